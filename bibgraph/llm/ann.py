"""Approximate nearest neighbours by inner product over learned partitions.

Fit, on a bounded sample (`sample` distinct vectors, a parameter): a graph of
each vector's `graph_degree` nearest neighbours; a balanced partitioning of it
(random start, then rounds in which vectors move to the part most of their
neighbours are in, best gains first, no part growing beyond its share plus
`slack`); a small classifier, softmax over a hidden layer, that learns the
parts of a vector's neighbours from the vector (Dong et al. 2020).  The same
sample, searched exactly, tells how many of the most probable parts a query
must visit to reach `target_recall`.

Parts grow in number with the table: a part of more than 4 * `leaf` vectors is cut
again in the same way, by a graph and a classifier fitted on a sample of its own, in
a task of its own, until all are small (at most DEPTH times; a part that cannot be
cut further is searched whole, in chunks).

Index: every distinct vector goes to its most probable part; equal vectors are
one entry with their k + 1 smallest ids, which is exact, as ties go to the
smaller id.  Search: queries visit their most probable parts; a part is cut
into chunks of bounded size, each compared with a bounded block of the queries that
visit the part by one matrix product in double precision, and the best k of every
chunk are merged by query.  A chunk is copied once per block of its own part's
queries, so the rows shuffled grow with the table, not with its square.

Vectors that are null, zero or hold null or non-finite components take no part, nor
do vectors of another length than most have (the longer one of equally frequent
lengths).  Repeated rows are candidates as often as their ids differ.  An empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

CHUNK, QUERY_BLOCK = 8192, 4096
TRIVIAL = 400  # distinct vectors; smaller tables are one part, searched exactly
MOST_PARTS = 64  # that one classifier tells apart
DEPTH = 8  # cuts of a part at most


class Router:
    """Partition probabilities of vectors, and how many partitions to visit."""

    def __init__(self, w1: np.ndarray, w2: np.ndarray, probes: int):
        self.w1, self.w2, self.probes = w1, w2, probes

    def scores(self, x: np.ndarray) -> np.ndarray:
        x = (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)).astype(np.float32)
        hidden = np.maximum(np.hstack([x, np.ones((len(x), 1), np.float32)]) @ self.w1, 0)
        return np.hstack([x, hidden, np.ones((len(x), 1), np.float32)]) @ self.w2


def _top(products: np.ndarray, k: int) -> np.ndarray:
    k = min(k, products.shape[1])
    return np.argpartition(-products, k - 1, axis=1)[:, :k]


def neighbour_graph(x: np.ndarray, degree: int) -> np.ndarray:
    """Places of each row's nearest rows by inner product, itself left out."""
    out = np.empty((len(x), min(degree, len(x) - 1)), np.int32)
    for lo in range(0, len(x), 512):
        products = x[lo:lo + 512] @ x.T
        products[np.arange(len(products)), np.arange(lo, lo + len(products))] = -np.inf
        out[lo:lo + 512] = _top(products, degree)
    return out


def balanced_parts(graph: np.ndarray, parts: int, slack: float = 0.05, rounds: int = 30,
                   seed: int = 3) -> np.ndarray:
    """Part of each vertex: few cut edges, no part larger than its share plus slack."""
    n = len(graph)
    most = int(np.ceil(n / parts * (1 + slack)))
    rng = np.random.default_rng(seed)
    part = np.empty(n, np.int64)
    # regions grown breadth-first from random seeds make the first, balanced cut
    part[:] = -1
    order, free = rng.permutation(n), 0
    for p in range(parts):
        want, front = (n * (p + 1)) // parts - (n * p) // parts, []
        while want:
            if not front:
                while free < n and part[order[free]] >= 0:
                    free += 1
                front = [order[free]]
            nxt = []
            for v in front:
                if part[v] < 0 and want:
                    part[v] = p
                    want -= 1
                    nxt += [u for u in graph[v] if part[u] < 0]
            front = nxt
    for _ in range(rounds):
        votes = np.zeros((n, parts), np.int32)
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)  # both directions
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        sizes, moved = np.bincount(part, minlength=parts), 0
        for v in np.argsort(-gain, kind="stable"):
            if gain[v] <= 0:
                break
            if sizes[best[v]] < most:
                sizes[part[v]] -= 1
                sizes[best[v]] += 1
                part[v] = best[v]
                moved += 1
        if not moved:
            break
    return part


def learn(x: np.ndarray, graph: np.ndarray, part: np.ndarray, parts: int, hidden: int = 96,
          epochs: int = 40, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Softmax classifier (one hidden layer and a linear path) of the parts of a vector and its neighbours."""
    rng = np.random.default_rng(seed)
    goal = np.zeros((len(x), parts), np.float32)
    np.add.at(goal, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].ravel()), 1)
    goal[np.arange(len(x)), part] += 2
    goal /= goal.sum(1, keepdims=True)
    one = np.ones((len(x), 1), np.float32)
    inputs = np.hstack([x, one])
    weights = [rng.normal(0, 0.3, (inputs.shape[1], hidden)).astype(np.float32),
               np.zeros((x.shape[1] + hidden + 1, parts), np.float32)]
    mean, square, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 256):
            at = order[lo:lo + 256]
            pre = inputs[at] @ weights[0]
            act = np.hstack([x[at], np.maximum(pre, 0), one[at]])
            z = act @ weights[1]
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            err = (p - goal[at]) / len(at)
            back = (err @ weights[1][x.shape[1]:-1].T) * (pre > 0)
            t += 1
            for i, g in enumerate((inputs[at].T @ back, act.T @ err)):
                mean[i] = 0.9 * mean[i] + 0.1 * g
                square[i] = 0.999 * square[i] + 0.001 * g * g
                weights[i] -= 0.01 * (1 - 0.9 * epoch / epochs) * (mean[i] / (1 - 0.9**t)) / (
                    np.sqrt(square[i] / (1 - 0.999**t)) + 1e-8)
    return weights[0], weights[1]


def fit(x: np.ndarray, parts: int, k: int = 20, target_recall: float = 0.95, graph_degree: int = 16,
        checks: int = 1000) -> Router:
    """x: the sample.  Probes: the fewest parts that hold target_recall of the checked rows' k nearest."""
    x = x.astype(np.float32)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    graph = neighbour_graph(unit, graph_degree)
    part = balanced_parts(graph, parts)
    w1, w2 = learn(unit, graph, part, parts)
    router = Router(w1, w2, parts)
    scores = router.scores(x)
    home = scores.argmax(1)
    at = np.random.default_rng(11).permutation(len(x))[:checks]
    products = x[at] @ x.T
    products[np.arange(len(at)), at] = -np.inf
    rank = np.argsort(np.argsort(-scores[at], axis=1), axis=1)  # how early a query visits a part
    needed = np.take_along_axis(rank, home[_top(products, k)], 1).ravel()
    hits = np.cumsum(np.bincount(needed, minlength=parts)) / len(needed)
    router.probes = int(np.searchsorted(hits, target_recall)) + 1
    return router


def _usable(c: str) -> Column:
    bad = F.exists(c, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.col(c).isNotNull() & ~bad & F.exists(c, lambda v: v != 0)


def _entries(k: int):
    """Equal vectors of a batch as one row: their k + 1 smallest ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[bytes, list] = {}
            for row, vec in zip(batch["vec_id"].to_pylist(), batch["vec"].to_pylist(), strict=True):
                held.setdefault(np.asarray(vec, "<f8").tobytes(), []).append(row)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.binary()),
                 pa.array([sorted(set(ids))[:k + 1] for ids in held.values()], pa.list_(pa.int64()))],
                ["vec", "ids"])

    return run


def _vectors(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(rows["vec"].to_pylist()), "<f8").reshape(rows.num_rows, -1)


def _visited(router: Router, x: np.ndarray, home: bool) -> pa.Array:
    scores = router.scores(x)
    places = scores.argmax(1)[:, None] if home else np.argsort(-scores, axis=1)[:, :router.probes]
    return pa.array([[str(p) for p in row] for row in places.tolist()], pa.list_(pa.string()))


def _routed(router: Router, home: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([*batch.columns, _visited(router, _vectors(batch), home)],
                                                 [*batch.schema.names, "parts"])

    return run


def _fitted(k: int, target_recall: float):
    """The classifier of one part, from the sample of it."""

    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        x = _vectors(rows)
        wanted = min(rows["wanted"][0].as_py(), len(x) // 5)
        out = []
        if wanted > 1:
            router = fit(np.stack(sorted(x, key=lambda v: v.tobytes())), wanted, k, target_recall)
            out = [(key[0].as_py(), router.w1.tobytes(), router.w2.tobytes(), wanted, router.probes)]
        columns = zip(*out, strict=True) if out else [[]] * 5
        types = [pa.string(), pa.binary(), pa.binary(), pa.int32(), pa.int32()]
        return pa.table([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                        names=["part", "w1", "w2", "wanted", "probes"])

    return run


def _rerouted(home: bool):
    """Rows of a part with the parts of it that they go to, by the part's classifier."""

    def run(key, rows: pa.Table, routers: pa.Table) -> pa.Table:
        x = _vectors(rows) if rows.num_rows else np.zeros((0, 1))
        parts = pa.array([[]] * len(x), pa.list_(pa.string()))
        if len(x) and routers.num_rows:
            r = routers.to_pylist()[0]
            w2 = np.frombuffer(r["w2"], np.float32).reshape(-1, r["wanted"])
            w1 = np.frombuffer(r["w1"], np.float32).reshape(x.shape[1] + 1, -1)
            parts = _visited(Router(w1, w2, r["probes"]), x, home)
        return rows.drop_columns(["salt"]).append_column("parts", parts)

    return run


def _matched(k: int):
    """Best k candidates in a chunk for each query of a block."""

    def run(key, queries: pa.Table, entries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and entries.num_rows:
            x, ids = _vectors(entries), entries["ids"].to_pylist()
            q, own = _vectors(queries), queries["query_id"].to_pylist()
            first = np.array([i[0] for i in ids])
            # products may differ from exact scores by the rounding of their sums
            slack = 4e-16 * x.shape[1] * float(np.linalg.norm(x, axis=1).max()) * np.linalg.norm(q, axis=1)
            for lo in range(0, len(q), 128):
                # products added up in one order whatever the block, so that a score depends on its vectors alone
                products = q[lo:lo + 128] @ x.T
                for i, row in enumerate(products):
                    near = np.flatnonzero(row >= row[np.argpartition(-row, min(k, len(row) - 1))[
                        min(k, len(row) - 1)]] - slack[lo + i])
                    exact = np.array([float(np.dot(q[lo + i], x[j])) for j in near])
                    order = np.lexsort((first[near], -exact))
                    rows = [(-exact[o], v) for o in order for v in ids[near[o]] if v != own[lo + i]]
                    rows = sorted(rows)[:k]
                    out_q += [own[lo + i]] * len(rows)
                    out_v += [v for _, v in rows]
                    out_s += [-s for s, _ in rows]
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(out_v, pa.int64()),
                         "score": pa.array(out_s, pa.float64())})

    return run


def _cut(index: DataFrame, asked: DataFrame, leaf: int, sample: int, k: int,
         target_recall: float) -> tuple[DataFrame, DataFrame]:
    """Large parts of the index cut into parts of their own, and the queries that visit them sent on."""
    for depth in range(DEPTH):
        # what cuts lose adds up: each may lose a quarter of what the one before may
        recall = 1 - (1 - target_recall) / 4 ** (depth + 1)
        sizes = written(index.groupBy("part").count(), "sizes")
        large = sizes.filter(F.col("count") > 4 * leaf)
        if large.isEmpty():
            break
        share = F.pmod(F.xxhash64("vec", "part"), F.lit(1 << 40)) / float(1 << 40) * F.col("count")
        routers = written(
            index.join(large, "part").filter(share < sample)
            .select("part", "vec", F.least(F.lit(MOST_PARTS), F.floor(F.col("count") / leaf)).alias("wanted"))
            .groupBy("part").applyInArrow(_fitted(k, recall),
                                          "part string, w1 binary, w2 binary, wanted int, probes int"), "routers")
        asks = written(asked.groupBy("part").count(), "asks")

        def sent(rows: DataFrame, counts: DataFrame, home: bool, schema: str) -> DataFrame:
            cut = counts.join(routers.select("part"), "part").select(
                "part", F.ceil(F.col("count") / CHUNK).cast("int").alias("salts"))
            salted = rows.join(cut, "part").withColumn(
                "salt", F.pmod(F.xxhash64("vec", rows.columns[0]), F.col("salts")).cast("int")).drop("salts")
            models = routers.join(cut, "part").withColumn(
                "salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
            moved = salted.groupBy("part", "salt").cogroup(models.groupBy("part", "salt")).applyInArrow(
                _rerouted(home), f"{schema}, part string, parts array<string>")
            moved = moved.select(*rows.columns[:2], F.explode("parts").alias("_p"), "part").select(
                *rows.columns[:2], F.concat_ws(".", "part", "_p").alias("part"))
            return rows.join(routers.select("part"), "part", "left_anti").select(*rows.columns).unionByName(moved)

        if routers.isEmpty():
            break
        index, asked = (written(sent(index, sizes, True, "vec binary, ids array<long>"), "index"),
                        written(sent(asked, asks, False, "query_id long, vec binary"), "asked"))
    return index, asked


def search(vectors: DataFrame, is_query: Column, k: int = 20, sample: int = 12_000,
           target_recall: float = 0.94, parts: int | None = None, leaf: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query among all other rows.

    vectors: vec_id and embedding.  is_query marks the rows that are queries.
    """
    vectors = (vectors.filter(F.col("vec_id").isNotNull() & _usable("embedding"))
               .select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("vec"), is_query.alias("asks")))
    usual = vectors.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    if not usual:
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id",
                              F.lit(0.0).alias("score")).limit(0)
    vectors = vectors.filter(F.size("vec") == usual["n"])
    entries = written(
        vectors.select("vec_id", "vec").mapInArrow(_entries(k), "vec binary, ids array<long>")
        .groupBy("vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, k + 1)
                            .alias("ids")), "entries")
    total = entries.count()
    chosen = entries.select("vec") if total <= sample else entries.select("vec").filter(
        F.pmod(F.xxhash64("vec"), F.lit(1_000_000)) < int(1_000_000 * sample / total))
    x = [np.frombuffer(r["vec"], "<f8") for r in chosen.collect()]
    parts = parts or int(np.clip(total // leaf, 4 if total >= TRIVIAL else 1, MOST_PARTS))
    router = fit(np.stack(sorted(x, key=lambda v: v.tobytes())), parts, k, target_recall) \
        if parts > 1 and len(x) > 4 * parts else None

    def routed(rows: DataFrame, home: bool, schema: str) -> DataFrame:
        rows = rows.mapInArrow(_routed(router, home), f"{schema}, parts array<string>") if router else \
            rows.withColumn("parts", F.array(F.lit("0")))
        return rows.withColumn("part", F.explode("parts")).drop("parts")

    index = written(routed(entries, True, "vec binary, ids array<long>"), "index")
    asked = vectors.filter("asks").select(F.col("vec_id").alias("query_id"), "vec").distinct().mapInArrow(
        _packed, "query_id long, vec binary")
    asked = written(routed(asked, False, "query_id long, vec binary"), "asked")
    index, asked = _cut(index, asked, leaf, sample, k, target_recall)
    # a chunk of a part goes to the blocks of queries that visit the part
    count = lambda rows, size, name: rows.groupBy("part").agg(
        F.ceil(F.count(F.lit(1)) / size).cast("int").alias(name))
    plan = written(count(index, CHUNK, "chunks").join(count(asked, QUERY_BLOCK, "blocks"), "part"), "plan")
    hashed = lambda c, n: F.pmod(F.xxhash64(c), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    asked = (asked.join(plan, "part").withColumn("block", hashed("query_id", "blocks"))
             .withColumn("chunk", every("chunks")).drop("chunks", "blocks"))
    held = (index.join(plan, "part").withColumn("chunk", hashed("vec", "chunks"))
            .withColumn("block", every("blocks")).drop("chunks", "blocks"))
    met = asked.groupBy("part", "chunk", "block").cogroup(held.groupBy("part", "chunk", "block")).applyInArrow(
        _matched(k), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (met.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vecs = [np.asarray(v, "<f8").tobytes() for v in batch["vec"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["query_id"], pa.array(vecs, pa.binary())], ["query_id", "vec"])
