"""Near-duplicates by DartMinHash over weighted word shingles.

A document is the weighted set of its shingles (five words, runs of characters
other than ASCII white space; a shorter text is one shingle), weighted by their
counts.  DartMinHash (Christiani 2020): darts are thrown, by hash alone, into
the region (element, weight, rank); rank is cut into slabs of doubling height,
and the number of darts in a cell of one unit of weight and one slab is Poisson
distributed.  A document sees the darts that land below the weight of its
elements.  Each dart belongs to one of K coordinates; the earliest dart of a
coordinate is its sample, so two samples agree with the probability of the
weighted Jaccard similarity.  Slabs are thrown until every coordinate has one.

Signatures are cut into bands of `rows` samples, and documents that share a
band meet in a bucket.  Exact copies are settled first by two 64-bit hashes of
the text; one of them stands for its class.  In a bucket every text is compared
with a leader (by the weighted Jaccard of all their shingles); those that fail meet
again under a second leader.  Bands use two different orders of leaders, so
that texts of one class are tied together in several ways.  The links so far
make up classes; in every bucket where several classes meet, its texts are then
compared with one another in chunks, any two chunks of a bucket in a task that
returns links between classes only.  Two texts of a bucket are left uncompared
only if they are known to be of one class, so leaders save work and lose
nothing.  No bucket lists its pairs, and there is no cap.  Links of at least
`threshold` are joined to classes by min-label propagation with pointer jumping,
on written tables.

Defined results: null texts and texts without words have no shingles; each is a
class of its own, copies included.  Rows with equal doc_id count as one document.
A document without an id goes by a negative number made from its text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Powers, arrow_batches, chunks, hashed_words, mix, of_worker, released, windowed, written

WORDS, BANDS, ROWS, THRESHOLD = 5, 16, 5, 0.8
COORDINATES = BANDS * ROWS
LEADER_ORDERS, LEADER_ROUNDS = 2, 2
SET_KEY = ["sum", "xor", "least", "most"]  # with the number of texts: buckets that agree hold one set
CHUNK = 128  # texts of a bucket's chunk in the last step
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
_FIRST_SLAB = 2.0 ** -6


def units(texts, powers: Powers, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hash and document of every unit of weight: the c-th occurrence of a shingle in a document."""
    words, counts = hashed_words(texts, powers)
    firsts = np.cumsum(counts) - counts
    n = np.where(counts == 0, 0, np.maximum(counts - size + 1, 1))
    doc = np.repeat(np.arange(len(counts)), n)
    start = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + firsts[doc]
    shingle = windowed(words, start, start + np.minimum(size, counts[doc]), powers)
    both = mix(shingle + doc.astype(np.uint64) * _A)
    order = np.argsort(both, kind="stable")
    both, shingle, doc = both[order], shingle[order], doc[order]
    place = np.arange(len(both))
    fresh = np.diff(both, prepend=np.uint64(0)) != 0
    if len(fresh):
        fresh[0] = True
    nth = place - np.maximum.accumulate(np.where(fresh, place, 0))
    return mix(shingle + nth.astype(np.uint64) * _B), doc


def _poisson(area: float) -> np.ndarray:
    term, total, out = np.exp(-area), 0.0, []
    for n in range(1, 20_000):
        total += term
        out.append(total)
        if n > area and term < 1e-18:
            break
        term *= area / n
    return np.array(out)


def signatures(unit: np.ndarray, doc: np.ndarray, n_docs: int, k: int = COORDINATES) -> np.ndarray:
    """n_docs x k samples; a document without units keeps zeros."""
    sample, filled = np.zeros(n_docs * k, np.uint64), np.zeros(n_docs * k, bool)
    open_ = np.bincount(doc, minlength=n_docs) > 0
    height, slab = _FIRST_SLAB, 0
    while open_.any():
        mine = open_[doc]
        unit, doc = unit[mine], doc[mine]
        cell_hash = mix(unit + np.uint64((2 * slab + 1) * int(_C) % (1 << 64)))
        u = (cell_hash >> np.uint64(11)) * 2.0 ** -53
        table = _poisson(height)
        hit = np.flatnonzero(u >= table[0])
        n = np.searchsorted(table, u[hit], "right")
        thrown = np.repeat(hit, n)
        nth = np.arange(len(thrown)) - np.repeat(np.cumsum(n) - n, n)
        dart = mix(cell_hash[thrown] + (nth.astype(np.uint64) + np.uint64(1)) * _A)
        at = doc[thrown] * k + (dart % np.uint64(k)).astype(np.int64)
        new = ~filled[at]
        at, dart = at[new], dart[new]
        order = np.lexsort((mix(dart + _B), at))  # the rank inside the slab
        at, dart = at[order], dart[order]
        first = np.ones(len(at), bool)
        first[1:] = at[1:] != at[:-1]
        sample[at[first]], filled[at[first]] = dart[first], True
        open_ &= ~filled.reshape(n_docs, k).all(1)
        height, slab = (height if slab == 0 else 2 * height), slab + 1
    return sample.reshape(n_docs, k)


def _bands(bands: int, rows: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = of_worker("minhash", Powers)
        weights = np.multiply.accumulate(np.full(rows, _A, np.uint64))
        for batch in batches:
            texts = batch["text"].to_pylist()
            for lo, hi in chunks(texts):
                unit, doc = units(texts[lo:hi], powers, size)
                signed = signatures(unit, doc, hi - lo, bands * rows).reshape(hi - lo, bands, rows)
                keys = mix((signed * weights).sum(2, dtype=np.uint64) + np.arange(bands, dtype=np.uint64))
                none = np.bincount(doc, minlength=hi - lo) == 0
                lists = pa.FixedSizeListArray.from_arrays(
                    pa.array(keys.view(np.int64).ravel()), bands).cast(pa.list_(pa.int64())).to_pylist()
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], part["nid"], part["t1"], part["t2"],
                     pa.array([None if e else b for b, e in zip(lists, none, strict=True)],
                              pa.list_(pa.int64()))], ["doc_id", "nid", "t1", "t2", "bands"])

    return run


def _units_of(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = of_worker("minhash", Powers)
        for batch in batches:
            texts = batch["text"].to_pylist()
            out = []
            for lo, hi in chunks(texts):
                unit, doc = units(texts[lo:hi], powers, size)
                order = np.argsort(doc, kind="stable")
                cuts = np.searchsorted(doc[order], np.arange(1, hi - lo))
                short = (unit[order] >> np.uint64(32)).astype(np.uint32)
                out += [np.sort(u).tobytes() for u in np.split(short, cuts)]
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(out, pa.binary())], ["node", "units"])

    return run


def _alike(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Weighted Jaccard of two documents by 32-bit hashes of their units."""
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())  # units are distinct within a document
    return shared >= threshold * (len(both) - shared)


def _compare(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch["a_units"].to_pylist(), batch["b_units"].to_pylist(), strict=True):
                linked.append(_alike(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32), threshold))
            yield pa.RecordBatch.from_arrays([batch["node"], batch["lead"], pa.array(linked)],
                                             ["node", "lead", "linked"])

    return run


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node) of every node in links (a, b)."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = written(edges.groupBy("a").agg(F.least("a", F.min("b")).alias("root"))
                     .select(F.col("a").alias("node"), "root"), "labels")
    while True:
        near = (edges.join(labels, edges["b"] == labels["node"]).groupBy("a")
                .agg(F.min("root").alias("near")))
        least = (labels.join(near, labels["node"] == near["a"])
                 .select("node", F.col("root").alias("old"), F.least("root", "near").alias("root")))
        jump = labels.select(F.col("node").alias("j_node"), F.col("root").alias("j_root"))
        moved = written(least.join(jump, F.col("root") == F.col("j_node"))
                        .select("node", "old", F.least("root", "j_root").alias("root")), "labels")
        labels = moved.select("node", "root")
        if moved.filter("old <> root").isEmpty():
            return labels


def _linked_in_block(threshold: float):
    """Links that join the known classes among the texts of one or two chunks of a bucket."""

    def run(table: pa.Table) -> pa.Table:
        nodes = table["node"].to_numpy()
        bags = [np.frombuffer(u, np.uint32) for u in table["units"].to_pylist()]
        sizes = np.array([len(bag) for bag in bags])
        root = np.unique(table["root"].to_numpy(), return_inverse=True)[1]
        a, b = [], []
        for i in range(len(nodes) - 1):
            rest = slice(i + 1, None)
            near = threshold <= np.minimum(sizes[i], sizes[rest]) / np.maximum(sizes[i], sizes[rest])
            for j in i + 1 + np.flatnonzero(near & (root[rest] != root[i])):
                if root[j] != root[i]:
                    if _alike(bags[i], bags[j], threshold):
                        a.append(int(nodes[i]))
                        b.append(int(nodes[j]))
                        root[root == root[j]] = root[i]
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _sets(named: DataFrame) -> DataFrame:
    """Every bucket with its number of classes and texts, its largest class, and what its set of texts goes by."""
    node = F.xxhash64("node")
    each = named.groupBy("band", "key", "root").agg(
        F.count("*").alias("n"), F.sum(node.bitwiseAND(F.lit((1 << 40) - 1))).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(1), "node")).alias("xor"), F.min("node").alias("least"),
        F.max("node").alias("most"))
    return each.groupBy("band", "key").agg(
        F.count("*").alias("classes"), F.sum("n").alias("n"), F.sum("sum").alias("sum"),
        F.bit_xor("xor").alias("xor"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.max(F.struct("n", "root")).alias("top"))


def _in_blocks(named: DataFrame, shingled: DataFrame, threshold: float) -> DataFrame:
    """Links between the classes (root) known so far that meet in a bucket.

    The texts of the bucket's largest class are compared with all others, the
    others with one another too: every two chunks meet in one task, but for two
    chunks of the largest class.
    """
    sets = _sets(named).filter("classes > 1")
    # a set of texts that shares several buckets is compared in one of them
    sets = sets.groupBy("n", *SET_KEY).agg(F.min(F.struct("band", "key", "top")).alias("b")).select(
        "b.band", "b.key", F.col("b.top.root").alias("top"),
        F.ceil((F.col("n") - F.col("b.top.n")) / CHUNK).cast("int").alias("chunks"),
        F.when(F.col("n") > CHUNK, F.ceil(F.col("b.top.n") / CHUNK)).otherwise(0).cast("int").alias("top_chunks"))
    at = F.xxhash64("node", "key")
    in_top = (F.col("root") == F.col("top")) & (F.col("top_chunks") > 0)
    rows = (named.join(written(sets, "sets"), ["band", "key"])
            .withColumn("chunk", F.when(in_top, F.col("chunks") + F.pmod(at, F.greatest("top_chunks", F.lit(1))))
                        .otherwise(F.pmod(at, F.col("chunks"))).cast("int"))
            .select("node", "root", "band", "key", "chunk", F.explode(F.sequence(F.lit(0), F.when(
                in_top, F.col("chunks")).otherwise(F.col("chunks") + F.col("top_chunks")) - 1)).alias("other"))
            .select("node", "root", "band", "key", F.least("chunk", "other").alias("lo"),
                    F.greatest("chunk", "other").alias("hi")))
    return (rows.join(shingled, "node").groupBy("band", "key", "lo", "hi")
            .applyInArrow(_linked_in_block(threshold), "a long, b long"))


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    size: int = WORDS) -> DataFrame:
    """Per row of docs: doc_id, class_id (smallest doc_id of its class), n_links: links found to other texts."""
    arrow_batches(docs.sparkSession)
    t1 = F.xxhash64("text")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn(
        "nid", F.coalesce("doc_id", -1 - t1.bitwiseAND(F.lit((1 << 62) - 1))))
    signed = written(docs.select("doc_id", "nid", "text", t1.alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
                     .mapInArrow(released(_bands(bands, rows, size)), "doc_id long, nid long, t1 long, t2 long, bands array<long>"),
                     "signatures")
    copies = written(signed.filter("bands is not null").groupBy("t1", "t2")
                     .agg(F.min("nid").alias("first"), F.max("nid").alias("last"))
                     .filter("first < last").select("t1", "t2", "first"), "copies")
    nodes = written(signed.join(copies, ["t1", "t2"], "left")
                    .select("doc_id", F.coalesce("first", "nid").alias("node"),
                            F.when(F.col("first").isNull() | (F.col("first") == F.col("nid")),
                                   F.col("bands")).alias("bands")), "nodes")
    placed = nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "key"))
    full = (placed.groupBy("band", "key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
            .filter("lo < hi").select("band", "key"))
    shared = written(placed.join(written(full, "buckets"), ["band", "key"]).distinct(), "shared")
    wanted = shared.select("node").distinct()
    shingled = written(docs.join(wanted.hint("merge"), docs["nid"] == wanted["node"]).select("node", "text")
                       .mapInArrow(released(_units_of(size)), "node long, units binary"), "units")
    links, open_ = [], shared
    for turn in range(LEADER_ROUNDS):
        order = F.xxhash64("node", F.col("band") % LEADER_ORDERS, F.lit(turn))
        leads = written(open_.groupBy("band", "key").agg(
            F.min(F.struct(order.alias("o"), "node")).alias("lead"), F.count("*").alias("n"))
            .filter("n > 1").select("band", "key", F.col("lead.node").alias("lead")), "leads")
        met = written(open_.join(leads, ["band", "key"]).filter("node <> lead"), "met")
        pairs = met.select("node", "lead").distinct()
        a = shingled.select("node", F.col("units").alias("a_units"))
        b = shingled.select(F.col("node").alias("lead"), F.col("units").alias("b_units"))
        judged = written(pairs.join(a, "node").join(b, "lead").select("node", "lead", "a_units", "b_units")
                         .mapInArrow(released(_compare(threshold)), "node long, lead long, linked boolean"), "judged")
        links.append(judged.filter("linked").select(F.col("node").alias("a"), F.col("lead").alias("b")))
        open_ = written(met.join(judged.filter("not linked").distinct(), ["node", "lead"])
                        .select("node", "band", "key").distinct(), "open")
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    pair = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    found = written(found.select(*pair).distinct(), "links")
    roots = components(found)
    named = written(shared.join(roots, "node", "left").select(
        "node", "band", "key", F.coalesce("root", "node").alias("root")), "named")
    late = written(_in_blocks(named, shingled, threshold).select(*pair).distinct(), "links")
    return _classes(nodes, found.unionByName(late), _joined(roots, late))


def _joined(roots: DataFrame, late: DataFrame) -> DataFrame:
    """node, root of every node in roots or late, whose links (a, b) join classes of roots."""
    own = roots.select(F.col("node").alias("own"), F.col("root").alias("own_root"))
    for end in ("a", "b"):
        late = late.join(own, F.col(end) == F.col("own"), "left").withColumn(
            f"{end}_root", F.coalesce("own_root", end)).drop("own", "own_root")
    classes = components(late.select(F.col("a_root").alias("a"), F.col("b_root").alias("b"))).select(
        F.col("node").alias("old"), F.col("root").alias("joined"))
    nodes = roots.unionByName(classes.select(F.col("old").alias("node"), F.col("old").alias("root")).join(
        roots.select("node"), "node", "left_anti"))
    return nodes.join(classes, F.col("root") == F.col("old"), "left").select(
        "node", F.coalesce("joined", "root").alias("root"))


def _classes(nodes: DataFrame, links: DataFrame, roots: DataFrame) -> DataFrame:
    degree = (links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node")
              .agg(F.count("*").alias("n_links")))
    roots = roots.join(degree, "node")
    return (nodes.select("doc_id", "node").join(roots, "node", "left")
            .select("doc_id", F.coalesce("root", "node").alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
