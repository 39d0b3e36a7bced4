"""Graph projection, PageRank and strongly connected components as Spark loops.

Design for scale
* Vertex values (rank, colour, mark) are vertex-sized tables; edges are the
  large table and are shuffled once per edge set, written as a table
  bucketed on ``(src, salt)`` and never moved again (a bucketed scan reports
  its partitioning, so each round shuffles only the vertex side).
* A source with a huge out-degree is split: its edges are spread over
  ``ceil(outdeg / hot_edges)`` salt buckets and its value row is replicated
  once per bucket, so no task receives a third of all edges.
* A bucket's value rows are hashed, so a round doesn't sort its edges again (``EdgeSet.messages``).
* Messages are aggregated per destination with partial (map-side)
  aggregation, so a hot destination is pre-combined before the shuffle.
* Every round is written into the session's checkpoint folder and the round before
  the last is removed, so plans don't grow: cached rounds nest in each other's plans,
  and Spark keeps the text of a thousand plans in the driver's memory.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegralType, NumericType
from pyspark.storagelevel import StorageLevel

from ..session import (checkpoint_dir, own_shuffles_removed, remove, scratch_database, scratch_path, tasks_for,
                       written_to)

HOT_EDGES = 1 << 20  # edges per salt bucket of one source vertex
#: Edges a vertex from which on a first sweep from one vertex looks for a component of most vertices.
DENSE = 4


@dataclass(frozen=True)
class Projection:
    """vertices(id bigint, label, key) and edges(src bigint, dst bigint)."""
    vertices: DataFrame
    edges: DataFrame

    def counts(self) -> DataFrame:
        """One row (nodeCount, relationshipCount) from one aggregate over both tables."""
        both = (self.vertices.select(F.lit(1).alias("v"), F.lit(0).alias("e"))
                .unionByName(self.edges.select(F.lit(0).alias("v"), F.lit(1).alias("e"))))
        return both.agg(F.sum("v").cast("bigint").alias("nodeCount"),
                        F.sum("e").cast("bigint").alias("relationshipCount"))


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def project(nodes: dict[str, DataFrame], rels: list[tuple[str, str, DataFrame]],
            orientation: str = "natural") -> Projection:
    """Named-graph projection.

    ``nodes`` maps a label to a one-column DataFrame of keys; ``rels`` lists
    (src_label, dst_label, DataFrame(s, d)).  Integral keys are encoded
    arithmetically as ``key * n_labels + label_index``; other keys get ids from ``monotonically_increasing_id`` made stable by a
    checkpoint before use.
    """
    labels = list(nodes)
    n = len(labels)
    first = nodes[labels[0]]
    integral = all(isinstance(df.schema[0].dataType, IntegralType) for df in nodes.values())
    spark = first.sparkSession
    if integral:
        parts = [nodes[lb].select(F.col(nodes[lb].columns[0]).cast("bigint").alias("key"))
                 .distinct()
                 .select((F.col("key") * n + i).alias("id"), F.lit(lb).alias("label"), "key")
                 for i, lb in enumerate(labels)]
        vertices = parts[0]
        for p in parts[1:]:
            vertices = vertices.unionByName(p)

        def vid(label: str, c):
            return F.col(c).cast("bigint") * n + labels.index(label)
        edge_parts = [df.select(vid(sl, df.columns[0]).alias("src"),
                                vid(dl, df.columns[1]).alias("dst"))
                      for sl, dl, df in rels]
    else:
        checkpoint_dir(spark)
        parts = [df.select(F.col(df.columns[0]).cast("string").alias("key")).distinct()
                 .withColumn("label", F.lit(lb)) for lb, df in nodes.items()]
        vertices = parts[0]
        for p in parts[1:]:
            vertices = vertices.unionByName(p)
        vertices = (vertices.withColumn("id", F.monotonically_increasing_id())
                    .select("id", "label", "key").checkpoint(eager=True))
        edge_parts = []
        for sl, dl, df in rels:
            s = vertices.where(F.col("label") == sl).select(F.col("key").alias("_s"),
                                                            F.col("id").alias("src"))
            d = vertices.where(F.col("label") == dl).select(F.col("key").alias("_d"),
                                                            F.col("id").alias("dst"))
            e = df.select(F.col(df.columns[0]).cast("string").alias("_s"),
                          F.col(df.columns[1]).cast("string").alias("_d"))
            edge_parts.append(e.join(s, "_s").join(d, "_d").select("src", "dst"))
    edges = edge_parts[0]
    for p in edge_parts[1:]:
        edges = edges.unionByName(p)
    if integral:  # an edge whose end is not projected is dropped, as for other keys
        for end in ("src", "dst"):
            edges = edges.join(vertices.select(F.col("id").alias(end)), end, "left_semi")
        edges = edges.select("src", "dst")
    if orientation == "reverse":
        edges = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    elif orientation == "undirected":
        edges = edges.unionByName(edges.select(F.col("dst").alias("src"),
                                               F.col("src").alias("dst")))
    elif orientation != "natural":
        raise ValueError(orientation)
    return Projection(vertices, edges)


def bucketed(df: DataFrame, cols: list[str], label: str, n: int | None = None) -> tuple[DataFrame, str]:
    """Write ``df`` as a table bucketed on ``cols`` (``n`` buckets) into the checkpoint folder.

    A bucketed scan reports its hash partitioning, so later joins on ``cols``
    shuffle only the other side; the written table is also the lineage cut.
    Returns the table and its catalog name; dropping the table removes its files.
    """
    spark = df.sparkSession
    n = n or _partitions(spark)
    name = f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:12]}"
    # hash-partition on the bucket columns first: bucket ids use the same
    # hash, so each task writes exactly one bucket file (not tasks x buckets)
    with own_shuffles_removed(spark):
        df.repartition(n, *cols).write.format("parquet").bucketBy(n, *cols).saveAsTable(name)
    return spark.table(name), name


class EdgeSet:
    """Edges written once, bucketed on (src, salt), with hot sources split.

    Every round has a task per bucket, so the number of buckets follows the number of
    edges: the few edges that late phases of a loop are left with make few tasks.
    """

    def __init__(self, edges: DataFrame, hot_edges: int | None = None):
        hot_edges = hot_edges or HOT_EDGES
        self.spark = edges.sparkSession
        # read twice below (degrees, then salted edges): keep the input once
        edges = edges.persist(StorageLevel.MEMORY_AND_DISK)
        n = tasks_for(self.spark, edges.count())
        deg = edges.groupBy("src").agg(F.count(F.lit(1)).alias("outdeg"))
        self.fanout, n1 = bucketed(
            deg.select(F.col("src").alias("id"), "outdeg",
                       F.greatest(F.lit(1), F.ceil(F.col("outdeg") / hot_edges))
                       .cast("int").alias("s")), ["id"], "fanout", n)
        # at most (edges / hot_edges) sources are split: no edge is shuffled on a plain source
        hot = self.fanout.where(F.col("s") > 1).select("id", "s")
        self.hot = None if hot.isEmpty() else hot
        self.edges, n2 = bucketed(
            self._split(edges, "src").select(
                "src", F.pmod(F.xxhash64("dst"), F.col("s")).cast("int").alias("salt"), "dst"),
            ["src", "salt"], "edges", n)
        edges.unpersist()
        self._names = [n1, n2]

    def _split(self, df: DataFrame, key: str) -> DataFrame:
        """``df`` with ``s``, the buckets of each source in column ``key``; no row is shuffled for it."""
        if self.hot is None:
            return df.withColumn("s", F.lit(1))
        hot = F.broadcast(self.hot.select(F.col("id").alias(key), F.col("s").alias("_s")))
        return df.join(hot, key, "left").withColumn("s", F.coalesce("_s", F.lit(1))).drop("_s")

    def messages(self, values: DataFrame, cols: list[str]) -> DataFrame:
        """Rows (dst, *cols) for every edge whose source has a row in
        ``values(id, *cols[, s])`` (``s`` is looked up when missing).

        Values of fixed width are hashed: a bucket has at most as many of them as edges, and those
        need no sort then.  Others (sketches, text) may not fit and are merged.
        """
        narrow = all(isinstance(values.schema[c].dataType, (NumericType, BooleanType)) for c in cols)
        if "s" not in values.columns:
            values = self._split(values, "id")
        salt = F.lit(0) if self.hot is None else F.explode(F.sequence(F.lit(0), F.col("s") - 1))
        sv = values.select(F.col("id").alias("src"), salt.alias("salt"), *cols)
        return self.edges.join(sv.hint("shuffle_hash") if narrow else sv, ["src", "salt"]).select("dst", *cols)

    def release(self) -> None:
        """Drop the tables and their files.
        Call only after every result that reads the edge set is cut."""
        for n in self._names:
            self.spark.sql(f"DROP TABLE IF EXISTS {n}")
        self._names = []


@dataclass(frozen=True)
class NamedProjection(Projection):
    """A projection whose edges are written, bucketed in both directions, for any number of algorithm runs."""
    name: str = ""
    forward: EdgeSet | None = None
    backward: EdgeSet | None = None
    has_loops: bool = False


class ProjectionCatalog:
    """Named projections: written once, shared by the algorithms, dropped with their files."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._held: dict[str, tuple[NamedProjection, str]] = {}

    def project(self, name: str, proj: Projection, hot_edges: int | None = None) -> NamedProjection:
        """Write a projection under a name; a name can be used again after ``drop``."""
        if name in self._held:
            raise ValueError(f"a projection named {name!r} exists")
        vertices, table = bucketed(proj.vertices, ["id"], "vertices")
        forward = EdgeSet(proj.edges.distinct(), hot_edges)
        edges = forward.edges.select("src", "dst")
        backward = EdgeSet(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), hot_edges)
        loops = not edges.where("src = dst").isEmpty()
        out = NamedProjection(vertices, edges, name, forward, backward, loops)
        self._held[name] = (out, table)
        return out

    def get(self, name: str) -> NamedProjection:
        if name not in self._held:
            raise KeyError(f"no projection named {name!r}")
        return self._held[name][0]

    def names(self) -> list[str]:
        return sorted(self._held)

    def drop(self, name: str) -> None:
        """Forget a projection and remove its files; results that still read it must be written before."""
        proj = self.get(name)
        proj.forward.release()
        proj.backward.release()
        self.spark.sql(f"DROP TABLE IF EXISTS {self._held.pop(name)[1]}")


class Materializer:
    """Per-round tables of a loop: each round is written and read back (a plan of one round, whatever came
    before), its shuffle files go, and so do all but the last ``keep`` rounds.  ``every`` is not used any more."""

    def __init__(self, every: int = 5, keep: int = 2):
        self.keep = keep
        self._spark: SparkSession | None = None
        self._held: list[str] = []

    def __call__(self, df: DataFrame, force_checkpoint: bool = False) -> DataFrame:
        if force_checkpoint:  # stays after close()
            return _cut(df)
        self._spark = df.sparkSession
        path = scratch_path(self._spark, "round")
        out = written_to(df, path)
        self._held.append(path)
        # the previous round may still be read by the caller (convergence test)
        remove(self._spark, self._held[:-self.keep])
        self._held = self._held[-self.keep:]
        return out

    def close(self) -> None:
        if self._held:
            remove(self._spark, self._held)
        self._held = []


def pagerank(proj: Projection, damping: float = 0.85, max_iter: int = 20,
             tol: float | None = None, checkpoint_every: int = 5,
             hot_edges: int | None = None) -> DataFrame:
    """Un-normalised PageRank ``(1-d) + d * sum(rank(u) / outdeg(u))``.

    Starts at ``1-d``; dangling mass is not redistributed; vertices without
    in-edges keep ``1-d``.  Runs ``max_iter`` rounds, or stops earlier when
    ``tol`` is given and no score moves by more than ``tol`` (the graph
    library's defaults are 20 rounds and 1e-7).  Only vertices with in-edges
    carry a rank row; everything else is ``1-d`` by definition.
    Returns (id, label, key, score).
    """
    spark = proj.vertices.sparkSession
    checkpoint_dir(spark)
    named = isinstance(proj, NamedProjection)
    es = proj.forward if named else EdgeSet(proj.edges.distinct(), hot_edges)
    base = 1.0 - damping
    mat = Materializer(checkpoint_every)
    ranks = None
    for i in range(1, max_iter + 1):
        if ranks is None:
            w = es.fanout.select("id", "s", (F.lit(base) / F.col("outdeg")).alias("w"))
        else:
            w = (es.fanout.join(ranks, "id", "left")
                 .select("id", "s", (F.coalesce(F.col("rank"), F.lit(base)) / F.col("outdeg"))
                         .alias("w")))
        inc = es.messages(w, ["w"]).groupBy("dst").agg(F.sum("w").alias("inc"))
        new = inc.select(F.col("dst").alias("id"),
                         (F.lit(base) + F.lit(damping) * F.col("inc")).alias("rank"))
        last = i == max_iter
        if tol is not None:
            new = mat(new, force_checkpoint=last)
            if ranks is None:
                delta = new.agg(F.max(F.abs(F.col("rank") - F.lit(base)))).first()[0]
            else:
                delta = (new.join(ranks.withColumnRenamed("rank", "old"), "id")
                         .agg(F.max(F.abs(F.col("rank") - F.col("old")))).first()[0])
            ranks = new
            if delta is None or delta <= tol:
                if not last:
                    ranks = ranks.checkpoint(eager=True)
                break
        else:
            ranks = new.checkpoint(eager=True) if last or i % checkpoint_every == 0 else new
    mat.close()
    if not named:
        es.release()
    if ranks is None:
        ranks = proj.vertices.select("id", F.lit(base).alias("rank")).limit(0)
    return (proj.vertices.join(ranks, "id", "left")
            .select("id", "label", "key",
                    F.coalesce(F.col("rank"), F.lit(base)).alias("score")))


def _cut(df: DataFrame) -> DataFrame:
    with own_shuffles_removed(df.sparkSession):
        return df.checkpoint(eager=True)


def _reached(active: DataFrame, start: int, es: EdgeSet, checkpoint_every: int) -> DataFrame:
    """active vertices (id) with ``k``: the start vertex leads to them along the edges.  Each sends once."""
    mat = Materializer(checkpoint_every)
    mark = active.select("id", (F.col("id") == start).alias("k"))
    frontier = mark.where("k").select("id")
    while True:
        come = es.messages(frontier, []).select(F.col("dst").alias("u")).distinct()
        new = mat(mark.join(come, mark.id == come.u, "left")
                  .select("id", (F.col("k") | F.col("u").isNotNull()).alias("k"),
                          (~F.col("k") & F.col("u").isNotNull()).alias("changed")))
        frontier = new.where("changed").select("id")
        mark = new.select("id", "k")
        if frontier.count() == 0:
            break
    mark = _cut(mark)
    mat.close()
    return mark


def _around(active: DataFrame, start: int, fwd: EdgeSet, bwd: EdgeSet, checkpoint_every: int) -> DataFrame:
    """(id, c, k): k marks the component of the start vertex; no component spans two values of c."""
    ahead = _reached(active, start, fwd, checkpoint_every).select("id", F.col("k").alias("f"))
    behind = _reached(active, start, bwd, checkpoint_every).select("id", F.col("k").alias("b"))
    return _cut(ahead.join(behind, "id").select(
        "id", (F.col("f").cast("bigint") * 2 + F.col("b").cast("bigint")).alias("c"),
        (F.col("f") & F.col("b")).alias("k")))


def _coloured(active: DataFrame, fwd: EdgeSet, bwd: EdgeSet, checkpoint_every: int) -> DataFrame:
    """(id, c, k): the colour of each vertex, and whether it is in the component of the colour's root."""
    # forward colouring: colour(v) = smallest hash(id) among the vertices that
    # reach v.  Hashed priorities make the number of phases independent of how
    # ids happen to be ordered along the edges; xxhash64 maps different longs to
    # different longs, so a hash names its vertex and, as a plain number, is
    # aggregated without a sort.  (Messages to trimmed vertices meet no row.)
    mat = Materializer(checkpoint_every)
    priority = F.xxhash64(F.col("id").cast("bigint"))
    colour = active.select("id", priority.alias("c"))
    senders = colour  # only vertices whose colour dropped send in the next round
    while True:
        m = fwd.messages(senders, ["c"]).groupBy("dst").agg(F.min("c").alias("m"))
        new = mat(colour.join(m, colour.id == m.dst, "left")
                  .select("id", F.least("c", F.coalesce("m", "c")).alias("c"),
                          F.coalesce(F.col("m") < F.col("c"), F.lit(False))
                          .alias("changed")))
        changed = new.where(F.col("changed")).count()
        colour = new.select("id", "c")
        senders = new.where(F.col("changed")).select("id", "c")
        if changed == 0:
            break
    colour = _cut(colour)
    mat.close()
    # backward sweep inside each colour, from the root: a message counts
    # only where sender and receiver have the same colour
    mat = Materializer(checkpoint_every)
    mark = colour.select("id", "c", (priority == F.col("c")).alias("k"))
    frontier = mark.where("k").select("id", "c")
    while True:
        reached = bwd.messages(frontier, ["c"]).select(F.col("dst").alias("u"),
                                                       F.col("c").alias("uc")).distinct()
        new = mat(mark.join(reached, (mark.id == reached.u) & (mark.c == reached.uc), "left")
                  .select("id", "c", (F.col("k") | F.col("u").isNotNull()).alias("k"),
                          (~F.col("k") & F.col("u").isNotNull()).alias("changed")))
        frontier = new.where(F.col("changed")).select("id", "c")
        mark = new.select("id", "c", "k")
        if frontier.count() == 0:
            break
    mark = _cut(mark)
    mat.close()
    return mark


def strongly_connected_components(proj: Projection, max_trim_rounds: int = 8,
                                  checkpoint_every: int = 5,
                                  hot_edges: int | None = None) -> DataFrame:
    """(id, label, key, componentId): componentId is the smallest vertex id of the SCC.

    Trim (a vertex without in- or out-edges in the remaining graph is a
    singleton SCC); in a graph of many edges a vertex, one sweep forward and
    one backward from a vertex of many edges, once; then forward colouring with hashed priorities and a
    backward sweep inside each colour from its root (Fleischer-Hendrickson-
    Pinar; Orzan).  Each phase writes the remaining edges twice, bucketed by
    source and by target; its rounds shuffle vertex-sized rows only: trimming
    subtracts the removed vertices' messages from degree counters, and the
    sweeps send from vertices that changed.  Edges across colours are dropped
    after each phase, since an SCC never spans two colours.  Rounds inside a
    sweep are written and counted (``checkpoint_every`` is not used any more); a
    reliable checkpoint cuts the lineage at the end of each sweep.
    """
    spark = proj.vertices.sparkSession
    checkpoint_dir(spark)
    active = _cut(proj.vertices.select("id").distinct())
    active = _cut(active.repartition(tasks_for(spark, active.count()), "id"))
    # the edges of a named projection are distinct and written in both directions
    held = [proj.forward, proj.backward] if isinstance(proj, NamedProjection) and not proj.has_loops else []
    edges = proj.edges if held else _cut(proj.edges.where(F.col("src") != F.col("dst")).distinct())
    found: list[DataFrame] = []
    swept = False
    while not active.isEmpty():
        own = not held
        fwd, bwd = held or (EdgeSet(edges, hot_edges), EdgeSet(
            edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")), hot_edges))
        held = []
        degree = lambda es, name: es.fanout.select("id", F.col("outdeg").alias(name))
        state = _cut(active.join(degree(fwd, "n_out"), "id", "left").join(degree(bwd, "n_in"), "id", "left")
                     .select("id", F.coalesce("n_out", F.lit(0)).alias("n_out"),
                             F.coalesce("n_in", F.lit(0)).alias("n_in")))
        for _ in range(max_trim_rounds):
            bare = (F.col("n_out") <= 0) | (F.col("n_in") <= 0)
            gone = _cut(state.where(bare).select("id"))
            if gone.isEmpty():
                break
            found.append(gone.select("id", F.col("id").alias("componentId")))
            lost = lambda es, name: es.messages(gone, []).groupBy(  # noqa: E731, B023
                F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias(name))
            state = _cut(state.where(~bare).join(lost(fwd, "less_in"), "id", "left")
                         .join(lost(bwd, "less_out"), "id", "left")
                         .select("id", (F.col("n_out") - F.coalesce("less_out", F.lit(0))).alias("n_out"),
                                 (F.col("n_in") - F.coalesce("less_in", F.lit(0))).alias("n_in")))
        active = state.select("id")
        if active.isEmpty():
            if own:
                fwd.release()
                bwd.release()
            break
        # a graph of many edges a vertex mostly has one component of most vertices: a sweep each way
        # from a vertex of many edges finds it, where colouring would send along its edges every round
        n_active, n_edges, start = state.agg(
            F.count(F.lit(1)), F.sum("n_out"), F.max_by("id", F.struct(F.least("n_out", "n_in"), "id"))).first()
        if not swept and n_edges >= DENSE * n_active:
            mark = _around(active, start, fwd, bwd, checkpoint_every)
        else:
            mark = _coloured(active, fwd, bwd, checkpoint_every)
        swept = True
        if own:
            fwd.release()
            bwd.release()
        # component id = smallest vertex id of the component (partial aggregation per root)
        members = mark.where("k").select("id", "c")
        smallest = members.groupBy("c").agg(F.min("id").alias("componentId"))
        found.append(_cut(members.join(smallest, "c").select("id", "componentId")))
        rest = mark.where(~F.col("k")).select("id", "c")
        n_rest = rest.count()
        if n_rest == 0:
            break
        active = _cut(rest.select("id").repartition(tasks_for(spark, n_rest), "id"))
        edges = _cut(edges.join(rest.select(F.col("id").alias("src"), F.col("c").alias("cs")), "src")
                     .join(rest.select(F.col("id").alias("dst"), F.col("c").alias("cd")), "dst")
                     .where(F.col("cs") == F.col("cd")).select("src", "dst"))
    if not found:  # no vertices at all
        return proj.vertices.select("id", "label", "key", F.col("id").alias("componentId"))
    comps = found[0]
    for f in found[1:]:
        comps = comps.unionByName(f)
    return comps.join(proj.vertices, "id").select("id", "label", "key", "componentId")
