"""The graph of strongly connected components, and its topological levels.

Components are the vertices of an acyclic graph; an edge joins two components if
any of their vertices are joined.  A component's level is the length of the longest
path that ends there, found by peeling: components without open in-edges leave
together, and their messages lower the counters of their successors.  A round
shuffles vertex-sized rows only (edges stay bucketed, hot sources split); there are
as many rounds as levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .graph_algorithms import EdgeSet, Materializer, Projection, _cut

#: Finished levels are put together after so many rounds, so that plans stay small.
FOLD = 20


def condense(proj: Projection, components: DataFrame, hot_edges: int | None = None) -> Projection:
    """Components (id, componentId) of a projection as a projection: id, label, key (its number of vertices)."""
    checkpoint_dir(proj.vertices.sparkSession)
    of = components.select("id", F.col("componentId").alias("c"))
    by_source = EdgeSet(proj.edges.distinct(), hot_edges)
    # (target, component of the source): edges of one component to one vertex are one row from here on
    half = by_source.messages(of, ["c"]).select(F.col("dst").alias("src"), F.col("c").alias("dst")).distinct()
    by_target = EdgeSet(half, hot_edges)
    edges = _cut(by_target.messages(of, ["c"]).select(F.col("dst").alias("src"), F.col("c").alias("dst"))
                 .where("src <> dst").distinct())
    by_source.release()
    by_target.release()
    vertices = components.groupBy(F.col("componentId").alias("id")).agg(F.count(F.lit(1)).alias("key")).select(
        "id", F.lit("Component").alias("label"), "key")
    return Projection(vertices, edges)


def topological_levels(dag: Projection, hot_edges: int | None = None) -> DataFrame:
    """(id, level): longest path to each vertex of an acyclic projection; a cycle raises."""
    checkpoint_dir(dag.vertices.sparkSession)
    es = EdgeSet(dag.edges.distinct(), hot_edges)
    open_in = es.edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_in"))
    # the levels since the last fold are read from the rounds that found them
    rounds, folds = Materializer(keep=FOLD), Materializer(keep=1)
    state = rounds(dag.vertices.select("id").join(open_in, "id", "left")
                   .select("id", F.coalesce("n_in", F.lit(0)).alias("n_in")))
    done, level = None, 0
    while True:
        ready = state.where("n_in <= 0").select("id")
        if ready.isEmpty():
            break
        own = ready.withColumn("level", F.lit(level).cast("bigint"))
        done = own if done is None else done.unionByName(own)
        if level % FOLD == FOLD - 1:
            done = folds(done)
        less = es.messages(ready, []).groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("less"))
        state = rounds(state.where("n_in > 0").join(less, "id", "left")
                       .select("id", (F.col("n_in") - F.coalesce("less", F.lit(0))).alias("n_in")))
        level += 1
    cyclic = not state.isEmpty()
    if done is not None and not cyclic:
        done = folds(done)  # stays: the caller reads it
    rounds.close()
    es.release()
    if cyclic:
        raise ValueError("the projection has a cycle: condense it first")
    return done if done is not None else dag.vertices.select("id", F.lit(0).cast("bigint").alias("level")).limit(0)
