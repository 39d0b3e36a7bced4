"""How many vertices every vertex reaches, by distinct-count sketches spread along the edges.

Each vertex starts with a sketch of itself.  In a round, vertices whose sketch changed
send it to their neighbours, which merge what arrives (sketches merge without counting
twice); after h rounds a sketch stands for everything within h hops, and when no
estimate moves any more for all that can be reached.  State is one sketch of at most
2^lg_k bytes a vertex, whatever the number of vertices reached, where an exact closure
grows as degree^h.  Messages are merged on the map side before the shuffle.

The relative standard error is ``relative_error(lg_k)``; small counts are exact up to
hash collisions.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .graph_algorithms import EdgeSet, Materializer, NamedProjection, Projection


def relative_error(lg_k: int) -> float:
    """Standard error of an estimate, as a share of the count."""
    return 1.04 / math.sqrt(1 << lg_k)


def reach_estimates(proj: Projection, hops: int | None = None, direction: str = "forward", lg_k: int = 12,
                    checkpoint_every: int = 5, hot_edges: int | None = None) -> DataFrame:
    """(id, n_reached): other vertices within ``hops`` of each vertex (any number of hops if None).

    ``forward`` counts what a vertex leads to, ``backward`` what leads to it.  A vertex without
    such edges has 0; a vertex on a cycle does not count itself.
    """
    if direction not in ("forward", "backward"):
        raise ValueError(direction)
    checkpoint_dir(proj.vertices.sparkSession)
    named = isinstance(proj, NamedProjection)
    if named:
        es = proj.backward if direction == "forward" else proj.forward
    else:
        edges = proj.edges.distinct()
        es = EdgeSet(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
                     if direction == "forward" else edges, hot_edges)
    mat, done = Materializer(checkpoint_every), 0
    state = mat(proj.vertices.groupBy("id").agg(F.hll_sketch_agg("id", F.lit(lg_k)).alias("sketch"))
                .select("id", "sketch", F.lit(1).cast("bigint").alias("n"), F.lit(True).alias("moved")),
                force_checkpoint=True)
    while hops is None or done < hops:
        come = es.messages(state.where("moved").select("id", "sketch"), ["sketch"]).groupBy(
            F.col("dst").alias("id")).agg(F.hll_union_agg("sketch").alias("come"))
        joined = state.drop("moved").join(come, "id", "left").select(
            "id", "n", F.when(F.col("come").isNull(), F.col("sketch"))
            .otherwise(F.hll_union("sketch", "come")).alias("sketch"))
        state = mat(joined.select("id", "sketch", F.hll_sketch_estimate("sketch").alias("m"), "n")
                    .select("id", "sketch", F.col("m").alias("n"), (F.col("m") != F.col("n")).alias("moved")))
        done += 1
        if state.where("moved").isEmpty():
            break
    out = state.select("id", (F.col("n") - 1).alias("n_reached")).checkpoint(eager=True)
    mat.close()
    if not named:
        es.release()
    return out
