"""PageRank after a MERGE: residuals are pushed from the changed vertices only.

Scores of the graph before satisfy ``r = (1-d) + d * sum(r(u) / outdeg(u))``.  Adding
or removing edges changes the right-hand side only at targets of the sources whose
edge lists changed; the differences there are residuals.  A round adds every residual
above ``tol`` to its vertex and sends the damped share of it along the out-edges;
smaller residuals wait where they are and grow or fade with what arrives.  The state
holds touched vertices only, edges stay bucketed with hot sources split, so a round
moves rows of active vertices and their messages, not the graph.

Each residual left at the end is at most ``tol``, so the scores are within
``d * tol * touched / (1 - d)`` of the exact ones, summed over all vertices (beside
what the scores given were off by).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .graph_algorithms import EdgeSet, Materializer, NamedProjection, Projection


@dataclass(frozen=True)
class RankUpdate:
    """scores (id, label, key, score), and what they cost: rounds, and messages sent along edges."""
    scores: DataFrame
    rounds: int
    messages: int


def _first_residuals(scores: DataFrame, es: EdgeSet, added: EdgeSet, removed: EdgeSet,
                     damping: float) -> tuple[DataFrame, int]:
    """(id, res) at the targets of changed sources, and the number of edges read for it."""
    of = lambda e, name: e.fanout.select("id", F.col("outdeg").alias(name))
    changed = (of(added, "plus").join(of(removed, "minus"), "id", "full")
               .join(es.fanout, "id", "left").join(scores, "id", "left")
               .select("id", F.coalesce("score", F.lit(1.0 - damping)).alias("rank"),
                       F.coalesce("outdeg", F.lit(0)).alias("now"),
                       (F.coalesce("outdeg", F.lit(0)) - F.coalesce("plus", F.lit(0))
                        + F.coalesce("minus", F.lit(0))).alias("was"), "plus", "minus"))
    stale = F.when(F.col("was") > 0, F.col("rank") / F.col("was")).otherwise(F.lit(0.0))
    changed = changed.withColumn("stale", stale).checkpoint(eager=True)
    sent = changed.agg(F.sum("now"), F.sum("plus"), F.sum("minus")).first()
    # every edge of today: its new share less the old one; an edge that is new had no old share
    parts = [es.messages(changed.where("now > 0").select("id", (F.col("rank") / F.col("now") - F.col("stale"))
                                                         .alias("w")), ["w"]),
             added.messages(changed.select("id", F.col("stale").alias("w")), ["w"]),
             removed.messages(changed.select("id", (-F.col("stale")).alias("w")), ["w"])]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return (rows.groupBy(F.col("dst").alias("id")).agg((F.lit(damping) * F.sum("w")).alias("res")),
            sum(n or 0 for n in sent))


def update_pagerank(scores: DataFrame, after: Projection, added: DataFrame, removed: DataFrame | None = None,
                    damping: float = 0.85, tol: float = 1e-9, checkpoint_every: int = 5,
                    hot_edges: int | None = None) -> RankUpdate:
    """Scores of ``after`` from converged ``scores`` (id, score) of the graph without the change.

    added, removed: (src, dst), edges of ``after`` that are new and edges that are gone.  A vertex
    without a score is new and starts at ``1 - d``; a vertex that is gone takes its edges with it,
    so they must be among ``removed``.
    """
    spark = after.vertices.sparkSession
    checkpoint_dir(spark)
    named = isinstance(after, NamedProjection)
    es = after.forward if named else EdgeSet(after.edges.distinct(), hot_edges)
    plus = EdgeSet(added.select("src", "dst").distinct(), hot_edges)
    minus = EdgeSet((removed if removed is not None else added.limit(0)).select("src", "dst").distinct(), hot_edges)
    scores = scores.select("id", "score")
    res, messages = _first_residuals(scores, es, plus, minus, damping)
    mat, rounds = Materializer(checkpoint_every), 0
    degrees = es.fanout.select("id", "s", "outdeg")
    state = res.select("id", F.lit(0.0).alias("gain"), "res").join(degrees, "id", "left").checkpoint(eager=True)
    active = F.abs("res") > tol
    while True:
        n, out = state.agg(F.count_if(active), F.sum(F.when(active, F.col("outdeg")))).first()
        if not n:
            break
        rounds, messages = rounds + 1, messages + (out or 0)
        pushed = es.messages(state.where(active & F.col("s").isNotNull()).select(
            "id", "s", (F.lit(damping) * F.col("res") / F.col("outdeg")).alias("w")), ["w"])
        rest = state.select("id", F.when(active, F.col("gain") + F.col("res")).otherwise(F.col("gain")).alias("gain"),
                            F.when(active, F.lit(0.0)).otherwise(F.col("res")).alias("res"))
        come = pushed.groupBy(F.col("dst").alias("id")).agg(F.lit(0.0).alias("gain"), F.sum("w").alias("res"))
        state = mat(rest.unionByName(come).groupBy("id").agg(F.sum("gain").alias("gain"), F.sum("res").alias("res"))
                    .join(degrees, "id", "left"))
    moved = state.select("id", (F.col("gain") + F.col("res")).alias("moved")).checkpoint(eager=True)
    mat.close()
    for e in (plus, minus) if named else (plus, minus, es):
        e.release()
    out = after.vertices.join(scores, "id", "left").join(moved, "id", "left").select(
        "id", "label", "key", (F.coalesce("score", F.lit(1.0 - damping)) + F.coalesce("moved", F.lit(0.0)))
        .alias("score"))
    return RankUpdate(out, rounds, messages)
