"""The graph-algorithm procedures of the reference: projection counts,
PageRank stream + top 10, SCC stream + top 10, on the WROTE and CITES graphs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph import Graph
from ..operators.graph_algorithms import Projection, project, strongly_connected_components


def wrote_projection(g: Graph, orientation: str = "natural") -> Projection:
    """Labels {Paper, Author}, relationship WROTE (Author -> Paper)."""
    return project(
        {"Paper": g.paper.select("paperId"), "Author": g.author.select("authorId")},
        [("Author", "Paper", g.wrote.select("authorId", "paperId"))],
        orientation)


def cites_projection(g: Graph) -> Projection:
    """Label Paper, relationship CITES (citing -> cited)."""
    return project({"Paper": g.paper.select("paperId")},
                   [("Paper", "Paper", g.cites.select("src", "dst"))])


def node_lookup(df: DataFrame) -> DataFrame:
    """asNode(id).paperId: the key for Paper vertices, null for other labels."""
    return df.withColumn("paperId", F.when(F.col("label") == "Paper", F.col("key")))


def top10(df: DataFrame, score: str, n: int = 10) -> DataFrame:
    return df.orderBy(F.desc(score), F.asc("label"), F.asc("key")).limit(n)


def scc_with_component_keys(proj: Projection) -> DataFrame:
    """SCC rows (label, key, componentLabel, componentKey) for every vertex.

    A component is named by its smallest (key, label) member, which does not
    depend on how internal vertex ids were assigned (string keys get
    arbitrary ids).  One aggregate per component, then a join back.
    """
    comps = strongly_connected_components(proj)
    names = (comps.groupBy("componentId")
             .agg(F.min(F.struct("key", "label")).alias("_m"))
             .select("componentId", F.col("_m.label").alias("componentLabel"),
                     F.col("_m.key").alias("componentKey")))
    return comps.join(names, "componentId").select("label", "key", "componentLabel",
                                                   "componentKey")


def reach_within(edges: DataFrame, sources: DataFrame, k: int,
                 direction: str = "backward") -> DataFrame:
    """(source, paperId, hops): papers within ``k`` hops of each source paper.

    A breadth-first expansion with one join and one de-duplication per
    level; each (source, paper) pair is kept once, at its smallest hop count.
    ``backward`` follows edges against their direction (who cites the source,
    directly or through others); ``forward`` follows them (what the source
    cites).  Work is proportional to the size of the reached sets, so callers
    pass a bounded source set (e.g. a top-k list).
    """
    if direction == "backward":
        step = edges.select(F.col("dst").alias("frm"), F.col("src").alias("to"))
    elif direction == "forward":
        step = edges.select(F.col("src").alias("frm"), F.col("dst").alias("to"))
    else:
        raise ValueError(direction)
    # the source list is read twice (frontier and seen set): compute it once
    frontier = sources.select(F.col(sources.columns[0]).alias("source"),
                              F.col(sources.columns[0]).alias("frm")).checkpoint(eager=True)
    seen = frontier.select("source", F.col("frm").alias("paperId"), F.lit(0).alias("hops"))
    for h in range(1, k + 1):
        nxt = (frontier.join(step, "frm").select("source", F.col("to").alias("paperId"))
               .distinct()
               .join(seen.select("source", "paperId"), ["source", "paperId"], "left_anti"))
        nxt = nxt.checkpoint(eager=True)
        seen = seen.unionByName(nxt.withColumn("hops", F.lit(h)))
        frontier = nxt.select("source", F.col("paperId").alias("frm"))
    return seen.where(F.col("hops") > 0).withColumn("hops", F.col("hops").cast("bigint"))
