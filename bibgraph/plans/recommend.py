"""Reviewer recommender for a research community.

community keywords -> community venues (share of community papers) ->
top papers cited from inside the community -> potential reviewers -> gurus.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..graph import Graph

COMMUNITY_KINDS = ("Journal", "Conference")


def community_keywords(g: Graph, terms: Iterable[str], community: str = "database") -> DataFrame:
    """BELONGS_TO edges (keyword, community) for keyword nodes in ``terms``."""
    terms = list(terms)
    return (g.keyword.where(F.col("text").isin(*terms))
            .select(F.col("text").alias("keyword"), F.lit(community).alias("community")))


def community_papers(g: Graph, terms: Iterable[str]) -> DataFrame:
    """Distinct papers that contain at least one community keyword."""
    terms = list(terms)
    # isin() over a fixed, short term list is a filter, not a join.
    return (g.contains.where(F.col("keyword").isin(*terms))
            .select("paperId").distinct())


def community_venues(g: Graph, terms: Iterable[str], threshold: float = 0.9,
                     community: str = "database", kinds=COMMUNITY_KINDS,
                     literal_denominator: bool = False) -> DataFrame:
    """RELATED_TO edges: venues where >= ``threshold`` of the papers are community papers.

    One pass: a conditional distinct count over the venue's papers replaces
    the original self-join.  ``literal_denominator`` reproduces the unparenthesised
    ``A OR B AND c`` of the original query: the denominator then counts all
    journal papers plus the venue's own conference papers.
    """
    comm = community_papers(g, terms).withColumn("is_comm", F.lit(True))
    pub = (g.published_in.where(F.col("kind").isin(*kinds))
           .select("kind", "name", "paperId").distinct()
           .join(comm, "paperId", "left"))
    per_venue = pub.groupBy("kind", "name").agg(
        F.count(F.when(F.col("is_comm"), F.lit(1))).alias("num_comm_papers"),
        F.count(F.lit(1)).alias("num_papers"))
    per_venue = per_venue.where(F.col("num_comm_papers") > 0)
    if literal_denominator:
        # one number: the count of all journal papers (a scalar, not a join)
        nj = (g.published_in.where(F.col("kind") == "Journal")
              .select("paperId").distinct().count())
        per_venue = per_venue.withColumn(
            "num_papers",
            F.when(F.col("kind") == "Journal", F.lit(nj))
            .otherwise(F.lit(nj) + F.col("num_papers")))
    share = F.col("num_comm_papers").cast("double") / F.col("num_papers")
    return (per_venue.withColumn("share", share)
            .where(F.col("share") >= threshold)
            .withColumn("community", F.lit(community)))


def community_venue_papers(g: Graph, venues: DataFrame) -> DataFrame:
    return (g.published_in.join(venues.select("kind", "name"), ["kind", "name"], "left_semi")
            .select("paperId").distinct())


def top_community_papers(g: Graph, venues: DataFrame, limit: int = 100) -> DataFrame:
    """(paperId, n_citations): papers of community venues most cited by papers of
    community venues; ties broken by paperId."""
    cvp = community_venue_papers(g, venues)
    # counted per cited paper before the second semi-join: a hot target is one row there
    counted = (g.cites.join(cvp.withColumnRenamed("paperId", "src"), "src", "left_semi")
               .groupBy(F.col("dst").alias("paperId")).agg(F.count(F.lit(1)).alias("n_citations"))
               .join(cvp, "paperId", "left_semi"))
    return counted.orderBy(F.desc("n_citations"), F.asc("paperId")).limit(limit)


def potential_reviewers(g: Graph, top_papers: DataFrame, community: str = "database") -> DataFrame:
    """POT_REVIEWER edges: distinct authors of top papers."""
    return (g.wrote.join(top_papers.select("paperId"), "paperId", "left_semi")
            .select("authorId").distinct()
            .withColumn("community", F.lit(community)))


def gurus(g: Graph, top_papers: DataFrame, min_papers: int = 2,
          community: str = "database") -> DataFrame:
    """IS_GURU edges: authors of at least ``min_papers`` top papers."""
    return (g.wrote.join(top_papers.select("paperId"), "paperId", "left_semi")
            .groupBy("authorId").agg(F.count(F.lit(1)).alias("n_top_papers"))
            .where(F.col("n_top_papers") >= min_papers)
            .withColumn("community", F.lit(community)))
