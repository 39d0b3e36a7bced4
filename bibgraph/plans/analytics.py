"""Bibliometric questions on the graph: top cited papers per conference,
conference communities, journal impact factor, author h-index.

Every count is pre-aggregated on its key before it meets another table, so a
paper cited by a third of all citations becomes one row before any join, and
partial (map-side) aggregation absorbs hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..graph import Graph


def citation_counts(cites: DataFrame) -> DataFrame:
    """(paperId, n_cited): number of distinct citing papers (CITES is one edge per pair)."""
    return cites.groupBy(F.col("dst").alias("paperId")).agg(F.count(F.lit(1)).alias("n_cited"))


def top_cited_per_venue(g: Graph, kind: str = "Conference", k: int = 3) -> DataFrame:
    """Top-k most cited papers of each venue of ``kind`` as rows (venue, rank, paperId, n)."""
    pub = g.published_in.where(F.col("kind") == kind).select("paperId", "name")
    counted = citation_counts(g.cites).join(pub, "paperId")
    w = Window.partitionBy("name").orderBy(F.desc("n_cited"), F.asc("paperId"))
    # row_number() <= k plans a partial WindowGroupLimit before the shuffle,
    # so a venue holding most of the papers still ships only k rows per task.
    return (counted.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k))


def top3_cited_per_conference(g: Graph, k: int = 3) -> DataFrame:
    """conference, topCitedPaper1..k: titles of the k most cited papers.

    A conference with fewer than k cited papers is dropped, and so is one
    where any of the k titles is 'None' or null (three-valued NONE()).
    """
    top = top_cited_per_venue(g, "Conference", k).join(
        g.paper.select("paperId", "title"), "paperId", "left")
    cols = [F.max(F.when(F.col("rank") == i, F.col("title"))).alias(f"topCitedPaper{i}")
            for i in range(1, k + 1)]
    out = top.groupBy(F.col("name").alias("conference")).agg(
        F.count(F.lit(1)).alias("_n"), *cols)
    any_none = None
    for i in range(1, k + 1):
        c = F.col(f"topCitedPaper{i}") == F.lit("None")
        any_none = c if any_none is None else (any_none | c)
    return out.where((F.col("_n") == k) & ~any_none).drop("_n")


def conference_communities(g: Graph, min_editions: int = 4) -> DataFrame:
    """(conferenceName, authorId, name): authors with papers in >= n distinct editions.

    The community is emitted one member per row; a list column would put a
    whole (possibly huge) community through one task.
    """
    pub = g.published_in.where(F.col("kind") == "Conference").select(
        F.col("paperId"), F.col("name").alias("conferenceName"), F.col("edition"))
    members = (g.wrote.select("authorId", "paperId").join(pub, "paperId")
               .select("conferenceName", "authorId", "edition").distinct()
               .groupBy("conferenceName", "authorId")
               .agg(F.count("edition").alias("distinctEditions"))
               .where(F.col("distinctEditions") >= min_editions))
    return members.join(g.author.select("authorId", "name"), "authorId").select(
        "conferenceName", "authorId", "name", "distinctEditions")


def conference_community_sizes(g: Graph, min_editions: int = 4) -> DataFrame:
    """(conferenceName, community_size) for every conference with a community."""
    return (conference_communities(g, min_editions)
            .groupBy("conferenceName").agg(F.count(F.lit(1)).alias("community_size")))


def journal_impact_factor(g: Graph, year: int = 2023, citing_kinds=("Journal",),
                          keep_zero: bool = False) -> DataFrame:
    """journalName, num_citations, num_papers, impact_factor, impact_factor_int.

    Citations made in ``year`` by papers published in any venue of
    ``citing_kinds`` to the papers the journal published in the two prior
    years, divided by the number of those papers.  ``impact_factor_int`` is
    the integer division of the original query.
    """
    pub = g.published_in
    recent = (pub.where((F.col("kind") == "Journal")
                        & F.col("year").isin(year - 1, year - 2))
              .select(F.col("name").alias("journalName"), "paperId"))
    n_papers = recent.groupBy("journalName").agg(F.count(F.lit(1)).alias("num_papers"))
    # How many qualifying PUBLISHED_IN edges each citing paper has (normally 1).
    citing = (pub.where(F.col("kind").isin(*citing_kinds) & (F.col("year") == year))
              .groupBy(F.col("paperId").alias("src")).agg(F.count(F.lit(1)).alias("m")))
    cited = (g.cites.join(citing, "src")
             .groupBy(F.col("dst").alias("paperId")).agg(F.sum("m").alias("c")))
    n_cit = (recent.join(cited, "paperId").groupBy("journalName")
             .agg(F.sum("c").cast("bigint").alias("num_citations")))
    how = "left" if keep_zero else "inner"
    out = n_papers.join(n_cit, "journalName", how).fillna(0, ["num_citations"])
    return out.select(
        "journalName", "num_citations", "num_papers",
        (F.col("num_citations") / F.col("num_papers")).alias("impact_factor"),
        F.expr("num_citations div num_papers").alias("impact_factor_int"))


def author_h_index(g: Graph, by_name: bool = False, keep_zero: bool = False) -> DataFrame:
    """(authorId, name, h_index).

    h = max over distinct citation counts n of min(n, #papers with >= n
    citations).  Papers are first folded into (author, n, count) rows, so the
    per-author window runs over distinct counts, not over all papers.
    """
    counts = g.wrote.select("authorId", "paperId").join(citation_counts(g.cites), "paperId")
    if by_name:
        counts = counts.join(g.author.select("authorId", "name"), "authorId").select(
            F.col("name").alias("authorKey"), "paperId", "n_cited").distinct()
    else:
        counts = counts.withColumnRenamed("authorId", "authorKey")
    folded = counts.groupBy("authorKey", "n_cited").agg(F.count(F.lit(1)).alias("c"))
    w = (Window.partitionBy("authorKey").orderBy(F.desc("n_cited"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = (folded.withColumn("ge", F.sum("c").over(w))
         .groupBy("authorKey")
         .agg(F.max(F.least(F.col("n_cited"), F.col("ge"))).cast("bigint").alias("h_index")))
    if by_name:
        return h.select(F.col("authorKey").alias("name"), "h_index")
    authors = g.author.select("authorId", "name")
    if keep_zero:
        return (authors.join(h.withColumnRenamed("authorKey", "authorId"), "authorId", "left")
                .fillna(0, ["h_index"]))
    return h.withColumnRenamed("authorKey", "authorId").join(authors, "authorId", "left") \
        .select("authorId", "name", "h_index")
