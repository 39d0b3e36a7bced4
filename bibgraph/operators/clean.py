"""Cleaning and enrichment of fetched paper records (the ETL layer).

Each step is a DataFrame -> DataFrame function meant for ``DataFrame.transform``;
list-valued columns stay ``array`` until a CSV edge.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import extract_edition as _edition_of
from ..functions.columns import parse_list_literal
from .upsert import dedupe_keep_first

# The publication types kept after categorisation.
ALLOWED_TYPES = ("['JournalArticle']", "['Conference']", "['Workshop']")


def dedupe_papers(papers: DataFrame, order: tuple[str, ...] = ("field_query",)) -> DataFrame:
    """One row per paperId: a paper fetched under several search terms keeps its
    first row in ``order`` (rows without an id go)."""
    return dedupe_keep_first(papers.where(F.col("paperId").isNotNull()), ["paperId"], list(order))


def attach_keywords_citations(papers: DataFrame, keywords: DataFrame, citations: DataFrame) -> DataFrame:
    """Inner joins of keywords(paperId, keywords) and citations(paperId, Citations), both lists
    as literal text; the field term joins the keywords, lower case; of repeated citation
    rows of a paper the smallest text stays."""
    kws = keywords.select("paperId", parse_list_literal("keywords").alias("keywords"))
    cites = citations.groupBy("paperId").agg(F.min("Citations").alias("_c")).select(
        "paperId", F.array_join(parse_list_literal("_c"), ", ").alias("Citations"))
    return finalize_keywords(papers.join(kws, "paperId")).join(cites, "paperId")


def clean_papers(papers: DataFrame) -> DataFrame:
    """Fix the ' Big Data' field term, drop rows without venue, type or abstract,
    drop the pages column.  (A missing journal volume is handled after
    categorisation, when only journals still need one.)"""
    fixed = papers.withColumn(
        "field_query",
        F.when(F.col("field_query") == " Big Data", F.lit("Big Data"))
        .otherwise(F.col("field_query")))
    return (fixed.dropna(subset=["venue", "publicationTypes", "abstract"])
            .drop("journal_pages"))


def categorize_publication(papers: DataFrame) -> DataFrame:
    """Workshop if the venue mentions one; Conference if the type list does
    (tested after the workshop rewrite); keep the three known types; strip
    the list brackets; blank the volume of conferences and workshops; then
    drop rows that still have no volume (journals without one)."""
    t = F.col("publicationTypes")
    t1 = F.when(F.coalesce(F.col("venue"), F.lit("")).contains("Workshop"),
                F.lit("['Workshop']")).otherwise(t)
    t2 = F.when(F.coalesce(t1, F.lit("")).contains("Conference"), F.lit("['Conference']")) \
        .otherwise(t1)
    out = papers.withColumn("publicationTypes", t2).where(F.col("publicationTypes").isin(
        *ALLOWED_TYPES))
    stripped = F.expr("substring(publicationTypes, 3, length(publicationTypes) - 4)")
    out = out.withColumn("publicationTypes", stripped)
    out = out.withColumn(
        "journal_volume",
        F.when(F.col("publicationTypes").isin("Workshop", "Conference"), F.lit(""))
        .otherwise(F.col("journal_volume")))
    return out.dropna(subset=["journal_volume"])


def aggregate_paper_authors(papers: DataFrame, authors: DataFrame) -> DataFrame:
    """Papers that have at least one non-null author, with ``n_authors``,
    ``corresponding_author`` (first in file order) and ``last_author``.

    Only fixed-size aggregates (count, min_by, max_by) are kept per paper, so
    partial aggregation bounds the state of a paper with any number of
    authors; the list itself is built only at the CSV edge
    (``author_id_lists``).
    """
    stats = (authors.where(F.col("authorId").isNotNull())
             .groupBy("paperId")
             .agg(F.count(F.lit(1)).alias("n_authors"),
                  F.min_by("authorId", "position").alias("corresponding_author"),
                  F.max_by("authorId", "position").alias("last_author")))
    return papers.join(stats, "paperId")


def author_id_lists(authors: DataFrame) -> DataFrame:
    """(paperId, authorIds): the ordered id list of the load-file format
    (``groupby(paperId)[authorId].agg(list)`` in file order).  collect order
    is not defined after a shuffle, so (position, id) structs are sorted."""
    return (authors.where(F.col("authorId").isNotNull())
            .groupBy("paperId")
            .agg(F.sort_array(F.collect_list(F.struct("position", "authorId"))).alias("_a"))
            .select("paperId", F.col("_a.authorId").alias("authorIds")))


def corresponding_author(papers: DataFrame) -> DataFrame:
    """The first listed author is the corresponding author (list input)."""
    return papers.withColumn("corresponding_author", F.element_at("authorIds", 1))


def venue_names(papers: DataFrame) -> DataFrame:
    """proceedings = venue for conferences/workshops; journal = venue for journal articles."""
    return (papers
            .withColumn("proceedings",
                        F.when(F.col("publicationTypes").isin("Conference", "Workshop"),
                               F.col("venue")))
            .withColumn("journal",
                        F.when(F.col("publicationTypes") == "JournalArticle", F.col("venue"))))


def extract_edition(papers: DataFrame, literal: bool = False) -> DataFrame:
    """edition = number before st/nd/rd/th in the proceedings, else in the
    journal name, else (for proceedings only) the last two digits of the year.

    ``literal=True`` reproduces the original, whose second assignment throws
    the proceedings-derived value away.
    """
    from_proc = _edition_of("proceedings")
    from_journal = _edition_of("journal_name")
    first = from_journal if literal else F.coalesce(from_proc, from_journal)
    year2 = F.substring(F.col("year").cast("string"), -2, 2)
    return papers.withColumn(
        "edition",
        F.when(F.col("proceedings").isNotNull() & first.isNull(), year2).otherwise(first))


def finalize_keywords(papers: DataFrame) -> DataFrame:
    """Append the field term to the keyword list and lower-case every item."""
    return papers.withColumn(
        "keywords",
        F.transform(F.array_append("keywords", F.col("field_query")), lambda x: F.lower(x)))


def list_columns_to_strings(papers: DataFrame) -> DataFrame:
    """The load-file text form of list columns."""
    out = papers
    seps = {"authorIds": ", ", "reviewers": ", ", "comments": ";", "keywords": ",",
            "Citations": ", "}
    for c, sep in seps.items():
        if c in papers.columns:
            out = out.withColumn(c, F.array_join(F.col(c).cast("array<string>"), sep))
    return out


def parse_list_literals(df: DataFrame, *cols: str) -> DataFrame:
    """Python list literals in text columns to arrays (``ast.literal_eval`` for lists of text)."""
    out = df
    for c in cols:
        out = out.withColumn(c, parse_list_literal(c))
    return out


def split_by_type(papers: DataFrame) -> dict[str, DataFrame]:
    """Three tables by publication type; edition cast to integer for
    conferences and workshops, dropped for journals."""
    conf = (papers.where(F.col("publicationTypes") == "Conference")
            .drop("field_query", "journal_volume", "journal_name")
            .withColumn("edition", F.col("edition").try_cast("bigint")))
    work = (papers.where(F.col("publicationTypes") == "Workshop")
            .drop("field_query", "journal_volume", "journal_name")
            .withColumn("edition", F.col("edition").try_cast("bigint")))
    jour = (papers.where(F.col("publicationTypes") == "JournalArticle")
            .drop("field_query", "proceedings", "edition"))
    return {"Conference": conf, "Workshop": work, "JournalArticle": jour}


def clone_previous_edition(conferences: DataFrame, generations: int = 1) -> DataFrame:
    """Append copies one edition (and one year) earlier with ``a`` appended to
    the id, ``generations`` times."""
    out = conferences
    cur = conferences
    for _ in range(generations):
        cur = (cur.withColumn("edition", F.col("edition") - 1)
               .withColumn("year", F.col("year") - 1)
               .withColumn("paperId", F.concat(F.col("paperId"), F.lit("a"))))
        out = out.unionByName(cur)
    return out
