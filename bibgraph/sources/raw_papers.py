"""Raw API-shaped paper and author tables derived from the fixture tables.

Shapes follow the reference's fetched CSV files (every value as the API
returned it, lists as Python list literals).  Mirrored by ``bibgraph_oracle.RAW_CTES``.

raw_papers(paperId, field_query, title, url, venue, publicationTypes, abstract,
           year int, citationCount int, journal_name, journal_volume, journal_pages)
raw_authors(paperId, authorId (nullable bigint), name, position)
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import Tables

# Field terms by p_partkey % 4 (the first carries the stray
# leading space the cleaning step repairs).
RAW_FIELD_TERMS = (" Big Data", "Big Data", "Indexing", "NLP")


def raw_papers(t: Tables) -> DataFrame:
    p = t.part
    docs = t.documents.select("doc_id", "text")
    size = F.col("p_size")
    venue = (F.when(F.col("p_type") == "PROMO", F.concat(F.lit("Workshop on "), F.col("p_brand")))
             .when(F.col("p_type") == "ECONOMY", F.lit(None).cast("string"))
             .when(size % 4 == 0, F.concat(F.col("p_brand"), F.lit(" "), size.cast("string"),
                                          F.lit("th")))
             .otherwise(F.col("p_brand")))
    types = (F.when(F.col("p_type").isin("LARGE", "PROMO"), F.lit("['JournalArticle']"))
             .when(F.col("p_type") == "SMALL", F.lit("['JournalArticle', 'Conference']"))
             .when(F.col("p_type") == "MEDIUM", F.lit("['Conference']"))
             .when(F.col("p_type") == "STANDARD", F.lit("['Review']")))
    field = F.element_at(F.array(*[F.lit(x) for x in RAW_FIELD_TERMS]),
                         (F.col("p_partkey") % 4 + 1).cast("int"))
    return (p.join(docs, p.p_partkey == docs.doc_id, "left").select(
        F.col("p_partkey").cast("string").alias("paperId"),
        field.alias("field_query"),
        F.col("p_name").alias("title"),
        F.concat(F.lit("p/"), F.col("p_partkey").cast("string")).alias("url"),
        venue.alias("venue"),
        types.alias("publicationTypes"),
        F.col("text").alias("abstract"),
        (F.lit(2017) + size % 8).alias("year"),
        size.alias("citationCount"),
        F.when(size % 3 == 0, F.concat(F.lit("Proc. "), size.cast("string"), F.lit("th")))
        .alias("journal_name"),
        F.when(size % 7 != 0, size.cast("string")).alias("journal_volume"),
        F.concat(F.lit("1-"), size.cast("string")).alias("journal_pages")))


def raw_authors(t: Tables) -> DataFrame:
    """One row per (paper, author); authorId is missing for every 50th customer."""
    wrote = (t.lineitem.select("l_orderkey", "l_partkey")
             .join(t.orders.select("o_orderkey", "o_custkey"),
                   F.col("l_orderkey") == F.col("o_orderkey"))
             .select(F.col("l_partkey").cast("string").alias("paperId"),
                     F.col("o_custkey").alias("cust")).distinct())
    return (wrote.join(t.customer.select("c_custkey", "c_name"),
                       F.col("cust") == F.col("c_custkey"))
            .select("paperId",
                    F.when(F.col("cust") % 50 != 0, F.col("cust")).alias("authorId"),
                    F.col("c_name").alias("name"),
                    F.col("cust").alias("position")))
