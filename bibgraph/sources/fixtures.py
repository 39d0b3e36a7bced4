"""Map the driver's TPC-H-ish tables onto the bibliographic property graph.

Every definition here is mirrored word for word by the SQL views in
``bibgraph_oracle.py`` so that Spark and the DuckDB oracle derive the same graph.

* paper     = part (the abstract, documents.text, is a separate table)
* author    = customer join nation
* wrote     = distinct (o_custkey, l_partkey) of lineitem join orders
* cites     = every lineitem row cites the row before it in the same order, in
              (l_orderkey, l_linenumber, l_partkey, l_suppkey) order: at most
              one edge per row, and no row is left out.
* published_in / venue from p_type and p_brand
* contains  = words of p_name
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graph import Graph, Lazy
from ..operators.ranked import numbered, with_neighbours
from .tables import Tables

# Fixed values of the fixture mapping.
# The seven community terms stand for the reference's seven database keywords.
COMMUNITY_TERMS = ("anvil", "bolt", "gear", "gizmo", "plate", "ring", "rod")
NULL_TITLE_NAME = "blue anvil"
JOURNAL_TYPES = ("LARGE", "SMALL")
WORKSHOP_TYPES = ("ECONOMY", "PROMO")
CONFERENCE_TYPES = ("MEDIUM", "STANDARD")
FIRST_YEAR = 2017
YEAR_SPAN = 8
EDITION_SPAN = 20


def venue_kind(p_type: Column) -> Column:
    return (F.when(p_type.isin(*JOURNAL_TYPES), F.lit("Journal"))
            .when(p_type.isin(*WORKSHOP_TYPES), F.lit("Workshop"))
            .when(p_type.isin(*CONFERENCE_TYPES), F.lit("Conference")))


def venue_name(kind: Column, brand: Column) -> Column:
    prefix = (F.when(kind == "Journal", F.lit("J-"))
              .when(kind == "Workshop", F.lit("W-"))
              .otherwise(F.lit("C-")))
    return F.concat(prefix, brand)


def paper_year(p_size: Column) -> Column:
    return (F.lit(FIRST_YEAR) + p_size % YEAR_SPAN).cast("bigint")


def paper_nodes(t: Tables) -> DataFrame:
    """Paper nodes without the abstract: no graph query reads it, and Catalyst
    cannot drop an outer join by itself, so it is offered separately."""
    return t.part.select(F.col("p_partkey").alias("paperId"),
                         F.nullif(F.col("p_name"), F.lit(NULL_TITLE_NAME)).alias("title"),
                         paper_year(F.col("p_size")).alias("year"),
                         F.col("p_size").cast("bigint").alias("citationCount"))


def paper_abstracts(t: Tables) -> DataFrame:
    """(paperId, abstract): the document text of each paper that has one."""
    return t.documents.select(F.col("doc_id").alias("paperId"), F.col("text").alias("abstract"))


def author_nodes(t: Tables) -> DataFrame:
    # nation is 25 rows: Spark's size-checked broadcast picks it up by itself.
    return (t.customer.join(t.nation, t.customer.c_nationkey == t.nation.n_nationkey)
            .select(F.col("c_custkey").alias("authorId"),
                    F.col("c_name").alias("name"),
                    F.col("n_name").alias("affiliation"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("university"))
                    .otherwise(F.lit("company")).alias("affiliationType")))


def published_in_edges(t: Tables) -> DataFrame:
    kind = venue_kind(F.col("p_type"))
    return (t.part.select(
        F.col("p_partkey").alias("paperId"),
        kind.alias("kind"),
        venue_name(kind, F.col("p_brand")).alias("name"),
        paper_year(F.col("p_size")).alias("year"),
        F.when(kind != "Journal", (F.col("p_size") % EDITION_SPAN).cast("bigint"))
        .alias("edition"))
        .where(F.col("kind").isNotNull()))


def wrote_edges(t: Tables) -> DataFrame:
    return (t.lineitem.select("l_orderkey", "l_partkey")
            .join(t.orders.select("o_orderkey", "o_custkey"),
                  F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("authorId"), F.col("l_partkey").alias("paperId"))
            .distinct())


def lineitem_positions(t: Tables, neighbours: bool = True) -> DataFrame:
    """Every lineitem row: l_orderkey, l_linenumber, part, supp, row_no (dense, from 1) and, if asked for,
    the parts of the rows before and after it in the same order (null at an order's ends)."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("part"),
                             F.col("l_suppkey").alias("supp"))
    order = ["l_orderkey", "l_linenumber", "part", "supp"]
    if not neighbours:
        return numbered(rows, order, "row_no", first=1)
    placed = with_neighbours(rows, order, "row_no", first=1)
    near = lambda side: F.when(F.col(f"{side}.l_orderkey") == F.col("l_orderkey"),
                               F.col(f"{side}.part"))
    return placed.select("l_orderkey", "l_linenumber", "part", "supp", "row_no",
                         near("_prev").alias("prev_part"), near("_next").alias("next_part"))


def cites_edges(t: Tables) -> DataFrame:
    return (lineitem_positions(t)
            .where(F.col("prev_part").isNotNull() & (F.col("part") != F.col("prev_part")))
            .select(F.col("part").alias("src"), F.col("prev_part").alias("dst")).distinct())


def contains_edges(t: Tables) -> DataFrame:
    return (t.part.select(F.col("p_partkey").alias("paperId"),
                          F.explode(F.split(F.col("p_name"), " ")).alias("keyword"))
            .where(F.col("keyword") != "").distinct())


def graph_from_tables(spark: SparkSession, sf_dir: str) -> Graph:
    """The fixture graph; each table is built (and its parquet files read)
    only when a query touches it."""
    t = Tables(spark, sf_dir)
    memo: dict[str, DataFrame] = {}

    def once(name, fn):
        def build():
            if name not in memo:
                memo[name] = fn()
            return memo[name]
        return build

    pub = once("published_in", lambda: published_in_edges(t))
    contains = once("contains", lambda: contains_edges(t))
    return Graph(
        paper=Lazy(lambda: paper_nodes(t)),
        author=Lazy(lambda: author_nodes(t)),
        venue=Lazy(lambda: pub().select("kind", "name").distinct()),
        keyword=Lazy(lambda: contains().select(F.col("keyword").alias("text")).distinct()),
        wrote=Lazy(lambda: wrote_edges(t)),
        published_in=Lazy(pub),
        cites=Lazy(lambda: cites_edges(t)),
        contains=Lazy(contains),
    )
