"""Reference-shaped graph load files derived from the fixture tables.

The reference loads ``conference_info.csv``, ``journal_info.csv``,
``workshop_info.csv`` and ``authors_info.csv`` with every field a string and
lists held as delimited text.  Here one load row is one lineitem row, so a
paper appears in many rows (exercising first/last-writer MERGE rules), and
every list in a row is bounded (two authors, two reviewers, at most three
citations; the first line of an order also cites an external ``ext-<supp>``
id that has no Paper row, which makes stub papers).
Mirrored in SQL by ``bibgraph_oracle.LOAD_CTES``.

Columns of a paper load row (all strings unless noted):
  kind, row_no (bigint), paperId, title, url, abstract, year, citationCount,
  authorIds ("a, b"), corresponding_author, venue (a city), approved,
  reviewers ("a, b"), comments ("x;y"), proceedings, edition, journal_name,
  journal_volume, keywords ("w1,w2,field"), Citations ("a, b")
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranked import numbered
from ..session import remove, replaced, scratch_tables, spread, written
from .fixtures import (JOURNAL_TYPES, NULL_TITLE_NAME, lineitem_positions, paper_year,
                       venue_kind, venue_name)
from .tables import Tables

# The four field terms a paper was fetched with (by p_partkey % 4).
FIELD_TERMS = ("Big Data", "Indexing", "NLP", "Data Management")


def cities(t: Tables) -> tuple[DataFrame, int]:
    """(city_no, n_name): the nations numbered from 0 by key, and their number."""
    placed = numbered(t.nation.select("n_nationkey", "n_name"), ["n_nationkey"], "city_no")
    # a written table's size is known: load rows are not shuffled to meet a few cities
    return replaced(placed.select("city_no", "n_name"), "cities"), t.nation.count()


def with_abstracts(papers: DataFrame, t: Tables) -> DataFrame:
    """Fill ``abstract`` of rows that are one per paper: the text is joined after the
    winner of each paper is chosen, so no load row carries it."""
    docs = t.documents.select(F.col("doc_id").cast("string").alias("paperId"), F.col("text").alias("_text"))
    return (papers.join(docs, "paperId", "left")
            .withColumn("abstract", F.col("_text")).drop("_text").select(*papers.columns))


def paper_load_rows(t: Tables, abstracts: bool = False, citations: bool = True, cut: bool = False) -> DataFrame:
    """Load rows; ``abstract`` is null unless asked for (a paper has many rows), ``Citations`` if not.

    ``cut`` writes the lines with their orders, so that shuffles before and after are not on disk at once.
    """
    n_lines = t.lineitem.count()
    lines = spread(lineitem_positions(t, citations), n_lines, "l_orderkey")
    city, n_cities = cities(t)
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    placed = lines.join(t.orders.select("o_orderkey", "o_custkey"),
                        F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
    if cut:
        placed = replaced(placed, "lines")
    rows = (spread(placed, n_lines, "part")
            .join(part, F.col("part") == F.col("p_partkey"))
            .join(city, F.pmod(F.col("part") + F.col("l_orderkey"), F.lit(max(n_cities, 1)))
                  == F.col("city_no"), "left"))
    if abstracts:
        rows = rows.join(t.documents.select("doc_id", "text"), F.col("part") == F.col("doc_id"), "left")
    else:
        rows = rows.withColumn("text", F.lit(None).cast("string"))
    kind = venue_kind(F.col("p_type"))
    s = lambda c: F.col(c).cast("string")
    is_journal = F.col("p_type").isin(*JOURNAL_TYPES)
    field = F.element_at(F.array(*[F.lit(x) for x in FIELD_TERMS]),
                         (F.col("part") % len(FIELD_TERMS) + 1).cast("int"))
    vname = venue_name(kind, F.col("p_brand"))
    return rows.select(
        kind.alias("kind"),
        F.col("row_no"),
        s("part").alias("paperId"),
        F.nullif(F.col("p_name"), F.lit(NULL_TITLE_NAME)).alias("title"),
        F.concat(F.lit("p/"), s("part"), F.lit("/"), s("l_orderkey")).alias("url"),
        F.col("text").alias("abstract"),
        paper_year(F.col("p_size")).cast("string").alias("year"),
        s("p_size").alias("citationCount"),
        F.concat(s("o_custkey"), F.lit(", "), s("supp")).alias("authorIds"),
        s("o_custkey").alias("corresponding_author"),
        F.col("n_name").alias("venue"),
        F.lit("Y").alias("approved"),
        F.concat((F.col("supp") + 1).cast("string"), F.lit(", "),
                 (F.col("o_custkey") + 1).cast("string")).alias("reviewers"),
        F.concat(F.lit("review "), s("l_orderkey"), F.lit(";review "),
                 s("l_linenumber")).alias("comments"),
        F.when(~is_journal, vname).alias("proceedings"),
        F.when(~is_journal, (F.col("p_size") % 20).cast("string")).alias("edition"),
        F.when(is_journal, vname).alias("journal_name"),
        F.when(is_journal, s("p_size")).alias("journal_volume"),
        F.concat(F.regexp_replace(F.col("p_name"), " ", ","), F.lit(","),
                 F.lower(field)).alias("keywords"),
        (F.concat_ws(", ", s("prev_part"), s("next_part"),
                     F.when(F.col("l_linenumber") == 1, F.concat(F.lit("ext-"), s("supp"))))
         if citations else F.lit(None).cast("string")).alias("Citations"),
    ).where(F.col("kind").isNotNull())


def author_load_rows(t: Tables) -> DataFrame:
    """authors_info: customers, then suppliers (whose keys collide with customers)."""
    nat = t.nation.select("n_nationkey", "n_name")
    cust = (t.customer.join(nat, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.col("c_custkey").cast("string").alias("authorId"),
                    F.col("c_name").alias("name"),
                    F.col("n_name").alias("Affiliations"),
                    F.when(F.col("c_custkey") % 2 == 0, F.lit("university"))
                    .otherwise(F.lit("company")).alias("Affiliation_type"),
                    F.col("c_custkey").alias("row_no")))
    supp = (t.supplier.join(nat, F.col("s_nationkey") == F.col("n_nationkey"))
            .select(F.col("s_suppkey").cast("string").alias("authorId"),
                    F.col("s_name").alias("name"),
                    F.col("n_name").alias("Affiliations"),
                    F.lit("company").alias("Affiliation_type"),
                    (F.lit(1 << 40) + F.col("s_suppkey")).alias("row_no")))
    return cust.unionByName(supp).withColumn("file_no", F.lit(0))


# --- reading and writing reference-style load files -------------------------

# The load-file names of the reference, by publication kind.
LOAD_FILE_NAMES = {"Conference": "conference_info", "Journal": "journal_info",
                   "Workshop": "workshop_info"}
# Columns each kind's file does not carry (journal files have no proceedings
# or edition; conference and workshop files no journal name or volume).
DROPPED_BY_KIND = {"Journal": ("proceedings", "edition"),
                   "Conference": ("journal_name", "journal_volume"),
                   "Workshop": ("journal_name", "journal_volume")}


def write_load_files(rows: DataFrame, base: str, own: bool = False) -> dict[str, str]:
    """Write one folder of gzipped CSV files per kind (header, all text), like the reference's
    processing step; ``row_no`` is kept as an explicit order column.  ``own``: nobody else reads
    the rows, so the intermediate tables they were made of are removed."""
    from .csv_io import write_csv

    rows = (replaced if own else written)(rows, "load_rows")  # each kind reads them
    paths = {}
    for kind, stem in LOAD_FILE_NAMES.items():
        path = f"{base.rstrip('/')}/{stem}"
        part = rows.where(F.col("kind") == kind).drop("kind", *DROPPED_BY_KIND[kind])
        write_csv(part, path, packed=True)
        paths[kind] = path
    remove(rows.sparkSession, scratch_tables(rows))
    return paths


def read_load_files(spark, paths: dict[str, str], order_col: str = "row_no") -> DataFrame:
    """``LOAD CSV WITH HEADERS``: every field a string, columns taken from each
    file's header, a column missing from a file reads as null.  Rows get the
    ``kind`` of their file and an order: ``order_col`` when the file has it,
    else (file, position): files in path order, rows as they stand.  ``path``
    may be a folder or a list of files; files of one kind may have different
    headers.  A row that doesn't fit its header raises, as a failing load does;
    ``read_load_files_with_rejects`` lists such rows instead."""
    out = None
    for kind, (df, rejects) in _read_kinds(spark, paths).items():
        first = rejects.first()
        if first is not None:
            raise ValueError(f"{first['file']}: broken row at {first['pos']}: {first['record'][:200]}")
        out = _ordered(df, kind, order_col, out)
    return out


def read_load_files_with_rejects(spark, paths: dict[str, str],
                                 order_col: str = "row_no") -> tuple[DataFrame, DataFrame]:
    """As ``read_load_files``, but a broken row costs one row: it is left out and listed
    in the second frame (kind, file, pos, record)."""
    out = bad = None
    for kind, (df, rejects) in _read_kinds(spark, paths).items():
        out = _ordered(df, kind, order_col, out)
        listed = rejects.select(F.lit(kind).alias("kind"), "file", "pos", "record")
        bad = listed if bad is None else bad.unionByName(listed)
    return out, bad


def _read_kinds(spark, paths: dict[str, str]) -> dict[str, tuple[DataFrame, DataFrame]]:
    from .split_csv import read_by_header

    return {kind: read_by_header(spark, path) for kind, path in paths.items()}


def _ordered(df: DataFrame, kind: str, order_col: str, others: DataFrame | None) -> DataFrame:
    """df with ``kind`` and ``row_no``, after the rows of the other kinds."""
    if order_col in df.columns:  # files without the column keep the order in which they stand
        df = df.withColumn("row_no", F.coalesce(F.col(order_col).try_cast("bigint"), F.col("_order"))).drop("_order")
    else:
        df = df.withColumnRenamed("_order", "row_no")
    df = df.withColumn("kind", F.lit(kind))
    return df if others is None else others.unionByName(df, allowMissingColumns=True)
