"""Nested JSON payloads of a paper API: schemas, fixture payloads, flattening.

Flattening is the reference's response-to-CSV step done with ``from_json``,
``explode`` and higher-order functions; payload text may come from
``spark.read.text``/``json`` or a string column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import Tables

PAPER_SCHEMA = (
    "paperId string, title string, url string, venue string, publicationTypes array<string>, "
    "abstract string, year int, citationCount int, "
    "journal struct<name: string, volume: string, pages: string>")
AUTHOR_SCHEMA = ("data array<struct<authorId: string, name: string, "
                 "affiliations: array<struct<name: string>>>>")
CITATION_SCHEMA = ("paperId string, error string, "
                   "citations array<struct<paperId: string, "
                   "authors: array<struct<authorId: string, name: string>>>>")


# --- flattening -----------------------------------------------------------

def explode_pages(pages: DataFrame, col: str = "page") -> DataFrame:
    """(payload): one row per record of the ``data`` list of each fetched page;
    a page without a list gives none."""
    records = F.from_json(F.get_json_object(F.col(col), "$.data"), "array<string>")
    return pages.select(F.explode(records).alias("payload"))


def list_literal(items: Column) -> Column:
    """array<string> as the text of a list literal, ``['a', 'b']``; null stays null."""
    quoted = F.transform(items, lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.when(items.isNotNull(), F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]")))


def flatten_papers(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """One row per paper, all eleven fields; venue may be an object with a name or
    a plain string; a missing journal gives null name, volume and pages.
    ``publicationTypes`` is a list literal, as ``clean_papers`` takes it."""
    p = F.from_json(F.col(col), PAPER_SCHEMA)
    df = payloads.select(p.alias("p"))
    venue = F.col("p.venue")
    return df.select(
        F.col("p.paperId").alias("paperId"), F.col("p.title").alias("title"),
        F.col("p.url").alias("url"),
        F.coalesce(F.get_json_object(venue, "$.name"), venue).alias("venue"),
        list_literal(F.col("p.publicationTypes")).alias("publicationTypes"),
        F.col("p.abstract").alias("abstract"), F.col("p.year").alias("year"),
        F.col("p.citationCount").alias("citationCount"),
        F.col("p.journal.name").alias("journal_name"),
        F.col("p.journal.volume").alias("journal_volume"),
        F.col("p.journal.pages").alias("journal_pages"))


def flatten_authors(payloads: DataFrame, key: str = "paperId", col: str = "payload") -> DataFrame:
    """One row per (paper, author); affiliation names joined with '; ' ('' if none)."""
    a = F.from_json(F.col(col), AUTHOR_SCHEMA)
    rows = payloads.select(key, F.explode(a["data"]).alias("a"))
    affs = F.array_join(F.transform(F.coalesce(F.col("a.affiliations"),
                                               F.array().cast("array<struct<name:string>>")),
                                    lambda x: F.coalesce(x["name"], F.lit(""))), "; ")
    return rows.select(key, F.col("a.authorId").alias("authorId"),
                       F.col("a.name").alias("name"), affs.alias("affiliations"))


def flatten_citations(payloads: DataFrame, col: str = "payload") -> DataFrame:
    """One row per (paper, citing paper); author ids and names of the citing
    paper joined with '; ', null members skipped; error payloads skipped."""
    c = F.from_json(F.col(col), CITATION_SCHEMA)
    ok = payloads.select(c.alias("c")).where(F.col("c.error").isNull())
    rows = ok.select(F.col("c.paperId").alias("paperId"), F.explode("c.citations").alias("x"))
    ids = F.filter(F.transform("x.authors", lambda a: a["authorId"]), lambda v: v.isNotNull())
    names = F.filter(F.transform("x.authors", lambda a: a["name"]), lambda v: v.isNotNull())
    return rows.select("paperId", F.col("x.paperId").alias("citationId"),
                       F.array_join(ids, "; ").alias("authorIds"),
                       F.array_join(names, "; ").alias("authorNames"))


def union_tagged(frames: dict[str, DataFrame], tag: str = "field_query") -> DataFrame:
    """Tag each result set with its search term and append them."""
    out = None
    for term, df in frames.items():
        t = df.withColumn(tag, F.lit(term))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


# --- fixture payloads (derived from the tables) ----------------------------

def paper_payloads(t: Tables) -> DataFrame:
    """to_json of a paper record: venue an object when p_partkey is even, else
    a string; journal missing when p_size % 7 = 0."""
    p = t.part
    name = F.concat(F.lit("V-"), F.col("p_brand"))
    # JSON text of the venue: an object {"name": ...} or a bare string
    as_string = F.expr("substring(to_json(array(concat('V-', p_brand))), 2, "
                       "length(to_json(array(concat('V-', p_brand)))) - 2)")
    venue = F.when(F.col("p_partkey") % 2 == 0, F.to_json(F.struct(name.alias("name")))) \
        .otherwise(as_string)
    journal = F.when(F.col("p_size") % 7 != 0, F.struct(
        F.concat(F.lit("J-"), F.col("p_brand")).alias("name"),
        F.col("p_size").cast("string").alias("volume"),
        F.concat(F.lit("1-"), F.col("p_size").cast("string")).alias("pages")))
    rest = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("paperId"),
                              F.col("p_name").alias("title"),
                              F.concat(F.lit("p/"), F.col("p_partkey").cast("string")).alias("url"),
                              F.when(F.col("p_size") % 5 != 0, F.array(F.lit("JournalArticle"), F.col("p_type")))
                              .alias("publicationTypes"),
                              F.when(F.col("p_size") % 3 != 0, F.concat(F.col("p_name"), F.lit(' "quoted"')))
                              .alias("abstract"),
                              (F.lit(2017) + F.col("p_size") % 8).alias("year"),
                              F.col("p_size").alias("citationCount"), journal.alias("journal")))
    js = F.concat(F.lit('{"venue":'), venue, F.lit(","), F.expr("substring(_rest, 2)"))
    p = p.withColumn("_rest", rest)
    return p.select(js.alias("payload"))


def paper_pages(t: Tables, per_page: int = 20) -> DataFrame:
    """(page): the payloads in pages of about ``per_page`` records, by key."""
    records = paper_payloads(t).withColumn(
        "n", F.floor(F.get_json_object("payload", "$.paperId").cast("bigint") / per_page))
    return records.groupBy("n").agg(F.concat(
        F.lit('{"offset":0,"data":['), F.array_join(F.collect_list("payload"), ","), F.lit("]}")).alias("page")
    ).select("page")


def author_payloads(wrote: DataFrame, author: DataFrame) -> DataFrame:
    """One payload per paper: its authors ordered by authorId, each with one
    affiliation (the nation) or none when authorId % 10 = 0."""
    rows = wrote.join(author, "authorId").select(
        "paperId", "authorId",
        F.struct(F.col("authorId").cast("string").alias("authorId"), F.col("name"),
                 F.when(F.col("authorId") % 10 != 0,
                        F.array(F.struct(F.col("affiliation").alias("name"))))
                 .otherwise(F.array().cast("array<struct<name:string>>"))
                 .alias("affiliations")).alias("a"))
    grouped = rows.groupBy("paperId").agg(
        F.sort_array(F.collect_list(F.struct("authorId", "a"))).alias("l"))
    return grouped.select(F.col("paperId").cast("string").alias("paperId"),
                          F.to_json(F.struct(F.col("l.a").alias("data"))).alias("payload"))


def citation_payloads(t: Tables) -> DataFrame:
    """conversations grouped by conv_id: each turn is a citing paper with two
    authors, the first null for system turns; every 10th conversation is an
    error payload."""
    cv = t.conversations
    turn = F.struct(
        F.col("turn").cast("string").alias("paperId"),
        F.array(F.struct(F.nullif(F.col("role"), F.lit("system")).alias("authorId"),
                         F.col("role").alias("name")),
                F.struct(F.col("conv_id").cast("string").alias("authorId"),
                         F.col("text").alias("name"))).alias("authors"))
    grouped = cv.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct(F.col("turn").alias("k"), turn.alias("c"))))
        .alias("l"))
    ok = F.to_json(F.struct(F.col("conv_id").cast("string").alias("paperId"),
                            F.col("l.c").alias("citations")))
    err = F.to_json(F.struct(F.lit("Not found").alias("error")))
    return grouped.select(F.when(F.col("conv_id") % 10 == 0, err).otherwise(ok).alias("payload"))
