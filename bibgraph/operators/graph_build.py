"""Build the property graph from load rows (all-string CSV rows).

Each builder mirrors one ``LOAD CSV ... MERGE`` step of the reference:
``rows`` holds the rows of all three publication files with a ``kind``
column and a ``row_no`` giving the order inside a file; the order in which
the reference loads the files becomes ``file_no``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import split_list, to_int
from ..graph import Graph
from ..session import written
from .upsert import merge_edges_last_wins, merge_nodes_first_wins

# The file order of the loading steps of the reference whose
# result depends on it (CITES and CONTAINS carry no properties, so their
# order does not matter).
PAPER_FILE_ORDER = ("Conference", "Journal", "Workshop")
WROTE_FILE_ORDER = ("Journal", "Workshop", "Conference")
REVIEW_FILE_ORDER = ("Conference", "Journal", "Workshop")


def with_file_no(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    return rows.withColumn(
        "file_no", F.array_position(F.array(*[F.lit(k) for k in order]), F.col("kind")))


def with_paper(rows: DataFrame, papers: DataFrame | None) -> DataFrame:
    """``MATCH (p:Paper {paperId: row.paperId})``.  ``papers=None`` means the
    Paper nodes were created from these same rows, so every row with a key
    matches and the existence join (a second pass over the rows) is skipped."""
    if papers is None:
        return rows.where(F.col("paperId").isNotNull())
    return rows.join(papers.select("paperId"), "paperId", "left_semi")


def empty_like(df: DataFrame) -> DataFrame:
    """``MATCH (n) DETACH DELETE n``: an empty table of the same schema."""
    return df.limit(0)


def reset_graph(g: Graph) -> Graph:
    return Graph(**{k: empty_like(v) for k, v in g.tables().items()})


PAPER_PROPS = ["title", "url", "abstract", "year", "citationCount"]
AUTHOR_PROPS = ["name", "affiliation", "affiliationType"]
PUBLISHED_PROPS = ["year", "edition", "venue", "journal_volume"]


def paper_writes(rows: DataFrame) -> DataFrame:
    """What each load row writes to its Paper node; year and citationCount through toInteger."""
    return with_file_no(rows, PAPER_FILE_ORDER).select(
        "paperId", "file_no", "row_no", "title", "url", "abstract",
        to_int("year").alias("year"), to_int("citationCount").alias("citationCount"))


def paper_nodes(rows: DataFrame) -> DataFrame:
    """Paper nodes, first writer wins."""
    return merge_nodes_first_wins(paper_writes(rows), "paperId", PAPER_PROPS)


def author_writes(author_rows: DataFrame) -> DataFrame:
    return author_rows.select("authorId", "file_no", "row_no", F.col("name"),
                              F.col("Affiliations").alias("affiliation"),
                              F.col("Affiliation_type").alias("affiliationType"))


def author_nodes(author_rows: DataFrame) -> DataFrame:
    return merge_nodes_first_wins(author_writes(author_rows), "authorId", AUTHOR_PROPS)


def wrote_writes(rows: DataFrame, papers: DataFrame | None, trim: bool = True) -> DataFrame:
    """What each load row writes to WROTE edges, whether or not the author exists."""
    r = with_file_no(with_paper(rows, papers), WROTE_FILE_ORDER).select(
        "paperId", "file_no", "row_no", "corresponding_author",
        F.posexplode(F.split(F.col("authorIds"), ",")).alias("pos", "raw"))
    return r.select("paperId", "file_no", "row_no", F.trim("raw").alias("authorId"),
                    F.coalesce((F.col("corresponding_author") ==
                                (F.trim("raw") if trim else F.col("raw"))), F.lit(False))
                    .alias("corresponding"))


def wrote_edges(rows: DataFrame, papers: DataFrame | None, authors: DataFrame,
                trim: bool = True) -> DataFrame:
    """WROTE with ``corresponding``; both ends must exist; last writer sets the flag.

    ``trim=False`` compares the untrimmed list item with the corresponding
    author, as the original query does (only the first item can match).
    """
    r = wrote_writes(rows, papers, trim).join(authors.select("authorId"), "authorId", "left_semi")
    return merge_edges_last_wins(r, ["authorId", "paperId"], ["corresponding"])


def venue_rows(rows: DataFrame) -> DataFrame:
    """Rows with a usable venue name: journal_name for journals, proceedings otherwise."""
    name = F.when(F.col("kind") == "Journal", F.col("journal_name")).otherwise(
        F.col("proceedings"))
    return (rows.withColumn("name", name)
            .where(F.col("name").isNotNull() & (F.col("name") != "")))


def venue_nodes(rows: DataFrame) -> DataFrame:
    """Conference / Journal / Workshop nodes keyed on (kind, name)."""
    return venue_rows(rows).select("kind", "name").distinct()


def published_in_writes(rows: DataFrame, papers: DataFrame | None) -> DataFrame:
    """What each load row writes to its PUBLISHED_IN edge.  The three kinds are separate
    loads, so file order does not matter across kinds."""
    return venue_rows(with_paper(rows, papers)).select(
        "paperId", "kind", "name", F.lit(0).alias("file_no"), "row_no",
        to_int("year").alias("year"), to_int("edition").alias("edition"),
        F.col("venue"),
        F.when(F.col("kind") == "Journal", F.col("journal_volume")).alias("journal_volume"))


def published_in_edges(rows: DataFrame, papers: DataFrame | None) -> DataFrame:
    """PUBLISHED_IN with year, edition, venue (city) and, for journals, the volume.

    One edge per (paper, venue); the last row's properties win.
    """
    return merge_edges_last_wins(published_in_writes(rows, papers), ["paperId", "kind", "name"], PUBLISHED_PROPS)


def cites_writes(rows: DataFrame) -> DataFrame:
    """(src, dst) of every non-empty ``Citations`` list whose row has a paper."""
    return (with_paper(rows.where(F.col("Citations").isNotNull() & (F.col("Citations") != "")), None)
            .select(F.col("paperId").alias("src"), F.explode(split_list("Citations", ",")).alias("dst")))


def cites_edges(rows: DataFrame, papers: DataFrame, papers_from_rows: bool = False,
                cut: bool = False) -> tuple[DataFrame, DataFrame]:
    """CITES from the delimited ``Citations`` list; returns (edges, stub papers).

    A cited id with no Paper node creates a stub node (key only).  The citing
    side must be a Paper; ``papers_from_rows=True`` says the Paper nodes were
    created from these rows, which makes that check a null test.  ``cut`` writes the
    edges, for callers whose several jobs would each derive them.
    """
    r = (with_paper(rows.where(F.col("Citations").isNotNull() & (F.col("Citations") != "")),
                    None if papers_from_rows else papers)
         .select(F.col("paperId").alias("src"),
                 F.explode(split_list("Citations", ",")).alias("dst")))
    edges = written(r.distinct(), "cites") if cut else r.distinct()
    stubs = (edges.select(F.col("dst").alias("paperId")).distinct()
             .join(papers.select("paperId"), "paperId", "left_anti"))
    return edges, stubs


def with_stubs(papers: DataFrame, stubs: DataFrame) -> DataFrame:
    cols = [F.col("paperId")] + [F.lit(None).cast(papers.schema[c].dataType).alias(c)
                                 for c in papers.columns if c != "paperId"]
    return papers.unionByName(stubs.select(*cols))


def keyword_nodes(rows: DataFrame) -> DataFrame:
    """Keyword nodes only, items untrimmed (the loader that is never called)."""
    return rows.select(F.explode(F.split("keywords", ",")).alias("text")).distinct()


def contains_edges(rows: DataFrame, papers: DataFrame | None,
                   delimiter: str = ",") -> DataFrame:
    """CONTAINS with trimmed, non-empty keywords; keyword nodes are its distinct targets."""
    return (with_paper(rows, papers)
            .select("paperId", F.explode(split_list("keywords", delimiter)).alias("keyword"))
            .where(F.col("keyword").isNotNull() & (F.col("keyword") != ""))
            .distinct())


def reviewed_edges(rows: DataFrame, papers: DataFrame | None, authors: DataFrame,
                   trim: bool = True) -> DataFrame:
    """REVIEWED (Author -> Paper) from the delimited ``reviewers`` list."""
    r = (with_paper(rows, papers)
         .select("paperId", F.explode(split_list("reviewers", ",", trim)).alias("authorId"))
         .join(authors.select("authorId"), "authorId", "left_semi"))
    return r.select("authorId", "paperId").distinct()


def reviewed_writes(rows: DataFrame, papers: DataFrame | None, trim: bool = True) -> DataFrame:
    """What each load row writes to REVIEWED edges, whether or not the author exists."""
    return (with_file_no(with_paper(rows, papers), REVIEW_FILE_ORDER)
            .select("paperId", "file_no", "row_no", "approved", "comments",
                    F.explode(split_list("reviewers", ",", trim)).alias("authorId")))


def reviewed_edges_evolved(rows: DataFrame, papers: DataFrame | None, authors: DataFrame,
                           existing: DataFrame | None = None, trim: bool = True) -> DataFrame:
    """Schema evolution: REVIEWED edges gain ``approved`` and ``comments`` (last writer)."""
    r = reviewed_writes(rows, papers, trim).join(authors.select("authorId"), "authorId", "left_semi")
    return merge_edges_last_wins(r, ["authorId", "paperId"], ["approved", "comments"],
                                 existing=existing)


def affiliated_edges(author_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Organization nodes and AFFILIATED_TO edges from authors_info (evolution step)."""
    edges = (author_rows.where(F.col("Affiliations").isNotNull())
             .select("authorId", F.col("Affiliations").alias("organization")).distinct())
    orgs = edges.select(F.col("organization").alias("name")).distinct()
    return orgs, edges


def build_graph(rows: DataFrame, author_rows: DataFrame, evolved: bool = True,
                write_inputs: bool = True) -> Graph:
    """The whole load (and optional evolution step) as lazily derived DataFrames.

    Every table reads the same load rows; ``write_inputs`` writes them once to
    the shared checkpoint folder, so that a job computing several tables parses
    the input once.  Paper nodes come from these rows, so the
    per-step Paper existence joins are skipped (``papers=None``).
    """
    if write_inputs:
        rows, author_rows = written(rows, "load_rows"), written(author_rows, "author_rows")
    papers = paper_nodes(rows)
    authors = author_nodes(author_rows)
    cites, stubs = cites_edges(rows, papers, papers_from_rows=True)
    contains = contains_edges(rows, None)
    g = Graph(
        paper=with_stubs(papers, stubs),
        author=authors,
        venue=venue_nodes(rows),
        keyword=contains.select(F.col("keyword").alias("text")).distinct(),
        wrote=wrote_edges(rows, None, authors),
        published_in=published_in_edges(rows, None),
        cites=cites,
        contains=contains,
        reviewed=(reviewed_edges_evolved(rows, None, authors) if evolved
                  else reviewed_edges(rows, None, authors)),
    )
    if evolved:
        orgs, aff = affiliated_edges(author_rows)
        g = g.with_tables(organization=orgs, affiliated_to=aff)
    return g


def graph_counts(g: Graph) -> DataFrame:
    """(table, rows) for every node and edge table of the graph, counted one after the other:
    the shuffle files of one table are gone before the next is built."""
    parts = [written(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows"), "count")
             for name, df in g.tables().items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
