"""Registry of the library's queries over the fixture tables.

Each entry takes (spark, sf_dir) and returns a DataFrame whose column names
match the DuckDB oracle in ``bibgraph_oracle.py``.  Doubles are rounded to 6 places so
that summation order does not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..graph import Graph
from ..operators import clean, synth
from ..operators import graph_build as gb
from ..operators import keywords as kw
from ..operators import nouns, profile
from ..operators.authors import process_authors
from ..operators.condensation import condense, topological_levels
from ..operators.graph_algorithms import Projection, ProjectionCatalog, pagerank
from ..operators.rank_update import update_pagerank
from ..operators.reach_sketch import reach_estimates, relative_error
from ..operators.upsert import dedupe_keep_first
from ..session import checkpoint_dir, in_parts, remove, replaced, scratch_path, written
from ..sources import csv_io, payloads, split_csv
from ..sources.fixtures import COMMUNITY_TERMS, graph_from_tables
from ..sources.load_files import author_load_rows, paper_load_rows, with_abstracts
from ..sources.raw_papers import raw_authors, raw_papers
from ..sources.tables import Tables
from ..streaming.graph_store import PAPER_COLUMNS, GraphStore, with_columns
from . import algorithms, analytics, recommend

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


# --- analytics -----------------------------------------------------------

@register("top3_cited_per_conference")
def q_top3(spark, sf_dir):
    return analytics.top3_cited_per_conference(graph_from_tables(spark, sf_dir))


@register("conference_communities")
def q_communities(spark, sf_dir):
    return analytics.conference_communities(graph_from_tables(spark, sf_dir))


@register("conference_community_sizes")
def q_community_sizes(spark, sf_dir):
    return analytics.conference_community_sizes(graph_from_tables(spark, sf_dir))


@register("journal_impact_factor")
def q_impact(spark, sf_dir):
    df = analytics.journal_impact_factor(graph_from_tables(spark, sf_dir), year=2023)
    return df.select("journalName", "num_citations", "num_papers", r6("impact_factor"),
                     "impact_factor_int")


@register("author_h_index")
def q_h_index(spark, sf_dir):
    return analytics.author_h_index(graph_from_tables(spark, sf_dir))


# --- recommender ---------------------------------------------------------

def _community(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    venues = recommend.community_venues(g, COMMUNITY_TERMS, 0.9)
    return g, venues


@register("community_keywords")
def q_comm_kw(spark, sf_dir):
    return recommend.community_keywords(graph_from_tables(spark, sf_dir), COMMUNITY_TERMS)


@register("community_venues")
def q_comm_venues(spark, sf_dir):
    _, venues = _community(spark, sf_dir)
    return venues.select("kind", "name", "num_comm_papers", "num_papers", r6("share"),
                         "community")


@register("top_community_papers")
def q_top_papers(spark, sf_dir):
    g, venues = _community(spark, sf_dir)
    return recommend.top_community_papers(g, venues, 100)


@register("potential_reviewers")
def q_pot_reviewers(spark, sf_dir):
    g, venues = _community(spark, sf_dir)
    return recommend.potential_reviewers(g, recommend.top_community_papers(g, venues, 100))


@register("gurus")
def q_gurus(spark, sf_dir):
    g, venues = _community(spark, sf_dir)
    return recommend.gurus(g, recommend.top_community_papers(g, venues, 100), 2)


# --- graph algorithms ----------------------------------------------------


@register("project_counts")
def q_project_counts(spark, sf_dir):
    return algorithms.wrote_projection(graph_from_tables(spark, sf_dir)).counts()


# The reference calls the graph library's PageRank with its defaults:
# damping 0.85, at most 20 rounds, tolerance 1e-7.  WROTE is bipartite and
# acyclic, so the loop is exactly converged after two rounds and stops.
PR_TOL = 1e-7


@register("pagerank_wrote")
def q_pagerank_wrote(spark, sf_dir):
    pr = pagerank(algorithms.wrote_projection(graph_from_tables(spark, sf_dir)), tol=PR_TOL)
    return pr.select("label", "key", r6("score"))


@register("pagerank_top10")
def q_pagerank_top10(spark, sf_dir):
    pr = pagerank(algorithms.wrote_projection(graph_from_tables(spark, sf_dir)), tol=PR_TOL)
    pr = algorithms.node_lookup(pr.select("label", "key", r6("score")))
    return algorithms.top10(pr, "score").select("paperId", "score")


@register("pagerank_cites")
def q_pagerank_cites(spark, sf_dir):
    # all 20 rounds, so that the unrolled SQL oracle computes the same numbers
    pr = pagerank(algorithms.cites_projection(graph_from_tables(spark, sf_dir)), max_iter=20)
    return pr.select(F.col("key").alias("paperId"), r6("score"))


@register("scc_cites")
def q_scc_cites(spark, sf_dir):
    proj = algorithms.cites_projection(graph_from_tables(spark, sf_dir))
    return algorithms.scc_with_component_keys(proj).select(
        F.col("key").alias("paperId"), F.col("componentKey").alias("componentId"))


def _same_edition_projection(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    edition = g.paper.select("paperId", (F.col("citationCount") % 20).alias("e"))
    inside = (g.cites.join(edition.select(F.col("paperId").alias("src"), "e"), "src")
              .join(edition.select(F.col("paperId").alias("dst"), "e"), ["dst", "e"]).select("src", "dst"))
    return algorithms.cites_projection(Graph(paper=g.paper, cites=inside))


@register("condensation_levels")
def q_condensation_levels(spark, sf_dir):
    """Components of the citations inside one edition, their sizes and topological levels."""
    proj = _same_edition_projection(spark, sf_dir)
    named = written(algorithms.scc_with_component_keys(proj).select(
        F.col("key").alias("paperId"), F.col("componentKey").alias("componentId")), "components")
    ids = proj.vertices.select("id", F.col("key").alias("paperId")).join(named, "paperId").select("id", "componentId")
    dag = condense(proj, ids)
    return topological_levels(dag).join(dag.vertices, "id").select(
        F.col("id").alias("componentId"), F.col("key").alias("n_papers"), "level")


@register("scc_same_edition")
def q_scc_same_edition(spark, sf_dir):
    """SCC of the citations inside one edition number: many components of mixed sizes."""
    proj = _same_edition_projection(spark, sf_dir)
    return algorithms.scc_with_component_keys(proj).select(
        F.col("key").alias("paperId"), F.col("componentKey").alias("componentId"))


@register("named_projection_algorithms")
def q_named_projection(spark, sf_dir):
    """PageRank and SCC of one named CITES projection, whose edges are written once."""
    catalog = ProjectionCatalog(spark)
    proj = catalog.project("cites", algorithms.cites_projection(graph_from_tables(spark, sf_dir)))
    pr = pagerank(proj, max_iter=20).select(F.col("key").alias("paperId"), r6("score"))
    scc = algorithms.scc_with_component_keys(catalog.get("cites")).select(
        F.col("key").alias("paperId"), F.col("componentKey").alias("componentId"))
    out = written(pr.join(scc, "paperId"), "named_projection")
    catalog.drop("cites")
    return out


@register("pagerank_after_merge")
def q_pagerank_after_merge(spark, sf_dir):
    """PageRank of the citations inside one edition from higher to lower paper ids (no cycles): every tenth
    citing paper's citations are merged after a full run, and another tenth's are taken back."""
    whole = _same_edition_projection(spark, sf_dir)
    edges = written(whole.edges.where("src > dst").distinct(), "edges")
    new, gone = F.col("src") % 10 == 0, F.col("src") % 10 == 1
    proj = Projection(whole.vertices, edges.where(~new))
    full = written(pagerank(proj, max_iter=500, tol=1e-13).select("id", "score"), "ranks")
    after = Projection(whole.vertices, edges.where(~gone))
    return update_pagerank(full, after, edges.where(new), edges.where(gone), tol=1e-13).scores.select(
        F.col("key").alias("paperId"), r6("score"))


@register("project_partial")
def q_project_partial(spark, sf_dir):
    """Counts of a projection that leaves out a third of the papers, with integer and with text
    keys: edges that lose an end are dropped alike."""
    g = graph_from_tables(spark, sf_dir)
    some = g.paper.where(F.col("paperId") % 3 != 0)
    text = Graph(paper=some.withColumn("paperId", F.col("paperId").cast("string")),
                 cites=g.cites.select(F.col("src").cast("string").alias("src"),
                                      F.col("dst").cast("string").alias("dst")))
    number = algorithms.cites_projection(Graph(paper=some, cites=g.cites)).counts()
    return (number.withColumn("keys", F.lit("integer"))
            .unionByName(algorithms.cites_projection(text).counts().withColumn("keys", F.lit("text"))))


@register("scc_top10")
def q_scc_top10(spark, sf_dir):
    df = q_scc_cites(spark, sf_dir)
    return df.orderBy(F.desc("componentId"), F.asc("paperId")).limit(10)


@register("scc_wrote")
def q_scc_wrote(spark, sf_dir):
    proj = algorithms.wrote_projection(graph_from_tables(spark, sf_dir))
    return algorithms.scc_with_component_keys(proj)


# --- graph load from reference-shaped load files --------------------------


def _load_papers(spark, sf_dir):
    return paper_load_rows(Tables(spark, sf_dir))


def _narrow_load_rows(spark, sf_dir, *columns):
    """Paper load rows derived once, with keys, order and the given columns; the others are null."""
    rows = _load_papers(spark, sf_dir).select("kind", "row_no", "paperId", *columns)
    return with_columns(written(rows, "load_rows"), PAPER_COLUMNS)


def _load_authors(spark, sf_dir):
    return author_load_rows(Tables(spark, sf_dir))


def _load(spark, sf_dir):
    return _load_papers(spark, sf_dir), _load_authors(spark, sf_dir)


@register("paper_nodes")
def q_paper_nodes(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return with_abstracts(gb.paper_nodes(rows), Tables(spark, sf_dir)).select(
        "paperId", "title", "url", "abstract", "year", "citationCount")


@register("merge_nodes_first_wins")
def q_author_nodes(spark, sf_dir):
    arows = _load_authors(spark, sf_dir)
    return gb.author_nodes(arows)


@register("wrote_edges")
def q_wrote_edges(spark, sf_dir):
    rows, arows = _load(spark, sf_dir)
    return gb.wrote_edges(rows, None, gb.author_nodes(arows))


@register("published_in_edges")
def q_published_in(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return gb.published_in_edges(rows, None)


@register("merge_edges_last_wins")
def q_merge_edges_last(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return gb.published_in_edges(rows, None).select(
        "paperId", "kind", "name", "venue")


def _loaded_in_batches(spark, sf_dir, tables, columns):
    """A graph store filled by three batches of load rows in a mixed order, one of them twice;
    ``columns`` are those of the load rows that the tables are made of."""
    rows, arows = _narrow_load_rows(spark, sf_dir, *columns), _load_authors(spark, sf_dir)
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("paperId", "row_no"), F.lit(3)))
    store = GraphStore(spark, scratch_path(spark, "graph_store"), buckets=8)
    for batch_id, part in ((0, 2), (1, 0), (2, 1), (2, 1)):
        store.merge(rows.where(F.col("_part") == part).drop("_part"),
                    arows if part == 1 else None, batch_id, tables=tables)
    return store


@register("merge_store_wrote")
def q_merge_store_wrote(spark, sf_dir):
    return _loaded_in_batches(spark, sf_dir, ["wrote", "author"],
                              ["authorIds", "corresponding_author"]).table("wrote")


@register("merge_store_published_in")
def q_merge_store_published_in(spark, sf_dir):
    return _loaded_in_batches(spark, sf_dir, ["published_in"], [
        "year", "edition", "venue", "proceedings", "journal_name", "journal_volume"]).table("published_in")


@register("merge_store_papers")
def q_merge_store_papers(spark, sf_dir):
    """Papers and stubs, after stubs of earlier batches became papers."""
    return _loaded_in_batches(spark, sf_dir, ["paper"], [
        *gb.PAPER_PROPS, "Citations"]).table("paper").drop("abstract")


@register("venue_nodes")
def q_venue_nodes(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return gb.venue_nodes(rows)


@register("cites_edges_with_stubs")
def q_cites_stubs(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    edges, stubs = gb.cites_edges(rows, gb.paper_nodes(rows), papers_from_rows=True)
    marked = stubs.select(F.col("paperId").alias("dst"), F.lit(True).alias("dst_is_stub"))
    return (edges.join(marked, "dst", "left")
            .select("src", "dst", F.coalesce("dst_is_stub", F.lit(False)).alias("dst_is_stub")))


@register("keyword_nodes")
def q_keyword_nodes(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return gb.keyword_nodes(rows)


@register("contains_edges")
def q_contains(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return gb.contains_edges(rows, None)


@register("reviewed_edges")
def q_reviewed(spark, sf_dir):
    rows, arows = _load(spark, sf_dir)
    return gb.reviewed_edges(rows, None, gb.author_nodes(arows))


@register("reviewed_edges_untrimmed")
def q_reviewed_untrimmed(spark, sf_dir):
    rows, arows = _load(spark, sf_dir)
    return gb.reviewed_edges(rows, None, gb.author_nodes(arows), trim=False)


@register("reviewed_edges_evolved")
def q_reviewed_evolved(spark, sf_dir):
    rows = paper_load_rows(Tables(spark, sf_dir), citations=False, cut=True)
    # both steps read the load rows: derive them once
    rows = replaced(rows.select("kind", "row_no", "paperId", "reviewers", "approved", "comments"), "load_rows")

    def evolved(authors):
        old = gb.reviewed_edges(rows, None, authors)
        return gb.reviewed_edges_evolved(rows, None, authors, existing=old)

    return in_parts(gb.author_nodes(_load_authors(spark, sf_dir)), "authorId", rows.count(), evolved)


@register("affiliated_edges")
def q_affiliated(spark, sf_dir):
    arows = _load_authors(spark, sf_dir)
    return gb.affiliated_edges(arows)[1]


@register("graph_counts")
def q_graph_counts(spark, sf_dir):
    rows, arows = _load(spark, sf_dir)
    return gb.graph_counts(gb.build_graph(rows, arows))


# --- cleaning / ETL --------------------------------------------------------


def _raw(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return raw_papers(t), raw_authors(t)


def _categorized(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    return clean.categorize_publication(clean.clean_papers(papers))


@register("clean_papers")
def q_clean(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    return clean.clean_papers(papers).select(
        "paperId", "field_query", "title", "url", "venue", "publicationTypes", "abstract", "year",
        "citationCount", "journal_name", "journal_volume")


@register("categorize_publication")
def q_categorize(spark, sf_dir):
    return _categorized(spark, sf_dir).select("paperId", "publicationTypes", "journal_volume")


@register("aggregate_paper_authors")
def q_aggregate_authors(spark, sf_dir):
    papers, authors = _raw(spark, sf_dir)
    out = clean.aggregate_paper_authors(clean.clean_papers(papers), authors)
    out = clean.list_columns_to_strings(out.join(clean.author_id_lists(authors), "paperId"))
    return out.select("paperId", "n_authors", "last_author", "authorIds")


@register("list_columns_to_strings")
def q_list_strings(spark, sf_dir):
    papers, authors = _raw(spark, sf_dir)
    lists = clean.author_id_lists(authors)
    out = clean.clean_papers(papers).join(lists, "paperId")
    return clean.list_columns_to_strings(out).select("paperId", "authorIds")


@register("corresponding_author")
def q_corresponding(spark, sf_dir):
    papers, authors = _raw(spark, sf_dir)
    out = clean.aggregate_paper_authors(clean.clean_papers(papers), authors)
    return out.select("paperId", "corresponding_author")


@register("venue_names")
def q_venue_names(spark, sf_dir):
    return clean.venue_names(_categorized(spark, sf_dir)).select(
        "paperId", "proceedings", "journal")


@register("extract_edition")
def q_edition(spark, sf_dir):
    out = clean.extract_edition(clean.venue_names(_categorized(spark, sf_dir)))
    return out.select("paperId", "edition")


@register("extract_edition_literal")
def q_edition_literal(spark, sf_dir):
    out = clean.extract_edition(clean.venue_names(_categorized(spark, sf_dir)), literal=True)
    return out.select("paperId", "edition")


@register("parse_list_literals")
def q_parse_lists(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    out = clean.parse_list_literals(papers.where(F.col("publicationTypes").isNotNull()),
                                    "publicationTypes")
    return out.select("paperId", F.size("publicationTypes").cast("bigint").alias("n_types"),
                      F.array_join("publicationTypes", "|").alias("types"))


@register("finalize_keywords")
def q_finalize_keywords(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    p = clean.clean_papers(papers).withColumn("keywords", F.split("title", " "))
    return clean.list_columns_to_strings(clean.finalize_keywords(p)).select(
        "paperId", "keywords")


def _typed(spark, sf_dir):
    out = clean.extract_edition(clean.venue_names(_categorized(spark, sf_dir)))
    return clean.split_by_type(out)


@register("split_by_type")
def q_split(spark, sf_dir):
    parts = _typed(spark, sf_dir)
    cols = lambda df, t: df.select("paperId", F.lit(t).alias("type"),
                                   (F.col("edition") if "edition" in df.columns
                                    else F.lit(None).cast("bigint")).alias("edition"))
    out = None
    for t, df in parts.items():
        out = cols(df, t) if out is None else out.unionByName(cols(df, t))
    return out


@register("clone_previous_edition")
def q_clone(spark, sf_dir):
    conf = _typed(spark, sf_dir)["Conference"]
    return clean.clone_previous_edition(conf).select(
        "paperId", "edition", F.col("year").cast("bigint").alias("year"))


@register("dedupe_keep_first")
def q_dedupe(spark, sf_dir):
    li = Tables(spark, sf_dir).lineitem
    others = [c for c in li.columns if c not in ("l_orderkey", "l_linenumber")]
    return dedupe_keep_first(li, ["l_orderkey", "l_linenumber"], others)


# --- synthetic attributes --------------------------------------------------

@register("assign_reviewers")
def q_reviewers(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    papers = synth.number_of_reviewers(g.paper.select("paperId"))
    pool = g.wrote.select("authorId")
    return synth.pick_from_pool(papers, "paperId", "number_reviewers", pool, "authorId",
                                seed="rev", exclude=g.wrote.select("paperId", "authorId"),
                                slack=20).withColumn("rank", F.col("rank").cast("bigint"))


@register("assign_comments")
def q_comments(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    papers = synth.number_of_reviewers(g.paper.select("paperId"))
    pool = Tables(spark, sf_dir).benchmark.select("item_id")
    return synth.pick_from_pool(papers, "paperId", "number_reviewers", pool, "item_id",
                                seed="comment", slack=20) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("synthetic_citations")
def q_synth_cites(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    papers = synth.number_of_citations(g.paper.select("paperId"))
    return synth.pick_from_pool(papers, "paperId", "synthetic_cites", g.paper.select("paperId"),
                                "paperId", seed="cite", slack=40, self_excluded=True) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("assign_reviewers_by_rank")
def q_reviewers_by_rank(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    papers = synth.number_of_reviewers(g.paper.select("paperId"))
    return synth.pick_by_rank(papers, "paperId", "number_reviewers", g.wrote.select("authorId"), "authorId",
                              seed="rev", exclude=g.wrote.select("paperId", "authorId"))


@register("synthetic_citations_by_rank")
def q_synth_cites_by_rank(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    papers = synth.number_of_citations(g.paper.select("paperId"))
    return synth.pick_by_rank(papers, "paperId", "synthetic_cites", g.paper.select("paperId"), "paperId",
                              seed="cite", self_excluded=True)


@register("assign_locations")
def q_locations(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    cities = Tables(spark, sf_dir).nation.select(F.col("n_name").alias("location"))
    return synth.pick_one(g.paper.select("paperId"), "paperId", cities, "location", seed="loc")


@register("assign_affiliations")
def q_affiliations(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    t = Tables(spark, sf_dir)
    # 25 nation names stand for the pool; the first dozen play universities
    pool = t.nation.select(F.col("n_name").alias("affiliation"), "n_nationkey")
    picked = synth.pick_one(g.author.select("authorId"), "authorId",
                            pool.select("affiliation"), "affiliation", seed="aff")
    unis = pool.where(F.col("n_nationkey") < 12).select("affiliation", F.lit(True).alias("u"))
    return (picked.join(unis, "affiliation", "left")
            .select("authorId", "affiliation",
                    F.when(F.col("u"), F.lit("university")).otherwise(F.lit("company"))
                    .alias("affiliation_type")))


# --- sources, profiling, keywords ----------------------------------------


@register("extract_keywords")
def q_keywords(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text",
                                                  F.col("source").alias("field_query"))
    return kw.extract_keywords(docs, "doc_id", "text", "field_query", 4) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("extract_noun_keywords")
def q_noun_keywords(spark, sf_dir):
    """The top nouns of each document, the field term among them."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text", F.col("source").alias("field_query"))
    weights = written(nouns.train(nouns.seed_table(spark)), "noun_weights")
    return kw.extract_keywords(docs, "doc_id", "text", "field_query", 4, nouns=weights) \
        .withColumn("rank", F.col("rank").cast("bigint"))


@register("value_counts")
def q_value_counts(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    return profile.value_counts(papers, "publicationTypes")


@register("null_profile")
def q_null_profile(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    return profile.null_profile(papers)


@register("papers_of_author")
def q_papers_of_author(spark, sf_dir):
    rows = _load_papers(spark, sf_dir)
    return profile.membership_counts(rows, "authorIds", "authorId")


@register("papers_of_author_substring")
def q_papers_of_author_substring(spark, sf_dir):
    """The literal form: rows whose author text contains the id anywhere, also inside other ids."""
    rows, arows = _load(spark, sf_dir)
    return profile.substring_counts(rows, "authorIds", arows, "authorId")


@register("flatten_papers")
def q_flatten_papers(spark, sf_dir):
    pages = payloads.paper_pages(Tables(spark, sf_dir))
    return payloads.flatten_papers(payloads.explode_pages(pages))


@register("flatten_then_clean")
def q_flatten_then_clean(spark, sf_dir):
    """Fetched pages through the cleaning step."""
    flat = payloads.flatten_papers(payloads.explode_pages(payloads.paper_pages(Tables(spark, sf_dir))))
    tagged = payloads.union_tagged({" Big Data": flat})
    return clean.clean_papers(tagged).select("paperId", "field_query", "publicationTypes", "abstract", "year")


@register("authors_info")
def q_authors_info(spark, sf_dir):
    """The author load table: nations 2 to 12 play the universities, the first ten suppliers the companies."""
    t = Tables(spark, sf_dir)
    _, authors = _raw(spark, sf_dir)
    unis = t.nation.select(F.col("n_name").alias("affiliation"), F.col("n_nationkey").alias("position"))
    firms = t.supplier.select(F.col("s_name").alias("affiliation"), F.col("s_suppkey").alias("position"))
    return process_authors(authors, unis, firms, university_rows=(1, 12), company_rows=(0, 10))


@register("dedupe_papers")
def q_dedupe_papers(spark, sf_dir):
    """Papers fetched under two terms: one row per paper, that of the first term."""
    papers, _ = _raw(spark, sf_dir)
    again = papers.where(F.col("paperId").cast("bigint") % 3 == 0).withColumn("field_query", F.lit("AAA"))
    return clean.dedupe_papers(papers.unionByName(again)).select("paperId", "field_query", "title", "year")


@register("attach_keywords_citations")
def q_attach(spark, sf_dir):
    papers, _ = _raw(spark, sf_dir)
    key = F.col("paperId").cast("bigint")
    kws = papers.where(key % 4 != 0).select("paperId", payloads.list_literal(F.split("title", " ")).alias("keywords"))
    cites = papers.where(key % 5 != 0).select(
        "paperId", F.explode(F.array(F.lit(1), F.lit(2))).alias("n")).select(
        "paperId", F.concat(F.lit("["), F.col("paperId"), F.lit(", "), F.col("n").cast("string"), F.lit("]"))
        .alias("Citations"))
    out = clean.attach_keywords_citations(clean.clean_papers(papers), kws, cites)
    return out.select("paperId", F.array_join("keywords", ",").alias("keywords"), "Citations")


@register("flatten_authors")
def q_flatten_authors(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    return payloads.flatten_authors(payloads.author_payloads(g.wrote, g.author))


@register("flatten_citations")
def q_flatten_citations(spark, sf_dir):
    return payloads.flatten_citations(payloads.citation_payloads(Tables(spark, sf_dir)))


@register("union_tagged")
def q_union_tagged(spark, sf_dir):
    g = graph_from_tables(spark, sf_dir)
    frames = {term: g.contains.where(F.col("keyword") == term).select("paperId")
              for term in COMMUNITY_TERMS}
    return payloads.union_tagged(frames)


@register("csv_round_trip")
def q_csv_round_trip(spark, sf_dir):
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text", "lang", "source")
    path = scratch_path(spark, "csv_round_trip")
    csv_io.write_csv(docs, path)
    return csv_io.read_csv(spark, path, "doc_id bigint, text string, lang string, source string")


@register("csv_round_trip_split")
def q_csv_round_trip_split(spark, sf_dir):
    """Texts with quotes and line breaks, written as CSV and read by byte ranges."""
    docs = Tables(spark, sf_dir).documents.select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch_path(spark, "csv_round_trip_split")
    csv_io.write_csv(docs, path)
    rows, _ = split_csv.read_split(spark, path, docs.schema)
    return rows


@register("community_papers")
def q_community_papers(spark, sf_dir):
    """(kind, name, paperId): papers with a community keyword, per journal/conference."""
    g = graph_from_tables(spark, sf_dir)
    comm = recommend.community_papers(g, COMMUNITY_TERMS)
    return (g.published_in.where(F.col("kind").isin(*recommend.COMMUNITY_KINDS))
            .join(comm, "paperId", "left_semi").select("kind", "name", "paperId").distinct())


@register("citation_reach_khop")
def q_reach(spark, sf_dir):
    """Papers citing a top community paper directly or through one other paper."""
    checkpoint_dir(spark)
    g, venues = _community(spark, sf_dir)
    top = recommend.top_community_papers(g, venues, 100).select("paperId")
    return algorithms.reach_within(g.cites, top, 2, "backward").withColumnRenamed(
        "source", "topPaperId")


@register("citation_reach_estimates")
def q_reach_estimates(spark, sf_dir):
    """Papers within two hops of each top community paper, counted exactly, and whether the estimate
    from the sketches of the whole graph is within five standard errors."""
    checkpoint_dir(spark)
    g, venues = _community(spark, sf_dir)
    top = recommend.top_community_papers(g, venues, 100).select("paperId")
    exact = algorithms.reach_within(g.cites, top, 2, "backward").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_papers"))
    proj = algorithms.cites_projection(g)
    about = reach_estimates(proj, 2, "backward").join(proj.vertices, "id")
    off = F.abs(F.col("n_reached") - F.col("n_papers")) <= 1 + 5 * relative_error(12) * F.col("n_papers")
    return exact.join(about, F.col("source") == F.col("key"), "left").select(
        F.col("source").alias("topPaperId"), "n_papers", F.coalesce(off, F.lit(False)).alias("within_bound"))


@register("graph_counts_from_csv")
def q_graph_counts_csv(spark, sf_dir):
    """Load rows written as the three reference-style CSV files, read back as
    all-string rows, then the whole graph built and counted."""
    from ..sources.load_files import read_load_files, write_load_files

    rows, arows = paper_load_rows(Tables(spark, sf_dir), cut=True), _load_authors(spark, sf_dir)
    paths = write_load_files(rows, scratch_path(spark, "load_files"), own=True)
    back = read_load_files(spark, paths)  # parsed once and written
    remove(spark, paths.values())  # nothing reads the files any more
    return gb.graph_counts(gb.build_graph(back, written(arows, "author_rows"), write_inputs=False))


def _processed(spark, sf_dir):
    from .etl import process_papers

    t = Tables(spark, sf_dir)
    papers, authors = _raw(spark, sf_dir)
    cities = t.nation.select(F.col("n_name").alias("location"))
    texts = t.benchmark.select(F.col("item_id").alias("review_id"), F.col("text").alias("Text"))
    return process_papers(papers, authors, cities, texts)


@register("process_papers_counts")
def q_process_papers(spark, sf_dir):
    """Rows per load file from the whole paper-processing pipeline."""
    out = None
    for kind, df in _processed(spark, sf_dir).items():
        c = df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(kind).alias("type"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


@register("process_papers_rows")
def q_process_papers_rows(spark, sf_dir):
    """Every row of the three load files, list columns as text; a column that a file lacks is null."""
    out = None
    for kind, df in _processed(spark, sf_dir).items():
        part = df.withColumn("type", F.lit(kind))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    numbers = ("year", "citationCount", "edition", "number_reviewers", "corresponding_author")
    return out.select(*[F.col(c).cast("bigint").alias(c) for c in numbers], "type", "paperId", "title", "url",
                      "abstract", "venue", "approved", "publicationTypes", "proceedings", "journal_name",
                      "journal_volume", "keywords", "authorIds", "reviewers", "comments", "Citations")


@register("scc_loaded_cites")
def q_scc_loaded(spark, sf_dir):
    """SCC of the CITES graph built from the load files: string keys, and the
    cited ids without a Paper row (stubs) as singleton components."""
    rows = _narrow_load_rows(spark, sf_dir, "Citations")  # what nodes and edges of CITES are made of
    papers = gb.paper_nodes(rows).select("paperId")
    edges, stubs = gb.cites_edges(rows, papers, papers_from_rows=True, cut=True)
    g = Graph(paper=gb.with_stubs(papers, stubs), cites=edges)
    return algorithms.scc_with_component_keys(algorithms.cites_projection(g)).select(
        F.col("key").alias("paperId"), F.col("componentKey").alias("componentId"))
