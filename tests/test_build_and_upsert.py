"""Upsert rules, list parsing and graph building on hand-made load rows."""

from pyspark.sql import functions as F

from conftest import rows
from bibgraph.operators import graph_build as gb
from bibgraph.operators.upsert import (dedupe_keep_first, merge_edges_last_wins,
                                       merge_nodes_first_wins)

LOAD_SCHEMA = ("kind string, row_no bigint, paperId string, title string, url string, "
               "abstract string, year string, citationCount string, authorIds string, "
               "corresponding_author string, venue string, approved string, reviewers string, "
               "comments string, proceedings string, edition string, journal_name string, "
               "journal_volume string, keywords string, Citations string")


def load_rows(spark, data):
    return spark.createDataFrame(data, LOAD_SCHEMA)


def authors_rows(spark, data):
    return spark.createDataFrame(
        data, "authorId string, name string, Affiliations string, Affiliation_type string, "
              "row_no bigint, file_no int")


def sample(spark):
    r = load_rows(spark, [
        ("Conference", 1, "p1", "T1", "u1", "ab", "2020.0", "3", "1, 2, 3", "1", "Rome", "Y",
         "4, 5", "ok;fine", "Proc 5th", "5", None, "", " x , y,,", "p2, zz"),
        ("Conference", 2, "p1", "T1b", "u1b", "ab", "2021", "4", "1", "1", "Oslo", "N",
         "4", "meh", "Proc 5th", "6", None, "", "x", ""),
        ("Journal", 1, "p2", "T2", "u2", None, "bad", "7", "2", "2", "Bern", "Y",
         "1", "good", None, None, "J", "9", "z", None),
        ("Workshop", 1, "p3", None, "u3", "c", "2019", "1", "9", "9", "Kyiv", "Y",
         "1, 2", "x;y", "", "2", None, "", "w", "p1"),
    ])
    a = authors_rows(spark, [("1", "Ann", "Org1", "university", 1, 0),
                             ("2", "Bob", "Org2", "company", 2, 0),
                             ("4", "Dan", None, "company", 3, 0),
                             ("5", "Eve", "Org1", "university", 4, 0),
                             ("1", "Ann2", "Org9", "company", 5, 0)])
    return r, a


def test_first_writer_nodes_and_int_conversion(spark):
    r, a = sample(spark)
    papers = gb.paper_nodes(r)
    assert rows(papers, "paperId", "title", "url", "year", "citationCount") == [
        ("p1", "T1", "u1", 2020, 3), ("p2", "T2", "u2", None, 7), ("p3", None, "u3", 2019, 1)]
    assert rows(gb.author_nodes(a), "authorId", "name") == [
        ("1", "Ann"), ("2", "Bob"), ("4", "Dan"), ("5", "Eve")]


def test_wrote_needs_both_ends_and_flags_corresponding(spark):
    r, a = sample(spark)
    papers, authors = gb.paper_nodes(r), gb.author_nodes(a)
    assert rows(gb.wrote_edges(r, papers, authors)) == [
        ("1", "p1", True), ("2", "p1", False), ("2", "p2", True)]


def test_reviewers_trim_flag(spark):
    r, a = sample(spark)
    papers, authors = gb.paper_nodes(r), gb.author_nodes(a)
    assert rows(gb.reviewed_edges(r, papers, authors)) == [
        ("1", "p2"), ("1", "p3"), ("2", "p3"), ("4", "p1"), ("5", "p1")]
    # untrimmed: only the first list item can match (" 5" and " 2" do not)
    assert rows(gb.reviewed_edges(r, papers, authors, trim=False)) == [
        ("1", "p2"), ("1", "p3"), ("4", "p1")]


def test_review_evolution_last_writer(spark):
    r, a = sample(spark)
    papers, authors = gb.paper_nodes(r), gb.author_nodes(a)
    old = gb.reviewed_edges(r, papers, authors)
    ev = gb.reviewed_edges_evolved(r, papers, authors, existing=old)
    assert rows(ev.where("authorId = '4'")) == [("4", "p1", "N", "meh")]


def test_venues_published_in_and_stubs(spark):
    r, a = sample(spark)
    papers = gb.paper_nodes(r)
    assert rows(gb.venue_nodes(r)) == [("Conference", "Proc 5th"), ("Journal", "J")]
    pub = gb.published_in_edges(r, papers)
    assert rows(pub, "paperId", "kind", "edition", "venue", "journal_volume") == [
        ("p1", "Conference", 6, "Oslo", None), ("p2", "Journal", None, "Bern", "9")]
    edges, stubs = gb.cites_edges(r, papers)
    assert rows(edges) == [("p1", "p2"), ("p1", "zz"), ("p3", "p1")]
    assert rows(stubs) == [("zz",)]
    assert gb.with_stubs(papers, stubs).count() == 4


def test_keywords_trimmed_and_nonempty(spark):
    r, _ = sample(spark)
    assert rows(gb.contains_edges(r, gb.paper_nodes(r))) == [
        ("p1", "x"), ("p1", "y"), ("p2", "z"), ("p3", "w")]
    assert (" x ",) in rows(gb.keyword_nodes(r))


def test_load_twice_equals_load_once(spark):
    r, a = sample(spark)
    g1 = gb.build_graph(r, a)
    g2 = gb.build_graph(r.unionByName(r), a.unionByName(a))
    for name, df in g1.tables().items():
        assert rows(df) == rows(g2.tables()[name]), name


def test_reset_keeps_schemas(spark):
    r, a = sample(spark)
    g = gb.build_graph(r, a)
    empty = gb.reset_graph(g)
    for name, df in empty.tables().items():
        assert df.count() == 0 and df.schema == g.tables()[name].schema


def test_merge_against_existing(spark):
    old_nodes = spark.createDataFrame([("a", "old")], "k string, v string")
    rows_ = spark.createDataFrame([("a", "new", 0, 1), ("b", "b1", 0, 2), ("b", "b0", 0, 1)],
                                  "k string, v string, file_no int, row_no int")
    assert rows(merge_nodes_first_wins(rows_, "k", ["v"], existing=old_nodes)) == [
        ("a", "old"), ("b", "b0")]
    old_edges = spark.createDataFrame([("a", "x", "keep"), ("c", "y", "stay")],
                                      "k string, p string, q string")
    new = spark.createDataFrame([("a", None, 0, 1), ("b", "z", 0, 1)],
                                "k string, p string, file_no int, row_no int")
    out = merge_edges_last_wins(new, ["k"], ["p"], existing=old_edges)
    assert rows(out, "k", "p", "q") == [("a", None, "keep"), ("b", "z", None), ("c", "y", "stay")]


def test_dedupe_keep_first(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 2, "b"), (2, 9, "z")],
                               "k int, o int, v string")
    assert rows(dedupe_keep_first(df, ["k"], ["o"])) == [(1, 2, "b"), (2, 9, "z")]


def test_load_files_csv_round_trip_builds_same_graph(spark):
    from conftest import SF0001
    from bibgraph.session import scratch_path
    from bibgraph.sources.load_files import (author_load_rows, paper_load_rows,
                                             read_load_files, write_load_files)
    from bibgraph.sources.tables import Tables

    t = Tables(spark, SF0001)
    rows_, arows = paper_load_rows(t), author_load_rows(t)
    paths = write_load_files(rows_, scratch_path(spark, "lf-test"))
    back = read_load_files(spark, paths)
    assert "proceedings" in back.columns and "journal_volume" in back.columns
    g1 = gb.build_graph(rows_, arows, write_inputs=False)
    g2 = gb.build_graph(back, arows, write_inputs=False)
    for name in ("paper", "wrote", "published_in", "cites", "contains", "reviewed"):
        assert rows(g1.tables()[name]) == rows(g2.tables()[name]), name


def test_read_load_file_without_order_column(spark):
    import os

    from bibgraph.session import scratch_path
    from bibgraph.sources.load_files import read_load_files

    base = scratch_path(spark, "lf-noorder").replace("file:", "")
    os.makedirs(base)
    with open(f"{base}/journal_info.csv", "w") as f:
        f.write("paperId,title,year\np1,First,2020\np1,Second,2021\np2,Other,2019\n")
    back = read_load_files(spark, {"Journal": f"{base}/journal_info.csv"})
    assert back.columns == ["paperId", "title", "year", "row_no", "kind"]
    nodes = gb.paper_nodes(back.withColumn("url", F.lit(None).cast("string"))
                           .withColumn("abstract", F.lit(None).cast("string"))
                           .withColumn("citationCount", F.lit(None).cast("string")))
    assert rows(nodes, "paperId", "title", "year") == [("p1", "First", 2020), ("p2", "Other", 2019)]


def test_existing_edges_without_properties_are_not_joined(spark):
    """One aggregate, no shuffle but those that made its inputs; null and repeated keys as in an outer join."""
    authors = spark.createDataFrame([("a",), ("b",)], "authorId string").distinct()
    old = spark.createDataFrame([("a", "p"), ("a", "q"), ("a", "q"), ("z", "p")], "authorId string, paperId string")
    new = spark.createDataFrame([("a", "p", 0, 1, "x"), ("a", "p", 0, 2, "y"), ("b", "p", 0, 1, None), ("a", "q", 1, 1, "w"),
                                 ("z", "q", 0, 1, "no")],
                                "authorId string, paperId string, file_no int, row_no long, v string")
    known = lambda df: df.join(authors.hint("merge"), "authorId", "left_semi")
    out = merge_edges_last_wins(known(new), ["authorId", "paperId"], ["v"], existing=known(old).select("authorId", "paperId"))
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in text and "hashpartitioning(authorId" in text and ", paperId" not in "".join(
        line for line in text.splitlines() if "Exchange" in line)
    assert sorted(map(tuple, out.collect()), key=str) == [
        ("a", "p", "y"), ("a", "q", "w"), ("a", "q", "w"), ("b", "p", None)]
    frame = lambda data: spark.createDataFrame(data, "k string, file_no int, row_no long, v string")
    nulls = merge_edges_last_wins(frame([(None, 0, 1, "x"), (None, 0, 2, "y"), ("k", 0, 1, "z")]), ["k"], ["v"],
                                  existing=spark.createDataFrame([(None,), (None,), ("l",)], "k string"))
    assert sorted(map(tuple, nulls.collect()), key=str) == sorted(
        [(None, None), (None, None), (None, "y"), ("k", "z"), ("l", None)], key=str)
