"""Awkward values: blanks and markers in CSV, headers in different order, bad numbers, repeated keys."""

import duckdb
import pytest
from conftest import SF0001, rows
from pyspark.sql import functions as F

from bibgraph.functions.columns import hash_draw, parse_list_literal, to_int
from bibgraph.graph import Graph
from bibgraph.operators import clean, synth
from bibgraph.operators.authors import process_authors
from bibgraph.operators.graph_algorithms import EdgeSet, pagerank
from bibgraph.operators.graph_build import graph_counts, paper_nodes
from bibgraph.operators.ranked import numbered, with_neighbours
from bibgraph.plans.algorithms import cites_projection
from bibgraph.plans.queries import REGISTRY
from bibgraph.sources import csv_io, payloads
from bibgraph.sources.load_files import read_load_files
from bibgraph.streaming.incremental_load import _existing_keys, start_paper_load


def test_csv_keeps_blanks_markers_and_breaks(spark, tmp_path):
    texts = ["  lead", "trail  ", "\\N", "", None, "a\nb", 'say "x", y', " Big Data", "\t", "\\", '"']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    csv_io.write_csv(df, str(tmp_path / "c"))
    back = csv_io.read_csv(spark, str(tmp_path / "c"), "i int, t string")
    assert rows(back) == rows(df)


def _write(path, text):
    path.write_text(text)
    return str(path)


def test_load_files_are_read_by_their_own_headers(spark, tmp_path):
    a = _write(tmp_path / "conference_info_1.csv", "paperId,title,year\np1,first,2020\np2,x,2019\n")
    b = _write(tmp_path / "conference_info_2.csv",
               "paperId,year,title\np1,2021,second\np3,2018,third\n" + "".join(
                   f"q{i},2000,pad pad pad\n" for i in range(400)))
    got = read_load_files(spark, {"Conference": [b, a]})
    by_id = {(r["paperId"], r["title"]): r["year"] for r in got.collect()}
    assert by_id[("p1", "first")] == "2020" and by_id[("p1", "second")] == "2021"
    full = got
    for c in ("url", "abstract", "citationCount"):
        full = full.withColumn(c, F.lit(None).cast("string"))
    nodes = {r["paperId"]: r["title"] for r in paper_nodes(full).collect()}
    assert nodes["p1"] == "first" and nodes["p3"] == "third" and len(nodes) == 403
    assert read_load_files(spark, {"Conference": str(tmp_path)}).count() == got.count()


def test_stream_rejects_unknown_files_and_read_errors(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _write(tmp_path / "in" / "strange.csv", "paperId\np1\n")
    query = start_paper_load(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck"))
    with pytest.raises(Exception, match="kind of load file"):
        query.awaitTermination(60)
    assert _existing_keys(spark, str(tmp_path / "none"), 3) is None
    bad = tmp_path / "bad" / "batch_id=0"
    bad.mkdir(parents=True)
    _write(bad / "part-0.parquet", "not parquet")
    with pytest.raises(Exception):
        _existing_keys(spark, str(tmp_path / "bad"), 3).count()


def test_to_int_never_aborts(spark):
    df = spark.createDataFrame([(v,) for v in ("NaN", "Infinity", "1e30", "2023.0", "x", "-7.9", None)], "v string")
    assert [r[0] for r in df.select(to_int("v")).collect()] == [None, None, None, 2023, None, -7, None]


def test_list_literals_keep_quoted_none_and_escapes(spark):
    cases = {"['None such', None]": ["None such", None], r"['caf\xe9','x']": ["café", "x"],
             "['a', \"it's\"]": ["a", "it's"], r"['it\'s']": ["it's"], "[]": [], "[1, 2]": ["1", "2"],
             r"['a\\x41']": [r"a\x41"], r"['\U000000e9']": ["é"], "nothing": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert [r[0] for r in df.select(parse_list_literal("v")).collect()] == list(cases.values())
    with pytest.raises(Exception, match="not a list literal"):
        df.select(parse_list_literal("v", fail_on_bad=True)).collect()


def test_draws_reach_past_32_bits_and_rows_draw_for_themselves(spark):
    top = spark.range(200).select(hash_draw("id", seed="s").alias("d")).agg(F.min("d"), F.max("d")).first()
    assert top[0] >= 0 and 2**59 < top[1] < 2**60
    # an index above 2**32 of a pool that large is reached
    offset = spark.range(200).select(F.pmod(hash_draw("id", seed="s"), F.lit(2**34)).alias("i"))
    assert offset.filter(F.col("i") > 2**32).count() > 100


def test_sampler_with_repeated_keys_and_scarce_rows(spark):
    want = spark.createDataFrame([("a", 3), ("a", 3), ("b", 1), ("c", 9)], "k string, n int")
    pool = spark.createDataFrame([(str(i),) for i in range(9)], "p string")
    out = [(None, "x")]
    out = spark.createDataFrame([("c", str(i)) for i in range(7)], "k string, p string")
    got = synth.pick_from_pool(want, "k", "n", pool, "p", seed="s", exclude=out, slack=0)
    counts = {r["k"]: r["count"] for r in got.groupBy("k").count().collect()}
    assert counts == {"a": 3, "b": 1, "c": 2}
    assert got.select("k", "pick").distinct().count() == 6


def test_order_and_neighbours_cross_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("v"))
    got = {r["v"]: (r["n"], r["_prev"], r["_next"]) for r in with_neighbours(df, ["v"], "n").collect()}
    assert all(got[v][0] == v for v in range(1000))
    assert all(got[v][1]["v"] == v - 1 for v in range(1, 1000)) and got[0][1] is None
    assert all(got[v][2]["v"] == v + 1 for v in range(999)) and got[999][2] is None
    assert numbered(df.limit(0), ["v"]).count() == 0


def test_projection_drops_dangling_edges_for_every_key_type(spark):
    def ranks(kind):
        nodes = spark.createDataFrame([(1,), (2,)], "paperId bigint").select(F.col("paperId").cast(kind))
        edges = spark.createDataFrame([(99, 1), (1, 2)], "src bigint, dst bigint").select(
            *(F.col(c).cast(kind) for c in ("src", "dst")))
        proj = cites_projection(Graph(paper=nodes, cites=edges))
        assert proj.counts().first()["relationshipCount"] == 1
        return sorted((str(r["key"]), round(r["score"], 6)) for r in pagerank(proj).collect())
    assert ranks("bigint") == ranks("string") == [("1", 0.15), ("2", 0.2775)]


def test_hot_source_is_split_over_salts(spark):
    edges = spark.range(500).select(F.lit(1).cast("bigint").alias("src"), F.col("id").alias("dst")).unionByName(
        spark.range(5).select((F.col("id") + 10).alias("src"), F.lit(1).cast("bigint").alias("dst")))
    held = EdgeSet(edges, hot_edges=50)
    sizes = {(r["src"], r["salt"]): r["count"] for r in held.edges.groupBy("src", "salt").count().collect()}
    assert sum(sizes.values()) == 505 and sum(k[0] == 1 for k in sizes) == 10
    held.release()


def test_every_lineitem_row_is_a_load_row_and_a_position(spark):
    from bibgraph.sources.fixtures import lineitem_positions
    from bibgraph.sources.load_files import paper_load_rows
    from bibgraph.sources.tables import Tables

    t = Tables(spark, SF0001)
    placed = lineitem_positions(t)
    n = t.lineitem.count()
    assert placed.count() == n and placed.select("row_no").distinct().count() == n
    typed = duckdb.sql(f"SELECT count(*) FROM '{SF0001}/lineitem.parquet' l JOIN '{SF0001}/part.parquet' p "
                       "ON p.p_partkey = l.l_partkey JOIN "
                       f"'{SF0001}/orders.parquet' o ON o.o_orderkey = l.l_orderkey").fetchall()[0][0]
    assert paper_load_rows(t).count() <= typed


def test_duplicate_papers_fall_together(spark):
    df = spark.createDataFrame([("p1", "B", "t"), ("p1", "A", "t"), ("p2", "B", "u"), (None, "A", "v")],
                               "paperId string, field_query string, title string")
    assert rows(clean.dedupe_papers(df)) == [("p1", "A", "t"), ("p2", "B", "u")]


def test_pages_and_authors(spark):
    pages = spark.createDataFrame([('{"data":[{"paperId":"a","venue":{"name":"V"},"publicationTypes":["X","it\'s"],'
                                    '"abstract":"q","year":2020,"citationCount":4,"url":"u"},'
                                    '{"paperId":"b","venue":"W"}]}',), ('{"offset": 3}',)], "page string")
    got = {r["paperId"]: r for r in payloads.flatten_papers(payloads.explode_pages(pages)).collect()}
    assert len(got) == 2 and got["a"]["venue"] == "V" and got["b"]["venue"] == "W"
    assert got["a"]["publicationTypes"] == "['X', 'it\\'s']" and got["b"]["publicationTypes"] is None
    assert (got["a"]["year"], got["a"]["citationCount"], got["a"]["url"]) == (2020, 4, "u")
    raw = spark.createDataFrame([("7", "n1", 2), ("7.0", "n0", 1), (None, "x", 1), ("8", "m", 1)],
                                "authorId string, name string, position int")
    names = lambda p, n: spark.createDataFrame(
        [(f"{p}{i}", i) for i in range(n)], "affiliation string, position int")
    out = {r["authorId"]: r for r in process_authors(raw, names("u", 60), names("c", 60)).collect()}
    assert set(out) == {7, 8} and out[7]["name"] == "n0"
    assert all(("university" if r["Affiliations"][0] == "u" else "company") == r["Affiliation_type"]
               for r in out.values())


def test_counts_of_empty_tables_and_partial_projection(spark):
    empty = Graph(paper=spark.createDataFrame([], "paperId string"))
    assert [tuple(r) for r in graph_counts(empty).collect() if r["table"] == "paper"] == [("paper", 0)]
    got = {r["keys"]: tuple(r)[:2] for r in REGISTRY["project_partial"](spark, SF0001).collect()}
    assert got["integer"] == got["text"]
