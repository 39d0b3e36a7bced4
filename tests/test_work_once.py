"""Steps that are done once, without a shuffle or a sort where none is needed."""
import glob
import random
import time

import pytest
from pyspark.sql import functions as F

from bibgraph.operators import graph_algorithms as ga
from bibgraph.operators import graph_build as gb
from bibgraph.operators import keywords as kw
from bibgraph.sources import load_files, split_csv


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def noted(monkeypatch, module):
    """Names of the tables that a module writes from now on, and their plans."""
    seen, real = [], module.written

    def written(df, name):
        seen.append((name, plan(df)))
        return real(df, name)

    monkeypatch.setattr(module, "written", written)
    return seen


DOCS = [(1, "a gear b gear. bolt the", "NLP"), (2, None, "x"), (3, None, None), (4, "", None),
        (5, "one two three four five five", "Three"), (6, "one two three four five", "zz"), (7, "k k", "k"),
        (8, "The the", None), (None, "q q r", "f"), (10, "w", "")]
TWICE = [(9, "dup one", "f"), (9, "dup two two", "g"), (None, "zz zz", "h")]


def test_keywords_of_own_keys_are_counted_in_their_rows(spark):
    frame = lambda rows: spark.createDataFrame(rows, "doc_id long, text string, field_query string")
    out = kw.extract_keywords(frame(DOCS))
    assert not any(step in plan(out) for step in ("Aggregate", "Window", "Join"))
    assert {(r["rank"], r["term"]) for r in out.where("doc_id = 6").collect()} == {
        (1, "one"), (2, "two"), (3, "three"), (4, "zz")}
    for rows in (DOCS, DOCS + TWICE):
        for field, n in (("field_query", 4), (None, 2)):
            f = F.lower("field_query") if field else F.lit(None).cast("string")
            src = frame(rows).select("doc_id", f.alias("_f"), "text")
            grouped = kw._grouped_keywords(src, "doc_id", "text", field, n, None, None)
            got = kw.extract_keywords(frame(rows), field=field, n=n)
            assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, grouped.collect())))


def test_raking_holds_few_copies_of_the_cells(spark, monkeypatch):
    mixing = pytest.importorskip("bibgraph.llm.mixing")
    cells = [(f"s{i % 3}", f"l{i % 5}", f"t{i % 4}", 10 + i) for i in range(60)]
    docs = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    seen = noted(monkeypatch, mixing)
    assert mixing.rates(docs, cycles=2).count() == len({c[:3] for c in cells})
    steps = [p for name, p in seen if name == "cells"]
    assert max(p.count("Join") for p in steps) <= 2 and len(steps) == 2 + 2 * 3


def test_lines_of_plain_blocks_are_not_shuffled_and_parsed_once(spark, tmp_path, monkeypatch):
    (tmp_path / "plain.csv").write_text('k,t\n1,"a ""b"" c"\n2,d\n3,e,f\n')
    seen = noted(monkeypatch, split_csv)
    rows, rejects = split_csv.read_by_header(spark, [str(tmp_path / "plain.csv")])
    assert [name for name, _ in seen] == ["blocks", "csv_files", "csv_rows"]
    assert [tuple(r) for r in rows.orderBy("_order").select("k", "t").collect()] == [("1", 'a "b" c'), ("2", "d")]
    assert [(r["pos"], r["record"]) for r in rejects.collect()] == [(3, "3,e,f")]
    assert "csv_to_struct" not in plan(rows).lower() and "csvtostructs" not in plan(rows).lower()
    (tmp_path / "long.csv").write_text('t,k\n"x\ny",4\n"z",5\n')
    both, _ = split_csv.read_by_header(spark, [str(tmp_path / "plain.csv"), str(tmp_path / "long.csv")])
    assert {tuple(r) for r in both.select("k", "t").collect()} == {
        ("1", 'a "b" c'), ("2", "d"), ("4", "x\ny"), ("5", "z")}


def test_load_rows_are_derived_once_for_all_files(spark, tmp_path, monkeypatch):
    seen = noted(monkeypatch, load_files)
    rows = spark.range(6).selectExpr("element_at(array('Conference','Journal','Workshop'), int(id % 3) + 1) kind",
                                     "id row_no", "string(id) paperId", "'p' proceedings", "'1' edition",
                                     "'j' journal_name", "'v' journal_volume")
    paths = load_files.write_load_files(rows, str(tmp_path / "files"))
    assert [name for name, _ in seen] == ["load_rows"]
    assert load_files.read_load_files(spark, paths).count() == 6


def brute_force(n, edges):
    reach = [{i} for i in range(n)]
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            if not reach[b] <= reach[a]:
                reach[a] |= reach[b]
                moved = True
    return sorted((i, min(j for j in reach[i] if i in reach[j])) for i in range(n))


@pytest.mark.parametrize("degree", [1, 8])
def test_components_of_dense_and_thin_graphs(spark, monkeypatch, degree):
    rng = random.Random(degree)
    edges = [(rng.randrange(40), rng.randrange(40)) for _ in range(40 * degree)]
    edges += [(40, 41), (41, 42), (42, 40), (42, 3), (5, 43), (43, 44), (44, 43), (45, 45)]
    proj = ga.Projection(spark.range(48).selectExpr("id", "'Paper' as label", "id as key"),
                         spark.createDataFrame(edges, "src long, dst long"))
    swept, real = [], ga._around
    monkeypatch.setattr(ga, "_around", lambda *a: swept.append(1) or real(*a))
    got = sorted(tuple(r) for r in ga.strongly_connected_components(proj).select("id", "componentId").collect())
    assert got == brute_force(48, edges) and len(swept) == (degree == 8)


def test_a_round_sorts_no_edges(spark):
    es = ga.EdgeSet(spark.createDataFrame([(i, i + 1) for i in range(50)], "src long, dst long"))
    sent = es.messages(spark.range(50).select("id", F.lit(1).alias("c")), ["c"])
    text = es.messages(spark.range(50).select("id", F.lit("x").alias("c")), ["c"])
    assert "ShuffledHashJoin [src" in sent._jdf.queryExecution().toString()
    assert "ShuffledHashJoin [src" not in text._jdf.queryExecution().toString()  # text may not fit in memory
    assert sent.count() == text.count() == 50
    es.release()


def test_a_batch_tells_stubs_without_pairs(spark, tmp_path):
    from bibgraph.streaming.graph_store import PAPER_COLUMNS, GraphStore, with_columns

    rows = spark.createDataFrame([("Journal", 1, "a", "b, c"), ("Journal", 2, "a", "b")],
                                 "kind string, row_no long, paperId string, Citations string")
    store = GraphStore(spark, str(tmp_path / "store"), buckets=2)
    writes = store._writes(with_columns(rows, PAPER_COLUMNS), None)
    assert plan(writes["paper"]).count("Aggregate") == 1 and writes["cites"].count() == 2
    assert {(r["paperId"], r["stub"]) for r in writes["paper"].collect()} == {("a", False), ("b", True), ("c", True)}


def test_processed_papers_are_joined_once(spark, monkeypatch):
    from bibgraph.plans import etl, queries

    seen = noted(monkeypatch, etl)
    parts = queries._processed(spark, "/root/testdata/sf0.001")
    assert [name for name, _ in seen].count("processed") == 1 and seen[0][0] == "authors"
    assert not any("Join" in plan(df) for df in parts.values())


def test_draws_are_dealt_over_all_tasks(spark, monkeypatch):
    from bibgraph.operators import synth

    seen = noted(monkeypatch, synth)
    rows = spark.range(100).select(F.col("id").alias("p"), F.lit(3).alias("k"))
    assert synth.pick_from_pool(rows, "p", "k", spark.range(9).toDF("a"), "a", "s").count() == 300
    assert any(name == "picks" and "RepartitionByExpression [p" in p for name, p in seen)


def test_plans_of_rounds_do_not_grow(spark):
    """A round reads one written table: cached rounds nested in each other's plans, whose texts filled the driver."""
    from bibgraph import session

    mat, state, texts, tables = ga.Materializer(), spark.range(20).withColumn("c", F.col("id")), [], []
    for _ in range(4):
        low = state.groupBy((F.col("id") % 7).alias("id")).agg(F.min("c").alias("m"))
        new = state.join(low, "id", "left").select("id", F.least("c", F.coalesce("m", "c")).alias("c"))
        texts.append(new._jdf.queryExecution().toString())
        state = mat(new)
        tables.append(session.scratch_tables(state))
    assert not any("InMemoryRelation" in t for t in texts) and abs(len(texts[3]) - len(texts[1])) < 100
    assert all(len(t) == 1 for t in tables) and len({t[0] for t in tables}) == 4
    exists = lambda path: (p := spark._jvm.org.apache.hadoop.fs.Path(path)).getFileSystem(
        spark._jsc.hadoopConfiguration()).exists(p)
    assert [exists(t[0]) for t in tables] == [False, False, True, True]
    mat.close()
    assert not any(exists(t[0]) for t in tables)


def test_values_are_not_shuffled_to_look_up_buckets(spark):
    edges = spark.createDataFrame([(1, i) for i in range(9)] + [(2, 1), (None, 3)], "src long, dst long")
    values = spark.createDataFrame([(1, 5), (2, 6), (3, 7), (None, 8)], "id long, c int")
    for hot_edges, most in ((None, 1), (4, 2)):
        es = ga.EdgeSet(edges, hot_edges)
        sent = es.messages(values, ["c"])
        assert plan(sent).count("Join") == most  # the edges, and a broadcast of hot sources if there are any
        assert sorted(tuple(r) for r in sent.collect()) == sorted([(i, 5) for i in range(9)] + [(1, 6)])
        es.release()


def shuffle_files(spark):
    tops = [d.getAbsolutePath() for d in
            spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {f for d in tops for f in glob.glob(f"{d}/*/shuffle_*.data")}


def test_written_tables_leave_no_shuffle_files(spark):
    from bibgraph import session

    before, setting = shuffle_files(spark), spark.conf.get(session.SHUFFLE_CLEANUP)
    out = session.written(spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 9).alias("k")).count(), "counts")
    for _ in range(50):  # they are removed in the background
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and out.count() == 9 and spark.conf.get(session.SHUFFLE_CLEANUP) == setting


def test_parts_of_the_keys_are_done_one_by_one(spark, monkeypatch):
    from bibgraph import session

    monkeypatch.setattr(session, "PART_ROWS", 100)
    seen = noted(monkeypatch, session)
    keys = spark.range(50).selectExpr("string(id) a").distinct()
    rows = spark.range(400).selectExpr("string(id % 60) a", "id")
    step = lambda some: rows.join(some, "a", "left_semi")
    assert sorted(map(tuple, session.in_parts(keys, "a", 400, step).collect())) == sorted(map(tuple, step(keys).collect()))
    assert len(seen) == session.PARTS == 3
    assert all(p.count("pmod(xxhash64(") == 2 for _, p in seen)  # rows of other parts are left out before the shuffle
    assert len(session.scratch_tables(session.in_parts(keys, "a", 99, step))) == 0


def test_reviewed_edges_in_parts(spark, monkeypatch):
    from bibgraph import session
    from bibgraph.plans.queries import REGISTRY

    whole = REGISTRY["reviewed_edges_evolved"](spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(session, "PART_ROWS", 1 << 10)
    parts = REGISTRY["reviewed_edges_evolved"](spark, "/root/testdata/sf0.001")
    assert len(session.scratch_tables(parts)) == 3 and len(session.scratch_tables(whole)) == 1
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, parts.collect()), key=str)


def test_load_files_are_packed_and_tables_they_came_from_go(spark, tmp_path, monkeypatch):
    from bibgraph import session
    from bibgraph.sources import csv_io

    monkeypatch.setattr(csv_io, "TASK_ROWS", 4)
    rows = session.written(spark.range(30).selectExpr("'Journal' kind", "id row_no", "string(id) paperId", "'a\nb' title",
                                                      "'1' edition", "'p' proceedings", "'j' journal_name",
                                                      "'v' journal_volume").coalesce(1), "lines")
    held = session.scratch_tables(rows)[0]
    paths = load_files.write_load_files(rows, str(tmp_path / "files"), own=True)
    files = sorted(p.name for p in (tmp_path / "files" / "journal_info").glob("part-*"))
    assert len(files) == 8 and all(f.endswith(".csv.gz") for f in files)
    assert not spark._jvm.java.io.File(held.removeprefix("file:")).exists()
    back = load_files.read_load_files(spark, paths)
    assert sorted((r["row_no"], r["paperId"], r["title"]) for r in back.collect()) == [
        (i, str(i), "a\nb") for i in range(30)]


def test_tables_of_a_graph_are_counted_one_after_the_other(spark, monkeypatch):
    from bibgraph.graph import Graph

    seen = noted(monkeypatch, gb)
    g = Graph(paper=spark.range(3).toDF("paperId"), keyword=spark.range(2).selectExpr("string(id) text"))
    assert {tuple(r) for r in gb.graph_counts(g).collect()} == {("paper", 3), ("keyword", 2)}
    assert [name for name, _ in seen] == ["count", "count"]
