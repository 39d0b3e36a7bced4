"""Substring membership, sampling by rank, named projections."""

import os
import random
from collections import Counter

import pytest
from conftest import rows

from bibgraph.operators import profile, synth
from bibgraph.operators.graph_algorithms import Projection, ProjectionCatalog, pagerank, strongly_connected_components
from bibgraph.session import scratch_database


@pytest.mark.parametrize("gram", [1, 3, 12])
def test_substring_counts_equal_brute_force(spark, gram):
    rng = random.Random(gram)
    texts = [", ".join(str(rng.randrange(300)) for _ in range(rng.randint(0, 4))) for _ in range(200)]
    texts += ["a long identifier 0123456789", "prefix a long identifier 0123456789 suffix", "é😀é", None, ""] * 2
    ids = [str(i) for i in range(0, 320, 3)] + ["long identifier 0123456", "identifier 0123456788", "😀é", "", None, "1", "1",
                                                ", ", "zzz"]
    got = profile.substring_counts(spark.createDataFrame([(t,) for t in texts], "t string"), "t",
                                   spark.createDataFrame([(i,) for i in ids], "authorId string"), gram=gram)
    expected = [(i, sum(i in t for t in texts if t is not None)) for i in {i for i in ids if i is not None}]
    assert rows(got, "authorId", "n_rows") == sorted(expected)
    empty = spark.createDataFrame([], "t string")
    assert rows(profile.substring_counts(empty, "t", spark.createDataFrame([("a",), ("",)], "authorId string"))) == [
        ("", 0), ("a", 0)]


def test_pick_by_rank_with_one_eligible_member(spark):
    n = 20_000
    pool = spark.range(n).withColumnRenamed("id", "p")
    wanted = spark.createDataFrame([(1, 5), (2, 3), (3, 0), (None, 2), (2, 1)], "r long, k int")
    # row 1 may only pick 12345; row 2 everything but even members
    exclude = (spark.range(n).where("id <> 12345").selectExpr("1L as r", "id as p")
               .unionByName(spark.range(0, n, 2).selectExpr("2L as r", "id as p"))
               .unionByName(spark.createDataFrame([(2, 4), (2, -1), (9, 1)], "r long, p long")))
    got = synth.pick_by_rank(wanted, "r", "k", pool, "p", "seed", exclude=exclude).collect()
    assert [(r["rank"], r["pick"]) for r in got if r["r"] == 1] == [(1, 12345)]
    second = sorted((r["rank"], r["pick"]) for r in got if r["r"] == 2)
    assert [k for k, _ in second] == [1, 2, 3] and len({p for _, p in second}) == 3
    assert all(p % 2 for _, p in second) and {r["r"] for r in got} == {1, 2}


def test_pick_by_rank_is_uniform_and_distinct(spark):
    pool = spark.range(12).withColumnRenamed("id", "p")
    wanted = spark.range(4000).selectExpr("id as r", "5 as k")
    got = synth.pick_by_rank(wanted, "r", "k", pool, "p", "u", self_excluded=True).collect()
    by_row = {}
    for r in got:
        by_row.setdefault(r["r"], set()).add(r["pick"])
    assert len(by_row) == 4000 and all(len(s) == 5 and r not in s for r, s in by_row.items())
    share = Counter(r["pick"] for r in got if r["r"] >= 12)
    assert all(0.9 < share[p] * 12 / (5 * 3988) < 1.1 for p in range(12))
    every = synth.pick_by_rank(spark.createDataFrame([(50, 99)], "r long, k int"), "r", "k", pool, "p", "u")
    assert sorted(r["pick"] for r in every.collect()) == list(range(12))
    assert synth.pick_by_rank(wanted, "r", "k", pool.limit(0), "p", "u").count() == 0


@pytest.mark.parametrize("loops", [False, True])
def test_named_projection_is_shared_and_dropped_with_its_files(spark, loops):
    rng = random.Random(3)
    edges = [(rng.randrange(30), rng.randrange(30)) for _ in range(60)]
    edges = [(a, b) for a, b in edges if loops or a != b] + ([(1, 1)] if loops else [])
    proj = Projection(spark.range(30).selectExpr("id", "'Paper' as label", "id as key"),
                      spark.createDataFrame(edges, "src long, dst long"))
    score = lambda p: [(i, round(s, 9)) for i, s in rows(pagerank(p), "id", "score")]
    parts = lambda p: rows(strongly_connected_components(p), "id", "componentId")
    catalog = ProjectionCatalog(spark)
    named = catalog.project("g", proj)
    with pytest.raises(ValueError):
        catalog.project("g", proj)
    db = scratch_database(spark)
    tables = lambda: {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {db}").collect()}
    held = tables()
    assert score(named) == score(proj) and parts(catalog.get("g")) == parts(proj)
    assert score(named) == score(proj)  # still there after a run of each
    assert tables() == held and catalog.names() == ["g"]
    place = spark.sql(f"DESCRIBE DATABASE {db}").where("info_name = 'Location'").first()["info_value"].replace("file:", "")
    before = {t for t in os.listdir(place) if t in held}
    catalog.drop("g")
    assert before and not {t for t in os.listdir(place) if t in held} and catalog.names() == []
    with pytest.raises(KeyError):
        catalog.get("g")
