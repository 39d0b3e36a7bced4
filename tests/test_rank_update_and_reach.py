"""PageRank after a MERGE and reach sketches against brute force."""

import random

import pytest
from test_graph_algorithms import brute_pagerank, proj_of

from bibgraph.operators.graph_algorithms import Projection, ProjectionCatalog
from bibgraph.operators.rank_update import update_pagerank
from bibgraph.operators.reach_sketch import reach_estimates, relative_error


def edges_of(spark, edges):
    return spark.createDataFrame(sorted(edges) or [], "src bigint, dst bigint")


def test_update_equals_a_full_run(spark):
    rnd = random.Random(8)
    n = 60
    before = {(rnd.randrange(n - 1), rnd.randrange(n - 1)) for _ in range(90)} | {(0, v) for v in range(1, 20)}
    added = {(0, 30), (0, 31), (41, 2), (59, 58)} - before  # a hot source, a source that had no edge at all
    removed = set(sorted(before)[3:6]) | {e for e in before if e[0] == 7}
    after = (before | added) - removed
    scores = spark.createDataFrame(list(brute_pagerank(n, sorted(before), d=0.5, it=60).items()), "id bigint, score double")
    out = update_pagerank(scores.where("id <> 59"), proj_of(spark, n, sorted(after)), edges_of(spark, added),
                          edges_of(spark, removed), damping=0.5, tol=1e-7, hot_edges=4)
    want = brute_pagerank(n, sorted(after), d=0.5, it=60)
    got = {r["key"]: r["score"] for r in out.scores.collect()}
    assert set(got) == set(range(n))  # 59 is a new vertex
    assert all(abs(got[v] - want[v]) < 1e-6 for v in want)


def test_update_touches_only_what_changed(spark):
    # two rings; the change is in the small one
    ring = [(i, (i + 1) % 40) for i in range(40)]
    small = [(100, 101), (101, 102), (103, 102)]
    keys = sorted({v for e in ring + small for v in e})
    catalog = ProjectionCatalog(spark)
    base = proj_of(spark, 1, [])
    vertices = spark.createDataFrame([(k, "Paper", k) for k in keys], base.vertices.schema)
    added = [(100, 103)]
    after = catalog.project("after", Projection(vertices, edges_of(spark, ring + small + added)))
    scores = spark.createDataFrame([(k, v) for k, v in brute_pagerank(104, ring + small, it=300).items() if k in keys],
                                   "id bigint, score double")
    out = update_pagerank(scores, after, edges_of(spark, added), tol=1e-10)
    full = brute_pagerank(104, ring + small + added, it=300)
    assert all(abs(r["score"] - full[r["id"]]) < 1e-9 for r in out.scores.collect())
    assert out.messages < 10 and out.rounds <= 4  # the ring's forty edges carry nothing
    again = update_pagerank(out.scores.select("id", "score"), after, edges_of(spark, []))
    assert (again.rounds, again.messages) == (0, 0)
    catalog.drop("after")


def brute_reach(n, edges, hops=None):
    out = {}
    for v in range(n):
        seen, front, h = {v}, {v}, 0
        while front and (hops is None or h < hops):
            front = {d for s, d in edges if s in front} - seen
            seen |= front
            h += 1
        out[v] = len(seen) - 1
    return out


@pytest.mark.parametrize("hops", [1, 2, None])
def test_reach_of_small_graphs_is_exact(spark, hops):
    rnd = random.Random(5)
    edges = sorted({(rnd.randrange(40), rnd.randrange(40)) for _ in range(60)} | {(3, 3)})
    got = {r["id"]: r["n_reached"] for r in reach_estimates(proj_of(spark, 40, edges), hops).collect()}
    assert got == brute_reach(40, edges, hops)
    back = {r["id"]: r["n_reached"] for r in
            reach_estimates(proj_of(spark, 40, edges), hops, "backward", hot_edges=3).collect()}
    assert back == brute_reach(40, [(d, s) for s, d in edges], hops)


def test_reach_error_and_edge_cases(spark):
    # a star of 5,000 leaves behind a chain: the estimate is within five standard errors
    edges = [(0, 1), (1, 2)] + [(2, v) for v in range(3, 5003)]
    got = {r["id"]: r["n_reached"] for r in reach_estimates(proj_of(spark, 5003, edges), lg_k=10).collect()}
    assert abs(got[0] - 5002) <= 5 * relative_error(10) * 5002 and got[4000] == 0
    assert {r["n_reached"] for r in reach_estimates(proj_of(spark, 3, [])).collect()} == {0}
    assert reach_estimates(Projection(proj_of(spark, 1, []).vertices.limit(0), edges_of(spark, []))).count() == 0
    with pytest.raises(ValueError):
        reach_estimates(proj_of(spark, 1, []), direction="up")
