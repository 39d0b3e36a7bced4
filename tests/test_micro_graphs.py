"""Hand-made micro-graphs, one per quirk of the reference queries."""

from pyspark.sql import functions as F

from conftest import rows
from bibgraph.graph import Graph
from bibgraph.plans import analytics, recommend


def graph(spark, papers=(), pub=(), cites=(), wrote=(), authors=(), contains=()):
    P = spark.createDataFrame(list(papers) or [], "paperId string, title string")
    PUB = spark.createDataFrame(list(pub) or [],
                                "paperId string, kind string, name string, year bigint, "
                                "edition bigint")
    C = spark.createDataFrame(list(cites) or [], "src string, dst string")
    W = spark.createDataFrame(list(wrote) or [], "authorId string, paperId string")
    A = spark.createDataFrame(list(authors) or [], "authorId string, name string")
    K = spark.createDataFrame(list(contains) or [], "paperId string, keyword string")
    return Graph(paper=P, published_in=PUB, cites=C, wrote=W, author=A, contains=K,
                 keyword=K.select(F.col("keyword").alias("text")).distinct())


def test_top3_drops_null_title_and_short_conferences(spark):
    papers = [("a", "A"), ("b", "B"), ("c", None), ("d", "D"), ("e", "E"), ("f", "F"),
              ("g", "G"), ("h", "H"), ("x", "X")]
    pub = [("a", "Conference", "C1", 2020, 1), ("b", "Conference", "C1", 2020, 1),
           ("c", "Conference", "C1", 2020, 1),                      # null title -> drop C1
           ("d", "Conference", "C2", 2020, 1), ("e", "Conference", "C2", 2020, 1),  # 2 only
           ("f", "Conference", "C3", 2020, 1), ("g", "Conference", "C3", 2020, 1),
           ("h", "Conference", "C3", 2020, 1),
           ("x", "Journal", "C3", 2020, None)]                      # same name, other kind
    cites = [("x", p) for p in "abcdefgh"] + [("a", "h"), ("b", "h"), ("c", "g")] + \
        [(s, "x") for s in "abcdefgh"]
    out = rows(analytics.top3_cited_per_conference(graph(spark, papers, pub, cites)))
    assert out == [("C3", "H", "G", "F")]


def test_top3_none_title_is_dropped_and_ties_by_key(spark):
    papers = [("a", "None"), ("b", "B"), ("c", "C"), ("d", "D"), ("e", "E")]
    pub = [(p, "Conference", "K", 2020, 1) for p in "abcd"]
    cites = [("e", p) for p in "abcd"]
    # all tie with one citation: a, b, c are the top 3 by key, and a's title is 'None'
    assert rows(analytics.top3_cited_per_conference(graph(spark, papers, pub, cites))) == []
    pub2 = [(p, "Conference", "K", 2020, 1) for p in "bcd"]
    out = rows(analytics.top3_cited_per_conference(graph(spark, papers, pub2, cites)))
    assert out == [("K", "B", "C", "D")]


def test_h_index_zero_namesakes_and_keep_zero(spark):
    wrote = [("1", "p1"), ("1", "p2"), ("1", "p3"), ("2", "p4"), ("3", "p1")]
    authors = [("1", "Ann"), ("2", "Bob"), ("3", "Ann")]
    cites = [("q1", "p1"), ("q2", "p1"), ("q3", "p1"), ("q1", "p2"), ("q2", "p2"),
             ("q1", "p3")]
    g = graph(spark, wrote=wrote, authors=authors, cites=cites)
    assert rows(analytics.author_h_index(g)) == [("1", "Ann", 2), ("3", "Ann", 1)]
    assert rows(analytics.author_h_index(g, keep_zero=True), "authorId", "h_index") == \
        [("1", 2), ("2", 0), ("3", 1)]
    assert rows(analytics.author_h_index(g, by_name=True)) == [("Ann", 2)]


def test_h_index_matches_definition_on_random_lists(spark):
    import random

    rnd = random.Random(7)
    wrote, cites = [], []
    expected = {}
    for a in range(30):
        counts = [rnd.randint(0, 12) for _ in range(rnd.randint(1, 15))]
        for i, n in enumerate(counts):
            pid = f"p{a}_{i}"
            wrote.append((str(a), pid))
            cites += [(f"c{j}", pid) for j in range(n)]
        s = sorted(counts, reverse=True)
        h = max([k for k in range(1, len(s) + 1) if s[k - 1] >= k], default=0)
        if h:
            expected[str(a)] = h
    g = graph(spark, wrote=wrote, cites=cites, authors=[(str(a), f"n{a}") for a in range(30)])
    got = {r.authorId: r.h_index for r in analytics.author_h_index(g).collect()}
    assert got == expected


def test_impact_factor_counts_any_journal_citer(spark):
    pub = [("j1a", "Journal", "J1", 2022, None), ("j1b", "Journal", "J1", 2021, None),
           ("j1c", "Journal", "J1", 2020, None),
           ("citer1", "Journal", "J2", 2023, None), ("citer2", "Journal", "J1", 2023, None),
           ("conf", "Conference", "C", 2023, 1)]
    cites = [("citer1", "j1a"), ("citer2", "j1a"), ("citer1", "j1b"), ("conf", "j1b"),
             ("citer1", "j1c")]
    out = rows(analytics.journal_impact_factor(graph(spark, pub=pub, cites=cites), 2023))
    assert out == [("J1", 3, 2, 1.5, 1)]


def test_community_share_and_top_papers(spark):
    pub = [("p1", "Journal", "J", 2020, None), ("p2", "Journal", "J", 2020, None),
           ("p3", "Conference", "C", 2020, 1), ("p4", "Conference", "C", 2020, 1),
           ("p5", "Workshop", "W", 2020, 1)]
    contains = [("p1", "rod"), ("p2", "gear"), ("p3", "rod"), ("p4", "other"), ("p5", "rod")]
    cites = [("p2", "p1"), ("p1", "p2"), ("p3", "p1"), ("p5", "p1")]
    wrote = [("a1", "p1"), ("a1", "p2"), ("a2", "p1"), ("a3", "p3")]
    g = graph(spark, pub=pub, contains=contains, cites=cites, wrote=wrote)
    venues = recommend.community_venues(g, ["rod", "gear"], 0.9)
    assert rows(venues, "kind", "name") == [("Journal", "J")]
    top = recommend.top_community_papers(g, venues)
    assert rows(top) == [("p1", 1), ("p2", 1)]
    assert rows(recommend.potential_reviewers(g, top), "authorId") == [("a1",), ("a2",)]
    assert rows(recommend.gurus(g, top), "authorId", "n_top_papers") == [("a1", 2)]
    lit = recommend.community_venues(g, ["rod", "gear"], 0.0, literal_denominator=True)
    assert rows(lit, "kind", "name", "num_papers") == [("Conference", "C", 4), ("Journal", "J", 2)]


def test_conference_community_needs_four_editions(spark):
    pub = [(f"p{e}", "Conference", "C", 2020, e) for e in range(5)]
    wrote = [("a", f"p{e}") for e in range(4)] + [("b", "p0"), ("b", "p1"), ("b", "p2"),
                                                   ("b", "p2")]
    g = graph(spark, pub=pub, wrote=wrote, authors=[("a", "A"), ("b", "B")])
    assert rows(analytics.conference_communities(g)) == [("C", "a", "A", 4)]
