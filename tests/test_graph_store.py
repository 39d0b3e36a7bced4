"""Incremental MERGE of nodes and edges: any split of the load equals one full load."""

import os
import random

import pytest
from conftest import rows

from bibgraph.operators import graph_build as gb
from bibgraph.session import scratch_path
from bibgraph.streaming.graph_store import GraphStore, KeyedStore, start_graph_load

COLUMNS = ("kind string, row_no bigint, paperId string, title string, url string, abstract string, year string, "
           "citationCount string, authorIds string, corresponding_author string, venue string, approved string, "
           "reviewers string, comments string, proceedings string, edition string, journal_name string, "
           "journal_volume string, keywords string, Citations string")


def load(spark, n=60, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = rng.choice(["Conference", "Journal", "Workshop"])
        p = rng.randrange(n // 3)
        out.append((kind, i, f"p{p}" if p else None, f"t{i}", "u", None, str(2000 + i % 9), f"{i}.0",
                    f"a{rng.randrange(9)}, a{rng.randrange(9)}", f"a{rng.randrange(9)}", f"city{i}", "Y",
                    f"a{rng.randrange(12)},a{rng.randrange(12)}", f"c{i}", None if kind == "Journal" else f"V{p % 4}",
                    str(i % 5), f"J{p % 3}" if kind == "Journal" else None, str(i), f"k{i % 4}, k{i % 7},",
                    rng.choice([None, "", f"p{rng.randrange(n)}, x{i % 5}"])))
    authors = [(f"a{i % 10}", f"name{i}", f"org{i % 3}" if i % 4 else None, "company", i, 0) for i in range(20)]
    return (spark.createDataFrame(out, COLUMNS),
            spark.createDataFrame(authors, "authorId string, name string, Affiliations string, Affiliation_type string, "
                                  "row_no bigint, file_no int"))


def tables(g):
    return {name: sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)
            for name, df in g.tables().items()}


@pytest.mark.parametrize("seed, n_batches", [(2, 3)])
def test_batches_in_any_split_equal_one_load(spark, seed, n_batches):
    papers, authors = load(spark, seed=seed)
    full = tables(gb.build_graph(papers, authors, write_inputs=False))
    store = GraphStore(spark, scratch_path(spark, "graph-store"), buckets=4)
    rng = random.Random(seed)
    deal = {i: rng.randrange(n_batches) for i in range(60)}
    order = list(range(n_batches))
    rng.shuffle(order)
    for batch_id, part in enumerate(order):
        mine = [i for i, b in deal.items() if b == part] or [-1]
        some = papers.where(papers.row_no.isin(mine))
        # the authors arrive in two parts, the last one at the very end
        late = authors.where(authors.row_no % 2 == (0 if batch_id == 0 else 1))
        store.merge(some, late if batch_id in (0, n_batches - 1) and n_batches > 1 else
                    (authors if n_batches == 1 else None), batch_id)
    assert tables(store.graph()) == full
    versions = {name: s.versions() for name, s in store.stores.items()}
    mine = [i for i, b in deal.items() if b == order[-1]] or [-1]
    store.merge(papers.where(papers.row_no.isin(mine)), authors.where("row_no % 2 = 1") if n_batches > 1 else authors,
                n_batches - 1)  # the last batch once more
    assert tables(store.graph()) == full
    assert {name: s.versions() for name, s in store.stores.items()} == versions


def test_only_touched_buckets_are_rewritten(spark):
    store = KeyedStore(spark, scratch_path(spark, "store"), "k string", "v bigint", True, 16)
    frame = lambda data: spark.createDataFrame(data, "k string, arrival bigint, file_no int, row_no bigint, v bigint")
    assert store.read().count() == 0 and store.merge(frame([]), 0) == []
    every = store.merge(frame([(f"k{i}", 0, 0, i, i) for i in range(200)]), 1)
    assert every == list(range(16))
    one = store.merge(frame([("k7", 0, 0, 1000, -1), ("k7", 0, 0, 3, -2)]), 2)
    assert len(one) == 1 and {b for b, v in store.versions().items() if v == 2} == set(one)
    got = dict(rows(store.read()))
    assert got["k7"] == -1 and got["k8"] == 8 and len(got) == 200
    store.merge(frame([("k7", 0, 0, 500, 99)]), 3)  # an earlier write that arrives late
    assert dict(rows(store.read())) == got
    store.merge(frame([(f"k{i}", 0, 0, i, i) for i in range(200)]), 1)  # an old batch once more
    assert dict(rows(store.read())) == got


def test_stub_becomes_paper(spark):
    papers, _ = load(spark, 0)
    row = ("Journal", 5, "p1", "t", "u", None, "2020", "1", "a1", "a1", "c", "Y", "a1", "x", None, None, "J", "1", "k",
           "p2, ext")
    cited = ("Journal", 9, "p2", "second", *row[4:-1], None)
    store = GraphStore(spark, scratch_path(spark, "stubs"), buckets=2)
    store.merge(spark.createDataFrame([row], COLUMNS), None, 0)
    assert rows(store.table("paper"), "paperId", "title", "stub") == [("ext", None, True), ("p1", "t", False),
                                                                      ("p2", None, True)]
    store.merge(spark.createDataFrame([cited], COLUMNS), None, 1)
    assert rows(store.table("paper"), "paperId", "title", "stub")[-1] == ("p2", "second", False)
    assert store.table("wrote").count() == 0  # the author hasn't arrived


def test_stream_of_load_files(spark):
    base = scratch_path(spark, "graph-stream").replace("file:", "")
    os.makedirs(f"{base}/in")
    kinds = {"conference_info": "Conference", "journal_info": "Journal"}
    store = GraphStore(spark, f"{base}/store", buckets=4)

    def run(name, text):
        with open(f"{base}/in/{name}", "w") as f:
            f.write(text)
        start_graph_load(spark, f"{base}/in", store, f"{base}/ck", kinds).awaitTermination(120)

    run("conference_info.1.csv", 'paperId,title,authorIds,corresponding_author,proceedings,year,Citations\n'
        'p1,"a\ntitle","1, 2",1,C,2020,"p2, p3"\n')
    run("authors_info.csv", "authorId,name,Affiliations\n1,One,Org\n2,Two,\n")
    run("journal_info.csv", 'title,paperId,authorIds,corresponding_author,journal_name,year,journal_volume\n'
        'Second,p2,2,2,J,2021,7\nChanged,p1,"1, 2",2,J,2022,8\n')
    g = store.graph()
    assert rows(g.paper, "paperId", "title", "year") == [("p1", "a\ntitle", 2020), ("p2", "Second", 2021),
                                                         ("p3", None, None)]
    assert rows(g.wrote, "authorId", "paperId", "corresponding") == [
        ("1", "p1", False), ("2", "p1", True), ("2", "p2", True)]
    assert rows(g.published_in, "paperId", "kind", "name", "year", "journal_volume") == [
        ("p1", "Conference", "C", 2020, None), ("p1", "Journal", "J", 2022, "8"), ("p2", "Journal", "J", 2021, "7")]
    assert rows(g.cites) == [("p1", "p2"), ("p1", "p3")]
    assert rows(g.organization) == [("Org",)]
