"""Incremental first-writer load of arriving load files."""

import os

from conftest import rows
from bibgraph.session import scratch_path
from bibgraph.streaming.incremental_load import read_paper_nodes, start_paper_load

HEADER = ("paperId,title,url,abstract,year,citationCount,authorIds,corresponding_author,venue,"
          "approved,reviewers,comments,proceedings,edition,journal_name,journal_volume,keywords,"
          "Citations\n")


def write(path, lines):
    with open(path, "w") as f:
        f.write(HEADER)
        for ln in lines:
            f.write(ln + "\n")


def test_two_batches_keep_first_writer(spark):
    base = scratch_path(spark, "stream-test").replace("file:", "")
    inp, out, ck = f"{base}/in", f"{base}/nodes", f"{base}/ck"
    os.makedirs(inp)
    write(f"{inp}/conference_info.csv",
          ['p1,First,u,"an ""abstract"", with comma",2020,3,"1, 2",1,Rome,Y,"3",x,C,5,,,k,',
           "p2,Second,u,a,2021,4,1,1,Oslo,Y,3,x,C,6,,,k,"])
    q = start_paper_load(spark, inp, out, ck)
    q.awaitTermination(120)
    # a journal file has its own column set and order (no proceedings, no edition)
    with open(f"{inp}/journal_info.csv", "w") as f:
        f.write("title,paperId,year,url,abstract,citationCount,journal_name,journal_volume\n"
                "Changed,p1,2019,u,a,1,J,1\nThird,p3,2018,u,a,2,J,1\n")
    q = start_paper_load(spark, inp, out, ck)
    q.awaitTermination(120)
    got = rows(read_paper_nodes(spark, out), "paperId", "title", "abstract", "year")
    assert got == [("p1", "First", 'an "abstract", with comma', 2020),
                   ("p2", "Second", "a", 2021), ("p3", "Third", "a", 2018)]
