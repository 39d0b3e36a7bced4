"""Quoted CSV read by byte ranges, rejects, and header-driven load files."""

import csv
import os
import random

import pytest

from bibgraph.session import scratch_path
from bibgraph.sources import split_csv
from bibgraph.sources.load_files import read_load_files, read_load_files_with_rejects


@pytest.fixture
def small_blocks(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    held = [spark.conf.get(k) for k in keys]
    for k in keys:
        spark.conf.set(k, "96")
    yield
    for k, v in zip(keys, held, strict=True):
        spark.conf.set(k, v)


def folder(spark, name):
    path = scratch_path(spark, name).replace("file:", "")
    os.makedirs(path)
    return path


def awkward_rows(n):
    rng = random.Random(n)
    parts = ["plain", 'a "quoted" word', "two\nlines", "a,b", "\n\n", '"', "é😀", "x" * 150, " ", "tail\n"]
    return [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 6))), rng.choice(["en", "d,e", "f\nr"]))
            for i in range(n)]


def test_many_tasks_equal_one_reader(spark, small_blocks):
    base = folder(spark, "split-csv")
    expected = {}
    for f, n in (("a.csv", 200), ("b.csv", 1), ("c.csv", 0)):
        rows = awkward_rows(n)
        with open(f"{base}/{f}", "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(["id", "text", "lang"])
            writer.writerows(rows)
        expected[f] = rows
    blocks = split_csv._lines(spark, base).select("file", "block").distinct().count()
    assert blocks > 100
    got, rejects = split_csv.read_split(spark, base, "id long, text string, lang string", with_place=True)
    found = {f: [] for f in expected}
    for r in sorted(got.collect(), key=lambda r: (r["file"], r["pos"])):
        found[r["file"].rsplit("/", 1)[-1]].append((r["id"], r["text"], r["lang"]))
    assert found == expected
    assert rejects.count() == 0
    one = spark.read.options(**split_csv.OPTIONS).schema("id long, text string, lang string").csv(base)
    assert sorted(map(tuple, one.collect())) == sorted(r for rows in expected.values() for r in rows)


def test_a_broken_row_costs_one_row(spark, small_blocks):
    base = folder(spark, "rejects")
    with open(f"{base}/a.csv", "w") as out:
        out.write('id,text\n1,"two\nlines"\nno number,x\n2,too,many\n3\n4,"ends"\r\n\n5,""\n')
    rows, rejects = split_csv.read_split(spark, base, "id long, text string")
    assert sorted(map(tuple, rows.collect())) == [(1, "two\nlines"), (4, "ends"), (5, "")]
    bad = rejects.orderBy("pos").collect()
    assert [r["record"] for r in bad] == ["no number,x", "2,too,many", "3"]
    assert [tuple(r)[1:] for r in split_csv.reject_counts(rejects).collect()] == [(3,)]


def test_load_files_of_many_headers_in_a_bounded_number_of_jobs(spark):
    sizes = {}
    for n in (6, 300):
        base = folder(spark, f"load-{n}")
        for i in range(n):
            header, row = [("paperId,title,year", f'p{i},"t\n{i}",2020'), ("year,paperId", f"2019,p{i}"),
                           ("paperId,keywords", f'p{i},"a,b"')][i % 3]
            with open(f"{base}/{i:05d}.csv", "w") as out:
                out.write(f"{header}\n{row}\n")
        spark.sparkContext.setJobGroup(f"load-{n}", "load files")
        got = read_load_files(spark, {"Conference": base}).orderBy("row_no").collect()
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        sizes[n] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"load-{n}"))
        assert [r["paperId"] for r in got] == [f"p{i}" for i in range(n)]  # in path order
        assert [r["title"] for r in got[:3]] == ["t\n0", None, None] and got[2]["keywords"] == "a,b"
        assert {r["kind"] for r in got} == {"Conference"}
    assert sizes[300] <= sizes[6] + 2


def test_load_files_with_a_broken_row(spark):
    base = folder(spark, "load-broken")
    with open(f"{base}/a.csv", "w") as out:
        out.write("paperId,year\np1,2020\np2,2021,more\np3,2022\n")
    with pytest.raises(ValueError, match="p2,2021,more"):
        read_load_files(spark, {"Journal": f"{base}/a.csv"})
    rows, rejects = read_load_files_with_rejects(spark, {"Journal": f"{base}/a.csv"})
    assert [r["paperId"] for r in rows.orderBy("row_no").collect()] == ["p1", "p3"]
    assert [(r["kind"], r["record"]) for r in rejects.collect()] == [("Journal", "p2,2021,more")]
