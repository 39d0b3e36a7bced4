"""The reference's flow end to end: ETL -> load files (CSV) -> graph -> questions."""

from pyspark.sql import functions as F

from conftest import SF0001
from bibgraph.operators import graph_build as gb
from bibgraph.operators import synth
from bibgraph.plans import algorithms, analytics
from bibgraph.plans.etl import process_papers
from bibgraph.session import scratch_path
from bibgraph.sources.load_files import read_load_files, write_load_files
from bibgraph.sources.raw_papers import raw_authors, raw_papers
from bibgraph.sources.tables import Tables
from bibgraph.operators.graph_algorithms import pagerank


def test_etl_to_graph_to_analytics(spark):
    t = Tables(spark, SF0001)
    papers, authors = raw_papers(t), raw_authors(t)
    cities = t.nation.select(F.col("n_name").alias("location"))
    texts = t.benchmark.select(F.col("item_id").alias("review_id"), F.col("text").alias("Text"))
    parts = process_papers(papers, authors, cities, texts)

    conf = parts["Conference"].collect()
    ids = {r.paperId for r in conf}
    assert any(i.endswith("a") for i in ids)
    for r in parts["Journal"].collect() + conf:
        own = set(r.authorIds.split(", "))
        revs = set(r.reviewers.split(", ")) if r.reviewers else set()
        assert not own & revs
        cited = r.Citations.split(", ")
        assert 15 <= len(cited) <= 50 and r.paperId.rstrip("a") not in cited
        assert r.keywords and r.keywords == r.keywords.lower()

    # the three tables become the reference's load files and are read back
    rows = None
    for kind, df in parts.items():
        d = df.withColumn("kind", F.lit(kind)).withColumn("row_no", F.monotonically_increasing_id())
        rows = d if rows is None else rows.unionByName(d, allowMissingColumns=True)
    paths = write_load_files(rows, scratch_path(spark, "etl-e2e"))
    back = read_load_files(spark, paths)

    au = (authors.where(F.col("authorId").isNotNull())
          .select(F.col("authorId").cast("string").alias("authorId"), "name").distinct())
    au = synth.pick_one(au, "authorId", cities.withColumnRenamed("location", "Affiliations"),
                        "Affiliations", seed="aff")
    au = au.select("authorId", "name", "Affiliations",
                   F.lit("university").alias("Affiliation_type"),
                   F.monotonically_increasing_id().alias("row_no"), F.lit(0).alias("file_no"))
    g = gb.build_graph(back, au, write_inputs=False)

    counts = dict((r.table, r.rows) for r in gb.graph_counts(g).collect())
    assert counts["paper"] >= len(ids) and counts["cites"] > 0 and counts["wrote"] > 0
    assert analytics.author_h_index(g).count() > 0
    top = analytics.top3_cited_per_conference(g).collect()
    assert all(r.topCitedPaper1 is not None for r in top)
    # string keys: the projection assigns ids and the loop still runs
    pr = pagerank(algorithms.cites_projection(g), max_iter=3)
    assert pr.count() == counts["paper"]
