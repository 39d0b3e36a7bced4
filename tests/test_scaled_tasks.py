"""Steps whose tasks must not grow with the input: sampling, row numbers, neighbours."""
from pyspark.sql import functions as F

from bibgraph import session
from bibgraph.operators import ranked, synth


def test_large_pools_are_merged_with_the_picks(spark, monkeypatch):
    monkeypatch.setattr(synth, "SMALL_POOL", 10)
    papers = spark.range(300).select(F.col("id").alias("p"), F.lit(3).alias("k"))
    own = papers.select("p", (F.col("p") % 50).alias("a"))
    out = synth.pick_from_pool(papers, "p", "k", spark.range(50).select(F.col("id").alias("a")), "a", "s", exclude=own)
    assert "SortMergeJoin [idx" in out._jdf.queryExecution().toString()  # members join the picks by a merge
    got = out.collect()
    assert len(got) == 900 and all(r["pick"] != r["p"] % 50 for r in got)


def test_null_row_keys_pick_nothing(spark):
    papers = spark.createDataFrame([(1, 2), (None, 2), (2, None)], "p long, k int")
    out = synth.pick_from_pool(papers.where("p is null or p = 1"), "p", "k", spark.range(9).toDF("a"), "a", "s")
    assert {(r["p"], r["rank"]) for r in out.collect()} == {(1, 1), (1, 2)}
    assert synth.pick_from_pool(papers.where("p = 2"), "p", "k", spark.range(9).toDF("a"), "a", "s").count() == 0


def test_neighbours_in_blocks_of_one_size(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK", 4)
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    # one value with most of the rows
    values = sorted([7] * 90 + list(range(30)))
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v long, i long")
    got = sorted((r["n"], r["v"], r["i"], r["_prev"] and r["_prev"]["i"], r["_next"] and r["_next"]["i"])
                 for r in ranked.with_neighbours(df, ["v", "i"], "n", first=1).collect())
    assert got == [(i + 1, v, i, i - 1 if i else None, i + 1 if i + 1 < len(values) else None)
                   for i, v in enumerate(values)]
    assert session.partitions_for(spark, 1000) == 100


def test_few_buckets_are_written_by_many_tasks(spark, tmp_path):
    """Two buckets, four partitions: no task holds a whole bucket."""
    from bibgraph.streaming.graph_store import KeyedStore

    store = KeyedStore(spark, str(tmp_path / "store"), "k bigint", "v bigint", True, buckets=2)
    writes = spark.range(200_000).select(F.col("id").alias("k"), F.lit(0).alias("arrival"), F.lit(0).alias("file_no"),
                                         F.col("id").alias("row_no"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert store.merge(writes, 0) == [0, 1]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for bucket in (0, 1):
        assert len(list((tmp_path / "store" / "data" / "0" / f"bucket={bucket}").glob("*.parquet"))) == 4
    assert store.read().where("v = 2 * k").count() == 200_000


def test_texts_are_cut_at_characters_that_no_id_holds(spark):
    from bibgraph.operators import profile

    df = spark.createDataFrame([("12, 345 (12)]😀7",)], "t string")
    assert df.select(profile._runs("t", list("0123456789"))).first()[0] == ["12", "345", "7"]
    assert df.select(profile._runs("t", list(" ,)]^-\\😀"))).first()[0] == [", ", " ", ")]😀"]


def test_few_edges_make_few_buckets(spark, monkeypatch):
    from bibgraph.operators.graph_algorithms import EdgeSet

    edges = spark.createDataFrame([(i, i + 1) for i in range(100)], "src long, dst long")
    monkeypatch.setattr(session, "TASK_ROWS", 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        many, few = EdgeSet(edges), EdgeSet(edges.limit(1))
        held = [spark.sql(f"DESCRIBE EXTENDED {e._names[1]}").where("col_name = 'Num Buckets'").first()["data_type"]
                for e in (many, few)]
        assert held == ["10", "4"]
        many.release(), few.release()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
