"""The topic is a property of the whole text, in Spark and in SQL."""
import duckdb

from bibgraph.llm import mixing

TEXTS = ["Opening words: cluster storage storage", "Opening words: storage cluster cluster", None, "", "a b c",
         "zebras animal zebras animal", "Straße Straßen straßen ÉCOLES écoles écoles", "x " * 50 + "planet"]


def test_leading_word_counts_the_whole_text(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    got = {r["doc_id"]: r["w"] for r in df.select("doc_id", mixing.leading_word().alias("w")).collect()}
    assert got == {0: "storage", 1: "cluster", 2: "", 3: "", 4: "", 5: "animal", 6: "écoles", 7: "planet"}


def test_topics_equal_their_sql(spark):
    table = [(i, f"{t} tail {w} {w}" if t else t, "s", "en") for i, t in enumerate(TEXTS)
             for w in ("matrix", "galaxy", "protein")]
    df = spark.createDataFrame(table, "doc_id long, text string, source string, lang string")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", table)
    got = sorted((r["doc_id"], r["topic"]) for r in mixing.result(df).select("doc_id", "topic").collect())
    assert got == sorted(con.execute(f"SELECT doc_id, topic FROM ({mixing.oracle_sql()}) q").fetchall())
    assert len({t for _, t in got}) > 2
