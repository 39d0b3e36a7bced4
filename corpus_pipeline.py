"""Cleaning and packing a corpus: toxicity, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read back as the next stage's docs.  All but the last return the
columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bibgraph.llm import line_dedup, minhash, mixing, packing, toxicity
from bibgraph.llm.common import table, written
from bibgraph.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; learns from all labels.

    A null or empty text scores like a text without known words and stays; without
    positive labels everything stays.
    """
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.with_score(docs.select(*COLUMNS), weights).filter(
        F.col("score") < toxicity.THRESHOLD).select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later copies of repeated line runs; n_chars follows.

    A document whose text was lost altogether goes; null and empty texts that were
    so before stay.
    """
    out = line_dedup.line_dedup(docs.select(*COLUMNS))
    text = F.when(F.col("text").isNotNull(), F.col("kept_text"))
    return (out.filter((F.col("n_removed") == 0) | (F.trim("kept_text") != ""))
            .withColumn("text", text)
            .withColumn("n_chars", F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
                        .otherwise(F.col("n_chars"))).select(*COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: the one of the smallest doc_id (null last).

    Rows are told apart by a number of their own, not by doc_id: rows that share an id
    stay if their texts differ, and exact copies without an id go.  Null texts and texts
    without a word are no one's copies.
    """
    rows = written(docs.select(*COLUMNS).withColumn("row", F.monotonically_increasing_id()), "rows")
    found = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"))
    grouped = found.groupBy("class_id").count().filter("count > 1").select("class_id")
    members = written(found.join(grouped, "class_id").select("class_id", F.col("doc_id").alias("row")), "members")
    first = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    kept = (members.join(rows.select("row", "doc_id"), "row").groupBy("class_id")
            .agg(F.min(first).alias("first")).select(F.col("first.row").alias("row")))
    dropped = written(members.select("row").join(kept, "row", "left_anti"), "dropped")
    return rows.join(dropped, "row", "left_anti").select(*COLUMNS)


def sample_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by rates that are raked to tempered source and language and even topic weights."""
    return mixing.mix(docs.select(*COLUMNS)).filter("kept").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    return packing.pack(packing.pieces(docs, tokenizer_path(), digest=True))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("near_dedup", drop_near_duplicates),
          ("mixing", sample_to_weights), ("packing", pack)]

#: A learned classifier, MinHash and best fit can't be put in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
