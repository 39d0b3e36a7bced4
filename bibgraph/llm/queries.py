"""Queries of the training-data operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, decontamination, fingerprints, language_id, lexical_search, line_dedup, merkle, minhash, mixing, packing,
               pii, substring_dedup, toxicity)
from .common import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(fn):
    REGISTRY[fn.__name__] = fn
    return fn


@register
def op1_learned_partitions(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@register
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents"), tokenizer_path(), digest=True))


@register
def op3_line_dedup(spark, sf_dir):
    return line_dedup.result(table(spark, sf_dir, "documents"))


@register
def op4_fingerprints(spark, sf_dir):
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


@register
def op5_language_id(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"), language_id.holdout(2, 4))


@register
def op6_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op7_toxicity(spark, sf_dir):
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                          language_id.holdout(1, 3))


@register
def op8_pii(spark, sf_dir):
    return pii.digest(pii.find_pii(table(spark, sf_dir, "documents")))


@register
def op9_substring_dedup(spark, sf_dir):
    return substring_dedup.digest(substring_dedup.substring_dedup(table(spark, sf_dir, "documents")))


@register
def op10_mixing(spark, sf_dir):
    return mixing.result(table(spark, sf_dir, "documents"))


@register
def op11_k2_treap_search(spark, sf_dir):
    return lexical_search.result(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register
def op12_merkle_manifest(spark, sf_dir):
    return merkle.result(table(spark, sf_dir, "documents"))


@register
def op13_decontamination(spark, sf_dir):
    return decontamination.result(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def oracle_sql() -> dict[str, str]:
    return {"op3_line_dedup": line_dedup.oracle_sql(), "op10_mixing": mixing.oracle_sql(),
            "op11_k2_treap_search": lexical_search.oracle_sql(),
            "op12_merkle_manifest": merkle.oracle_sql(), "op13_decontamination": decontamination.oracle_sql()}
