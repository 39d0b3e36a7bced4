"""Keyword extraction as a distributed term count.

Per document: lower-case, strip ASCII punctuation, split on whitespace, drop
English stop words, count terms, keep the ``n`` most frequent (ties: first
occurrence), and make sure the document's field term is among them (it
replaces the last one when missing).  The original keeps only nouns: pass
``nouns``, the weights of a tagger (``operators.nouns.train``), for that.
``term_filter`` is the hook for a step of one's own (DataFrame -> DataFrame over
(doc, pos, term) rows).  By default every non-stop word is kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import strip_punctuation
from ..session import written
from .nouns import neighbours, only_nouns

# The English stop-word list of the NLTK corpus (179 words).
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours "
    "yourself yourselves he him his himself she she's her hers herself it it's its itself "
    "they them their theirs themselves what which who whom this that that'll these those "
    "am is are was were be been being have has had having do does did doing a an the and "
    "but if or because as until while of at by for with about against between into "
    "through during before after above below to from up down in out on off over under "
    "again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just "
    "don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't "
    "didn didn't doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn "
    "mightn't mustn mustn't needn needn't shan shan't shouldn shouldn't wasn wasn't weren "
    "weren't won won't wouldn wouldn't"
).split()
WHITESPACE = "[ \\t\\n\\r\\f]+"


def extract_keywords(docs: DataFrame, key: str = "doc_id", text: str = "text",
                     field: str | None = "field_query", n: int = 4,
                     term_filter: Callable[[DataFrame], DataFrame] | None = None,
                     nouns: DataFrame | None = None) -> DataFrame:
    """(key, rank, term): the top ``n`` terms of each document, with ``nouns`` the top nouns.

    A noun is judged by its neighbours in the text, stop words included.

    Terms of a document whose key no other row has are counted inside its row: neither
    its words nor their counts are shuffled or spilled.  Rows that share a key (found by a
    count over the keys alone) are counted together, by ``_grouped_keywords``, and so are
    all rows where a step on token rows (``nouns``, ``term_filter``) is asked for.
    """
    f = F.lower(F.col(field)) if field is not None else F.lit(None).cast("string")
    src = docs.select(key, f.alias("_f"), text)
    if nouns is not None or term_filter is not None:
        return _grouped_keywords(src, key, text, field, n, term_filter, nouns)
    shared = written(src.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
                     .select(F.col(key).alias("_shared")), "shared_keys")
    if shared.isEmpty():  # the usual case
        return _row_keywords(src, key, text, n)
    same = src[key].eqNullSafe(shared["_shared"])
    return _row_keywords(src.join(shared, same, "left_anti"), key, text, n).unionByName(
        _grouped_keywords(src.join(shared, same, "left_semi"), key, text, field, n, None, None))


def _row_keywords(src: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, rank, term) of rows (key, _f, text) that each are a document.

    Equal words stand together in the sorted (word, place) list and are counted as runs; a
    run that ends goes into the list of the best ``n``.
    """
    words = F.filter(F.split(strip_punctuation(F.lower(F.col(text))), WHITESPACE),
                     lambda w: (w != "") & ~w.isin(*STOP_WORDS))
    # the field term is counted once more, after every word of the text
    listed = F.concat(F.coalesce(words, F.array().cast("array<string>")), F.array_compact(F.array("_f")))
    placed = F.sort_array(F.transform(listed, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    best = "array<struct<less:int,first:int,term:string>>"

    def with_run(held: Column) -> Column:  # most first, then the first to occur
        run = F.array(F.struct((-held["n"]).alias("less"), held["first"].alias("first"), held["w"].alias("term")))
        return F.slice(F.sort_array(F.concat(held["best"], run.cast(best))), 1, n)

    def count(held: Column, word: Column) -> Column:
        same = held["w"] == word["w"]
        return F.struct(word["w"].alias("w"), F.when(same, held["n"] + 1).otherwise(F.lit(1)).alias("n"),
                        F.when(same, held["first"]).otherwise(word["i"]).alias("first"),
                        F.when(same | held["w"].isNull(), held["best"]).otherwise(with_run(held)).alias("best"))

    start = F.struct(F.lit(None).cast("string").alias("w"), F.lit(0).alias("n"), F.lit(0).alias("first"),
                     F.array().cast(best).alias("best"))
    top = F.aggregate(placed, start, count,
                      lambda held: F.when(held["w"].isNull(), held["best"]).otherwise(with_run(held)))
    terms = src.select(key, "_f", F.transform(top, lambda t: t["term"]).alias("_top"))
    # field term missing: it takes the place of the last kept term
    fixed = F.when(F.col("_f").isNotNull() & ~F.array_contains("_top", F.col("_f")), F.concat(
        F.slice("_top", 1, F.size("_top") - 1), F.array("_f"))).otherwise(F.col("_top"))
    return (terms.select(key, F.posexplode(fixed).alias("_at", "term"))
            .select(key, (F.col("_at") + 1).alias("rank"), "term"))


def _grouped_keywords(src: DataFrame, key: str, text: str, field: str | None, n: int,
                      term_filter: Callable[[DataFrame], DataFrame] | None, nouns: DataFrame | None) -> DataFrame:
    """(key, rank, term) of rows (key, _f, text) that may share a key.

    One pass over the text: the field term rides along as a grouping column
    (it is fixed per document), and the "is the field term among the top n"
    test is a window over the same document partition, so nothing is joined
    back and no text is tokenised twice.
    """
    cleaned = strip_punctuation(F.lower(F.col(text)))
    tok = src.select(key, "_f", F.posexplode(F.split(cleaned, WHITESPACE)).alias("pos", "term"))
    if nouns is not None:
        words = F.filter(F.split(cleaned, WHITESPACE), lambda w: w != "")
        tok = (src.select(key, "_f", words.alias("_words"))
               .select(key, "_f", F.posexplode(neighbours(F.col("_words"))).alias("pos", "_t"))
               .select(key, "_f", "pos", "_t.*").toDF(key, "_f", "pos", "term", "_before", "_after"))
    tok = tok.where((F.col("term") != "") & ~F.col("term").isin(*STOP_WORDS))
    if nouns is not None:
        tok = only_nouns(tok, nouns, "term", "_before", "_after").drop("_before", "_after")
    if term_filter is not None:
        tok = term_filter(tok)
    if field is not None:
        # the field term is counted once more, after every word of the text
        tok = tok.unionByName(src.where(F.col("_f").isNotNull())
                              .select(key, "_f", F.lit(1 << 62).alias("pos"),
                                      F.col("_f").alias("term")))
    counts = tok.groupBy(key, "_f", "term").agg(F.count(F.lit(1)).alias("c"),
                                                F.min("pos").alias("first"))
    w = Window.partitionBy(key).orderBy(F.desc("c"), F.asc("first"))
    top = counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    if field is None:
        return top.select(key, "rank", "term")
    doc = Window.partitionBy(key)
    top = (top.withColumn("_has", F.max((F.col("term") == F.col("_f")).cast("int")).over(doc))
           .withColumn("_last", F.max("rank").over(doc)))
    # field term missing: it takes the place of the last kept term
    return top.select(key, "rank",
                      F.when((F.col("_has") == 0) & (F.col("rank") == F.col("_last")),
                             F.col("_f")).otherwise(F.col("term")).alias("term"))
