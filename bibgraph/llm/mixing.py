"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents fall into cells by their margins (source, language, topic).  Starting
from the cells' token counts, cell weights are raked to one margin after the
other, a fixed number of cycles, so that the weights of each value of a margin
sum to its target share.  A target is either given (value, share) or tempered:
the token share to the power of an exponent, renormalised (1 keeps the shares, 0
makes them equal).

A cell can't give more tokens than it has, so raking works on the tokens to be
sampled, min(weight, tokens): what a full cell can't give, the others of its value
do.  Where the targets ask for more than there is, fewer tokens are kept: all
shares of a ladder (`keep`, then a tenth less each) are raked at once, and the
largest one counts at which every margin is met, which means that the summed
absolute differences between reached and target shares are at most twice
TOLERANCE.  If none is, the one with the smallest error does.  A document of a
cell is sampled with probability min(1, weight / tokens).  The draw is 60 bits of
an md5 of the id, so it is repeatable and rows of one id are kept or dropped
together.

Cells stay in a table at every size; a total and the ladder's errors reach the driver.  Null
margins form a value of their own, documents without tokens have rate 0 and are
never sampled, and a target value that has no cell is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MARGINS = {"source": 0.5, "lang": 0.7, "topic": 0.0}
CYCLES, KEEP, TOPICS = 8, 0.75, 8
#: Most of the sample's tokens that may lie with other values of a margin than the target says.
TOLERANCE, RUNGS = 0.005, 16
NONE = "(none)"
#: Words that can tell a topic: shorter ones are mostly articles, pronouns and the like.
WORD_LETTERS = 6
LONG_WORD = rf"\p{{L}}{{{WORD_LETTERS},}}"


def draw(doc_id: str = "doc_id") -> Column:
    """Uniform in [0, 1) by id; a null id draws like the empty text."""
    text = F.md5(F.concat(F.lit("mix:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("long") / float(1 << 60)


def leading_word(text: str = "text") -> Column:
    """Most frequent word of WORD_LETTERS or more letters in the whole text, lower case; ties: first in byte
    order; empty if there is none.  Equal words stand together in the sorted list and are counted as runs."""
    words = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(LONG_WORD), F.lit(0))

    def count(held: Column, word: Column) -> Column:
        n = F.when(held["word"] == word, held["n"] + 1).otherwise(F.lit(1))
        more = n > held["most"]
        return F.struct(word.alias("word"), n.alias("n"), F.when(more, word).otherwise(held["best"]).alias("best"),
                        F.when(more, n).otherwise(held["most"]).alias("most"))

    start = F.struct(F.lit("").alias("word"), F.lit(0).alias("n"), F.lit("").alias("best"), F.lit(0).alias("most"))
    return F.aggregate(F.sort_array(words), start, count, lambda held: held["best"])


def topic(text: str = "text", topics: int = TOPICS) -> Column:
    """Stand-in for a topic label: a hash bucket of the whole text's leading word."""
    word = leading_word(text)
    return F.concat(F.lit("t"), F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("long") % topics)


def tokens(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t\n\f\r]+")), F.lit(0)).cast("long")


def tempered(cells: DataFrame, margin: str, exponent: float) -> DataFrame:
    """value, share: token shares to the power of `exponent`, renormalised."""
    sums = cells.groupBy(margin).agg(F.pow(F.sum("tokens").cast("double"), F.lit(exponent)).alias("share"))
    total = sums.agg(F.sum("share")).first()[0] or 1.0
    return sums.select(F.col(margin).alias("value"), (F.col("share") / total).alias("share"))


def ladder(keep: float = KEEP) -> list[float]:
    """Kept shares to try, largest first."""
    return [round(keep * 0.9 ** k, 9) for k in range(RUNGS)]


def sampled() -> Column:
    return F.least("weight", "tokens")


def rake(cells: DataFrame, targets: dict[str, DataFrame], keeps: list[float], cycles: int = CYCLES) -> DataFrame:
    """cells (margins, tokens) for each kept share `keep`, with `weight`, the raked tokens to sample."""
    total = float(cells.agg(F.sum("tokens")).first()[0] or 0)
    names = [*cells.columns, "keep"]
    held = cells.withColumn("keep", F.explode(F.array(*map(F.lit, keeps))))
    held = written(held.withColumn("weight", F.col("tokens") * F.col("keep")), "cells")
    for _ in range(cycles if total else 0):
        for margin, target in targets.items():
            now = held.groupBy("keep", F.col(margin).alias("value")).agg(F.sum(sampled()).alias("now"))
            wanted = F.col("share") * F.col("keep") * total
            factor = now.join(target, "value", "left").select(
                "keep", F.col("value").alias(margin),
                F.coalesce(F.when(F.col("now") > 0, wanted / F.col("now")), F.lit(0.0)).alias("factor"))
            # cut at every margin: a step reads the cells twice, so the plan of a whole cycle holds them eight times
            held = written(held.join(factor, ["keep", margin]).select(
                *names, (F.col("weight") * F.col("factor")).alias("weight")), "cells")
    return held


def reached(held: DataFrame, target: DataFrame, margin: str) -> DataFrame:
    """keep, value, share (target), got (share in the expected sample) of a margin's raked cells."""
    now = held.groupBy("keep", F.col(margin).alias("value")).agg(F.sum(sampled()).alias("now"))
    total = held.groupBy("keep").agg((F.sum("tokens") * F.col("keep")).alias("total"))
    return now.join(total, "keep").join(target, "value", "left").select(
        "keep", "value", F.coalesce("share", F.lit(0.0)).alias("share"), (F.col("now") / F.col("total")).alias("got"))


def calibrate(held: DataFrame, targets: dict[str, DataFrame]) -> DataFrame:
    """The cells of the largest kept share that meets every margin, with `rate`."""
    errors: dict[float, float] = {}
    for margin, target in targets.items():
        gaps = reached(held, target, margin).groupBy("keep").agg((F.sum(F.abs(F.col("got") - F.col("share"))) / 2))
        for keep, gap in gaps.collect():  # one row per rung
            errors[keep] = max(gap, errors.get(keep, 0.0))
    allowed = max(TOLERANCE, min(errors.values(), default=0.0))
    best = max((keep for keep, error in errors.items() if error <= allowed), default=0.0)
    return held.filter(F.col("keep") == best).withColumn("rate", sampled() / F.col("tokens"))


def rates(docs: DataFrame, margins: dict[str, float] | None = None,
          targets: dict[str, DataFrame] | None = None, keep: float = KEEP, cycles: int = CYCLES) -> DataFrame:
    """Cells of docs (one column per margin, `tokens`) with keep, weight and rate; targets replace exponents."""
    margins = margins or MARGINS
    cells = written(docs.filter("tokens > 0").groupBy(*margins).agg(F.sum("tokens").alias("tokens")), "cells")
    wanted = {m: tempered(cells, m, e) for m, e in margins.items()} | (targets or {})
    wanted = {m: written(t, "targets") for m, t in wanted.items()}
    return written(calibrate(rake(cells, wanted, ladder(keep), cycles), wanted), "rates")


def with_margins(docs: DataFrame) -> DataFrame:
    """The rows with non-null source and lang, the stand-in topic, and tokens, under names of their own."""
    return docs.select("*", F.coalesce("source", F.lit(NONE)).alias("_source"),
                       F.coalesce("lang", F.lit(NONE)).alias("_lang"), topic().alias("_topic"),
                       tokens().alias("_tokens"))


def mix(docs: DataFrame, keep: float = KEEP, cycles: int = CYCLES) -> DataFrame:
    """docs with _source, _lang, _topic, _tokens, rate and kept (sampled or not)."""
    marked = with_margins(docs.drop("_source", "_lang", "_topic", "_tokens", "rate", "kept"))
    plain = marked.select(*(F.col(f"_{m}").alias(m) for m in (*MARGINS, "tokens")))
    cells = rates(plain, keep=keep, cycles=cycles).select(
        *(F.col(m).alias(f"_{m}") for m in MARGINS), F.col("rate").alias("_rate"))
    rate = F.when(F.col("_tokens") > 0, F.coalesce("_rate", F.lit(0.0))).otherwise(F.lit(0.0))
    return (marked.join(cells, [f"_{m}" for m in MARGINS], "left")
            .withColumn("rate", rate).withColumn("kept", draw() < F.col("rate")).drop("_rate"))


def result(docs: DataFrame, **options) -> DataFrame:
    """doc_id, topic, tokens, rate (rounded), kept."""
    return mix(docs.select("doc_id", "text", "source", "lang"), **options).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_topic").alias("topic"),
        F.col("_tokens").alias("tokens"), F.round("rate", 6).alias("rate"), "kept")


def oracle_sql(keep: float = KEEP, cycles: int = CYCLES, topics: int = TOPICS) -> str:
    """DuckDB SQL of result(), the cycles written out."""
    ctes = ["num AS MATERIALIZED (SELECT *, row_number() OVER () AS rid FROM documents)",
            f"""lead AS MATERIALIZED (
  SELECT rid, word FROM (
    SELECT rid, word, count(*) AS n
    FROM (SELECT rid, unnest(regexp_extract_all(lower(coalesce(text, '')), '{LONG_WORD}')) AS word FROM num) w
    GROUP BY 1, 2) c
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY n DESC, word) = 1)""",
            f"""doc AS (
  SELECT doc_id, coalesce(source, '{NONE}') AS source, coalesce(lang, '{NONE}') AS lang,
         't' || (('0x' || substr(md5(coalesce(word, '')), 1, 8))::BIGINT % {topics}) AS topic,
         len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\f\\r]+'))::BIGINT AS tokens,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT::DOUBLE
           / {float(1 << 60)} AS u
  FROM num LEFT JOIN lead USING (rid))""",
            """cell AS MATERIALIZED (
  SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM doc WHERE tokens > 0 GROUP BY ALL)""",
            f"""c0 AS MATERIALIZED (
  SELECT *, tokens * keep AS weight, (SELECT sum(tokens) FROM cell) AS total
  FROM cell, (SELECT unnest({ladder(keep)}::DOUBLE[]) AS keep) l)"""]
    for margin, exponent in MARGINS.items():
        ctes.append(f"""want_{margin} AS MATERIALIZED (
  SELECT {margin}, p / sum(p) OVER () AS share
  FROM (SELECT {margin}, pow(sum(tokens), {exponent}) AS p FROM cell GROUP BY 1))""")
    n = 0
    for _ in range(cycles):
        for margin in MARGINS:
            ctes.append(f"""c{n + 1} AS MATERIALIZED (
  SELECT c.source, c.lang, c.topic, c.tokens, c.keep, c.total,
         c.weight * (w.share * c.keep * c.total
                     / sum(least(c.weight, c.tokens)) OVER (PARTITION BY c.keep, c.{margin})) AS weight
  FROM c{n} c JOIN want_{margin} w USING ({margin}))""")
            n += 1
    gaps = " UNION ALL ".join(f"""
  SELECT keep, sum(abs(got - share)) / 2 AS gap FROM (
    SELECT keep, {margin}, sum(least(weight, tokens)) / any_value(keep * total) AS got FROM c{n} GROUP BY 1, 2) g
  JOIN want_{margin} USING ({margin}) GROUP BY 1""" for margin in MARGINS)
    ctes.append(f"err AS MATERIALIZED (SELECT keep, max(gap) AS gap FROM ({gaps}) x GROUP BY 1)")
    ctes.append(f"""best AS (
  SELECT max(keep) AS keep FROM err WHERE gap <= greatest({TOLERANCE}, (SELECT min(gap) FROM err)))""")
    ctes.append(f"""rate AS (
  SELECT source, lang, topic, least(weight, tokens) / tokens AS rate FROM c{n} JOIN best USING (keep))""")
    body = ",\n".join(ctes)
    return f"""WITH {body}
SELECT d.doc_id, d.topic, d.tokens, round(CASE WHEN d.tokens > 0 THEN r.rate ELSE 0.0 END, 6) AS rate,
       d.u < (CASE WHEN d.tokens > 0 THEN r.rate ELSE 0.0 END) AS kept
FROM doc d LEFT JOIN rate r USING (source, lang, topic)"""
