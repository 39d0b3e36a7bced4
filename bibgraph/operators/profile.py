"""Data profiling: value counts, null counts, list-membership counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import split_list
from ..session import written


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """(value, count) ordered by count desc, then value (pandas ``value_counts``)."""
    src = df.where(F.col(col).isNotNull()) if dropna else df
    return (src.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("value")))


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, non_null, nulls, n_rows): one aggregate pass, then unpivoted."""
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for c in df.columns:
        aggs.append(F.count(F.col(c)).alias(f"nn_{c}"))
    wide = df.agg(*aggs)
    stacked = wide.select(
        F.col("__rows").alias("n_rows"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                     F.col(f"nn_{c}").alias("non_null"))
                            for c in df.columns])).alias("s"))
    return stacked.select(F.col("s.column_name").alias("column_name"),
                          F.col("s.non_null").alias("non_null"),
                          (F.col("n_rows") - F.col("s.non_null")).alias("nulls"), "n_rows")


def membership_counts(df: DataFrame, list_col: str, key: str = "authorId",
                      delimiter: str = ",") -> DataFrame:
    """(key, n_rows): in how many rows each id appears in a delimited list."""
    return (df.select(F.array_distinct(split_list(list_col, delimiter)).alias("_l"))
            .select(F.explode("_l").alias(key))
            .where(F.col(key) != "")
            .groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")))


#: Longest gram that is compared by equality; longer ids are found by one gram and verified.
GRAM = 12


def _grams(text, size: int):
    """Distinct substrings of ``size`` characters."""
    starts = F.sequence(F.lit(1), F.length(text) - size + 1)
    all_ = F.transform(starts, lambda i: F.substring(text, i, F.lit(size)))
    return F.when(F.length(text) >= size, F.array_distinct(all_))


#: Ids of up to so many different characters cut the texts at all others.
ALPHABET = 256


def _runs(text, letters: list[str]):
    """Longest pieces of a text that consist of the given characters, each piece once."""
    of = "[" + "".join(rf"\x{{{ord(c):X}}}" for c in letters) + "]+"
    return F.array_distinct(F.regexp_extract_all(F.col(text), F.lit(of), F.lit(0)))


def substring_counts(df: DataFrame, text_col: str, ids: DataFrame, key: str = "authorId",
                     gram: int = GRAM) -> DataFrame:
    """(key, n_rows): in how many rows of ``df`` each distinct id occurs inside the text, as a substring.

    Equal texts are folded first.  Ids of up to ``gram`` characters are grams: texts
    are cut at characters that no such id holds, then into their distinct substrings of the
    lengths that ids have, rows are counted per gram (partial aggregation, so a hot gram is one row) and joined
    with the ids by equality.  A longer id is looked for by its rarest gram only and
    verified in the texts that hold it.  An empty id is inside every text; an id that
    occurs nowhere counts 0.  Null ids and null texts are left out.
    """
    texts = written(df.where(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("_text"))
                    .agg(F.count(F.lit(1)).alias("_n")), "texts")
    ids = written(ids.select(F.col(key).cast("string").alias("_id")).where("_id is not null").distinct(), "ids")
    # at most `gram` lengths reach the driver
    lengths = [r[0] for r in ids.select(F.length("_id").alias("m")).where((F.col("m") > 0) & (F.col("m") <= gram))
               .distinct().collect()]
    found = texts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("_rows")).select(F.lit("").alias("_id"), "_rows")
    if lengths:
        letters = [r[0] for r in ids.where(F.length("_id").isin(lengths)).select(F.explode(_grams("_id", 1)))
                   .distinct().limit(ALPHABET + 1).collect()]
        runs = _runs("_text", letters) if len(letters) <= ALPHABET else F.array("_text")
        of_run = lambda r: F.flatten(F.filter(F.array(*[_grams(r, m) for m in sorted(lengths)]),
                                              lambda a: a.isNotNull()))
        pieces = F.array_distinct(F.flatten(F.transform(runs, of_run)))
        found = found.unionByName(texts.select(F.explode(pieces).alias("_id"), "_n").groupBy("_id")
                                  .agg(F.sum("_n").alias("_rows")))
    long = ids.where(F.length("_id") > gram)
    if not long.isEmpty():
        wanted = long.select("_id", F.explode(_grams("_id", gram)).alias("_gram"))
        held = texts.select("_text", "_n", F.explode(_grams("_text", gram)).alias("_gram"))
        # only grams of ids are kept, with the number of texts that hold each
        met = written(held.join(wanted.select("_gram").distinct(), "_gram", "left_semi"), "grams")
        spread = met.groupBy("_gram").agg(F.count(F.lit(1)).alias("_df"))
        # a gram that no text holds settles its id: it counts 0
        rarest = wanted.join(spread, "_gram", "left").groupBy("_id").agg(
            F.min_by("_gram", F.struct(F.coalesce("_df", F.lit(0)), "_gram")).alias("_gram"))
        verified = met.join(rarest, "_gram").where(F.contains("_text", "_id"))
        found = found.unionByName(verified.groupBy("_id").agg(F.sum("_n").alias("_rows")))
    return ids.join(found, "_id", "left").select(F.col("_id").alias(key),
                                                 F.coalesce("_rows", F.lit(0)).alias("n_rows"))
