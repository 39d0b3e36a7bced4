"""Seeded synthetic attributes: affiliations, locations, reviewers, review
texts and citations.

Every random choice is a hash draw of (seed, row key, draw number), so the
result does not depend on partitioning, executor count or retries, and an
independent SQL engine can reproduce it.  Sampling without replacement is
linear: each row takes ``k + slack`` numbered draws into a dense index of the
pool, excluded and repeated picks are removed, and the first ``k`` remaining
draws win.  Rows left short (rare) take another batch of draws until every
row has ``min(k, eligible)`` picks — no row is capped or dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import hash_draw
from ..session import tasks_for, written
from .ranked import numbered

#: Most numbers that a row draws in one round; bounds the rows that one row becomes.
MAX_SPAN = 4096
#: Pools of up to so many members are sent to every task.
SMALL_POOL = 1 << 16


def dense_index(pool: DataFrame, key: str, idx: str = "idx") -> DataFrame:
    """Number the distinct keys of ``pool`` 0..n-1 in key order, without a
    single-task global window."""
    # read three times while it is numbered
    return numbered(written(pool.select(key).distinct(), "members"), [key], idx)


def pick_from_pool(rows: DataFrame, row_key: str, k_col: str, pool: DataFrame,
                   pool_key: str, seed: str, exclude: DataFrame | None = None,
                   slack: int = 20, self_excluded: bool = False) -> DataFrame:
    """(row_key, rank, pick): ``k_col`` distinct picks per row from ``pool``
    without replacement, skipping pairs in ``exclude(row_key, pool_key)`` and,
    with ``self_excluded``, the row's own key.

    A row draws the numbers ``[0, W)`` with ``W = k + slack``; if still short, the
    next ``2W``, then ``4W`` numbers, up to MAX_SPAN a round, until it has
    ``min(k, eligible)`` picks, where eligible is the pool minus its excluded
    members.  Nothing is capped.  Repeated row keys count once (largest k).

    A row's draws are one array, so picks are told apart inside the row; only the draws that
    meet an excluded pair and the ``k`` picks themselves are shuffled.  Joins with tables that
    grow are never broadcast: the planner takes an exploded table for as small as its rows.
    Null row keys and rows without a number pick nothing.
    """
    indexed = dense_index(pool.select(F.col(pool_key).alias("_pk")), "_pk")
    n_pool = indexed.count()
    if n_pool == 0:  # nothing to pick from: every row gets min(k, 0) = 0 picks
        return rows.select(row_key, F.lit(1).alias("rank"),
                           F.lit(None).cast(pool.schema[pool_key].dataType).alias("pick")).limit(0)
    none = F.array().cast("array<bigint>")
    target = (rows.where(F.col(row_key).isNotNull()).groupBy(row_key).agg(F.max(k_col).cast("int").alias("_k"))
              .where("_k is not null"))
    elig, never = F.lit(n_pool), none
    pairs = None
    if exclude is not None:
        ex = exclude.select(F.col(exclude.columns[0]).alias(row_key), F.col(exclude.columns[1]).alias("_pk")).distinct()
        pairs = written(ex.join(_shared(indexed, n_pool), "_pk").select(row_key, "idx"), "excluded")
        n_ex = pairs.groupBy(row_key).agg(F.count(F.lit(1)).alias("_nex"))
        target = target.join(n_ex.hint("merge"), row_key, "left")
        elig = elig - F.coalesce("_nex", F.lit(0))
    if self_excluded:
        own = indexed.select(F.col("_pk").alias(row_key), F.col("idx").alias("_own"))
        target = target.join(own.hint("merge"), row_key, "left")
        # a null member is never told to differ from the row
        null_at = [F.lit(r["idx"]) for r in indexed.where("_pk is null").collect()]  # at most one
        elig = elig - F.when(F.col("_own").isNull(), 0).otherwise(1) - len(null_at)
        never = F.array_compact(F.array(F.col("_own"), *null_at))
    todo = written(target.select(row_key, F.least("_k", elig).cast("int").alias("_target"),
                                 (F.col("_k") + slack).cast("long").alias("_width"),
                                 never.alias("_never"), none.alias("_held")), "targets")
    # rows are small but draw much: tasks follow the draws, not the bytes
    n_draws = todo.agg(F.sum(F.least("_width", F.lit(MAX_SPAN)))).first()[0] or 0
    todo = todo.repartition(tasks_for(todo.sparkSession, n_draws), row_key)

    finished: DataFrame | None = None
    lo, span = F.lit(0).cast("long"), F.least(F.col("_width"), F.lit(MAX_SPAN))
    factor = 1
    while True:
        numbers = F.when(span > 0, F.sequence(lo, lo + span - 1)).otherwise(none)
        draws = F.transform(numbers, lambda i: F.pmod(hash_draw(row_key, i, seed=seed), F.lit(n_pool)))  # noqa: B023
        gone = F.concat("_never", "_held")
        if pairs is not None:  # at most ``span`` draws of a row meet an excluded pair
            met = (todo.select(row_key, F.explode(F.array_distinct(draws)).alias("idx"))
                   .join(pairs.hint("merge"), [row_key, "idx"])
                   .groupBy(row_key).agg(F.collect_set("idx").alias("_met")))
            todo = todo.join(met.hint("merge"), row_key, "left")
            gone = F.concat(gone, F.coalesce("_met", none))
        more = F.slice(F.array_except(draws, gone), 1, F.col("_target") - F.size("_held"))
        state = written(todo.select(row_key, "_target", "_width", "_never",
                                    F.concat("_held", more).alias("_held")), "picks")
        full = state.where(F.size("_held") >= F.col("_target")).select(row_key, "_held")
        finished = full if finished is None else finished.unionByName(full)
        todo = state.where(F.size("_held") < F.col("_target"))
        if todo.isEmpty():  # the usual case
            break
        # only short rows draw again, with twice as many numbers each round,
        # so even a row whose eligible set is a sliver of the pool finishes
        factor = min(2 * factor, MAX_SPAN)
        lo, span = lo + span, F.least(F.col("_width") * factor, F.lit(MAX_SPAN))
    return (finished.select(row_key, F.posexplode("_held").alias("_at", "idx")).join(_shared(indexed, n_pool), "idx")
            .select(row_key, (F.col("_at") + 1).alias("rank"), F.col("_pk").alias("pick")))


def _shared(indexed: DataFrame, n_pool: int) -> DataFrame:
    """The numbered pool for a join: sent to every task if small, else sorted and merged."""
    return F.broadcast(indexed) if n_pool <= SMALL_POOL else indexed.hint("merge")


def pick_by_rank(rows: DataFrame, row_key: str, k_col: str, pool: DataFrame, pool_key: str, seed: str,
                 exclude: DataFrame | None = None, self_excluded: bool = False) -> DataFrame:
    """(row_key, rank, pick): ``min(k, eligible)`` distinct picks per row, without rejection.

    As ``pick_from_pool``, but in one pass, however few members are eligible: a
    row draws distinct ranks among its eligible members (Floyd's method: draw i of
    k falls on 0 .. n - k + i, and takes the last of these if its number is taken),
    and rank r is mapped to the r-th member outside the row's excluded ones.  The i-th
    excluded place e stands before rank r exactly if e - i <= r, so the shift of a
    rank is a running count over excluded places and ranks in one order: a window that
    spills, never a list.  Repeated row keys count once (largest k); null row keys pick nothing.
    """
    key_type = pool.schema[pool_key].dataType
    indexed = written(dense_index(pool.select(F.col(pool_key).alias("_pk")).where("_pk is not null"), "_pk"), "pool")
    n_pool = indexed.count()
    base = (rows.where(F.col(row_key).isNotNull()).groupBy(F.col(row_key).alias("_row"))
            .agg(F.max(k_col).cast("bigint").alias("_k")))
    taken = []
    if exclude is not None:
        taken.append(exclude.select(F.col(exclude.columns[0]).alias("_row"), F.col(exclude.columns[1]).alias("_pk")))
    if self_excluded:
        taken.append(base.select("_row", F.col("_row").cast(key_type).alias("_pk")))
    per_row = Window.partitionBy("_row").orderBy("idx")
    if taken:
        pairs = taken[0] if len(taken) == 1 else taken[0].unionByName(taken[1])
        shifts = written(pairs.join(base.select("_row"), "_row", "left_semi").distinct().join(indexed, "_pk")
                         .select("_row", (F.col("idx") - F.row_number().over(per_row) + 1).alias("at"),
                                 F.lit(None).cast("bigint").alias("rank")), "excluded")
        base = base.join(shifts.groupBy("_row").agg(F.count(F.lit(1)).alias("_gone")), "_row", "left")
    else:
        shifts, base = None, base.withColumn("_gone", F.lit(0))
    eligible = F.lit(n_pool) - F.coalesce("_gone", F.lit(0))
    targets = base.select("_row", eligible.alias("_n"), F.least("_k", eligible).alias("_m")).where("_m > 0")

    def draw(held, i):
        top = F.col("_n") - F.col("_m") + i
        at = F.pmod(hash_draw("_row", i, seed=seed), top + 1)
        return F.concat(held, F.array(F.when(F.array_contains(held, at), top).otherwise(at)))

    ranks = F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.col("_m") - 1), F.array().cast("array<bigint>"), draw)
    drawn = targets.select("_row", F.posexplode(ranks).alias("rank", "at")).select(
        "_row", "at", (F.col("rank") + 1).cast("bigint").alias("rank"))
    if shifts is None:
        placed = drawn.withColumn("idx", F.col("at"))
    else:
        # excluded places first among equals: they shift the rank that they meet
        order = Window.partitionBy("_row").orderBy("at", F.asc_nulls_first("rank")).rowsBetween(
            Window.unboundedPreceding, 0)
        placed = drawn.unionByName(shifts).withColumn(
            "idx", F.col("at") + F.count(F.when(F.col("rank").isNull(), 1)).over(order)).where("rank is not null")
    return placed.join(indexed, "idx").select(F.col("_row").alias(row_key), "rank", F.col("_pk").alias("pick"))


def pick_one(rows: DataFrame, row_key: str, lookup: DataFrame, lookup_key: str,
             seed: str) -> DataFrame:
    """One seeded pick per row from ``lookup`` (a bounded list, e.g. 25 cities)."""
    indexed = dense_index(lookup, lookup_key)
    n = indexed.count()
    return (rows.withColumn("idx", F.pmod(hash_draw(row_key, seed=seed), F.lit(n)))
            .join(indexed, "idx").drop("idx"))


def number_of_reviewers(papers: DataFrame, key: str = "paperId", seed: str = "nrev") -> DataFrame:
    """2 or 3 reviewers per paper."""
    return papers.withColumn("number_reviewers",
                             (F.lit(2) + F.pmod(hash_draw(key, seed=seed), F.lit(2))).cast("int"))


def number_of_citations(papers: DataFrame, key: str = "paperId", seed: str = "ncite",
                        low: int = 15, high: int = 51) -> DataFrame:
    """low <= n < high citations per paper (upper bound exclusive)."""
    return papers.withColumn(
        "synthetic_cites",
        (F.lit(low) + F.pmod(hash_draw(key, seed=seed), F.lit(high - low))).cast("int"))
