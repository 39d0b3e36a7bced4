"""Global row order without a single-task window.

Rows are dealt out by range, sorted and written with their place in their partition;
per-partition counts (one small row per partition reaches the driver) turn places
inside a partition into global places.  Neighbours are seen inside blocks of
consecutive rows: the first and the last row of a block are copied to the block before
and after, so blocks are of one size, and so are tasks, at every size of the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import partitions_for, written

#: monotonically_increasing_id holds the partition above and the place in it below this bit.
PLACE_BITS = 33
#: Consecutive rows that see their neighbours in one window partition.
BLOCK = 1 << 14


def numbered(rows: DataFrame, order: Sequence[str], name: str = "idx", first: int = 0) -> DataFrame:
    """Rows with a dense number in the given order; equal rows are numbered in any order."""
    return _numbered(rows, list(order), name, first)[0]


def with_neighbours(rows: DataFrame, order: Sequence[str], name: str = "idx", first: int = 0) -> DataFrame:
    """Rows with a dense number, and ``_prev`` / ``_next``: structs of the rows before and after."""
    whole = F.struct(*order, *[c for c in rows.columns if c not in order])
    held, n_rows = _numbered(rows, list(order), name, first)
    own, place = F.floor((F.col(name) - first) / BLOCK), F.pmod(F.col(name) - first, F.lit(BLOCK))
    copies = F.array(own, F.when(place == 0, own - 1), F.when(place == BLOCK - 1, own + 1))
    spread = held.withColumn("_block", F.explode(F.array_compact(copies))).repartition(
        partitions_for(rows.sparkSession, n_rows), "_block")
    w = Window.partitionBy("_block").orderBy(name)
    return (spread.withColumn("_prev", F.lag(whole).over(w)).withColumn("_next", F.lead(whole).over(w))
            .where(own == F.col("_block")).drop("_block"))


def _numbered(rows: DataFrame, order: list[str], name: str, first: int) -> tuple[DataFrame, int]:
    """The numbered rows and how many there are."""
    spark = rows.sparkSession
    held = written(rows.repartitionByRange(partitions_for(spark, rows.count()), *order).sortWithinPartitions(*order)
                   .withColumn("_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftright("_at", PLACE_BITS).cast("int")
    counts = sorted(held.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row each
    offsets, run = [], first
    for pid, n in counts:
        offsets.append((pid, run))
        run += n
    table = F.broadcast(spark.createDataFrame(offsets, "_pid int, _off bigint"))
    place = F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return (held.withColumn("_pid", part).join(table, "_pid").withColumn(name, F.col("_off") + place)
            .drop("_pid", "_off", "_at")), run - first
