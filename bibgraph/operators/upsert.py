"""First-writer / last-writer upserts and keep-first de-duplication.

The reference loads rows with ``MERGE``: a node keeps the properties of the
first row that created it, an edge takes the properties of the last row that
touched it.  Here precedence is an explicit ordering column list (normally
``file_no, row_no``) and the winner is picked with ``min``/``max`` of a struct
— an ordinary aggregate, so partial aggregation collapses a hot key on the
map side instead of sorting all its rows into one window partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ORDER = ("file_no", "row_no")


def _pick(rows: DataFrame, keys: Sequence[str], props: Sequence[str],
          order: Sequence[str], last: bool) -> DataFrame:
    keys, props, order = list(keys), list(props), list(order)
    if not props:
        return rows.select(*keys).distinct()
    agg = F.max if last else F.min
    picked = rows.groupBy(*keys).agg(agg(F.struct(*order, *props)).alias("_w"))
    return picked.select(*keys, *[F.col(f"_w.{p}").alias(p) for p in props])


def merge_nodes_first_wins(rows: DataFrame, key: str | Sequence[str],
                           props: Sequence[str], order: Sequence[str] = ORDER,
                           existing: DataFrame | None = None) -> DataFrame:
    """``MERGE (n {key}) ON CREATE SET props``: one node per key, first row's props.

    With ``existing`` nodes, keys already present keep their old properties.
    """
    keys = [key] if isinstance(key, str) else list(key)
    new = _pick(rows, keys, props, order, last=False)
    if existing is None:
        return new
    return existing.unionByName(new.join(existing.select(*keys), keys, "left_anti"))


def merge_edges_last_wins(rows: DataFrame, keys: Sequence[str], props: Sequence[str],
                          order: Sequence[str] = ORDER,
                          existing: DataFrame | None = None) -> DataFrame:
    """``MERGE (a)-[r]->(b) SET r.props``: one edge per key pair, last row's props.

    With ``existing`` edges, properties not set by the new rows are kept
    (schema evolution adds columns to old edges).
    """
    keys = list(keys)
    if props and existing is not None and sorted(existing.columns) == sorted(keys):
        return _evolved(rows, keys, list(props), list(order), existing)
    new = _pick(rows, keys, props, order, last=True)
    if existing is None:
        return new
    old_props = [c for c in existing.columns if c not in keys]
    new = new.withColumn("_hit", F.lit(True))
    joined = existing.join(new, keys, "full_outer")
    cols = [F.col(k) for k in keys]
    for p in dict.fromkeys(old_props + list(props)):
        if p in props and p in old_props:
            # SET overwrites (also with null) on touched edges only
            cols.append(F.when(F.col("_hit"), new[p]).otherwise(existing[p]).alias(p))
        else:
            cols.append(F.col(p))
    return joined.select(*cols)


def _evolved(rows: DataFrame, keys: list[str], props: list[str], order: list[str],
             existing: DataFrame) -> DataFrame:
    """Edges without properties get them: one aggregate over old and new rows instead of a full outer join.

    Both inputs keep the partitioning that made them (by one of the keys, say), where a join
    on all keys would shuffle old edges and winners once more.  As in a join, an old edge that
    comes twice is returned twice, and keys with a null meet nothing.
    """
    apart = F.when(reduce(or_, [F.col(k).isNull() for k in keys]), F.col("_old"))
    old = existing.select(*keys, F.lit(True).alias("_old"))
    new = rows.select(*keys, F.lit(False).alias("_old"), F.struct(*order, *props).alias("_w"))
    merged = (old.unionByName(new, allowMissingColumns=True).groupBy(*keys, apart.alias("_apart"))
              .agg(F.max("_w").alias("_w"), F.count_if("_old").alias("_n")))
    one = F.lit(1).cast("bigint")
    return (merged.select(*keys, "_w", F.explode(F.sequence(one, F.greatest("_n", one))).alias("_copy"))
            .select(*keys, *[F.col(f"_w.{p}").alias(p) for p in props]))


def dedupe_keep_first(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``drop_duplicates(subset=keys)``: keep the first row in ``order`` for each key."""
    keys, order = list(keys), list(order)
    rest = [c for c in rows.columns if c not in keys and c not in order]
    picked = rows.groupBy(*keys).agg(F.min(F.struct(*order, *rest)).alias("_w"))
    return picked.select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest]) \
        .select(*rows.columns)
