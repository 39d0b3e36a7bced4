"""The author table of the load files (``authors_info``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import to_int
from . import synth
from .ranked import numbered
from .upsert import dedupe_keep_first

# Rows of the two institution lists that are drawn from, counted from 0, end exclusive.
UNIVERSITY_ROWS = (1, 51)
COMPANY_ROWS = (0, 50)


def _slice(names: DataFrame, order: str, rows: tuple[int, int]) -> DataFrame:
    """(affiliation): the rows [first, end) of a list in its order."""
    placed = numbered(names, [order], "_at")
    return placed.where((F.col("_at") >= rows[0]) & (F.col("_at") < rows[1])).select("affiliation")


def process_authors(raw_authors: DataFrame, universities: DataFrame, companies: DataFrame,
                    order: str = "position", university_rows: tuple[int, int] = UNIVERSITY_ROWS,
                    company_rows: tuple[int, int] = COMPANY_ROWS, seed: str = "aff") -> DataFrame:
    """(authorId bigint, name, Affiliations, Affiliation_type): one row per author.

    Rows without an id go; of several rows of an author the first in ``order``
    stays.  ``universities`` and ``companies`` are (affiliation, position) lists;
    the affiliation is a seeded draw from both slices together, and it is a
    university's if the university slice has it.
    """
    authors = raw_authors.withColumn("authorId", to_int("authorId")).where(F.col("authorId").isNotNull())
    authors = dedupe_keep_first(authors.select("authorId", order, "name"), ["authorId"], [order, "name"])
    unis = _slice(universities, "position", university_rows)
    pool = unis.unionByName(_slice(companies, "position", company_rows))
    picked = synth.pick_one(authors.select("authorId", "name"), "authorId", pool, "affiliation", seed=seed)
    known = unis.distinct().withColumn("_u", F.lit(True))
    return picked.join(known, "affiliation", "left").select(
        "authorId", "name", F.col("affiliation").alias("Affiliations"),
        F.when(F.col("_u"), F.lit("university")).otherwise(F.lit("company")).alias("Affiliation_type"))
