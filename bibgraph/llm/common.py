"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: Characters that one vectorised numpy step works on; bounds a Python worker's memory.
CHUNK_CHARS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def arrow_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Lower the Arrow batch size so that a batch of long texts fits a Python worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows:
        spark.conf.set(key, str(rows))


def sampled(rows: DataFrame, size: int, seed: str, total: int | None = None) -> DataFrame:
    """At most `size` of the rows (doc_id, text, ...), drawn by a hash of id and text.

    Rows equal in both share their draw; where that leaves none, any `size` rows are taken.
    """
    total = rows.count() if total is None else total
    if total <= size:
        return rows
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)
    # a margin above the wanted share, then the smallest draws: never more than `size`
    some = rows.withColumn("_draw", draw).filter(F.col("_draw") < 1.2 * size / total + 50 / total)
    some = rows.withColumn("_draw", F.lit(0.0)) if some.isEmpty() else some
    return some.orderBy("_draw").limit(size).drop("_draw")


def released(run):
    """A task function on Arrow batches that hands freed memory back to the system when its partition ends."""
    def tidy(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        pa.system_memory_pool().release_unused()

    return tidy


def of_worker(operator: str, make):
    """A table shared by the tasks of one Python worker.

    A worker keeps one operator's table at a time: what another operator left
    is dropped, so that idle workers hold little memory.
    """
    held = sys.modules.setdefault("_bibgraph_worker", types.ModuleType("_bibgraph_worker")).__dict__
    if held.get("operator") != operator:
        held.pop("table", None)
        held["table"], held["operator"] = make(), operator
    return held["table"]


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id's decimal text; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))


def utf8(text: str | bytes | None) -> bytes:
    if isinstance(text, bytes):
        return text
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def chunks(texts, limit: int = CHUNK_CHARS):
    """Consecutive index ranges whose texts hold about `limit` characters."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        n = len(text) if text is not None else 0
        if held and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


_ROOT = 0x9E3779B97F4A7C15  # odd: it has an inverse modulo 2**64
_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, np.uint64)
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_NO_TERM = ~np.isin(np.arange(256), [*range(48, 58), *range(97, 123), *range(128, 256)])
_LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


class Powers:
    """Powers of a root and of its inverse modulo 2**64, kept and grown on demand."""

    def __init__(self, root: int = _ROOT):
        self.roots, self.held = (root, pow(root, -1, 1 << 64)), {}

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held.get(0, ())) < n:
            for side, root in enumerate(self.roots):
                table = np.full(n + n // 4 + 1, root, np.uint64)
                table[0] = 1
                self.held[side] = np.multiply.accumulate(table)
        return self.held[0][:n], self.held[1][:n]


def windowed(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hash, modulo 2**64, of values[start:end] for each pair; equal contents hash alike."""
    up, down = powers.get(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def hashed_words(texts, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of other bytes than ASCII white space), and the word count of each text."""
    joined, text_ends = _joined(texts)
    return _hashed_runs(joined, _SPACE, text_ends, powers)


def hashed_terms(texts, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all terms (runs of ASCII letters, lower-cased, digits and other than ASCII), and each text's count."""
    joined, text_ends = _joined(texts)
    return _hashed_runs(_LOWERED[joined], _NO_TERM, text_ends, powers)


def _joined(texts) -> tuple[np.ndarray, np.ndarray]:
    raw = [utf8(t) for t in texts]
    return (np.frombuffer(b"\n".join(raw) + b"\n", np.uint8),
            np.cumsum(np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))))


def counted_terms(texts) -> np.ndarray:
    """Number of terms of each text."""
    joined, text_ends = _joined(texts)
    starts = np.flatnonzero(np.diff(_NO_TERM[_LOWERED[joined]], prepend=True))[::2]
    return np.diff(np.searchsorted(starts, text_ends), prepend=0)


def _hashed_runs(joined: np.ndarray, between: np.ndarray, text_ends: np.ndarray, powers: Powers):
    edge = np.flatnonzero(np.diff(between[joined], prepend=True))  # run starts and ends take turns
    starts, ends = edge[::2], edge[1::2]
    counts = np.diff(np.searchsorted(starts, text_ends), prepend=0)
    return windowed(_BYTE_VALUES[joined], starts, ends, powers), counts


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser, element-wise on uint64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
