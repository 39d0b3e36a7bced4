"""Repeated word windows by level-wise doubling.

A window is `window` consecutive words (`[^\\x20\\x09-\\x0D]+`) of one
document; every word that lies in a window whose word sequence also starts
anywhere else (the same document included) is removed.

Levels double from about half a window up to the window (35: 18, 35).  At each
level the windows of that length alone are grouped by hash, and only those that
occur at least twice are extended to twice the length.  Below the last level
not every short window has to be looked at: each target window is stood for by
its minimizer, the smallest-hashed short window inside it.  Equal target
windows have equal minimizers, so a target window whose minimizer is unique is
unique and needs no further level.  The last level looks at whole windows,
with a 64-bit and a 32-bit check hash.

Exact copies are settled first: all words of a text of `window` words or more
that occurs twice are removed, and one copy stands for its class in the levels.
Repeated rows count as separate documents, null and empty texts have no words,
and rows with a null doc_id are kept: documents are told apart by a 64-bit hash
of id and text.  Hot hashes never meet in one task (see `_with_lists`).  The
texts are shuffled once; all levels reuse that exchange.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Powers, arrow_batches, chunks, hashed_words, of_worker, utf8, windowed, written

BASE = 18
#: Hot hashes are looked for on one document in SAMPLED.
SAMPLED, HOT_SHARE = 16, 0.001
_CHECK_ROOT = 0xD6E8FEB86659FD93


def levels(window: int, base: int = BASE) -> list[int]:
    """Window lengths, doubling up to `window`."""
    out = [window]
    while out[-1] > base:
        out.append(-(-out[-1] // 2))
    return out[::-1]


def rolling(words: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Hash of the `length` words at each start."""
    starts = np.arange(max(0, len(words) - length + 1))
    return windowed(words, starts, starts + length, powers)


def minimizers(hashes: np.ndarray, reach: int) -> np.ndarray:
    """For each run of `reach` hashes, the place of its smallest (the first one)."""
    best, at, have = hashes, np.arange(len(hashes)), 1
    while have < reach and len(best):  # minimum over `have` places, doubled
        step = min(have, reach - have)
        m = max(0, len(best) - step)
        later = best[step:] < best[:m]
        at = np.where(later, at[step:], at[:m])
        best = np.where(later, best[step:], best[:m])
        have += step
    return at


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed UTF-8: they are shuffled once and read four times."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        texts = [packer.compress(utf8(t)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["k"], pa.array(texts, pa.binary())],
                                         ["doc_id", "k", "text"])


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(t) for t in batch["text"].to_pylist()]


def _emit(window: int, sizes: list[int], level: int):
    """Rows (h, k, place) of the selected windows of a level; place: check hash and start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, check_powers = of_worker("substring_dedup", lambda: (Powers(), Powers(_CHECK_ROOT)))
        for batch in batches:
            texts = _texts(batch)
            keys = batch["k"].to_numpy()
            for lo, hi in chunks(texts):
                words, counts = hashed_words(texts[lo:hi], powers)
                if len(words) < window:
                    continue
                firsts = np.cumsum(counts) - counts
                left = np.repeat(firsts + counts, counts) - np.arange(len(words))
                ok = left[:len(words) - window + 1] >= window
                for earlier in range(level):  # the minimizers of all earlier levels were repeated
                    lists = batch[f"s{earlier}"].slice(lo, hi - lo)
                    n = lists.value_lengths().fill_null(0).to_numpy()
                    kept = np.zeros(len(words), bool)
                    kept[np.repeat(firsts, n) + lists.flatten().to_numpy()] = True
                    ok &= kept[minimizers(rolling(words, sizes[earlier], powers),
                                          window - sizes[earlier] + 1)]
                hashes = rolling(words, sizes[level], powers)
                chosen = np.zeros(len(words), bool)
                chosen[minimizers(hashes, window - sizes[level] + 1)[ok]] = True
                at = np.flatnonzero(chosen)
                if len(at):
                    text = np.repeat(np.arange(hi - lo), counts)[at]
                    place = at - firsts[text]
                    if level == len(sizes) - 1:
                        check = windowed(words, at, at + window, check_powers) >> np.uint64(32)
                        place |= check.view(np.int64) << 32
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(hashes[at].view(np.int64)), pa.array(keys[lo + text]), pa.array(place)],
                        ["h", "k", "place"])

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n_words, n_removed = [], [], []
            for text, copied, starts in zip(_texts(batch), batch["copied"].to_pylist(),
                                            batch["starts"].to_pylist(), strict=True):
                words = text.split()
                n_words.append(len(words))
                if copied and len(words) >= window:
                    words = []
                elif starts and not copied:
                    edge = np.zeros(len(words) + 1, np.int64)
                    starts = np.unique(np.asarray(starts, np.int64))
                    edge[starts] += 1
                    edge[starts + window] -= 1
                    covered = np.cumsum(edge)[:-1] > 0
                    words = [w for w, c in zip(words, covered.tolist(), strict=True) if not c]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(kept, pa.string()), pa.array(n_words, pa.int64()),
                 pa.array(n_removed, pa.int64())], ["doc_id", "kept_text", "n_words", "n_removed"])

    return run


def _with_lists(docs: DataFrame, emit, n_docs: int, name: str) -> DataFrame:
    """Attach to each document the starts of its rows that are repeated.

    One shuffle deals the rows out by hash.  Hashes of more than about a
    thousandth of all documents are found beforehand on one document in 16;
    they are known to be repeated, so their rows are dealt out at random.
    """
    rows = lambda part: emit(part).select(
        "h", F.shiftright("place", 32).cast("int").alias("chk"), "k",
        F.col("place").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("at"))
    # at most 1000 times the mean number of rows per document
    hot = (rows(docs.filter(F.pmod("k", F.lit(SAMPLED)) == 0)).groupBy("h", "chk").count()
           .filter(F.col("count") >= max(4, n_docs * HOT_SHARE / SAMPLED))
           .select("h", "chk", F.lit(True).alias("hot")))
    dealt = rows(docs).join(F.broadcast(hot), ["h", "chk"], "left").select(
        F.when(F.col("hot"), F.xxhash64("k", "at")).otherwise(F.col("h")).alias("h"), "chk", "k",
        F.when(F.col("hot"), -1 - F.col("at")).otherwise(F.col("at")).alias("at"))
    n = F.count("*").over(Window.partitionBy("h", "chk"))
    lists = (dealt.withColumn("n", n).filter("n > 1 or at < 0").groupBy("k")
             .agg(F.collect_list(F.when(F.col("at") < 0, -1 - F.col("at")).otherwise(F.col("at"))).alias(name)))
    return docs.join(lists, "k", "left")


def substring_dedup(docs: DataFrame, window: int = 35) -> DataFrame:
    """Per document: doc_id, kept_text (words joined by one space), n_words, n_removed."""
    if window < 1:
        raise ValueError("a window has at least one word")
    arrow_batches(docs.sparkSession)
    sizes = levels(window)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.xxhash64("doc_id", "text").alias("k"))
    twins = docs.select("k", F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"))
    # written, so that a hot class can be split in the join
    classes = written(twins.groupBy("t1", "t2").agg(F.count("*").alias("n"), F.min("k").alias("lead"))
                      .filter("n > 1").select("t1", "t2", "lead"), "copies")
    copies = (twins.join(classes, ["t1", "t2"]).groupBy("k")
              .agg(F.max(F.col("k") != F.col("lead")).alias("skip")))
    held = docs.mapInArrow(_squeeze, "doc_id long, k long not null, text binary not null").join(copies, "k", "left")
    n_docs = docs.count()
    for level in range(len(sizes)):
        earlier = [f"s{i}" for i in range(level)]

        def emit(part: DataFrame, level=level, earlier=earlier) -> DataFrame:
            alive = part.filter(" and ".join(["not coalesce(skip, false)",
                                              *(f"{s} is not null" for s in earlier)]))
            # doc_id rides along: with other columns the exchange of the texts would not be reused
            return alive.select("doc_id", "k", "text", *earlier).mapInArrow(
                _emit(window, sizes, level), "h long, k long, place long")

        held = _with_lists(held, emit, n_docs, f"s{level}")
    return held.select("doc_id", "text", F.col("skip").isNotNull().alias("copied"),
                       F.col(f"s{len(sizes) - 1}").alias("starts")).mapInArrow(
        _cut(window), "doc_id long, kept_text string, n_words long, n_removed long")


def digest(out: DataFrame) -> DataFrame:
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
