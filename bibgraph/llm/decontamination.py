"""Benchmark decontamination by suffix arrays over the training documents.

Terms are runs of ASCII letters (lower-cased), digits and other than ASCII.  A
window is `window` consecutive terms of a benchmark item; an item of fewer, but not
none, is one window.  Documents are dealt into shards of about SHARD_CHARS
characters, whole documents each.  A task builds the suffix array of its shard
(term suffixes in hash order, by prefix doubling), binary-searches every test
suffix, term by term, and obtains all its occurrences.  Occurrences of one item that
follow one another on a diagonal make up the longest verbatim matches.  Documents
with an occurrence are affected; `decontaminated` removes them.

The benchmark is read in blocks of about BLOCK_CHARS characters of whole items; a
block of test suffixes is all that travels with a task, and each block meets every
document (one pass over the documents a block; a benchmark of usual size is one block).

Defined results: a null or empty text has no terms and is clean; items without terms
find nothing, and an empty benchmark leaves every document clean.  Rows of one item_id
are one item, a null item_id counts as an item `null`.  Repeated documents each have a
row.  Texts of any length are searched whole: a document is never cut between shards.
Equality of terms is that of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Powers, chunks, hashed_terms, of_worker, windowed

WINDOW = 10
SHARD_CHARS = 1_500_000
BLOCK_CHARS = 2_000_000
_FOUND = "n_words long, hits array<int>, items array<string>, longest long"


@dataclass
class TestSuffixes:
    """Distinct windows of a block of items: their terms, and the (item, start) places of each."""

    terms: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    first: np.ndarray   # places of window w: first[w]:first[w + 1]
    item: np.ndarray
    at: np.ndarray
    names: list[str]


def test_suffixes(items: list[tuple[str, str]], window: int) -> TestSuffixes:
    """Windows of (name, text) items."""
    powers = Powers()
    terms, counts = hashed_terms([text for _, text in items], powers)
    ends = np.cumsum(counts)
    have = np.maximum(0, np.minimum(counts, np.maximum(1, counts - window + 1)))  # windows of each item
    item = np.repeat(np.arange(len(items)), have)
    at = np.arange(have.sum()) - np.repeat(np.cumsum(have) - have, have)
    starts = np.repeat(ends - counts, have) + at
    lengths = np.minimum(window, counts[item])
    same = windowed(terms, starts, starts + lengths, powers)
    _, chosen, of = np.unique(same, return_index=True, return_inverse=True)
    order = np.argsort(of, kind="stable")
    return TestSuffixes(terms, starts[chosen], lengths[chosen],
                        np.searchsorted(of[order], np.arange(len(chosen) + 1)), item[order].astype(np.int32),
                        at[order].astype(np.int32), [name for name, _ in items])


def suffix_array(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Starts ordered by their first `depth` ranks at least (fewer at the end), by prefix doubling."""
    n, reach = len(ranks), 1
    order, named = np.argsort(ranks), ranks.astype(np.int64)
    while reach < depth and n:
        key = named * (n + 1)
        key[:max(0, n - reach)] += named[reach:] + 1
        order = np.argsort(key)
        step = np.diff(key[order], prepend=key[order[0]]) != 0
        named[order] = np.cumsum(step)
        reach *= 2
    return order


def occurrences(ranks: np.ndarray, order: np.ndarray, tests: np.ndarray, starts: np.ndarray,
                lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval of the suffix array that begins with tests[start:start + length], for each test suffix.

    Binary search, one term deeper each time; both edges of all open intervals move together.
    """
    lo, hi = np.zeros(len(starts), np.int64), np.full(len(starts), len(order))
    padded = np.append(ranks, np.zeros(int(lengths.max(initial=1)), ranks.dtype))
    for depth in range(int(lengths.max(initial=0))):
        live = np.flatnonzero((lengths > depth) & (hi > lo))
        term = tests[starts[live] + depth]
        for edge, after in ((lo, False), (hi, True)):
            a, b = lo[live].copy(), hi[live].copy()
            while len(open_ := np.flatnonzero(a < b)):
                mid = (a[open_] + b[open_]) >> 1
                found = padded[order[mid] + depth]
                right = found <= term[open_] if after else found < term[open_]
                a[open_] = np.where(right, mid + 1, a[open_])
                b[open_] = np.where(right, b[open_], mid)
            if after:
                hi[live] = a
            else:
                new_lo = a
        lo[live] = new_lo
    return lo, hi


def search_shard(texts, block: TestSuffixes, powers: Powers):
    """Per text: term count, and (hit places, item numbers, longest match), or None if it is clean."""
    terms, counts = hashed_terms(texts, powers)
    out: list = [None] * len(counts)
    if not len(terms) or not len(block.starts):
        return counts, out
    known, ranks = np.unique(terms, return_inverse=True)
    doc_of = np.repeat(np.arange(len(counts)), counts)
    places = np.arange(len(terms)) + doc_of  # a separator of rank 0 follows each document
    joined = np.zeros(len(terms) + len(counts), np.int64)
    joined[places] = ranks + 1
    at = np.searchsorted(known, block.terms)
    tests = np.where(known[np.minimum(at, len(known) - 1)] == block.terms, at + 1, -1)
    order = suffix_array(joined, int(block.lengths.max()))
    lo, hi = occurrences(joined, order, tests, block.starts, block.lengths)
    n = hi - lo
    which = np.repeat(np.arange(len(n)), n)
    where = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
    firsts = np.cumsum(counts) - counts + np.arange(len(counts))
    doc = np.searchsorted(firsts, where, side="right") - 1
    by_doc = np.argsort(doc, kind="stable")
    which, where, doc = which[by_doc], (where - firsts[doc])[by_doc], doc[by_doc]
    edges = np.flatnonzero(np.diff(doc, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        out[doc[a]] = _in_document(where[a:b], which[a:b], int(counts[doc[a]]), block)
    return counts, out


def _in_document(where: np.ndarray, which: np.ndarray, n_words: int, block: TestSuffixes):
    edge = np.zeros(n_words + 1, np.int64)
    np.add.at(edge, where, 1)
    np.add.at(edge, where + block.lengths[which], -1)
    hits = np.flatnonzero(np.cumsum(edge)[:-1] > 0)
    n = block.first[which + 1] - block.first[which]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(block.first[which], n)
    item, start = block.item[place].astype(np.int64), np.repeat(where, n)
    diagonal = start - block.at[place]
    by = np.lexsort((start, diagonal, item))
    item, start, diagonal = item[by], start[by], diagonal[by]
    lengths = np.repeat(block.lengths[which], n)[by]
    broken = (np.diff(item, prepend=-1) != 0) | (np.diff(diagonal, prepend=0) != 0) | (np.diff(start, prepend=-1) != 1)
    broken[0] = True
    run = np.diff(np.append(np.flatnonzero(broken), len(broken)))
    return hits, np.unique(item), int((run - 1 + lengths[broken]).max())


def _searched(block: TestSuffixes, columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = of_worker("decontamination", Powers)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for lo, hi in chunks(texts, SHARD_CHARS):
                counts, found = search_shard(texts[lo:hi], block, powers)
                hits = [f[0] if f else [] for f in found]
                names = [[block.names[i] for i in f[1].tolist()] if f else [] for f in found]
                yield pa.RecordBatch.from_arrays(
                    [*(batch[c].slice(lo, hi - lo) for c in columns), pa.array(counts, pa.int64()),
                     pa.array(hits, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string())),
                     pa.array([f[2] if f else 0 for f in found], pa.int64())],
                    [*columns, "n_words", "hits", "items", "longest"])

    return run


def blocks_of(benchmark: DataFrame, window: int, block_chars: int) -> Iterator[TestSuffixes]:
    """The benchmark's items in blocks; at least one, which may be empty."""
    held, size, any_block = [], 0, False
    items = benchmark.filter("text is not null").select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "text")
    for name, text in items.toLocalIterator():
        if held and size + len(text) > block_chars:
            yield test_suffixes(held, window)
            held, size, any_block = [], 0, True
        held.append((name, text))
        size += len(text)
    if held or not any_block:
        yield test_suffixes(held, window)


def search(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, n_words, hits (places of hit words), items (with occurring windows, in order of their text) and longest
    (words of the longest verbatim match) of every document."""
    if window < 1:
        raise ValueError("a window has at least one word")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    keyed = rows.select("doc_id", "text", F.xxhash64("text").alias("k1"), F.xxhash64(F.lit(1), "text").alias("k2"))
    passes = []
    for block in blocks_of(benchmark, window, block_chars):
        passes.append(keyed.mapInArrow(_searched(block, ["doc_id", "k1", "k2"]),
                                       f"doc_id long, k1 long, k2 long, {_FOUND}"))
    if len(passes) == 1:
        return passes[0].select("doc_id", "n_words", "hits", F.array_sort(F.array_distinct("items")).alias("items"),
                                "longest")
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    # equal rows have equal results, once per row and pass
    merged = found.groupBy("doc_id", "k1", "k2").agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        F.max("longest").alias("longest"), (F.count("*") / len(passes)).cast("long").alias("rows"))
    return merged.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), "rows"))).select(
        "doc_id", "n_words", "hits", "items", "longest")


def digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"),
                        F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.size("hits") > 0).alias("contaminated"), "longest")


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of docs, every column, without the documents that hold a window of the benchmark."""
    out, schema = docs, docs.schema
    for block in blocks_of(benchmark, window, BLOCK_CHARS):
        out = out.mapInArrow(_clean(block), schema)
    return out


def _clean(block: TestSuffixes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = of_worker("decontamination", Powers)
        for batch in batches:
            texts = batch["text"].to_pylist()
            for lo, hi in chunks(texts, SHARD_CHARS):
                _, found = search_shard(texts[lo:hi], block, powers)
                yield batch.slice(lo, hi - lo).filter(pa.array([f is None for f in found]))

    return run


def result(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return digest(search(docs, benchmark))


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL of result()."""
    words = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    cut = "array_to_string(w[p:p + {n} - 1], ' ')"
    return f"""WITH item AS (
  SELECT coalesce(item_id::VARCHAR, 'null') AS item, {words} AS w, row_number() OVER () AS row_no
  FROM benchmark WHERE text IS NOT NULL),
test AS (
  SELECT item, row_no, p, least(len(w), {window}) AS n, {cut.format(n=f"least(len(w), {window})")} AS words
  FROM (SELECT *, unnest(range(1, greatest(len(w) - {window}, 0) + 2)) AS p FROM item WHERE len(w) > 0)),
doc AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, doc_id, CASE WHEN text IS NULL THEN [] ELSE {words} END AS w FROM documents),
place AS (SELECT row_no, w, unnest(range(1, len(w) + 1)) AS p FROM doc),
found AS (
  SELECT row_no, p, n, words FROM (
    SELECT row_no, p, n, {cut.format(n="n")} AS words
    FROM place, (SELECT DISTINCT n FROM test) WHERE p + n - 1 <= len(w)) SEMI JOIN test USING (n, words)),
hit AS (SELECT row_no, count(DISTINCT q) AS n_hit
        FROM (SELECT row_no, unnest(range(p, p + n)) AS q FROM found) GROUP BY 1),
met AS MATERIALIZED (
  SELECT f.row_no, t.item, t.row_no AS item_row, f.p, f.p - t.p AS diagonal, f.n
  FROM found f JOIN test t USING (n, words)),
named AS (SELECT row_no, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS s
          FROM met GROUP BY 1),
run AS (
  SELECT row_no, max(c) AS longest FROM (
    SELECT row_no, count(*) + max(n) - 1 AS c FROM (
      SELECT *, p - row_number() OVER (PARTITION BY row_no, item_row, diagonal ORDER BY p) AS isle FROM met)
    GROUP BY row_no, item_row, diagonal, isle) GROUP BY 1)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(m.n_items, 0)::BIGINT AS n_items, coalesce(m.s, sha256('')) AS items_sha256,
       h.n_hit IS NOT NULL AS contaminated, coalesce(r.longest, 0)::BIGINT AS longest
FROM doc d LEFT JOIN hit h USING (row_no) LEFT JOIN named m USING (row_no) LEFT JOIN run r USING (row_no)"""
