"""Ranked lexical search over K2-treaps of the term-document grid.

Terms are the maximal runs of ASCII letters (lower-cased), digits and other than
ASCII.  A document's score for an item sums w * impact over the item's terms, repeats
included; impact = (10**9 * tf) div (1000 * tf + 12 * m), m = 75 + (25 * n * N) div L,
w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

Index: documents are dealt into shards of about SHARD_CHARS characters, whole
documents each.  A shard's grid has a row per term, frequent ones first, and a column
per document; a cell holds its impact.  The K2-treap halves rows and columns level by
level (rows alone at the top, where there are more of them) and stores the non-empty
cells only: four bits per cell for its quarters, and for each quarter how much its
impact maximum falls below its parent's.  A shard is one row of the written index.

Search: in each shard an item's terms are row paths that descend together.  A state
is a range of documents with each path's cell; the weighted sum of the cells' maxima
bounds every score in it.  The states of the highest bounds are halved first, in
batches; a state of one document has its exact score.  States below the k-th score
found so far are left.  All states that can reach it are opened, so the result is
exact.  Each shard's k best meet in one ranking per item.

Items come in blocks of about BLOCK_CHARS characters of whole items; the terms and
weights of one block travel with a task, and each block is a pass over the index.

Defined results: a null or empty text, of a document or an item, has no terms; such
documents are not ranked and such items have no rows.  Every row of the items is ranked by itself,
also if ids repeat.  Repeated documents are documents of their own; equal scores go
by ascending doc_id, null last.  Empty tables give no rows.  Equality of terms is that
of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Powers, chunks, counted_terms, hashed_terms, of_worker, written

SHARD_CHARS = 4_000_000
BLOCK_CHARS = 1_000_000
TOP = 20
#: States opened at a time in the joint descent.
BATCH = 64
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_COUNT = np.array([bin(m).count("1") for m in range(16)], np.int64)
_INDEX = "docs array<long>, shape array<int>, terms binary, df binary, cells binary, falls binary"


# -- the treap ----------------------------------------------------------------------------------

@dataclass
class Treap:
    """Cells of all levels, root first: quarters (four bits), number of the first quarter, impact maximum."""

    quarters: np.ndarray
    first: np.ndarray
    best: np.ndarray
    row_bits: int
    col_bits: int

    @property
    def top(self) -> int:
        """Levels that halve rows alone (twice each)."""
        return (self.row_bits - self.col_bits) // 2


def bits_of(rows: int, cols: int) -> tuple[int, int]:
    col_bits = max(1, (cols - 1).bit_length())
    row_bits = max(col_bits, (rows - 1).bit_length())
    return row_bits + (row_bits - col_bits) % 2, col_bits


def _interleaved(rows: np.ndarray, cols: np.ndarray, col_bits: int) -> np.ndarray:
    """Cell numbers: two bits a level, rows alone first, then row and column bits in turn."""
    code = rows >> col_bits
    for bit in range(col_bits - 1, -1, -1):
        code = (code << 2) | (((rows >> bit) & 1) << 1) | ((cols >> bit) & 1)
    return code


def grow(rows: np.ndarray, cols: np.ndarray, impacts: np.ndarray, shape: tuple[int, int]):
    """Quarters and falls of all levels below the root, and the root's maximum; (row, col) pairs are distinct."""
    row_bits, col_bits = bits_of(*shape)
    code = _interleaved(rows, cols, col_bits)
    order = np.argsort(code)
    code, best = code[order], impacts[order]
    quarters, falls = [], []
    for _ in range((row_bits - col_bits) // 2 + col_bits):
        start = np.flatnonzero(np.diff(code >> 2, prepend=-1))
        above = np.maximum.reduceat(best, start)
        quarters.append(np.bitwise_or.reduceat(np.left_shift(1, code & 3), start).astype(np.uint8))
        falls.append((np.repeat(above, np.diff(np.append(start, len(code)))) - best).astype(np.uint32))
        code, best = code[start] >> 2, above
    return quarters[::-1], falls[::-1], int(best[0])


def packed(quarters, falls, root: int) -> tuple[bytes, bytes]:
    flat = np.concatenate(quarters)
    flat = np.append(flat, np.zeros(len(flat) % 2, np.uint8))
    falls = np.concatenate([np.array([root], np.uint32), *falls])
    squeeze = zstandard.ZstdCompressor(level=3).compress
    planes = falls.view(np.uint8).reshape(-1, 4).T  # bytes of one weight lie together
    return squeeze((flat[::2] | (flat[1::2] << 4)).tobytes()), squeeze(np.ascontiguousarray(planes).tobytes())


def unpacked(cells: bytes, falls: bytes, shape: tuple[int, int]) -> Treap:
    """The treap of packed(); one cell without quarters is added at the end, for paths that have ended."""
    raw = zstandard.ZstdDecompressor().decompress
    planes = np.frombuffer(raw(falls), np.uint8).reshape(4, -1)
    fall = np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)
    both = np.frombuffer(raw(cells), np.uint8)
    n = len(fall)  # cells of all levels, the lowest included
    quarters = np.zeros(n + 1, np.uint8)
    inner = np.empty(2 * len(both), np.uint8)
    inner[::2], inner[1::2] = both & 15, both >> 4
    quarters[:min(n, len(inner))] = inner[:n]
    held = _COUNT[quarters]
    first = np.cumsum(held) - held + 1
    best = np.zeros(n + 1, np.int64)
    best[0] = fall[0]
    lo, hi = 0, 1
    row_bits, col_bits = bits_of(*shape)
    for _ in range((row_bits - col_bits) // 2 + col_bits):
        below = int(held[lo:hi].sum())
        best[hi:hi + below] = np.repeat(best[lo:hi], held[lo:hi]) - fall[hi:hi + below]
        lo, hi = hi, hi + below
    quarters[lo:] = 0  # the lowest cells have no quarters
    return Treap(quarters, first, best, row_bits, col_bits)


def _quarter(treap: Treap, cells: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The given quarter of each cell; where it is empty, the cell without quarters."""
    mask = treap.quarters[cells]
    below = treap.first[cells] + _COUNT[mask & (np.left_shift(1, which) - 1)]
    return np.where((mask >> which) & 1, below, len(treap.quarters) - 1)


def roots_of(treap: Treap, rows: np.ndarray) -> np.ndarray:
    """The cells of the rows where the levels that halve rows alone end."""
    cells = np.zeros(len(rows), np.int64)
    for level in range(treap.top):
        cells = _quarter(treap, cells, (rows >> (treap.row_bits - 2 * level - 2)) & 3)
    return cells


def best_documents(treap: Treap, cells: np.ndarray, rows: np.ndarray, weights: np.ndarray, k: int):
    """(columns, scores) of all documents whose score is above 0 and at least the k-th highest."""
    depth, col = np.zeros(1, np.int64), np.zeros(1, np.int64)
    paths, bound = cells[None, :], np.array([(treap.best[cells] * weights).sum()])
    found_col, found, floor = np.zeros(0, np.int64), np.zeros(0, np.int64), 1
    while len(bound):
        if len(bound) > BATCH:
            pick = np.zeros(len(bound), bool)
            pick[np.argpartition(-bound, BATCH)[:BATCH]] = True
        else:
            pick = np.ones(len(bound), bool)
        d, c, p = depth[pick], col[pick], paths[pick]
        row_bit = (rows[None, :] >> (treap.col_bits - 1 - d)[:, None]) & 1
        halves = np.concatenate([_quarter(treap, p, 2 * row_bit), _quarter(treap, p, 2 * row_bit + 1)])
        new = treap.best[halves] @ weights
        d, c = np.concatenate([d, d]) + 1, np.concatenate([2 * c, 2 * c + 1])
        done = (d == treap.col_bits) & (new >= floor)
        if done.any():
            found_col, found = np.concatenate([found_col, c[done]]), np.concatenate([found, new[done]])
            if len(found) > k:
                floor = max(floor, int(np.partition(found, -k)[-k]))
                found_col, found = found_col[found >= floor], found[found >= floor]
        on = (d < treap.col_bits) & (new >= floor)
        rest = ~pick & (bound >= floor)
        depth, col = np.concatenate([depth[rest], d[on]]), np.concatenate([col[rest], c[on]])
        paths, bound = np.concatenate([paths[rest], halves[on]]), np.concatenate([bound[rest], new[on]])
    return found_col, found


# -- index --------------------------------------------------------------------------------------

@dataclass
class Index:
    """shards: one row a shard; n_docs: documents with a term (N); n_terms: all terms of theirs (L)."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with a term, and their terms, of each batch."""
    for batch in batches:
        texts = batch["text"].to_pylist()
        counts = np.concatenate([counted_terms(texts[a:b]) for a, b in chunks(texts)] or [np.zeros(0, np.int64)])
        yield pa.RecordBatch.from_arrays([pa.array([np.count_nonzero(counts)], pa.int64()),
                                          pa.array([counts.sum()], pa.int64())], ["docs", "terms"])


def _shards(n_docs: int, n_terms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = of_worker("lexical_search", Powers)
        for batch in batches:
            texts = batch["text"].to_pylist()
            ids = batch["doc_id"].to_pylist()
            for lo, hi in chunks(texts, SHARD_CHARS):
                parts = [hashed_terms(texts[lo + a:lo + b], powers) for a, b in chunks(texts[lo:hi])]
                counts = np.concatenate([c for _, c in parts])
                if not counts.sum():
                    continue
                yield _shard(ids[lo:hi], np.concatenate([t for t, _ in parts]), counts, n_docs, n_terms)

    return run


def _shard(ids: list, terms: np.ndarray, counts: np.ndarray, n_docs: int, n_terms: int) -> pa.RecordBatch:
    known, row = np.unique(terms, return_inverse=True)
    n_cols = len(counts)
    pair, tf = np.unique(row * n_cols + np.repeat(np.arange(n_cols), counts), return_counts=True)
    row, col = pair // n_cols, pair % n_cols
    df = np.bincount(row)
    by_df = np.argsort(-df, kind="stable")
    place = np.empty(len(known), np.int64)
    place[by_df] = np.arange(len(known))
    # exact in Python integers: 25 * n * N can pass 64 bits before the division
    m = np.array([75 + 25 * int(n) * n_docs // n_terms for n in counts], np.int64)
    shape = (len(known), n_cols)
    cells, falls = packed(*grow(place[row], col, impact(tf, m[col]), shape))
    return pa.RecordBatch.from_arrays(
        [pa.array([ids], pa.list_(pa.int64())), pa.array([list(shape)], pa.list_(pa.int32())),
         pa.array([known[by_df].tobytes()], pa.binary()), pa.array([df[by_df].astype(np.int32).tobytes()], pa.binary()),
         pa.array([cells], pa.binary()), pa.array([falls], pa.binary())],
        ["docs", "shape", "terms", "df", "cells", "falls"])


def build_index(docs: DataFrame) -> Index:
    """Every document of doc_id and text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, n_terms = docs.select("text").mapInArrow(_sizes, "docs long, terms long").agg(
        F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    shards = written(docs.mapInArrow(_shards(n_docs, n_terms), _INDEX), "treaps")
    return Index(shards, n_docs, n_terms)


# -- search -------------------------------------------------------------------------------------

@dataclass
class Block:
    """Items of a block: distinct terms, and per item the term numbers with their repeats."""

    terms: np.ndarray
    items: list[tuple[int, np.ndarray, np.ndarray]]


def item_block(items: list[tuple[int, str]]) -> Block:
    hashes, counts = hashed_terms([text for _, text in items], Powers())
    terms, of = np.unique(hashes, return_inverse=True)
    ends = np.cumsum(counts)
    rows = []
    for (number, _), end, n in zip(items, ends, counts, strict=True):
        if n:
            rows.append((number, *np.unique(of[end - n:end], return_counts=True)))
    return Block(terms, rows)


def _blocks(items: DataFrame, block_chars: int) -> Iterator[Block]:
    held, size = [], 0
    for number, text in items.toLocalIterator():
        if held and size + len(text) > block_chars:
            yield item_block(held)
            held, size = [], 0
        held.append((number, text))
        size += len(text)
    if held:
        yield item_block(held)


def _dfs(terms: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(terms), np.int64)
        for batch in batches:
            for known, df in zip(batch["terms"], batch["df"], strict=True):
                known, df = np.frombuffer(known.as_py(), np.uint64), np.frombuffer(df.as_py(), np.int32)
                by = np.argsort(known)
                at = by[np.minimum(np.searchsorted(known, terms, sorter=by), len(known) - 1)]
                total += np.where(known[at] == terms, df[at], 0)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met])], ["term", "df"])

    return run


def _search(block: Block, weights: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch[c][i].as_py() for c in ("docs", "shape", "terms", "cells", "falls")}
                out = list(search_shard(row, block, weights, k))
                if out:
                    number, doc, score = (np.concatenate(x) for x in zip(*out, strict=True))
                    doc_ids = pa.array(row["docs"], pa.int64()).take(pa.array(doc))
                    yield pa.RecordBatch.from_arrays([pa.array(number), doc_ids, pa.array(score)],
                                                     ["item_no", "doc_id", "score"])

    return run


def search_shard(row: dict, block: Block, weights: np.ndarray, k: int):
    """(item number, column, score) arrays of the best documents of each item."""
    known = np.frombuffer(row["terms"], np.uint64)
    by = np.argsort(known)
    at = by[np.minimum(np.searchsorted(known, block.terms, sorter=by), len(known) - 1)]
    rows = np.where((known[at] == block.terms) & (weights > 0), at, -1)
    treap = unpacked(row["cells"], row["falls"], tuple(row["shape"]))
    roots = np.full(len(rows), len(treap.quarters) - 1)
    roots[rows >= 0] = roots_of(treap, rows[rows >= 0])
    for number, terms, repeats in block.items:
        held = rows[terms] >= 0
        if not held.any():
            continue
        terms, weight = terms[held], (weights[terms] * repeats)[held]
        cols, scores = best_documents(treap, roots[terms], rows[terms], weight, k)
        # more than k only if the last ones tie: the smallest ids of those stay
        ids = np.array([np.iinfo(np.int64).max if row["docs"][c] is None else row["docs"][c] for c in cols], np.int64)
        best = np.lexsort((ids, -scores))[:k]
        yield np.full(len(best), number), cols[best], scores[best]


def term_weights(index: Index, block: Block) -> np.ndarray:
    df = np.zeros(len(block.terms), np.int64)
    for term, n in index.shards.select("terms", "df").mapInArrow(_dfs(block.terms), "term long, df long").groupBy(
            "term").agg(F.sum("df").alias("df")).collect():  # at most the terms of one block
        df[term] = n
    return np.array([math.floor(1000 * math.log((2 * index.n_docs + 2) / (2 * int(n) + 1))) for n in df], np.int64)


def search(index: Index, items: DataFrame, k: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the k best documents of each row of items (item_id, text)."""
    if k < 1:
        raise ValueError("k is at least 1")
    numbered = written(items.select("item_id", "text", F.monotonically_increasing_id().alias("item_no")), "items")
    found = None
    for block in _blocks(numbered.filter("text is not null").select("item_no", "text"), block_chars):
        part = index.shards.mapInArrow(_search(block, term_weights(index, block), k),
                                       "item_no long, doc_id long, score long")
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = numbered.select("item_no", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    order = Window.partitionBy("item_no").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.join(numbered.select("item_no", "item_id"), "item_no").select("item_id", "rank", "doc_id", "score")


def result(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return search(build_index(docs), benchmark)


def oracle_sql(k: int = TOP) -> str:
    """DuckDB SQL of result()."""
    terms = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), " \
            f"'{TERM}')"
    return f"""WITH doc AS MATERIALIZED (
  SELECT row_number() OVER () AS no, doc_id, {terms} AS t FROM documents WHERE text IS NOT NULL),
stat AS (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS n_terms FROM doc WHERE len(t) > 0),
item AS MATERIALIZED (
  SELECT row_number() OVER () AS no, item_id, {terms} AS t FROM benchmark WHERE text IS NOT NULL),
ask AS (SELECT no, term, count(*) AS repeats FROM (SELECT no, unnest(t) AS term FROM item) GROUP BY ALL),
posting AS MATERIALIZED (
  SELECT no, doc_id, term, count(*)::BIGINT AS tf, n FROM (SELECT no, doc_id, unnest(t) AS term, len(t) AS n FROM doc)
  SEMI JOIN ask USING (term) GROUP BY ALL),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
           FROM posting, stat GROUP BY term, n_docs),
score AS (
  SELECT a.no, p.no AS doc_no, p.doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_terms)))) AS score
  FROM ask a JOIN posting p USING (term) JOIN weight USING (term), stat GROUP BY ALL),
ranked AS (
  SELECT no, doc_id, score, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM score WHERE score > 0 QUALIFY rank <= {k})
SELECT item_id, rank::INTEGER AS rank, doc_id, score::BIGINT AS score FROM ranked JOIN item USING (no)"""
