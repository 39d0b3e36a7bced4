"""Best-fit packing in bulk-synchronous rounds.

Documents become token pieces: the ids of the whole text followed by id 0; only
documents longer than the capacity are cut, into pieces of the capacity, the
last one shorter.  Pieces shorter than the capacity are packed by best fit:

1. Range-sort: pieces are sorted by length (then by doc_id, start and a hash) over
   range partitions; a piece's rank among the pieces of its length is its place
   minus the place of the first one.
2. Each round sweeps lengths and gaps together from large to small.  A piece
   takes the successor of its length, the smallest gap that is still free and
   not smaller; conflicts are resolved by rank, the k-th piece of a length
   getting the k-th gap of the matched run, and a gap takes one piece a round.
3. Gaps shrink by what they took, and the next round starts.  When no remaining
   piece fits any gap, new sequences are opened for the largest pieces, as many
   as the remaining tokens need at least.

Pieces of one length, and gaps of one size, are interchangeable up to rank, so
the sweep itself runs over size classes: at most `capacity` lengths and as many
gaps, whatever the number of documents (that bound is what reaches the driver).
Everything per document is distributed: lengths are counted by a partial
aggregate, ranks come from range partitions, every sequence derives its own
trajectory through the rounds, and pieces meet sequences in one shuffle join on
(round, gap, rank).

Null texts count as empty: one piece of one token.  Repeated rows are packed as
often as they stand.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, of_worker, released, written

CAPACITY = 2048
SEPARATOR = b"\0\0\0\0"


class WordIds:
    """Ids, as little-endian unsigned 32-bit bytes, of stretches of text without blanks.

    Kept per worker; beyond LIMIT entries only those of the batch at hand stay.
    A Latin stretch is looked up by its lower-case form, and a comma or stop behind
    a letter by itself: the tokenizer splits it off anyway.
    """

    LIMIT = 600_000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {"": b""}

    def _encode(self, words: list[str]) -> None:
        # a run of letters is one word of the tokenizer, so blanks between them are enough
        plain = [w for w in words if w.isalpha() and w.islower() and max(w) < "\u0130"]
        self._encode_all(plain, " ".join)
        self._encode_all(list(set(words).difference(plain)), list)

    def _encode_all(self, words: list[str], joined) -> None:
        for lo in range(0, len(words), 20_000):
            part = words[lo:lo + 20_000]
            found = self.tokenizer.encode(joined(part), is_pretokenized=joined is list, add_special_tokens=False)
            ids, of = np.array(found.ids, "<u4"), np.array(found.word_ids, np.int64)
            ends = np.searchsorted(of, np.arange(len(part)), "right")
            raw, start = ids.tobytes(), 0
            for word, end in zip(part, ends.tolist(), strict=True):
                self.ids[word] = raw[4 * start:4 * end]
                start = end

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """A table that has every one of the words."""
        if len(self.ids) > self.LIMIT:
            self.ids = {w: self.ids[w] for w in words if w in self.ids} | {"": b""}
        forms = {}
        for word in words.difference(self.ids):
            stem, tail = word, ""
            # behind a mark that normal form or lower case puts last (as of U+0130) the tail is not split off
            if len(word) > 1 and word[-1] in ",." and normalize("NFC", word[-2].lower())[-1].isalpha():
                stem, tail = word[:-1], word[-1]
            # below U+0130 lower case is one to one and every letter is composed
            forms[word] = (stem.lower() if "<" not in stem and max(stem) < "\u0130" else stem, tail)
        self._encode(list({f for form in forms.values() for f in form}.difference(self.ids)))
        for word, (stem, tail) in forms.items():
            self.ids[word] = self.ids[stem] + self.ids[tail]
        return self.ids


    def of_texts(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text; every distinct stretch of the batch is looked up once."""
        words = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        table = self.learn(set(distinct))
        ids = [table[w] for w in distinct]
        length = np.fromiter((len(i) // 4 for i in ids), np.int64, len(ids))
        values, start = np.frombuffer(b"".join(ids), "<u4"), np.cumsum(length) - length
        word = coded.indices.to_numpy()
        n = length[word]
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        small = np.int32 if max(total, len(values)) < 2**31 else np.int64
        place = np.repeat((start[word] - ends + n).astype(small), n)
        place += np.arange(total, dtype=small)
        out = values[place]
        last = np.cumsum(words.value_lengths().to_numpy())
        return np.split(out, np.concatenate([[0], ends])[last[:-1]])


def _tokenize(path: str, capacity: int, digest: bool):
    """Tokens are taken per stretch between blanks; the tokenizer drops white space and never joins across it."""
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = of_worker(f"packing {path}", lambda: WordIds(path))
        for batch in batches:
            rows, piece, start, length, ids = [], [], [], [], []
            for i, doc_ids in enumerate(ids_of.of_texts(batch["text"])):
                tokens = doc_ids.tobytes() + SEPARATOR
                for k, at in enumerate(range(0, len(tokens), width)):
                    part = tokens[at:at + width]
                    rows.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    ids.append(zlib.crc32(part) if digest else part)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.int64() if digest else pa.binary())],
                ["doc_id", "piece", "start", "length", "ids_crc32" if digest else "ids"])

    return run


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, digest: bool = False) -> DataFrame:
    """doc_id, piece, start, length and the ids (little-endian unsigned 32-bit), or only their crc32."""
    arrow_batches(docs.sparkSession, 2500)
    kind = "ids_crc32 long" if digest else "ids binary"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        released(_tokenize(tokenizer, capacity, digest)), f"doc_id long, piece int, start long, length long, {kind}")


# --- the rounds over size classes -----------------------------------------------------------------



def plan(counts: dict[int, int], capacity: int):
    """Rounds of best fit over size classes.

    counts: pieces per length (below the capacity).  Returns the number of
    sequences, the moves of gap classes by round, as rows (round, gap, first
    rank, number, length of the piece or 0, new first rank), and the places of
    pieces, as rows (length, first rank, number, round, gap, gap's first rank).
    A new sequence starts as a gap of the whole capacity in the round that
    opens it; new ones get the next sequence numbers in rank order.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    taken = defaultdict(int)
    gaps: dict[int, int] = {}
    moves, places, opened = [], [], []
    n_sequences = turn = 0
    while left:
        matched = _sweep(left, gaps, turn, taken, places)
        if not matched:
            # nothing fits: the largest pieces open as many sequences as the remaining tokens need
            need = -(-sum(n * c for n, c in left.items()) // capacity)
            opened.append((turn, n_sequences, need))
            n_sequences += need
            gaps[capacity] = gaps.get(capacity, 0) + need
            matched = _sweep(left, gaps, turn, taken, places)
        # a gap's unmatched sequences keep their order behind nothing; matched ones move on
        new: dict[int, int] = {}
        used = defaultdict(int)
        for gap, first, number, length in matched:
            used[gap] = max(used[gap], first + number)
        for gap in sorted(gaps):
            rest = gaps[gap] - used[gap]
            if rest:
                moves.append((turn, gap, used[gap], rest, 0, new.get(gap, 0)))
                new[gap] = new.get(gap, 0) + rest
        for gap, first, number, length in matched:
            smaller = gap - length
            if smaller:
                moves.append((turn, gap, first, number, length, new.get(smaller, 0)))
                new[smaller] = new.get(smaller, 0) + number
            else:
                moves.append((turn, gap, first, number, length, 0))
        gaps = new
        turn += 1
    return n_sequences, opened, moves, places


def _sweep(left: dict[int, int], gaps: dict[int, int], turn: int, taken, places) -> list:
    """One successor sweep from large to small: free gaps wait on a stack, a piece takes the smallest."""
    stack: list[list[int]] = []  # [gap, next free rank, number]
    matched = []
    sizes = sorted({*left, *gaps}, reverse=True)
    for size in sizes:
        if gaps.get(size):
            stack.append([size, 0, gaps[size]])
        while left.get(size) and stack:
            gap, rank, free = stack[-1]
            n = min(left[size], free)
            places.append((size, taken[size], n, turn, gap, rank))
            matched.append((gap, rank, n, size))
            taken[size] += n
            left[size] -= n
            if n == free:
                stack.pop()
            else:
                stack[-1][1:] = [rank + n, free - n]
        if not left.get(size, 1):
            del left[size]
    return matched


def _trajectories(opened: list, moves: list, capacity: int):
    """For each sequence number, where it stands in the round in which it takes a piece."""
    turns = defaultdict(list)
    for move in moves:
        turns[move[0]].append(move)
    tables = {}
    for turn, rows in turns.items():
        rows = np.array(sorted(rows, key=lambda m: (m[1], m[2])), np.int64)
        tables[turn] = rows
    last = max(tables, default=-1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 100_000):
                yield from _follow(batch["sequence"].to_numpy()[lo:lo + 100_000])

    def _follow(sequence: np.ndarray) -> Iterator[pa.RecordBatch]:
        gap, rank = np.full(len(sequence), -1, np.int64), np.zeros(len(sequence), np.int64)
        opening = {turn: (first, n) for turn, first, n in opened}
        for turn in range(last + 1):
            if turn in opening:
                first, n = opening[turn]
                fresh = (sequence >= first) & (sequence < first + n)
                gap[fresh], rank[fresh] = capacity, sequence[fresh] - first
            rows = tables[turn]
            open_ = np.flatnonzero(gap > 0)
            if not len(open_):
                continue
            key = gap[open_] * (1 << 40) + rank[open_]
            at = np.searchsorted(rows[:, 1] * (1 << 40) + rows[:, 2], key, "right") - 1
            move = rows[at]
            takes = move[:, 4] > 0
            own = open_[takes]
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sequence[own]), pa.array(np.full(len(own), turn, np.int32)),
                     pa.array(gap[own]), pa.array(rank[own])], ["sequence", "turn", "gap", "gap_rank"])
            rank[open_] = rank[open_] - move[:, 2] + move[:, 5]
            gap[open_] = gap[open_] - move[:, 4]

    return run


def _placed(places: list):
    """(length, rank) -> (turn, gap, gap's rank)."""
    rows = np.array(sorted(places), np.int64).reshape(-1, 6)
    starts = rows[:, 0] * (1 << 40) + rows[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["rank"].to_numpy()
            row = rows[np.searchsorted(starts, length * (1 << 40) + rank, "right") - 1]
            names = [n for n in batch.schema.names if n not in ("turn", "gap", "gap_rank")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(row[:, 3].astype(np.int32)), pa.array(row[:, 4]),
                 pa.array(row[:, 5] + rank - row[:, 1])], [*names, "turn", "gap", "gap_rank"])

    return run


def pack(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (a column `length`, 1 to `capacity`) with sequence_id and offset.

    Rows are kept whole; the other columns pass through.  An empty table gives
    an empty table.
    """
    spark = parts.sparkSession
    names = [c for c in parts.columns if c not in ("sequence_id", "offset")]
    order = ["length", *[c for c in ("doc_id", "piece", "ids_crc32") if c in names]]
    # written twice: range-sorting reads its input twice, and place and partition must stay fixed
    ranged = written(written(parts.select(*names), "unsorted").orderBy(*order).withColumn("mid", F.monotonically_increasing_id()),
                     "pieces")
    per_part = (ranged.groupBy(F.shiftright("mid", 33).alias("part"), "length")
                .agg(F.count("*").alias("n"), F.min("mid").alias("first")))
    # at most one row per partition and length that it holds: sorted lengths, so partitions + capacity rows
    runs = sorted((r["length"], r["part"], r["first"], r["n"]) for r in per_part.collect())
    counts: dict[int, int] = {}
    offsets = []
    for length, part, first, n in runs:
        offsets.append((length, part, counts.get(length, 0) - first))
        counts[length] = counts.get(length, 0) + n
    n_full = counts.pop(capacity, 0)
    n_sequences, opened, moves, places = plan(counts, capacity)
    offset_table = spark.createDataFrame(offsets, "o_length long, o_part long, shift long") if offsets else \
        spark.createDataFrame([], "o_length long, o_part long, shift long")
    ranked = (ranged.join(F.broadcast(offset_table), (ranged["length"] == offset_table["o_length"])
                          & (F.shiftright("mid", 33) == offset_table["o_part"]))
              .withColumn("rank", F.col("mid") + F.col("shift")).drop("o_length", "o_part", "shift", "mid"))
    full = ranked.filter(F.col("length") == capacity).select(
        *names, (F.col("rank") + n_sequences).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    short = ranked.filter(F.col("length") < capacity)
    if not places:
        return full
    keyed = T.StructType([*(f for f in short.schema.fields), T.StructField("turn", T.IntegerType()),
                          T.StructField("gap", T.LongType()), T.StructField("gap_rank", T.LongType())])
    short = short.mapInArrow(_placed(places), keyed)
    sequences = (spark.range(n_sequences).withColumnRenamed("id", "sequence")
                 .mapInArrow(_trajectories(opened, moves, capacity),
                             "sequence long, turn int, gap long, gap_rank long"))
    packed = short.join(sequences, ["turn", "gap", "gap_rank"]).select(
        *names, F.col("sequence").alias("sequence_id"), (F.lit(capacity) - F.col("gap")).alias("offset"))
    return packed.unionByName(full)


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, ids: the token ids of each sequence (packed pieces with `ids`), little-endian bytes."""
    return (packed.groupBy("sequence_id")
            .agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.aggregate(
                "parts", F.lit(b""), lambda out, p: F.concat(out, p["ids"])).alias("ids")))
