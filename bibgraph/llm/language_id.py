"""Language identification with string kernels.

Kernel: blended-spectrum presence kernel, the number of hashed character
n-grams (n = 2, 3, 4, lower case, the text padded by blanks) that two whole
texts share, divided by the geometric mean of their own numbers.  Nyström
landmarks and one-versus-rest kernel ridge regression are fitted on a bounded
sample of labelled rows: at most `per_lang` rows of each of the `languages` most
frequent languages and `sample_rows` in all, drawn by a hash of id and text; about
`landmarks` of them, as many of each language, are landmarks.  The regression is linear in the
kernel, and the kernel is linear in the presence vector, so landmarks and ridge
weights fold into one matrix (buckets x languages), and a batch of documents is
scored by one matrix product.

Null texts and texts without a letter are `und` with score 0; so is every text
if nothing is labelled.  Labels, sources and ids are never read by the scoring.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches, crc_of_id, of_worker, released

BUCKETS = 1 << 15
_SHIFT = np.uint32(32 - 15)
_FACTORS = tuple(np.uint32(f) for f in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F))
NGRAMS = (2, 3, 4)
UNKNOWN = "und"


def presence(text: str, out: np.ndarray) -> None:
    """Mark the buckets of a text's n-grams in `out` (bool, BUCKETS)."""
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    for n in NGRAMS:
        m = len(points) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint32)
        for k in range(n):
            h = (h ^ points[k:k + m]) * _FACTORS[k]
            h ^= h >> np.uint32(15)
        out[(h * _FACTORS[3]) >> _SHIFT] = True


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, bits = [], []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if has_letter(text):
                row = np.zeros(BUCKETS, bool)
                presence(text, row)
                langs.append(lang)
                bits.append(np.packbits(row).tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(bits, pa.binary())],
                                         ["lang", "bits"])


def _unpacked(bits: list[bytes]) -> np.ndarray:
    """Presence rows of unit length."""
    rows = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1)
    rows = rows.astype(np.float32)
    return rows / np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))


def fit(docs: DataFrame, training: Column, per_lang: int = 800, landmarks: int = 256,
        ridge: float = 1e-4, languages: int = 256, sample_rows: int = 16_000) -> tuple[list[str], np.ndarray]:
    """Languages and the folded matrix, from at most `per_lang` rows of each language where `training`."""
    rows = docs.filter(training & F.col("lang").isNotNull() & F.col("text").isNotNull())
    common = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages)
    counts = {r["lang"]: r["count"] for r in common.collect()}
    if not counts:
        return [], np.zeros((BUCKETS, 0), np.float32)
    each = max(1, min(per_lang, sample_rows // len(counts)))
    # a margin above the wanted share, then the smallest draws of each language
    share = F.create_map(*[F.lit(x) for lang, n in sorted(counts.items())
                           for x in (lang, min(1.0, 1.2 * each / n + 50 / n))])
    draw = F.pmod(F.xxhash64("doc_id", "text", F.lit("language sample")), F.lit(1 << 40)) / float(1 << 40)
    drawn = rows.withColumn("_draw", draw).filter(F.col("_draw") < share[F.col("lang")])
    first = F.row_number().over(Window.partitionBy("lang").orderBy("_draw", "text"))
    sample = (drawn.withColumn("_nth", first).filter(F.col("_nth") <= each).select("lang", "text")
              .mapInArrow(released(_pack), "lang string, bits binary").collect())
    sample = sorted((r["lang"], bytes(r["bits"])) for r in sample)
    langs = sorted({lang for lang, _ in sample})
    if not langs:
        return [], np.zeros((BUCKETS, 0), np.float32)
    of = {lang: [b for own, b in sample if own == lang] for lang in langs}
    each = max(1, landmarks // len(langs))
    marks = _unpacked([b for lang in langs for b in of[lang][::max(1, len(of[lang]) // each)][:each]])
    gram, target, y = np.zeros((len(marks),) * 2), np.zeros((len(marks), len(langs))), langs.index
    for lo in range(0, len(sample), 256):
        part = sample[lo:lo + 256]
        kernel = (_unpacked([b for _, b in part]) @ marks.T).astype(np.float64)
        goal = np.full((len(part), len(langs)), -1.0)
        goal[np.arange(len(part)), [y(lang) for lang, _ in part]] = 1.0
        weight = np.array([[1.0 / len(of[lang])] for lang, _ in part])
        gram += kernel.T @ (kernel * weight)
        target += kernel.T @ (goal * weight)
    own = (marks @ marks.T).astype(np.float64)
    alpha = np.linalg.solve(gram + ridge * own + 1e-8 * np.eye(len(marks)), target)
    return langs, (marks.T.astype(np.float64) @ alpha).astype(np.float32)


def _score(langs: list[str], folded: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_worker("language_id", dict)
        for batch in batches:
            texts = batch["text"].to_pylist()
            preds, scores = [], []
            for lo in range(0, len(texts), 128):
                part = texts[lo:lo + 128]
                rows = np.zeros((len(part), BUCKETS), bool)
                known = [bool(langs) and has_letter(t) for t in part]
                for row, text, ok in zip(rows, part, known, strict=True):
                    if ok:
                        presence(text, row)
                if not langs:
                    preds += [UNKNOWN] * len(part)
                    scores += [0.0] * len(part)
                    continue
                margin = rows.astype(np.float32) @ folded
                margin /= np.sqrt(np.maximum(rows.sum(1, keepdims=True), 1))
                best = margin.argmax(1)
                top = np.clip((margin[np.arange(len(part)), best] + 1) / 2, 0, 1)
                preds += [langs[b] if ok else UNKNOWN for b, ok in zip(best, known, strict=True)]
                scores += [float(s) if ok else 0.0 for s, ok in zip(top, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, held_out: Column | None = None, **options) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score; learns from the rows that aren't held out."""
    arrow_batches(docs.sparkSession)
    held_out = F.lit(False) if held_out is None else held_out
    langs, folded = fit(docs, ~held_out, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(released(_score(langs, folded)),
                           "doc_id long, held_out boolean, lang_pred string, score double")


def holdout(remainder: int, modulus: int) -> Column:
    return F.pmod(crc_of_id(), F.lit(modulus)) == remainder
