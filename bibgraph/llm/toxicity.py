"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic rows are the positives, all other training text is unlabelled.
A linear classifier over the presence of words (lower-case runs of letters) and
of word beginnings (4 and 5 letters, so that inflected forms share a feature)
minimises the class-prior-corrected risk of Kiryo et al. (2017),

    pi * R_p(+1)  +  max(0, R_u(-1) - pi * R_p(-1)),

by Adam on numpy minibatches; where the bracket turns negative, the step goes
against it.  The class prior pi is the share of toxic rows among the labelled
training rows.  The fit reads a bounded sample (`positives`, `unlabelled`
documents at most, parameters).  Features are kept (at most the `features` strongest)
whose document frequencies in positives and in unlabelled text differ by at
least `least_shift` standard errors and by a quarter of the strongest shift;
weights start at `start` times the prior-corrected log odds of those
frequencies (words and their beginnings come together, so full log odds would
count one word up to three times).  Scoring reads every whole text.

A null or empty text gets the score of a text without known words.  Without a
positive row every score is 0.  A repeated row is scored as often as it stands.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from .common import arrow_batches, of_worker, released, sampled, written

WORD = re.compile(r"[^\W\d_]+")
THRESHOLD = 0.7


def terms(text: str | None) -> set[str]:
    """Words, and their beginnings marked by a caret."""
    found = set(WORD.findall(text.lower())) if text else set()
    return found | {"^" + w[:4] for w in found if len(w) > 3} | {"^" + w[:5] for w in found if len(w) > 4}


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = [sorted(terms(t)) for t in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["positive"], pa.array(bags, pa.list_(pa.string()))],
                                         ["positive", "terms"])


def _known(vocabulary: list[str]):
    place = {w: i for i, w in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [sorted(place[w] for w in place.keys() & terms(t)) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["positive"], pa.array(bags, pa.list_(pa.int32()))],
                                             ["positive", "places"])

    return run


def risk_gradient(x_p: np.ndarray, x_u: np.ndarray, w: np.ndarray, prior: float) -> np.ndarray:
    """Gradient of the non-negative risk (logistic loss) of one minibatch; the last column is the bias."""
    g_p, g_u = x_p @ w, x_u @ w
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    soft = lambda z: np.logaddexp(0, z)
    plus = -prior * (x_p.T @ sig(-g_p)) / len(g_p)
    minus = (x_u.T @ sig(g_u)) / len(g_u) - prior * (x_p.T @ sig(g_p)) / len(g_p)
    rest = soft(g_u).mean() - prior * soft(g_p).mean()
    return plus + minus if rest >= 0 else -minus


def train(bags_p: list[list[int]], bags_u: list[list[int]], n_terms: int, prior: float,
          epochs: int = 15, batch: int = 1024, decay: float = 1e-5, seed: int = 7, start: float = 0.4,
          rate: float = 0.005) -> np.ndarray:
    """Weight per term (bags hold the terms' numbers), the bias last."""
    bits = [np.zeros((len(bags), n_terms + 1), np.uint8) for bags in (bags_p, bags_u)]
    for rows, bags in zip(bits, (bags_p, bags_u), strict=True):
        rows[:, -1] = 1
        for i, bag in enumerate(bags):
            rows[i, bag] = 1
    n_p, n_u = len(bags_p), len(bags_u)
    p, u = bits[0].mean(0), bits[1].mean(0)
    w = start * np.log((p + 0.5 / n_p) / (np.maximum(u - prior * p, 0) / (1 - prior) + 1 / n_u))
    w[-1] = np.log(prior / (1 - prior))
    rng = np.random.default_rng(seed)
    m, v, t = np.zeros_like(w), np.zeros_like(w), 0
    for _ in range(epochs):
        order = rng.permutation(n_u)
        for lo in range(0, n_u, batch):
            x_u = bits[1][order[lo:lo + batch]].astype(np.float32)
            x_p = bits[0][rng.integers(0, n_p, min(batch // 2, n_p))].astype(np.float32)
            g = risk_gradient(x_p, x_u, w, prior) + decay * np.append(w[:-1], 0)
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def choose_terms(sample: DataFrame, n_p: int, n_u: int, features: int = 512,
                 least_shift: float = 6.0) -> list[str]:
    """Terms whose document frequencies differ most between positives and unlabelled text."""
    counts = (sample.mapInArrow(_bags, "positive boolean, terms array<string>")
              .select("positive", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.count_if("positive").alias("in_p"), F.count_if(~F.col("positive")).alias("in_u"))
              .filter("in_p + in_u >= 3"))
    p, u = F.col("in_p") / n_p, F.col("in_u") / n_u
    both = (F.col("in_p") + F.col("in_u")) / (n_p + n_u)
    shift = F.abs(p - u) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u) + 1e-12)
    rows = (counts.select("term", shift.alias("shift")).filter(F.col("shift") >= least_shift)
            .orderBy(F.desc("shift"), "term").limit(features).collect())
    return [r["term"] for r in rows if r["shift"] >= rows[0]["shift"] / 4]


def fit(docs: DataFrame, labels: DataFrame, training: Column, positives: int = 3000,
        unlabelled: int = 9000, features: int = 512, least_shift: float = 6.0, **options) -> dict[str, float]:
    """Weight per term, the bias under the empty term; learns from the rows where `training`.

    labels: doc_id, toxic (1: confirmed).  Without positives there are no weights.
    """
    marks = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = marks.filter(training)
    prior, n = marks.agg(F.avg((F.col("toxic") == 1).cast("int")), F.count("*")).first()
    if not n or not prior:
        return {}
    texts = docs.select("doc_id", "text").filter(training & F.col("text").isNotNull())
    toxic = sampled(marks.filter("toxic = 1").select("doc_id", F.lit("").alias("text")), positives, "positives")
    confirmed = written(texts.join(toxic.select("doc_id"), "doc_id", "left_semi"), "confirmed")
    held = written((sampled(confirmed, positives, "positives").withColumn("positive", F.lit(True))
                    .unionByName(sampled(texts, unlabelled, "unlabelled").withColumn("positive", F.lit(False))))
                   .select("positive", "text"), "sample")
    sizes = {r["positive"]: r["count"] for r in held.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return {}
    vocabulary = choose_terms(held, n_p, n_u, features, least_shift)
    bags = held.mapInArrow(_known(vocabulary), "positive boolean, places array<int>").collect()
    bags_p, bags_u = (sorted(list(b["places"]) for b in bags if b["positive"] is side) for side in (True, False))
    w = train(bags_p, bags_u, len(vocabulary), min(max(float(prior), 0.001), 0.5), **options)
    return dict(zip([*vocabulary, ""], w.tolist(), strict=True))


def score_of(text: str | None, weights: dict[str, float]) -> float:
    if not weights:
        return 0.0
    z = weights[""] + sum(weights[w] for w in weights.keys() & terms(text))
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def with_score(docs: DataFrame, weights: dict[str, float]) -> DataFrame:
    """The rows with a column `score` (a column of that name is replaced); only texts pass through Python."""
    arrow_batches(docs.sparkSession)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        of_worker("toxicity", dict)
        for part in texts:
            yield pa.array([score_of(t, weights) for t in part.to_pylist()], pa.float64())

    return docs.withColumn("score", F.arrow_udf(released(run), "double", ArrowUDFType.SCALAR_ITER)(F.col("text")))


def score(docs: DataFrame, labels: DataFrame, held_out: Column, **options) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    weights = fit(docs, labels, ~held_out, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return with_score(rows, weights).select(
        "doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
