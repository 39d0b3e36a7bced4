"""Fingerprints, language scores and toxicity scores against values worked out in plain Python."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import frame
from pyspark.sql import functions as F

from bibgraph.llm import fingerprints, language_id, toxicity

TEXTS = ["alpha beta beta gamma", "one", "a a a a a b b c d e f g a a b", "the  end\tof\nthe day the end", "", None]


def consistent_samples(text, k):
    """The sample of each coordinate: consistent weighted sampling, a word at a time."""
    xxhash = pytest.importorskip("xxhash")

    def chained(*values):  # the hash of one value seeds that of the next
        seed = 42
        for v in values:
            raw = v if isinstance(v, bytes) else v[0].to_bytes(v[1], "little")
            seed = xxhash.xxh64_intdigest(raw, seed)
        return seed

    weights = Counter((text or "").split() or [""])
    out = []
    for i in range(k):
        best = None
        for word, count in weights.items():
            term = (chained(word.encode()), 8)
            h, h2 = chained(term, (i, 4)), chained((i, 4), term)
            u = [((h >> at & 0xFFFF) + 0.5) / 65536 for at in (0, 16, 32, 48)]
            r, c, b = -math.log(u[0] * u[1]), -math.log(u[2] * u[3]), (h2 & 0xFFFFF) / 2**20
            t = math.floor(math.log(count) / r + b)
            y = math.exp(r * (t - b))
            bid = math.log(c / (y * math.exp(r)))
            if best is None or bid < best[0]:
                best = bid, ((h2 >> 24) ^ t) & 0xFFFFFF
        out.append(best[1])
    return out


def test_fingerprint_samples_recomputed(spark):
    rows = [(i, t, "en", "s") for i, t in enumerate(TEXTS)]
    got = {r["doc_id"]: r["samples"] for r in fingerprints.fingerprints(frame(spark, rows), ["doc_id"], k=16).collect()}
    assert len(got) == len(rows)
    for i, text in enumerate(TEXTS):
        assert got[i] == consistent_samples(text, 16)


def buckets(text):
    """Bucket numbers of a padded text's n-grams, one n-gram at a time."""
    points, mask, out = [ord(c) for c in f" {text.lower()} "], 0xFFFFFFFF, set()
    factors = [int(f) for f in language_id._FACTORS]
    for n in language_id.NGRAMS:
        for at in range(len(points) - n + 1):
            h = n
            for k in range(n):
                h = ((h ^ points[at + k]) * factors[k]) & mask
                h ^= h >> 15
            out.add(((h * factors[3]) & mask) >> 17)
    return out


def test_folded_matrix_equals_explicit_kernel_ridge(spark):
    rng, ridge = np.random.default_rng(11), 1e-2
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["strö", "ka", "ung"], "zz": ["ción", "lo", "ez"]}
    texts = [(lang, " ".join("".join(rng.choice(p, 2)) for _ in range(8))) for lang, p in parts.items()
             for _ in range(16)]
    rows = [(i, t, lang, "s") for i, (lang, t) in enumerate(texts)]
    langs, folded = language_id.fit(frame(spark, rows), F.lit(True), per_lang=16, landmarks=48, ridge=ridge)
    assert langs == ["xx", "yy", "zz"]

    def kernel(a, b):
        return np.array([[len(x & y) / math.sqrt(len(x) * len(y)) for y in b] for x in a])

    own = [buckets(t) for _, t in texts]
    goal = np.array([[1.0 if lang == other else -1.0 for other in langs] for lang, _ in texts])
    # every row is a landmark and weighs 1/16: K alpha / 16 + ridge alpha = goal / 16
    alpha = np.linalg.solve(kernel(own, own) / 16 + ridge * np.eye(len(own)), goal / 16)
    new = ["kalo mika lomi", "ströung kaung", "ez ción loez", "kaka lolo", "12 ab"]
    expected = kernel([buckets(t) for t in new], own) @ alpha
    for text, want in zip(new, expected, strict=True):
        row = np.zeros(language_id.BUCKETS, bool)
        language_id.presence(text, row)
        assert set(np.flatnonzero(row)) == buckets(text)
        assert np.allclose(row.astype(float) @ folded / math.sqrt(row.sum()), want, atol=2e-3)
    fresh = frame(spark, [(100 + i, t, None, "s") for i, t in enumerate(new)] + rows)
    got = {r["doc_id"]: r for r in language_id.identify(fresh, per_lang=16, landmarks=48, ridge=ridge).collect()}
    for i, want in enumerate(expected):
        assert got[100 + i]["lang_pred"] == langs[want.argmax()]
        assert abs(got[100 + i]["score"] - min(1.0, max(0.0, (want.max() + 1) / 2))) < 2e-3


@pytest.mark.parametrize("shift", [0.0, 3.0])
def test_risk_gradient_by_finite_differences(shift):
    rng, prior = np.random.default_rng(5), 0.3
    x_p = np.c_[rng.integers(0, 2, (40, 6)), np.ones(40)].astype(float)
    x_u = np.c_[rng.integers(0, 2, (90, 6)), np.ones(90)].astype(float)
    x_u[:, 0] = 0
    w = rng.normal(0, 0.5, 7)
    w[0] += 2 * shift
    w[-1] -= shift

    def parts(v):
        loss = lambda z: np.log1p(np.exp(-z)).mean()
        return prior * loss(x_p @ v), loss(-(x_u @ v)) - prior * loss(-(x_p @ v))

    corrected = parts(w)[1] < 0
    assert corrected == (shift > 0)
    risk = (lambda v: -parts(v)[1]) if corrected else (lambda v: sum(parts(v)))
    step = 1e-6 * np.eye(7)
    numeric = np.array([(risk(w + e) - risk(w - e)) / 2e-6 for e in step])
    assert np.allclose(toxicity.risk_gradient(x_p, x_u, w, prior), numeric, atol=1e-6)


def test_toxicity_scores_recomputed(spark):
    weights = {"": -2.0, "vile": 1.5, "^vile": 0.75, "^rott": 0.5, "^rotte": 2.0, "nice": -1.0}
    texts = ["A VILE, rotten vile day", "nice", "rot vil", "", None, "viler rottt 7rotten_nice"]
    got = {r["doc_id"]: r["score"] for r in toxicity.with_score(
        frame(spark, [(i, t, "en", "s") for i, t in enumerate(texts)]), weights).collect()}
    for i, text in enumerate(texts):
        found = set()
        for word in re.split(r"[\W\d_]+", (text or "").lower()):
            found |= {word} | ({"^" + word[:4]} if len(word) >= 4 else set()) | (
                {"^" + word[:5]} if len(word) >= 5 else set())
        z = weights[""] + sum(v for key, v in weights.items() if key and key in found)
        assert abs(got[i] - 1 / (1 + math.exp(-z))) < 1e-12
