"""Merkle manifest, ranked search and decontamination against brute force."""

import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from llm_data import edge_rows, frame, words

from bibgraph.llm import decontamination, lexical_search, merkle

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# -- manifest -----------------------------------------------------------------------------------

def h(*parts):
    return sha256("".join(parts).encode("utf-8", "surrogatepass")).hexdigest()


def leaf_of(i, t, lang, source):
    n = None if t is None else len(t)
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, t)))


def tree_brute(digests):
    """Root, and each leaf's [(left, right)] path."""
    paths, held, own = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(held) > 1:
        for leaf, at in enumerate(own):
            run = held[at // 3 * 3:at // 3 * 3 + 3]
            paths[leaf].append((run[:at % 3], run[at % 3 + 1:]))
            own[leaf] = at // 3
        held = [h(*held[i:i + 3]) for i in range(0, len(held), 3)]
    return held[0], paths


def manifest_brute(rows):
    groups = {}
    for i, t, lang, s in rows:
        untampered = leaf_of(i, t, lang, s)
        cut = t is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0
        n = None if t is None else len(t)
        fields = (i, s, lang, n, t.replace("\n", "") if cut else t)
        shown = h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))
        groups.setdefault(s, []).append((i is not None, i or 0, untampered, shown))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree_brute([r[2] for r in sorted(groups[s])]) for s in order}
    root, above = tree_brute([trees[s][0] for s in order])
    out = []
    for at, s in enumerate(order):
        subroot, paths = trees[s]
        for (known, i, leaf, shown), path in zip(sorted(groups[s]), paths, strict=True):
            path = path + above[at]
            folded = shown
            for left, right in path:
                folded = h(*left, folded, *right)
            siblings = "".join("".join(left + right) for left, right in path)
            out.append((i if known else None, leaf, subroot, root, h(siblings), folded, folded == root))
    return sorted(out, key=str)


def test_manifest_equals_brute_force(spark):
    rows = edge_rows()
    rows += [(1000 + i, f"row {i}\nof many" if i % 3 else f"row {i}", "en", "hot") for i in range(1600)]
    rows += [(5000 + i, f"text\n{i}", None, f"small{i % 7}") for i in range(30)]
    rows += [(1000, "the same id again\n", "en", "hot"), (7000, "é\n😀", "en", "ü"), (7001, "z", "en", "z")]
    got = merkle.result(frame(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    expected = manifest_brute(rows)
    assert sorted(map(tuple, got.collect()), key=str) == expected
    assert {r[-1] for r in expected} == {True, False}
    assert merkle.result(frame(spark, [])).count() == 0
    one = merkle.result(frame(spark, [(3, "alone\n", "en", None)])).first()
    assert one["leaf"] == one["subroot"] == one["root"] and one["proof_sha256"] == h("")


def test_manifest_proofs_of_some_leaves(spark):
    rows = [(i, f"row {i}", "en", "a" if i % 3 else "b") for i in range(1500)]
    built = merkle.build(frame(spark, rows))
    every = {r["doc_id"]: r for r in merkle.prove(built, with_proof=True).collect()}
    some = merkle.prove(built, merkle.F.col("doc_id") % 97 == 0, with_proof=True).collect()
    assert len(some) == 16 and all(r["verified"] for r in some)
    assert all(every[r["doc_id"]]["proof"] == r["proof"] for r in some)


def test_multiproof_is_minimal():
    rng, digests = random.Random(2), [h(str(i)) for i in range(50)]
    levels = [[d.encode() for d in digests]]
    while len(levels[-1]) > 1:
        levels.append([merkle.joined_digest(levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    for _ in range(50):
        held = rng.sample(range(50), rng.randint(1, 50))
        asked = [(k, i) for k, i in merkle.missing(held, len(levels) - 1) if i < len(levels[k])]
        derivable = {(k, i // 3 ** k) for i in held for k in range(len(levels))}
        assert not set(asked) & derivable
        got = {(k, i): levels[k][i] for k, i in asked}
        proofs = merkle.expand({i: levels[0][i] for i in held}, got)
        assert all(merkle.fold_proof(levels[0][i], proofs[i]) == levels[-1][0] for i in held)
        assert len(asked) <= len({(k, i // 3 ** k) for i in range(50) for k in range(len(levels))}) - len(derivable)


# -- search -------------------------------------------------------------------------------------

def search_brute(docs, items, k):
    held = [(i, Counter(terms_of(t))) for i, t, *_ in docs if terms_of(t)]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in held:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms_of(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, n + 1, i, -s) for n, (s, _, i) in enumerate(sorted(scores, key=str_last)[:k])]
    return sorted(out, key=str)


def str_last(row):
    return row[0], row[1], row[2] or 0


@pytest.mark.parametrize("shard_chars, block_chars", [(4_000_000, 1_000_000), (3000, 200)])
def test_search_equals_brute_force(spark, monkeypatch, shard_chars, block_chars):
    monkeypatch.setattr(lexical_search, "SHARD_CHARS", shard_chars)
    rng = random.Random(4)
    docs = edge_rows()
    docs += [(100 + i, " ".join(words(i, rng.randint(1, 80), 60)), "en", "a") for i in range(150)]
    docs += [(300, "MiXed CASE wOrds COUNT as One w1", "en", "a")]
    docs += [(400 + i, "W1 w2, w3 repeated", "en", "a") for i in range(40)]  # more ties than places
    items = [(1, "w1 W2 w3"), (2, None), (3, ""), (4, "nowhere found"), (None, "é w4 w4 w4"), (1, "w7 w8 w9 w9 w0"),
             (5, " ".join(words(8, 60, 60))), (6, " ".join(words(2, 30, 5000))), (7, "x😀")]
    got = lexical_search.search(lexical_search.build_index(frame(spark, docs)),
                                spark.createDataFrame(items, "item_id long, text string"), 20, block_chars)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == search_brute(docs, items, 20)


def test_search_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert lexical_search.result(frame(spark, edge_rows()), none).count() == 0
    some = spark.createDataFrame([(1, "w1")], "item_id long, text string")
    assert lexical_search.result(frame(spark, []), some).count() == 0
    with pytest.raises(ValueError):
        lexical_search.search(lexical_search.build_index(frame(spark, [])), some, 0)


@pytest.mark.parametrize("shape", [(1, 1), (5, 9), (300, 2), (300, 70), (3, 200)])
def test_treap_holds_its_cells(shape):
    rng = np.random.default_rng(1)
    dense = np.where(rng.random(shape) < 0.2, rng.integers(1, 10**6, shape), 0)
    dense[0, 0] = 7
    rows, cols = np.nonzero(dense)
    quarters, falls, root = lexical_search.grow(rows, cols, dense[rows, cols], shape)
    treap = lexical_search.unpacked(*lexical_search.packed(quarters, falls, root), shape)
    assert treap.best[0] == root == dense.max()
    for row in range(min(shape[0], 20)):
        start = lexical_search.roots_of(treap, np.array([row]))
        found, scores = lexical_search.best_documents(treap, start, np.array([row]), np.array([3]), 10**6)
        assert dict(zip(found.tolist(), scores.tolist())) == {
            c: 3 * int(v) for c, v in enumerate(dense[row]) if v}


# -- decontamination ----------------------------------------------------------------------------

def occurs_brute(docs, items, window):
    tests = []
    for name, text in items:
        w = terms_of(text)
        tests += [(str(name) if name is not None else "null", i, tuple(w[i:i + window]), k)
                  for i in range(max(1, len(w) - window + 1)) if w for k in [id(w)]]
    out = []
    for i, text, *_ in docs:
        w, hit, names, at = terms_of(text), set(), set(), set()
        for name, j, words_, item in tests:
            for p in range(len(w) - len(words_) + 1):
                if tuple(w[p:p + len(words_)]) == words_:
                    hit |= set(range(p, p + len(words_)))
                    names.add(name)
                    at.add((item, p - j, p, len(words_)))
        longest = 0
        for item, diagonal, p, n in at:
            run = 0
            while (item, diagonal, p + run, n) in at:
                run += 1
            longest = max(longest, n + run - 1)
        digest = sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(names), digest, bool(hit), longest))
    return sorted(out, key=str)


def leaks():
    passage, other = words(70, 40, 10**6), words(71, 40, 10**6)
    docs = edge_rows()[:5] + edge_rows()[7:]
    docs += [(200, " ".join(words(1, 30) + passage[3:30] + words(2, 5)).upper(), "en", "a"),
             (201, " ".join(passage[:9]), "en", "a"), (202, "-".join(passage[:10]), "en", "a"),
             (203, " ".join(passage + other[:12] + passage[:15]), "en", "a"), (203, " ".join(other), "en", "a"),
             (204, "the short one here", "en", "a"), (205, "the short one", "en", None),
             (206, " ".join(["a b"] * 30), "en", "a"), (207, " ".join(passage), None, None)]
    docs += [docs[-1]] * 3
    items = [(1, " ".join(passage)), (2, " ".join(other)), (10, " ".join(passage[:20])), (3, "The short one!"),
             (4, None), (5, "..."), (None, " ".join(other[5:20])), (2, "a b a b a b a b a b a b"), (6, "é😀 ß")]
    return docs, items


@pytest.mark.parametrize("window, block_chars, shard_chars", [(10, 10**6, 10**6), (10, 150, 200), (1, 10**6, 10**6)])
def test_decontamination_equals_brute_force(spark, monkeypatch, window, block_chars, shard_chars):
    monkeypatch.setattr(decontamination, "SHARD_CHARS", shard_chars)
    docs, items = leaks()
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.digest(decontamination.search(frame(spark, docs), table, window, block_chars))
    assert sorted(map(tuple, got.collect()), key=str) == occurs_brute(docs, items, window)


def test_decontaminated_rows(spark):
    docs, items = leaks()
    table = spark.createDataFrame(items, "item_id long, text string")
    kept = decontamination.decontaminated(frame(spark, docs), table)
    clean = sorted(((i, t) for (i, t, *_), r in zip(docs, map(lambda d: occurs_brute([d], items, 10)[0], docs),
                                                    strict=True) if not r[5]), key=str)
    assert kept.columns == frame(spark, docs).columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == clean
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.decontaminated(frame(spark, docs), none).count() == len(docs)
    assert {r["contaminated"] for r in decontamination.result(frame(spark, docs), none).collect()} == {False}
    assert decontamination.result(frame(spark, []), table).count() == 0
    with pytest.raises(ValueError):
        decontamination.search(frame(spark, docs), table, 0)


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(3)
    ranks = rng.integers(0, 3, 200)
    order = decontamination.suffix_array(ranks, 256)
    assert order.tolist() == sorted(range(200), key=lambda i: ranks[i:].tolist())
