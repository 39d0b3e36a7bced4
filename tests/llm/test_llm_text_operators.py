"""Spans, windows, lines, fingerprints and near-duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_data import edge_rows, frame, words

from bibgraph.llm import fingerprints, line_dedup, minhash, pii, substring_dedup

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def base_spans(text):
    digits = lambda s: re.sub(r"[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(CARD, text)
            if 13 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m[0])) <= 15]
    return out


def test_pii_base_kinds_equal_the_patterns():
    anchors, rng = pii.automaton(), random.Random(5)
    for _ in range(4000):
        text = "".join(rng.choice("0123459+@.- ()ab%_é") for _ in range(rng.randint(0, 45)))
        assert [s for s in pii.find(text, anchors) if s[0] in pii.BASE_KINDS] == base_spans(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_pii_added_kinds_and_redaction():
    anchors = pii.automaton()
    text = 'see ftp://joe:pw@files.example.org and iban: DE44500105175407324931 now'
    spans = pii.find(text, anchors)
    assert {text[a:b] for k, a, b in spans if k == "address"} == {"ftp://joe:pw@files.example.org"}
    assert {text[a:b] for k, a, b in spans if k == "account"} == {"DE44500105175407324931"}
    assert pii.redact(text, spans) == "see [address] and iban: [account] now"
    assert pii.redact(None, []) is None and pii.find("plain words at https://example.org", anchors) == []


def test_pii_rows(spark):
    got = {r["doc_id"]: r for r in pii.digest(pii.find_pii(frame(spark, edge_rows()))).collect()}
    text = dict((i, t) for i, t, *_ in edge_rows())
    for i, r in got.items():
        spans = base_spans(text[i] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert r["n_email"] == sum(k == "email" for k, *_ in spans)
    assert (got[11]["n_email"], got[11]["n_phone"]) == (1, 1) and "account:" in got[11]["spans"]
    assert 2**60 in got and None in got
    assert pii.digest(pii.find_pii(frame(spark, []))).count() == 0


def windows_brute(rows, window):
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    count = Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, split, strict=True):
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if count[tuple(w[s:s + window])] > 1:
                gone[s:s + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("window", [35, 3, 80])
def test_substring_dedup_equals_brute_force(spark, window):
    rows = edge_rows()
    passage = " ".join(words(9, 60))
    for i in range(30):
        own = " ".join(words(100 + i, 50 + i))
        rows.append((100 + i, f"{own} {passage if i % 3 == 0 else ''} {own if i % 5 == 0 else 'tail'}", "en", "a"))
    out = substring_dedup.digest(substring_dedup.substring_dedup(frame(spark, rows), window)).collect()
    assert sorted(map(tuple, out), key=str) == windows_brute(rows, window)


def test_substring_dedup_small_parts(spark):
    assert substring_dedup.levels(35) == [18, 35] and substring_dedup.levels(100)[-2:] == [50, 100]
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0
    h = np.array([5, 3, 3, 9, 1, 7, 2], np.uint64)
    for reach in (1, 2, 3, 5):
        at = substring_dedup.minimizers(h, reach)
        assert [h[a] for a in at] == [min(h[i:i + reach]) for i in range(len(h) - reach + 1)]
    with pytest.raises(ValueError):
        substring_dedup.substring_dedup(frame(spark, []), 0)


def lines_brute(rows, min_words):
    docs = sorted({(i, t) for i, t, *_ in rows if t is not None}, key=lambda r: (r[0] is not None, r[0]))
    split = {d: d[1].split("\n") for d in docs}
    weight = lambda ls: sum(max(1, len(re.findall(r"[^ \t\n\f\r]+", x))) for x in ls)
    gone = {d: set() for d in docs}
    for size in range(1, max(map(len, split.values()), default=0) + 1):
        seen = set()
        for d in docs:
            for s in range(len(split[d]) - size + 1):
                run = tuple(split[d][s:s + size])
                if run in seen and weight(run) >= min_words:
                    gone[d] |= set(range(s, s + size))
                seen.add(run)
    return {d: "\n".join(x for p, x in enumerate(split[d]) if p not in gone[d]) for d in docs}


@pytest.mark.parametrize("min_words", [8, 1])
def test_line_dedup_equals_brute_force(spark, min_words):
    rows = [r for r in edge_rows() if r[0] != 6]
    rng = random.Random(3)
    pool = [" ".join(words(i, rng.randint(0, 6))) for i in range(25)]
    rows += [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 12))), "en", "a")
             for i in range(40)]
    docs = frame(spark, rows)
    out = line_dedup.line_dedup(docs, min_words)
    assert set(docs.columns) - {"kept"} <= set(out.columns)
    expected = lines_brute(rows, min_words)
    for r in out.collect():
        if r["text"] is None:
            assert r["kept_text"] is None and r["n_lines"] == 0
            continue
        kept = expected[(r["doc_id"], r["text"])]
        assert r["kept_text"] == kept
        assert r["n_lines"] == r["text"].count("\n") + 1
    assert out.count() == len(rows)
    assert line_dedup.line_dedup(frame(spark, [])).count() == 0


def test_line_dedup_of_overlapping_copies(spark):
    rows = [(1, "\n".join(["a b c d"] * 6), "en", "a"), (2, "\n" * 12, "en", "a"), (3, "x\n\n\ny", "en", "a")]
    got = {r["doc_id"]: r["kept_text"] for r in line_dedup.line_dedup(frame(spark, rows)).collect()}
    assert got == {1: "a b c d", 2: "", 3: "x\n\n\ny"}


def every_run_brute(rows, min_words):
    """Lines kept by document, every run length tried."""
    docs = sorted({(i, t) for i, t, *_ in rows if t is not None})
    split = {d: d[1].split("\n") for d in docs}
    weight = lambda ls: sum(max(1, len(x.split())) for x in ls)
    gone = {d: set() for d in docs}
    for size in range(1, max(map(len, split.values())) + 1):
        seen = set()
        for d in docs:
            for s in range(len(split[d]) - size + 1):
                run = tuple(split[d][s:s + size])
                if run in seen and weight(run) >= min_words:
                    gone[d] |= set(range(s, s + size))
                seen.add(run)
    return {d: "\n".join(x for p, x in enumerate(split[d]) if p not in gone[d]) for d in docs}


@pytest.mark.parametrize("min_words", [8, 11])
def test_line_dedup_runs_of_every_length(spark, min_words):
    long = " ".join(words(70, 20))
    runs = ["a b c\nd e f\ng h i\nj k", "m\nn o\np\nq r\ns\nt u", f"a b\nc d\n{long}", f"{long} end\nx\nx"]
    rows = [(10 * r + c, f"top {r} {c}\n{run}\nlast {r} {c}", "en", "a") for r, run in enumerate(runs) for c in range(2)]
    rng = random.Random(7)
    pool = [" ".join(words(200 + i, rng.randint(0, 3))) for i in range(7)]
    rows += [(100 + i, "\n".join(rng.choice(pool) for _ in range(rng.randint(1, 14))), "en", "a") for i in range(60)]
    expected = every_run_brute(rows, min_words)
    got = {(r["doc_id"], r["text"]): r for r in line_dedup.line_dedup(frame(spark, rows), min_words).collect()}
    assert {d: r["kept_text"] for d, r in got.items()} == expected
    if min_words == 8:
        removed = {d[0]: (r["n_removed"], r["longest_run"]) for d, r in got.items() if d[0] < 100}
        assert removed == {0: (0, 0), 1: (4, 4), 10: (0, 0), 11: (6, 6), 20: (0, 0), 21: (3, 3), 30: (0, 0), 31: (3, 3)}


def bag(text):
    return Counter(re.split(r"\s+", (text or "").strip()))


def jaccard(a, b):
    return sum((a & b).values()) / sum((a | b).values())


def test_fingerprints_estimate_generalised_jaccard(spark):
    rows = [(i, " ".join(words(i, 200, 120)), "en", "a") for i in range(60)]
    got = {r["doc_id"]: r for r in fingerprints.edited_pairs(frame(spark, rows), k=64).collect()}
    order = sorted(rows, reverse=True)
    errors = []
    for n, (i, text, *_) in enumerate(order):
        after = order[(n + 1) % len(order)][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(got[i]["fingerprint"]) == 6 * 64
        errors += [got[i]["near_edited"] - jaccard(bag(text), bag(edited)),
                   got[i]["near_next"] - jaccard(bag(text), bag(after))]
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def test_fingerprints_edge_rows(spark):
    got = fingerprints.edited_pairs(frame(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["fingerprint"] == by_id[4]["fingerprint"]
    assert by_id[0]["fingerprint"] == by_id[1]["fingerprint"] == by_id[2]["fingerprint"]
    assert by_id[0]["n_chars"] == 0 and by_id[0]["near_edited"] == 1.0
    assert by_id[7]["n_chars"] == len("é😀 ß x")
    assert by_id[4]["near_next"] == 1.0  # the next one by descending id is its copy
    assert fingerprints.edited_pairs(frame(spark, [])).count() == 0
    one = fingerprints.edited_pairs(frame(spark, [(1, "a b c", "en", "a")])).collect()
    assert one[0]["near_next"] == 1.0  # the only document is its own next one


def shingles(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates_equal_brute_force(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    rng = random.Random(8)
    for g in range(12):
        base = words(500 + g, rng.randint(30, 160))
        for c in range(rng.randint(1, 6)):
            own = list(base)
            for _ in range(c * rng.randint(0, 2)):
                own[rng.randrange(len(own))] = f"z{rng.random()}"
            rows.append((1000 + 10 * g + c, " ".join(own), "en", "a"))
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    bags = {i: shingles(t) for i, t, *_ in rows}
    root = {i: i for i in bags}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(bags)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if bags[a] and bags[b] and jaccard(bags[a], bags[b]) >= 0.8:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert {r["doc_id"]: r["class_id"] for r in got} == {i: find(i) for i in ids}


def test_dart_signatures_agree_with_similarity():
    powers = minhash.Powers()
    a = words(1, 300)
    b = a[:200] + words(2, 100)
    k = 2000
    unit, doc = minhash.units([" ".join(a), " ".join(b), "", "two words"], powers)
    sig = minhash.signatures(unit, doc, 4, k)
    assert not sig[2].any() and sig[3].all()
    assert abs((sig[0] == sig[1]).mean() - jaccard(shingles(" ".join(a)), shingles(" ".join(b)))) < 0.04


def test_near_duplicates_hot_bucket_and_empty(spark):
    base = words(77, 200)
    rows = []
    for c in range(150):  # near copies of one text, more than a chunk
        own = list(base)
        own[c] = "changed"
        rows.append((c, " ".join(own), "en", "a"))
    rows += [(1000 + c, " ".join(base), "en", "a") for c in range(50)]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert {r["class_id"] for r in got} == {0}
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("edits", [10, 60, 200])
def test_near_duplicates_stars_of_independent_edits(spark, edits):
    """Every edit is near the original and far from the other edits: only the original holds the class together."""
    base = words(90, 400, 100_000)
    rng, rows = random.Random(edits), []
    for c in range(edits):
        own = list(base)
        for at in rng.sample(range(0, 395, 10), 7 + c % 2):  # five shingles each: 0.82 or 0.84 to the original
            own[at + 4] = f"e{c}x{at}"
        rows.append((100 + c, " ".join(own), "en", "a"))
    rows.append((5000, " ".join(base), "en", "a"))
    bags = {i: shingles(t) for i, t, *_ in rows}
    assert all(jaccard(bags[5000], bags[100 + c]) >= 0.8 for c in range(edits))
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicates(frame(spark, rows)).collect()}
    powers = minhash.Powers()
    unit, doc = minhash.units([t for _, t, *_ in rows], powers)
    sig = minhash.signatures(unit, doc, len(rows)).reshape(len(rows), minhash.BANDS, minhash.ROWS)
    met = (sig[:, None] == sig[None]).all(3).any(2)
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in np.flatnonzero(met[i]):
            if root[i] != root[j] and jaccard(bags[rows[i][0]], bags[rows[j][0]]) >= 0.8:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert got == {rows[i][0]: rows[root[i]][0] for i in range(len(rows))}


def test_sets_of_equal_size_and_sum_are_told_apart(spark):
    """Two buckets of two texts whose 40-bit hashes add up alike (found by search in a small range of hashes)."""
    hashed = spark.range(3_000_000).selectExpr("id", "xxhash64(id) & ((1L << 40) - 1) AS h").toPandas()
    h, seen, found = hashed["h"].to_numpy(), {}, None
    order = np.argsort(h)
    gaps = np.diff(h[order])
    for place in np.argsort(gaps, kind="stable"):  # a + d = b + c where b - a = d - c
        before = seen.get(gaps[place])
        if before is not None and abs(before - place) > 1:
            found = order[[before, before + 1, place, place + 1]]
            break
        seen[gaps[place]] = place
    a, b, c, d = (int(x) for x in found)
    named = spark.createDataFrame([(a, 0, 1, a), (d, 0, 1, d), (b, 1, 2, b), (c, 1, 2, c), (a, 2, 3, a), (d, 2, 3, d)],
                                  "node long, band int, key long, root long")
    sets = {r["band"]: r for r in minhash._sets(named).collect()}
    assert sets[0]["n"] == sets[1]["n"] == 2 and sets[0]["sum"] == sets[1]["sum"]
    key = lambda r: [r[k] for k in minhash.SET_KEY]
    assert key(sets[0]) != key(sets[1]) and key(sets[0]) == key(sets[2])
    # both buckets are compared, each holds a pair of equal texts
    bag = np.arange(50, dtype=np.uint32).tobytes()
    shingled = spark.createDataFrame([(x, bytearray(bag)) for x in (a, b, c, d)], "node long, units binary")
    links = {tuple(sorted(r)) for r in minhash._in_blocks(named, shingled, 0.8).collect()}
    assert links == {tuple(sorted((a, d))), tuple(sorted((b, c)))}
