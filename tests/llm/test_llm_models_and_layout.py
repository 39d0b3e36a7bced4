"""Learned scorers, search, packing, mixing and the pipeline."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from llm_data import edge_rows, frame, words
from pyspark.sql import functions as F

import corpus_pipeline
from bibgraph.llm import ann, language_id, mixing, packing, toxicity
from bibgraph.llm.common import sampled
from bibgraph.llm.queries import REGISTRY, oracle_sql, tokenizer_path

SF = "/root/testdata/sf0.001"


def by_language(n, seed=0):
    rng = np.random.default_rng(seed)
    parts = {"xx": ["ka", "lo", "mi"], "yy": ["ström", "bär", "ung"], "zz": ["ción", "ado", "ez"]}
    return [(1000 * j + i, " ".join("".join(rng.choice(p, 3)) for _ in range(15)), lang, "s")
            for j, (lang, p) in enumerate(parts.items()) for i in range(n)]


def test_language_id_learns_and_handles_edges(spark):
    rows = by_language(40) + [(9001, None, "xx", "s"), (9002, "12 34 !", "yy", "s"), (9003, "", None, None),
                              (None, "kalomi kalomi", None, "s")]
    held = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == 2
    got = language_id.identify(frame(spark, rows), held).collect()
    assert len(got) == len(rows)
    of = {i: lang for i, _, lang, _ in rows}
    known = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 9000]
    assert all(r["lang_pred"] == of[r["doc_id"]] for r in known)
    assert any(r["held_out"] for r in known) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (9001, 9002, 9003)} == {"und"}
    assert language_id.identify(frame(spark, [])).count() == 0
    none = language_id.identify(frame(spark, [(1, "text", None, None)])).first()
    assert (none["lang_pred"], none["score"]) == ("und", 0.0)


def test_language_id_held_out_accuracy(spark):
    got = REGISTRY["op5_language_id"](spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    right = got.filter("held_out").join(docs, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.9


def test_holdout_is_crc_of_the_id_text(spark):
    rows = frame(spark, [(i, "a", "en", "a") for i in range(40)])
    got = {r["doc_id"] for r in rows.filter(language_id.holdout(2, 4)).collect()}
    assert got == {i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2}


def test_toxicity_separates_held_out_rows(spark):
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for i in range(600):
        text = words(i, 40, 300)
        toxic = i % 5 == 0
        if toxic:
            for w in rng.choice(["vilexu", "vilexa", "grubno"], 3):
                text[rng.integers(len(text))] = str(w)
        rows.append((i, " ".join(text), "en", "a"))
        if i % 2 == 0 or toxic:
            labels.append((i, int(toxic)))
    rows += [(10_000, None, "en", "a"), (10_001, "", "en", "a"), (10_001, "", "en", "a")]
    marks = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id bigint, toxic int")
    got = toxicity.score(frame(spark, rows), marks, language_id.holdout(1, 3)).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r["held_out"] and r["doc_id"] < 10_000]
    assert np.mean([r["predicted"] == (r["doc_id"] % 5 == 0) for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] >= 10_000)


def test_toxicity_without_positives_and_risk(spark):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.score(frame(spark, edge_rows()), none, F.lit(False)).collect()
    assert {r["score"] for r in got} == {0.0} and len(got) == len(edge_rows())
    assert toxicity.score(frame(spark, []), none, F.lit(False)).count() == 0
    x_p, x_u = np.array([[1.0, 1.0]]), np.array([[0.0, 1.0], [0.0, 1.0]])
    w = np.zeros(2)
    for _ in range(300):
        w -= 0.1 * toxicity.risk_gradient(x_p, x_u, w, 0.3)
    assert w[0] > 1 and w[1] < 0


def search_brute(ids, x, query, k):
    s = x @ x[query]
    order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[query]][:k]
    return [int(ids[j]) for j in order]


def test_search_equals_brute_force_in_one_part(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:90] = x[50]  # equal vectors: ties go to the smaller id
    rows = [(i, [float(v) for v in x[i]], "x") for i in range(300)]
    rows += [(900, None, "x"), (901, [0.0] * 8, "x"), (902, [float("nan")] * 8, "x"), (None, [1.0] * 8, "x"),
             (903, [None] + [1.0] * 7, "x"), (904, [float("inf")] * 8, "x")]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank string")
    got = defaultdict(list)
    for r in ann.search(vectors, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    exact = x.astype(np.float64)
    assert sorted(got) == list(range(0, 300, 20))
    assert all(got[q] == search_brute(np.arange(300), exact, q, 20) for q in got)
    assert ann.search(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_search_recall_over_learned_parts(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 16))
    x = (centres[rng.integers(40, size=2000)] + 0.4 * rng.normal(size=(2000, 16))).astype(np.float32)
    vectors = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(2000)],
                                    "vec_id bigint, embedding array<float>")
    got = defaultdict(set)
    for r in ann.search(vectors, F.col("vec_id") % 20 == 0, k=10, parts=8).collect():
        got[r["query_id"]].add(r["vec_id"])
    exact = x.astype(np.float64)
    recall = np.mean([len(got[q] & set(search_brute(np.arange(2000), exact, q, 10))) / 10
                      for q in range(0, 2000, 20)])
    assert recall >= 0.9


def test_small_tables_are_partitioned_too(spark, monkeypatch):
    fitted, fit = [], ann.fit
    monkeypatch.setattr(ann, "fit", lambda x, parts, *args: fitted.append((len(x), parts)) or fit(x, parts, *args))
    x = np.random.default_rng(4).normal(size=(500, 8))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    assert ann.search(vectors, F.col("vec_id") % 20 == 0, k=5).count() == 25 * 5
    assert fitted == [(500, 4)]


def test_large_parts_are_cut_again(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(60, 16))
    x = centres[rng.integers(60, size=6000)] + 0.4 * rng.normal(size=(6000, 16))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = defaultdict(set)
    rows = ann.search(vectors, F.col("vec_id") % 20 == 0, k=10, parts=4, leaf=150, sample=2000).collect()
    for r in rows:
        got[r["query_id"]].add(r["vec_id"])
        assert r["score"] == pytest.approx(float(x[r["query_id"]] @ x[r["vec_id"]]), rel=1e-12)
    assert len(rows) == 300 * 10
    recall = np.mean([len(got[q] & set(search_brute(np.arange(6000), x, q, 10))) / 10 for q in range(0, 6000, 20)])
    assert recall >= 0.9, recall
    index, asked = (spark.createDataFrame([(x[i].tobytes(), [i], "0") for i in range(3000)],
                                          "vec binary, ids array<long>, part string"),
                    spark.createDataFrame([(i, x[i].tobytes(), "0") for i in range(0, 3000, 20)],
                                          "query_id long, vec binary, part string"))
    cut, sent = ann._cut(index, asked, 150, 1000, 10, 0.94)
    sizes = [r["count"] for r in cut.groupBy("part").count().collect()]
    assert sum(sizes) == 3000 and max(sizes) <= 600 and len(sizes) >= 10
    assert sent.select("query_id").distinct().count() == 150


def test_vectors_of_other_lengths_and_large_ties(spark):
    rows = [(i, [1e9 * (1 + i % 3), 1.0]) for i in range(60)] + [(100, [1.0]), (101, [1.0, 2.0, 3.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.search(vectors, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append(r["vec_id"])
    x = np.array([v for _, v in rows[:60]])
    assert got == {q: search_brute(np.arange(60), x, q, 5) for q in (0, 20, 40)}


def test_balanced_parts():
    graph = ann.neighbour_graph(np.random.default_rng(0).normal(size=(200, 4)).astype(np.float32), 6)
    part = ann.balanced_parts(graph, 5)
    assert np.bincount(part, minlength=5).max() <= np.ceil(40 * 1.05)


def layout_is_sound(rows, capacity):
    at = defaultdict(list)
    for r in rows:
        at[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in at.values():
        place = 0
        for offset, length in sorted(spans):
            assert offset == place
            place += length
        assert place <= capacity
    return len(at)


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    rows = edge_rows() + [(50, "<|endoftext|> Word, x <|ENDOFTEXT|> café A.B, \r\n don't", "en", "a")]
    docs = frame(spark, rows)
    parts = packing.pieces(docs, tokenizer_path(), 256)
    packed = packing.pack(parts, 256)
    out = packed.collect()
    layout_is_sound(out, 256)
    expected = defaultdict(list)
    for i, text, *_ in rows:
        expected[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    got = defaultdict(list)
    for r in sorted(out, key=lambda r: r["piece"]):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] and r["start"] == 256 * r["piece"]
        got[r["doc_id"]].append(ids)
    for i, texts in expected.items():
        assert sorted(sum(texts, [])) == sorted(sum(got[i], []))
        if len(texts) == 1:
            assert sum(got[i], []) == texts[0]
    whole = {r["sequence_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in packing.assemble(packed).collect()}
    for r in out:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert whole[r["sequence_id"]][r["offset"]:r["offset"] + r["length"]] == ids
    crc = packing.pieces(docs, tokenizer_path(), 256, digest=True)
    assert sorted(r["ids_crc32"] for r in crc.collect()) == sorted(zlib.crc32(r["ids"]) for r in out)


def test_packing_ids_equal_the_tokenizer_on_odd_letters():
    import pyarrow as pa
    from tokenizers import Tokenizer

    tokenizer, words_of = Tokenizer.from_file(tokenizer_path()), packing.WordIds(tokenizer_path())
    rng = np.random.default_rng(9)
    letters = [chr(c) for c in range(0x30000) if chr(c).isalpha()]
    texts = ["\u0130, x", "K\u0130. y", "\u0958, \u0958."] + [f"x{c}, y{c}. {c}." for c in letters[::7]]
    texts += ["".join(rng.choice(["\u0130", "\u0131", "\u00df", ",", ".", " ", "a", "K", "<"], 8)) for _ in range(3000)]
    got = words_of.of_texts(pa.array(texts))
    expected = tokenizer.encode_batch(texts, add_special_tokens=False)
    assert all(g.tolist() == e.ids for g, e in zip(got, expected, strict=True))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_packing_is_tight(spark, seed):
    rng = np.random.default_rng(seed)
    lengths = np.clip(rng.lognormal(4.5, 1.2, 1500).astype(int), 1, 1000)
    parts = spark.createDataFrame([(i, 0, int(n)) for i, n in enumerate(lengths)],
                                  "doc_id bigint, piece int, length bigint")
    out = packing.pack(parts, 1000).collect()
    assert len(out) == len(lengths)
    used, least = layout_is_sound(out, 1000), -(-int(lengths.sum()) // 1000)
    opened = 0  # first fit over falling lengths, one by one
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in range(len(gaps)) if gaps[g] >= n]
        if fit:
            gaps[min(fit, key=lambda g: gaps[g])] -= n
        else:
            gaps.append(1000 - n)
            opened += 1
    assert used <= max(opened, least) * 1.02 + 1
    assert packing.pack(parts.limit(0), 1000).count() == 0


def test_mixing_reaches_the_targets(spark):
    rng = np.random.default_rng(3)
    rows = [(i, 3 * chr(97 + i % 12) + " " + " ".join(words(i, int(rng.integers(5, 60)))),
             ["en", "de"][int(rng.random() < 0.2)], ["a", "b", "c"][int(rng.integers(3))]) for i in range(600)]
    docs = frame(spark, rows)
    marked = mixing.with_margins(docs).select(*(F.col(f"_{m}").alias(m) for m in (*mixing.MARGINS, "tokens")))
    cells = mixing.rates(marked, keep=0.5, cycles=40).toPandas()
    total = cells.tokens.sum()
    (keep,) = set(cells.keep)
    assert 0.3 < keep <= 0.5
    expected = cells.rate * cells.tokens
    for margin, exponent in mixing.MARGINS.items():
        share = cells.groupby(margin).tokens.sum().astype(float) ** exponent
        got = expected.groupby(cells[margin]).sum() / expected.sum()
        assert np.abs(got - share / share.sum()).sum() / 2 <= mixing.TOLERANCE
    assert abs(expected.sum() / total - keep) < 2 * mixing.TOLERANCE
    out = mixing.mix(docs, keep=0.5).collect()
    assert len(out) == len(rows)
    kept = sum(r["_tokens"] for r in out if r["kept"])
    assert abs(kept / total - keep) < 0.1
    edges = mixing.mix(frame(spark, edge_rows()), keep=0.5).collect()
    assert len(edges) == len(edge_rows()) and not any(r["kept"] for r in edges if not r["_tokens"])
    assert mixing.result(frame(spark, [])).count() == 0
    assert mixing.result(frame(spark, [(1, None, None, None)])).first()["rate"] == 0.0


def test_mixing_keeps_less_where_targets_ask_for_more_than_there_is(spark):
    cells = spark.createDataFrame(
        [("a", "x", 900), ("a", "y", 60), ("b", "x", 30), ("b", "y", 10)], "source string, lang string, tokens long")
    even = {m: spark.createDataFrame([(v, 0.5) for v in values], "value string, share double")
            for m, values in (("source", "ab"), ("lang", "xy"))}
    out = mixing.rates(cells, {"source": 1.0, "lang": 1.0}, even, keep=0.09, cycles=20).toPandas()
    assert (out.rate <= 1).all() and 0.05 < out.keep.iloc[0] < 0.085  # b holds 40 of 1,000 tokens
    expected = out.rate * out.tokens
    for margin in ("source", "lang"):
        got = expected.groupby(out[margin]).sum() / expected.sum()
        assert np.abs(got - 0.5).sum() / 2 <= mixing.TOLERANCE * 1.1
    # nothing in reach: the rung of the smallest error, no crash
    out = mixing.rates(cells, {"source": 1.0, "lang": 1.0}, even, keep=0.9, cycles=4).toPandas()
    assert len(out) == 4 and out.rate.between(0, 1).all()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_sql_oracles(spark, name):
    import duckdb

    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM read_parquet('{SF}/{name_}.parquet')")
    got = REGISTRY[name](spark, SF)
    cols = sorted(got.columns)
    expected = con.sql(oracle_sql()[name]).df()[cols]
    have = sorted(map(str, got.select(cols).toPandas().itertuples(index=False, name=None)))
    assert have == sorted(map(str, expected.itertuples(index=False, name=None)))


def test_every_operator_has_one_query():
    numbers = sorted(int(n[2:].split("_")[0]) for n in REGISTRY)
    assert numbers == list(range(1, 14))


def test_pipeline_stages(spark):
    rows = [(i, t, lang, s) for i, t, lang, s in edge_rows()]
    rows += [(200 + i, " ".join(words(200 + i, 80, 3000)), "en", "ab"[i % 2]) for i in range(30)]
    near = words(900, 120, 3000)
    rows.append((300, " ".join(near), "en", "a"))
    rows.append((301, " ".join([*near[:60], "changed", *near[61:]]), "en", "a"))
    docs = frame(spark, rows).select(*corpus_pipeline.COLUMNS)
    stages = dict(corpus_pipeline.STAGES)
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == corpus_pipeline.COLUMNS and clean.count() == len(rows)
    lines = stages["line_dedup"](spark, docs, SF)
    kept = [r["doc_id"] for r in lines.collect()]
    assert 3 in kept and 4 not in kept and 0 in kept and 1 in kept and 301 in kept
    assert all(r["n_chars"] == len(r["text"]) for r in lines.collect() if r["text"])
    single = stages["near_dedup"](spark, docs, SF)
    ids = [r["doc_id"] for r in single.collect()]
    assert 300 in ids and 301 not in ids and 4 not in ids and ids.count(5) <= 1
    assert {200 + i for i in range(30)} <= set(ids)
    mixed = stages["mixing"](spark, single, SF)
    assert set(r["doc_id"] for r in mixed.collect()) <= set(ids)
    packed = stages["packing"](spark, mixed, SF)
    layout_is_sound(packed.collect(), packing.CAPACITY)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in mixed.collect()}


def test_near_dedup_stage_tells_rows_apart(spark):
    texts = [" ".join(words(800 + i, 60, 3000)) for i in range(4)]
    rows = [(1, texts[0], "en", "a"), (1, texts[1], "en", "a"), (None, texts[2], "en", "a"),
            (None, texts[2], "de", "b"), (7, texts[3], "en", "a"), (3, texts[3], "en", "a"),
            (9, None, "en", "a"), (9, None, "en", "a"), (10, "", "en", "a")]
    out = dict(corpus_pipeline.STAGES)["near_dedup"](spark, frame(spark, rows), SF)
    assert out.columns == corpus_pipeline.COLUMNS
    left = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(left, key=str) == sorted([(1, texts[0]), (1, texts[1]), (None, texts[2]), (3, texts[3]),
                                            (9, None), (9, None), (10, "")], key=str)


@pytest.mark.parametrize("ids", [[None], [1], [4], range(5000)])
def test_samples_keep_their_bound(spark, ids):
    rows = [(ids[i % len(ids)], f"text {i}", "en", "a") for i in range(5000)]
    docs = frame(spark, rows)
    assert 850 <= sampled(docs, 900, "x").count() <= 900
    assert sampled(docs, 6000, "x").count() == 5000
    same = frame(spark, [(1, "one text", "en", "a")] * 300)
    assert 0 < sampled(same, 20, "x").count() <= 20
    langs, folded = language_id.fit(docs, F.lit(True), per_lang=100)
    assert langs == ["en"] and folded.shape == (language_id.BUCKETS, 1)


def test_pipeline_runs_whole(spark):
    out = corpus_pipeline.run(spark, SF)
    layout_is_sound(out.collect(), packing.CAPACITY)
    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0
