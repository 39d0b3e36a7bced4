"""The noun tagger: accuracy on sentences it has not seen, training, and odd texts."""

from bibgraph.operators import nouns
from bibgraph.operators.keywords import STOP_WORDS, extract_keywords

# Hand-marked sentences that are not in the training seed: /n follows a noun.
HELD_OUT = """
the students/n wrote a program/n that sorts large files/n on disk/n
we present a technique/n for the compression/n of time/n series/n
a famous painter/n lived in the small village/n near the coast/n
the experiment/n shows the influence/n of noise/n on the classification/n
modern processors/n execute many instructions/n in each cycle/n
the editor/n rejected the manuscript/n because of a serious mistake/n
the algorithm/n computes the shortest path/n between two vertices/n
our method/n clearly improves the precision/n of the recommendation/n
the minister/n announced a reform/n of the pension/n system/n
we analyze the behavior/n of customers/n with statistical models/n
the committee/n will publish the decision/n in the next weeks/n
this library/n offers functions/n for the visualization/n of networks/n
"""


def test_tagger_marks_unseen_sentences(spark):
    held = nouns.seed_tokens(HELD_OUT)
    open_words = [t for t in held if t[0] not in STOP_WORDS]
    assert not {" ".join(line.split()) for line in HELD_OUT.strip().splitlines()} & set(nouns.SEED.splitlines())
    weights = nouns.train(nouns.seed_table(spark))
    rows = [(i, w, p, x) for i, (w, p, x, _) in enumerate(open_words)]
    tokens = spark.createDataFrame(rows, "id long, term string, prev string, next string")
    marked = {r["id"] for r in nouns.only_nouns(tokens, weights).collect()}
    right = sum((i in marked) == t[3] for i, t in enumerate(open_words))
    print("accuracy on open words", right, len(open_words))
    assert right / len(open_words) >= 0.85
    always = sum(t[3] for t in open_words) / len(open_words)
    assert right / len(open_words) > always + 0.1


def test_training_counts(spark):
    marked = spark.createDataFrame([("cat", "the", "", True)] * 3 + [("the", "", "cat", False)] * 3,
                                   "word string, prev string, next string, noun boolean")
    got = {(r["kind"], r["value"]): r["weight"] for r in nouns.train(marked).collect()}
    assert got[("prior", "")] == 0 and got[("word", "cat")] == 1946 and got[("prev", "the")] == 1946  # 1000 ln 7
    assert got[("next", "cat")] == -1946
    assert nouns.train(marked.limit(0)).count() == 0


def test_noun_keywords_of_odd_texts(spark):
    docs = spark.createDataFrame(
        [(1, "The quality of the system. The system improves quickly, and 2020 the system!", "NLP"),
         (2, "", "Big Data"), (3, None, "NLP"), (4, "The method", None)],
        "doc_id long, text string, field_query string")
    weights = nouns.train(nouns.seed_table(spark))
    out = extract_keywords(docs, nouns=weights).collect()
    terms = {k: [r["term"] for r in sorted(out, key=lambda r: r["rank"]) if r["doc_id"] == k] for k in range(1, 5)}
    assert terms[1][:2] == ["system", "quality"] and "nlp" in terms[1]
    assert "quickly" not in terms[1] and "2020" not in terms[1]
    assert terms[2] == ["big data"] and terms[3] == ["nlp"] and terms[4] == ["method"]
    assert extract_keywords(docs.limit(0), nouns=weights).count() == 0
    # without weights nothing is known of any word, and no word is a noun
    assert {r["term"] for r in extract_keywords(docs, nouns=weights.limit(0)).collect()} == {"nlp", "big data"}
