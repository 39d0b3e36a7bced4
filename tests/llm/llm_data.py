"""Small tables with awkward rows, shared by the tests of the training-data operators."""

import random

CLASHES = ("k", "n", "rank", "score", "kept", "node", "class_id", "block", "term", "line", "pos", "h",
           "tie", "rate", "tokens", "piece", "vec", "th", "nid", "t1", "skip", "word", "gone")
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, "
          + ", ".join(f"{c} string" for c in CLASHES))


def words(seed, n, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, rows):
    """rows: (doc_id, text, lang, source); every clashing name is an extra column."""
    extra = ("x",) * len(CLASHES)
    return spark.createDataFrame(
        [(i, t, lang, s, None if t is None else len(t), *extra) for i, t, lang, s in rows], SCHEMA)


def edge_rows():
    """Null and empty texts, blanks, a very long text, copies, repeated rows, null columns."""
    base = " ".join(words(1, 120))
    near = base.replace(base.split()[60], "changed", 1)
    long = " ".join(words(2, 30_000, 5000))
    return [
        (0, None, "en", "a"), (1, "", "en", "a"), (2, " \n\t ", None, None), (3, base, "en", "a"),
        (4, base, "en", None), (5, near, "en", "b"), (5, near, "en", "b"), (6, long, "de", "b"),
        (None, "one text without an id " * 12, "fr", "c"), (7, "é😀 ß x", "fr", "c"), (8, "a", "en", "a"),
        (9, "line one of the text\n\nline two of the text\n" + base, "en", "a"),
        (10, "line one of the text\n\nline two of the text\nother " + " ".join(words(3, 50)), "en", "a"),
        (11, "token = \"0123456789abcdef\" mail bob@mail.example.com call +1 (132) 555-1352", "en", "a"),
        (2**60, " ".join(words(4, 60)), "en", "a")]
