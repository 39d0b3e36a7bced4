"""Repeated line runs by distributed prefix doubling, in DataFrame operations only.

The corpus is a sequence of line ids (128-bit hashes of whole lines, cut at line
feeds; blank lines are lines too).  Prefix doubling names the first 2**k lines
of each suffix of a document: a name of 2**(k+1) lines is the pair of the names
at a place and 2**k further on.  Suffixes of one name share a prefix of 2**k
lines, an interval of the suffix array with that longest common prefix; only
intervals of two suffixes or more are doubled, until none survives.  Lengths
between two powers are named by two names of the lower power that overlap.  The
member that comes first, by doc_id, then place, is the first copy.  A later
member marks the lines of its names; marks on consecutive lines make up the
maximal repeated runs, which are deleted.

A run counts from `min_words` words on (a blank line counts as one), so that
short lines that recur by chance stay.  A line holds a word at least, so a run
of more than `min_words` lines is made up of runs of `min_words` lines that
count; lengths between the powers are named up to there, and nothing is lost.
Ranks are hashes, not sorted positions:
equality of prefixes and the first copy are all that is asked of the order.

Defined results: a null text has no lines and stays null; an empty text is one
blank line.  Rows with equal doc_id and text are one document: both keep or lose
the same lines.  Null ids come first in the order.  A later copy may overlap the
first: of six equal lines of four words the first stays, and of many blank lines
in a row one.  Texts of any length are taken whole; an empty table has no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

MIN_WORDS = 8
_KEY = ["doc_id", "tie"]


def lines_of(docs: DataFrame) -> DataFrame:
    """doc_id, tie, pos, a, b (the line's id), words."""
    line = F.col("line")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("tie"),
                        F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .select("doc_id", "tie", "pos", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"),
                    F.greatest(F.regexp_count(line, F.lit(r"[^ \t\n\f\r]+")), F.lit(1)).cast("long").alias("words")))


def _repeated(rows: DataFrame, name: str) -> DataFrame:
    """Rows whose name occurs at two places or more, and whether an earlier place has it (`later`)."""
    place = F.struct(*_KEY, "pos")
    names = written(rows.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                    .filter("first < last").select("a", "b", "first"), f"names{name}")
    return written(rows.join(names, ["a", "b"]).select(
        *rows.columns, (place > F.col("first")).alias("later")), f"level{name}")


def _between(rows: DataFrame, level: int, min_words: int) -> DataFrame | None:
    """Later copies of repeated runs of 2**level + 1, ... lines, below the next power and up to min_words lines."""
    size, ends = 1 << level, []
    for more in range(1, min(size, min_words - size + 1)):
        ahead = Window.partitionBy(*_KEY).orderBy("pos").rangeBetween(more, more)
        ends.append(F.struct(F.lit(size + more).alias("n"), *(F.first(c).over(ahead).alias(f"{c}2") for c in (
            "a", "b", "before", "words"))))
    if not ends:
        return None
    runs = rows.select(*_KEY, "pos", "a", "b", "before", F.array(*ends).alias("ends")).select(
        *_KEY, "pos", "a", "b", "before", F.explode("ends").alias("end")).filter("end.a2 is not null").select(
        *_KEY, "pos", F.xxhash64("end.n", "a", "end.a2").alias("a"), F.xxhash64("b", "end.n", "end.b2").alias("b"),
        (F.col("end.before2") + F.col("end.words2") - F.col("before")).alias("words"), "end.n")
    return _repeated(runs.filter(F.col("words") >= min_words), f"{level}more").filter("later").select(
        *_KEY, "pos", "n")


def marked_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """All lines, and the marks: doc_id, tie, pos, n lines that repeat an earlier run."""
    lines = written(lines_of(docs).distinct(), "lines")
    level, rows, marks = 0, _repeated(lines, "0"), None
    # words of the repeated lines before a place: the lines of a run follow one another among them
    before = F.sum("words").over(Window.partitionBy(*_KEY).orderBy("pos")) - F.col("words")
    while not rows.isEmpty():
        own = rows.filter((F.col("words") >= min_words) & F.col("later")).select(
            *_KEY, "pos", F.lit(1 << level).alias("n"))
        marks = own if marks is None else marks.unionByName(own)
        more = _between(rows, level, min_words)
        marks = marks if more is None else marks.unionByName(more)
        ahead = Window.partitionBy(*_KEY).orderBy("pos").rangeBetween(1 << level, 1 << level)
        then = lambda c: F.first(c).over(ahead)  # noqa: E731, B023
        doubled = rows.select(*_KEY, "pos", "a", "b", "words", (before if level == 0 else F.col("before")).alias("before"),
                              then("a").alias("a2"), then("b").alias("b2"),
                              then("words").alias("words2")).filter("a2 is not null")
        rows = _repeated(doubled.select(
            *_KEY, "pos", F.xxhash64("a", "a2").alias("a"), F.xxhash64(F.lit(level), "b", "b2").alias("b"),
            (F.col("words") + F.col("words2")).alias("words"), "before"), str(level + 1))
        level += 1
    if marks is None:
        marks = lines.select(*_KEY, "pos", F.lit(1).alias("n")).limit(0)
    return lines, marks


def line_dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows with `kept_text`, `n_lines`, `n_removed` and `longest_run` (deleted lines in a row)."""
    lines, marks = marked_runs(docs, min_words)
    longest = marks.groupBy(*_KEY, "pos").agg(F.max("n").alias("n"))
    touched = written(longest.select(*_KEY).distinct(), "touched")
    same = lambda l, r: F.expr(f"{l}.doc_id <=> {r}.doc_id AND {l}.tie = {r}.tie")  # noqa: E731, E741
    of_touched = lines.alias("l").join(touched.alias("t"), same("l", "t"), "left_semi")
    ends = (of_touched.alias("l").join(longest.alias("m"), same("l", "m") & F.expr("l.pos = m.pos"), "left")
            .select("l.doc_id", "l.tie", "l.pos", (F.col("m.pos") + F.col("n")).alias("end")))
    so_far = Window.partitionBy(*_KEY).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    covered = ends.select(*_KEY, "pos", (F.coalesce(F.max("end").over(so_far), F.lit(0)) > F.col("pos"))
                          .alias("gone"))
    flags = (covered.groupBy(*_KEY).agg(F.array_sort(F.collect_list(F.struct("pos", "gone"))).alias("f"))
             .select(F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("f.gone").alias("_gone")))
    names = [c for c in docs.columns if c not in ("kept_text", "n_lines", "n_removed", "longest_run")]
    held = docs.select(*names).join(
        flags, F.col("doc_id").cast("long").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_tie")), "left")
    pieces = F.split("text", "\n")
    kept = F.array_join(F.filter(pieces, lambda x, i: ~F.get("_gone", i)), "\n")
    run = F.aggregate("_gone", F.struct(F.lit(0).alias("best"), F.lit(0).alias("now")), _longer, lambda s: s["best"])
    return held.select(
        *names, F.when(F.col("_gone").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size(pieces)), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.filter("_gone", lambda g: g)), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(run, F.lit(0)).cast("long").alias("longest_run"))


def _longer(state: Column, gone: Column) -> Column:
    now = F.when(gone, state["now"] + 1).otherwise(0)
    return F.struct(F.greatest(state["best"], now).alias("best"), now.alias("now"))


def result(docs: DataFrame, **options) -> DataFrame:
    return line_dedup(docs.select("doc_id", "text"), **options).select(
        F.col("doc_id").cast("long").alias("doc_id"), "n_lines", "n_removed", "longest_run",
        F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


def oracle_sql(min_words: int = MIN_WORDS) -> str:
    """DuckDB SQL of result(): windows of 1 to min_words lines that repeat an earlier one."""
    levels, sizes = [], range(1, min_words + 1)
    for size in sizes:
        levels.append(f"""w{size} AS (
  SELECT doc_id, pos, {size} AS n,
         row_number() OVER (PARTITION BY lines ORDER BY doc_id, pos) AS nth, words
  FROM (SELECT doc_id, pos, count(*) OVER nxt AS have,
               list(line) OVER nxt AS lines, sum(words) OVER nxt AS words
        FROM line WINDOW nxt AS (PARTITION BY doc_id ORDER BY pos
                                 ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)) x
  WHERE have = {size})""")
    marks = " UNION ALL ".join(f"SELECT doc_id, pos, n FROM w{s} WHERE nth > 1 AND words >= {min_words}"
                               for s in sizes)
    return f"""WITH line AS MATERIALIZED (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos,
         greatest(len(regexp_extract_all(unnest(string_split(text, chr(10))), '[^ \\t\\n\\f\\r]+')), 1) AS words
  FROM documents WHERE text IS NOT NULL),
{", ".join(levels)},
mark AS (SELECT doc_id, pos, max(n) AS n FROM ({marks}) GROUP BY ALL),
flag AS (
  SELECT l.doc_id, l.pos, l.line,
         coalesce(max(m.pos + m.n) OVER (PARTITION BY l.doc_id ORDER BY l.pos), 0) > l.pos AS gone
  FROM line l LEFT JOIN mark m ON l.doc_id = m.doc_id AND l.pos = m.pos),
island AS (
  SELECT *, pos - row_number() OVER (PARTITION BY doc_id, gone ORDER BY pos) AS isle FROM flag),
run AS (SELECT doc_id, max(c) AS longest_run FROM (
  SELECT doc_id, isle, count(*) AS c FROM island WHERE gone GROUP BY ALL) GROUP BY 1),
doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM flag GROUP BY 1)
SELECT d.doc_id, coalesce(k.n_lines, 0)::BIGINT AS n_lines, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
       coalesce(r.longest_run, 0)::BIGINT AS longest_run, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM documents d LEFT JOIN doc k USING (doc_id) LEFT JOIN run r USING (doc_id)"""
