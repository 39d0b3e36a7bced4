"""Merkle manifest of a data set, with proofs by one multiproof per leaf partition.

Each row is a leaf: H (lowercase hex sha256) of its fields, each `-` if null, else
its UTF-8 byte count, `:` and its value.  Per source, leaves ascend by doc_id; every
ARITY consecutive nodes of a level become the H of their digests until one remains,
the subroot.  Subroots, ordered by source, are the leaves of a second tree of the
same form; its last node is the root.

Building: leaves are numbered over range partitions.  An aligned block of BLOCK
leaves is folded LEVELS levels up in one task, the block roots of a source are
folded likewise, and so on; all interior nodes are written.  Block 0 of a level stops
when one node is left (blocks fill up in order, so it is then the only block).

Proving (Octopus): the leaf partition is the block.  It computes the minimal union of
node coordinates (level, index) that its wanted leaves lack: siblings, at every level,
that can't be derived from leaves it holds.  All coordinates of all blocks are fetched
by one join; a node far up is asked for by many blocks and therefore dealt out in
copies, so that no copy meets more than 2 * 3 ** LEVELS blocks.  The block then derives the
interior nodes that its leaves share and expands each leaf's own proof locally.

Defined results: a null source is a source of its own, before the others; null ids
come first; rows of one id in a source are ordered by leaf digest, and rows equal in
every field are interchangeable (and so are their proofs' results).  Null and empty
texts differ (`-` and `0:`).  An empty table has no rows and no root.  Columns that are
not fields are ignored.  A text is hashed in its scan and travels no further.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_of_id, written

ARITY = 3
LEVELS = 6
BLOCK = ARITY ** LEVELS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_TOP = "top"
_SALTS = 32
_NODE = "tree string, level int, idx long, digest binary"


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Hex digest of a row's fields: `-` if null, else UTF-8 byte count, `:`, value."""
    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(field, columns)), 256)


def joined_digest(digests) -> bytes:
    """H of hex digests, as ASCII bytes."""
    return sha256(b"".join(digests)).hexdigest().encode()


def fold(start: int, digests: Sequence[bytes], levels: int = LEVELS):
    """(level, index, digest) of the nodes above consecutive nodes from index `start` on, at most `levels` up."""
    for level in range(1, levels + 1):
        if start == 0 and len(digests) == 1:
            return
        digests = [joined_digest(digests[i:i + ARITY]) for i in range(0, len(digests), ARITY)]
        start //= ARITY
        yield from ((level, start + i, d) for i, d in enumerate(digests))


def missing(held: Sequence[int], height: int) -> list[tuple[int, int]]:
    """Minimal union of coordinates that a holder of the leaves `held` lacks below `height`; some may not exist."""
    out, held = [], set(held)
    for level in range(height):
        runs = {i // ARITY for i in held}
        out += [(level, i) for r in sorted(runs) for i in range(r * ARITY, (r + 1) * ARITY) if i not in held]
        held = runs
    return out


def expand(leaves: dict[int, bytes], fetched: dict[tuple[int, int], bytes]) -> dict[int, list[tuple[bytes, bytes]]]:
    """Each leaf's proof: the joined digests left and right of its path, level by level.

    Interior nodes above the leaves are derived once and shared by all their proofs.
    """
    level, held, runs_of = 0, dict(leaves), []
    while True:
        around: dict[int, tuple[bytes, bytes]] = {}
        above: dict[int, bytes] = {}
        for run in {i // ARITY for i in held}:
            row = []
            for i in range(run * ARITY, (run + 1) * ARITY):
                digest = held.get(i) or fetched.get((level, i))
                if digest is None:
                    break
                row.append(digest)
            if run == 0 and len(row) == 1:  # the last node that remains
                continue
            for place in range(len(row)):
                around[run * ARITY + place] = (b"".join(row[:place]), b"".join(row[place + 1:]))
            above[run] = joined_digest(row)
        if not around:
            break
        runs_of.append(around)
        held, level = above, level + 1
    return {leaf: [runs_of[k][leaf // ARITY ** k] for k in range(len(runs_of)) if leaf // ARITY ** k in runs_of[k]]
            for leaf in leaves}


def fold_proof(digest: bytes, proof) -> bytes:
    for left, right in proof:
        digest = joined_digest((left, digest, right))
    return digest


@dataclass
class Manifest:
    """leaves: tree, idx, leaf and the given columns; nodes: all interior nodes; sources: tree, source, subroot,
    lefts, rights (proof from subroot to root), root.  All are written tables."""

    leaves: DataFrame
    nodes: DataFrame
    sources: DataFrame


def _fold_block(base: int):
    def run(key, rows):
        rows = rows.sort_by("idx")
        nodes = list(fold(rows["idx"][0].as_py(), rows["digest"].to_pylist()))
        return pa.table({"tree": pa.array([key[0].as_py()] * len(nodes), pa.string()),
                         "level": pa.array([base + n[0] for n in nodes], pa.int32()),
                         "idx": pa.array([n[1] for n in nodes], pa.int64()),
                         "digest": pa.array([n[2] for n in nodes], pa.binary())})

    return run


def _interior(leaves: DataFrame, name: str) -> DataFrame:
    """All interior nodes over (tree, idx, digest): tree, level, idx, digest."""
    base, held, front = 0, None, leaves.select("tree", "idx", "digest")
    while True:
        nodes = written(front.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block"))
                        .applyInArrow(_fold_block(base), _NODE), f"{name}-{base}")
        held = nodes if held is None else held.unionByName(nodes)
        base += LEVELS
        front = nodes.filter(F.col("level") == base).select("tree", "idx", "digest")
        if front.isEmpty():
            return held


def _fetched(leaves: DataFrame, stored: DataFrame, height: int) -> DataFrame:
    """tree, block, nodes: what the leaves of each block lack of the stored nodes, fetched by one join."""
    def ask(key, rows):
        want = missing(rows["idx"].to_pylist(), height)
        return pa.table({"tree": pa.array([key[0].as_py()] * len(want), pa.string()),
                         "block": pa.array([key[1].as_py()] * len(want), pa.int64()),
                         "level": pa.array([w[0] for w in want], pa.int32()),
                         "idx": pa.array([w[1] for w in want], pa.int64())})

    copies = F.pow(F.lit(ARITY), F.greatest(F.col("level") - 2 * LEVELS, F.lit(0))).cast("long")
    asked = leaves.groupBy("tree", "block").applyInArrow(ask, "tree string, block long, level int, idx long")
    dealt = stored.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return (asked.withColumn("copy", F.pmod("block", copies)).join(dealt, ["tree", "level", "idx", "copy"])
            .groupBy("tree", "block").agg(F.collect_list(F.struct("level", "idx", "digest")).alias("nodes")))


def _known(rows) -> dict[tuple[int, int], bytes]:
    return {(n["level"], n["idx"]): n["digest"] for n in rows or []}


def _blocks(leaves: DataFrame) -> DataFrame:
    return leaves.withColumn("block", F.floor(F.col("idx") / BLOCK))


def _stored(leaves: DataFrame | None, nodes: DataFrame) -> DataFrame:
    """Nodes that a block can lack: without `leaves` every block holds all its leaves, so it derives the lower levels."""
    if leaves is None:
        return nodes.filter(F.col("level") >= LEVELS)
    return leaves.select("tree", F.lit(0).alias("level"), "idx", "digest").unionByName(nodes)


def _height(nodes: DataFrame) -> int:
    return nodes.agg(F.coalesce(F.max("level"), F.lit(0))).first()[0]


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """rows with idx: the place in its tree by `order`; no tree passes through one task."""
    spark = rows.sparkSession
    p = int(spark.conf.get("spark.sql.shuffle.partitions"))
    held = written(rows.withColumn("place", F.monotonically_increasing_id())
                   .repartitionByRange(p, "tree", *order, "place").withColumn("pid", F.spark_partition_id()), "leaves")
    # one row a partition: of its trees only the first can begin in an earlier one
    size = F.struct("tree", "count")
    parts = (held.groupBy("pid", "tree").count().groupBy("pid")
             .agg(F.min(size).alias("lo"), F.max(size).alias("hi")).orderBy("pid").collect())
    offsets, last, run = [], None, 0
    for r in parts:
        offsets.append((r["pid"], r["lo"]["tree"], run if r["lo"]["tree"] == last else 0))
        run = r["hi"]["count"] + (run if r["hi"]["tree"] == last else 0)
        last = r["hi"]["tree"]
    offset = F.broadcast(spark.createDataFrame(offsets, "pid int, tree string, skipped long"))
    window = Window.partitionBy("pid", "tree").orderBy(*order, "place")
    return held.join(offset, ["pid", "tree"], "left").withColumn(
        "idx", F.coalesce("skipped", F.lit(0)) + F.row_number().over(window) - 1).drop("pid", "place", "skipped")


def build(docs: DataFrame, presented: Column | None = None, fields: Sequence[str] = FIELDS) -> Manifest:
    """Manifest of the rows; `presented`: another leaf digest of the row, to be verified against it."""
    leaf = leaf_digest([F.col(c) for c in fields])
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("tree"),
                       F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
                       (leaf if presented is None else presented).alias("presented"))
    leaves = written(_numbered(rows, ["doc_id", "leaf"]).withColumn("digest", F.col("leaf").cast("binary")), "numbered")
    nodes = _interior(leaves, "nodes")
    tops = leaves.filter("idx = 0").select("tree", F.lit(0).alias("level"), "digest").unionByName(
        nodes.filter("idx = 0").select("tree", "level", "digest"))
    subroots = tops.groupBy("tree").agg(F.max_by("digest", "level").alias("digest"))
    second = written(_numbered(subroots.select(F.lit(_TOP).alias("tree"), F.col("tree").alias("source_tree"), "digest"),
                               ["source_tree"]), "subroots")
    above = _interior(second, "top")
    paths = written(_paths(_blocks(second), above), "paths")
    root = second.select("idx", F.lit(0).alias("level"), "digest").unionByName(
        above.select("idx", "level", "digest")).filter("idx = 0").agg(F.max_by("digest", "level").alias("root"))
    sources = (second.join(paths, "idx").join(F.broadcast(root))  # one row
               .select(F.col("source_tree").alias("tree"),
                       F.expr("if(source_tree = '-', null, substr(source_tree, 2))").alias("source"),
                       F.col("digest").alias("subroot"), "lefts", "rights", "root"))
    return Manifest(leaves, nodes, written(sources, "sources"))


def _paths(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """idx, lefts, rights: the proof of each leaf of the tree of sources."""
    def path(key, rows, got):
        held = dict(zip(rows["idx"].to_pylist(), rows["digest"].to_pylist(), strict=True))
        proofs = expand(held, _known(got["nodes"][0].as_py() if got.num_rows else None))
        return pa.table({"idx": pa.array(list(proofs), pa.int64()),
                         "lefts": pa.array([[s[0] for s in p] for p in proofs.values()], pa.list_(pa.binary())),
                         "rights": pa.array([[s[1] for s in p] for p in proofs.values()], pa.list_(pa.binary()))})

    got = _fetched(leaves, _stored(None, nodes), _height(nodes)).toDF("of_tree", "of_block", "nodes")
    return leaves.select("tree", "block", "idx", "digest").groupBy("tree", "block").cogroup(
        got.groupBy("of_tree", "of_block")).applyInArrow(path, "idx long, lefts array<binary>, rights array<binary>")


def prove(manifest: Manifest, wanted: Column | None = None, with_proof: bool = False) -> DataFrame:
    """Per wanted leaf (all by default): doc_id, leaf, subroot, root, proof_sha256 (of the siblings by level, left to
    right), folded_root (from the presented digest and the original siblings), verified, and the proof if asked for."""
    leaves = _blocks(manifest.leaves if wanted is None else manifest.leaves.filter(wanted))
    got = _fetched(leaves, _stored(None if wanted is None else manifest.leaves, manifest.nodes),
                   _height(manifest.nodes))
    blocks = leaves.select("tree", "block").distinct().withColumn("salt", F.pmod("block", F.lit(_SALTS)))
    upper = manifest.sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    around = (blocks.join(upper, ["tree", "salt"]).join(got, ["tree", "block"], "left")
              .select("tree", "block", "subroot", "root", "lefts", "rights", "nodes")
              .toDF("of_tree", "of_block", "subroot", "root", "lefts", "rights", "nodes"))
    names = ["leaf", "subroot", "root", "proof_sha256", "folded_root", *(["proof"] if with_proof else [])]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.string()) for c in names), ("verified", pa.bool_())])

    def each(key, rows, got):
        (rest,), places, n = got.to_pylist(), rows["idx"].to_pylist(), rows.num_rows
        digests, presented = rows["digest"].to_pylist(), rows["presented"].cast(pa.binary()).to_pylist()
        inner = expand(dict(zip(places, digests, strict=True)), _known(rest["nodes"]))
        upper = list(zip(rest["lefts"], rest["rights"], strict=True))
        paths = [inner[i] + upper for i in places]
        proofs = [b"".join(left + right for left, right in path) for path in paths]
        ends = [fold_proof(d, path) for d, path in zip(presented, paths, strict=True)]
        out = {"leaf": digests, "subroot": [rest["subroot"]] * n, "root": [rest["root"]] * n, "proof": proofs,
               "proof_sha256": [sha256(p).hexdigest().encode() for p in proofs], "folded_root": ends}
        return pa.table([rows["doc_id"], *(pa.array([x.decode() for x in out[c]], pa.string()) for c in names),
                         pa.array([e == rest["root"] for e in ends], pa.bool_())], schema=schema)

    return leaves.select("tree", "block", "idx", "doc_id", "digest", "presented").groupBy("tree", "block").cogroup(
        around.groupBy("of_tree", "of_block")).applyInArrow(
        each, "doc_id long, " + ", ".join(f"{c} string" for c in names) + ", verified boolean")


def without_line_feeds(docs: DataFrame) -> Column:
    """Leaf digest after tampering: the text of every row of even crc32 of its id loses its line feeds."""
    even = F.col("doc_id").isNotNull() & (crc_of_id() % 2 == 0)
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return leaf_digest([text if c == "text" else F.col(c) for c in FIELDS])


def result(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row, half of them tampered with."""
    return prove(build(docs, without_line_feeds(docs)))


def oracle_sql() -> str:
    """DuckDB SQL of result(): both trees level by level, then each leaf's path."""
    def digest(text: str) -> str:
        def field(c):
            return f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in FIELDS) + ")"

    def levels(name: str, leaves: str) -> str:
        return f"""{name}(tree, level, idx, digest, n) AS (
  SELECT tree, 0, idx, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, level + 1, idx // {ARITY}, sha256(string_agg(digest, '' ORDER BY idx)), (n + {ARITY - 1}) // {ARITY}
  FROM {name} WHERE n > 1 GROUP BY tree, level, idx // {ARITY}, n),
{name}_run AS (SELECT tree, level, idx // {ARITY} AS run, list(digest ORDER BY idx) AS d
               FROM {name} WHERE n > 1 GROUP BY ALL)"""

    def paths(name: str, nodes: str, start: str) -> str:
        own = f"(p.idx % {ARITY} + 1)::INTEGER"
        return f"""{name}(doc, tree, level, idx, fold, proof) AS (
  {start}
  UNION ALL
  SELECT p.doc, p.tree, p.level + 1, p.idx // {ARITY},
         sha256(array_to_string(d[:{own} - 1], '') || p.fold || array_to_string(d[{own} + 1:], '')),
         p.proof || array_to_string(d[:{own} - 1], '') || array_to_string(d[{own} + 1:], '')
  FROM {name} p JOIN {nodes}_run r ON p.tree = r.tree AND p.level = r.level AND p.idx // {ARITY} = r.run)"""

    return f"""WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0],
         lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))) AS t),
base AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '-') AS tree, {digest("text")} AS digest,
         CASE WHEN crc % 2 = 0 THEN {digest("replace(text, chr(10), '')")} ELSE {digest("text")} END AS presented
  FROM (SELECT d.*, xor(4294967295, list_reduce(
          list_concat([4294967295::BIGINT], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
          lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1]))) AS crc FROM documents d, crc_table)),
leaf AS MATERIALIZED (
  SELECT *, row_number() OVER (ORDER BY tree, doc_id NULLS FIRST, digest) AS doc,
         row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
         count(*) OVER (PARTITION BY tree) AS n FROM base),
{levels("node", "leaf")},
subroot AS (SELECT tree AS source_tree, digest, '{_TOP}' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx,
                   count(*) OVER () AS n FROM node WHERE n = 1),
{levels("above", "subroot")},
root AS (SELECT digest FROM above WHERE n = 1),
{paths("inner_path", "node", "SELECT doc, tree, 0, idx, presented, '' FROM leaf")},
inner_end AS (SELECT doc, tree, fold, proof FROM inner_path
              QUALIFY row_number() OVER (PARTITION BY doc ORDER BY level DESC) = 1),
{paths("outer_path", "above",
       f"SELECT e.doc, '{_TOP}', 0, s.idx, e.fold, e.proof FROM inner_end e JOIN subroot s ON e.tree = s.source_tree")},
outer_end AS (SELECT doc, fold, proof FROM outer_path
              QUALIFY row_number() OVER (PARTITION BY doc ORDER BY level DESC) = 1)
SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root, sha256(o.proof) AS proof_sha256,
       o.fold AS folded_root, o.fold = r.digest AS verified
FROM leaf l JOIN subroot s ON l.tree = s.source_tree JOIN outer_end o USING (doc) CROSS JOIN root r"""
