"""Incremental graph load: keyed tables in buckets, merged batch by batch.

The reference re-runs its ``MERGE`` loads over new files.  Here each node or edge
table is a store of one row per key, dealt into a fixed number of buckets by a hash of
the key.  A batch folds its writes to one row per key, reads the buckets it touches,
merges and writes those buckets alone, as a new version; a manifest, written last,
names the batch that holds each bucket's current version.

A row keeps the order (arrival, file_no, row_no) of the write that won, and merging
takes the smallest (nodes: first writer) or the largest (edges: last writer).  That is
commutative and idempotent: batches in any split and order give the table of one full
load, and a replayed batch changes nothing.  A batch reads versions of earlier batches
only, so a retry after a lost executor writes the same files again.

Stubs (cited papers without a row) are papers whose order comes after every real
write; the first real write turns a stub into a paper.  Edges are kept whether or not
their author has arrived; ``GraphStore.graph`` joins them with the authors, so an
edge appears as soon as both ends exist.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..graph import Graph
from ..operators import graph_build as gb
from ..session import written
from ..sources.load_files import read_load_files

ORDER = ("arrival", "file_no", "row_no")
_ORDER_DDL = "arrival bigint, file_no bigint, row_no bigint"
_LATEST = (1 << 62,) * 3


@dataclass(frozen=True)
class KeyedStore:
    """One row per key at ``path``; ``props`` and ``keys`` are DDL, ``last``: the last write wins, else the first."""

    spark: SparkSession
    path: str
    keys: str
    props: str = ""
    last: bool = False
    buckets: int = 64

    @property
    def key_names(self) -> list[str]:
        return StructType.fromDDL(self.keys).names

    @property
    def prop_names(self) -> list[str]:
        return StructType.fromDDL(self.props).names if self.props else []

    @property
    def _ddl(self) -> str:
        return ", ".join(x for x in (self.keys, _ORDER_DDL, self.props) if x)

    def _read_or_none(self, path: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":  # nothing written yet; any other error is one
                return None
            raise

    def versions(self, before: int | None = None) -> dict[int, int]:
        """Batch that holds the current version of each bucket (at most one row a bucket)."""
        held = self._read_or_none(f"{self.path}/manifest", "bucket int, version bigint")
        if held is None:
            return {}
        if before is not None:
            held = held.where(F.col("version") < before)
        return {r["bucket"]: r["version"] for r in held.groupBy("bucket").agg(F.max("version").alias("version")).collect()}

    def _stored(self, versions: dict[int, int]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], self._ddl)
        return self.spark.read.schema(self._ddl).parquet(
            *[f"{self.path}/data/{batch}/bucket={bucket}" for bucket, batch in sorted(versions.items())])

    def _fold(self, rows: DataFrame) -> DataFrame:
        pick = F.max if self.last else F.min
        won = rows.groupBy(*self.key_names).agg(pick(F.struct(*ORDER, *self.prop_names)).alias("_w"))
        return won.select(*self.key_names, "_w.*")

    def merge(self, rows: DataFrame, batch_id: int) -> list[int]:
        """Fold a batch of writes (keys, order, props) into the store; the buckets it rewrote."""
        typed = self.spark.createDataFrame([], self._ddl).schema
        writes = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in typed])
        bucket = F.pmod(F.xxhash64(*self.key_names), F.lit(self.buckets)).cast("int")
        new = written(self._fold(writes).withColumn("bucket", bucket), "writes")
        touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most one row a bucket
        if not touched:
            return []
        current = self.versions(before=batch_id)
        old = self._stored({b: v for b, v in current.items() if b in set(touched)})
        merged = self._fold(old.unionByName(new.drop("bucket"))).withColumn("bucket", bucket)
        # folding left the rows dealt by key: each task writes its part of every bucket, however few the buckets
        (merged.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/{batch_id}"))
        (self.spark.createDataFrame([(b, batch_id) for b in touched], "bucket int, version bigint").coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/batch={batch_id}"))
        return touched

    def read(self, with_order: bool = False) -> DataFrame:
        """The current rows: keys and props."""
        held = self._stored(self.versions())
        return held if with_order else held.select(*self.key_names, *self.prop_names)


@dataclass
class GraphStore:
    """The stores of all node and edge tables under one folder."""

    spark: SparkSession
    path: str
    buckets: int = 64
    stores: dict[str, KeyedStore] = field(init=False)

    def __post_init__(self):
        def store(name, keys, props="", last=False):
            return KeyedStore(self.spark, f"{self.path}/{name}", keys, props, last, self.buckets)

        self.stores = {
            "paper": store("paper", "paperId string",
                           "title string, url string, abstract string, year bigint, citationCount bigint, stub boolean"),
            "author": store("author", "authorId string", "name string, affiliation string, affiliationType string"),
            "venue": store("venue", "kind string, name string"),
            "wrote": store("wrote", "authorId string, paperId string", "corresponding boolean", True),
            "published_in": store("published_in", "paperId string, kind string, name string",
                                  "year bigint, edition bigint, venue string, journal_volume string", True),
            "cites": store("cites", "src string, dst string"),
            "contains": store("contains", "paperId string, keyword string"),
            "reviewed": store("reviewed", "authorId string, paperId string", "approved string, comments string", True),
            "affiliated_to": store("affiliated_to", "authorId string, organization string"),
        }

    def _writes(self, rows: DataFrame | None, author_rows: DataFrame | None) -> dict[str, DataFrame]:
        out = {}
        unordered = [F.lit(0).alias(c) for c in ORDER[1:]]
        if rows is not None:
            cites = gb.cites_writes(rows)
            papers = gb.paper_writes(rows).withColumn("stub", F.lit(False))
            stubs = cites.select(F.col("dst").alias("paperId")).distinct().select(
                "paperId", F.lit(_LATEST[1]).alias("file_no"), F.lit(_LATEST[2]).alias("row_no"), F.lit(True).alias("stub"))
            out |= {"paper": papers.unionByName(stubs, allowMissingColumns=True),
                    "wrote": gb.wrote_writes(rows, None), "published_in": gb.published_in_writes(rows, None),
                    "reviewed": gb.reviewed_writes(rows, None),
                    "venue": gb.venue_nodes(rows).select("*", *unordered),
                    "cites": cites.distinct().select("*", *unordered),
                    "contains": gb.contains_edges(rows, None).select("*", *unordered)}
        if author_rows is not None:
            out |= {"author": gb.author_writes(author_rows),
                    "affiliated_to": gb.affiliated_edges(author_rows)[1].select("*", *unordered)}
        return out

    def merge(self, rows: DataFrame | None, author_rows: DataFrame | None, batch_id: int,
              by_arrival: bool = False, tables: Iterable[str] | None = None) -> dict[str, list[int]]:
        """Fold a batch of load rows into every table (or the named ones); buckets rewritten by table.

        ``row_no`` of the rows tells their order in the whole load.  With ``by_arrival`` it
        counts inside the batch only, and a later batch is a later write.
        """
        out, wanted = {}, None if tables is None else set(tables)
        arrival = F.lit(batch_id if by_arrival else 0).cast("bigint")
        for name, writes in self._writes(rows, author_rows).items():
            if wanted is None or name in wanted:
                late = F.when(F.col("stub"), F.lit(_LATEST[0])).otherwise(arrival) if name == "paper" else arrival
                out[name] = self.stores[name].merge(writes.withColumn("arrival", late), batch_id)
        return out

    def table(self, name: str) -> DataFrame:
        """Current rows of a table; WROTE and REVIEWED without the edges whose author hasn't arrived."""
        held = self.stores[name].read()
        if name in ("wrote", "reviewed"):
            return held.join(self.stores["author"].read().select("authorId"), "authorId", "left_semi")
        return held

    def graph(self) -> Graph:
        t = {name: self.table(name) for name in self.stores}
        organization = t["affiliated_to"].select(F.col("organization").alias("name")).distinct()
        return Graph(**(t | {"paper": t["paper"].drop("stub")}),
                     keyword=t["contains"].select(F.col("keyword").alias("text")).distinct()).with_tables(
            organization=organization)


def start_graph_load(spark: SparkSession, input_dir: str, store: GraphStore, checkpoint_location: str,
                     kind_of: dict[str, str], author_stem: str = "authors_info", available_now: bool = True,
                     max_files_per_batch: int = 1000) -> StreamingQuery:
    """Stream arriving load files into a graph store; a later batch is a later write.

    ``kind_of`` maps the beginning of a file name to its publication kind.  The stream
    discovers files (paths only) exactly once; each batch reads its files by header.
    """
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("pathGlobFilter", "*.csv").option("maxFilesPerTrigger", max_files_per_batch)
             .load(input_dir).select("path"))

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        papers: dict[str, list[str]] = {}
        authors: list[str] = []
        for (path,) in batch.collect():  # file paths of this batch only
            stem = path.rsplit("/", 1)[-1]
            kind = next((k for begin, k in kind_of.items() if stem.startswith(begin)), None)
            if kind is None and not stem.startswith(author_stem):
                raise ValueError(f"{path}: the name tells no kind of load file")
            (authors if kind is None else papers.setdefault(kind, [])).append(path)
        session = batch.sparkSession
        rows = with_columns(read_load_files(session, papers), PAPER_COLUMNS) if papers else None
        author_rows = None
        if authors:
            author_rows = with_columns(read_load_files(session, {"Author": authors}), AUTHOR_COLUMNS).withColumn(
                "file_no", F.lit(0))
        store.merge(rows, author_rows, batch_id, by_arrival=True)

    writer = files.writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


# The columns of the load files that the loading steps read.
PAPER_COLUMNS = ("paperId", "title", "url", "abstract", "year", "citationCount", "authorIds", "corresponding_author",
                 "venue", "approved", "reviewers", "comments", "proceedings", "edition", "journal_name",
                 "journal_volume", "keywords", "Citations")
AUTHOR_COLUMNS = ("authorId", "name", "Affiliations", "Affiliation_type")


def with_columns(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """rows with every one of the columns; one that no file has is null."""
    return rows.withColumns({c: F.lit(None).cast("string") for c in columns if c not in rows.columns})
