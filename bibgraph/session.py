"""Spark session and checkpoint-directory helpers.

The library never decides where lineage cuts are stored on a cluster: it
reads ``spark.checkpoint.dir`` (or an already-set SparkContext checkpoint
directory) from the session.  Only a local master without any setting gets a
private scratch folder, which is what the tests and the local bench use.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(master: str | None = None, partitions: int | None = None,
                  app: str = "bibgraph") -> SparkSession:
    """Session tuned for the library: AQE on, UI off, UTC, Arrow on."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    master = master or f"local[{cpus}]"
    partitions = partitions or max(cpus, 4)
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.default.parallelism", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BIBGRAPH_DRIVER_MEMORY", "16g"))
        .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared lineage-cut folder, setting a local one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="bibgraph-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


#: Rows that one task sorts or groups; more rows are dealt out over more tasks.
TASK_ROWS = 1 << 18


def partitions_for(spark: SparkSession, n_rows: int) -> int:
    """Partitions for so many rows: the session's number, more if tasks would get over TASK_ROWS."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_rows // TASK_ROWS))


def tasks_for(spark: SparkSession, n_rows: int) -> int:
    """Tasks for a table that a loop reads again and again: one a core, more for more rows, never many for few."""
    sessions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(min(sessions, spark.sparkContext.defaultParallelism), -(-n_rows // TASK_ROWS))


def spread(df: DataFrame, n_rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by keys over as many tasks as so many rows need; as it is where the session's number does."""
    n = partitions_for(df.sparkSession, n_rows)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table beside the checkpoints."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def scratch_database(spark: SparkSession) -> str:
    """A database beside the checkpoints: its tables are managed, so dropping one removes its files."""
    base = checkpoint_dir(spark).rstrip("/")
    name = f"bibgraph_{uuid.uuid5(uuid.NAMESPACE_URL, base).hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{base}/{name}'")
    return name


#: Spark removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def own_shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go when their query ends: for results that are written."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)


def written_to(df: DataFrame, path: str) -> DataFrame:
    """Write to ``path``, remove the shuffle files of that, and read back."""
    with own_shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df, name: str):
    """Cut the lineage: write to the shared checkpoint folder and read back."""
    return written_to(df, scratch_path(df.sparkSession, name))


def scratch_tables(df: DataFrame) -> list[str]:
    """Paths of the written intermediate tables that ``df`` reads."""
    base = checkpoint_dir(df.sparkSession).rstrip("/")
    found = {m[1] for m in (re.search(r"/tables/([\w-]+-[0-9a-f]{12})/", f) for f in df.inputFiles()) if m}
    return sorted(f"{base}/tables/{name}" for name in found)


def replaced(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, for a frame that nobody else reads: the intermediate tables it was made of are removed."""
    sources = scratch_tables(df)
    out = written(df, name)
    remove(df.sparkSession, sources)
    return out


#: A job over more rows than PART_ROWS is done for a part of the keys after the other, in PARTS parts at most.
PART_ROWS = 1 << 22
PARTS = 3


def in_parts(df: DataFrame, key: str, n_rows: int, step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``step(df)``, for steps that work on each key of ``df`` alone.

    Over many rows it is done part after part, by a hash of the key, and written: the shuffle
    files of one part are gone before the next begins.  Joins with ``df`` on the key take its
    condition over to the other side, so rows of other parts are left out before a shuffle.
    """
    n = min(PARTS, -(-n_rows // PART_ROWS))
    if n <= 1:
        return step(df)
    out = [written(step(df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i)), "part") for i in range(n)]
    return reduce(DataFrame.unionByName, out)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Remove written intermediate tables that nothing reads any more."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
