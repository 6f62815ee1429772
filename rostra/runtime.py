"""Scratch tables, size-checked broadcasts and distributed ranking."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BROADCAST_BYTES = 64 * 1024 * 1024
# The most frequent terms, handled apart so that none of them lands in one task.
HEAVY_TERMS = 10_000
# Bytes of stored input that one task of a heavy scan sorts or sums, whatever the size of the table.
SPLIT_BYTES = 16 * 1024 * 1024
# monotonically_increasing_id keeps the partition in the bits above this one.
_ROW_BITS = 33
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SPLIT = "spark.sql.files.maxPartitionBytes"


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="rostra-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    run = spark.sparkContext.applicationId
    return f"{scratch_dir(spark)}/{run}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def storing(spark: SparkSession, split_bytes: int | None = None) -> Iterator[None]:
    """Jobs that store a table: what they shuffle is deleted at their end, as nothing reads it
    again. With ``split_bytes`` a task scans no more than that, so what it sorts or sums does
    not grow with the table.
    """
    settings = {_CLEANUP: "true"}
    if split_bytes:
        settings[_SPLIT] = str(split_bytes)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def materialize(df: DataFrame, name: str, split_bytes: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, name)
    with storing(df.sparkSession, split_bytes):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application; results must be stored by then."""
    _delete(spark, f"{scratch_dir(spark)}/{spark.sparkContext.applicationId}")


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that nothing reads any more."""
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def spread(df: DataFrame) -> DataFrame:
    """Use all cores when an input is one small file; a scan with enough splits is unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def size_in_bytes(df: DataFrame) -> int:
    row = F.octet_length(F.to_json(F.struct(*df.columns)))
    return df.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return size_in_bytes(df) <= max_bytes


def heavy_terms(vocab: DataFrame, count: int = HEAVY_TERMS) -> DataFrame:
    """At most ``count`` rows by construction, so a broadcast of them is bounded."""
    return vocab.orderBy(F.desc("df"), "term").limit(count)


def join_vocabulary(facts: DataFrame, vocab: DataFrame, heavy: int = HEAVY_TERMS) -> DataFrame:
    """``facts`` joined with ``vocab`` on term, safe for terms that most documents hold.

    Rows of the most frequent terms meet a bounded broadcast and are not shuffled. Any
    other term holds at most 1/``heavy`` of the postings, so the shuffled join is even.
    """
    head = heavy_terms(vocab, heavy)
    frequent = facts.join(F.broadcast(head), "term")
    rest = facts.join(F.broadcast(head.select("term")), "term", "left_anti")
    return frequent.unionByName(rest.join(vocab, "term"))


def dense_row_number(df: DataFrame, name: str, order: list[Column], start: int = 0) -> DataFrame:
    """Add a dense 64-bit number in a global order, sorted and counted in parallel.

    The rows are range-partitioned and sorted once; each then needs only the number of rows
    in the partitions before its own. The one window without a key runs over a table with
    one row per partition.
    """
    ordered = df.orderBy(*order).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(ordered, "ordered")
    return _number_by_partition(rows, name, start)


def _number_by_partition(rows: DataFrame, name: str, start: int) -> DataFrame:
    part = F.shiftright("_row", _ROW_BITS)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    in_part = F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)
    return (
        rows.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_off") + in_part + start)
        .drop("_row", "_part", "_off")
    )


def rank_within(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """``row_number`` per key for groups of any size.

    A window would sort a whole group in one task. Here all rows are sorted by key and order
    across the cluster, numbered densely, and the first number of the key is subtracted.
    """
    numbered = materialize(
        dense_row_number(df, "_number", [*[F.col(k) for k in keys], *order]), "numbered"
    )
    first = numbered.groupBy(*keys).agg(F.min("_number").alias("_first"))
    if fits_broadcast(first):
        first = F.broadcast(first)
    return (
        numbered.join(first, keys)
        .withColumn(name, F.col("_number") - F.col("_first") + 1)
        .drop("_number", "_first")
    )


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = tempfile.mkdtemp(prefix="rostra-package-") + "/rostra"
    shutil.make_archive(archive, "zip", root_dir=package.parent, base_dir=package.name)
    context.addPyFile(archive + ".zip")
    _shipped.add(context.applicationId)
