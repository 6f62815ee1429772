"""What the operators of this package share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostra.runtime import fits_broadcast, scratch_path, ship_package

Batches = Iterator[pa.RecordBatch]


def whole_text(name: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def give_back() -> None:
    """Hand freed memory back to the system: a worker that waits for a task would keep it."""
    gc.collect()  # what only circles hold
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _giving_back(fn: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        try:
            yield from fn(batches)
        finally:
            give_back()

    return run


def map_batches(df: DataFrame, fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers, which keep no freed memory."""
    ship_package(df.sparkSession)
    return df.mapInArrow(_giving_back(fn), schema)


def by_bytes(batches: Batches, column: str, limit: int = 8 << 20) -> Batches:
    """The batches in pieces of about ``limit`` bytes of ``column``; a longer text is alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
        piece, begin = np.cumsum(sizes) // limit, 0
        for end in [*(np.flatnonzero(np.diff(piece)) + 1), batch.num_rows]:
            if end > begin:
                yield batch.slice(begin, end - begin)
            begin = end


_temporary: list[list[str]] = []


def written(df: DataFrame, name: str, keep: bool = False, **options: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    if _temporary and not keep:
        _temporary[-1].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Tables written within are deleted at the end, but for those to ``keep``."""
    _temporary.append([])
    try:
        yield
    finally:
        for path in _temporary.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark._jsc.hadoopConfiguration()).delete(found, True)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``written`` table that no later result reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(df.sparkSession, folder)


def small(df: DataFrame, max_bytes: int = 32 << 20) -> DataFrame:
    """Marked for broadcast if its measured size is within the bound, else as it is."""
    return F.broadcast(df) if fits_broadcast(df, max_bytes) else df


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model learns labels from: crc32 of the id as text is divisible by five."""
    remainder = F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
