"""Shared pieces of the training-data operators: table access, stage files, Arrow batches, hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import new_path, shared_dir, ship, stage  # noqa: F401

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tune(spark: SparkSession) -> None:
    """Ship the package, and keep Arrow batches small (texts can be long) where their size is left to its default."""
    ship(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) in (None, "10000"):
        spark.conf.set(key, "1000")


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand on the executors."""
    tune(df.sparkSession)
    return df.mapInArrow(work, schema)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that ``stage`` wrote and nothing will read again."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/ligature/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(hadoop).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def byte_slices(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of consecutive items whose sizes add up to ``limit`` at most; a larger item is a run of its own."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def together(batches: Iterator[pa.RecordBatch], column: int, limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Runs of consecutive batches, each closed by the batch with which a column's bytes reach ``limit``."""
    held: list[pa.RecordBatch] = []
    total = 0
    for batch in batches:
        held.append(batch)
        total += batch.column(column).nbytes
        if total >= limit:
            yield held
            held, total = [], 0
    if held:
        yield held


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` reproducible 64-bit constants."""
    with np.errstate(over="ignore"):
        return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(0x9E3779B97F4A7C15))
