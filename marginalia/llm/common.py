"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..scratch import cut, drop
from .words import forget

BATCH_ROWS = 2000
BATCH_BYTES = 4 << 20


__all__ = ["buckets", "cut", "drop", "in_arrow", "most_frequent", "release", "table", "tidy"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def most_frequent(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys (as unsigned) and counts of the most frequent keys of (key long, n long): all whose
    count has at least as many bits as lets no more than ``limit`` of them through."""
    counts = cut(counts, "counts")
    sizes = counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect()
    least, room = 65, limit
    for r in sorted(sizes, key=lambda r: -r.bits):
        room -= r["count"]
        if room < 0:
            break
        least = r.bits
    top = counts.where(F.length(F.bin("n")) >= least).select("key", "n").toArrow()
    drop(counts)
    return top["key"].to_numpy().astype(np.int64).view(np.uint64), top["n"].to_numpy().astype(np.int64)


def buckets(docs: DataFrame, text_col: str, bytes_per_bucket: int) -> int:
    """Bucket count for a shuffle over texts: by their bytes, which are summed up in one pass over
    that column, at least the session's partitions. It changes no result."""
    least = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.agg(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    return max(least, -(-int(size) // bytes_per_bucket))


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def tidy() -> None:
    """Gives freed memory of a Python worker back, as workers outlive their tasks."""
    forget()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def in_arrow(df: DataFrame, run, schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` for long rows: memory is given back after a task, and batches end at
    BATCH_ROWS rows or with the row that reaches BATCH_BYTES. Spark knows these bounds as settings
    of the session only: they are lowered here, never raised."""
    conf, in_bytes = df.sparkSession.conf, df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most, number in (("maxRecordsPerBatch", BATCH_ROWS, int), ("maxBytesPerBatch", BATCH_BYTES, in_bytes)):
        now = number(conf.get(f"spark.sql.execution.arrow.{name}"))
        if now <= 0 or now > most:
            conf.set(f"spark.sql.execution.arrow.{name}", str(most))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            tidy()

    return df.mapInArrow(task, schema)
