"""Tables, the folder that all executors share, and the few columns and shuffles that several operators need."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Lets Spark remove the shuffle files of a plan once it has run, rather than whenever the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession) -> str:
    """A new path in the folder that the cluster names in spark.checkpoint.dir.

    Local mode has one machine, so a temporary folder serves if none is named; a cluster has to name one.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="metricwatch-")
    return f"{shared}/llm/{uuid.uuid4()}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written once and read back, so that later plans don't compute them again; its shuffles are removed."""
    path = new_folder(df.sparkSession)
    write(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write(df: DataFrame, path: str) -> None:
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(doc_id: str, n: int) -> Column:
    """crc32 of the id as text modulo n, by which rows are held out; null for a null id."""
    return (F.crc32(F.col(doc_id).cast("string")) % n).cast("int")


def hand_back() -> None:
    """Returns to the machine what this process no longer uses; numpy's and Arrow's allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def frugal(rows: Callable) -> Callable:
    """`rows` for mapInArrow, whose worker hands memory back at a task's end: workers outlive tasks, and idle ones would keep it."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            hand_back()

    return task


def frugal_group(work: Callable) -> Callable:
    """`work` for applyInArrow, as frugal() does."""

    def task(group: pa.Table) -> pa.Table:
        found = work(group)
        hand_back()
        return found

    return task
