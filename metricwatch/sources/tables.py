"""Reading watched tables."""

from __future__ import annotations

import time
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the catalog."""
    return spark.table(name)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """CSV files with a header line. The schema is given, so the files are read once and never sampled.

    A line or header that does not fit the schema stops the read.
    """
    return spark.read.schema(schema).options(**options).csv(path, header=True, mode="FAILFAST", enforceSchema=False)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    """Create a catalog schema if it is absent."""
    place = "" if location is None else " LOCATION :location"
    args = {"name": name} if location is None else {"name": name, "location": location}
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:name)" + place, args=args)


def schema_folder(spark: SparkSession, name: str) -> str:
    """Where the tables of a catalog schema lie."""
    return spark.catalog.getDatabase(name).locationUri


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of any store that Spark reads; one that isn't there is no error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_unused(spark: SparkSession, folder: str, used: Collection[str], older_than_hours: float) -> int:
    """Delete the files below a folder that are not used and have not changed for so long; returns how many."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(path):
        return 0
    kept = {hadoop.Path(spark._jvm.java.net.URI(name)).toUri().getPath() for name in used}
    bound, files, removed = (time.time() - older_than_hours * 3600) * 1000, store.listFiles(path, True), 0
    while files.hasNext():
        found = files.next()
        if found.getPath().toUri().getPath() not in kept and found.getModificationTime() <= bound:
            removed += store.delete(found.getPath(), False)
    return removed
