"""The duplicate count of a table that grows, without reading its old rows again.

What is kept per table is the set of business keys seen before a cut in event time, as 128-bit hashes, and how many rows
and keys those were. The rows from the cut on are grouped by key and joined with the seen keys: excess rows are all rows
less all keys. Moving the cut adds the keys that are new behind it; no stored row is ever rewritten.

Rows without event time lie behind no cut and are counted anew each time. Rows that arrive late behind the cut are not
counted until the state is started over.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import kind_of, moment, named, period_of
from metricwatch.operators.metrics import source_columns
from metricwatch.specs import DUPLICATE_COUNT, SourceSpec

KEY = ("key_high", "key_low")


def cut_at(spec: SourceSpec, since: datetime | str) -> Column:
    """The edge of the period that holds ``since``."""
    return F.date_trunc(spec.trunc_unit, moment(since))


def keyed(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The hashes of each row's business key and its event time. Null parts differ from all values; null keys are one key."""
    parts = [part for c in spec.duplicate_key_columns for part in (named(c), named(c).isNull())]
    return source_columns(df, spec).select(
        F.xxhash64(*parts).alias(KEY[0]), F.xxhash64(F.lit(1), *parts).alias(KEY[1]), named(spec.timestamp_column).alias("_time")
    )


def rows_between(df: DataFrame, spec: SourceSpec, begin: Column | None, end: Column | None) -> DataFrame:
    """Rows from one cut on and before another, by filters that reach the scan; without an end, rows without time too."""
    rows = source_columns(df, spec)
    time, kind = named(spec.timestamp_column), kind_of(rows, spec.timestamp_column)
    if begin is not None:
        from_begin = time >= begin.cast(kind)
        rows = rows.filter(from_begin | time.isNull() if end is None else from_begin)
    return rows if end is None else rows.filter(time < end.cast(kind))


def per_key(rows: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows and latest event time of each key."""
    return keyed(rows, spec).groupBy(*KEY).agg(F.count(F.lit(1)).alias("rows"), F.max("_time").cast("timestamp").alias("latest"))


def totals_with(counts: DataFrame, seen: DataFrame, rows: int, keys: int, latest: datetime | None) -> DataFrame:
    """rows, keys, latest: the kept totals with the counted keys added, those among the seen ones as rows only."""
    known = seen.select(*KEY).distinct().withColumn("_seen", F.lit(True))
    added = counts.join(known, list(KEY), "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"),
        F.count_if(F.col("_seen").isNull()).alias("_keys"),
        F.max("latest").alias("_latest"),
    )
    return added.select(
        (F.col("_rows") + rows).alias("rows"),
        (F.col("_keys") + keys).alias("keys"),
        F.greatest(F.col("_latest"), F.lit(latest).cast("timestamp")).alias("latest"),
    )


def as_metric(totals: DataFrame, spec: SourceSpec) -> DataFrame:
    """The duplicate count as a metric of the table's latest period; a table without rows gives none."""
    return totals.filter("rows > 0").select(
        period_of("latest", spec.trunc_unit).alias("period_start"),
        F.lit(DUPLICATE_COUNT).alias("metric_name"),
        (F.col("rows") - F.col("keys")).cast("double").alias("metric_value"),
    )
