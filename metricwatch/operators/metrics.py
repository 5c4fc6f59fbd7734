"""Per-period metrics of a table, in long form.

All statistics of a table come from one aggregation by period, so it is read once. Only very wide tables are
split by columns, since an aggregation of hundreds of values runs slower than several narrow ones; each pass
reads its own columns and the event time. The duplicate count needs its own grouping by business key and reads
the key columns only. All are plain sums, counts and extremes, which Spark pre-aggregates before the shuffle:
a hot period or a hot key arrives as one small partial row per task.

A row without an event time belongs to the null period, which is kept like any other.
"""

from __future__ import annotations

from collections.abc import Collection, Iterable, Mapping
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch.functions.columns import is_blank, kind_of, moment, named, period_of, quoted
from metricwatch.specs import (
    DUPLICATE_COUNT,
    LAST_UPDATED,
    METRICS_SCHEMA,
    NULL_RATIO,
    ROW_COUNT,
    STATISTICS,
    SourceSpec,
)

# Spark compiles a stage to one piece of code while its rows have at most 100 fields (the default of
# spark.sql.codegen.maxFields). An aggregation past that takes several times as long per column. A numeric
# column's statistics buffer up to 8 fields; the period, row count and ingestion time take the rest.
FIELDS_PER_PASS = 92
FIELDS_PER_NUMERIC = 8


def source_columns(df: DataFrame, spec: SourceSpec, *others: str) -> DataFrame:
    """The table with the nested fields that the spec names by path as columns of their own."""
    used = [
        spec.timestamp_column,
        spec.ingestion_timestamp_column,
        spec.status_column,
        *spec.id_columns,
        *spec.duplicate_key_columns,
        *spec.monitored_null_columns,
        *spec.numeric_metric_columns,
        *others,
    ]
    present = set(df.columns)
    paths = [c for c in used if c and c not in present and c.split(".")[0] in present]
    return df.withColumns({path: F.col(path) for path in paths}) if paths else df


def with_period(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Add ``period_start``, the bucket of the event time at the table's grain."""
    period = period_of(spec.timestamp_column, spec.trunc_unit)
    return source_columns(df, spec).withColumn("period_start", period)


def _statistics(column: str) -> list[Column]:
    # The mean is the sum over the count, so that exact sums (integers, decimals) give a mean that does not
    # depend on the order of the rows.
    value = quoted(column)
    formulas = {
        "sum": f"CAST(sum({value}) AS DOUBLE)",
        "avg": f"try_divide(CAST(sum({value}) AS DOUBLE), CAST(count({value}) AS DOUBLE))",
        "stddev": f"stddev({value})",
        "min": f"CAST(min({value}) AS DOUBLE)",
        "max": f"CAST(max({value}) AS DOUBLE)",
    }
    return [F.expr(formulas[name]).alias(f"{name}_{column}") for name in STATISTICS]


def null_counts(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Null or blank cells per period, one column per watched column, beside the period's row count."""
    rows = with_period(df, spec)
    counts = [F.expr(f"count_if({is_blank(rows, c)})").alias(f"null_count_{c}") for c in spec.monitored_null_columns]
    return rows.groupBy("period_start").agg(F.count(F.lit(1)).alias(ROW_COUNT), *counts)


def period_metrics(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """All metrics of each period as one wide row, from one pass over the table."""
    rows = with_period(df, spec)
    columns = [F.expr("CAST(count(1) AS DOUBLE)").alias(ROW_COUNT)]
    for column in spec.numeric_metric_columns:
        columns += _statistics(column)
    for column in spec.monitored_null_columns:
        ratio = f"CAST(count_if({is_blank(rows, column)}) AS DOUBLE) / CAST(count(1) AS DOUBLE)"
        columns.append(F.expr(ratio).alias(f"{NULL_RATIO}_{column}"))
    if spec.ingestion_timestamp_column:
        latest = F.max(named(spec.ingestion_timestamp_column))
        columns.append(latest.cast("timestamp").cast("double").alias(LAST_UPDATED))
    return rows.groupBy("period_start").agg(*columns)


def column_passes(spec: SourceSpec, limit: int = FIELDS_PER_PASS) -> list[SourceSpec]:
    """The spec cut into passes whose aggregation buffers hold at most ``limit`` fields.

    Only the first pass has the ingestion time.
    """
    numeric, nulls = "numeric_metric_columns", "monitored_null_columns"
    columns = [(numeric, c, FIELDS_PER_NUMERIC) for c in spec.numeric_metric_columns]
    columns += [(nulls, c, 1) for c in spec.monitored_null_columns]
    passes, room = [{numeric: (), nulls: ()}], limit
    for role, column, fields in columns:
        if room < fields:
            passes.append({numeric: (), nulls: ()})
            room = limit
        passes[-1][role] += (column,)
        room -= fields
    first, *others = (replace(spec, **roles) for roles in passes)
    return [first, *(replace(other, ingestion_timestamp_column=None) for other in others)]


def to_long(wide: DataFrame) -> DataFrame:
    """One row per period and metric; metrics without a value keep their row."""
    values = [named(column) for column in wide.columns if column != "period_start"]
    return wide.unpivot(["period_start"], values, "metric_name", "metric_value")


def duplicate_count(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Excess rows over one per business key in the whole table, tagged to its latest period.

    Rows whose key is null form one group. The latest event time travels with the key counts, so the key
    columns and event time are read once. An empty table gives no row.
    """
    keys = [named(column) for column in spec.duplicate_key_columns]
    latest = F.max(named(spec.timestamp_column)).alias("_latest")
    per_key = source_columns(df, spec).groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), latest)
    whole = per_key.agg(F.max("_latest").alias("_latest"), F.sum(F.col("_rows") - 1).alias("_excess"))
    return whole.filter(F.col("_excess").isNotNull()).select(
        period_of("_latest", spec.trunc_unit).alias("period_start"),
        F.lit(DUPLICATE_COUNT).alias("metric_name"),
        F.col("_excess").cast("double").alias("metric_value"),
    )


def duplicate_history(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """The duplicate count as it stood at the end of each period.

    A key adds no duplicate in the period it is first seen, and one per row after that. So the count after
    a period is the rows so far less the keys first seen so far, which takes two aggregations and a running
    sum over periods, and never gathers the rows of a key. It equals the count a run at the end of each
    period would have stored when rows arrive in event-time order. Rows without event time are left out.
    """
    time, unit = named(spec.timestamp_column), spec.trunc_unit
    dated = source_columns(df, spec).filter(time.isNotNull())
    keys = [named(column) for column in spec.duplicate_key_columns]
    per_key = dated.groupBy(*keys).agg(F.min(time).alias("_first"))
    first_seen = per_key.groupBy(period_of("_first", unit).alias("period_start")).agg(F.count(F.lit(1)).alias("_keys"))
    rows = with_period(dated, spec).groupBy("period_start").agg(F.count(F.lit(1)).alias("_rows"))
    so_far = Window.partitionBy("table_name").orderBy("period_start").rowsBetween(Window.unboundedPreceding, 0)
    excess = F.sum(F.col("_rows") - F.coalesce("_keys", F.lit(0))).over(so_far)
    return (
        rows.join(first_seen, "period_start", "left")
        .withColumn("table_name", F.lit(spec.table_name))
        .select("period_start", F.lit(DUPLICATE_COUNT).alias("metric_name"), excess.cast("double").alias("metric_value"))
    )


def since_period(df: DataFrame, spec: SourceSpec, since: datetime | str) -> DataFrame:
    """Rows of the period that holds ``since`` and of later ones.

    The bound is cast to the column's own type and lies on a period's edge, so it reaches the scan and no
    period is cut.
    """
    rows = source_columns(df, spec)
    bound = F.date_trunc(spec.trunc_unit, moment(since)).cast(kind_of(rows, spec.timestamp_column))
    return rows.filter(named(spec.timestamp_column) >= bound)


def tag_metrics(long: DataFrame, spec: SourceSpec, run_id: str, computed_at: datetime | str) -> DataFrame:
    """Bring long metrics of one table into the schema of the metric history."""
    return long.select(
        F.lit(run_id).alias("run_id"),
        F.lit(spec.table_name).alias("table_name"),
        "period_start",
        "metric_name",
        F.col("metric_value").cast("double").alias("metric_value"),
        moment(computed_at).alias("computed_at"),
    ).select(*METRICS_SCHEMA.names)


def compute_metrics(
    df: DataFrame,
    spec: SourceSpec,
    run_id: str,
    computed_at: datetime | str,
    since: datetime | str | None = None,
    only: Collection[str] | None = None,
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """All metrics of one table, one row per period and metric.

    With ``since`` only the periods from there on are read and computed, for an upsert into a history that
    holds the older ones. The duplicate count always covers the whole table: it reads the key columns of all rows, unless
    ``duplicates`` has it, kept up to date by ``runs.duplicate_counts``. ``only`` names the metrics to
    compute; columns that none of them needs are not read.
    """
    recent = df if since is None else since_period(df, spec, since)
    frames = []
    for number, part in enumerate(column_passes(spec)):
        wide = period_metrics(recent, part)
        wanted = [c for c in wide.columns[1:] if (number == 0 or c != ROW_COUNT) and (only is None or c in only)]
        if wanted:
            frames.append(to_long(wide.select("period_start", *map(named, wanted))))
    if spec.duplicate_key_columns and (only is None or DUPLICATE_COUNT in only):
        frames.append(duplicate_count(df, spec) if duplicates is None else duplicates)
    return tag_metrics(reduce(DataFrame.unionByName, frames), spec, run_id, computed_at)


def compute_all(
    sources: Iterable[tuple[DataFrame, SourceSpec]],
    run_id: str,
    computed_at: datetime | str,
    since: datetime | str | None = None,
    only: Mapping[str, Collection[str]] | None = None,
    duplicates: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Metrics of many tables as one plan, so that Spark runs their stages side by side in one job.

    ``only`` maps a table's name to the metrics to compute for it, ``duplicates`` to its duplicate count if that is known.
    """
    known = duplicates or {}
    frames = [
        compute_metrics(
            df, spec, run_id, computed_at, since, None if only is None else only[spec.table_name], known.get(spec.table_name)
        )
        for df, spec in sources
    ]
    return reduce(DataFrame.unionByName, frames)


def unexpected_status(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows per period and status whose status is not an expected one. A missing status is unexpected."""
    status = named(spec.status_column)
    unexpected = source_columns(df, spec).filter(status.isNull() | ~status.isin(*spec.expected_status_values))
    return (
        with_period(unexpected, spec)
        .groupBy("period_start", status.alias("status"))
        .agg(F.count(F.lit(1)).alias("unexpected_rows"))
        .select(F.lit(spec.table_name).alias("table_name"), "period_start", "status", "unexpected_rows")
    )
