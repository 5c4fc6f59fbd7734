"""Trailing baselines over the metric history.

A series is one metric of one table. All windows here share the same partitioning and order, so the history
is shuffled and sorted once. A series has at most one row per period: its length is set by the calendar
(a year of minutes is about half a million rows), never by the number of rows in the watched table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

SERIES = ("table_name", "metric_name")
#: Spark evaluates a moving median's whole window anew for each row. From so many rows on, the window is kept in order instead.
WIDE_WINDOW = 100


def series_window() -> WindowSpec:
    return Window.partitionBy(*SERIES).orderBy("period_start")


def metric_history(metrics: DataFrame, *metric_names: str) -> DataFrame:
    """The rows of the named metrics."""
    return metrics.filter(F.col("metric_name").isin(*metric_names))


def dated(metrics: DataFrame) -> DataFrame:
    """The history without the rows of the null period, which come from source rows that have no event time."""
    return metrics.filter(F.col("period_start").isNotNull())


def with_previous(metrics: DataFrame) -> DataFrame:
    """Add ``previous_value``, the value one row earlier in the series."""
    return dated(metrics).withColumn("previous_value", F.lag("metric_value").over(series_window()))


def with_baseline(metrics: DataFrame, window: int = 24) -> DataFrame:
    """Add what a value is compared with.

    ``previous_value``; ``baseline_median``, the lower median of the ``window`` rows before this one;
    ``history_count``, the non-null values among these; ``pct_change`` from the median. The window counts
    rows, so gaps in time do not shrink it, and the row itself is never part of it. The null period is left out.
    """
    ordered = series_window()
    trailing = ordered.rowsBetween(-window, -1)
    if window >= WIDE_WINDOW:
        added = _with_kept_window(dated(metrics), window)
    else:
        added = dated(metrics).withColumns(
            {
                "baseline_median": F.percentile_approx("metric_value", 0.5).over(trailing),
                "history_count": F.count("metric_value").over(trailing),
            }
        )
    previous = F.lag("metric_value").over(ordered)
    return added.withColumn("previous_value", previous).select(
        *metrics.columns, "previous_value", "baseline_median", "history_count", percent_change().alias("pct_change")
    )


def _with_kept_window(metrics: DataFrame, window: int) -> DataFrame:
    """Add ``baseline_median`` and ``history_count`` from a window kept in order, which each row changes by two values.

    A task reads its series one after another in the order of time and holds one window. NaN ranks above all numbers.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        series, rows, ranked = None, deque(), []
        for batch in batches:
            medians, counts = [], []
            names = zip(batch.column(SERIES[0]).to_pylist(), batch.column(SERIES[1]).to_pylist(), strict=True)
            for name, value in zip(names, batch.column("metric_value").to_pylist(), strict=True):
                if name != series:
                    series, rows, ranked = name, deque(), []
                medians.append(ranked[(len(ranked) - 1) // 2][1] if ranked else None)
                counts.append(len(ranked))
                key = None if value is None else (value != value, value if value == value else 0.0), value
                rows.append(key)
                if key[0] is not None:
                    insort(ranked, key, key=lambda held: held[0])
                if len(rows) > window:
                    gone = rows.popleft()
                    if gone[0] is not None:
                        del ranked[bisect_left(ranked, gone[0], key=lambda held: held[0])]
            added = [pa.array(medians, pa.float64()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "baseline_median", "history_count"])

    schema = T.StructType([*metrics.schema, T.StructField("baseline_median", T.DoubleType()), T.StructField("history_count", T.LongType())])
    return metrics.repartition(*SERIES).sortWithinPartitions(*SERIES, "period_start").mapInArrow(walk, schema)


def with_latest(metrics: DataFrame) -> DataFrame:
    """Add ``highest_so_far`` and ``is_latest``: on a series' last row they give its maximum."""
    ordered = series_window()
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return metrics.withColumns(
        {
            "highest_so_far": F.max("metric_value").over(so_far),
            "is_latest": F.lead(F.lit(1)).over(ordered).isNull(),
        }
    )


def with_run_length(metrics: DataFrame, value: Column) -> DataFrame:
    """Add ``run_length``: how many rows in a row, up to this one, have held exactly ``value``."""
    ordered = series_window()
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = metrics.withColumn("_row", F.row_number().over(ordered))
    broken_at = F.max(F.when(F.col("metric_value").eqNullSafe(value), None).otherwise(F.col("_row"))).over(so_far)
    return numbered.withColumn("run_length", F.col("_row") - F.coalesce(broken_at, F.lit(0))).drop("_row")


def percent_change() -> Column:
    """Percent deviation from the baseline; null when the baseline is null or zero."""
    return F.expr("try_divide(metric_value - baseline_median, abs(baseline_median)) * 100.0D")


def has_history(minimum: int) -> Column:
    """Whether enough earlier values exist to trust the baseline."""
    return F.col("history_count") >= minimum


def zero_to_nonzero() -> Column:
    """A clean zero baseline and a value above it, where a percent change is undefined."""
    return (F.col("baseline_median") == 0) & (F.col("metric_value") > 0)
