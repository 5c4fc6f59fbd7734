"""The anomaly log: what is new, what is pending, and counts over it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import severity_rank

# The columns that make two detections the same.
LOG_KEYS = ("table_name", "column_name", "anomaly_type", "period_start")


#: Into how many parts hits are dealt where Spark doesn't split hot keys itself.
FIXED_SALTS = 16


def new_anomalies(hits: DataFrame, log: DataFrame, salts: int | None = None) -> DataFrame:
    """Hits that are not in the log yet. Keys compare null-safely; hits are not compared with each other.

    The logged side is one row per table, column, type and period. One hour of one table can hold most hits of a run, when a
    bound is broken by nearly every row: Spark then splits that key's hits and gives each part the logged row, as
    its size shows at run time. Where adaptive execution is off, hits are dealt out by their id, which is one row's, to
    FIXED_SALTS parts, and the logged keys are repeated for each; ``salts`` sets another number.
    """
    if salts is None:
        adaptive = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
        salts = 1 if all(hits.sparkSession.conf.get(name) == "true" for name in adaptive) else FIXED_SALTS
    logged = log.select(*(F.col(key).alias(f"_logged_{key}") for key in LOG_KEYS)).distinct()
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_logged_{key}")) for key in LOG_KEYS))
    if salts > 1:
        logged = logged.withColumn("_logged_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same &= F.pmod(F.xxhash64("anomaly_id"), F.lit(salts)).cast("int") == F.col("_logged_salt")
    return hits.join(logged, same, "left_anti")


def pending_anomalies(log: DataFrame, dedupe: bool = True) -> DataFrame:
    """Anomalies to alert on: those not alerted yet, or with ``dedupe`` off all of them again."""
    return log.filter(~F.col("alerted")) if dedupe else log


def anomaly_summary(log: DataFrame) -> DataFrame:
    """Counts per detector and severity."""
    return log.groupBy("anomaly_type", "severity").agg(F.count(F.lit(1)).alias("anomalies"))


def alert_totals(log: DataFrame) -> DataFrame:
    """How many anomalies the log holds and how many of these were alerted."""
    return log.agg(F.count(F.lit(1)).alias("logged"), F.count_if("alerted").alias("alerted"))


def anomalies_ordered(log: DataFrame) -> DataFrame:
    """The log, most urgent first, then by time."""
    return log.orderBy(severity_rank(), "severity", "detected_at", "period_start", "anomaly_id")


def metrics_ordered(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("period_start", "metric_name", "table_name")
