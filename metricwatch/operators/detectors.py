"""Detectors: metric history and source rows in, anomaly rows out.

Six of the seven anomaly types look at the metric history. They are one plan: the history of the metrics that
some rule watches is windowed once, joined with the rules on table and metric, and filtered by the condition
of each rule's type. The seventh looks at single source rows, next to their scan.

Joins with rules carry no hint. Rules given as configuration have a known size, and rules read from a table
are measured, so Spark broadcasts them when they are small; otherwise the join partitions both sides by
table and metric, and the windows use that partitioning.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metricwatch import specs
from metricwatch.functions import messages
from metricwatch.functions.columns import digest_of, moment, named, period_of, severity_rank
from metricwatch.operators.baseline import (
    SERIES,
    dated,
    has_history,
    metric_history,
    with_baseline,
    with_latest,
    with_run_length,
    zero_to_nonzero,
)
from metricwatch.operators.metrics import since_period, source_columns
from metricwatch.operators.rules import PARAMETERS, enabled_rules, watched_metrics
from metricwatch.specs import ANOMALY_SCHEMA, GRAINS, Rule, SourceSpec, metric_columns


def _finish(hits: DataFrame, run_id: str, as_of: datetime | str, *identity: str) -> DataFrame:
    """Bring hits into the anomaly schema. Ids depend on what was found, not on the run or its time."""
    keys = ("table_name", "column_name", "anomaly_type", "unix_micros(period_start)", "metric_name")
    return hits.withColumns(
        {
            "anomaly_id": digest_of(*keys, *identity),
            "run_id": F.lit(run_id),
            "detected_at": moment(as_of),
            "alerted": F.lit(False),
        }
    ).select(*ANOMALY_SCHEMA.names)


def rules_on_history(metrics: DataFrame, rules: DataFrame, columns: DataFrame, window: int = 24) -> DataFrame:
    """History of every watched metric with its baselines, one row per period and rule.

    Metrics that no rule watches are dropped before the shuffle, and a metric that several rules watch is
    windowed once. Runs of zeros are counted against the value that the metric's zero-activity rule names.
    """
    watched = watched_metrics(rules, columns)
    zero = F.max(F.when(F.col("anomaly_type") == specs.ZERO_ACTIVITY, F.col("limit")))
    series = watched.groupBy(*SERIES).agg(zero.alias("zero_value"))
    history = dated(metrics).select(*SERIES, "period_start", "metric_value").join(series, list(SERIES))
    history = with_run_length(with_latest(with_baseline(history, window)), F.col("zero_value"))
    return history.join(watched, list(SERIES))


def _fires(min_history: int) -> Column:
    """Whether a row of the history breaks its rule."""
    value, change, limit, trusted = F.col("metric_value"), F.col("pct_change"), F.col("limit"), has_history(min_history)
    # Too little history, or a clean baseline, leaves the floor as the only test.
    spike = (value >= F.col("floor")) & (~trusted | zero_to_nonzero() | (change >= limit))
    kind = F.col("anomaly_type")
    return (
        F.when(kind == specs.SUDDEN_INCREASE, trusted & (change >= limit))
        .when(kind == specs.SUDDEN_DECREASE, trusted & (change <= limit))
        .when(kind == specs.ZERO_ACTIVITY, (value == limit) & (F.col("run_length") >= F.col("needed_run")))
        .when(kind == specs.STALE_DATA, F.col("is_latest") & (F.col("staleness") > limit))
        .when(kind.isin(specs.DUPLICATE_SPIKE, specs.NULL_SPIKE), spike)
    )


def detect_metric_anomalies(
    metrics: DataFrame,
    rules: DataFrame,
    columns: DataFrame,
    as_of: datetime | str,
    run_id: str,
    window: int = 24,
    min_history: int = 5,
) -> DataFrame:
    """Anomalies of all types but values, for all tables in the history at once.

    ``columns`` comes from ``metric_columns``; ``as_of`` is the time staleness is measured at.
    """
    history = rules_on_history(metrics, rules, columns, window)
    staleness = (moment(as_of).cast("double") - F.col("highest_so_far")) / 60.0
    hits = history.withColumn("staleness", staleness).filter(_fires(min_history))
    detected = f"CASE anomaly_type WHEN '{specs.STALE_DATA}' THEN staleness ELSE metric_value END"
    baseline = f"""CASE anomaly_type WHEN '{specs.STALE_DATA}' THEN limit
        WHEN '{specs.ZERO_ACTIVITY}' THEN previous_value ELSE baseline_median END"""
    described = hits.withColumns({"detected_value": F.expr(detected), "baseline_value": F.expr(baseline)}).withColumns(
        {
            "message": messages.metric_message(window),
            "threshold_used": messages.metric_threshold(window, min_history),
        }
    )
    return _finish(described, run_id, as_of)


def _bound(given: object) -> float | int:
    """A bound as a number; rules may hold it as text."""
    return float(given) if isinstance(given, str) else given


def detect_value_anomalies(
    df: DataFrame,
    spec: SourceSpec,
    rules: Rule | Sequence[Rule],
    as_of: datetime | str,
    run_id: str,
    since: datetime | str | None = None,
) -> DataFrame:
    """Source rows whose value breaks a fixed bound, or lies too many standard deviations from the mean.

    All rules of the table are judged in one pass over it: a row that breaks any goes on and becomes one hit for each rule
    it breaks. Only the values, the event time and the columns that tell rows apart are read, and fixed bounds reach the
    scan. Mean and deviation are those of the whole table and enter as one scalar subquery per column. With ``since`` only
    rows of the periods from there on are judged.
    """
    rules = [rules] if isinstance(rules, Rule) else list(rules)
    columns = [rule.params["metric"] for rule in rules]
    df = source_columns(df, spec, *columns)
    judged = df if since is None else since_period(df, spec, since)
    numbers: dict[str, Column] = {}
    broken, found = [], []
    for rule, column in zip(rules, columns, strict=True):
        value = named(column)
        if _fixed(rule):
            lower, upper = rule.params["fixed_lower_threshold"], rule.params["fixed_upper_threshold"]
            # Fixed value: the note for fixed bounds.
            note = f"outside [{lower}, {upper}]"
            breaks, baseline = (value > _bound(upper)) | (value < _bound(lower)), F.lit(None)
        else:
            bound = rule.params["zscore_threshold"]
            # Fixed value: the note for z-scores.
            note = f"|zscore| >= {bound}"
            if column not in numbers:
                numbers[column] = df.agg(F.struct(F.avg(value).alias("mean"), F.stddev(value).alias("deviation"))).scalar()
            mean, deviation = numbers[column]["mean"], numbers[column]["deviation"]
            # A constant column has deviation zero, the score is null and nothing fires.
            breaks, baseline = F.abs(F.try_divide(value - mean, deviation)) >= _bound(bound), mean
        broken.append(breaks)
        found.append(
            F.struct(
                F.lit(column).alias("column_name"),
                F.lit(rule.severity).cast("string").alias("severity"),
                value.cast("double").alias("detected_value"),
                baseline.cast("double").alias("baseline_value"),
                F.lit(note).alias("threshold_used"),
            )
        )
    hits = judged.filter(reduce(or_, broken))
    hit = found[0] if len(rules) == 1 else F.explode(F.array_compact(F.array(*(F.when(b, f) for b, f in zip(broken, found, strict=True)))))
    # Without declared ids, rows are told apart by their place in the scan, so that many copies of one row are
    # still that many anomalies and never one hot id.
    identity = [named(c) for c in spec.id_columns] or [F.monotonically_increasing_id()]
    rows = hits.select(
        F.lit(spec.table_name).alias("table_name"),
        F.lit(specs.VALUE_ANOMALY).alias("anomaly_type"),
        period_of(spec.timestamp_column, spec.trunc_unit).alias("period_start"),
        F.array(*(part.cast("string") for part in identity)).alias("_identity"),
        hit.alias("_hit"),
    ).select("*", "_hit.*", F.col("_hit.column_name").alias("metric_name"))
    rows = rows.withColumn("message", messages.value_message())
    several = ["threshold_used"] if len(set(columns)) < len(columns) else []  # one row may break two rules on a column
    return _finish(rows, run_id, as_of, "detected_value", *(f"_identity[{i}]" for i in range(len(identity))), *several)


def _fixed(rule: Rule) -> bool:
    given = rule.params.get("use_fixed_threshold", True)
    return given.lower() in ("true", "t", "yes", "y", "1") if isinstance(given, str) else bool(given if given is not None else True)


def missing_periods(
    metrics: DataFrame, grain: str, as_of: datetime | str | None = None, expected: DataFrame | None = None
) -> DataFrame:
    """Periods from a table's first one on for which it has no rows at all.

    They end with the last period that has rows, or with ``as_of`` with the last period that is over by then. ``expected``
    (``table_name, expected_from``) says from when on a table should have rows: periods before its first one count from
    there, and a table without any row lacks all of them up to ``as_of``. Each
    gap is filled from the row before it, by day and then within the day, so no calendar is built or joined and no array is longer
    than a day's periods. ``baseline_value`` is the row count of the last period that had rows, null before the first.
    """
    unit = GRAINS[grain]
    step = F.expr(f"INTERVAL 1 {unit.upper()}")
    series = Window.partitionBy("table_name").orderBy("period_start")
    following = F.lead("period_start").over(series)
    counts = dated(metric_history(metrics, specs.ROW_COUNT))
    if expected is not None:
        counts = counts.select("table_name", "period_start", "metric_name", "metric_value")
        first = counts.groupBy("table_name").agg(F.min("period_start").alias("_first_row"))
        begin = F.when(F.date_trunc(unit, "expected_from") == F.col("expected_from"), F.col("expected_from")).otherwise(
            F.date_trunc(unit, "expected_from") + step  # a period that is under way is not expected whole
        )
        starts = expected.groupBy("table_name").agg(F.min(begin).alias("_begin")).join(first, "table_name", "left")
        starts = starts.filter(F.col("_begin") < F.coalesce("_first_row", F.lit("9999-12-31").cast("timestamp")))
        before = starts.select(
            "table_name",
            (F.col("_begin") - step).alias("period_start"),
            F.lit(specs.ROW_COUNT).alias("metric_name"),
            F.lit(None).cast("double").alias("metric_value"),
        )
        counts = counts.unionByName(before)
    if as_of is not None:
        following = F.coalesce(following, F.date_trunc(unit, moment(as_of)))
    gaps = counts.withColumn("_next", following).filter(F.col("_next") > F.col("period_start") + step)
    gaps = gaps.withColumn("_first", F.col("period_start") + step).withColumn("_last", F.col("_next") - step)
    day, whole = F.date_trunc("day", "_first"), F.expr("INTERVAL 1 DAY")
    years = F.sequence(F.year("_first"), F.year("_last"))
    # A gap may span centuries: years, then their days, then a day's periods.
    gaps = gaps.withColumn("_year", F.explode(years))
    begin = F.greatest(day, F.make_timestamp("_year", F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))
    end = F.least("_last", F.make_timestamp("_year", F.lit(12), F.lit(31), F.lit(23), F.lit(59), F.lit(59)))
    gaps = gaps.withColumn("_day", F.explode(F.sequence(begin, end, whole)))
    if unit in ("minute", "hour"):
        begin = F.greatest("_first", "_day")
        end = F.least("_last", F.col("_day") + whole - step)
        gaps = gaps.withColumn("_period", F.explode(F.sequence(begin, end, step)))
    else:
        gaps = gaps.withColumn("_period", F.col("_day")).filter(F.date_trunc(unit, "_day") == F.col("_day"))
    return gaps.select(
        "table_name",
        F.col("_period").alias("period_start"),
        "metric_name",
        F.lit(0.0).alias("detected_value"),
        F.col("metric_value").alias("baseline_value"),
    )


def detect_missing_periods(
    metrics: DataFrame,
    rules: DataFrame,
    specs_of_tables: Iterable[SourceSpec],
    as_of: datetime | str,
    run_id: str,
) -> DataFrame:
    """Missing periods as anomalies, for tables with an enabled zero-activity rule, each once per table and period.

    A rule may say ``expected_from``, the time from which on its table should have rows, so that data that never
    arrived is found: also of a table whose rows have never been seen.
    """
    tables, kind = list(specs_of_tables), specs.ZERO_ACTIVITY
    spark = metrics.sparkSession
    grains = {spec.grain for spec in tables}
    names = {grain: [spec.table_name for spec in tables if spec.grain == grain] for grain in grains}
    rule = enabled_rules(rules).filter(F.col("anomaly_type") == kind)
    said = F.from_json("rule_json", PARAMETERS)["expected_from"].try_cast("timestamp")
    expected = rule.select("table_name", said.alias("expected_from")).filter("expected_from IS NOT NULL")

    def of(frame: DataFrame, grain: str) -> DataFrame:
        return frame.filter(F.col("table_name").isin(*names[grain]))

    missing = reduce(
        DataFrame.unionByName,
        [missing_periods(of(metrics, grain), grain, as_of, of(expected, grain)) for grain in sorted(grains)],
    )
    rule = rule.groupBy("table_name", "anomaly_type").agg(F.min_by("severity", severity_rank()).alias("severity"))
    columns = metric_columns(spark, tables).filter(F.col("metric_name") == specs.ROW_COUNT)
    hits = (
        missing.join(rule.select("table_name", "anomaly_type", "severity"), "table_name")
        .join(columns.select("table_name", F.col("activity_column").alias("column_name")), "table_name", "left")
        .withColumn("limit_text", F.lit("0"))
        .withColumn("threshold_used", messages.text_by_type({kind: messages.THRESHOLDS[kind]}))
        .withColumn("message", messages.text_by_type({kind: messages.MESSAGES[kind]}))
    )
    return _finish(hits, run_id, as_of)


def detect(
    metrics: DataFrame,
    sources: Iterable[tuple[DataFrame, SourceSpec]],
    rules: DataFrame,
    values: Mapping[str, Rule | Sequence[Rule]],
    as_of: datetime | str,
    run_id: str,
    window: int = 24,
    min_history: int = 5,
    since: datetime | str | None = None,
) -> DataFrame:
    """Every anomaly of the given tables as one plan.

    ``rules`` drives the metric checks; ``values`` maps a table's name to its value rules. With ``since`` the
    value rules skip rows of earlier periods; the metric checks always cover the whole history.
    """
    sources = list(sources)
    tables = [spec for _, spec in sources]
    columns = metric_columns(metrics.sparkSession, tables)
    # The history may hold tables of other runs, which know their columns and log them.
    metrics = metrics.filter(F.col("table_name").isin([spec.table_name for spec in tables]))
    frames = [detect_metric_anomalies(metrics, rules, columns, as_of, run_id, window, min_history)]
    for df, spec in sources:
        given = values.get(spec.table_name, ())
        wanted = [rule for rule in ([given] if isinstance(given, Rule) else given) if rule.enabled]
        if wanted:
            frames.append(detect_value_anomalies(df, spec, wanted, as_of, run_id, since))
    return reduce(DataFrame.unionByName, frames)
