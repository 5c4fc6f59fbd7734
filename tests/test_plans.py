"""Plans have the shape that scales: few scans, early filters, no Python, no row-sized gathering."""

import re
from pathlib import Path

import pytest
from helpers import BOUNDS_ROWS, SPEC, START
from pyspark.sql import functions as F

import metricwatch
from __spark_entry__ import queries
from metricwatch import specs
from metricwatch.operators import detectors, metrics
from metricwatch.operators.anomaly_log import new_anomalies
from metricwatch.plans import fixtures as fx
from metricwatch.specs import ANOMALY_SCHEMA

SF_DIR = "/root/testdata/sf0.001"


def planned(df):
    """The plan Spark would start with."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def counts(df, *operators):
    plan = planned(df)
    return [len(re.findall(rf"\b{operator}\b", plan)) for operator in operators]


def test_one_scan_and_one_shuffle_for_all_period_metrics(spark):
    wide = metrics.to_long(metrics.period_metrics(fx.events(spark, SF_DIR), fx.EVENTS))
    assert counts(wide, "FileScan", "Exchange") == [1, 1]
    # The duplicate count adds one scan, by key.
    assert counts(fx.event_metrics(spark, SF_DIR), "FileScan") == [2]


def test_only_needed_columns_are_read(spark):
    plan = planned(fx.event_metrics(spark, SF_DIR, only=["sum_amount"]))
    assert re.findall(r"ReadSchema: struct<(.*?)>", plan) == ["ts:timestamp_ntz,value:double"]
    plan = planned(metrics.duplicate_count(fx.lineitem(spark, SF_DIR), fx.LINEITEM))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_shipdate:timestamp_ntz>" in plan


def test_since_reaches_the_scan(spark):
    recent = metrics.since_period(fx.events(spark, SF_DIR), fx.EVENTS, fx.SPLIT)
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in planned(recent)


def test_value_bounds_reach_the_scan(spark):
    hits = detectors.detect_value_anomalies(fx.events(spark, SF_DIR), fx.EVENTS, fx.VALUE_RULES["events"], fx.AS_OF, "r")
    plan = planned(hits)
    assert "GreaterThan(value,200.0),LessThan(value,0.0)" in plan
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,value:double>" in plan
    assert "Exchange" not in plan


def test_zscore_needs_no_join(spark):
    hits = detectors.detect_value_anomalies(fx.events(spark, SF_DIR), fx.EVENTS, fx.ZSCORE_RULE, fx.AS_OF, "r")
    plan = planned(hits)
    assert "Join" not in plan and "Subquery" in plan


def test_metric_detectors_share_one_shuffle(spark):
    history = fx.stored(spark, fx.event_metrics(spark, SF_DIR))
    columns = specs.metric_columns(spark, [fx.EVENTS])
    hits = detectors.detect_metric_anomalies(history, fx.rules(spark, "events"), columns, fx.AS_OF, "r")
    # All windows work on the same sorted partitions. Grouping the rules takes a shuffle too, which serves the
    # windows as well when the history is the smaller side.
    scans, shuffles, sorts, merges = counts(hits, "FileScan", "Exchange hashpartitioning", "Sort", "SortMergeJoin")
    assert (scans, sorts, merges) == (1, 1, 0) and shuffles <= 2


def test_large_rules_are_not_broadcast_and_add_no_shuffle_for_windows(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        history = fx.stored(spark, fx.event_metrics(spark, SF_DIR))
        columns = specs.metric_columns(spark, [fx.EVENTS])
        hits = detectors.detect_metric_anomalies(history, fx.rules(spark, "events"), columns, fx.AS_OF, "r")
        plan = planned(hits)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Broadcast" not in plan
    # From the join with the rules down to the join that selects the watched metrics, nothing is shuffled.
    upper, windows = plan.index("SortMergeJoin"), plan.index("Window")
    lower = plan.index("SortMergeJoin", windows)
    assert upper < windows < lower and "Exchange" not in plan[upper:lower]


def test_no_query_runs_python_or_a_cross_join(spark):
    for name in ("detect_all", "alert_outbox", "digest_html", "duplicate_history", "missing_periods", "upsert_metrics"):
        plan = planned(queries()[name](spark, SF_DIR))
        assert not re.search(r"Python|Pandas|CartesianProduct|BroadcastNestedLoopJoin", plan), name


def test_operators_hold_no_actions_or_hints():
    root = Path(metricwatch.__file__).parent
    banned = re.compile(r"\.(collect|toPandas|localCheckpoint|take|head|first|count|rdd)\(\)|broadcast\(|crossJoin|udf\(|uuid\(\)")
    for folder in ("operators", "functions"):
        for path in (root / folder).glob("*.py"):
            assert not banned.search(path.read_text()), path


def hot_rows(spark, n=30_000):
    """A third of all rows share one key and one hour."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id").cast("int").alias("id"),
        F.when(hot, F.lit(START)).otherwise(F.timestamp_seconds(F.lit(1704067200) + F.col("id"))).alias("at"),
        F.when(hot, F.lit(None)).otherwise(F.col("id").cast("string")).alias("key"),
        F.lit("x").alias("note"),
        F.lit(50).alias("amount"),
        F.lit(START).alias("loaded"),
    )


@pytest.mark.parametrize("operator", [metrics.duplicate_count, metrics.duplicate_history])
def test_hot_keys_are_counted_before_the_shuffle(spark, operator):
    rows = hot_rows(spark)
    counted = operator(rows, SPEC)
    assert counted.orderBy(F.desc("period_start")).first()["metric_value"] == 9_999
    plan = planned(counted)
    assert "partial_" in plan and "Window [row_number" not in plan
    # Every exchange sits right above a partial aggregate or a frame of periods.
    for line, below in zip(plan.splitlines(), plan.splitlines()[1:]):
        if "Exchange" in line:
            assert re.search("HashAggregate|Sort|Project|AQE", below), below


def test_hot_hour_of_hits_is_spread(spark):
    hits = spark.range(8_000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("anomaly_id"),
        F.lit("t").alias("table_name"),
        F.lit("c").alias("column_name"),
        F.lit("value_anomaly").alias("anomaly_type"),
        F.lit(START).alias("period_start"),
    )
    log = spark.createDataFrame([], ANOMALY_SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        fresh = new_anomalies(hits, log.unionByName(log.limit(1)))
        sizes = fresh.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(r["count"] for r in sizes) == 8_000
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 5_000


def test_results_do_not_depend_on_partitioning(spark):
    rows = [(n, START, str(n % 7), "x" if n % 3 else " ", n * n % 101, START) for n in range(200)]
    df = spark.createDataFrame(rows, BOUNDS_ROWS).withColumn("at", F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 977))
    found = []
    for parts in (1, 7):
        long = metrics.compute_metrics(df.repartition(parts), SPEC, "r", START)
        found.append({(r.period_start, r.metric_name): r.metric_value for r in long.filter("metric_name not like 'stddev%'").collect()})
    assert found[0] == found[1]


def test_bucketed_tables_need_no_shuffle_by_key(spark):
    hot_rows(spark, 3_000).write.bucketBy(4, "key").sortBy("key").mode("overwrite").saveAsTable("bucketed_rows")
    try:
        counted = metrics.duplicate_count(spark.table("bucketed_rows"), SPEC)
        assert counted.first()["metric_value"] == 999
        assert "Exchange hashpartitioning" not in planned(counted)
    finally:
        spark.sql("DROP TABLE bucketed_rows")
