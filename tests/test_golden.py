"""The sample events give the documented metrics, anomalies and alerts, and a second run adds nothing."""

from datetime import datetime, timedelta

import duckdb
import pytest
import sample
from sample import AS_OF, RULES, SETTINGS, SPEC, TABLE, frame

from metricwatch import Rule
from metricwatch.operators import alerts
from metricwatch.operators.detectors import detect_value_anomalies
from metricwatch.plans import runs
from metricwatch.sources import state
from metricwatch.sources.state import StateTables


# 15 rows per hour (a count, twice five statistics, three null ratios, the latest load) and the duplicate count.
METRIC_ROWS = 15 * sample.HOURS + 1
FOUND = 6 + 1 + 3 + 1 + 1 + 2  # changes, huge, silent, stale, repeated, blank


def hour(number):
    return sample.START + timedelta(hours=number)


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    tables = StateTables(spark, "golden_state", str(tmp_path_factory.mktemp("state")))
    assert runs.set_up(tables, RULES) == 7
    sources = [(frame(spark).cache(), SPEC)]
    assert runs.run_metrics(tables, sources, "m1", AS_OF) == METRIC_ROWS
    found = runs.run_detection(tables, sources, "d1", AS_OF).collect()
    return tables, sources, found


def changes():
    """hour, amount and trailing median of the hours whose amount is far from it, by DuckDB."""
    made = duckdb.connect()
    made.execute("CREATE TABLE t (hour INT, amount INT)")
    made.executemany("INSERT INTO t VALUES (?, ?)", [(hour, sample.amount(hour)) for hour in range(sample.HOURS)])
    return made.execute(
        """SELECT hour, amount, median FROM (SELECT *,
            quantile_disc(amount, 0.5) OVER w AS median, count(*) OVER w AS n
            FROM t WINDOW w AS (ORDER BY hour ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))
        WHERE n >= 5 AND abs(amount - median) * 100.0 / median >= 50"""
    ).fetchall()


def test_metrics(run):
    metrics = run[0].read(state.METRICS)
    assert metrics.filter("metric_name like 'stddev%' and metric_value is null").count() == 2 * sample.HOURS
    duplicates = metrics.filter("metric_name = 'duplicate_count'").collect()
    assert [(r.period_start, r.metric_value) for r in duplicates] == [(hour(sample.HOURS - 1), 1.0)]


def test_anomalies(run):
    found = {}
    for row in run[2]:
        found.setdefault(row.anomaly_type, []).append(
            (row.period_start, row.severity, row.column_name, row.detected_value, row.baseline_value)
        )
    moved = [(hour(h), "HIGH", "amount", float(value), float(median)) for h, value, median in changes()]
    newest = max(row[-1] for row in sample.rows())
    assert {kind: sorted(rows) for kind, rows in found.items()} == {
        "sudden_increase": [m for m in moved if m[3] > m[4]],
        "sudden_decrease": [m for m in moved if m[3] < m[4]],
        "value_anomaly": [(hour(sample.HUGE), "CRITICAL", "amount", 88000.0, None)],
        "missing_zero_activity": [(hour(h), "HIGH", "activity_count", 0.0, float(h == sample.SILENT[0])) for h in sample.SILENT],
        "stale_data": [
            (hour(sample.HOURS - 1), "MEDIUM", "ingestion_time", (datetime.fromisoformat(AS_OF) - newest).total_seconds() / 60, 180.0)
        ],
        "duplicate_record_anomaly": [(hour(sample.HOURS - 1), "MEDIUM", "order_id", 1.0, None)],
        "null_data_quality_spike": [(hour(h), "MEDIUM", "buyer", 1.0, 0.0) for h in sample.BLANK],
    }
    assert [m[0] for m in moved] == [hour(h) for h in sorted(sample.PLANTED)]


def test_messages(run):
    texts = {(row.message, row.threshold_used) for row in run[2]}
    percent = {h: (value - median) * 100.0 / median for h, value, median in changes()}
    up, down = percent[sample.SPIKE], percent[sample.DIP]
    stale = (datetime.fromisoformat(AS_OF) - max(row[-1] for row in sample.rows())).total_seconds() / 60
    trend = "pct_change_vs_rolling_median >= 50.0% (trailing 24 periods, min history 5)"
    spike = "pct_change_vs_rolling_median >= 100.0% once 5+ periods of trailing 24-period history exist"
    assert {
        (
            f"Sudden increase: sum_amount is {up:.1f}% above its trailing 24-period median (threshold 50.0%)",
            trend,
        ),
        (
            f"Sudden decrease: sum_amount is {down:.1f}% below its trailing 24-period median (threshold -50.0%)",
            trend.replace(">= 50.0", "<= -50.0"),
        ),
        ("Value anomaly on amount = 88000.0 (outside [0, 50000])", "outside [0, 50000]"),
        ("No activity detected for period (sum_activity_count = 0)", "sum_activity_count == 0"),
        (f"Data is stale: last updated {stale} minutes ago (limit 180 min)", "staleness_minutes > 180"),
        ("Duplicate record spike: 1.0 duplicate row(s) detected", f"duplicate_count >= 1, and {spike}"),
        ("Null/data-quality spike on buyer: null ratio = 100.0%", f"null_ratio >= 0.05, and {spike}"),
    } <= texts


def test_second_run_adds_nothing(run):
    tables, sources, _ = run
    assert runs.run_metrics(tables, sources, "m2", AS_OF) == METRIC_ROWS
    assert runs.run_detection(tables, sources, "d2", AS_OF).count() == 0
    assert tables.read(state.ANOMALIES).count() == FOUND


def test_zscore(spark):
    rule = Rule(TABLE, "value_anomaly", "CRITICAL", True, {"metric": "amount", "use_fixed_threshold": False, "zscore_threshold": 3.0})
    hits = detect_value_anomalies(frame(spark), SPEC, rule, AS_OF, "z").collect()
    mean = sum(map(sample.amount, range(sample.HOURS))) / sample.HOURS
    assert [(h.detected_value, round(h.baseline_value, 6)) for h in hits] == [(88000.0, round(mean, 6))]
    assert hits[0].threshold_used == "|zscore| >= 3.0"


def test_alerts(run, spark):
    tables = run[0]
    outbox = runs.run_alerting(tables, SETTINGS, "a1")
    assert sorted((r.channel, r.status, r.in_digest) for r in outbox.collect()) == (
        [("email", "PENDING", True)] * FOUND + [("teams", "SKIPPED", False)]
    )
    summary = alerts.digest_summary(tables.read(state.ANOMALIES), SETTINGS, AS_OF).collect()
    assert [(r.anomalies, r.severity_summary, r.subject) for r in summary] == [
        (FOUND, "1 CRITICAL, 9 HIGH, 4 MEDIUM", f"[Anomaly Digest] {FOUND} anomalies detected - 2025-03-05")
    ]
    assert runs.digest_of_run(tables, "a1").count() == FOUND
    none = spark.createDataFrame([], "alert_id string, status string, error_message string")

    failed = runs.record_outcomes(tables, "a1", none, ("FAILED", "no route to host"), AS_OF)
    assert failed.groupBy("status").count().orderBy("status").collect() == [("FAILED", FOUND), ("SKIPPED", 1)]
    assert tables.read(state.ANOMALIES).filter("alerted").count() == 0

    runs.run_alerting(tables, SETTINGS, "a2")
    assert runs.run_alerting(tables, SETTINGS, "a2").count() == FOUND + 1
    runs.record_outcomes(tables, "a2", none, ("SENT", None), AS_OF)
    sent = runs.record_outcomes(tables, "a2", none, ("SENT", None), AS_OF)
    assert sent.count() == FOUND + 1
    assert sent.filter("status = 'SKIPPED'").select("error_message").distinct().collect() == [
        ("Channel 'teams' disabled in config",)
    ]
    assert tables.read(state.ANOMALIES).filter("alerted").count() == FOUND
    assert tables.read(state.ALERTS).count() == 2 * (FOUND + 1)


def test_reset(run):
    tables = run[0]
    with pytest.raises(ValueError):
        tables.reset("yes")
    tables.reset("RESET")
    counts = {table: tables.read(table).count() for table in state.SCHEMAS}
    assert counts == {table: 7 if table == state.RULES else 0 for table in state.SCHEMAS}
    assert tables.read(state.METRICS).columns == state.SCHEMAS[state.METRICS].names
