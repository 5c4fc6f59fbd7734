import random
from collections import Counter
from dataclasses import replace
from datetime import datetime
from functools import reduce

import pytest
from helpers import (
    AS_OF,
    BOUNDS_ROWS,
    DECREASE,
    DUPLICATES,
    HISTORY,
    INCREASE,
    NULLS,
    SPEC,
    STALE,
    START,
    TABLE,
    detected,
    history,
    hour,
    hours_of,
    rule,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch import Rule, SourceSpec, metric_columns, rules_frame
from metricwatch.operators import baseline
from metricwatch.operators.baseline import with_baseline, with_previous
from metricwatch.operators.detectors import (
    detect,
    detect_metric_anomalies,
    detect_missing_periods,
    detect_value_anomalies,
    missing_periods,
)
from metricwatch.operators.rules import rule_violations, sound_rules
from metricwatch.plans import runs
from metricwatch.specs import RULES_SCHEMA, source_fields


def test_median_is_the_lower_middle_of_earlier_rows(spark):
    rows = with_baseline(history(spark, "m", [1, 2, 3, 4, 100])).orderBy("period_start").collect()
    assert [r.baseline_median for r in rows] == [None, 1.0, 1.0, 2.0, 2.0]
    assert [r.history_count for r in rows] == [0, 1, 2, 3, 4]
    assert [r.previous_value for r in rows] == [None, 1.0, 2.0, 3.0, 4.0]
    assert rows[4].pct_change == 4900.0


def test_window_counts_rows_and_skips_nulls(spark):
    with_gap = history(spark, "m", [5, None, 7, 9, 11]).filter(F.col("period_start") != hour(2))
    last = with_baseline(with_gap, window=2).orderBy("period_start").collect()[-1]
    assert (last.baseline_median, last.history_count) == (9.0, 1)


def test_cold_start_gives_no_increase(spark):
    assert hours_of(detected(spark, history(spark, "sum_amount", [10, 10, 10, 10, 100]), INCREASE)) == []
    assert hours_of(detected(spark, history(spark, "sum_amount", [10, 10, 10, 10, 10, 100]), INCREASE)) == [5]


def test_thresholds_are_inclusive(spark):
    series = history(spark, "sum_amount", [10] * 5 + [15, 14.99, 5, 5.01])
    hits = {(r.anomaly_type, r.detected_value) for r in detected(spark, series, INCREASE, DECREASE).collect()}
    assert hits == {("sudden_increase", 15.0), ("sudden_decrease", 5.0)}


def test_zero_baseline(spark):
    assert hours_of(detected(spark, history(spark, "sum_amount", [0] * 5 + [7]), INCREASE)) == []
    assert hours_of(detected(spark, history(spark, "duplicate_count", [0] * 5 + [7]), DUPLICATES)) == [5]
    assert hours_of(detected(spark, history(spark, "null_ratio_note", [0] * 5 + [0.05]), NULLS)) == [5]


def test_spikes_on_a_cold_start_need_only_the_floor(spark):
    assert hours_of(detected(spark, history(spark, "null_ratio_note", [0.05]), NULLS)) == [0]
    assert hours_of(detected(spark, history(spark, "null_ratio_note", [0.04]), NULLS)) == []
    # With history and a baseline, the change counts.
    assert hours_of(detected(spark, history(spark, "duplicate_count", [4] * 5 + [7, 8]), DUPLICATES)) == [0, 1, 2, 3, 4, 6]


def test_missing_baseline_with_history_off_never_fires_on_null(spark):
    series = history(spark, "duplicate_count", [None] * 6 + [1])
    assert hours_of(detected(spark, series, DUPLICATES)) == [6]
    assert hours_of(detected(spark, history(spark, "sum_amount", [None] * 7), INCREASE, DECREASE)) == []


def test_zero_activity_compares_with_the_previous_period(spark):
    zero = rule("missing_zero_activity", metric="sum_amount", zero_activity_value=0)
    hits = detected(spark, history(spark, "sum_amount", [3, 0, 0, None, 0]), zero).orderBy("period_start").collect()
    assert [(r.detected_value, r.baseline_value) for r in hits] == [(0.0, 3.0), (0.0, 0.0), (0.0, None)]
    assert hits[0].column_name == "amount" and hits[0].threshold_used == "sum_amount == 0"


def test_zero_activity_after_consecutive_periods(spark):
    zero = rule("missing_zero_activity", metric="sum_amount", zero_activity_value=0, consecutive_periods_before_alert=3)
    assert hours_of(detected(spark, history(spark, "sum_amount", [0, 0, 1, 0, 0, 0, 0, 2, 0]), zero)) == [5, 6]


def test_zero_activity_value_may_differ(spark):
    zero = rule("missing_zero_activity", metric="row_count", zero_activity_value=7)
    (hit,) = detected(spark, history(spark, "row_count", [1, 7, 0]), zero).collect()
    assert hit.message == "No activity detected for period (row_count = 7)"


def epochs(spark, *hours):
    return history(spark, "last_updated_epoch", [1704067200 + 3600 * h for h in hours])


def test_staleness_is_strict_and_takes_maxima_apart(spark):
    # The newest ingestion sits in the first period, the newest period is the last.
    series = epochs(spark, 21, 3, 4)
    assert detected(spark, series, STALE, as_of=AS_OF).count() == 0
    (hit,) = detected(spark, series, STALE, as_of="2024-01-02 00:00:30").collect()
    assert (hit.period_start, hit.detected_value, hit.baseline_value) == (hour(2), 180.5, 180.0)
    assert hit.message == "Data is stale: last updated 180.5 minutes ago (limit 180 min)"


def test_disabled_and_unknown_rules_find_nothing(spark):
    series = history(spark, "sum_amount", [10] * 5 + [100])
    off = Rule(TABLE, "sudden_increase", "HIGH", False, {"metric": "sum_amount", "threshold_pct": 50.0})
    unknown = rule("schema_drift", metric="sum_amount", threshold_pct=1.0)
    assert detected(spark, series, off, unknown).count() == 0
    assert detected(spark, series).count() == 0


def test_tables_keep_their_own_rules_and_series(spark):
    series = history(spark, "sum_amount", [10] * 5 + [100]).unionByName(
        history(spark, "sum_amount", [10] * 5 + [100, 1], table="other")
    )
    rules = [INCREASE, Rule("other", "sudden_decrease", "LOW", True, {"metric": "sum_amount", "threshold_pct": -50})]
    columns = metric_columns(spark, [SPEC, SourceSpec("other", "at", numeric_metric_columns=("amount",))])
    hits = detect_metric_anomalies(series, rules_frame(spark, rules), columns, AS_OF, "run").collect()
    assert {(r.table_name, r.anomaly_type, r.severity, r.column_name) for r in hits} == {
        (TABLE, "sudden_increase", "HIGH", "amount"),
        ("other", "sudden_decrease", "LOW", "amount"),
    }
    assert {r.threshold_used for r in hits if r.table_name == "other"} == {
        "pct_change_vs_rolling_median <= -50% (trailing 24 periods, min history 5)"
    }


ROWS = "id int, at timestamp, amount double"


def rows(spark, *amounts):
    return spark.createDataFrame([(n, START, None if a is None else float(a)) for n, a in enumerate(amounts)], ROWS)


BOUNDS = rule("value_anomaly", metric="amount", use_fixed_threshold=True, fixed_lower_threshold=0, fixed_upper_threshold=10)
SCORES = rule("value_anomaly", metric="amount", use_fixed_threshold=False, zscore_threshold=1.5)


def test_fixed_bounds_are_strict_and_null_never_fires(spark):
    hits = detect_value_anomalies(rows(spark, 0, 10, 10.5, -1, None), SPEC, BOUNDS, AS_OF, "run").collect()
    assert sorted(r.detected_value for r in hits) == [-1.0, 10.5]
    assert {r.baseline_value for r in hits} == {None}


def test_equal_values_in_one_period_are_separate_anomalies(spark):
    hits = detect_value_anomalies(rows(spark, 99, 99), SPEC, BOUNDS, AS_OF, "run").collect()
    assert len(hits) == 2 and len({r.anomaly_id for r in hits}) == 2


def test_zscore_is_inclusive_and_constant_columns_are_silent(spark):
    assert detect_value_anomalies(rows(spark, 4, 4, 4), SPEC, SCORES, AS_OF, "run").count() == 0
    assert detect_value_anomalies(rows(spark, 4), SPEC, SCORES, AS_OF, "run").count() == 0
    (hit,) = detect_value_anomalies(rows(spark, 1, 1, 1, 1, 11), SPEC, SCORES, AS_OF, "run").collect()
    assert (hit.detected_value, hit.baseline_value, hit.threshold_used) == (11.0, 3.0, "|zscore| >= 1.5")


def test_ids_do_not_depend_on_the_run(spark):
    series = history(spark, "sum_amount", [10] * 5 + [100])
    first = [r.anomaly_id for r in detected(spark, series, INCREASE).collect()]
    again = [r.anomaly_id for r in detected(spark, series.repartition(3), INCREASE, as_of="2025-01-01").collect()]
    assert first == again


def test_missing_periods_fill_gaps(spark):
    counts = history(spark, "row_count", [4, 1, 1, 6]).filter(~F.col("period_start").isin(hour(1), hour(2)))
    got = missing_periods(counts, "hourly").orderBy("period_start").collect()
    assert [(r.period_start, r.detected_value, r.baseline_value) for r in got] == [(hour(1), 0.0, 4.0), (hour(2), 0.0, 4.0)]
    assert missing_periods(history(spark, "row_count", [1, 2, 3]), "hourly").count() == 0


def test_missing_periods_as_anomalies(spark):
    counts = history(spark, "row_count", [4, 1, 6]).filter(F.col("period_start") != hour(1))
    zero = rule("missing_zero_activity", metric="row_count", zero_activity_value=0)
    (hit,) = detect_missing_periods(counts, rules_frame(spark, [zero]), [SPEC], str(hour(3)), "run").collect()
    assert (hit.period_start, hit.severity, hit.column_name) == (hour(1), "HIGH", "amount")
    assert hit.message == "No activity detected for period (row_count = 0)"


def test_detect_joins_both_kinds(spark):
    series = history(spark, "sum_amount", [10] * 5 + [100])
    columns = ["anomaly_type", "detected_value"]
    hits = detect(series, [(rows(spark, 50), SPEC)], rules_frame(spark, [INCREASE]), {TABLE: BOUNDS}, AS_OF, "run")
    assert {tuple(r) for r in hits.select(*columns).collect()} == {("sudden_increase", 100.0), ("value_anomaly", 50.0)}


def test_metric_without_known_column_has_none(spark):
    trend = rule("sudden_increase", metric="null_ratio_note", threshold_pct=50.0)
    (hit,) = detected(spark, history(spark, "null_ratio_note", [1] * 5 + [2]), trend).collect()
    assert hit.column_name is None and hit.message.startswith("Sudden increase: null_ratio_note is 100.0% above")


@pytest.mark.parametrize("window", [1, 3, 40])
def test_rolling_median_matches_sorting(spark, window):
    values = [(7 * n * n) % 31 for n in range(60)]
    rows_ = with_baseline(history(spark, "m", values), window).orderBy("period_start").collect()
    for n, row in enumerate(rows_):
        trailing = sorted(values[max(0, n - window) : n])
        assert row.baseline_median == (trailing[(len(trailing) - 1) // 2] if trailing else None)


def test_wide_windows_are_kept_in_order(spark, monkeypatch):
    rng = random.Random(4)
    series = [("a", [None if rng.random() < 0.1 else float(rng.randrange(9)) for _ in range(300)]), ("b", [None, 1.0, None, 2.0] * 30), ("c", [1.0])]
    whole = reduce(DataFrame.unionByName, (history(spark, name, values) for name, values in series)).withColumn("metric_value_2", F.lit(1))
    columns = ["metric_name", "period_start", "previous_value", "baseline_median", "history_count", "pct_change", "metric_value_2"]
    plain = with_baseline(whole, 30)
    monkeypatch.setattr(baseline, "WIDE_WINDOW", 30)
    kept = with_baseline(whole, 30)
    assert kept.columns == plain.columns
    assert sorted(map(str, kept.select(*columns).collect())) == sorted(map(str, plain.select(*columns).collect()))


def test_value_rules_since_a_period(spark):
    late = rows(spark, 50).unionByName(rows(spark, 60).withColumn("at", F.lit(hour(3.5))))
    hits = detect_value_anomalies(late, SPEC, BOUNDS, AS_OF, "run", since=hour(3.75)).collect()
    assert [r.detected_value for r in hits] == [60.0]


def test_copies_without_ids_are_separate_anomalies(spark):
    bare = SourceSpec(TABLE, "at", numeric_metric_columns=("amount",))
    copies = spark.range(0, 4, 1, 2).select(F.lit(START).alias("at"), F.lit(99.0).alias("amount"))
    hits = detect_value_anomalies(copies, bare, BOUNDS, AS_OF, "run").collect()
    assert len(hits) == 4 and len({r.anomaly_id for r in hits}) == 4


def test_missing_periods_go_on_to_the_given_time(spark):
    counts = history(spark, "row_count", [3])
    got = [r.period_start for r in missing_periods(counts, "hourly", AS_OF).orderBy("period_start").collect()]
    assert got == [hour(n) for n in range(1, 24)]
    old = spark.createDataFrame([(TABLE, "row_count", datetime(1970, 1, 1), 1.0), (TABLE, "row_count", START, 2.0)], HISTORY)
    got = missing_periods(old, "hourly")
    assert (got.count(), got.distinct().count()) == ((START - datetime(1970, 1, 1)).days * 24 - 1,) * 2


def test_rows_without_event_time_are_no_history(spark):
    with_null = history(spark, "sum_amount", [10, 10, 10, 10, 90]).unionByName(
        spark.createDataFrame([(TABLE, "sum_amount", None, 5.0)], HISTORY)
    )
    assert detected(spark, with_null, INCREASE).count() == 0
    assert with_previous(with_null).filter("period_start IS NULL").count() == 0
    assert with_previous(with_null).orderBy("period_start").first().previous_value is None


def test_a_malformed_rule_stops_no_other(spark):
    bad = rule("sudden_decrease", metric="sum_amount", threshold_pct="fifty")
    hits = detected(spark, history(spark, "sum_amount", [10] * 6 + [90]), INCREASE, bad)
    assert [h.anomaly_type for h in hits.collect()] == ["sudden_increase"]
    problems = [r.problem for r in rule_violations(rules_frame(spark, [bad]), {"HIGH": ["email"]}).collect()]
    assert problems == ["threshold_pct is not a number"]


def test_runs_over_one_table_each_find_what_one_run_finds(spark):
    values = [10] * 6 + [90]
    both = history(spark, "sum_amount", values, "a").unionByName(history(spark, "sum_amount", values, "b"))
    tables = [replace(SPEC, table_name=name) for name in ("a", "b")]
    rules = rules_frame(spark, [replace(INCREASE, table_name=name) for name in ("a", "b")])
    empty = spark.createDataFrame([], BOUNDS_ROWS)
    ids = [{r.anomaly_id for r in detect(both, [(empty, t)], rules, {}, AS_OF, "run").collect()} for t in tables]
    whole = {r.anomaly_id for r in detect(both, [(empty, t) for t in tables], rules, {}, AS_OF, "run").collect()}
    assert len(whole) == 2 and ids[0] | ids[1] == whole and not ids[0] & ids[1]


def problems_of(spark, rules, **known):
    found = rule_violations(rules_frame(spark, rules), {"HIGH": ["email"]}, **known).collect()
    return sorted(r.problem for r in found)


def test_every_rule_that_cannot_work_is_listed(spark):
    known = {
        "columns": metric_columns(spark, [SPEC]),
        "fields": source_fields(spark, [(spark.createDataFrame([], BOUNDS_ROWS + ", sale struct<price: double>"), SPEC)]),
    }
    bounds = {"fixed_lower_threshold": 0, "fixed_upper_threshold": "10"}
    zero = {"metric": "sum_amount", "zero_activity_value": 0}
    cases = {
        "metric missing": rule("value_anomaly", **bounds),
        "fixed_lower_threshold missing": rule("value_anomaly", metric="amount", fixed_upper_threshold=1),
        "fixed_upper_threshold is not a number": rule("value_anomaly", metric="amount", fixed_lower_threshold=1, fixed_upper_threshold="x"),
        "zscore_threshold missing": rule("value_anomaly", metric="amount", use_fixed_threshold=False),
        "use_fixed_threshold is not true or false": rule("value_anomaly", metric="amount", use_fixed_threshold="maybe", **bounds),
        "unknown column": rule("value_anomaly", metric="nowhere", **bounds),
        "column is not a number": rule("value_anomaly", metric="note", **bounds),
        "unknown metric": rule("sudden_increase", metric="sum_amuont", threshold_pct=5),
        "consecutive_periods_before_alert is not a whole number from 1 on": rule(
            "missing_zero_activity", consecutive_periods_before_alert="three", **zero
        ),
        "expected_from is not a time": rule("missing_zero_activity", expected_from="soon", **zero),
        "unknown anomaly type": rule("schema_drift"),
    }
    for problem, bad in cases.items():
        assert problems_of(spark, [bad], **known) == [problem], problem
    for run in (0, -1, 1.5, "", "2x"):
        (found,) = problems_of(spark, [rule("missing_zero_activity", consecutive_periods_before_alert=run, **zero)], **known)
        assert found.startswith("consecutive")
    fine = [
        rule("value_anomaly", metric="Sale.Price", **bounds),
        rule("value_anomaly", metric="amount", **bounds),
        rule("value_anomaly", metric="amount", use_fixed_threshold=False, zscore_threshold=3),
        rule("sudden_increase", metric="null_ratio_note", threshold_pct=5),
        rule("missing_zero_activity", consecutive_periods_before_alert="2", expected_from="2024-01-01", **zero),
        replace(INCREASE, table_name="unwatched", params={"metric": "anything", "threshold_pct": 1}),
        replace(cases["unknown column"], enabled=False),
    ]
    assert problems_of(spark, fine, **known) == []
    twice = [*fine, fine[3], rule("sudden_increase", metric="null_ratio_note", threshold_pct=6)]
    assert problems_of(spark, twice, **known) == ["repeated rule"] * 2
    frame = rules_frame(spark, [*cases.values(), *fine, fine[0]])
    assert sound_rules(frame, *known.values()).count() == len(fine)
    assert rule_violations(rules_frame(spark, []), {}, **known).count() == 0


def test_bad_rules_stop_no_run(spark, tables):
    """All kinds of bad rules beside two good ones: a run logs what the good ones find."""
    bounds = {"fixed_lower_threshold": 0, "fixed_upper_threshold": 10}
    bad = [
        rule("value_anomaly", metric="amount"),
        rule("value_anomaly", metric="nowhere", **bounds),
        rule("sudden_decrease", metric="sum_nothing", threshold_pct=-1),
        rule("missing_zero_activity", metric="sum_amount", zero_activity_value=50, consecutive_periods_before_alert="three"),
    ]
    good = [rule("value_anomaly", metric="amount", **bounds), rule("missing_zero_activity", metric="row_count", zero_activity_value=1)]
    runs.set_up(tables, [*bad, *good])
    given = [(n, START, "k", "x", amount, START) for n, amount in enumerate((5, 50))]
    sources = [(spark.createDataFrame(given, BOUNDS_ROWS), SPEC)]
    runs.run_metrics(tables, sources, "r", AS_OF)
    found = runs.run_detection(tables, sources, "r", AS_OF).collect()
    assert [(r.anomaly_type, r.detected_value) for r in found] == [("value_anomaly", 50.0)]
    broken = spark.createDataFrame([(TABLE, "value_anomaly", True, "HIGH", "{not json")], RULES_SCHEMA)
    tables.append("anomaly_rules_config", broken)
    assert runs.run_detection(tables, sources, "r2", AS_OF).count() == 0  # all logged by then


def test_several_value_rules_are_judged_in_one_scan(spark, tmp_path):
    wide = rule("value_anomaly", metric="amount", fixed_lower_threshold=0, fixed_upper_threshold=100)
    narrow = Rule(TABLE, "value_anomaly", "LOW", True, {"metric": "amount", "fixed_lower_threshold": 10, "fixed_upper_threshold": 20})
    other = rule("value_anomaly", metric="id", fixed_lower_threshold=1, fixed_upper_threshold="2")
    rows(spark, 15, 30, 150, None).write.parquet(str(tmp_path / "t"))
    given = spark.read.parquet(str(tmp_path / "t"))
    hits = detect_value_anomalies(given, SPEC, [wide, narrow, other], AS_OF, "run")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PushedFilters: [Or(" in plan
    found = hits.collect()
    one_by_one = [r for x in (wide, narrow, other) for r in detect_value_anomalies(given, SPEC, x, AS_OF, "run").collect()]
    parts = ("column_name", "severity", "detected_value", "threshold_used", "message", "period_start")
    assert Counter(tuple(r[p] for p in parts) for r in found) == Counter(tuple(r[p] for p in parts) for r in one_by_one)
    assert len(found) == 5 and len({r.anomaly_id for r in found}) == 5
    scores = rule("value_anomaly", metric="amount", use_fixed_threshold=False, zscore_threshold="1.0")
    assert {r.threshold_used for r in detect_value_anomalies(given, SPEC, [scores, narrow], AS_OF, "run").collect()} == {
        "|zscore| >= 1.0", "outside [10, 20]"
    }


def test_data_that_never_arrived(spark):
    late, never = replace(SPEC, table_name="late"), replace(SPEC, table_name="never")
    zero = {"metric": "row_count", "zero_activity_value": 0, "expected_from": str(hour(1.5))}
    rules = rules_frame(spark, [Rule(t, "missing_zero_activity", "HIGH", True, zero) for t in (TABLE, "late", "never")])
    counts = history(spark, "row_count", [4, 1, 6]).filter(F.col("period_start") != hour(1))
    counts = counts.unionByName(history(spark, "row_count", [None] * 4 + [2.0], "late").filter(F.col("period_start") == hour(4)))
    hits = detect_missing_periods(counts, rules, [SPEC, late, never], str(hour(6.5)), "run").collect()
    found = {(r.table_name, (r.period_start - START).total_seconds() / 3600, r.baseline_value) for r in hits}
    # The period that was under way is not expected; a table's own earlier rows go on counting.
    assert found == {(TABLE, 1, 4.0), (TABLE, 3, 6.0), (TABLE, 4, 6.0), (TABLE, 5, 6.0)} | {
        ("late", 2, None), ("late", 3, None), ("late", 5, 2.0)
    } | {("never", n, None) for n in (2, 3, 4, 5)}
    assert len(hits) == len({r.anomaly_id for r in hits}) == 11
    nothing = detect_missing_periods(counts.limit(0), rules, [never], str(hour(3)), "run")
    assert [r.period_start for r in nothing.collect()] == [hour(2)]
