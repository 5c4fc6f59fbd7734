import random
from dataclasses import replace
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from helpers import BOUNDS_ROWS, SPEC, START, TABLE, hour
from pyspark.sql import functions as F

from metricwatch import Rule, SourceSpec
from metricwatch.operators import duplicates
from metricwatch.operators.detectors import detect_value_anomalies
from metricwatch.operators.metrics import (
    column_passes,
    compute_all,
    compute_metrics,
    duplicate_count,
    duplicate_history,
    period_metrics,
    unexpected_status,
)
from metricwatch.plans import runs
from metricwatch.sources import state

SCHEMA = "id int, at timestamp, key string, note string, amount int, loaded timestamp"


def frame(spark, rows):
    """Rows as (hour, key, note, amount), loaded ten minutes after the event."""
    made = []
    for number, (at, key, note, amount) in enumerate(rows):
        moment = None if at is None else hour(at)
        made.append((number, moment, key, note, amount, None if at is None else moment + timedelta(minutes=10)))
    return spark.createDataFrame(made, SCHEMA)


def values(df):
    return {(r.period_start, r.metric_name): r.metric_value for r in df.collect()}


def computed(spark, rows, **options):
    return values(compute_metrics(frame(spark, rows), SPEC, "run", START, **options))


def test_all_metrics_of_a_period(spark):
    rows = [(0, "a", "x", 1), (0.5, "b", None, 3), (1, "c", "y", None)]
    got = computed(spark, rows)
    first = {name: value for (at, name), value in got.items() if at == START}
    assert first == {
        "row_count": 2.0,
        "sum_amount": 4.0,
        "avg_amount": 2.0,
        "stddev_amount": pytest.approx(2**0.5),
        "min_amount": 1.0,
        "max_amount": 3.0,
        "null_ratio_note": 0.5,
        "last_updated_epoch": 1704067200.0 + 1800 + 600,
    }
    # A period without values keeps its rows, and so does a single value's deviation.
    assert got[hour(1), "sum_amount"] is None and got[hour(1), "avg_amount"] is None
    assert got[hour(1), "stddev_amount"] is None
    assert got[hour(1), "duplicate_count"] == 0.0
    assert len(got) == 17


def test_blank_is_null(spark):
    got = computed(spark, [(0, "a", None, 1), (0, "b", "", 1), (0, "c", "  ", 1), (0, "d", "x", 1)])
    assert got[START, "null_ratio_note"] == 0.75


def test_numbers_are_never_blank(spark):
    spec = replace(SPEC, monitored_null_columns=("amount",))
    wide = period_metrics(frame(spark, [(0, "a", "", 0), (0, "b", "", None)]), spec)
    assert wide.first()["null_ratio_amount"] == 0.5


def test_duplicates_cross_periods_and_null_keys_group(spark):
    rows = [(0, "a", "", 1), (5, "a", "", 1), (2, None, "", 1), (3, None, "", 1), (9, None, "", 1)]
    assert values(duplicate_count(frame(spark, rows), SPEC)) == {(hour(9), "duplicate_count"): 3.0}


def test_duplicate_history_is_the_count_of_each_prefix(spark):
    rows = [(n, key, "", 1) for n, key in enumerate("abacabadabac")] + [(11.5, None, "", 1), (13, None, "", 1)]
    history = values(duplicate_history(frame(spark, rows), SPEC))
    assert len(history) == 13
    for at, _ in history:
        prefix = [row for row in rows if hour(row[0]) < at + timedelta(hours=1)]
        expected = len(prefix) - len({row[1] for row in prefix})
        assert history[at, "duplicate_count"] == expected


def test_empty_source_has_no_metrics(spark):
    assert computed(spark, []) == {}


def test_rows_without_event_time_form_the_null_period(spark):
    got = computed(spark, [(0, "a", "", 1), (None, "a", "", 5)])
    assert got[None, "sum_amount"] == 5.0 and got[START, "sum_amount"] == 1.0
    assert got[START, "duplicate_count"] == 1.0


@pytest.mark.parametrize(("grain", "start"), [("minute", hour(25.5)), ("hourly", hour(25)), ("daily", hour(24))])
def test_grains(spark, grain, start):
    wide = period_metrics(frame(spark, [(25.505, "a", "", 1)]), replace(SPEC, grain=grain))
    assert wide.first()["period_start"] == start


def test_unknown_grain_is_rejected():
    with pytest.raises(ValueError, match="weekly"):
        SourceSpec("t", "at", grain="weekly")


def test_since_never_cuts_a_period(spark):
    rows = [(0, "a", "", 1), (5, "b", "", 2), (5.75, "c", "", 4), (6, "a", "", 8)]
    got = computed(spark, rows, since=hour(5.5))
    assert got[hour(5), "sum_amount"] == 6.0 and got[hour(6), "sum_amount"] == 8.0
    assert (START, "sum_amount") not in got
    # The duplicate count still covers the older rows.
    assert got[hour(6), "duplicate_count"] == 1.0


def test_only_named_metrics(spark):
    rows = [(0, "a", "", 1)]
    assert set(computed(spark, rows, only=["sum_amount"])) == {(START, "sum_amount")}
    assert set(computed(spark, rows, only=["duplicate_count"])) == {(START, "duplicate_count")}


def test_many_tables_in_one_plan(spark):
    other = SourceSpec("other", "at", numeric_metric_columns=("amount",))
    both = compute_all([(frame(spark, [(0, "a", "", 1)]), SPEC), (frame(spark, [(1, "a", "", 7)]), other)], "r", START)
    sums = both.filter("metric_name = 'sum_amount'").collect()
    assert {(r.table_name, r.period_start, r.metric_value) for r in sums} == {(TABLE, START, 1.0), ("other", hour(1), 7.0)}
    assert both.filter("table_name = 'other'").count() == 6


def test_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(START, 2, None)], "`event time` timestamp, `a.b` int, `c d` string")
    spec = SourceSpec(
        "odd",
        "event time",
        duplicate_key_columns=("c d",),
        monitored_null_columns=("c d",),
        numeric_metric_columns=("a.b",),
    )
    got = values(compute_metrics(df, spec, "run", START))
    assert got[START, "sum_a.b"] == 2.0 and got[START, "null_ratio_c d"] == 1.0 and got[START, "duplicate_count"] == 0.0


def test_nested_fields_are_named_by_path(spark):
    schema = "sale struct<at: timestamp, amount: int, key: string, note: string>"
    df = spark.createDataFrame([((START, 7, "a", " "),), ((START, 9, "a", "x"),)], schema)
    spec = SourceSpec(
        "t",
        "sale.at",
        duplicate_key_columns=("sale.key",),
        monitored_null_columns=("sale.note",),
        numeric_metric_columns=("sale.amount",),
    )
    got = values(compute_metrics(df, spec, "run", START, since=START))
    assert got[START, "sum_sale.amount"] == 16.0 and got[START, "null_ratio_sale.note"] == 0.5
    assert got[START, "duplicate_count"] == 1.0
    rule = Rule("t", "value_anomaly", "LOW", True, {"metric": "sale.amount", "fixed_lower_threshold": 0, "fixed_upper_threshold": 8})
    (hit,) = detect_value_anomalies(df, spec, rule, START, "run").collect()
    assert (hit.metric_name, hit.detected_value, hit.period_start) == ("sale.amount", 9.0, START)


def test_names_may_differ_in_case(spark):
    df = frame(spark, [(0, "a", " ", 4)]).withColumnRenamed("amount", "Amount").withColumnRenamed("note", "NOTE")
    got = values(compute_metrics(df.withColumnRenamed("at", "At"), SPEC, "run", START, since=START))
    assert got[START, "sum_amount"] == 4.0 and got[START, "null_ratio_note"] == 1.0


def test_unexpected_status_counts_missing_ones(spark):
    df = spark.createDataFrame([(START, s) for s in ("OK", "BAD", "BAD", None)], "at timestamp, status string")
    spec = SourceSpec("t", "at", status_column="status", expected_status_values=("OK",))
    assert {(r.status, r.unexpected_rows) for r in unexpected_status(df, spec).collect()} == {("BAD", 2), (None, 1)}


def test_config_sections_give_a_spec():
    config = {
        "unity_catalog": {"catalog": "c", "source_table_full_name": "{catalog}.s.t"},
        "source_data": {"timestamp_column": "at", "numeric_metric_columns": ["x"], "id_columns": ["id"]},
        "metrics_engine": {"grain": "daily"},
    }
    assert SourceSpec.from_config(config) == SourceSpec(
        "c.s.t", "at", "daily", numeric_metric_columns=("x",), id_columns=("id",)
    )


def test_epoch_does_not_depend_on_zone_free_types(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5), datetime(2024, 1, 1, 6))], "at timestamp_ntz, loaded timestamp_ntz")
    spec = SourceSpec("t", "at", ingestion_timestamp_column="loaded")
    assert period_metrics(df, spec).first()["last_updated_epoch"] == 1704088800.0


def test_wide_tables_are_read_in_passes(spark):
    names = [f"n{i}" for i in range(30)]
    row = [START, *range(30)]
    df = spark.createDataFrame([tuple(row)], "at timestamp, " + ", ".join(f"{n} int" for n in names))
    spec = SourceSpec("w", "at", ingestion_timestamp_column="at", numeric_metric_columns=tuple(names), monitored_null_columns=("n3",))
    got = values(compute_metrics(df, spec, "run", START))
    assert len(got) == 1 + 30 * 5 + 1 + 1
    assert all(got[START, f"sum_n{i}"] == i for i in range(30))
    assert len(column_passes(spec)) == 3 and len(column_passes(SPEC)) == 1
    assert [p.numeric_metric_columns for p in column_passes(SourceSpec("t", "at"))] == [()]
    many = SourceSpec("t", "at", numeric_metric_columns=tuple(names), monitored_null_columns=tuple(map(str, range(100))))
    passes = column_passes(many)
    assert [(len(p.numeric_metric_columns), len(p.monitored_null_columns)) for p in passes] == [(11, 0), (11, 0), (8, 28), (0, 72)]
    assert sum((p.monitored_null_columns for p in passes), ()) == many.monitored_null_columns


def dup_rows(spark, *keyed):
    rows = [(n, None if at is None else hour(at), key, "x", 1, None) for n, (at, key) in enumerate(keyed)]
    return spark.createDataFrame(rows, BOUNDS_ROWS)


def counted(tables, df, since):
    """The duplicate count and its period as a run keeps them."""
    (found,) = runs.duplicate_counts(tables, [(df, SPEC)], since).values()
    return [(r.period_start, r.metric_value) for r in found.collect()]


def full_count(df):
    return [(r.period_start, r.metric_value) for r in duplicate_count(df, SPEC).collect()]


def test_kept_duplicate_counts_are_those_of_the_whole_table(spark, tables):
    rng = random.Random(3)
    given = sorted((rng.uniform(0, 20), rng.choice(["a", "b", None, *map(str, range(30))])) for _ in range(300))
    given += [(None, "a"), (None, "never dated"), (None, "never dated")]
    for until, since in ((5, 3), (9, 5), (9, 5), (12, 12.5), (20, 11), (20, 19.5), (20, 20)):
        rows = dup_rows(spark, *((at, key) for at, key in given if at is None or at <= until))
        # A cut that lies before the kept one starts over with the older rows.
        assert counted(tables, rows, hour(since)) == full_count(rows), (until, since)


def test_kept_duplicate_counts_do_not_read_old_rows(spark, tables, tmp_path):
    old, new = [(n / 10, str(n % 7)) for n in range(60)], [(6 + n / 10, str(n % 9)) for n in range(20)]
    assert counted(tables, dup_rows(spark, *old), hour(6)) == full_count(dup_rows(spark, *old))
    # Only the new rows are there, and the count is that of both.
    assert counted(tables, dup_rows(spark, *new), hour(6)) == full_count(dup_rows(spark, *old, *new))
    dup_rows(spark, *old, *new).write.parquet(str(tmp_path / "t"))
    rows = duplicates.rows_between(spark.read.parquet(str(tmp_path / "t")), SPEC, F.lit(hour(6)), None)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(" in plan and "GreaterThanOrEqual(at" in plan


def test_a_run_that_was_cut_short_does_no_harm(spark, tables, monkeypatch):
    rows = dup_rows(spark, (1, "a"), (2, "a"), (3, "b"), (4, "b"), (5, "c"), (6, "a"))
    counted(tables, rows, hour(2))
    append = tables.append
    monkeypatch.setattr(tables, "append", lambda t, df: append(t, df) if t == state.SEEN_KEYS else (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        counted(tables, rows, hour(5))
    monkeypatch.undo()
    for since in (2, 4, 5, 6):
        assert counted(tables, rows, hour(since)) == full_count(rows)
    assert runs.duplicate_counts(tables, [(rows, SPEC)], None) == {}
    assert tables.read(state.SEEN_KEYS).count() == 0 and tables.read(state.KEY_TOTALS).count() == 0
    assert counted(tables, rows.limit(0), hour(2)) == []


def test_keys_with_nulls_are_told_apart(spark):
    spec = replace(SPEC, duplicate_key_columns=("key", "note"))
    rows = spark.createDataFrame([(1, START, a, b, 1, None) for a, b in ((None, "x"), ("x", None), (None, None), (None, None), ("", "x"))], BOUNDS_ROWS)
    assert duplicates.per_key(rows, spec).count() == 4


def test_batches_add_up_to_the_metrics_of_all_rows(spark, tables):
    rng = random.Random(8)
    schema = "at timestamp, exact decimal(18,2), number double, whole bigint, note string, loaded timestamp"
    spec = SourceSpec(
        TABLE, "at", ingestion_timestamp_column="loaded", monitored_null_columns=("note",), numeric_metric_columns=("exact", "number", "whole")
    )

    def row():
        at = rng.choice([None, *(hour(n / 4) for n in range(20))])
        cents = None if rng.random() < 0.2 else Decimal(rng.randrange(-(10**9), 10**9)) / 100
        return at, cents, rng.choice([None, rng.gauss(1e6, 1)]), rng.choice([None, 2**52 + 1, -3]), rng.choice([None, " ", "x"]), rng.choice([None, at])

    batches = [[row() for _ in range(size)] for size in (60, 1, 25, 40)] + [[(hour(9), None, None, None, "x", None)]]
    every = []
    for number, batch in enumerate(batches):
        every += batch
        given = [(spark.createDataFrame(batch, schema), spec)]
        changed = runs.run_batch(tables, given, f"b{number}", "r", START)
        if number == 2:
            assert runs.run_batch(tables, given, f"b{number}", "r", START) == changed
        wanted = values(compute_metrics(spark.createDataFrame(every, schema), spec, "r", START))
        found = values(tables.read(state.METRICS))
        assert found.keys() == wanted.keys()
        for key, value in wanted.items():
            exact = key[1].startswith(("sum_exact", "sum_whole", "avg_exact", "row", "min", "max", "null", "last"))
            assert found[key] == (value if exact or value is None else pytest.approx(value, rel=1e-9, abs=1e-9)), key
    assert runs.run_batch(tables, [(spark.createDataFrame([], schema), spec)], "none", "r", START) == 0


def test_a_batch_reads_and_writes_only_its_months(spark, tables):
    months = [datetime(2024, n, 3) for n in (1, 2, 3)]

    def batch(name, *times):
        rows = spark.createDataFrame([(1, at, "a", "x", 1, None) for at in times], BOUNDS_ROWS)
        return runs.run_batch(tables, [(rows, SPEC)], name, name, START)

    batch("first", *months)
    before = set(spark.table(tables.name(state.METRICS)).inputFiles())
    batch("late", months[1])
    kept = before & set(spark.table(tables.name(state.METRICS)).inputFiles())
    assert len({path.split("period_month=")[1][:7] for path in kept}) == 2 and not any("2024-02" in path for path in kept)
    counts = {(r.period_start, r.run_id): r.metric_value for r in tables.read(state.METRICS).filter("metric_name = 'row_count'").collect()}
    assert counts == {(months[0], "first"): 1.0, (months[1], "late"): 2.0, (months[2], "first"): 1.0}
