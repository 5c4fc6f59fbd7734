from concurrent.futures import ThreadPoolExecutor
from datetime import datetime

import pytest
from helpers import AS_OF, BOUNDS_ROWS, SPEC, START, TABLE, hour
from pyspark.sql import Row
from pyspark.sql import functions as F

from metricwatch import AlertSettings, Rule
from metricwatch.operators.anomaly_log import alert_totals, anomalies_ordered, anomaly_summary, new_anomalies, pending_anomalies
from metricwatch.operators.upsert import upsert
from metricwatch.plans import runs
from metricwatch.sources import state
from metricwatch.sources.tables import ensure_schema, read_csv, read_table, table_exists

KEYED = "k int, v string, w int"
OUTCOME = "alert_id string, status string, error_message string"
AS_OF_DAY = "2024-01-31 12:00:00"


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_upsert_updates_inserts_and_keeps(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], KEYED)
    source = spark.createDataFrame([(2, "B", 99), (3, "C", 30), (None, "N", 5)], KEYED)
    once = upsert(target, source, ["k"], ["v"])
    assert as_set(once) == {(1, "a", 10), (2, "B", 20), (3, "C", 30), (None, "N", 0)}
    assert as_set(upsert(once, source, ["k"], ["v"])) == as_set(once)


def test_upsert_takes_null_values(spark):
    target = spark.createDataFrame([(1, "a", 10)], KEYED)
    source = spark.createDataFrame([(1, None, 11)], KEYED)
    assert as_set(upsert(target, source, ["k"])) == {(1, None, 11)}


def test_upsert_update_only(spark):
    target = spark.createDataFrame([(1, "a", 10), (1, "a2", 11), (2, "b", 20)], KEYED)
    source = spark.createDataFrame([(1, "A"), (7, "x")], "k int, v string")
    assert as_set(upsert(target, source, ["k"], ["v"], insert=False)) == {(1, "A", 10), (1, "A", 11), (2, "b", 20)}
    with pytest.raises(ValueError, match="w"):
        upsert(target, source, ["k"], ["v"])


def test_upsert_rejects_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a", 10)], KEYED)
    source = spark.createDataFrame([(5, "x", 1), (5, "y", 2)], KEYED)
    with pytest.raises(Exception, match="more than one source row for key"):
        upsert(target, source, ["k"]).collect()


LOG = "anomaly_id string, table_name string, column_name string, anomaly_type string, period_start timestamp"


def test_new_anomalies_match_null_keys(spark):
    hits = spark.createDataFrame(
        [
            ("1", "t", None, "a", START),
            ("2", "t", "c", "a", None),
            ("3", "t", "c", "a", START),
            ("4", "t", "c", "a", START),
            ("5", "t", "c", "b", START),
        ],
        LOG,
    )
    logged = hits.filter("anomaly_id in (1, 2)").withColumn("anomaly_id", F.lit("old"))
    # Hits alike in all keys stay together; only the log removes.
    assert {r.anomaly_id for r in new_anomalies(hits, logged).collect()} == {"3", "4", "5"}
    later = logged.unionByName(hits.filter("anomaly_id = 3"))
    assert {r.anomaly_id for r in new_anomalies(hits, later).collect()} == {"5"}
    assert new_anomalies(hits, hits.limit(0)).count() == 5


def test_log_counts_and_order(spark):
    rows = [("1", "LOW", "a", True), ("2", "CRITICAL", "a", False), ("3", "odd", "b", False), ("4", "HIGH", "b", False)]
    log = spark.createDataFrame(rows, "anomaly_id string, severity string, anomaly_type string, alerted boolean")
    log = log.withColumns({"detected_at": F.lit(START), "period_start": F.lit(START)})
    assert [r.anomaly_id for r in anomalies_ordered(log).collect()] == ["2", "4", "1", "3"]
    assert as_set(alert_totals(log)) == {(4, 1)}
    assert ("b", "odd", 1) in as_set(anomaly_summary(log))
    assert pending_anomalies(log).count() == 3 and pending_anomalies(log, dedupe=False).count() == 4


def test_append_brings_new_columns(spark, tables):
    tables.create("t", spark.createDataFrame([], "a int").schema)
    assert tables.append("t", spark.createDataFrame([(1,)], "a int")) == 1
    assert tables.append("t", spark.createDataFrame([(2, "x")], "a int, b string")) == 1
    assert as_set(tables.read("t").select("a", "b")) == {(1, None), (2, "x")}
    assert tables.compact("t") == 2 and tables.read("t").count() == 2


def test_overwrite_may_read_itself(spark, tables):
    tables.overwrite("t", spark.range(5))
    assert tables.overwrite("t", tables.read("t").filter("id > 2")) == 2
    assert as_set(tables.read("t")) == {(3,), (4,)}
    assert spark.catalog.tableExists(tables.name("t")) and len(spark.catalog.listTables(tables.schema)) == 1


def test_a_failed_write_leaves_the_table_as_it_was(spark, tables):
    tables.overwrite("t", spark.range(3))
    broken = spark.range(3).withColumn("id", F.when(F.col("id") == 2, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite("t", broken)
    with pytest.raises(Exception, match="lost"):
        tables.append("t", broken)
    assert tables.read("t").count() == 3
    assert tables.append("t", spark.range(2)) == 2 and tables.read("t").count() == 5
    assert tables.overwrite("t", spark.range(4)) == 4 and tables.read("t").count() == 4


def metric_rows(spark, run_id, *rows):
    names = "table_name string, period_start timestamp, metric_name string, metric_value double"
    made = spark.createDataFrame([(name, at, "row_count", float(value)) for name, at, value in rows], names)
    return made.withColumns({"run_id": F.lit(run_id), "computed_at": F.lit(START)})


def files(tables, table):
    return set(tables.spark.table(tables.name(table)).inputFiles())


def test_an_upsert_leaves_other_partitions_alone(spark, tables):
    later = datetime(2024, 2, 5)
    tables.create_all()
    first = metric_rows(spark, "r1", ("a", START, 1), ("a", later, 2), ("b", START, 3), ("b", None, 4))
    assert tables.upsert(state.METRICS, first, runs.METRIC_KEYS, runs.METRIC_UPDATES) == 4
    before = files(tables, state.METRICS)
    second = metric_rows(spark, "r2", ("a", later, 20), ("b", None, 40), ("c", later, 50))
    assert tables.upsert(state.METRICS, second, runs.METRIC_KEYS, runs.METRIC_UPDATES) == 3
    got = as_set(tables.read(state.METRICS).select("table_name", "period_start", "metric_value", "run_id"))
    assert got == {
        ("a", START, 1.0, "r1"), ("a", later, 20.0, "r2"), ("b", START, 3.0, "r1"), ("b", None, 40.0, "r2"), ("c", later, 50.0, "r2")
    }
    kept = before & files(tables, state.METRICS)
    assert len(kept) == 2 and all("period_month=2024-01" in path for path in kept)


def anomaly_rows(spark, *rows):
    empty = spark.createDataFrame([], state.SCHEMAS[state.ANOMALIES])
    given = spark.createDataFrame(rows, "anomaly_id string, detected_at timestamp").withColumn("alerted", F.lit(False))
    return empty.unionByName(given, allowMissingColumns=True)


def test_marking_alerts_leaves_other_days_alone(spark, tables):
    from metricwatch.operators.alerts import alerted_flags

    tables.create_all()
    tables.append(state.ANOMALIES, anomaly_rows(spark, ("1", START), ("2", START), ("3", datetime(2024, 1, 2))))
    before = files(tables, state.ANOMALIES)
    log = spark.createDataFrame([("1", "SENT"), ("1", "FAILED"), ("3", "FAILED")], "anomaly_id string, status string")
    assert tables.upsert(state.ANOMALIES, alerted_flags(log), ["anomaly_id"], ["alerted"], insert=False) == 1
    assert as_set(tables.read(state.ANOMALIES).select("anomaly_id", "alerted")) == {("1", True), ("2", False), ("3", False)}
    assert any("detected_date=2024-01-02" in path for path in before & files(tables, state.ANOMALIES))


def test_an_empty_run_writes_nothing(spark, tables):
    tables.create_all()
    tables.append(state.ANOMALIES, anomaly_rows(spark, ("1", START)))
    for table in state.HISTORY_TABLES:
        before = files(tables, table)
        assert tables.append(table, tables.read(table).limit(0)) == 0
        assert files(tables, table) == before


def test_an_upsert_cannot_move_rows(spark, tables):
    tables.create_all()
    with pytest.raises(ValueError, match="other partitions"):
        tables.upsert(state.ANOMALIES, anomaly_rows(spark, ("1", START)), ["anomaly_id"], ["detected_at"], insert=False)


def test_create_leaves_existing_tables_alone(spark, tables):
    assert not tables.exists(state.METRICS)
    tables.create_all()
    assert all(tables.read(name).columns == schema.names for name, schema in state.SCHEMAS.items())
    tables.append(state.RULES, spark.createDataFrame([("t", "a", True, "LOW", "{}")], state.SCHEMAS[state.RULES]))
    tables.create_all()
    assert tables.read(state.RULES).count() == 1


def test_late_rows_change_history_but_not_the_log(spark, tables):
    bounds = {"metric": "amount", "fixed_lower_threshold": 0, "fixed_upper_threshold": 10}
    runs.set_up(tables, [Rule(TABLE, "value_anomaly", "CRITICAL", True, bounds)])

    def run(rows, name):
        sources = [(spark.createDataFrame(rows, BOUNDS_ROWS), SPEC)]
        runs.run_metrics(tables, sources, name, AS_OF)
        return runs.run_detection(tables, sources, name, AS_OF)

    early = [(1, hour(0), "a", "x", 50, hour(0)), (2, hour(1), "b", "x", 60, hour(1))]
    assert {r.detected_value for r in run(early, "r1").collect()} == {50.0, 60.0}
    # Hour 0 gains a row over the bound, hour 1 disappears, hour 2 is new.
    late = [early[0], (3, hour(0), "c", "x", 70, hour(0)), (4, hour(2), "d", "x", 80, hour(2))]
    assert {r.detected_value for r in run(late, "r2").collect()} == {80.0}
    sums = tables.read(state.METRICS).filter("metric_name = 'sum_amount'").select("period_start", "metric_value", "run_id")
    assert as_set(sums) == {(hour(0), 120.0, "r2"), (hour(1), 60.0, "r1"), (hour(2), 80.0, "r2")}


def test_value_rules_come_from_the_rules_table(spark, tables):
    from metricwatch.operators.rules import value_rules

    params = {"metric": "amount", "fixed_lower_threshold": 0, "fixed_upper_threshold": 10}
    rules = [
        Rule(TABLE, "value_anomaly", "LOW", True, params),
        Rule("off", "value_anomaly", "LOW", False, params),
        Rule(TABLE, "stale_data", "LOW", True, {}),
    ]
    runs.set_up(tables, rules)
    assert value_rules(tables.read(state.RULES), [TABLE, "off"]) == {TABLE: [rules[0]]}


def test_csv_with_header(spark, tmp_path):
    (tmp_path / "in.csv").write_text('id,at,note\n1,2024-01-01 05:00:00,"a, b"\n2,2024-01-01 06:00:00,\n')
    schema = "id int, at timestamp, note string"
    got = read_csv(spark, str(tmp_path / "in.csv"), schema)
    assert as_set(got) == {(1, datetime(2024, 1, 1, 5), "a, b"), (2, datetime(2024, 1, 1, 6), None)}
    (tmp_path / "bad.csv").write_text("id,at,note\nx,2024-01-01 05:00:00,a\n")
    with pytest.raises(Exception, match="MALFORMED|FAILED"):
        read_csv(spark, str(tmp_path / "bad.csv"), schema).collect()


def test_catalog_tables(spark, tmp_path):
    ensure_schema(spark, "watched", str(tmp_path / "watched"))
    ensure_schema(spark, "watched")
    assert not table_exists(spark, "watched.sales")
    spark.range(3).write.mode("overwrite").saveAsTable("watched.sales")
    assert table_exists(spark, "watched.sales")
    assert read_table(spark, "watched.sales").count() == 3
    spark.sql("DROP TABLE watched.sales")


def test_reading_a_missing_table_says_so(tables):
    with pytest.raises(ValueError, match="'alert_log' does not exist"):
        tables.read(state.ALERTS)


def test_repeated_rules_are_rejected(tables):
    with pytest.raises(ValueError, match="more than one rule"):
        runs.set_up(tables, [Rule(TABLE, "stale_data", "LOW"), Rule(TABLE, "stale_data", "HIGH")])


def test_sparse_rows_are_written_as_few_files(spark, tables, tmp_path):
    sparse = spark.range(0, 100_000, 1, 64).filter("id % 1000 = 0")
    assert tables.overwrite("t", sparse) == 100
    assert len(list(tmp_path.glob("state/t/*/*.parquet"))) <= 2


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_an_upsert_reads_only_the_partitions_of_its_rows(spark, tables, monkeypatch):
    later, plans = datetime(2024, 2, 5), []
    tables.create_all()
    first = metric_rows(spark, "r1", ("a", START, 1), ("a", later, 2), ("b", START, 3), ("c", START, 4))
    tables.upsert(state.METRICS, first, runs.METRIC_KEYS, runs.METRIC_UPDATES)
    save = tables._save
    monkeypatch.setattr(tables, "_save", lambda table, df: (plans.append((plan_of(df), df.inputFiles())), save(table, df))[1])
    second = metric_rows(spark, "r2", ("a", later, 20), ("c", later, 50))
    assert tables.upsert(state.METRICS, second, runs.METRIC_KEYS, runs.METRIC_UPDATES) == 2
    (plan, read), = plans
    assert "PartitionFilters: [" in plan and "period_month" in plan and "2024-02" in plan and "_key," not in plan
    of_table = [path for path in read if "metrics_baseline" in path]
    assert len(of_table) == 1 and "table_name=a/period_month=2024-02" in of_table[0]


def test_many_partitions_are_still_pruned():
    rows = [Row(table_name=f"t{i}", period_month="2024-01") for i in range(3)]
    few = str(state._within(rows, ["table_name", "period_month"]))
    assert few.count("2024-01") == 3
    many = [Row(table_name=f"t{i}", period_month=f"{i % 7}") for i in range(state.NAMED_PARTITIONS + 1)]
    assert str(state._within(many, ["table_name", "period_month"])).count(" OR ") == 0


def test_failed_writes_leave_nothing_in_the_way(spark, tables, tmp_path):
    """Tasks that go on after the job has failed, and folders that an earlier failure left, block no later write."""
    tables.create_all()
    tables.overwrite("t", spark.range(3))

    @F.udf("long")
    def late(i):
        import time

        if i == 0:
            raise ValueError("lost")
        time.sleep(0.05)
        return i

    broken = spark.range(0, 40, 1, 8).select(late("id").alias("id"))
    wrong = broken.select(
        F.lit("r").alias("run_id"), F.lit("a").alias("table_name"), F.lit(START).alias("period_start"), F.lit("m").alias("metric_name"),
        F.col("id").cast("double").alias("metric_value"), F.lit(START).alias("computed_at"),
    )
    for n in range(20):
        with pytest.raises(Exception, match="lost"):
            tables.overwrite("t", broken)
        (tmp_path / "state" / "t__staged").mkdir(exist_ok=True)
        assert tables.overwrite("t", spark.range(n)) == n and tables.read("t").count() == n
        if n % 5 == 0:
            with pytest.raises(Exception, match="lost"):
                tables.upsert(state.METRICS, wrong, runs.METRIC_KEYS, runs.METRIC_UPDATES)
            assert tables.upsert(state.METRICS, metric_rows(spark, "r", ("a", START, n)), runs.METRIC_KEYS, runs.METRIC_UPDATES) == 1
            assert tables.read(state.METRICS).first().metric_value == n


def test_two_writers_do_not_collide(spark, tables):
    """Upserts into one partition at the same time: the later one is worked out anew over what the first wrote."""
    tables.create_all()
    key, updates = runs.METRIC_KEYS, runs.METRIC_UPDATES
    tables.upsert(state.METRICS, metric_rows(spark, "r0", ("a", START, 1)), key, updates)
    save, others = tables._save, []

    def slow(table, df):
        saved = save(table, df)
        if not others:
            others.append(state.StateTables(spark, tables.schema))
            others[0].upsert(state.METRICS, metric_rows(spark, "r1", ("a", hour(1), 2)), key, updates)
            others[0].append(state.METRICS, metric_rows(spark, "r1", ("a", hour(2), 3)))
        return saved

    tables._save = slow
    assert tables.upsert(state.METRICS, metric_rows(spark, "r2", ("a", hour(3), 4), ("a", START, 9)), key, updates) == 2
    assert {(r.period_start, r.metric_value) for r in tables.read(state.METRICS).collect()} == {
        (START, 9.0), (hour(1), 2.0), (hour(2), 3.0), (hour(3), 4.0)
    }
    with ThreadPoolExecutor(2) as pool:
        done = [pool.submit(state.StateTables(spark, tables.schema).overwrite, "t", spark.range(n)) for n in (5, 7)]
        assert [d.result() for d in done] == [5, 7]
    assert tables.read("t").count() in (5, 7)


def test_odd_names_of_partitions(spark, tables):
    tables.create_all()
    names = ["a.b", "x/y", "50 %", "é:=?", "it's", "back\\slash", "[z]{^}#*"]
    for value in (1, 2):
        rows = metric_rows(spark, f"r{value}", *((name, START, value) for name in names))
        assert tables.upsert(state.METRICS, rows, runs.METRIC_KEYS, runs.METRIC_UPDATES) == len(names)
        assert as_set(tables.read(state.METRICS).select("table_name", "metric_value")) == {(name, float(value)) for name in names}
    assert tables.overwrite(state.METRICS, tables.read(state.METRICS).filter("table_name like '%b%'")) == 2
    assert {r.table_name for r in tables.read(state.METRICS).collect()} == {"a.b", "back\\slash"}
    tables.reset(state.RESET_WORD)
    assert tables.read(state.METRICS).count() == 0
    tables.append(state.METRICS, metric_rows(spark, "r", ("x/y", START, 5)))
    assert tables.read(state.METRICS).count() == 1


def test_a_frame_read_earlier_still_finds_its_files_until_they_are_removed(spark, tables):
    tables.create_all()
    tables.upsert(state.METRICS, metric_rows(spark, "r1", ("a", START, 1)), runs.METRIC_KEYS, runs.METRIC_UPDATES)
    before = spark.read.parquet(*tables.spark.table(tables.name(state.METRICS)).inputFiles())
    tables.upsert(state.METRICS, metric_rows(spark, "r2", ("a", START, 2)), runs.METRIC_KEYS, runs.METRIC_UPDATES)
    assert before.first().metric_value == 1.0
    assert tables.vacuum(state.METRICS) == 0
    assert tables.vacuum(state.METRICS, older_than_hours=-1) > 0
    assert tables.read(state.METRICS).first().metric_value == 2.0


def outbox_rows(spark, run_id, *anomalies):
    rows = [(f"{run_id}-{a}", run_id, a, "slack", "PENDING", None, False, "s", "b") for a in anomalies]
    return spark.createDataFrame(rows, state.SCHEMAS[state.OUTBOX])


def outcome_rows(spark, run_id, *anomalies, status="SENT"):
    return spark.createDataFrame([(f"{run_id}-{a}", status, None) for a in anomalies], OUTCOME)


def test_outcomes_are_marked_without_touching_the_log(spark, tables):
    tables.create_all()
    tables.append(state.ANOMALIES, anomaly_rows(spark, ("1", START), ("2", START), ("3", datetime(2024, 1, 2)), ("4", START)))
    for run in ("old", "new"):
        tables.append(state.OUTBOX, outbox_rows(spark, run, "1", "2") if run == "old" else outbox_rows(spark, run, "3", "4"))
    log, old = files(tables, state.ANOMALIES), files(tables, state.OUTBOX)
    assert runs.record_outcomes(tables, "old", outcome_rows(spark, "old", "1")).count() == 1
    assert runs.record_outcomes(tables, "new", outcome_rows(spark, "new", "3", "4", status="FAILED")).count() == 2
    runs.record_outcomes(tables, "old", outcome_rows(spark, "old", "1"))  # again: nothing more
    assert files(tables, state.ANOMALIES) == log and files(tables, state.OUTBOX) == old
    assert tables.read(state.ALERTS).count() == 3 and tables.read(state.MARKS).count() == 1
    flags = {("1", True), ("2", False), ("3", False), ("4", False)}
    assert as_set(tables.read(state.ANOMALIES).select("anomaly_id", "alerted")) == flags
    of_run = tables.read_partitions(state.OUTBOX, F.col("run_id") == "new")
    assert all("run_id=new" in path for path in of_run.inputFiles()) and of_run.inputFiles()

    assert tables.fold_marks(at_least=2) == 0 and tables.read(state.MARKS).count() == 1
    runs.record_outcomes(tables, "new", outcome_rows(spark, "new", "3"), fold_at=2)
    assert tables.read(state.MARKS).count() == 0
    assert as_set(spark.table(tables.name(state.ANOMALIES)).select("anomaly_id", "alerted")) == flags - {("3", False)} | {("3", True)}
    assert as_set(tables.read(state.ANOMALIES).select("anomaly_id", "alerted")) == flags - {("3", False)} | {("3", True)}


def test_alerting_looks_back_so_many_days(spark, tables):
    settings = AlertSettings({"LOW": ["slack"]}, {"slack"}, send_digest=False)
    tables.create_all()
    days = [datetime(2024, 1, 1), datetime(2024, 1, 20), datetime(2024, 1, 30)]
    rows = anomaly_rows(spark, *((str(n), day) for n, day in enumerate(days)))
    tables.append(state.ANOMALIES, rows.withColumns({"severity": F.lit("LOW"), "message": F.lit("m")}))

    def emitted(run, **given):
        return {r.anomaly_id for r in runs.run_alerting(tables, settings, run, as_of=AS_OF_DAY, **given).collect()}

    assert emitted("a", look_back_days=5) == {"2"}
    assert emitted("a", look_back_days=5) == {"2"}  # a repeated run has its rows, once
    assert emitted("b", look_back_days=15) == {"1"}  # that of run a is open
    runs.record_outcomes(tables, "a", spark.createDataFrame([(r.alert_id, "SENT", None) for r in tables.read(state.OUTBOX).collect()], OUTCOME))
    assert emitted("c", look_back_days=15, retry_open=True) == {"1"} and emitted("d") == {"0"}
