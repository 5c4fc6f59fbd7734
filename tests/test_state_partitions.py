"""How upserts bring partitions into a state table."""

from datetime import datetime

from pyspark.sql import functions as F

from metricwatch.sources import state

KEYS = ("table_name", "period_start", "metric_name")
UPDATES = ("metric_value", "run_id", "computed_at")


def metrics(spark, value):
    rows = [("run", "sh'op=1", datetime(2020 + n // 12, 1 + n % 12, 1), "row_count", value, datetime(2024, 1, 1)) for n in range(30)]
    return spark.createDataFrame(rows, state.METRICS_SCHEMA)


def altered(tables, monkeypatch):
    found, plain = [], tables._alter
    monkeypatch.setattr(tables, "_alter", lambda table, change: found.append(change) or plain(table, change))
    return found


def values(tables):
    return {(r.n, r.metric_value) for r in tables.read(state.METRICS).groupBy("metric_value").agg(F.count(F.lit(1)).alias("n")).collect()}


def test_new_partitions_come_in_one_statement(spark, tables, monkeypatch):
    tables.create(state.METRICS)
    changes = altered(tables, monkeypatch)
    tables.upsert(state.METRICS, metrics(spark, 1.0), KEYS, UPDATES)
    assert len(changes) == 1 and values(tables) == {(30, 1.0)}
    tables.upsert(state.METRICS, metrics(spark, 2.0), KEYS, UPDATES)
    assert values(tables) == {(30, 2.0)} and all("SET LOCATION" in change for change in changes[1:])


def test_partitions_that_another_writer_adds_meanwhile_are_switched(spark, tables, monkeypatch):
    tables.create(state.METRICS)
    tables.upsert(state.METRICS, metrics(spark, 1.0), KEYS, UPDATES)
    monkeypatch.setattr(tables, "_listed", lambda table: [])
    tables.upsert(state.METRICS, metrics(spark, 2.0), KEYS, UPDATES)
    assert values(tables) == {(30, 2.0)}
