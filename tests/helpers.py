from datetime import datetime, timedelta

from metricwatch import Rule, SourceSpec, metric_columns, rules_frame
from metricwatch.operators.detectors import detect_metric_anomalies

START = datetime(2024, 1, 1)
TABLE = "shop"
AS_OF = "2024-01-02 00:00:00"
HISTORY = "table_name string, metric_name string, period_start timestamp, metric_value double"

SPEC = SourceSpec(
    table_name=TABLE,
    timestamp_column="at",
    ingestion_timestamp_column="loaded",
    id_columns=("id",),
    duplicate_key_columns=("key",),
    monitored_null_columns=("note",),
    numeric_metric_columns=("amount",),
    activity_column="amount",
)


def hour(n):
    return START + timedelta(hours=n)


def history(spark, metric, values, table=TABLE):
    """A series with one value per hour."""
    rows = [(table, metric, hour(n), None if v is None else float(v)) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, HISTORY)


def rule(kind, **params):
    return Rule(TABLE, kind, "HIGH", True, params)


INCREASE = rule("sudden_increase", metric="sum_amount", threshold_pct=50.0)
DECREASE = rule("sudden_decrease", metric="sum_amount", threshold_pct=-50.0)
DUPLICATES = rule("duplicate_record_anomaly", minimum_duplicate_count=1, threshold_pct=100.0)
NULLS = rule("null_data_quality_spike", minimum_null_ratio=0.05, threshold_pct=100.0)
STALE = rule("stale_data", max_allowed_staleness_minutes=180)


def detected(spark, metrics, *rules, as_of=AS_OF, spec=SPEC):
    columns = metric_columns(spark, [spec])
    return detect_metric_anomalies(metrics, rules_frame(spark, rules), columns, as_of, "run")


def hours_of(hits):
    return sorted((row.period_start - START).total_seconds() / 3600 for row in hits.collect())


BOUNDS_ROWS = "id int, at timestamp, key string, note string, amount int, loaded timestamp"
