"""Sample events with planted anomalies, as a rule, with rules and routing.

The anomaly types, the names of rule parameters and the status of rules are fixed values; the data are our own.
"""

from datetime import datetime, timedelta

from metricwatch import AlertSettings, Rule, SourceSpec

TABLE = "shop.orders.incoming"
START = datetime(2025, 3, 3)
HOURS = 66
# A gentle daily wave; then what is planted, by hour.
SPIKE, DIP, HUGE, SILENT, BLANK, LATE, REPEATED = 31, 34, 38, (44, 45, 46), (55, 56), range(62, 66), 58
PLANTED = {SPIKE: 2750, DIP: 130, HUGE: 88000, **dict.fromkeys(SILENT, 0)}


def amount(hour):
    return PLANTED.get(hour, 700 + 15 * (hour % 8))


def rows():
    made = []
    for hour in range(HOURS):
        at = START + timedelta(hours=hour)
        silent, original = hour in SILENT, 21 if hour == REPEATED else hour
        made.append(
            (
                hour,
                at,
                f"order-{original}",
                "" if hour in BLANK else f"buyer-{original % 7}",
                amount(hour),
                0 if silent else 1,
                "NO_ACTIVITY" if silent else "SUCCESS",
                START + timedelta(hours=1) if hour in LATE else at + timedelta(minutes=20),
            )
        )
    return made


SCHEMA = (
    "row_id int, event_time timestamp_ntz, order_id string, buyer string, amount int, "
    "activity_count int, status string, ingestion_time timestamp_ntz"
)

SPEC = SourceSpec(
    table_name=TABLE,
    timestamp_column="event_time",
    ingestion_timestamp_column="ingestion_time",
    id_columns=("row_id",),
    duplicate_key_columns=("order_id",),
    monitored_null_columns=("buyer", "order_id", "amount"),
    numeric_metric_columns=("amount", "activity_count"),
    activity_column="activity_count",
    status_column="status",
    expected_status_values=("SUCCESS", "NO_ACTIVITY"),
)

FIXED_BOUNDS = {
    "metric": "amount",
    "zscore_threshold": 3.0,
    "fixed_upper_threshold": 50000,
    "fixed_lower_threshold": 0,
    "use_fixed_threshold": True,
}
RULES = [
    Rule(TABLE, "sudden_increase", "HIGH", True, {"metric": "sum_amount", "threshold_pct": 50.0}),
    Rule(TABLE, "sudden_decrease", "HIGH", True, {"metric": "sum_amount", "threshold_pct": -50.0}),
    Rule(TABLE, "value_anomaly", "CRITICAL", True, FIXED_BOUNDS),
    Rule(TABLE, "missing_zero_activity", "HIGH", True, {"metric": "sum_activity_count", "zero_activity_value": 0}),
    Rule(TABLE, "stale_data", "MEDIUM", True, {"max_allowed_staleness_minutes": 180}),
    Rule(
        TABLE,
        "duplicate_record_anomaly",
        "MEDIUM",
        True,
        {"metric": "duplicate_count", "threshold_pct": 100.0, "minimum_duplicate_count": 1},
    ),
    Rule(
        TABLE,
        "null_data_quality_spike",
        "MEDIUM",
        True,
        {"metric": "null_ratio", "threshold_pct": 100.0, "minimum_null_ratio": 0.05},
    ),
]
SETTINGS = AlertSettings(
    routing={"CRITICAL": ["email", "teams"], "HIGH": ["email"], "MEDIUM": ["email"], "LOW": ["slack"]},
    enabled_channels={"email"},
    send_digest=True,
    dedupe=False,
)
AS_OF = "2025-03-05 22:00:00"


def frame(spark):
    return spark.createDataFrame(rows(), SCHEMA)
