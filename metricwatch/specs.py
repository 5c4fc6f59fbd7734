"""What a watched table looks like, the rules that apply to it, and the state schemas."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Grain words and the date_trunc unit each stands for.
GRAINS = {"minute": "minute", "hourly": "hour", "daily": "day"}

# Anomaly types.
SUDDEN_INCREASE = "sudden_increase"
SUDDEN_DECREASE = "sudden_decrease"
VALUE_ANOMALY = "value_anomaly"
ZERO_ACTIVITY = "missing_zero_activity"
STALE_DATA = "stale_data"
DUPLICATE_SPIKE = "duplicate_record_anomaly"
NULL_SPIKE = "null_data_quality_spike"
ANOMALY_TYPES = (
    SUDDEN_INCREASE,
    SUDDEN_DECREASE,
    VALUE_ANOMALY,
    ZERO_ACTIVITY,
    STALE_DATA,
    DUPLICATE_SPIKE,
    NULL_SPIKE,
)

# Metric names that are not built from a column name.
ROW_COUNT = "row_count"
DUPLICATE_COUNT = "duplicate_count"
LAST_UPDATED = "last_updated_epoch"
NULL_RATIO = "null_ratio"

# Numeric statistics, the first part of names such as sum_amount.
STATISTICS = ("sum", "avg", "stddev", "min", "max")


def _schema(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(*column) for column in columns])


_string, _double, _time, _flag = T.StringType(), T.DoubleType(), T.TimestampType(), T.BooleanType()

# The columns of the state tables.
METRICS_SCHEMA = _schema(
    ("run_id", _string, False),
    ("table_name", _string, False),
    ("period_start", _time, False),
    ("metric_name", _string, False),
    ("metric_value", _double, True),
    ("computed_at", _time, False),
)
ANOMALY_SCHEMA = _schema(
    ("anomaly_id", _string, False),
    ("run_id", _string, False),
    ("table_name", _string, False),
    ("column_name", _string, True),
    ("anomaly_type", _string, False),
    ("severity", _string, False),
    ("period_start", _time, True),
    ("metric_name", _string, True),
    ("detected_value", _double, True),
    ("baseline_value", _double, True),
    ("threshold_used", _string, True),
    ("message", _string, False),
    ("detected_at", _time, False),
    ("alerted", _flag, False),
)
ALERT_SCHEMA = _schema(
    ("alert_id", _string, False),
    ("anomaly_id", _string, False),
    ("channel", _string, False),
    ("status", _string, False),
    ("error_message", _string, True),
    ("sent_at", _time, False),
)
RULES_SCHEMA = _schema(
    ("table_name", _string, False),
    ("anomaly_type", _string, False),
    ("enabled", _flag, False),
    ("severity", _string, True),
    ("rule_json", _string, True),
)
OUTBOX_SCHEMA = _schema(
    ("alert_id", _string, False),
    ("run_id", _string, False),
    ("anomaly_id", _string, False),
    ("channel", _string, False),
    ("status", _string, False),
    ("error_message", _string, True),
    ("in_digest", _flag, False),
    ("subject", _string, True),
    ("body", _string, True),
)
DIGESTS_SCHEMA = _schema(
    ("run_id", _string, False),
    ("section", T.IntegerType(), False),
    ("rank", T.IntegerType(), False),
    ("line_id", _string, False),
    ("html", _string, True),
)
SEEN_KEYS_SCHEMA = _schema(
    ("table_name", _string, False),
    ("generation", _string, False),
    ("until", _time, False),
    ("key_high", T.LongType(), False),
    ("key_low", T.LongType(), False),
)
KEY_TOTALS_SCHEMA = _schema(
    ("table_name", _string, False),
    ("generation", _string, False),
    ("until", _time, True),
    ("rows", T.LongType(), False),
    ("keys", T.LongType(), False),
    ("latest", _time, True),
    ("recorded_at", _time, False),
)
PARTS_SCHEMA = _schema(
    ("table_name", _string, False),
    ("period_start", _time, True),
    ("kind", _string, False),
    ("column_name", _string, True),
    ("batch_id", _string, False),
    ("n", T.LongType(), False),
    ("total_exact", T.DecimalType(38, 18), True),
    ("total", _double, True),
    ("deviation", _double, True),
    ("low", _double, True),
    ("high", _double, True),
)
MARKS_SCHEMA = _schema(("anomaly_id", _string, False))


@dataclass(frozen=True)
class SourceSpec:
    """A watched table: its name and which columns play which role."""

    table_name: str
    timestamp_column: str
    grain: str = "hourly"
    ingestion_timestamp_column: str | None = None
    id_columns: tuple[str, ...] = ()
    duplicate_key_columns: tuple[str, ...] = ()
    monitored_null_columns: tuple[str, ...] = ()
    numeric_metric_columns: tuple[str, ...] = ()
    activity_column: str | None = None
    status_column: str | None = None
    expected_status_values: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.grain not in GRAINS:
            raise ValueError(f"unknown grain {self.grain!r}; use one of {sorted(GRAINS)}")

    @property
    def trunc_unit(self) -> str:
        return GRAINS[self.grain]

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> SourceSpec:
        """Read the sections ``unity_catalog``, ``source_data`` and ``metrics_engine`` of a loaded config."""
        catalog, roles = config["unity_catalog"], config["source_data"]
        return cls(
            table_name=catalog["source_table_full_name"].format(**catalog),
            timestamp_column=roles["timestamp_column"],
            grain=config["metrics_engine"]["grain"],
            ingestion_timestamp_column=roles.get("ingestion_timestamp_column"),
            id_columns=tuple(roles.get("id_columns", ())),
            duplicate_key_columns=tuple(roles.get("duplicate_key_columns", ())),
            monitored_null_columns=tuple(roles.get("monitored_null_columns", ())),
            numeric_metric_columns=tuple(roles.get("numeric_metric_columns", ())),
            activity_column=roles.get("activity_column"),
            status_column=roles.get("status_column"),
            expected_status_values=tuple(roles.get("expected_status_values", ())),
        )


@dataclass(frozen=True)
class Rule:
    """One rule of one table. ``params`` is the JSON payload, numbers as the author wrote them."""

    table_name: str
    anomaly_type: str
    severity: str | None = None
    enabled: bool = True
    params: Mapping[str, Any] = field(default_factory=dict)

    def to_row(self) -> dict[str, Any]:
        payload = {"enabled": self.enabled, **self.params}
        if self.severity is not None:
            payload["severity"] = self.severity
        return {
            "table_name": self.table_name,
            "anomaly_type": self.anomaly_type,
            "enabled": self.enabled,
            "severity": self.severity,
            "rule_json": json.dumps(payload),
        }

    @classmethod
    def from_row(cls, row: Mapping[str, Any]) -> Rule:
        params = json.loads(row["rule_json"] or "{}")
        params.pop("enabled", None)
        params.pop("severity", None)
        return cls(row["table_name"], row["anomaly_type"], row["severity"], row["enabled"], params)


def rules_from_config(config: Mapping[str, Any], table_name: str) -> list[Rule]:
    """The section ``anomaly_rules`` of a loaded config, as rules of one table."""
    rules = []
    for anomaly_type, settings in config["anomaly_rules"].items():
        params = {key: value for key, value in settings.items() if key not in ("enabled", "severity")}
        rules.append(Rule(table_name, anomaly_type, settings.get("severity"), settings.get("enabled", False), params))
    return rules


def local_frame(spark: SparkSession, rows: Iterable[Mapping[str, Any]], schema: T.StructType) -> DataFrame:
    """Rows of configuration as a DataFrame whose size the optimizer knows.

    Arrow input becomes a local relation, so joins with it are broadcast when, and only when, it is small.
    """
    arrow_types = {_string: pa.string(), _double: pa.float64(), _flag: pa.bool_()}
    arrow = pa.schema([(f.name, arrow_types[f.dataType]) for f in schema.fields])
    return spark.createDataFrame(pa.Table.from_pylist([dict(row) for row in rows], schema=arrow), schema=schema)


def rules_frame(spark: SparkSession, rules: Iterable[Rule]) -> DataFrame:
    """Rules as rows of the rules table."""
    return local_frame(spark, (rule.to_row() for rule in rules), RULES_SCHEMA)


METRIC_COLUMNS_SCHEMA = _schema(
    ("table_name", _string, False),
    ("rule_metric", _string, False),
    ("metric_name", _string, False),
    ("column_name", _string, True),
    ("activity_column", _string, True),
)


def metric_columns(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    """Which source column each metric of each table describes.

    ``rule_metric`` is the name a rule uses: the metric's own name, or ``null_ratio`` for every null ratio.
    """
    rows = []
    for spec in specs:
        named = [(ROW_COUNT, ROW_COUNT, None)]
        named += [(f"{s}_{c}",) * 2 + (c,) for c in spec.numeric_metric_columns for s in STATISTICS]
        named += [(NULL_RATIO, f"{NULL_RATIO}_{c}", c) for c in spec.monitored_null_columns]
        if spec.duplicate_key_columns:
            named.append((DUPLICATE_COUNT, DUPLICATE_COUNT, ", ".join(spec.duplicate_key_columns)))
        if spec.ingestion_timestamp_column:
            named.append((LAST_UPDATED, LAST_UPDATED, spec.ingestion_timestamp_column))
        rows += [
            dict(zip(METRIC_COLUMNS_SCHEMA.names, (spec.table_name, *name, spec.activity_column))) for name in named
        ]
    return local_frame(spark, rows, METRIC_COLUMNS_SCHEMA)


SOURCE_FIELDS_SCHEMA = _schema(("table_name", _string, False), ("field", _string, False), ("numeric", _flag, False))


def source_fields(spark: SparkSession, sources: Iterable[tuple[DataFrame, SourceSpec]]) -> DataFrame:
    """The columns of each table, and nested fields by path, in lower case, with whether they are numbers."""
    rows = []

    def listed(name: str, fields: T.StructType, before: str) -> None:
        for field in fields:
            path = f"{before}{field.name}".lower()
            rows.append({"table_name": name, "field": path, "numeric": isinstance(field.dataType, T.NumericType)})
            if isinstance(field.dataType, T.StructType):
                listed(name, field.dataType, f"{path}.")

    for df, spec in sources:
        listed(spec.table_name, df.schema, "")
    return local_frame(spark, rows, SOURCE_FIELDS_SCHEMA)
