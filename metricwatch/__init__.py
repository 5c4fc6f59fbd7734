"""Metric history, anomaly detection and alert tables as Spark DataFrame operators."""

from metricwatch.operators.alerts import AlertSettings
from metricwatch.specs import Rule, SourceSpec, metric_columns, rules_frame

__all__ = ["AlertSettings", "Rule", "SourceSpec", "metric_columns", "rules_frame"]
