"""The sentences and threshold notes stored with an anomaly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricwatch import specs
from metricwatch.functions.columns import literal

# Message formats per anomaly type, then the SQL that fills them, in order.
MESSAGES = {
    specs.SUDDEN_INCREASE: (
        "Sudden increase: %s is %s%% above its trailing %s-period median (threshold %s%%)",
        ("metric_name", "round(pct_change, 1)", "{window}", "limit_text"),
    ),
    specs.SUDDEN_DECREASE: (
        "Sudden decrease: %s is %s%% below its trailing %s-period median (threshold %s%%)",
        ("metric_name", "round(pct_change, 1)", "{window}", "limit_text"),
    ),
    specs.VALUE_ANOMALY: ("Value anomaly on %s = %s (%s)", ("metric_name", "detected_value", "threshold_used")),
    specs.ZERO_ACTIVITY: ("No activity detected for period (%s = %s)", ("metric_name", "limit_text")),
    specs.STALE_DATA: (
        "Data is stale: last updated %s minutes ago (limit %s min)",
        ("round(detected_value, 1)", "limit_text"),
    ),
    specs.DUPLICATE_SPIKE: ("Duplicate record spike: %s duplicate row(s) detected", ("detected_value",)),
    specs.NULL_SPIKE: (
        "Null/data-quality spike on %s: null ratio = %s%%",
        ("column_name", "round(detected_value * 100, 1)"),
    ),
}

# Threshold formats per anomaly type, then the SQL that fills them, in order.
THRESHOLDS = {
    specs.SUDDEN_INCREASE: (
        "pct_change_vs_rolling_median >= %s%% (trailing %s periods, min history %s)",
        ("limit_text", "{window}", "{min_history}"),
    ),
    specs.SUDDEN_DECREASE: (
        "pct_change_vs_rolling_median <= %s%% (trailing %s periods, min history %s)",
        ("limit_text", "{window}", "{min_history}"),
    ),
    specs.ZERO_ACTIVITY: ("%s == %s", ("metric_name", "limit_text")),
    specs.STALE_DATA: ("staleness_minutes > %s", ("limit_text",)),
    specs.DUPLICATE_SPIKE: (
        "duplicate_count >= %s, and pct_change_vs_rolling_median >= %s%% once %s+ periods of "
        "trailing %s-period history exist",
        ("floor_text", "limit_text", "{min_history}", "{window}"),
    ),
    specs.NULL_SPIKE: (
        "null_ratio >= %s, and pct_change_vs_rolling_median >= %s%% once %s+ periods of "
        "trailing %s-period history exist",
        ("floor_text", "limit_text", "{min_history}", "{window}"),
    ),
}


def text_by_type(texts: Mapping[str, tuple[str, tuple[str, ...]]], **settings: int) -> Column:
    """The text of the row's own anomaly type."""
    cases = []
    for anomaly_type, (template, arguments) in texts.items():
        filled = (f"CAST({argument.format(**settings)} AS STRING)" for argument in arguments)
        cases.append(f"WHEN {literal(anomaly_type)} THEN format_string({literal(template)}, {', '.join(filled)})")
    return F.expr(f"CASE anomaly_type {' '.join(cases)} END")


def metric_message(window: int) -> Column:
    """Message of a metric anomaly, from the columns of a hit."""
    texts = {kind: text for kind, text in MESSAGES.items() if kind != specs.VALUE_ANOMALY}
    return text_by_type(texts, window=window)


def value_message() -> Column:
    """Message of a value anomaly, from the columns of a hit."""
    return text_by_type({specs.VALUE_ANOMALY: MESSAGES[specs.VALUE_ANOMALY]})


def metric_threshold(window: int, min_history: int) -> Column:
    """Threshold note of a metric anomaly, from the columns of a hit."""
    return text_by_type(THRESHOLDS, window=window, min_history=min_history)
