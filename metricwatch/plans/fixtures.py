"""Watched views of the given tables, with the rules and routing the registered queries use.

The tables hold no null or blank cells, so these are derived here: an event of type ``error`` has no actor and
no activity, one of type ``signup`` has a blank actor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Collection, Iterator
from contextlib import contextmanager
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwatch.operators.alerts import AlertSettings
from metricwatch.operators.metrics import compute_all, compute_metrics, with_period
from metricwatch.operators.rules import seed_rules
from metricwatch.sources.state import StateTables
from metricwatch.specs import ANOMALY_TYPES, ROW_COUNT, Rule, SourceSpec, rules_frame

AS_OF = "2024-02-01 00:00:00"
SPLIT = datetime(2024, 1, 15)
RUN = "run-1"

EVENTS = SourceSpec(
    table_name="events",
    timestamp_column="event_time",
    grain="hourly",
    ingestion_timestamp_column="ingestion_time",
    id_columns=("event_id",),
    duplicate_key_columns=("user_id", "event_type"),
    monitored_null_columns=("actor_null", "actor_blank"),
    numeric_metric_columns=("amount", "activity_count"),
    activity_column="activity_count",
    status_column="event_type",
    expected_status_values=("click", "purchase", "signup", "view"),
)
ORDERS = SourceSpec(
    table_name="orders",
    timestamp_column="o_orderdate",
    grain="daily",
    id_columns=("o_orderkey",),
    duplicate_key_columns=("o_custkey", "o_orderdate"),
    monitored_null_columns=("o_orderpriority",),
    numeric_metric_columns=("price",),
    status_column="o_orderstatus",
    expected_status_values=("F", "O"),
)
LINEITEM = SourceSpec(
    table_name="lineitem",
    timestamp_column="l_shipdate",
    grain="daily",
    duplicate_key_columns=("l_orderkey", "l_linenumber"),
    monitored_null_columns=("l_returnflag", "l_partkey"),
    numeric_metric_columns=("price", "quantity"),
)

RULES = [
    Rule("events", "sudden_increase", "HIGH", True, {"metric": "sum_amount", "threshold_pct": 50.0}),
    Rule("events", "sudden_decrease", "HIGH", True, {"metric": "sum_amount", "threshold_pct": -50.0}),
    Rule(
        "events",
        "value_anomaly",
        "CRITICAL",
        True,
        {"metric": "value", "use_fixed_threshold": True, "fixed_lower_threshold": 0, "fixed_upper_threshold": 200},
    ),
    Rule("events", "missing_zero_activity", "HIGH", True, {"metric": "sum_activity_count", "zero_activity_value": 0}),
    Rule("events", "stale_data", "MEDIUM", True, {"max_allowed_staleness_minutes": 180}),
    Rule(
        "events",
        "duplicate_record_anomaly",
        "MEDIUM",
        True,
        {"metric": "duplicate_count", "minimum_duplicate_count": 1, "threshold_pct": 100.0},
    ),
    Rule(
        "events",
        "null_data_quality_spike",
        "MEDIUM",
        True,
        {"metric": "null_ratio", "minimum_null_ratio": 0.05, "threshold_pct": 100.0},
    ),
    Rule("orders", "sudden_increase", "LOW", True, {"metric": "sum_price", "threshold_pct": 100.0}),
    Rule("orders", "sudden_decrease", "MEDIUM", True, {"metric": "row_count", "threshold_pct": -60}),
    Rule(
        "orders",
        "value_anomaly",
        "LOW",
        True,
        {"metric": "o_totalprice", "use_fixed_threshold": True, "fixed_lower_threshold": 1000, "fixed_upper_threshold": 499000.5},
    ),
    Rule("lineitem", "sudden_increase", "HIGH", False, {"metric": "avg_price", "threshold_pct": 10.0}),
    Rule("lineitem", "sudden_decrease", "INFO", True, {"metric": "sum_quantity", "threshold_pct": -40.0}),
]
ZSCORE_RULE = Rule(
    "events", "value_anomaly", "CRITICAL", True, {"metric": "value", "use_fixed_threshold": False, "zscore_threshold": 3.0}
)
# Three value rules of one table, two of them on one column.
SEVERAL_VALUE_RULES = [
    Rule("events", "value_anomaly", "CRITICAL", True, {"metric": "value", "fixed_lower_threshold": 0, "fixed_upper_threshold": 200}),
    Rule("events", "value_anomaly", "LOW", True, {"metric": "value", "fixed_lower_threshold": 1, "fixed_upper_threshold": 150}),
    Rule("events", "value_anomaly", "MEDIUM", True, {"metric": "user_id", "fixed_lower_threshold": 3, "fixed_upper_threshold": 1000000}),
]
CONSECUTIVE_RULE = Rule(
    "events",
    "missing_zero_activity",
    "HIGH",
    True,
    {"metric": "sum_activity_count", "zero_activity_value": 0, "consecutive_periods_before_alert": 2},
)
# The metrics that the enabled rules above watch.
WATCHED = {
    "events": (
        "sum_amount",
        "sum_activity_count",
        "last_updated_epoch",
        "duplicate_count",
        "null_ratio_actor_null",
        "null_ratio_actor_blank",
    ),
    "orders": ("sum_price", "row_count"),
    "lineitem": ("sum_quantity",),
}
VALUE_RULES = {rule.table_name: rule for rule in RULES if rule.anomaly_type == "value_anomaly"}

ROUTING = {"CRITICAL": ["email", "teams"], "HIGH": ["email", "slack"], "MEDIUM": ["email"], "LOW": ["slack", "pager"]}
DIGEST = AlertSettings(ROUTING, frozenset({"email", "slack"}), send_digest=True)
SINGLE = AlertSettings(ROUTING, frozenset({"email", "slack"}), send_digest=False)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Periods are cut in the session's time zone; the tables hold zone-free times, which are read as UTC.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str, name: str) -> str:
    # Exact sums, whatever order the rows are added in.
    return f"CAST({column} AS DECIMAL(18,2)) AS {name}"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "ts AS event_time",
        "user_id",
        "event_type",
        "value",
        money("value", "amount"),
        "CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS activity_count",
        "CASE WHEN event_type <> 'error' THEN user_id END AS actor_null",
        "CASE WHEN event_type = 'signup' THEN '  ' ELSE CAST(user_id AS STRING) END AS actor_blank",
        "ts + INTERVAL 10 MINUTES AS ingestion_time",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("*", money("o_totalprice", "price"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr("*", "l_extendedprice AS price", "l_quantity AS quantity")


def sources(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, SourceSpec]]:
    return [
        (events(spark, sf_dir), EVENTS),
        (orders(spark, sf_dir), ORDERS),
        (lineitem(spark, sf_dir), LINEITEM),
    ]


def event_metrics(
    spark: SparkSession, sf_dir: str, run_id: str = RUN, only: Collection[str] | None = None
) -> DataFrame:
    return compute_metrics(events(spark, sf_dir), EVENTS, run_id, AS_OF, only=only)


def early_event_metrics(spark: SparkSession, sf_dir: str, run_id: str = RUN) -> DataFrame:
    early = events(spark, sf_dir).filter(F.col("event_time") < F.lit(SPLIT.isoformat(sep=" ")).cast("timestamp_ntz"))
    return compute_metrics(early, EVENTS, run_id, AS_OF)


def all_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compute_all(sources(spark, sf_dir), RUN, AS_OF)


def rules(spark: SparkSession, table_name: str | None = None, *types: str) -> DataFrame:
    """The rules above, of one table and of some types only if given."""
    chosen = [rule for rule in RULES if table_name in (None, rule.table_name)]
    return rules_frame(spark, [rule for rule in chosen if not types or rule.anomaly_type in types])


def feed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules of one feed per supplier, so that the rules table grows with the data.

    Feeds of suppliers with a low balance are off, some rules lack a severity or a route, and suppliers with a
    high balance have a rule of an unknown type.
    """
    severities = F.array(*(F.lit(s).cast("string") for s in ("CRITICAL", "HIGH", "MEDIUM", "LOW", "INFO", None)))
    known = F.array(*map(F.lit, ANOMALY_TYPES))
    types = F.when(F.col("s_acctbal") >= 8000, F.array_append(known, F.lit("schema_drift"))).otherwise(known)
    suppliers = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("feed_"), "s_suppkey").alias("table_name"),
        F.explode(types).alias("anomaly_type"),
        (F.col("s_acctbal") >= 1000).alias("enabled"),
        F.get(severities, (F.col("s_nationkey") % 6).cast("int")).alias("severity"),
        F.lit("sum_price").alias("metric"),
        (F.col("s_nationkey") + 50).alias("threshold_pct"),
    )
    return seed_rules(suppliers, ["metric", "threshold_pct"])


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of one feed per event type, some of which are silent for hours."""
    counts = with_period(events(spark, sf_dir), EVENTS).groupBy("event_type", "period_start").agg(
        F.count(F.lit(1)).cast("double").alias("metric_value")
    )
    return counts.select(
        F.concat(F.lit("events_"), "event_type").alias("table_name"),
        "period_start",
        F.lit(ROW_COUNT).alias("metric_name"),
        "metric_value",
    )


# Feeds that should have hourly rows from before the first event on; the last one never has any.
FEEDS = [
    SourceSpec(f"events_{kind}", "event_time", activity_column="activity_count")
    for kind in ("click", "error", "purchase", "signup", "view", "refund")
]
EXPECTED_FROM = "2023-12-31 20:00:00"


def feed_activity_rules(spark: SparkSession) -> DataFrame:
    params = {"metric": ROW_COUNT, "zero_activity_value": 0}
    return rules_frame(
        spark,
        [Rule(f.table_name, "missing_zero_activity", "HIGH", True, {**params, "expected_from": EXPECTED_FROM}) for f in FEEDS],
    )


def feed_schema(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The metrics and the columns of some of the feeds, as ``metric_columns`` and ``source_fields`` would list them."""
    feeds = table(spark, sf_dir, "supplier").withColumn("table_name", F.concat(F.lit("feed_"), "s_suppkey"))
    nation = F.col("s_nationkey")
    metric = F.when(nation % 3 == 0, "sum_price").otherwise(ROW_COUNT)
    columns = feeds.filter(nation % 3 != 2).select("table_name", metric.alias("rule_metric"), metric.alias("metric_name"))
    field = F.when((nation % 4).isin(0, 1), "sum_price").otherwise("price")
    fields = feeds.filter(nation % 4 != 3).select("table_name", field.alias("field"), (nation % 4 == 0).alias("numeric"))
    return columns, fields


def scratch(spark: SparkSession) -> str:
    """A new folder in the place the cluster names for written intermediate tables; on one machine any folder serves."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="metricwatch-")
    return f"{shared}/metricwatch/{uuid.uuid4()}"


@contextmanager
def state_tables(spark: SparkSession) -> Iterator[StateTables]:
    """State tables in a schema of their own, which is dropped afterwards; what is to last is stored before."""
    tables = StateTables(spark, f"metricwatch_{uuid.uuid4().hex}", scratch(spark))
    try:
        yield tables
    finally:
        spark.sql("DROP SCHEMA IDENTIFIER(:name) CASCADE", args={"name": tables.schema})


def stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The frame written once and read back, for plans that use it more than once."""
    path = scratch(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
