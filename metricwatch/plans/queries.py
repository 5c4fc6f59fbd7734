"""The registered queries: each operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch import specs
from metricwatch.functions.columns import quoted
from metricwatch.operators import alerts, anomaly_log, baseline, detectors, metrics
from metricwatch.operators import rules as rule_ops
from metricwatch.operators.upsert import upsert
from metricwatch.plans import fixtures as fx
from metricwatch.plans import runs
from metricwatch.plans.runs import METRIC_KEYS, METRIC_UPDATES
from metricwatch.sources import state
from metricwatch.sources.tables import read_csv, read_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

METRIC = ("table_name", "period_start", "metric_name", "metric_value")
HIT = (
    "table_name",
    "column_name",
    "anomaly_type",
    "severity",
    "period_start",
    "metric_name",
    "detected_value",
    "baseline_value",
    "threshold_used",
)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def shown(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns as results are compared: rounded doubles and zone-free times."""
    picked = df.select(*columns) if columns else df
    forms = {T.DoubleType: "round({0}, 6) AS {0}", T.TimestampType: "CAST({0} AS TIMESTAMP_NTZ) AS {0}"}
    return picked.selectExpr(
        *(forms.get(type(field.dataType), "{0}").format(quoted(field.name)) for field in picked.schema.fields)
    )


# Metrics


def _bucket(spark: SparkSession, sf_dir: str, grain: str) -> DataFrame:
    bucketed = metrics.with_period(fx.events(spark, sf_dir), replace(fx.EVENTS, grain=grain))
    return shown(bucketed.groupBy("period_start").agg(F.count(F.lit(1)).alias("rows")))


@query
def period_bucket_minute(spark, sf_dir):
    return _bucket(spark, sf_dir, "minute")


@query
def period_bucket_hour(spark, sf_dir):
    return _bucket(spark, sf_dir, "hourly")


@query
def period_bucket_day(spark, sf_dir):
    return _bucket(spark, sf_dir, "daily")


def _event_periods(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return shown(metrics.period_metrics(fx.events(spark, sf_dir), fx.EVENTS), "period_start", *columns)


@query
def row_count(spark, sf_dir):
    return _event_periods(spark, sf_dir, "row_count")


@query
def numeric_stats(spark, sf_dir):
    names = [f"{s}_{c}" for c in fx.EVENTS.numeric_metric_columns for s in specs.STATISTICS]
    return _event_periods(spark, sf_dir, *names)


@query
def null_count(spark, sf_dir):
    return shown(metrics.null_counts(fx.events(spark, sf_dir), fx.EVENTS))


@query
def null_ratio(spark, sf_dir):
    return _event_periods(spark, sf_dir, *(f"null_ratio_{c}" for c in fx.EVENTS.monitored_null_columns))


@query
def last_updated_epoch(spark, sf_dir):
    return _event_periods(spark, sf_dir, "last_updated_epoch")


@query
def duplicate_count(spark, sf_dir):
    return shown(metrics.duplicate_count(fx.lineitem(spark, sf_dir), fx.LINEITEM))


@query
def duplicate_history(spark, sf_dir):
    return shown(metrics.duplicate_history(fx.events(spark, sf_dir), fx.EVENTS))


@query
def metrics_long(spark, sf_dir):
    return shown(fx.event_metrics(spark, sf_dir), *METRIC)


@query
def metrics_multi_table(spark, sf_dir):
    return shown(fx.all_metrics(spark, sf_dir), *METRIC)


@query
def metrics_since(spark, sf_dir):
    recent = metrics.compute_all([(fx.events(spark, sf_dir), fx.EVENTS)], fx.RUN, fx.AS_OF, since=fx.SPLIT)
    return shown(recent, *METRIC)


@query
def duplicate_count_since(spark, sf_dir):
    """Four runs over the growing table; after the first each reads only the rows that the one before left open."""
    events = fx.events(spark, sf_dir)
    with fx.state_tables(spark) as tables:
        for until, since in (("2024-01-12", "2024-01-08"), ("2024-01-20", "2024-01-12"), ("2024-01-20", "2024-01-12"), (None, "2024-01-20")):
            rows = events if until is None else events.filter(F.col("event_time") < F.lit(until).cast("timestamp_ntz"))
            runs.run_metrics(tables, [(rows, fx.EVENTS)], f"since {since}", fx.AS_OF, since=since)
        history = baseline.metric_history(tables.read(state.METRICS), specs.DUPLICATE_COUNT)
        return fx.stored(spark, shown(history, "run_id", *METRIC))


@query
def metrics_by_batches(spark, sf_dir):
    """Three batches, each with rows of nearly every period; the second one twice."""
    events = fx.events(spark, sf_dir)
    with fx.state_tables(spark) as tables:
        for number in (0, 1, 1, 2):
            batch = events.filter(F.pmod("event_id", F.lit(3)) == number)
            runs.run_batch(tables, [(batch, fx.EVENTS)], f"batch {number}", fx.RUN, fx.AS_OF)
        return fx.stored(spark, shown(tables.read(state.METRICS), *METRIC))


@query
def metrics_ordered(spark, sf_dir):
    return anomaly_log.metrics_ordered(shown(fx.event_metrics(spark, sf_dir), *METRIC))


@query
def metric_column_map(spark, sf_dir):
    columns = specs.metric_columns(spark, [spec for _, spec in fx.sources(spark, sf_dir)])
    described = fx.all_metrics(spark, sf_dir).join(columns, ["table_name", "metric_name"], "left")
    return described.groupBy("table_name", "metric_name", "column_name").agg(F.count(F.lit(1)).alias("periods"))


@query
def unexpected_status(spark, sf_dir):
    return shown(metrics.unexpected_status(fx.orders(spark, sf_dir), fx.ORDERS))


# Baselines


@query
def metric_history(spark, sf_dir):
    history = fx.event_metrics(spark, sf_dir, only=["sum_amount", "row_count"])
    return shown(baseline.metric_history(history, "sum_amount"), *METRIC)


@query
def lag_previous(spark, sf_dir):
    return shown(baseline.with_previous(fx.event_metrics(spark, sf_dir)), *METRIC, "previous_value")


def _with_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.with_baseline(fx.event_metrics(spark, sf_dir))


@query
def rolling_median(spark, sf_dir):
    return shown(_with_baseline(spark, sf_dir), *METRIC, "baseline_median")


@query
def history_count(spark, sf_dir):
    return shown(_with_baseline(spark, sf_dir), "table_name", "period_start", "metric_name", "history_count")


@query
def pct_change(spark, sf_dir):
    return shown(_with_baseline(spark, sf_dir), "table_name", "period_start", "metric_name", "pct_change")


@query
def cold_start_gate(spark, sf_dir):
    gated = _with_baseline(spark, sf_dir).withColumn("has_history", baseline.has_history(5))
    return shown(gated, "table_name", "period_start", "metric_name", "has_history")


@query
def zero_to_nonzero(spark, sf_dir):
    tested = _with_baseline(spark, sf_dir).withColumn("from_zero", baseline.zero_to_nonzero())
    return shown(tested, "table_name", "period_start", "metric_name", "from_zero")


# Detectors


def _hits_on(history: DataFrame, spec: specs.SourceSpec, rules: DataFrame) -> DataFrame:
    columns = specs.metric_columns(history.sparkSession, [spec])
    return detectors.detect_metric_anomalies(history, rules, columns, fx.AS_OF, fx.RUN)


def _event_hits_of(spark: SparkSession, sf_dir: str, anomaly_type: str, *watched: str) -> DataFrame:
    """Hits of one type, from a history of just the metrics its rule watches."""
    history = fx.event_metrics(spark, sf_dir, only=watched)
    return shown(_hits_on(history, fx.EVENTS, fx.rules(spark, "events", anomaly_type)), *HIT)


@query
def rules_applied(spark, sf_dir):
    columns = specs.metric_columns(spark, [spec for _, spec in fx.sources(spark, sf_dir)])
    applied = detectors.rules_on_history(fx.all_metrics(spark, sf_dir), fx.rules(spark), columns)
    return shown(applied, *METRIC, "anomaly_type", "severity", "limit", "floor")


@query
def sudden_increase(spark, sf_dir):
    return _event_hits_of(spark, sf_dir, specs.SUDDEN_INCREASE, "sum_amount")


@query
def sudden_decrease(spark, sf_dir):
    return _event_hits_of(spark, sf_dir, specs.SUDDEN_DECREASE, "sum_amount")


@query
def zero_activity(spark, sf_dir):
    return _event_hits_of(spark, sf_dir, specs.ZERO_ACTIVITY, "sum_activity_count")


@query
def zero_activity_consecutive(spark, sf_dir):
    history = fx.event_metrics(spark, sf_dir, only=["sum_activity_count"])
    return shown(_hits_on(history, fx.EVENTS, specs.rules_frame(spark, [fx.CONSECUTIVE_RULE])), *HIT)


@query
def missing_periods(spark, sf_dir):
    return shown(detectors.missing_periods(fx.event_type_counts(spark, sf_dir), "hourly"))


@query
def detect_missing_periods(spark, sf_dir):
    history = fx.event_type_counts(spark, sf_dir)
    return shown(detectors.detect_missing_periods(history, fx.feed_activity_rules(spark), fx.FEEDS, fx.AS_OF, fx.RUN), "anomaly_id", *HIT)


@query
def baseline_without_event_time(spark, sf_dir):
    # Errors lose their event time: their rows are the null period, which no baseline counts.
    time = F.when(F.col("event_type") != "error", F.col("event_time"))
    some = fx.events(spark, sf_dir).withColumn("event_time", time)
    history = metrics.compute_metrics(some, fx.EVENTS, fx.RUN, fx.AS_OF, only=["row_count", "sum_amount"])
    return shown(baseline.with_baseline(history), *METRIC, "previous_value", "baseline_median", "history_count")


@query
def stale_data(spark, sf_dir):
    return _event_hits_of(spark, sf_dir, specs.STALE_DATA, specs.LAST_UPDATED)


@query
def duplicate_spike(spark, sf_dir):
    counts = metrics.duplicate_history(fx.events(spark, sf_dir), fx.EVENTS)
    history = metrics.tag_metrics(counts, fx.EVENTS, fx.RUN, fx.AS_OF)
    return shown(_hits_on(history, fx.EVENTS, fx.rules(spark, "events", specs.DUPLICATE_SPIKE)), *HIT)


@query
def null_spike(spark, sf_dir):
    ratios = [f"{specs.NULL_RATIO}_{c}" for c in fx.EVENTS.monitored_null_columns]
    return _event_hits_of(spark, sf_dir, specs.NULL_SPIKE, *ratios)


@query
def value_fixed_threshold(spark, sf_dir):
    rule = fx.VALUE_RULES["events"]
    hits = detectors.detect_value_anomalies(fx.events(spark, sf_dir), fx.EVENTS, rule, fx.AS_OF, fx.RUN)
    return shown(hits, "anomaly_id", *HIT)


@query
def value_zscore(spark, sf_dir):
    hits = detectors.detect_value_anomalies(fx.events(spark, sf_dir), fx.EVENTS, fx.ZSCORE_RULE, fx.AS_OF, fx.RUN)
    return shown(hits, *HIT)


@query
def value_several_bounds(spark, sf_dir):
    hits = detectors.detect_value_anomalies(fx.events(spark, sf_dir), fx.EVENTS, fx.SEVERAL_VALUE_RULES, fx.AS_OF, fx.RUN)
    return shown(hits, *HIT, "message")


def _all_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fx.sources(spark, sf_dir)
    history = metrics.compute_all(tables, fx.RUN, fx.AS_OF, only=fx.WATCHED)
    return detectors.detect(history, tables, fx.rules(spark), fx.VALUE_RULES, fx.AS_OF, fx.RUN)


@query
def detect_all(spark, sf_dir):
    return shown(_all_hits(spark, sf_dir), "anomaly_id", *HIT, "detected_at", "alerted")


@query
def detect_by_table(spark, sf_dir):
    tables, rules = fx.sources(spark, sf_dir), fx.rules(spark)
    history = fx.stored(spark, metrics.compute_all(tables, fx.RUN, fx.AS_OF, only=fx.WATCHED))
    runs_ = [detectors.detect(history, [source], rules, fx.VALUE_RULES, fx.AS_OF, fx.RUN) for source in tables]
    return shown(reduce(DataFrame.unionByName, runs_), "anomaly_id", *HIT, "detected_at", "alerted")


@query
def anomaly_messages(spark, sf_dir):
    return shown(_all_hits(spark, sf_dir), "anomaly_id", "message", "threshold_used")


# Anomaly log


def _early(hits: DataFrame) -> DataFrame:
    return hits.filter(F.col("period_start") < F.lit(fx.SPLIT.isoformat(sep=" ")).cast("timestamp"))


@query
def new_anomalies(spark, sf_dir):
    hits = fx.stored(spark, _all_hits(spark, sf_dir))
    return shown(anomaly_log.new_anomalies(hits, _early(hits)), "anomaly_id", *HIT)


@query
def new_anomalies_null_key(spark, sf_dir):
    midnight = F.hour("period_start") == 0
    hits = _all_hits(spark, sf_dir).withColumn("column_name", F.when(F.col("severity") != "MEDIUM", F.col("column_name")))
    hits = fx.stored(spark, hits.withColumn("period_start", F.when(~midnight, F.col("period_start"))))
    logged = hits.filter(F.col("period_start").isNull() | F.col("column_name").isNull())
    return shown(anomaly_log.new_anomalies(hits, logged), "anomaly_id", *HIT)


@query
def detect_incremental(spark, sf_dir):
    spec, values = fx.EVENTS, fx.VALUE_RULES
    events = fx.events(spark, sf_dir)
    before = events.filter(F.col("event_time") < F.lit(fx.SPLIT.isoformat(sep=" ")).cast("timestamp_ntz"))
    rules = fx.rules(spark, "events")

    def run(rows: DataFrame) -> DataFrame:
        history = metrics.compute_metrics(rows, spec, fx.RUN, fx.AS_OF, only=fx.WATCHED["events"])
        return detectors.detect(history, [(rows, spec)], rules, values, fx.AS_OF, fx.RUN)

    return shown(anomaly_log.new_anomalies(run(events), run(before)), "anomaly_id", *HIT)


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything detected; the decreases were alerted on by an earlier run."""
    return _all_hits(spark, sf_dir).withColumn("alerted", F.col("anomaly_type") == specs.SUDDEN_DECREASE)


@query
def anomalies_ordered(spark, sf_dir):
    return anomaly_log.anomalies_ordered(shown(_log(spark, sf_dir), "anomaly_id", *HIT, "detected_at"))


@query
def anomaly_summary(spark, sf_dir):
    return anomaly_log.anomaly_summary(_log(spark, sf_dir))


@query
def alert_totals(spark, sf_dir):
    return anomaly_log.alert_totals(_log(spark, sf_dir))


@query
def pending_anomalies(spark, sf_dir):
    return shown(anomaly_log.pending_anomalies(_log(spark, sf_dir)), "anomaly_id", *HIT, "alerted")


@query
def pending_realert(spark, sf_dir):
    return shown(anomaly_log.pending_anomalies(_log(spark, sf_dir), dedupe=False), "anomaly_id", *HIT, "alerted")


# Alerts


@query
def alert_routing(spark, sf_dir):
    routed = alerts.route(anomaly_log.pending_anomalies(_log(spark, sf_dir)), fx.DIGEST)
    return routed.select("anomaly_id", "severity", "channel")


@query
def unrouted(spark, sf_dir):
    return shown(alerts.unrouted(_log(spark, sf_dir), fx.DIGEST), "anomaly_id", *HIT)


@query
def alert_outbox(spark, sf_dir):
    return alerts.alert_outbox(_log(spark, sf_dir), fx.DIGEST, "alerts-1")


@query
def alert_addresses(spark, sf_dir):
    outbox = alerts.alert_outbox(_log(spark, sf_dir), fx.DIGEST, "alerts-1")
    to = replace(fx.DIGEST, recipients=("ops@x.com", "data@x.com"), cc=("lead@x.com",), chat_targets={"slack": "#watch"})
    named = alerts.addressed(outbox, to)
    joined = {c: F.array_join(c, ", ") for c in ("recipients", "cc")}
    return named.withColumns(joined).select("alert_id", "channel", "recipients", "cc", "target")


@query
def alert_subjects(spark, sf_dir):
    outbox = alerts.alert_outbox(_log(spark, sf_dir), fx.SINGLE, "alerts-1")
    return outbox.filter("status = 'PENDING'").select("alert_id", "channel", "subject")


@query
def alert_bodies(spark, sf_dir):
    outbox = alerts.alert_outbox(_log(spark, sf_dir), fx.SINGLE, "alerts-1")
    return outbox.filter("status = 'PENDING'").select("alert_id", "channel", "body")


@query
def digest_rows(spark, sf_dir):
    return shown(alerts.digest_rows(_log(spark, sf_dir), fx.DIGEST))


@query
def digest_summary(spark, sf_dir):
    return alerts.digest_summary(_log(spark, sf_dir), fx.DIGEST, fx.AS_OF)


@query
def digest_html(spark, sf_dir):
    return alerts.digest_html(fx.stored(spark, _log(spark, sf_dir)), fx.DIGEST, fx.AS_OF)


def _outcomes(outbox: DataFrame) -> DataFrame:
    """What a sender might report: ids that start with 0 to 7 get through."""
    sent = F.substring("anomaly_id", 1, 1) < "8"
    return outbox.filter((F.col("status") == alerts.PENDING) & ~F.col("in_digest")).select(
        "alert_id",
        F.when(sent, alerts.SENT).otherwise(alerts.FAILED).alias("status"),
        F.when(~sent, "timeout").alias("error_message"),
    )


@query
def alert_log(spark, sf_dir):
    outbox = fx.stored(spark, alerts.alert_outbox(_log(spark, sf_dir), fx.DIGEST, "alerts-1"))
    return shown(alerts.alert_log(outbox, _outcomes(outbox), (alerts.SENT, None), fx.AS_OF))


@query
def alert_log_single(spark, sf_dir):
    outbox = fx.stored(spark, alerts.alert_outbox(_log(spark, sf_dir), fx.SINGLE, "alerts-1"))
    return shown(alerts.alert_log(outbox, _outcomes(outbox), None, fx.AS_OF))


@query
def mark_alerted(spark, sf_dir):
    log = fx.stored(spark, _log(spark, sf_dir))
    outbox = fx.stored(spark, alerts.alert_outbox(log, fx.DIGEST, "alerts-1"))
    logged = alerts.alert_log(outbox, _outcomes(outbox), (alerts.FAILED, "timeout"), fx.AS_OF)
    return shown(alerts.mark_alerted(log, logged), "anomaly_id", *HIT, "alerted")


@query
def scheduled_run(spark, sf_dir):
    sources = fx.sources(spark, sf_dir)
    with fx.state_tables(spark) as tables:
        runs.set_up(tables, fx.RULES)
        for run_id in ("run-1", "run-2"):
            runs.run_metrics(tables, sources, run_id, fx.AS_OF)
            runs.run_detection(tables, sources, run_id, fx.AS_OF)
        outbox = runs.run_alerting(tables, fx.DIGEST, "alerts-1")
        # The alerts of the first run are still open, so this one has none to emit.
        runs.run_alerting(tables, fx.DIGEST, "alerts-2")
        runs.record_outcomes(tables, "alerts-1", _outcomes(outbox), (alerts.FAILED, "timeout"), fx.AS_OF)
        emitted = tables.read(state.OUTBOX).filter("status = 'PENDING'").groupBy("anomaly_id").agg(
            F.count(F.lit(1)).alias("emitted")
        )
        log = tables.read(state.ANOMALIES).join(emitted, "anomaly_id", "left")
        log = log.withColumn("emitted", F.coalesce("emitted", F.lit(0)).cast("long"))
        return fx.stored(spark, shown(log, "anomaly_id", "run_id", *HIT, "message", "alerted", "emitted"))


@query
def scheduled_digest(spark, sf_dir):
    sources = fx.sources(spark, sf_dir)
    with fx.state_tables(spark) as tables:
        runs.set_up(tables, fx.RULES)
        runs.run_metrics(tables, sources, "run-1", fx.AS_OF)
        runs.run_detection(tables, sources, "run-1", fx.AS_OF)
        outbox = runs.run_alerting(tables, fx.DIGEST, "alerts-1", as_of=fx.AS_OF)
        runs.store_digest(tables, fx.DIGEST, "alerts-1", fx.AS_OF)
        runs.record_outcomes(tables, "alerts-1", _outcomes(outbox), (alerts.SENT, None), fx.AS_OF)
        # Again, after it was sent: the same lines, once.
        return fx.stored(spark, runs.store_digest(tables, fx.DIGEST, "alerts-1", fx.AS_OF))


# Rules


@query
def rules_table(spark, sf_dir):
    with fx.state_tables(spark) as tables:
        tables.overwrite(state.RULES, fx.feed_rules(spark, sf_dir))
        return fx.stored(spark, tables.read(state.RULES))


@query
def rules_enabled(spark, sf_dir):
    return rule_ops.enabled_rules(fx.feed_rules(spark, sf_dir)).select("table_name", "anomaly_type", "severity")


@query
def rules_violations(spark, sf_dir):
    return rule_ops.rule_violations(fx.feed_rules(spark, sf_dir), fx.ROUTING)


@query
def rules_against_schema(spark, sf_dir):
    feeds = fx.feed_rules(spark, sf_dir)
    fifth = fx.table(spark, sf_dir, "supplier").filter("s_nationkey % 5 = 0").select(F.concat(F.lit("feed_"), "s_suppkey").alias("table_name"))
    twice = feeds.unionByName(feeds.join(fifth, "table_name"))
    return rule_ops.rule_violations(twice, fx.ROUTING, *fx.feed_schema(spark, sf_dir))


@query
def retire_rules(spark, sf_dir):
    # Each supplier's feed lands in one of five tables by its nation; two of these are gone.
    supplier = fx.table(spark, sf_dir, "supplier")
    place = F.concat(F.lit("feed_"), F.col("s_nationkey") % 5)
    places = supplier.select(F.concat(F.lit("feed_"), "s_suppkey").alias("table_name"), place.alias("place"))
    with fx.state_tables(spark) as tables:
        for group in (1, 2, 4):
            tables.create(f"feed_{group}", supplier.schema)
        name = F.concat(F.lit(f"{tables.schema}."), "place").alias("table_name")
        rules = fx.feed_rules(spark, sf_dir).join(places, "table_name")
        tables.overwrite(state.RULES, rules.select(name, "anomaly_type", "enabled", "severity", "rule_json"))
        runs.run_retirement(tables, rule_ops.existing_tables(spark, tables.schema))
        kept = tables.read(state.RULES).withColumn("table_name", F.substring_index("table_name", ".", -1))
        return fx.stored(spark, kept)


# State tables


@query
def csv_source(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    path, times = fx.scratch(spark), {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}
    events.write.options(**times).csv(path, header=True)
    return read_csv(spark, path, events.schema, **times)


@query
def state_init(spark, sf_dir):
    with fx.state_tables(spark) as tables:
        tables.create_all()
        tables.append(state.METRICS, fx.event_metrics(spark, sf_dir))
        tables.create_all()
        return fx.stored(spark, shown(read_table(spark, tables.name(state.METRICS)), *METRIC))


@query
def state_append(spark, sf_dir):
    history = fx.event_metrics(spark, sf_dir).select(*METRIC)
    early = F.col("period_start") < F.lit(fx.SPLIT.isoformat(sep=" ")).cast("timestamp")
    with fx.state_tables(spark) as tables:
        tables.create("history", history.schema)
        tables.append("history", history.filter(early))
        tables.append("history", history.filter(~early).withColumn("grain", F.lit("hourly")))
        return fx.stored(spark, shown(tables.read("history")))


@query
def state_overwrite(spark, sf_dir):
    with fx.state_tables(spark) as tables:
        tables.overwrite(state.METRICS, fx.event_metrics(spark, sf_dir))
        tables.overwrite(state.METRICS, baseline.metric_history(tables.read(state.METRICS), "row_count"))
        return fx.stored(spark, shown(tables.read(state.METRICS), *METRIC))


@query
def state_reset(spark, sf_dir):
    with fx.state_tables(spark) as tables:
        tables.create_all()
        tables.append(state.METRICS, fx.event_metrics(spark, sf_dir))
        tables.append(state.RULES, fx.feed_rules(spark, sf_dir))
        tables.reset(state.RESET_WORD)
        counts = [tables.read(t).agg(F.lit(t).alias("state_table"), F.count(F.lit(1)).alias("rows")) for t in state.SCHEMAS]
        return fx.stored(spark, reduce(DataFrame.unionByName, counts))


@query
def upsert_metrics(spark, sf_dir):
    target, source = fx.early_event_metrics(spark, sf_dir, "run-1"), fx.event_metrics(spark, sf_dir, "run-2")
    return shown(upsert(target, source, METRIC_KEYS, METRIC_UPDATES), "run_id", *METRIC)


@query
def upsert_update_only(spark, sf_dir):
    target, source = fx.early_event_metrics(spark, sf_dir, "run-1"), fx.event_metrics(spark, sf_dir, "run-2")
    return shown(upsert(target, source, METRIC_KEYS, METRIC_UPDATES, insert=False), "run_id", *METRIC)


@query
def upsert_into_empty(spark, sf_dir):
    with fx.state_tables(spark) as tables:
        tables.create(state.METRICS)
        tables.upsert(state.METRICS, fx.event_metrics(spark, sf_dir, "run-2"), METRIC_KEYS, METRIC_UPDATES)
        return fx.stored(spark, shown(tables.read(state.METRICS), "run_id", *METRIC))
