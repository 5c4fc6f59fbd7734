"""The scheduled runs: set up, compute metrics, detect, alert, record outcomes.

Each run makes its result once, by writing it, and later steps read what was written. So ids and times agree
everywhere, and a repeated run adds nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import moment
from metricwatch.operators import alerts
from metricwatch.operators import duplicates as dup
from metricwatch.operators.alerts import AlertSettings
from metricwatch.operators.anomaly_log import new_anomalies, pending_anomalies
from metricwatch.operators.detectors import detect, detect_missing_periods
from metricwatch.operators.metrics import compute_all, with_period
from metricwatch.operators.partials import PART_KEYS, batch_parts, merged_metrics
from metricwatch.operators.rules import missing_tables, retire_rules, sound_rules, value_rules
from metricwatch.sources import state
from metricwatch.sources.state import StateTables
from metricwatch.specs import (
    ALERT_SCHEMA,
    METRICS_SCHEMA,
    OUTBOX_SCHEMA,
    PARTS_SCHEMA,
    VALUE_ANOMALY,
    Rule,
    SourceSpec,
    metric_columns,
    rules_frame,
    source_fields,
)

METRIC_KEYS = ("table_name", "period_start", "metric_name")
METRIC_UPDATES = ("metric_value", "run_id", "computed_at")


def new_run_id() -> str:
    return str(uuid.uuid4())


def now() -> datetime:
    return datetime.now(timezone.utc)


def set_up(tables: StateTables, rules: Iterable[Rule]) -> int:
    """Create the state tables and replace the rules; returns the number of rules.

    A table has one rule of each type and metric, and any number of value rules; ``rule_violations`` checks what they say.
    """
    rules = list(rules)
    told_apart = [(r.table_name, r.anomaly_type, r.params.get("metric")) for r in rules if r.anomaly_type != VALUE_ANOMALY]
    if len(set(told_apart)) < len(told_apart):
        raise ValueError("more than one rule of a type for one table and metric")
    tables.create_all()
    return tables.overwrite(state.RULES, rules_frame(tables.spark, rules))


def run_metrics(
    tables: StateTables,
    sources: Iterable[tuple[DataFrame, SourceSpec]],
    run_id: str | None = None,
    as_of: datetime | str | None = None,
    since: datetime | str | None = None,
) -> int:
    """Compute metrics of all sources into the history; returns how many rows were computed.

    With ``since`` only the periods from there on are read from the sources, also for the duplicate count, whose older keys
    are kept; see ``duplicate_counts``. A run without it reads everything and starts that state over.
    """
    sources = list(sources)
    tables.create(state.METRICS)
    counts = duplicate_counts(tables, sources, since)
    metrics = compute_all(sources, run_id or new_run_id(), as_of or now(), since, duplicates=counts)
    return tables.upsert(state.METRICS, metrics, METRIC_KEYS, METRIC_UPDATES)


def run_batch(
    tables: StateTables,
    sources: Iterable[tuple[DataFrame, SourceSpec]],
    batch_id: str,
    run_id: str | None = None,
    as_of: datetime | str | None = None,
) -> int:
    """Add a batch of rows, late ones too, to the metrics of their periods; returns how many metrics changed.

    ``sources`` hold the rows of the batch only; earlier rows are not read again, as what each batch adds up to per period is
    kept. A batch that is repeated replaces itself. The duplicate count is that of whole tables: see ``run_metrics``.
    """
    sources = list(sources)
    tables.create(state.PARTS)
    tables.create(state.METRICS)
    parts = reduce(DataFrame.unionByName, [batch_parts(df, spec, batch_id) for df, spec in sources])
    tables.upsert(state.PARTS, parts.select(*PARTS_SCHEMA.names), PART_KEYS)
    periods = reduce(DataFrame.unionByName, [_periods(df, spec) for df, spec in sources])
    near = tables.read_near(state.PARTS, periods)
    of_batch = near.filter(F.col("batch_id") == batch_id).select("table_name", "period_start").distinct()
    of_batch = of_batch.select(F.col("table_name").alias("_table"), F.col("period_start").alias("_period"))
    same = (F.col("table_name") == F.col("_table")) & F.col("period_start").eqNullSafe(F.col("_period"))
    merged = merged_metrics(near.join(of_batch, same, "left_semi"))
    tagged = merged.withColumns({"run_id": F.lit(run_id or new_run_id()), "computed_at": moment(as_of or now())})
    return tables.upsert(state.METRICS, tagged.select(*METRICS_SCHEMA.names), METRIC_KEYS, METRIC_UPDATES)


def _periods(df: DataFrame, spec: SourceSpec) -> DataFrame:
    return with_period(df, spec).select(F.lit(spec.table_name).alias("table_name"), "period_start").distinct()


def duplicate_counts(
    tables: StateTables, sources: Iterable[tuple[DataFrame, SourceSpec]], since: datetime | str | None
) -> dict[str, DataFrame]:
    """The duplicate count of each table with business keys, from the keys seen before ``since`` and the rows from there on.

    The first run, and one whose ``since`` lies before the kept cut, reads the older rows once; later ones read only those
    between the kept cut and ``since``, and the rows from ``since`` on. Keys are appended before the totals that vouch for
    them, and only vouched keys count as seen, so a run cut short in between is repeated without harm. Without
    ``since`` the state is forgotten and nothing is returned.
    """
    tables.create(state.SEEN_KEYS)
    tables.create(state.KEY_TOTALS)
    found = {}
    for df, spec in sources:
        if not spec.duplicate_key_columns:
            continue
        own = F.col("table_name") == spec.table_name
        if since is None:
            tables.drop_partitions(state.KEY_TOTALS, own)
            tables.drop_partitions(state.SEEN_KEYS, own)
            continue
        cut = dup.cut_at(spec, since)
        # One row: the totals of the latest cut that isn't past this one.
        kept = tables.read_partitions(state.KEY_TOTALS, own).filter(F.col("until") <= cut)
        kept = kept.orderBy(F.desc("until"), F.desc("recorded_at")).withColumn("behind", F.col("until") < cut).first()
        if kept is None:
            tables.drop_partitions(state.KEY_TOTALS, own)
            tables.drop_partitions(state.SEEN_KEYS, own)
        generation = kept.generation if kept else uuid.uuid4().hex
        begin = F.lit(kept.until) if kept else None
        of_generation = own & (F.col("generation") == generation)

        def seen(until: Column | None) -> DataFrame:
            rows = tables.read_partitions(state.SEEN_KEYS, of_generation)  # noqa: B023
            return rows.filter(F.lit(False) if until is None else F.col("until") <= until)

        totals = (kept.rows, kept.keys, kept.latest) if kept else (0, 0, None)
        if kept is None or kept.behind:
            between = dup.per_key(dup.rows_between(df, spec, begin, cut), spec)
            fresh = between.join(seen(begin).select(*dup.KEY), list(dup.KEY), "left_anti")
            named = {"table_name": F.lit(spec.table_name), "generation": F.lit(generation), "until": cut}
            tables.append(state.SEEN_KEYS, fresh.select(*dup.KEY).withColumns(named))
            moved = dup.totals_with(between, seen(begin), *totals).withColumns({**named, "recorded_at": moment(now())})
            tables.append(state.KEY_TOTALS, moved)
            kept = tables.read_partitions(state.KEY_TOTALS, own).filter(F.col("until") == cut).orderBy(F.desc("recorded_at")).first()
            totals = (kept.rows, kept.keys, kept.latest)
        latest = dup.per_key(dup.rows_between(df, spec, cut, None), spec)
        found[spec.table_name] = dup.as_metric(dup.totals_with(latest, seen(cut), *totals), spec)
    return found


def run_detection(
    tables: StateTables,
    sources: Iterable[tuple[DataFrame, SourceSpec]],
    run_id: str | None = None,
    as_of: datetime | str | None = None,
    window: int = 24,
    min_history: int = 5,
    find_missing_periods: bool = False,
    since: datetime | str | None = None,
) -> DataFrame:
    """Log the anomalies that are not logged yet; returns the rows this run added.

    Rules that cannot work on these tables are left out; ``rule_violations`` lists them. With ``since`` the value rules read only the sources' periods from there on.
    """
    sources, run_id, as_of = list(sources), run_id or new_run_id(), as_of or now()
    tables.create(state.ANOMALIES)
    metrics, specs = tables.read(state.METRICS), [spec for _, spec in sources]
    known = metric_columns(tables.spark, specs), source_fields(tables.spark, sources)
    rules = sound_rules(tables.read(state.RULES), *known)
    values = value_rules(rules, [spec.table_name for spec in specs])
    hits = detect(metrics, sources, rules, values, as_of, run_id, window, min_history, since)
    if find_missing_periods:
        hits = hits.unionByName(detect_missing_periods(metrics, rules, specs, as_of, run_id))
    tables.append(state.ANOMALIES, new_anomalies(hits, tables.read(state.ANOMALIES)))
    return tables.read(state.ANOMALIES).filter(F.col("run_id") == run_id)


def run_alerting(
    tables: StateTables,
    settings: AlertSettings,
    run_id: str | None = None,
    retry_open: bool = False,
    as_of: datetime | str | None = None,
    look_back_days: int | None = None,
) -> DataFrame:
    """Write the outbox of this run; returns its rows for the sender. A repeated run adds no alert twice.

    Anomalies with an alert of an earlier run whose outcome isn't recorded yet are left out, unless ``retry_open``.
    With ``look_back_days`` only the partitions of so many days before ``as_of`` are read, of anomalies and of earlier
    alerts; what is still pending from before that is no longer alerted.
    """
    run_id, as_of = run_id or new_run_id(), moment(as_of or now())
    for table in (state.OUTBOX, state.ALERTS, state.MARKS):
        tables.create(table)
    emitted = F.date_format(as_of, "yyyy-MM-dd")
    log, others = tables.read(state.ANOMALIES), F.col("run_id") != run_id
    if look_back_days is not None:
        first = F.date_format(F.date_sub(as_of.cast("date"), look_back_days), "yyyy-MM-dd")
        recent = tables.read_partitions(state.ANOMALIES, F.col("detected_date") >= first)
        marked = tables.read(state.MARKS)
        log = recent.filter("NOT alerted").join(marked, "anomaly_id", "left_anti") if settings.dedupe else recent
        others = others & (F.col("emitted_date") >= first)
    if not retry_open:
        earlier = tables.read_partitions(state.OUTBOX, others).filter(F.col("status") == alerts.PENDING)
        recorded = tables.read_partitions(state.ALERTS, others).select("alert_id")
        still_open = earlier.join(recorded, "alert_id", "left_anti")
        log = log.join(still_open.select("anomaly_id"), "anomaly_id", "left_anti")
    outbox = alerts.alert_outbox(log, settings, run_id)
    of_run = F.col("run_id") == run_id
    listed = tables.read_partitions(state.OUTBOX, of_run).select("alert_id")
    fresh = outbox.join(listed, "alert_id", "left_anti").select(*OUTBOX_SCHEMA.names)
    tables.append(state.OUTBOX, fresh.withColumn("emitted_date", emitted))
    return tables.read_partitions(state.OUTBOX, of_run)


def digest_of_run(tables: StateTables, run_id: str) -> DataFrame:
    """The anomalies that an alerting run put in its digest."""
    listed = tables.read_partitions(state.OUTBOX, F.col("run_id") == run_id).filter("in_digest")
    return tables.read(state.ANOMALIES).join(listed.select("anomaly_id").distinct(), "anomaly_id", "left_semi")


def store_digest(tables: StateTables, settings: AlertSettings, run_id: str, as_of: datetime | str | None = None) -> DataFrame:
    """Keep the digest of an alerting run as lines of HTML, for its sender and for later; returns them.

    A repeated run has its digest once. Lines of other runs are neither read nor written.
    """
    tables.create(state.DIGESTS)
    # What the run put in its digest stays in it, also once it was sent.
    lines = alerts.digest_html(digest_of_run(tables, run_id), replace(settings, dedupe=False), as_of or now())
    tables.upsert(state.DIGESTS, lines.withColumn("run_id", F.lit(run_id)), ("run_id", "section", "rank", "line_id"), ("html",))
    return tables.read_partitions(state.DIGESTS, F.col("run_id") == run_id)


def record_outcomes(
    tables: StateTables,
    run_id: str,
    outcomes: DataFrame,
    digest: tuple[str, str | None] | None = None,
    sent_at: datetime | str | None = None,
    fold_at: int = 1_000_000,
) -> DataFrame:
    """Log what became of a run's alerts and mark the anomalies that got through; returns the logged rows.

    Only the run's own partitions of outbox and alert log are read, and what is written is the run's own outcomes and marks.
    Marks are folded into the anomaly log once there are ``fold_at`` of them.
    """
    tables.create(state.ALERTS)
    tables.create(state.MARKS)
    of_run, sent_at = F.col("run_id") == run_id, sent_at or now()
    day = F.date_format(moment(sent_at), "yyyy-MM-dd")
    outbox = tables.read_partitions(state.OUTBOX, of_run)
    logged = alerts.alert_log(outbox, outcomes, digest, sent_at)
    # An outcome that was recorded before, by a run that then failed, is not recorded again.
    known = tables.read_partitions(state.ALERTS, of_run).select("alert_id", "status")
    fresh = logged.join(known, ["alert_id", "status"], "left_anti").select(*ALERT_SCHEMA.names)
    tables.append(state.ALERTS, fresh.withColumns({"emitted_date": day, "run_id": F.lit(run_id)}))
    recorded = tables.read_partitions(state.ALERTS, of_run)
    marks = alerts.alerted_flags(recorded).select("anomaly_id")
    new = marks.join(tables.read(state.MARKS), "anomaly_id", "left_anti")
    tables.append(state.MARKS, new.withColumn("marked_date", day))
    tables.fold_marks(fold_at)
    return recorded


def run_retirement(tables: StateTables, existing: DataFrame) -> int:
    """Switch off the rules of tables that no longer exist; returns how many tables that were."""
    rules = tables.read(state.RULES)
    missing = missing_tables(rules.filter("enabled"), existing).count()
    if missing:
        tables.overwrite(state.RULES, retire_rules(rules, existing))
    return missing


def pending(tables: StateTables, settings: AlertSettings) -> DataFrame:
    return pending_anomalies(tables.read(state.ANOMALIES), settings.dedupe)

