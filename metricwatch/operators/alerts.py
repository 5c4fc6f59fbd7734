"""Alert tables: what to send where, the digest, and folding outcomes back.

Nothing is sent from here. The outbox and digest frames hold everything a sender needs, and the sender
reports outcomes as rows.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import digest_of, html_text, literal, moment, or_dash, severity_rank, time_text
from metricwatch.operators.anomaly_log import pending_anomalies
from metricwatch.operators.rules import channels_for
from metricwatch.operators.upsert import upsert
from metricwatch.specs import ALERT_SCHEMA, OUTBOX_SCHEMA

# Outcomes in the alert log, and the state of an alert waiting for its sender.
SENT, FAILED, SKIPPED, PENDING = "SENT", "FAILED", "SKIPPED", "PENDING"
# Fixed value: the channel that digests apply to, and the one that takes marked-up text.
EMAIL, SLACK = "email", "slack"

# Labels of the digest's columns, and the anomaly column behind each.
DIGEST_COLUMNS = {
    "Severity": "severity",
    "Table": "table_name",
    "Column": "column_name",
    "Anomaly Type": "anomaly_type",
    "Metric": "metric_name",
    "Detected Value": "detected_value",
    "Baseline Value": "baseline_value",
    "Message": "message",
    "Detected At": "detected_at",
}
# Labels of the rows of a single mail, and the anomaly column behind each.
MAIL_ROWS = {
    "Table": "table_name",
    "Column": "column_name",
    "Anomaly Type": "anomaly_type",
    "Severity": "severity",
    "Metric": "metric_name",
    "Detected Value": "detected_value",
    "Baseline Value": "baseline_value",
    "Threshold": "threshold_used",
    "Period": "period_start",
    "Message": "message",
    "Detected At": "detected_at",
}


@dataclass(frozen=True)
class AlertSettings:
    """Where alerts go and what they say. Templates name their fields in braces."""

    routing: Mapping[str, Sequence[str]]
    enabled_channels: Collection[str]
    send_digest: bool = True
    dedupe: bool = True
    # The default subject formats.
    subject_template: str = "[{severity}] Anomaly Alert - {anomaly_type} detected in {table_name}"
    digest_subject_template: str = "[Anomaly Digest] {count} anomalies detected - {run_date}"
    recipients: Sequence[str] = ()
    cc: Sequence[str] = ()
    chat_targets: Mapping[str, str] = field(default_factory=dict)  # the room of each chat channel

    @property
    def digests_mail(self) -> bool:
        return self.send_digest and EMAIL in self.enabled_channels

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> AlertSettings:
        """Read the sections ``severity_routing`` and ``alerting`` of a loaded config."""
        alerting = config["alerting"]
        mail = alerting.get(EMAIL, {})
        channels = [name for name, section in alerting.items() if isinstance(section, Mapping) and section.get("enabled")]
        texts = {key: mail[key] for key in ("subject_template", "digest_subject_template") if key in mail}
        return cls(
            routing=config["severity_routing"],
            enabled_channels=frozenset(channels),
            send_digest=bool(mail.get("send_digest")),
            dedupe=alerting.get("dedupe_alerts", True),
            recipients=tuple(mail.get("recipients", ())),
            cc=tuple(mail.get("cc", ())),
            chat_targets={name: s["channel"] for name, s in alerting.items() if isinstance(s, Mapping) and s.get("channel")},
            **texts,
        )


def fill_fields(template: str, fields: Mapping[str, Column]) -> Column:
    """A template as a column, with each ``{name}`` replaced by that field's text."""
    filled = F.lit(template)
    for name, value in fields.items():
        filled = F.replace(filled, F.lit("{" + name + "}"), value.cast("string"))
    return filled


def field_text(column: str) -> str:
    """SQL: an anomaly's field as shown to people, safe inside HTML."""
    return html_text(or_dash(time_text(column) if column in ("period_start", "detected_at") else column))


def subject_of(template: str) -> Column:
    names = ("severity", "anomaly_type", "table_name")
    return fill_fields(template, {name: F.col(name) for name in names})


def mail_body() -> Column:
    """An anomaly as a small HTML table."""
    rows = ", ".join(f"'<tr><th>{label}</th><td>', {field_text(c)}, '</td></tr>'" for label, c in MAIL_ROWS.items())
    return F.expr(f"concat('<h3>Anomaly Detected</h3><table>', {rows}, '</table>')")


def route(anomalies: DataFrame, settings: AlertSettings) -> DataFrame:
    """One row per anomaly and channel its severity is routed to."""
    return anomalies.withColumn("channel", F.explode(channels_for(F.col("severity"), settings.routing)))


def unrouted(anomalies: DataFrame, settings: AlertSettings) -> DataFrame:
    """Anomalies whose severity leads to no channel."""
    channels = channels_for(F.col("severity"), settings.routing)
    return anomalies.filter(channels.isNull() | (F.size(channels) == 0))


def alert_outbox(log: DataFrame, settings: AlertSettings, run_id: str) -> DataFrame:
    """One row per pending anomaly and channel, ready to send.

    Rows of channels that are off or unknown are SKIPPED and say why. Mails that go out in the digest are
    flagged and carry no text of their own.
    """
    channel = F.col("channel")
    on = channel.isin(*settings.enabled_channels)
    in_digest = (channel == EMAIL) & F.lit(settings.digests_mail)
    subject = subject_of(settings.subject_template)
    text = (
        F.when(channel == EMAIL, mail_body())
        .when(channel == SLACK, F.concat(F.lit("*"), subject, F.lit("*\n"), F.col("message")))
        .otherwise(F.col("message"))
    )
    # Fixed value: why a row was skipped.
    reason = F.concat(F.lit("Channel '"), channel, F.lit("' disabled in config"))
    single = on & ~in_digest
    return (
        route(pending_anomalies(log, settings.dedupe), settings)
        .withColumns(
            {
                "alert_id": digest_of(literal(run_id), "anomaly_id", "channel"),
                "run_id": F.lit(run_id),
                "status": F.when(on, PENDING).otherwise(SKIPPED),
                "error_message": F.when(~on, reason),
                "in_digest": in_digest,
                "subject": F.when(single, subject),
                "body": F.when(single, text),
            }
        )
        .select(*OUTBOX_SCHEMA.names)
    )


def addressed(outbox: DataFrame, settings: AlertSettings) -> DataFrame:
    """The outbox with who gets each alert: ``recipients`` and ``cc`` of mails, and the room, ``target``, of chats."""

    def listed(names: Sequence[str]) -> Column:
        return F.array(*map(F.lit, names)).cast("array<string>")

    channel, target = F.col("channel"), F.lit(None).cast("string")
    for name, room in settings.chat_targets.items():
        target = F.when(channel == name, room).otherwise(target)
    return outbox.withColumns(
        {
            "recipients": F.when(channel == EMAIL, listed(settings.recipients)),
            "cc": F.when(channel == EMAIL, listed(settings.cc)),
            "target": target,
        }
    )


def digest_anomalies(log: DataFrame, settings: AlertSettings) -> DataFrame:
    """Pending anomalies that go out in the mail digest."""
    if not settings.digests_mail:
        return log.limit(0)
    channels = channels_for(F.col("severity"), settings.routing)
    return pending_anomalies(log, settings.dedupe).filter(F.array_contains(channels, EMAIL))


def digest_rows(log: DataFrame, settings: AlertSettings) -> DataFrame:
    """The digest's rows, most urgent first."""
    ranked = digest_anomalies(log, settings).orderBy(severity_rank(), "severity", "anomaly_id")
    dashed = ("column_name", "metric_name")
    return ranked.select(
        *(F.expr(or_dash(c) if c in dashed else c).alias(label) for label, c in DIGEST_COLUMNS.items())
    )


def digest_summary(log: DataFrame, settings: AlertSettings, as_of: datetime | str) -> DataFrame:
    """The digest's head as one row: subject, number of anomalies, counts per severity and opening line.

    No row when there is nothing to send.
    """
    per_severity = digest_anomalies(log, settings).groupBy("severity").agg(F.count(F.lit(1)).alias("n"))
    # One small struct per distinct severity.
    ranked = F.sort_array(F.collect_list(F.struct(severity_rank().alias("rank"), "severity", "n")))
    parts = F.transform(ranked, lambda s: F.concat_ws(" ", s["n"].cast("string"), s["severity"]))
    head = per_severity.agg(F.sum("n").alias("anomalies"), F.array_join(parts, ", ").alias("severity_summary"))
    fields = {"count": F.col("anomalies"), "run_date": F.date_format(moment(as_of), "yyyy-MM-dd")}
    return head.filter(F.col("anomalies").isNotNull()).select(
        "anomalies",
        "severity_summary",
        fill_fields(settings.digest_subject_template, fields).alias("subject"),
        # Fixed value: the digest's opening line.
        fill_fields(
            "<h3>Anomaly Digest</h3><p>{n} anomaly(ies) detected in this run ({summary}).</p>",
            {"n": F.col("anomalies"), "summary": F.expr(html_text("severity_summary"))},
        ).alias("opening"),
    )


def digest_html(log: DataFrame, settings: AlertSettings, as_of: datetime | str) -> DataFrame:
    """The digest as HTML, one line per row: opening, table head, one line per anomaly, table end.

    Joining the lines by ``section``, ``rank`` and ``line_id`` gives the document. It stays a distributed
    frame, so that a run with very many anomalies never builds one long text; ``ordered_html`` sorts it for
    writing as text files.
    """
    heads = "".join(f"<th>{label}</th>" for label in DIGEST_COLUMNS)
    cells = ", ".join(f"'<td>', {field_text(c)}, '</td>'" for c in DIGEST_COLUMNS.values())

    def line(section: int, html: Column) -> list[Column]:
        return [F.lit(section).alias("section"), F.lit(0).alias("rank"), F.lit("").alias("line_id"), html.alias("html")]

    summary = digest_summary(log, settings, as_of)
    body = digest_anomalies(log, settings).select(
        F.lit(2).alias("section"),
        severity_rank().alias("rank"),
        F.col("anomaly_id").alias("line_id"),
        F.expr(f"concat('<tr>', {cells}, '</tr>')").alias("html"),
    )
    frame = F.array(
        F.struct(*line(0, F.col("opening"))),
        F.struct(*line(1, F.lit(f"<table><thead><tr>{heads}</tr></thead><tbody>"))),
        F.struct(*line(3, F.lit("</tbody></table>"))),
    )
    return summary.select(F.inline(frame)).unionByName(body)


def ordered_html(digest: DataFrame) -> DataFrame:
    """The digest's lines in reading order, as one text column."""
    return digest.orderBy("section", "rank", "line_id").select("html")


def alert_log(outbox: DataFrame, outcomes: DataFrame, digest: tuple[str, str | None] | None, sent_at: datetime | str) -> DataFrame:
    """One row per anomaly and channel that was sent, failed or skipped.

    ``outcomes`` has a row per single alert: ``alert_id, status, error_message``. If an alert is reported
    more than once, it counts as sent when any report says so. ``digest`` is the one outcome, status and
    error, of the whole digest and holds for each of its rows; it is part of the plan, so a digest of any
    size needs no join on one key. Alerts without an outcome yet are left out.
    """
    best = F.max(F.struct((F.col("status") == SENT).alias("sent"), "status", "error_message"))
    reported = (
        outcomes.groupBy("alert_id")
        .agg(best.alias("_best"))
        .select("alert_id", F.struct("_best.status", "_best.error_message").alias("_outcome"))
    )
    status, error = digest if digest else (None, None)
    of_digest = F.struct(F.lit(status).cast("string").alias("status"), F.lit(error).cast("string").alias("error_message"))
    skipped = F.struct("status", "error_message")
    single = outbox.filter((F.col("status") == PENDING) & ~F.col("in_digest"))
    decided = outbox.filter((F.col("status") == SKIPPED) | F.col("in_digest")).withColumn(
        "_outcome", F.when(F.col("status") == SKIPPED, skipped).otherwise(of_digest)
    )
    keys = ["alert_id", "anomaly_id", "channel", "_outcome"]
    rows = decided.select(*keys).unionByName(single.join(reported, "alert_id").select(*keys))
    return (
        rows.filter(F.col("_outcome.status").isNotNull())
        .select("alert_id", "anomaly_id", "channel", "_outcome.status", "_outcome.error_message", moment(sent_at).alias("sent_at"))
        .select(*ALERT_SCHEMA.names)
    )


def alerted_flags(alerts: DataFrame) -> DataFrame:
    """Anomalies that reached at least one channel."""
    return (
        alerts.groupBy("anomaly_id")
        .agg(F.bool_or(F.col("status") == SENT).alias("alerted"))
        .filter("alerted")
    )


def mark_alerted(log: DataFrame, alerts: DataFrame) -> DataFrame:
    """The anomaly log with ``alerted`` set where any channel succeeded. Other rows stay as they are."""
    return upsert(log, alerted_flags(alerts), ["anomaly_id"], ["alerted"], insert=False)
