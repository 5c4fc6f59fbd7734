from dataclasses import replace

import pytest
from helpers import START, TABLE
from pyspark.sql import functions as F

from metricwatch import AlertSettings, Rule, rules_frame
from metricwatch.operators import alerts
from metricwatch.operators import rules as rule_ops
from metricwatch.plans import runs
from metricwatch.sources import state
from metricwatch.sources.tables import ensure_schema
from metricwatch.specs import ANOMALY_SCHEMA, RULES_SCHEMA, rules_from_config

SETTINGS = AlertSettings(
    routing={"CRITICAL": ["email", "teams"], "HIGH": ["email", "slack"], "LOW": ["pager"], "MUTED": []},
    enabled_channels=frozenset({"email", "slack"}),
    send_digest=False,
)
SEVERITIES = ("CRITICAL", "HIGH", "HIGH", "LOW", "MUTED", "odd")


def log(spark):
    rows = [
        (
            f"id{n}", "run", TABLE, None if n == 0 else "a<b", "value_anomaly", severity, START, "amount",
            float(n), None, "x > 1 & y", f"Value {n} <odd>", START, False,
        )
        for n, severity in enumerate(SEVERITIES)
    ]
    return spark.createDataFrame(rows, ANOMALY_SCHEMA)


def test_outbox(spark):
    outbox = alerts.alert_outbox(log(spark), SETTINGS, "r").collect()
    assert sorted((r.anomaly_id, r.channel, r.status) for r in outbox) == [
        ("id0", "email", "PENDING"),
        ("id0", "teams", "SKIPPED"),
        ("id1", "email", "PENDING"),
        ("id1", "slack", "PENDING"),
        ("id2", "email", "PENDING"),
        ("id2", "slack", "PENDING"),
        ("id3", "pager", "SKIPPED"),
    ]
    assert len({r.alert_id for r in outbox}) == 7
    text = {(r.anomaly_id, r.channel): r for r in outbox}
    assert text["id0", "teams"].error_message == "Channel 'teams' disabled in config"
    assert text["id0", "teams"].subject is None and text["id0", "teams"].body is None
    assert text["id1", "email"].subject == f"[HIGH] Anomaly Alert - value_anomaly detected in {TABLE}"
    assert text["id1", "slack"].body == f"*[HIGH] Anomaly Alert - value_anomaly detected in {TABLE}*\nValue 1 <odd>"
    body = text["id1", "email"].body
    assert "<th>Column</th><td>a&lt;b</td>" in body and "<td>x &gt; 1 &amp; y</td>" in body
    assert "<th>Baseline Value</th><td>-</td>" in body and "<td>2024-01-01 00:00:00</td>" in body
    assert body.count("<tr>") == 11
    assert "<th>Column</th><td>-</td>" in text["id0", "email"].body


def test_unrouted(spark):
    assert {r.anomaly_id for r in alerts.unrouted(log(spark), SETTINGS).collect()} == {"id4", "id5"}
    assert alerts.unrouted(log(spark), replace(SETTINGS, routing={})).count() == 6


def test_digest(spark):
    settings = replace(SETTINGS, send_digest=True)
    outbox = alerts.alert_outbox(log(spark), settings, "r")
    mails = outbox.filter("channel = 'email'").collect()
    assert {(r.in_digest, r.status, r.body) for r in mails} == {(True, "PENDING", None)}
    (head,) = alerts.digest_summary(log(spark), settings, "2024-03-04 05:00:00").collect()
    assert (head.anomalies, head.severity_summary) == (3, "1 CRITICAL, 2 HIGH")
    assert head.subject == "[Anomaly Digest] 3 anomalies detected - 2024-03-04"
    rows = alerts.digest_rows(log(spark), settings)
    assert rows.columns == list(alerts.DIGEST_COLUMNS)
    assert [(r["Severity"], r["Column"]) for r in rows.collect()] == [("CRITICAL", "-"), ("HIGH", "a<b"), ("HIGH", "a<b")]
    lines = [r.html for r in alerts.ordered_html(alerts.digest_html(log(spark), settings, START)).collect()]
    assert lines[0].startswith("<h3>Anomaly Digest</h3><p>3 anomaly(ies) detected in this run (1 CRITICAL, 2 HIGH)")
    assert lines[1].startswith("<table>") and lines[-1] == "</tbody></table>" and len(lines) == 6
    assert [line[8:12] for line in lines[2:5]] == ["CRIT", "HIGH", "HIGH"]


def test_no_digest_when_mail_is_off(spark):
    settings = replace(SETTINGS, send_digest=True, enabled_channels=frozenset({"slack"}))
    assert alerts.digest_html(log(spark), settings, START).count() == 0
    assert alerts.alert_outbox(log(spark), settings, "r").filter("channel = 'email' AND status = 'SKIPPED'").count() == 3


def test_alerted_when_any_channel_got_through(spark):
    outbox = alerts.alert_outbox(log(spark), SETTINGS, "r")
    status = F.when((F.col("anomaly_id") == "id1") & (F.col("channel") == "slack"), "SENT").otherwise("FAILED")
    outcomes = outbox.filter("status = 'PENDING' AND anomaly_id != 'id2'").select(
        "alert_id", status.alias("status"), F.lit("why").alias("error_message")
    )
    # A second, failed report of the same alert does not undo the first.
    outcomes = outcomes.unionByName(outcomes.withColumn("status", F.lit("FAILED")))
    logged = alerts.alert_log(outbox, outcomes, None, START)
    assert sorted((r.anomaly_id, r.channel, r.status) for r in logged.collect()) == [
        ("id0", "email", "FAILED"),
        ("id0", "teams", "SKIPPED"),
        ("id1", "email", "FAILED"),
        ("id1", "slack", "SENT"),
        ("id3", "pager", "SKIPPED"),
    ]
    marked = alerts.mark_alerted(log(spark), logged)
    assert {r.anomaly_id for r in marked.filter("alerted").collect()} == {"id1"}
    assert marked.drop("alerted").exceptAll(log(spark).drop("alerted")).count() == 0


def test_already_alerted_stays_so(spark):
    done = log(spark).withColumn("alerted", F.col("anomaly_id") == "id0")
    assert alerts.alert_outbox(done, SETTINGS, "r").filter("anomaly_id = 'id0'").count() == 0
    assert alerts.alert_outbox(done, replace(SETTINGS, dedupe=False), "r").filter("anomaly_id = 'id0'").count() == 2
    none = alerts.alert_log(alerts.alert_outbox(done, SETTINGS, "r"), spark.createDataFrame([], "alert_id string, status string, error_message string"), None, START)
    assert alerts.mark_alerted(done, none).filter("alerted").count() == 1


def test_settings_from_config():
    config = {
        "severity_routing": {"HIGH": ["email"]},
        "alerting": {"dedupe_alerts": False, "email": {"enabled": True, "send_digest": True}, "slack": {"enabled": False}},
    }
    got = AlertSettings.from_config(config)
    assert (got.enabled_channels, got.digests_mail, got.dedupe) == (frozenset({"email"}), True, False)
    assert AlertSettings.from_config({"severity_routing": {}, "alerting": {}}).dedupe is True


def test_rule_violations(spark):
    rules = [
        Rule("t", "sudden_increase", "HIGH"),
        Rule("t", "schema_drift", "HIGH"),
        Rule("t", "schema_drift", "HIGH", enabled=False),
        Rule("t", "stale_data", None),
        Rule("t", "value_anomaly", "odd"),
    ]
    got = {(r.anomaly_type, r.problem) for r in rule_ops.rule_violations(rules_frame(spark, rules), SETTINGS.routing).collect()}
    assert got == {
        ("schema_drift", "unknown anomaly type"),
        ("stale_data", "severity missing"),
        ("stale_data", "max_allowed_staleness_minutes missing"),
        ("sudden_increase", "metric missing"),
        ("sudden_increase", "threshold_pct missing"),
        ("value_anomaly", "severity has no route"),
        ("value_anomaly", "metric missing"),
        ("value_anomaly", "fixed_lower_threshold missing"),
        ("value_anomaly", "fixed_upper_threshold missing"),
    }


def test_rules_keep_their_payload(spark):
    config = {"anomaly_rules": {"stale_data": {"enabled": True, "severity": "LOW", "max_allowed_staleness_minutes": 5}}}
    (rule,) = rules_from_config(config, "t")
    frame = rules_frame(spark, [rule])
    assert frame.schema.names == RULES_SCHEMA.names
    assert Rule.from_row(frame.first().asDict()) == rule


def test_retiring_switches_detection_off(spark, tables, tmp_path):
    ensure_schema(spark, "live", str(tmp_path / "live"))
    spark.range(1).write.mode("overwrite").saveAsTable("live.sales")
    runs.set_up(tables, [Rule("live.sales", "stale_data", "LOW"), Rule("live.gone", "stale_data", "LOW")])
    existing = rule_ops.existing_tables(spark, "live")
    assert runs.run_retirement(tables, existing) == 1
    kept = rule_ops.enabled_rules(tables.read(state.RULES)).collect()
    assert [r.table_name for r in kept] == ["live.sales"]
    assert tables.read(state.RULES).count() == 2
    assert runs.run_retirement(tables, existing) == 0
    spark.sql("DROP TABLE live.sales")
