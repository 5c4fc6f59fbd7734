"""For each registered query, SQL that gives the same result on the same tables.

The SQL states the semantics on its own: it is built from named steps, each a common table expression, and
uses none of the operators' code.
"""

from __future__ import annotations

SPLIT = "TIMESTAMP '2024-01-15 00:00:00'"
AS_OF = "TIMESTAMP '2024-02-01 00:00:00'"

STEPS: dict[str, tuple[str, tuple[str, ...]]] = {}


def step(name: str, sql: str, *needs: str) -> str:
    STEPS[name] = (sql, needs)
    return name


def sql(body: str, *needs: str) -> str:
    """A query with the steps it needs in front, each once and in order."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name not in order:
            for inner in STEPS[name][1]:
                visit(inner)
            order.append(name)

    for name in needs:
        visit(name)
    steps = ",\n".join(f"{name} AS ({STEPS[name][0]})" for name in order)
    return f"WITH {steps}\n{body}" if steps else body


# Watched tables


step(
    "ev",
    """SELECT event_id, ts AS event_time, user_id, event_type, value, CAST(value AS DECIMAL(18,2)) AS amount,
    CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS activity_count,
    CASE WHEN event_type <> 'error' THEN user_id END AS actor_null,
    CASE WHEN event_type = 'signup' THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS actor_blank,
    ts + INTERVAL 10 MINUTE AS ingestion_time FROM events""",
)
step("ev_early", f"SELECT * FROM ev WHERE event_time < {SPLIT}", "ev")
step("ev_recent", f"SELECT * FROM ev WHERE event_time >= {SPLIT}", "ev")
step("od", "SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders")
step(
    "li",
    "SELECT *, l_extendedprice AS price, l_quantity AS quantity FROM lineitem",
)


# Metrics


def numbers(column: str) -> dict[str, str]:
    return {
        f"sum_{column}": f"CAST(sum({column}) AS DOUBLE)",
        f"avg_{column}": f"CAST(sum({column}) AS DOUBLE) / count({column})",
        f"stddev_{column}": f"stddev_samp(CAST({column} AS DOUBLE))",
        f"min_{column}": f"CAST(min({column}) AS DOUBLE)",
        f"max_{column}": f"CAST(max({column}) AS DOUBLE)",
    }


def nulls(column: str) -> str:
    return f"CAST(sum(CASE WHEN {column} IS NULL OR trim(CAST({column} AS VARCHAR)) = '' THEN 1 ELSE 0 END) AS BIGINT)"


def null_ratio(column: str) -> dict[str, str]:
    return {f"null_ratio_{column}": f"CAST({nulls(column)} AS DOUBLE) / count(*)"}


ROWS = {"row_count": "CAST(count(*) AS DOUBLE)"}
FRESH = {"last_updated_epoch": "epoch_us(max(ingestion_time)) / 1000000.0::DOUBLE"}
EVENT_METRICS = {
    **ROWS,
    **numbers("amount"),
    **numbers("activity_count"),
    **null_ratio("actor_null"),
    **null_ratio("actor_blank"),
    **FRESH,
}
ORDER_METRICS = {**ROWS, **numbers("price"), **null_ratio("o_orderpriority")}
LINE_METRICS = {**ROWS, **numbers("price"), **numbers("quantity"), **null_ratio("l_returnflag"), **null_ratio("l_partkey")}


def metric_steps(prefix: str, source: str, table: str, unit: str, time: str, metrics: dict[str, str], keys: str | None) -> str:
    columns = ", ".join(f"{sql_} AS {name}" for name, sql_ in metrics.items())
    wide = step(
        f"{prefix}_wide", f"SELECT date_trunc('{unit}', {time}) AS period_start, {columns} FROM {source} GROUP BY 1", source
    )
    long = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, period_start, '{name}' AS metric_name, {name} AS metric_value FROM {wide}"
        for name in metrics
    )
    needs = [wide]
    if keys:
        per_key = step(
            f"{prefix}_keys",
            f"SELECT {keys}, count(*) AS n, max(date_trunc('{unit}', {time})) AS latest FROM {source} GROUP BY {keys}",
            source,
        )
        long += (
            f" UNION ALL SELECT '{table}', max(latest), 'duplicate_count', CAST(sum(n - 1) AS DOUBLE)"
            f" FROM {per_key} HAVING count(*) > 0"
        )
        needs.append(per_key)
    return step(f"{prefix}_long", long, *needs)


EVENT_KEYS = "user_id, event_type"
metric_steps("ev", "ev", "events", "hour", "event_time", EVENT_METRICS, EVENT_KEYS)
metric_steps("early", "ev_early", "events", "hour", "event_time", EVENT_METRICS, EVENT_KEYS)
metric_steps("recent", "ev_recent", "events", "hour", "event_time", EVENT_METRICS, None)
step("ev_timed", "SELECT * FROM ev WHERE event_type <> 'error'", "ev")
metric_steps("timed", "ev_timed", "events", "hour", "event_time", {**ROWS, **numbers("amount")}, None)
metric_steps("od", "od", "orders", "day", "o_orderdate", ORDER_METRICS, "o_custkey, o_orderdate")
metric_steps("li", "li", "lineitem", "day", "l_shipdate", LINE_METRICS, "l_orderkey, l_linenumber")
step(
    "all_long",
    "SELECT * FROM ev_long UNION ALL SELECT * FROM od_long UNION ALL SELECT * FROM li_long",
    "ev_long",
    "od_long",
    "li_long",
)
step(
    "dup_rows",
    """SELECT date_trunc('hour', event_time) AS period_start,
    row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_time, event_id) > 1 AS again FROM ev""",
    "ev",
)
step(
    "dup_long",
    """SELECT 'events' AS table_name, period_start, 'duplicate_count' AS metric_name,
    CAST(sum(count(*) FILTER (again)) OVER (ORDER BY period_start) AS DOUBLE) AS metric_value
    FROM dup_rows GROUP BY period_start""",
    "dup_rows",
)

METRIC = "table_name, period_start, metric_name, round(metric_value, 6) AS metric_value"


# Baselines


def baseline(history: str) -> str:
    return step(
        f"{history}_base",
        f"""SELECT *, CASE WHEN baseline_median <> 0
            THEN (metric_value - baseline_median) / abs(baseline_median) * 100 END AS pct_change
        FROM (SELECT *, lag(metric_value) OVER s AS previous_value,
            quantile_disc(metric_value, 0.5) OVER t AS baseline_median,
            count(metric_value) OVER t AS history_count FROM {history}
            WINDOW s AS (PARTITION BY table_name, metric_name ORDER BY period_start),
            t AS (PARTITION BY table_name, metric_name ORDER BY period_start
                ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""",
        history,
    )


for name in ("ev_long", "early_long", "all_long", "dup_long", "timed_long"):
    baseline(name)


# Detectors


def hits(base: str, table: str, kind: str, severity: str, column: str, where: str, threshold: str, message: str, baseline_value: str = "baseline_median") -> str:
    return f"""SELECT '{table}' AS table_name, {column} AS column_name, '{kind}' AS anomaly_type,
    '{severity}' AS severity, period_start, metric_name, metric_value AS detected_value,
    {baseline_value} AS baseline_value, '{threshold}' AS threshold_used, {message} AS message,
    CAST(NULL AS VARCHAR) AS row_id FROM {base} WHERE table_name = '{table}' AND {where}"""


def trend(base: str, table: str, up: bool, severity: str, metric: str, limit: str, column: str) -> str:
    sign, word = (">=", "above") if up else ("<=", "below")
    kind = "increase" if up else "decrease"
    return hits(
        base,
        table,
        f"sudden_{kind}",
        severity,
        column,
        f"metric_name = '{metric}' AND history_count >= 5 AND pct_change {sign} {limit}",
        f"pct_change_vs_rolling_median {sign} {limit}% (trailing 24 periods, min history 5)",
        f"'Sudden {kind}: {metric} is ' || CAST(round(pct_change, 1) AS VARCHAR) ||"
        f" '% {word} its trailing 24-period median (threshold {limit}%)'",
    )


def spike(base: str, kind: str, names: str, floor: str, column: str, what: str, message: str) -> str:
    return hits(
        base,
        "events",
        kind,
        "MEDIUM",
        column,
        f"{names} AND metric_value >= {floor} AND (history_count < 5"
        " OR (baseline_median = 0 AND metric_value > 0) OR pct_change >= 100.0)",
        f"{what} >= {floor}, and pct_change_vs_rolling_median >= 100.0% once 5+ periods of"
        " trailing 24-period history exist",
        message,
    )


def zero(base: str, extra: str = "") -> str:
    return hits(
        base,
        "events",
        "missing_zero_activity",
        "HIGH",
        "'activity_count'",
        f"metric_name = 'sum_activity_count' AND metric_value = 0{extra}",
        "sum_activity_count == 0",
        "'No activity detected for period (sum_activity_count = 0)'",
        "previous_value",
    )


def stale(history: str) -> str:
    return f"""SELECT 'events' AS table_name, 'ingestion_time' AS column_name, 'stale_data' AS anomaly_type,
    'MEDIUM' AS severity, period_start, 'last_updated_epoch' AS metric_name, minutes AS detected_value,
    180.0::DOUBLE AS baseline_value, 'staleness_minutes > 180' AS threshold_used,
    'Data is stale: last updated ' || CAST(round(minutes, 1) AS VARCHAR) || ' minutes ago (limit 180 min)' AS message,
    CAST(NULL AS VARCHAR) AS row_id
    FROM (SELECT max(period_start) AS period_start, (epoch({AS_OF}) - max(metric_value)) / 60 AS minutes
        FROM {history} WHERE table_name = 'events' AND metric_name = 'last_updated_epoch') WHERE minutes > 180"""


def value(source: str, table: str, severity: str, column: str, unit: str, time: str, row: str, where: str, note: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'value_anomaly' AS anomaly_type,
    '{severity}' AS severity, date_trunc('{unit}', {time}) AS period_start, '{column}' AS metric_name,
    {column} AS detected_value, CAST(NULL AS DOUBLE) AS baseline_value, '{note}' AS threshold_used,
    'Value anomaly on {column} = ' || CAST({column} AS VARCHAR) || ' ({note})' AS message,
    CAST({row} AS VARCHAR) AS row_id FROM {source} WHERE {where}"""


INCREASE = ("events", True, "HIGH", "sum_amount", "50.0", "'amount'")
DECREASE = ("events", False, "HIGH", "sum_amount", "-50.0", "'amount'")


def duplicates(base: str) -> str:
    text = "'Duplicate record spike: ' || CAST(metric_value AS VARCHAR) || ' duplicate row(s) detected'"
    return spike(base, "duplicate_record_anomaly", "metric_name = 'duplicate_count'", "1", "'user_id, event_type'", "duplicate_count", text)


def null_spikes(base: str) -> str:
    column = "substr(metric_name, 12)"
    text = (
        f"'Null/data-quality spike on ' || {column} || ': null ratio = '"
        " || CAST(round(metric_value * 100, 1) AS VARCHAR) || '%'"
    )
    return spike(base, "null_data_quality_spike", "metric_name LIKE 'null_ratio%'", "0.05", column, "null_ratio", text)


def event_values(source: str) -> str:
    where = "value > 200 OR value < 0"
    return value(source, "events", "CRITICAL", "value", "hour", "event_time", "event_id", where, "outside [0, 200]")


def event_hits(source: str, history: str) -> str:
    base = f"{history}_base"
    parts = [
        trend(base, *INCREASE),
        trend(base, *DECREASE),
        zero(base),
        stale(history),
        duplicates(base),
        null_spikes(base),
        event_values(source),
    ]
    return " UNION ALL ".join(parts)


OTHER_HITS = " UNION ALL ".join(
    [
        trend("all_long_base", "orders", True, "LOW", "sum_price", "100.0", "'price'"),
        trend("all_long_base", "orders", False, "MEDIUM", "row_count", "-60", "CAST(NULL AS VARCHAR)"),
        value(
            "od",
            "orders",
            "LOW",
            "o_totalprice",
            "day",
            "o_orderdate",
            "o_orderkey",
            "o_totalprice > 499000.5 OR o_totalprice < 1000",
            "outside [1000, 499000.5]",
        ),
        trend("all_long_base", "lineitem", False, "INFO", "sum_quantity", "-40.0", "'quantity'"),
    ]
)


def identified(body: str) -> str:
    part = "coalesce({}, '\\N')"
    parts = ["table_name", "column_name", "anomaly_type", "CAST(epoch_us(period_start) AS VARCHAR)", "metric_name"]
    shared = ", ".join(part.format(p) for p in parts)
    return f"""SELECT sha256(CASE WHEN row_id IS NULL THEN concat_ws('|', {shared})
        ELSE concat_ws('|', {shared}, CAST(detected_value AS VARCHAR), row_id) END) AS anomaly_id,
    * EXCLUDE (row_id, detected_value, baseline_value), detected_value AS raw_value, baseline_value AS raw_baseline,
    round(detected_value, 6) AS detected_value, round(baseline_value, 6) AS baseline_value FROM ({body})"""


step("ev_found", identified(event_hits("ev", "ev_long")), "ev", "ev_long_base", "ev_long")
step("early_found", identified(event_hits("ev_early", "early_long")), "ev_early", "early_long_base", "early_long")
step("found", identified(event_hits("ev", "all_long") + " UNION ALL " + OTHER_HITS), "ev", "od", "all_long_base", "all_long")
step("logged", "SELECT *, anomaly_type = 'sudden_decrease' AS alerted FROM found", "found")
step("pending", "SELECT * FROM logged WHERE NOT alerted", "logged")

HIT = "table_name, column_name, anomaly_type, severity, period_start, metric_name, detected_value, baseline_value, threshold_used"


def one(body: str, *needs: str) -> str:
    return sql(f"SELECT {HIT} FROM ({identified(body)})", *needs)


def z_hits() -> str:
    return f"""SELECT 'events' AS table_name, 'value' AS column_name, 'value_anomaly' AS anomaly_type,
    'CRITICAL' AS severity, date_trunc('hour', event_time) AS period_start, 'value' AS metric_name,
    value AS detected_value, round(m, 6) AS baseline_value, '|zscore| >= 3.0' AS threshold_used
    FROM ev, (SELECT avg(value) AS m, stddev_samp(value) AS d FROM ev) WHERE abs((value - m) / d) >= 3.0"""


# Zero runs: rows since the last one that was not zero.
step(
    "zero_runs",
    """SELECT * EXCLUDE (island), row_number() OVER (PARTITION BY island ORDER BY period_start) AS run
    FROM (SELECT *, row_number() OVER (ORDER BY period_start)
        - row_number() OVER (PARTITION BY metric_value = 0 ORDER BY period_start) AS island
        FROM ev_long_base WHERE metric_name = 'sum_activity_count') WHERE metric_value = 0""",
    "ev_long_base",
)
step(
    "feed_hours",
    """SELECT 'events_' || event_type AS table_name, date_trunc('hour', ts) AS period_start, count(*) AS n
    FROM events GROUP BY ALL""",
)
step(
    "calendar",
    """SELECT table_name, unnest(generate_series(min(period_start), max(period_start), INTERVAL 1 HOUR)) AS period_start
    FROM feed_hours GROUP BY table_name""",
    "feed_hours",
)


step(
    "expected_hours",
    f"""SELECT 'events_' || kind AS table_name, period_start
    FROM (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view'), ('refund')) AS k(kind),
    (SELECT unnest(generate_series(TIMESTAMP '2023-12-31 20:00:00', {AS_OF} - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS period_start)""",
)


# Alerts


def escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def cell(column: str) -> str:
    times = {"period_start": "strftime(period_start, '%Y-%m-%d %H:%M:%S')", "detected_at": "'2024-02-01 00:00:00'"}
    raw = {"detected_value": "raw_value", "baseline_value": "raw_baseline"}
    text = times.get(column, raw.get(column, column))
    return escaped(f"coalesce(nullif(CAST({text} AS VARCHAR), ''), '-')")


MAIL = [
    ("Table", "table_name"),
    ("Column", "column_name"),
    ("Anomaly Type", "anomaly_type"),
    ("Severity", "severity"),
    ("Metric", "metric_name"),
    ("Detected Value", "detected_value"),
    ("Baseline Value", "baseline_value"),
    ("Threshold", "threshold_used"),
    ("Period", "period_start"),
    ("Message", "message"),
    ("Detected At", "detected_at"),
]
DIGEST = [
    ("Severity", "severity"),
    ("Table", "table_name"),
    ("Column", "column_name"),
    ("Anomaly Type", "anomaly_type"),
    ("Metric", "metric_name"),
    ("Detected Value", "detected_value"),
    ("Baseline Value", "baseline_value"),
    ("Message", "message"),
    ("Detected At", "detected_at"),
]
MAIL_BODY = (
    "'<h3>Anomaly Detected</h3><table>' || "
    + " || ".join(f"'<tr><th>{label}</th><td>' || {cell(column)} || '</td></tr>'" for label, column in MAIL)
    + " || '</table>'"
)
SUBJECT = "'[' || severity || '] Anomaly Alert - ' || anomaly_type || ' detected in ' || table_name"
RANK = "CASE severity WHEN 'CRITICAL' THEN 0 WHEN 'HIGH' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LOW' THEN 3 ELSE 99 END"

step(
    "routes",
    """SELECT * FROM (VALUES ('CRITICAL', 'email'), ('CRITICAL', 'teams'), ('HIGH', 'email'), ('HIGH', 'slack'),
    ('MEDIUM', 'email'), ('LOW', 'slack'), ('LOW', 'pager')) AS r(severity, channel)""",
)
step(
    "routed",
    """SELECT p.*, channel, sha256('alerts-1|' || anomaly_id || '|' || channel) AS alert_id,
    channel IN ('email', 'slack') AS is_on FROM pending p JOIN routes USING (severity)""",
    "pending",
    "routes",
)
for name, in_digest in (("digest_box", "channel = 'email'"), ("single_box", "false")):
    single = f"is_on AND NOT ({in_digest})"
    step(
        name,
        f"""SELECT alert_id, 'alerts-1' AS run_id, anomaly_id, channel,
        CASE WHEN is_on THEN 'PENDING' ELSE 'SKIPPED' END AS status,
        CASE WHEN NOT is_on THEN 'Channel ''' || channel || ''' disabled in config' END AS error_message,
        {in_digest} AS in_digest, CASE WHEN {single} THEN {SUBJECT} END AS subject,
        CASE WHEN {single} THEN CASE channel WHEN 'email' THEN {MAIL_BODY}
            WHEN 'slack' THEN '*' || {SUBJECT} || '*' || chr(10) || message ELSE message END END AS body FROM routed""",
        "routed",
    )
    digest_status = "'SENT'" if name == "digest_box" else "NULL"
    sent = "substr(anomaly_id, 1, 1) < '8'"
    step(
        f"{name}_log",
        f"""SELECT alert_id, anomaly_id, channel, CASE WHEN status = 'SKIPPED' THEN 'SKIPPED'
            WHEN in_digest THEN {digest_status} WHEN {sent} THEN 'SENT' ELSE 'FAILED' END AS status,
        CASE WHEN status = 'SKIPPED' THEN error_message WHEN in_digest THEN NULL
            WHEN {sent} THEN NULL ELSE 'timeout' END AS error_message, {AS_OF} AS sent_at FROM {name}""",
        name,
    )
step("digested", "SELECT * FROM pending WHERE severity IN ('CRITICAL', 'HIGH', 'MEDIUM')", "pending")
step("run_digested", "SELECT * FROM found WHERE severity IN ('CRITICAL', 'HIGH', 'MEDIUM')", "found")
for head, rows in (("digest_head", "digested"), ("run_head", "run_digested")):
    step(
        head,
        f"""SELECT CAST(sum(n) AS BIGINT) AS anomalies,
        string_agg(n || ' ' || severity, ', ' ORDER BY {RANK}, severity) AS severity_summary
        FROM (SELECT severity, count(*) AS n FROM {rows} GROUP BY severity) HAVING count(*) > 0""",
        rows,
    )
OPENING = (
    "'<h3>Anomaly Digest</h3><p>' || anomalies || ' anomaly(ies) detected in this run ('"
    " || severity_summary || ').</p>'"
)
DIGEST_HEADS = "".join(f"<th>{label}</th>" for label, _ in DIGEST)
DIGEST_LINE = "'<tr>' || " + " || ".join(f"'<td>' || {cell(column)} || '</td>'" for _, column in DIGEST) + " || '</tr>'"


def digest_column(label: str, column: str) -> str:
    shown = {
        "column_name": "coalesce(nullif(column_name, ''), '-')",
        "metric_name": "coalesce(nullif(metric_name, ''), '-')",
        "detected_at": AS_OF,
    }
    return f'{shown.get(column, column)} AS "{label}"'


# Rules


step(
    "feed_rules",
    """SELECT 'feed_' || s_suppkey AS table_name, anomaly_type, s_acctbal >= 1000 AS enabled,
    CASE s_nationkey % 6 WHEN 0 THEN 'CRITICAL' WHEN 1 THEN 'HIGH' WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'LOW'
        WHEN 4 THEN 'INFO' END AS severity,
    '{"metric":"sum_price","threshold_pct":' || (s_nationkey + 50) || '}' AS rule_json, s_suppkey
    FROM supplier, (VALUES ('sudden_increase'), ('sudden_decrease'), ('value_anomaly'), ('missing_zero_activity'),
        ('stale_data'), ('duplicate_record_anomaly'), ('null_data_quality_spike'), ('schema_drift')) AS t(anomaly_type)
    WHERE anomaly_type <> 'schema_drift' OR s_acctbal >= 8000""",
)
step(
    "feed_twice",
    """SELECT r.*, s_nationkey AS nation, again FROM feed_rules r JOIN (SELECT s_suppkey, s_nationkey FROM supplier) USING (s_suppkey),
    (VALUES (false), (true)) AS t(again) WHERE NOT again OR s_nationkey % 5 = 0""",
    "feed_rules",
)
step(
    "applied",
    """SELECT * FROM (VALUES
    ('events', 'sum_amount', 'sudden_increase', 'HIGH', 50, NULL),
    ('events', 'sum_amount', 'sudden_decrease', 'HIGH', -50, NULL),
    ('events', 'sum_activity_count', 'missing_zero_activity', 'HIGH', 0, NULL),
    ('events', 'last_updated_epoch', 'stale_data', 'MEDIUM', 180, NULL),
    ('events', 'duplicate_count', 'duplicate_record_anomaly', 'MEDIUM', 100, 1),
    ('events', 'null_ratio_actor_null', 'null_data_quality_spike', 'MEDIUM', 100, 0.05),
    ('events', 'null_ratio_actor_blank', 'null_data_quality_spike', 'MEDIUM', 100, 0.05),
    ('orders', 'sum_price', 'sudden_increase', 'LOW', 100, NULL),
    ('orders', 'row_count', 'sudden_decrease', 'MEDIUM', -60, NULL),
    ('lineitem', 'sum_quantity', 'sudden_decrease', 'INFO', -40, NULL)
    ) AS r(table_name, metric_name, anomaly_type, severity, lim, flo)""",
)


def columns_of(table: str, metrics: dict[str, str], keys: str | None) -> list[str]:
    rows = []
    for name in metrics:
        first, _, rest = name.partition("_")
        column = {"row_count": None, "last_updated_epoch": "ingestion_time"}.get(name, rest)
        if first == "null":
            column = name.removeprefix("null_ratio_")
        rows.append(f"('{table}', '{name}', {repr(column) if column else 'NULL'})")
    return rows + [f"('{table}', 'duplicate_count', '{keys}')"]


COLUMN_MAP = ", ".join(
    columns_of("events", EVENT_METRICS, EVENT_KEYS)
    + columns_of("orders", ORDER_METRICS, "o_custkey, o_orderdate")
    + columns_of("lineitem", LINE_METRICS, "l_orderkey, l_linenumber")
)


def bucket(unit: str) -> str:
    return f"SELECT date_trunc('{unit}', ts) AS period_start, count(*) AS rows FROM events GROUP BY 1"


def event_wide(*names: str) -> str:
    return sql("SELECT period_start, " + ", ".join(f"round({n}, 6) AS {n}" for n in names) + " FROM ev_wide", "ev_wide")


def event_base(*columns: str) -> str:
    return sql(f"SELECT table_name, period_start, metric_name, {', '.join(columns)} FROM ev_long_base", "ev_long_base")


UPSERT = (
    "SELECT coalesce(n.{0}, o.{0}) AS {0}".format("run_id")
    + ", table_name, period_start, metric_name,"
    + " round(CASE WHEN n.run_id IS NOT NULL THEN n.metric_value ELSE o.metric_value END, 6) AS metric_value"
    + " FROM (SELECT 'run-1' AS run_id, * FROM early_long) o {} JOIN (SELECT 'run-2' AS run_id, * FROM ev_long) n"
    + " USING (table_name, period_start, metric_name)"
)

ORACLE: dict[str, str] = {
    "period_bucket_minute": bucket("minute"),
    "period_bucket_hour": bucket("hour"),
    "period_bucket_day": bucket("day"),
    "row_count": event_wide("row_count"),
    "numeric_stats": event_wide(*numbers("amount"), *numbers("activity_count")),
    "null_count": sql(
        f"""SELECT date_trunc('hour', event_time) AS period_start, count(*) AS row_count,
        {nulls("actor_null")} AS null_count_actor_null, {nulls("actor_blank")} AS null_count_actor_blank
        FROM ev GROUP BY 1""",
        "ev",
    ),
    "null_ratio": event_wide("null_ratio_actor_null", "null_ratio_actor_blank"),
    "last_updated_epoch": event_wide("last_updated_epoch"),
    "duplicate_count": sql(
        "SELECT period_start, metric_name, metric_value FROM li_long WHERE metric_name = 'duplicate_count'", "li_long"
    ),
    "duplicate_history": sql("SELECT period_start, metric_name, metric_value FROM dup_long", "dup_long"),
    "metrics_long": sql(f"SELECT {METRIC} FROM ev_long", "ev_long"),
    "metrics_multi_table": sql(f"SELECT {METRIC} FROM all_long", "all_long"),
    "metrics_since": sql(
        f"SELECT {METRIC} FROM (SELECT * FROM recent_long UNION ALL"
        " SELECT * FROM ev_long WHERE metric_name = 'duplicate_count')",
        "recent_long",
        "ev_long",
    ),
    "metrics_ordered": sql(f"SELECT {METRIC} FROM ev_long ORDER BY period_start, metric_name, table_name", "ev_long"),
    "metric_column_map": sql(
        f"""SELECT table_name, metric_name, column_name, count(*) AS periods FROM all_long
        LEFT JOIN (VALUES {COLUMN_MAP}) AS c(table_name, metric_name, column_name) USING (table_name, metric_name)
        GROUP BY ALL""",
        "all_long",
    ),
    "unexpected_status": """SELECT 'orders' AS table_name, date_trunc('day', o_orderdate) AS period_start,
        o_orderstatus AS status, count(*) AS unexpected_rows FROM orders
        WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O') GROUP BY ALL""",
    "metric_history": sql(f"SELECT {METRIC} FROM ev_long WHERE metric_name = 'sum_amount'", "ev_long"),
    "lag_previous": event_base("round(metric_value, 6) AS metric_value", "round(previous_value, 6) AS previous_value"),
    "rolling_median": event_base("round(metric_value, 6) AS metric_value", "round(baseline_median, 6) AS baseline_median"),
    "history_count": event_base("history_count"),
    "pct_change": event_base("round(pct_change, 6) AS pct_change"),
    "cold_start_gate": event_base("history_count >= 5 AS has_history"),
    "zero_to_nonzero": event_base("baseline_median = 0 AND metric_value > 0 AS from_zero"),
    "rules_applied": sql(
        """SELECT table_name, period_start, metric_name, round(metric_value, 6) AS metric_value, anomaly_type, severity,
        CAST(lim AS DOUBLE) AS "limit", CAST(flo AS DOUBLE) AS floor FROM all_long JOIN applied USING (table_name, metric_name)""",
        "all_long",
        "applied",
    ),
    "sudden_increase": one(trend("ev_long_base", *INCREASE), "ev_long_base"),
    "sudden_decrease": one(trend("ev_long_base", *DECREASE), "ev_long_base"),
    "zero_activity": one(zero("ev_long_base"), "ev_long_base"),
    "zero_activity_consecutive": one(zero("zero_runs", " AND run >= 2"), "zero_runs"),
    "missing_periods": sql(
        """SELECT table_name, c.period_start, 'row_count' AS metric_name, 0.0::DOUBLE AS detected_value,
        (SELECT CAST(arg_max(n, h.period_start) AS DOUBLE) FROM feed_hours h
            WHERE h.table_name = c.table_name AND h.period_start < c.period_start) AS baseline_value
        FROM calendar c WHERE NOT EXISTS (SELECT 1 FROM feed_hours f
            WHERE f.table_name = c.table_name AND f.period_start = c.period_start)""",
        "calendar",
        "feed_hours",
    ),
    "duplicate_count_since": sql(
        """SELECT run_id, 'events' AS table_name, max(date_trunc('hour', latest)) AS period_start, 'duplicate_count' AS metric_name,
        CAST(sum(n - 1) AS DOUBLE) AS metric_value
        FROM (SELECT run_id, user_id, event_type, count(*) AS n, max(event_time) AS latest
            FROM ev JOIN (VALUES ('since 2024-01-08', TIMESTAMP '2024-01-12'), ('since 2024-01-12', TIMESTAMP '2024-01-20'),
                ('since 2024-01-20', TIMESTAMP '2999-01-01')) AS r(run_id, until) ON event_time < until GROUP BY ALL)
        GROUP BY run_id""",
        "ev",
    ),
    "metrics_by_batches": sql(f"SELECT {METRIC} FROM ev_long WHERE metric_name <> 'duplicate_count'", "ev_long"),
    "detect_missing_periods": sql(
        f"""SELECT anomaly_id, {HIT} FROM ({identified("""SELECT table_name, 'activity_count' AS column_name, 'missing_zero_activity' AS anomaly_type,
            'HIGH' AS severity, period_start, 'row_count' AS metric_name, 0.0::DOUBLE AS detected_value,
            (SELECT CAST(arg_max(n, h.period_start) AS DOUBLE) FROM feed_hours h
                WHERE h.table_name = c.table_name AND h.period_start < c.period_start) AS baseline_value,
            'row_count == 0' AS threshold_used, CAST(NULL AS VARCHAR) AS row_id
            FROM expected_hours c WHERE NOT EXISTS (SELECT 1 FROM feed_hours f
                WHERE f.table_name = c.table_name AND f.period_start = c.period_start)""")})""",
        "expected_hours",
        "feed_hours",
    ),
    "baseline_without_event_time": sql(
        f"""SELECT {METRIC}, round(previous_value, 6) AS previous_value, round(baseline_median, 6) AS baseline_median, history_count
        FROM timed_long_base WHERE metric_name IN ('row_count', 'sum_amount')""",
        "timed_long_base",
    ),
    "stale_data": one(stale("ev_long"), "ev_long"),
    "duplicate_spike": one(duplicates("dup_long_base"), "dup_long_base"),
    "null_spike": one(null_spikes("ev_long_base"), "ev_long_base"),
    "value_fixed_threshold": sql(f"SELECT anomaly_id, {HIT} FROM ({identified(event_values('ev'))})", "ev"),
    "value_zscore": sql(z_hits(), "ev"),
    "value_several_bounds": sql(
        f"""SELECT {HIT}, message FROM ({event_values('ev')} UNION ALL
        {value('ev', 'events', 'LOW', 'value', 'hour', 'event_time', 'event_id', 'value > 150 OR value < 1', 'outside [1, 150]')} UNION ALL
        SELECT 'events', 'user_id', 'value_anomaly', 'MEDIUM', date_trunc('hour', event_time), 'user_id', CAST(user_id AS DOUBLE), NULL,
            'outside [3, 1000000]', 'Value anomaly on user_id = ' || CAST(CAST(user_id AS DOUBLE) AS VARCHAR) || ' (outside [3, 1000000])', NULL
            FROM ev WHERE user_id < 3 OR user_id > 1000000)""",
        "ev",
    ),
    "detect_by_table": sql(f"SELECT anomaly_id, {HIT}, {AS_OF} AS detected_at, false AS alerted FROM found", "found"),
    "detect_all": sql(f"SELECT anomaly_id, {HIT}, {AS_OF} AS detected_at, false AS alerted FROM found", "found"),
    "anomaly_messages": sql("SELECT anomaly_id, message, threshold_used FROM found", "found"),
    "new_anomalies": sql(f"SELECT anomaly_id, {HIT} FROM found WHERE period_start >= {SPLIT}", "found"),
    "new_anomalies_null_key": sql(
        f"""SELECT anomaly_id, {HIT} FROM found
        WHERE hour(period_start) <> 0 AND severity <> 'MEDIUM' AND column_name IS NOT NULL""",
        "found",
    ),
    "detect_incremental": sql(
        f"""SELECT anomaly_id, {HIT} FROM ev_found f WHERE NOT EXISTS (SELECT 1 FROM early_found e
        WHERE e.table_name = f.table_name AND e.column_name IS NOT DISTINCT FROM f.column_name
        AND e.anomaly_type = f.anomaly_type AND e.period_start IS NOT DISTINCT FROM f.period_start)""",
        "ev_found",
        "early_found",
    ),
    "anomalies_ordered": sql(
        f"""SELECT anomaly_id, {HIT}, {AS_OF} AS detected_at FROM logged
        ORDER BY {RANK}, severity, period_start, anomaly_id""",
        "logged",
    ),
    "anomaly_summary": sql("SELECT anomaly_type, severity, count(*) AS anomalies FROM logged GROUP BY ALL", "logged"),
    "alert_totals": sql("SELECT count(*) AS logged, count(*) FILTER (alerted) AS alerted FROM logged", "logged"),
    "pending_anomalies": sql(f"SELECT anomaly_id, {HIT}, alerted FROM pending", "pending"),
    "pending_realert": sql(f"SELECT anomaly_id, {HIT}, alerted FROM logged", "logged"),
    "alert_routing": sql("SELECT anomaly_id, severity, channel FROM routed", "routed"),
    "unrouted": sql(
        f"SELECT anomaly_id, {HIT} FROM logged WHERE severity NOT IN (SELECT severity FROM routes)", "logged", "routes"
    ),
    "alert_outbox": sql("SELECT * FROM digest_box", "digest_box"),
    "alert_addresses": sql(
        """SELECT alert_id, channel, CASE channel WHEN 'email' THEN 'ops@x.com, data@x.com' END AS recipients,
        CASE channel WHEN 'email' THEN 'lead@x.com' END AS cc, CASE channel WHEN 'slack' THEN '#watch' END AS target FROM digest_box""",
        "digest_box",
    ),
    "alert_subjects": sql("SELECT alert_id, channel, subject FROM single_box WHERE status = 'PENDING'", "single_box"),
    "alert_bodies": sql("SELECT alert_id, channel, body FROM single_box WHERE status = 'PENDING'", "single_box"),
    "digest_rows": sql(
        f"SELECT {', '.join(digest_column(*pair) for pair in DIGEST)} FROM digested ORDER BY {RANK}, severity, anomaly_id",
        "digested",
    ),
    "digest_summary": sql(
        f"""SELECT anomalies, severity_summary,
        '[Anomaly Digest] ' || anomalies || ' anomalies detected - 2024-02-01' AS subject, {OPENING} AS opening
        FROM digest_head""",
        "digest_head",
    ),
    "digest_html": sql(
        f"""SELECT 0 AS section, 0 AS rank, '' AS line_id, {OPENING} AS html FROM digest_head
        UNION ALL SELECT 1, 0, '', '<table><thead><tr>{DIGEST_HEADS}</tr></thead><tbody>' FROM digest_head
        UNION ALL SELECT 2, {RANK}, anomaly_id, {DIGEST_LINE} FROM digested
        UNION ALL SELECT 3, 0, '', '</tbody></table>' FROM digest_head""",
        "digest_head",
        "digested",
    ),
    "alert_log": sql("SELECT * FROM digest_box_log", "digest_box_log"),
    "alert_log_single": sql("SELECT * FROM single_box_log", "single_box_log"),
    "mark_alerted": sql(
        f"""SELECT anomaly_id, {HIT}, alerted OR EXISTS (SELECT 1 FROM digest_box_log b
            WHERE b.anomaly_id = l.anomaly_id AND b.channel <> 'email' AND b.status = 'SENT') AS alerted FROM logged l""",
        "logged",
        "digest_box_log",
    ),
    "scheduled_run": sql(
        f"""SELECT anomaly_id, 'run-1' AS run_id, {HIT}, message,
        coalesce(substr(anomaly_id, 1, 1) < '8' AND severity IN (SELECT severity FROM routes WHERE channel = 'slack'), false)
            AS alerted,
        (SELECT count(*) FROM routes r WHERE r.severity = f.severity AND channel IN ('email', 'slack')) AS emitted
        FROM found f""",
        "found",
        "routes",
    ),
    "scheduled_digest": sql(
        f"""SELECT 'alerts-1' AS run_id, 0 AS section, 0 AS rank, '' AS line_id, {OPENING} AS html FROM run_head
        UNION ALL SELECT 'alerts-1', 1, 0, '', '<table><thead><tr>{DIGEST_HEADS}</tr></thead><tbody>' FROM run_head
        UNION ALL SELECT 'alerts-1', 2, {RANK}, anomaly_id, {DIGEST_LINE} FROM run_digested
        UNION ALL SELECT 'alerts-1', 3, 0, '', '</tbody></table>' FROM run_head""",
        "run_head",
        "run_digested",
    ),
    "rules_table": sql("SELECT table_name, anomaly_type, enabled, severity, rule_json FROM feed_rules", "feed_rules"),
    "rules_enabled": sql("SELECT table_name, anomaly_type, severity FROM feed_rules WHERE enabled", "feed_rules"),
    "rules_violations": sql(
        """SELECT table_name, anomaly_type, severity, problem FROM (
        SELECT *, 'unknown anomaly type' AS problem FROM feed_rules WHERE enabled AND anomaly_type = 'schema_drift'
        UNION ALL SELECT *, 'severity missing' FROM feed_rules WHERE severity IS NULL
        UNION ALL SELECT *, 'severity has no route' FROM feed_rules
            WHERE severity NOT IN (SELECT severity FROM routes)
        UNION ALL SELECT r.*, missing || ' missing' FROM feed_rules r JOIN (VALUES
            ('duplicate_record_anomaly', 'minimum_duplicate_count'), ('null_data_quality_spike', 'minimum_null_ratio'),
            ('missing_zero_activity', 'zero_activity_value'), ('stale_data', 'max_allowed_staleness_minutes'),
            ('value_anomaly', 'fixed_lower_threshold'), ('value_anomaly', 'fixed_upper_threshold'))
            AS needs(kind, missing) ON enabled AND anomaly_type = kind)""",
        "feed_rules",
        "routes",
    ),
    "rules_against_schema": sql(
        """SELECT table_name, anomaly_type, severity, problem FROM (
        SELECT *, 'unknown anomaly type' AS problem FROM feed_twice WHERE enabled AND anomaly_type = 'schema_drift'
        UNION ALL SELECT *, 'severity missing' FROM feed_twice WHERE severity IS NULL
        UNION ALL SELECT *, 'severity has no route' FROM feed_twice
            WHERE severity NOT IN (SELECT severity FROM routes)
        UNION ALL SELECT r.*, missing || ' missing' FROM feed_twice r JOIN (VALUES
            ('duplicate_record_anomaly', 'minimum_duplicate_count'), ('null_data_quality_spike', 'minimum_null_ratio'),
            ('missing_zero_activity', 'zero_activity_value'), ('stale_data', 'max_allowed_staleness_minutes'),
            ('value_anomaly', 'fixed_lower_threshold'), ('value_anomaly', 'fixed_upper_threshold'))
            AS needs(kind, missing) ON enabled AND anomaly_type = kind
        UNION ALL SELECT *, 'repeated rule' FROM feed_twice WHERE enabled AND again
        UNION ALL SELECT *, 'unknown metric' FROM feed_twice WHERE enabled AND nation % 3 <> 2
            AND anomaly_type NOT IN ('value_anomaly', 'schema_drift')
            AND NOT (nation % 3 = 0 AND anomaly_type IN ('sudden_increase', 'sudden_decrease', 'missing_zero_activity'))
        UNION ALL SELECT *, 'unknown column' FROM feed_twice WHERE enabled AND anomaly_type = 'value_anomaly' AND nation % 4 = 2
        UNION ALL SELECT *, 'column is not a number' FROM feed_twice
            WHERE enabled AND anomaly_type = 'value_anomaly' AND nation % 4 = 1)""",
        "feed_twice",
        "routes",
    ),
    "retire_rules": sql(
        """SELECT 'feed_' || (s_nationkey % 5) AS table_name, anomaly_type,
        enabled AND s_nationkey % 5 IN (1, 2, 4) AS enabled, severity, rule_json
        FROM feed_rules JOIN (SELECT s_suppkey, s_nationkey FROM supplier) USING (s_suppkey)""",
        "feed_rules",
    ),
    "csv_source": "SELECT * FROM events",
    "state_init": sql(f"SELECT {METRIC} FROM ev_long", "ev_long"),
    "state_append": sql(
        f"SELECT {METRIC}, CASE WHEN period_start >= {SPLIT} THEN 'hourly' END AS grain FROM ev_long", "ev_long"
    ),
    "state_overwrite": sql(f"SELECT {METRIC} FROM ev_long WHERE metric_name = 'row_count'", "ev_long"),
    "state_reset": sql(
        """SELECT state_table, CAST(0 AS BIGINT) AS rows FROM (VALUES ('metrics_baseline'), ('anomaly_detection_log'),
        ('alert_log'), ('alert_outbox')) AS t(state_table)
        UNION ALL SELECT 'anomaly_rules_config', count(*) FROM feed_rules""",
        "feed_rules",
    ),
    "upsert_metrics": sql(UPSERT.format("FULL"), "early_long", "ev_long"),
    "upsert_update_only": sql(UPSERT.format("LEFT"), "early_long", "ev_long"),
    "upsert_into_empty": sql(f"SELECT 'run-2' AS run_id, {METRIC} FROM ev_long", "ev_long"),
}
