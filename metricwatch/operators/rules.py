"""Rules as rows: reading, checking and retiring them."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricwatch import specs
from metricwatch.specs import ANOMALY_TYPES, RULES_SCHEMA, Rule

# Numbers are read as text, so that messages show a threshold the way its author wrote it.
PARAMETERS = (
    "metric string, threshold_pct string, minimum_duplicate_count string, minimum_null_ratio string, "
    "zero_activity_value string, consecutive_periods_before_alert string, max_allowed_staleness_minutes string, "
    "use_fixed_threshold string, fixed_lower_threshold string, fixed_upper_threshold string, zscore_threshold string, "
    "expected_from string"
)
#: The types whose rules name a metric, and those whose metric is their own.
NAMING = (specs.SUDDEN_INCREASE, specs.SUDDEN_DECREASE, specs.ZERO_ACTIVITY)
OWN_METRICS = {specs.DUPLICATE_SPIKE: specs.DUPLICATE_COUNT, specs.STALE_DATA: specs.LAST_UPDATED, specs.NULL_SPIKE: specs.NULL_RATIO}


def seed_rules(rules: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Rules with one column per parameter, brought to the rules table's schema by packing them as JSON."""
    return rules.withColumn("rule_json", F.to_json(F.struct(*parameters))).select(*RULES_SCHEMA.names)


def enabled_rules(rules: DataFrame) -> DataFrame:
    return rules.filter("enabled")


def watched_metrics(rules: DataFrame, metric_columns: DataFrame) -> DataFrame:
    """Enabled rules on metrics, one row per rule and metric it watches.

    Adds to table, type and severity: ``metric_name``, the ``column_name`` it describes, the rule's
    ``limit`` and ``floor`` (and their text), and ``needed_run``. A rule on null ratios watches one metric
    per monitored column.
    """
    kind = F.col("anomaly_type")
    parsed = enabled_rules(rules).filter(kind.isin(*(set(ANOMALY_TYPES) - {specs.VALUE_ANOMALY}))).select(
        "table_name", "anomaly_type", "severity", F.from_json("rule_json", PARAMETERS).alias("p")
    )
    limit = (
        F.when(kind == specs.ZERO_ACTIVITY, F.col("p.zero_activity_value"))
        .when(kind == specs.STALE_DATA, F.col("p.max_allowed_staleness_minutes"))
        .otherwise(F.col("p.threshold_pct"))
    )
    floor = F.when(kind == specs.DUPLICATE_SPIKE, F.col("p.minimum_duplicate_count")).when(
        kind == specs.NULL_SPIKE, F.col("p.minimum_null_ratio")
    )
    flat = parsed.select(
        "table_name",
        "anomaly_type",
        "severity",
        _metric_of(F.col("p")).alias("rule_metric"),
        limit.alias("limit_text"),
        limit.try_cast("double").alias("limit"),
        floor.alias("floor_text"),
        floor.try_cast("double").alias("floor"),
        _needed_run(F.col("p")).alias("needed_run"),
    )
    column = F.when(kind == specs.ZERO_ACTIVITY, F.col("activity_column")).otherwise(F.col("column_name"))
    return (
        flat.join(metric_columns, ["table_name", "rule_metric"], "left")
        .withColumn("column_name", column)
        .withColumn("metric_name", F.coalesce("metric_name", "rule_metric"))
        .drop("rule_metric", "activity_column")
    )


def _metric_of(given: Column) -> Column:
    """The metric or column that a rule looks at."""
    kind, found = F.col("anomaly_type"), given["metric"]
    for own, metric in OWN_METRICS.items():
        found = F.when(kind == own, metric).otherwise(found)
    return found


def _needed_run(given: Column) -> Column:
    """How many periods in a row a zero-activity rule waits for: one if it doesn't say, null if that is no whole number."""
    said = given["consecutive_periods_before_alert"]
    number = said.try_cast("double")
    whole = (number >= 1) & (number == F.floor(number))
    return F.when(said.isNull(), 1).when(whole, number.cast("int"))


def value_rules(rules: DataFrame, table_names: Iterable[str]) -> dict[str, list[Rule]]:
    """The enabled value rules of each named table, each once and in a fixed order.

    Value rules filter the rows of a table, so their bounds go into its plan as literals. Only the rules of the
    named tables come back. They have to be sound: see ``sound_rules``.
    """
    wanted = enabled_rules(rules).filter(
        (F.col("anomaly_type") == specs.VALUE_ANOMALY) & F.col("table_name").isin(*table_names)
    )
    found: dict[str, list[Rule]] = defaultdict(list)
    for row in wanted.distinct().orderBy("table_name", "rule_json", "severity").toLocalIterator():
        found[row["table_name"]].append(Rule.from_row(row.asDict()))
    return dict(found)


def _literal_map(values: Mapping[str, Column]) -> Column:
    return F.create_map(*(part for key, value in values.items() for part in (F.lit(key), value)))


def channels_for(severity: Column, routing: Mapping[str, Sequence[str]]) -> Column:
    """The channels a severity is routed to; null when it has no route. Routing is part of the plan, not a join."""
    if not routing:
        return F.lit(None).cast("array<string>")
    routes = {key: F.array(*map(F.lit, channels)).cast("array<string>") for key, channels in routing.items()}
    return F.try_element_at(_literal_map(routes), severity)


def checked_rules(
    rules: DataFrame,
    routing: Mapping[str, Sequence[str]] | None = None,
    columns: DataFrame | None = None,
    fields: DataFrame | None = None,
) -> DataFrame:
    """Every rule with its ``problems`` and whether it is ``sound``, that is, has none that keep it from working.

    ``columns`` (from ``metric_columns``) tells which metrics the tables have and ``fields`` (from ``source_fields``) which
    columns; rules of tables that these do not know are not held against them. Of enabled rules that say the same,
    the first by its text is sound and the others are repeated. Those are rules of one table and type on
    one metric, and value rules with the same bounds; value rules of one column with other bounds are rules of their own.
    """
    kind, on, given = F.col("anomaly_type"), F.col("enabled"), F.from_json("rule_json", PARAMETERS)
    parsed = rules.select("*", given.alias("_given"))
    p = F.col("_given")
    bounds = ("use_fixed_threshold", "fixed_lower_threshold", "fixed_upper_threshold", "zscore_threshold")
    same = F.when(kind == specs.VALUE_ANOMALY, F.to_json(F.struct(*(p[b].alias(b) for b in bounds))))
    alike = Window.partitionBy("table_name", "anomaly_type", "enabled", _metric_of(p), same).orderBy("rule_json", "severity")
    parsed = parsed.withColumn("_metric", _metric_of(p)).withColumn("_turn", F.row_number().over(alike))

    def known(frame: DataFrame | None, name: str, *values: str) -> tuple[Column, Column]:
        """Whether the frame knows the rule's table, and its metric or column; joined to the rules on the way."""
        nonlocal parsed
        if frame is None:
            return F.lit(False), F.lit(False)
        listed = frame.select("table_name", F.array(*values).alias("_names")).select("table_name", F.explode("_names").alias("_metric"))
        listed = listed.distinct().withColumn(f"_{name}", F.lit(True))
        tables = listed.select("table_name").distinct().withColumn(f"_{name}_table", F.lit(True))
        parsed = parsed.join(listed, ["table_name", "_metric"], "left").join(tables, "table_name", "left")
        return F.col(f"_{name}_table").isNotNull(), F.col(f"_{name}").isNotNull()

    table_known, metric_known = known(columns, "of_metrics", "rule_metric", "metric_name")
    if fields is not None:  # names resolve as Spark resolves them
        parsed = parsed.withColumn("_metric", F.when(kind == specs.VALUE_ANOMALY, F.lower("_metric")).otherwise(F.col("_metric")))
    source_known, field_known = known(fields, "of_source", "field")
    _, number_known = known(None if fields is None else fields.filter("numeric"), "of_numbers", "field")
    fixed = F.coalesce(F.lower(p["use_fixed_threshold"]).try_cast("boolean"), F.lit(True))

    def needed(name: str, *kinds: str, when: Column | None = None) -> list[Column]:
        asked, value = on & kind.isin(*kinds) & (F.lit(True) if when is None else when), p[name]
        wrong = [F.when(asked & value.isNull(), F.lit(f"{name} missing"))]
        if name != "metric":
            bad = asked & value.isNotNull() & value.try_cast("double").isNull()
            wrong.append(F.when(bad, F.lit(f"{name} is not a number")))
        return wrong

    run_given = p["consecutive_periods_before_alert"].isNotNull() & on & (kind == specs.ZERO_ACTIVITY)
    of_value = on & (kind == specs.VALUE_ANOMALY)
    watches = on & kind.isin(*NAMING, *OWN_METRICS) & F.col("_metric").isNotNull()
    blocking = F.array_compact(
        F.array(
            F.when(on & ~kind.isin(*ANOMALY_TYPES), F.lit("unknown anomaly type")),
            *needed("metric", *NAMING, specs.VALUE_ANOMALY),
            *needed("threshold_pct", specs.SUDDEN_INCREASE, specs.SUDDEN_DECREASE, specs.DUPLICATE_SPIKE, specs.NULL_SPIKE),
            *needed("minimum_duplicate_count", specs.DUPLICATE_SPIKE),
            *needed("minimum_null_ratio", specs.NULL_SPIKE),
            *needed("zero_activity_value", specs.ZERO_ACTIVITY),
            *needed("max_allowed_staleness_minutes", specs.STALE_DATA),
            F.when(run_given & _needed_run(p).isNull(), F.lit("consecutive_periods_before_alert is not a whole number from 1 on")),
            F.when(
                of_value & p["use_fixed_threshold"].isNotNull() & F.lower(p["use_fixed_threshold"]).try_cast("boolean").isNull(),
                F.lit("use_fixed_threshold is not true or false"),
            ),
            *needed("fixed_lower_threshold", specs.VALUE_ANOMALY, when=fixed),
            *needed("fixed_upper_threshold", specs.VALUE_ANOMALY, when=fixed),
            *needed("zscore_threshold", specs.VALUE_ANOMALY, when=~fixed),
            F.when(
                on & (kind == specs.ZERO_ACTIVITY) & p["expected_from"].isNotNull() & p["expected_from"].try_cast("timestamp").isNull(),
                F.lit("expected_from is not a time"),
            ),
            F.when(watches & table_known & ~metric_known, F.lit("unknown metric")),
            F.when(of_value & F.col("_metric").isNotNull() & source_known & ~field_known, F.lit("unknown column")),
            F.when(of_value & source_known & field_known & ~number_known, F.lit("column is not a number")),
            F.when(on & (F.col("_turn") > 1), F.lit("repeated rule")),
        )
    )
    severity = F.col("severity")
    others = [F.when(severity.isNull(), F.lit("severity missing"))]
    if routing is not None:
        others.append(F.when(severity.isNotNull() & channels_for(severity, routing).isNull(), F.lit("severity has no route")))
    checked = parsed.withColumn("_blocking", blocking)
    problems = F.concat("_blocking", F.array_compact(F.array(*others)))
    return checked.select(*rules.columns, problems.alias("problems"), (F.size("_blocking") == 0).alias("sound"))


def rule_violations(
    rules: DataFrame,
    routing: Mapping[str, Sequence[str]],
    columns: DataFrame | None = None,
    fields: DataFrame | None = None,
) -> DataFrame:
    """Rules that cannot work as written, one row per rule and problem; see ``checked_rules``.

    A rule with such a parameter never fires, and stops no other rule. Without a severity or a route it fires and is not sent.
    """
    checked = checked_rules(rules, routing, columns, fields)
    return checked.select("table_name", "anomaly_type", "severity", F.explode("problems").alias("problem"))


def sound_rules(rules: DataFrame, columns: DataFrame | None = None, fields: DataFrame | None = None) -> DataFrame:
    """The rules that can work: what detection goes by."""
    return checked_rules(rules, None, columns, fields).filter("sound").select(*rules.columns)


def existing_tables(spark: SparkSession, schema: str) -> DataFrame:
    """Names of the tables of a catalog schema, qualified the way rules name them."""
    listed = spark.sql("SHOW TABLES IN IDENTIFIER(:schema)", args={"schema": schema})
    return listed.filter("NOT isTemporary").select(F.concat_ws(".", F.lit(schema), "tableName").alias("table_name"))


def missing_tables(rules: DataFrame, existing: DataFrame) -> DataFrame:
    """Tables that rules name but that no longer exist."""
    return rules.select("table_name").distinct().join(existing.select("table_name"), "table_name", "left_anti")


def retire_rules(rules: DataFrame, existing: DataFrame) -> DataFrame:
    """The rules with those of tables that no longer exist switched off."""
    present = existing.select("table_name").distinct().withColumn("_present", F.lit(True))
    return (
        rules.join(present, "table_name", "left")
        .withColumn("enabled", F.col("enabled") & F.col("_present").isNotNull())
        .select(*RULES_SCHEMA.names)
    )
