"""Period metrics from parts that can be merged, so that late rows do not make their periods be read again.

A batch of rows gives, per period and column, how many values there are, their sum, their squared deviation from their
mean, and the extremes. Parts of several batches of a period add up to the metrics that one pass over all their rows gives:
counts, extremes, and sums of integers and decimals exactly, the rest but for rounding.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.functions.columns import is_blank, kind_of, named
from metricwatch.operators.metrics import with_period
from metricwatch.specs import LAST_UPDATED, NULL_RATIO, ROW_COUNT, STATISTICS, SourceSpec

# Kinds of parts: of all rows, of a numeric column, of a watched column's blanks, of the ingestion time.
ROWS, NUMBER, BLANK, LATEST = "rows", "number", "blank", "latest"
#: What tells parts apart; a repeated batch replaces its parts.
PART_KEYS = ("table_name", "period_start", "kind", "column_name", "batch_id")
EXACT = T.DecimalType(38, 18)


def batch_parts(df: DataFrame, spec: SourceSpec, batch_id: str) -> DataFrame:
    """The parts of one batch of rows of a table, from one pass over it."""
    rows = with_period(df, spec)

    def part(kind: str, column: str | None, n: Column, **values: Column) -> Column:
        nothing = F.lit(None).cast("double")
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lit(column).cast("string").alias("column_name"),
            n.cast("long").alias("n"),
            values.get("exact", F.lit(None)).cast(EXACT).alias("total_exact"),
            *(values.get(name, nothing).cast("double").alias(name) for name in ("total", "deviation", "low", "high")),
        )

    parts = [part(ROWS, None, F.count(F.lit(1)))]
    for column in spec.numeric_metric_columns:
        value, kind = named(column), kind_of(rows, column)
        whole = isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale <= EXACT.scale
        exact = F.try_sum(value.try_cast(EXACT)) if whole else F.lit(None)
        n, total = F.count(value), F.sum(value.cast("double"))
        parts.append(
            part(NUMBER, column, n, exact=exact, total=total, deviation=F.var_pop(value) * F.count(value), low=F.min(value), high=F.max(value))
        )
    parts += [part(BLANK, c, F.expr(f"count_if({is_blank(rows, c)})")) for c in spec.monitored_null_columns]
    if spec.ingestion_timestamp_column:
        time = named(spec.ingestion_timestamp_column).cast("timestamp").cast("double")
        parts.append(part(LATEST, None, F.count(time), high=F.max(time)))
    found = rows.groupBy("period_start").agg(F.array(*parts).alias("_parts")).select("period_start", F.inline("_parts"))
    return found.select(F.lit(spec.table_name).alias("table_name"), F.lit(batch_id).alias("batch_id"), "*")


def merged_metrics(parts: DataFrame) -> DataFrame:
    """table_name, period_start, metric_name, metric_value from all parts of the periods."""
    of_column = ("table_name", "period_start", "kind", "column_name")
    alike = Window.partitionBy(*of_column)
    mean, own = F.try_divide(F.sum("total").over(alike), F.sum("n").over(alike)), F.try_divide(F.col("total"), F.col("n"))
    apart = F.col("deviation") + F.col("n") * (own - mean) * (own - mean)
    counted = F.when(F.col("kind") == NUMBER, F.col("n") > 0)
    exact = F.count_if(counted & F.col("total_exact").isNull()) == 0
    whole = (
        parts.withColumn("_apart", apart)
        .groupBy(*of_column)
        .agg(
            F.sum("n").alias("n"),
            F.when(exact, F.coalesce(F.try_sum("total_exact").cast("double"), F.sum("total"))).otherwise(F.sum("total")).alias("sum"),
            F.sum("_apart").alias("_apart"),
            F.min("low").alias("min"),
            F.max("high").alias("max"),
        )
    )
    rows = F.max(F.when(F.col("kind") == ROWS, F.col("n"))).over(Window.partitionBy("table_name", "period_start"))
    whole = whole.withColumns(
        {
            "_rows": rows,
            "avg": F.try_divide(F.col("sum"), F.col("n").cast("double")),
            "stddev": F.when(F.col("n") > 1, F.sqrt(F.col("_apart") / (F.col("n") - 1))),
        }
    )

    def metric(name: Column, value: Column) -> Column:
        return F.struct(name.alias("metric_name"), value.cast("double").alias("metric_value"))

    kind, column = F.col("kind"), F.col("column_name")
    statistics = F.array(*(metric(F.concat(F.lit(f"{s}_"), column), F.col(s)) for s in STATISTICS))
    named_values = reduce(
        lambda done, case: done.when(*case),
        [
            (kind == NUMBER, statistics),
            (kind == BLANK, F.array(metric(F.concat(F.lit(f"{NULL_RATIO}_"), column), F.col("n") / F.col("_rows")))),
            (kind == LATEST, F.array(metric(F.lit(LAST_UPDATED), F.col("max")))),
        ],
        F.when(kind == ROWS, F.array(metric(F.lit(ROW_COUNT), F.col("n")))),
    )
    return whole.select("table_name", "period_start", F.inline(named_values))
