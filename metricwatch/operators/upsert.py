"""Keyed upsert of one frame into another, for tables whose format has no MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.functions.columns import quoted


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    insert: bool = True,
) -> DataFrame:
    """``target`` with the named columns taken from the ``source`` row of the same key.

    Source rows without a match are added when ``insert`` is set; they need every target column. Null keys
    match each other. Two source rows of one key are an error, raised when the plan runs. Target rows are
    never merged with each other.

    The join is on the key columns themselves, null-safely, so filters on them reach the target's scan.
    """
    updates = list(update_columns) if update_columns is not None else [c for c in source.columns if c not in keys]
    carried = target.columns if insert else [*keys, *updates]
    lacking = set(carried) - set(source.columns)
    if lacking:
        raise ValueError(f"source lacks columns {sorted(lacking)}")

    # A cast on the way in keeps the target's types whatever the source's are.
    kinds = {field.name: field.dataType for field in target.schema.fields}
    typed = {name: F.col(quoted(name)).cast(kinds[name]) for name in carried}
    held = {name: f"_key_{number}" for number, name in enumerate(keys)}
    repeated = F.raise_error(F.concat(F.lit("more than one source row for key "), F.to_json(F.struct(*held.values()))))
    unique = (
        source.select(*(typed[k].alias(held[k]) for k in keys), F.struct(*(typed[c].alias(c) for c in carried)).alias("_new"))
        .groupBy(*held.values())
        .agg(F.count(F.lit(1)).alias("_rows"), F.first("_new").alias("_new"))
        .withColumn("_new", F.when(F.col("_rows") == 1, F.col("_new")).otherwise(repeated))
    )
    same = reduce(and_, (F.col(quoted(key)).eqNullSafe(F.col(held[key])) for key in keys))
    joined = target.withColumn("_old", F.lit(True)).join(unique, same, "full_outer" if insert else "left")

    def column(name: str):
        old = F.col(quoted(name))
        if name in updates:
            old = F.when(F.col("_new").isNotNull(), F.col("_new")[name]).otherwise(old)
        elif insert:
            old = F.when(F.col("_old"), old).otherwise(F.col("_new")[name])
        return old.alias(name)

    return joined.select(*(column(name) for name in target.columns))
