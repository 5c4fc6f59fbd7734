"""Rows that share a key, dealt out so that every two of them meet in one bounded block, however many share it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.shared import stored


def blocked(rows: DataFrame, keys: Sequence[str], by: str, size: int) -> DataFrame:
    """The rows with `left`, `right` and `side`: all of a key go to one block (0, 0) unless they are more than `size`.

    Otherwise they are cut by the hash of `by` into parts of about `size`, and each goes to every block of its part with
    another: in block (i, i) stand all of part i, in block (i, j) those of i with side 0 and those of j with side 1.
    Keys of more rows than `size` are counted first and written; there is at most one such key per `size` rows.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > size)
    parts = stored(counts.select(*keys, F.ceil(F.col("_rows") / size).cast("int").alias("_parts")))
    dealt = rows.join(parts, list(keys), "left").withColumn("_parts", F.coalesce("_parts", F.lit(1)))
    dealt = dealt.withColumn("_own", F.pmod(F.xxhash64(by), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return (
        dealt.withColumn("left", F.least("_own", "_other"))
        .withColumn("right", F.greatest("_own", "_other"))
        .withColumn("side", (F.col("_own") > F.col("_other")).cast("int"))
        .drop("_parts", "_own", "_other")
    )
