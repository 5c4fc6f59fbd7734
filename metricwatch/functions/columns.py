"""Expressions shared by the operators.

Functions that take or return SQL text are meant to be put together into one expression.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Severities from most to least urgent; anything else ranks last.
SEVERITY_RANKS = {"CRITICAL": 0, "HIGH": 1, "MEDIUM": 2, "LOW": 3}
OTHER_SEVERITY_RANK = 99


def quoted(column: str) -> str:
    """A top-level column's name in SQL, also when it holds dots or spaces."""
    return "`" + column.replace("`", "``") + "`"


def named(column: str) -> Column:
    return F.col(quoted(column))


def literal(text: str) -> str:
    """Text as a literal in SQL."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def moment(value: datetime | str) -> Column:
    """A fixed point in time as a column. ISO text and naive datetimes are read as UTC."""
    when = datetime.fromisoformat(value) if isinstance(value, str) else value
    when = when if when.tzinfo else when.replace(tzinfo=timezone.utc)
    return F.lit(when.astimezone(timezone.utc).isoformat(sep=" ")).cast("timestamp")


def period_of(column: str, unit: str) -> Column:
    """The bucket a row's event time falls in, as a timestamp."""
    return F.date_trunc(unit, named(column))


def kind_of(df: DataFrame, column: str) -> T.DataType:
    """A column's type. Names resolve the way Spark resolves them, so case may differ."""
    if column in df.columns:
        return df.schema[column].dataType
    return df.select(named(column)).schema[0].dataType


def is_blank(df: DataFrame, column: str) -> str:
    """SQL: null, or text that is empty after trimming. Only text can be blank, so other types are not cast."""
    test = f"{quoted(column)} IS NULL"
    if isinstance(kind_of(df, column), (T.StringType, T.CharType, T.VarcharType, T.BinaryType)):
        test += f" OR trim(CAST({quoted(column)} AS STRING)) = ''"
    return test


def severity_rank(severity: str = "severity") -> Column:
    """Position of a severity for sorting, most urgent first."""
    cases = " ".join(f"WHEN {literal(name)} THEN {rank}" for name, rank in SEVERITY_RANKS.items())
    return F.expr(f"CASE {severity} {cases} ELSE {OTHER_SEVERITY_RANK} END")


def or_dash(column: str) -> str:
    """SQL: the value as text, or a dash when there is none."""
    return f"coalesce(nullif(CAST({column} AS STRING), ''), '-')"


def html_text(text: str) -> str:
    """SQL: text that is safe between HTML tags."""
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def time_text(column: str) -> str:
    return f"date_format({column}, 'yyyy-MM-dd HH:mm:ss')"


def digest_of(*parts: str) -> Column:
    """A stable id from SQL parts; a missing part differs from an empty one."""
    marked = ", ".join(f"coalesce(CAST({part} AS STRING), '\\\\N')" for part in parts)
    return F.expr(f"sha2(concat_ws('|', {marked}), 256)")
