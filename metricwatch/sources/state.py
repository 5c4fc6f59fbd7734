"""The state tables: metric history, anomaly log, alert log, rules, outbox and marks, as tables of one catalog schema.

Files of a table are never replaced in place. A replacement or upsert writes to a folder of its own, and what it wrote takes
effect when the catalog's location of the table, or of each touched partition, is set to it. So a lost executor, a
failed plan or a straggling task leaves the table as it was and nothing in the way of the next write, and a frame read
earlier still finds its files until `vacuum` removes them. A partition switches at once; a reader between two switches of
one write sees some of its partitions new, and repeating a write that was cut short there completes it.

An upsert reads and rewrites only the partitions that its rows lie in. If other writes changed these meanwhile, it is worked
out anew from what is there then. That check and the switch are two steps, as the catalog has no locks, so writers
that must not miss each other by that moment need a scheduler that runs them in turn.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Collection, Sequence
from functools import reduce
from operator import or_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.functions.columns import literal, quoted
from metricwatch.operators.upsert import upsert
from metricwatch.sources.tables import ensure_schema, remove_folder, remove_unused, schema_folder, table_exists
from metricwatch.specs import (
    ALERT_SCHEMA,
    ANOMALY_SCHEMA,
    DIGESTS_SCHEMA,
    KEY_TOTALS_SCHEMA,
    MARKS_SCHEMA,
    METRICS_SCHEMA,
    OUTBOX_SCHEMA,
    PARTS_SCHEMA,
    RULES_SCHEMA,
    SEEN_KEYS_SCHEMA,
)

# Names of the state tables.
METRICS = "metrics_baseline"
ANOMALIES = "anomaly_detection_log"
ALERTS = "alert_log"
RULES = "anomaly_rules_config"
OUTBOX = "alert_outbox"
#: Ids of anomalies that got through to a channel and are not flagged in the log's files yet.
MARKS = "anomaly_alerted"
#: The digests of alerting runs, as lines.
DIGESTS = "alert_digest"
#: Business keys seen before a cut in event time, and what they add up to.
SEEN_KEYS, KEY_TOTALS = "duplicate_keys", "duplicate_totals"
#: What the batches of each period add up to.
PARTS = "metric_parts"

SCHEMAS = {
    METRICS: METRICS_SCHEMA,
    ANOMALIES: ANOMALY_SCHEMA,
    ALERTS: ALERT_SCHEMA,
    RULES: RULES_SCHEMA,
    OUTBOX: OUTBOX_SCHEMA,
}
_ALL = SCHEMAS | {MARKS: MARKS_SCHEMA, DIGESTS: DIGESTS_SCHEMA, SEEN_KEYS: SEEN_KEYS_SCHEMA, KEY_TOTALS: KEY_TOTALS_SCHEMA, PARTS: PARTS_SCHEMA}
#: Partition columns, each with the column it is made of and the form of its time; one without a form is that column.
#: Rows may also bring the partition column itself.
PARTITIONS: dict[str, dict[str, tuple[str, str | None]]] = {
    METRICS: {"table_name": ("table_name", None), "period_month": ("period_start", "yyyy-MM")},
    ANOMALIES: {"detected_date": ("detected_at", "yyyy-MM-dd")},
    ALERTS: {"emitted_date": ("emitted_at", "yyyy-MM-dd"), "run_id": ("run_id", None)},
    OUTBOX: {"emitted_date": ("emitted_at", "yyyy-MM-dd"), "run_id": ("run_id", None)},
    MARKS: {"marked_date": ("marked_at", "yyyy-MM-dd")},
    DIGESTS: {"run_id": ("run_id", None)},
    SEEN_KEYS: {"table_name": ("table_name", None), "generation": ("generation", None)},
    KEY_TOTALS: {"table_name": ("table_name", None)},
    PARTS: {"table_name": ("table_name", None), "period_month": ("period_start", "yyyy-MM")},
}
NO_TIME = "none"
# The tables a reset empties; rules and sources stay.
HISTORY_TABLES = (METRICS, ANOMALIES, ALERTS, OUTBOX, MARKS, DIGESTS, SEEN_KEYS, KEY_TOTALS, PARTS)
RESET_WORD = "RESET"
#: Partitions named one by one in a filter; more are looked up by their columns' values, which may cover some others.
NAMED_PARTITIONS = 500


class StateTables:
    """The state tables of one catalog schema, which is created if absent, in the given location if any."""

    def __init__(self, spark: SparkSession, schema: str, location: str | None = None, attempts: int = 5) -> None:
        self.spark = spark
        self.schema = schema
        self.attempts = attempts
        ensure_schema(spark, schema, location)
        self.place = schema_folder(spark, schema).rstrip("/")

    def name(self, table: str) -> str:
        return f"{self.schema}.{table}"

    def exists(self, table: str) -> bool:
        return table_exists(self.spark, self.name(table))

    def create(self, table: str, schema: T.StructType | None = None) -> None:
        """Create an empty table; one that exists is left alone."""
        if not self.exists(table):
            empty = _partitioned(table, self.spark.createDataFrame([], schema or _ALL[table]))
            writer = empty.write.format("parquet").partitionBy(*PARTITIONS.get(table, ())).mode("ignore")
            try:
                writer.option("path", self._new_folder(table)).saveAsTable(self.name(table))
            except AnalysisException:
                if not self.exists(table):  # else another writer was first
                    raise

    def create_all(self) -> None:
        for table in _ALL:
            self.create(table)

    def _new_folder(self, table: str) -> str:
        """A folder that no other write has or will have."""
        return f"{self.place}/{table}/{uuid.uuid4().hex}"

    def _stored(self, table: str) -> DataFrame:
        if not self.exists(table):
            raise ValueError(f"state table {table!r} does not exist in {self.schema}; create it first")
        return self.spark.table(self.name(table))

    def read(self, table: str) -> DataFrame:
        """The rows as they are now. Columns that came later read as null in earlier rows; marks count as flags."""
        rows = self._shown(table, self._stored(table))
        if table == ANOMALIES and self.exists(MARKS):
            marks = self._stored(MARKS).select("anomaly_id").distinct().withColumn("_marked", F.lit(True))
            flag = F.col("alerted") | F.coalesce("_marked", F.lit(False))
            rows = rows.join(marks, "anomaly_id", "left").withColumn("alerted", flag).select(*map(quoted, rows.columns))
        return rows

    def read_partitions(self, table: str, where: Column) -> DataFrame:
        """The rows of the partitions that a condition on partition columns names; no others are read."""
        return self._shown(table, self._stored(table).filter(where))

    def read_near(self, table: str, df: DataFrame) -> DataFrame:
        """The rows of the partitions that the rows of ``df``, which have what those are made of, lie in."""
        places = _partitioned(table, df).select(*PARTITIONS[table]).distinct().collect()
        return self.read_partitions(table, _within(places, list(PARTITIONS[table])) if places else F.lit(False))

    def _shown(self, table: str, stored: DataFrame) -> DataFrame:
        own = _ALL[table].names if table in _ALL else []
        later = [c for c in stored.columns if c not in own and c not in PARTITIONS.get(table, ())]
        return stored.select(*map(quoted, [*own, *later]))

    def append(self, table: str, df: DataFrame) -> int:
        """Add rows, which may bring new columns, and return how many were written. No rows add no file."""
        self._widen(table, df)
        even, written = self._even(table, df)
        even.write.insertInto(self.name(table))
        return written.get["rows"]

    def overwrite(self, table: str, df: DataFrame) -> int:
        """Replace the table, which may be read by ``df`` itself, and return how many rows were written."""
        self.create(table, _ALL.get(table, df.schema))
        folder, rows = self._save(table, df)
        self._widen(table, df)
        if PARTITIONS.get(table):
            self._switch(table, self._partitions_in(table, folder), folder, others=False)
        else:
            self._alter(table, f"SET LOCATION {literal(folder)}")
        return rows

    def upsert(
        self,
        table: str,
        df: DataFrame,
        keys: Sequence[str],
        update_columns: Sequence[str] | None = None,
        insert: bool = True,
    ) -> int:
        """Update rows by key, add new ones, and return how many rows came in.

        Only partitions that the rows lie in are read and rewritten: their values, at most as many as the catalog has or
        gets partitions, become literals in the plan. Rows that lack what a table is partitioned by can update
        only; their partitions are found by the keys, which is the one case that reads a column of all partitions.
        """
        parts = PARTITIONS.get(table, {})
        made_of = {column for column, _ in parts.values()}
        if made_of & set(update_columns if update_columns is not None else set(df.columns) - set(keys)):
            raise ValueError(f"an upsert cannot move rows of {table!r} to other partitions")
        staged, coming = f"{self.place}/_coming/{uuid.uuid4().hex}", Observation()
        try:
            df.observe(coming, F.count(F.lit(1)).alias("rows")).write.parquet(staged)
            rows = self.spark.read.schema(df.schema).parquet(staged)
            for _ in range(self.attempts):
                if self._upserted(table, rows, keys, update_columns, insert):
                    return coming.get["rows"]
            raise RuntimeError(f"{table!r} was changed by others during each of {self.attempts} attempts to upsert into it")
        finally:
            remove_folder(self.spark, staged)

    def _upserted(self, table: str, rows: DataFrame, keys: Sequence[str], updates: Sequence[str] | None, insert: bool) -> bool:
        """One attempt; false if another write changed the partitions in the meantime."""
        parts = PARTITIONS.get(table, {})
        stored, touched, places = self._stored(table), self._stored(table), []
        if parts:
            placed = {column for column, _ in parts.values()} <= set(keys)
            found = _partitioned(table, rows) if placed else stored.join(rows.select(*keys), list(keys), "left_semi")
            places = found.select(*parts).distinct().collect()
            if not places:
                return True
            touched = stored.filter(_within(places, list(parts)))
        seen = set(touched.inputFiles())
        folder, _ = self._save(table, upsert(self._shown(table, touched), rows, keys, updates, insert))
        self.spark.catalog.refreshTable(self.name(table))
        now = self._stored(table)
        if set((now.filter(_within(places, list(parts))) if parts else now).inputFiles()) != seen:
            remove_folder(self.spark, folder)
            return False
        if parts:
            self._switch(table, places, folder)
        else:
            self._alter(table, f"SET LOCATION {literal(folder)}")
        return True

    def fold_marks(self, at_least: int = 1) -> int:
        """Set the flags of marked anomalies in the log's files, if that many are marked, and drop their marks.

        Returns how many marks were folded in. Only the days of the marked anomalies are rewritten.
        """
        self.create(MARKS)
        marks = self._stored(MARKS).select("anomaly_id").distinct()
        if marks.count() < at_least:
            return 0
        folder = f"{self.place}/_coming/{uuid.uuid4().hex}"
        try:
            marks.write.parquet(folder)
            folded = self.spark.read.schema(marks.schema).parquet(folder)
            count = self.upsert(ANOMALIES, folded.withColumn("alerted", F.lit(True)), ["anomaly_id"], ["alerted"], insert=False)
            # Marks that came in meanwhile stay.
            self.overwrite(MARKS, self.read(MARKS).join(folded, "anomaly_id", "left_anti"))
        finally:
            remove_folder(self.spark, folder)
        return count

    def reset(self, confirm: str) -> None:
        """Empty the history tables. Rules are kept."""
        if confirm != RESET_WORD:
            raise ValueError(f"nothing was reset; pass confirm={RESET_WORD!r}")
        for table in HISTORY_TABLES:
            if self.exists(table):
                self.overwrite(table, self._stored(table).limit(0))

    def compact(self, table: str) -> int:
        """Rewrite a table that has gathered many small appends."""
        return self.overwrite(table, self._stored(table))

    def vacuum(self, table: str, older_than_hours: float = 24.0) -> int:
        """Delete files that no longer belong to the table and are older than that; returns how many.

        The time has to be longer than any read or write takes.
        """
        self.spark.catalog.refreshTable(self.name(table))
        used = self._stored(table).inputFiles()
        return remove_unused(self.spark, f"{self.place}/{table}", used, older_than_hours)

    def _alter(self, table: str, change: str) -> None:
        self.spark.sql(f"ALTER TABLE IDENTIFIER(:name) {change}", args={"name": self.name(table)})
        self.spark.catalog.refreshTable(self.name(table))

    def _widen(self, table: str, df: DataFrame) -> None:
        """Add the columns that ``df`` brings."""
        known = {c.lower() for c in self._stored(table).columns}
        new = [f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema if f.name.lower() not in known]
        if new:
            self._alter(table, f"ADD COLUMNS ({', '.join(new)})")

    def _even(self, table: str, df: DataFrame) -> tuple[DataFrame, Observation]:
        """The rows as they are written, and what counts them.

        Hits are few rows out of very many tasks, or nearly all rows of a few; either way they are evened out
        into files of a sensible size. Rows are counted after that, in the tasks that write them.
        """
        written, parts = Observation(), PARTITIONS.get(table, {})
        held, target = {c.lower() for c in df.columns}, self._stored(table).schema
        lacking = {f.name: F.lit(None).cast(f.dataType) for f in target if f.name.lower() not in held and f.name not in parts}
        full = _partitioned(table, df.withColumns(lacking) if lacking else df)
        known = {c.lower() for c in target.names}
        new = [c for c in df.columns if c.lower() not in known]
        body = [c for c in target.names if c not in parts]
        even = full.select(*map(quoted, [*body, *new, *parts])).hint("rebalance", *parts)
        return even.observe(written, F.count(F.lit(1)).alias("rows")), written

    def _save(self, table: str, df: DataFrame) -> tuple[str, int]:
        """Write rows to a folder of their own, which is no part of the table yet."""
        even, written = self._even(table, df)
        folder = self._new_folder(table)
        even.write.partitionBy(*PARTITIONS.get(table, ())).parquet(folder)
        return folder, written.get["rows"]

    def _partitions_in(self, table: str, folder: str) -> list[Row]:
        parts, schema = list(PARTITIONS[table]), self._stored(table).schema
        return self.spark.read.schema(schema).parquet(folder).select(*parts).distinct().collect()

    def _switch(self, table: str, places: Sequence[Row], folder: str, others: bool = True) -> None:
        """Let the partitions be what a folder holds of them; without ``others`` the table has no other partitions.

        New ones come in one statement; only those that were there before are switched one by one.
        """
        parts = list(PARTITIONS[table])
        values = [{part: str(place[part]) for part in parts} for place in places]
        if values:
            listed = set(self._listed(table))
            there = [value for value in values if _path("", value)[1:] in listed]
            new = [value for value in values if _path("", value)[1:] not in listed]
            if new:
                added = " ".join(f"PARTITION ({_spec(v)}) LOCATION {literal(_path(folder, v))}" for v in new)
                try:
                    self._alter(table, f"ADD {added}")
                except AnalysisException:  # another writer added some of them meanwhile
                    self._alter(table, f"ADD IF NOT EXISTS {added}")
                    there = values
            for value in there:
                self._alter(table, f"PARTITION ({_spec(value)}) SET LOCATION {literal(_path(folder, value))}")
        if not others:
            kept = {_path("", value)[1:] for value in values}
            gone = [place for place in self._listed(table) if place not in kept]
            self._drop(table, [dict(_unescaped(step.split("=", 1)) for step in place.split("/")) for place in gone])

    def _listed(self, table: str) -> list[str]:
        """The names of the table's partitions, as in the paths of their folders."""
        return [place for (place,) in self.spark.sql("SHOW PARTITIONS IDENTIFIER(:name)", args={"name": self.name(table)}).collect()]

    def _drop(self, table: str, places: Sequence[dict[str, str]]) -> None:
        if places:
            self._alter(table, "DROP IF EXISTS " + ", ".join(f"PARTITION ({_spec(place)})" for place in places))

    def drop_partitions(self, table: str, where: Column) -> int:
        """Take the partitions that a condition on partition columns names out of the table; returns how many."""
        places = self._stored(table).filter(where).select(*PARTITIONS[table]).distinct().collect()
        self._drop(table, [{part: str(place[part]) for part in PARTITIONS[table]} for place in places])
        return len(places)


def _partitioned(table: str, df: DataFrame) -> DataFrame:
    """The rows with the partition columns that are made of others."""
    made = {}
    for part, (column, form) in PARTITIONS.get(table, {}).items():
        if part in df.columns:
            continue
        made[part] = F.lit(NO_TIME) if column not in df.columns else F.coalesce(F.date_format(column, form), F.lit(NO_TIME))
    return df.withColumns(made) if made else df


def _within(places: Sequence[Row], parts: Sequence[str]) -> Column:
    """Whether a row lies in one of the partitions, or, if they are very many, in one of like values of each column."""
    first, *rest = parts
    if len(places) > NAMED_PARTITIONS or not rest:
        return reduce(lambda a, b: a & b, (F.col(p).isin(*sorted({place[p] for place in places})) for p in parts))
    grouped: dict[str, list[Row]] = defaultdict(list)
    for place in places:
        grouped[place[first]].append(place)
    return reduce(or_, ((F.col(first) == value) & _within(some, rest) for value, some in sorted(grouped.items())))


# Characters that stand as % and two digits in the names of partition folders, besides control characters.
_ESCAPED = "\"#%'*/:=?\\\x7f{[]^"


def _escaped(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED or c < " " else c for c in value)


def _unescaped(step: Collection[str]) -> list[str]:
    out = []
    for text in step:
        parts = text.split("%")
        out.append(parts[0] + "".join(chr(int(part[:2], 16)) + part[2:] for part in parts[1:]))
    return out


def _path(folder: str, value: dict[str, str]) -> str:
    return folder + "".join(f"/{part}={_escaped(text)}" for part, text in value.items())


def _spec(value: dict[str, str]) -> str:
    return ", ".join(f"{quoted(part)} = {literal(text)}" for part, text in value.items())
