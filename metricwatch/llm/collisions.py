"""Near-duplicate vectors by collision counting over one-dimensional projections.

Vectors are projected on many random directions. Two vectors collide on a direction if one lies in the window of fixed width
around the other; near vectors collide on most directions, others on few. Each projection of a block is sorted, the windows of
all its vectors are read off the order, and collisions are counted per pair; pairs that reach the count are verified by
their cosine. Width, count and number of tables are set by recall: pairs of exactly the threshold's cosine are planted
next to a bounded sample, and RECALL of them must pass.

Windows on one line hold a fixed share of all vectors, so the vectors are first dealt to cells, by the side of the median
they lie on in further projections, in several tables; a pair is judged in the first table whose cell it shares. A cell of
more than BLOCK vectors is compared in blocks of parts (see `pairs`). A block gives sums of links and a forest of
them, so a group of near copies costs its comparisons but makes no row per pair.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.components import components
from metricwatch.llm.pairs import blocked
from metricwatch.llm.shared import stored
from metricwatch.llm.text import gather

#: Vectors with the least hash that the medians and the recall are learnt from, at most.
SAMPLE, PLANTED = 20_000, 4_000
#: Of pairs with exactly the threshold's cosine, the share that must share a cell, and that must reach the count.
RECALL = 0.995
#: Directions that collisions are counted on, and half a window's width in distances of a pair at the threshold.
DIRECTIONS, WIDTH = 16, 1.6
#: Vectors of a cell on the average at most twice as many, and of a part of a block.
CELL, BLOCK = 2_048, 2_048
#: Pairs whose collisions are counted, and pairs that are verified, at a time.
COUNTED, VERIFIED = 4_000_000, 50_000
MAX_BITS = 48


@dataclass(frozen=True)
class Projections:
    """Directions that every worker draws anew from the seed, and what was learnt for them."""

    size: int  # components of a vector
    cuts: np.ndarray  # (tables, bits): medians of the projections that deal to cells
    need: int  # collisions of a pair that is verified
    width: float
    threshold: float
    seed: int = 11

    def counted(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors on the directions that collisions are counted on."""
        return x @ np.random.default_rng(self.seed).normal(size=(self.size, DIRECTIONS))

    def cells(self, x: np.ndarray) -> np.ndarray:
        """(vectors, tables): the cell of each unit vector in each table."""
        tables, bits = self.cuts.shape
        out = np.zeros((len(x), tables), np.int64)
        if bits:
            for table in range(tables):
                above = x @ _dealing(self.size, bits, table, self.seed) > self.cuts[table]
                out[:, table] = above @ (np.int64(1) << np.arange(bits, dtype=np.int64))
        return out


def _dealing(size: int, bits: int, table: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, table]).normal(size=(size, bits))


def learn(sample: np.ndarray, n: int, threshold: float) -> Projections:
    """Cells for n vectors, and the count and number of tables that the planted pairs call for."""
    size, rng = sample.shape[1], np.random.default_rng(3)
    x = sample[:PLANTED]
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-300)
    y = threshold * x + np.sqrt(1 - threshold**2) * aside
    width = WIDTH * float(np.sqrt(2 - 2 * threshold))
    plain = Projections(size, np.zeros((1, 0)), 0, width, threshold)
    collided = (np.abs(plain.counted(x) - plain.counted(y)) <= width).sum(1)
    need = int(np.quantile(collided, 1 - RECALL, method="lower")) if len(x) else 0
    bits = min(MAX_BITS, max(0, int(np.log2(max(n, 1) / CELL)))) if len(x) else 0
    cuts, apart = [], np.ones(len(x), bool)
    while bits and (not cuts or apart.mean() > 1 - RECALL):
        directions = _dealing(size, bits, len(cuts), plain.seed)
        cuts.append(np.median(sample @ directions, axis=0))
        apart &= ((x @ directions > cuts[-1]) != (y @ directions > cuts[-1])).any(1)
    return Projections(size, np.array(cuts) if cuts else np.zeros((1, 0)), need, width, threshold)


def collided(a: np.ndarray, b: np.ndarray, width: float, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a and of b that lie in each other's window on at least `need` of the columns."""
    order = np.argsort(b, axis=0, kind="stable")
    inside = np.take_along_axis(b, order, axis=0)
    low = np.stack([np.searchsorted(inside[:, k], a[:, k] - width, "left") for k in range(a.shape[1])], axis=1)
    high = np.stack([np.searchsorted(inside[:, k], a[:, k] + width, "right") for k in range(a.shape[1])], axis=1)
    found_a, found_b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, COUNTED // max(len(b), 1))
    for at in range(0, len(a), step):
        rows = np.arange(at, min(at + step, len(a)))
        counts = np.zeros(len(rows) * len(b), np.uint16)
        for k in range(a.shape[1]):
            lengths = high[rows, k] - low[rows, k]
            place = order[gather(low[rows, k], lengths), k] + np.repeat((rows - at) * len(b), lengths)
            counts[place] += 1  # a column holds each pair once
        passed = np.flatnonzero(counts >= max(need, 1)) if need else np.arange(len(counts))
        found_a.append(at + passed // max(len(b), 1))
        found_b.append(passed % max(len(b), 1))
    return np.concatenate(found_a), np.concatenate(found_b)


def _linked(x: np.ndarray, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of rows have the cosine, in double precision on the vectors as given."""
    norms, out = np.sqrt(np.einsum("ij,ij->i", x, x)), np.zeros(len(a), bool)
    for at in range(0, len(a), VERIFIED):
        i, j = a[at : at + VERIFIED], b[at : at + VERIFIED]
        out[at : at + VERIFIED] = np.einsum("ij,ij->i", x[i], x[j]) >= threshold * norms[i] * norms[j]
    return out


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least row that each of n rows reaches by pairs."""
    label = np.arange(n)
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if np.array_equal(label, before):
            return label


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def links(classes: DataFrame, threshold: float) -> DataFrame:
    """key, links, to: sums of the rows linked with those of a class, and a forest that ties linked classes (to not null).

    `classes` has key, rows and v: different usable vectors of one length, and how many rows each stands for.
    """
    size, n = (classes.agg(F.max(F.size("v")), F.count(F.lit(1)))).first()
    schema = "key string, links long, `to` string"
    if not n:
        return classes.sparkSession.createDataFrame([], schema)
    sample = classes.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("v").toArrow()
    fitted = learn(_unit(_matrix(sample["v"])), n, threshold)
    tables = len(fitted.cuts)

    def deal(batches):
        for batch in batches:
            if batch.num_rows:
                cells = fitted.cells(_unit(_matrix(batch.column("v"))))
                before = pa.array([b""] * len(cells), pa.binary())  # cells in the tables before: computed anew they might round differently
                for table in range(tables):
                    columns = [pa.array(np.full(len(cells), table, np.int32)), pa.array(cells[:, table].copy()), before, *batch.columns]
                    before = pa.array([row.tobytes() for row in cells[:, : table + 1]], pa.binary())
                    yield pa.RecordBatch.from_arrays(columns, ["table", "cell", "before", *batch.schema.names])

    def compare(group: pa.Table) -> pa.Table:
        table, x = group["table"][0].as_py(), _matrix(group["v"])
        unit = _unit(x)
        cells = np.frombuffer(b"".join(group["before"].to_pylist()), np.int64).reshape(len(x), table)
        places = fitted.counted(unit)
        side = group["side"].to_numpy()
        alike = group["left"][0] == group["right"][0]
        left, right = (np.arange(len(x)),) * 2 if alike else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        a, b = collided(places[left], places[right], fitted.width, fitted.need)
        a, b = left[a], right[b]
        kept = (a < b) if alike else np.ones(len(a), bool)
        a, b = a[kept], b[kept]
        earlier = np.zeros(len(a), bool)
        for k in range(table):
            earlier |= cells[a, k] == cells[b, k]
        a, b = a[~earlier], b[~earlier]
        near = _linked(x / np.abs(x).max(1, keepdims=True), a, b, threshold)
        a, b = a[near], b[near]
        rows, sums = group["rows"].to_numpy(), np.zeros(len(x), np.int64)
        np.add.at(sums, a, rows[b])
        np.add.at(sums, b, rows[a])
        least = least_reached(len(x), a, b)
        some = np.flatnonzero(sums)
        to = pa.array(np.where(least == np.arange(len(x)), -1, least)[some])
        to = group["key"].combine_chunks().take(pa.compute.if_else(pa.compute.less(to, 0), None, to))
        return pa.table({"key": group["key"].take(pa.array(some)), "links": pa.array(sums[some]), "to": to})

    dealt = classes.select("key", "rows", "v").mapInArrow(deal, f"`table` int, cell long, before binary, key string, rows long, v {classes.schema['v'].dataType.simpleString()}")
    met = blocked(dealt, ["table", "cell"], "key", BLOCK)
    return met.groupBy("table", "cell", "left", "right").applyInArrow(compare, schema)


def near_vectors(vectors: DataFrame, threshold: float = 0.95, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row, with the rows that its vector has the cosine with, and the least
    id that it reaches by links, its own included; kept if that is its own.

    Equal vectors are compared once, as a class. Vectors that are null, empty, zero or hold null or non-finite components, and
    vectors of another length than the longest, link with nothing. Rows that share an id are rows of their own; they
    count as links where their vectors link. A row without an id links, but names no component; a component
    without any id has none, and its rows are kept. Other columns are left out. An empty table gives no rows.
    """
    given = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).alias("v"))
    usable = _usable(F.col("v"))
    longest = given.filter(usable).agg(F.max(F.size("v"))).first()[0] or 0
    name = F.concat(F.hex(F.xxhash64("v")), F.hex(F.xxhash64(F.lit(1), "v")))
    named = given.withColumn("key", F.when(usable & (F.size("v") == longest), name))
    grouped = named.filter("key IS NOT NULL").groupBy("key")
    classes = stored(grouped.agg(F.count(F.lit(1)).alias("rows"), F.min("vec_id").alias("least"), F.first("v").alias("v")))
    found = stored(links(classes, threshold))
    sums = found.groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(found.filter("`to` IS NOT NULL"), "key", "to").select(F.col("node").alias("key"), "component")
    placed = classes.select("key", "rows", "least").join(sums, "key", "left").join(joined, "key", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "key")))
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    own = placed.join(least, "component").select(
        "key", (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("component_id").alias("component_id")
    )
    back = named.select("vec_id", "key").join(own, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return back.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )
