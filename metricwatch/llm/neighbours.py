"""Nearest vectors by inner product, through balanced posting lists.

The vectors get one more component so that the largest inner product is the least distance. A bounded sample is cut
into equal halves again and again; the means of the parts are the lists' centroids, which a small graph ties together.
Every vector goes to the list of its nearest centroid, and near a boundary to further ones. A query searches the graph and reads the lists whose centroid is not much farther than the nearest.

Lists are dealt to slots of bounded size, several short ones or a piece of a long one each, so a list of any length and a
vector that many rows share are many even pieces of work. A query goes once to each slot in which it reads, with the lists
that it reads there. Each slot yields its queries' best, and those are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from metricwatch.llm.shared import stored

#: Vectors that the centroids are learnt from at most, those with the least hash of their id.
SAMPLE = 40_000
#: Vectors of the table per list, if the sample has at least SAMPLE_PER_LIST for each.
LIST_SIZE, SAMPLE_PER_LIST = 256, 16
#: Edges of a centroid in the graph, and nearest centroids that a search walks on from at least.
EDGES, VIEW = 24, 16
#: A vector is also filed under centroids up to so many times as far as the nearest, REPLICAS in all.
BOUNDARY, REPLICAS = 1.03, 4
#: A query reads the lists of centroids up to so many times as far as the nearest that this share of the nearest neighbours of
#: the sample's own queries, ASKED at most, is found among the sample.
RECALL, ASKED = 0.94, 400
#: Bytes of the vectors of a slot, and of the queries that are compared with a slot at a time.
SLOT_BYTES, ASK_BYTES = 16 << 20, 8 << 20
#: Rows of a block of vectors or of queries, and results that a task holds before it drops all but each query's best.
BLOCK_ROWS, HELD = 512, 200_000
#: Pairs of a vector and a centroid that a walk looks at together, and pairs whose vectors are laid side by side.
CELLS, PAIRS = 1 << 18, 8192


@dataclass(frozen=True)
class Centroids:
    points: np.ndarray  # (lists, dimensions + 1)
    graph: np.ndarray  # (lists, edges)
    radius: float  # of the ball that all vectors lie in
    prune: float = 1.0  # how much farther than the nearest centroid a query's lists may lie

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the component that brings all to the same length."""
        rest = np.sqrt(np.maximum(self.radius**2 - (x**2).sum(1), 0))
        return np.hstack([x, rest[:, None]])

    def walk(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances of points to all centroids that a walk on the graph meets; infinite where it met none.

        The walk starts at a few centroids and goes on from every one that is among the VIEW nearest met so far, or
        at most `ratio` times as far as the nearest.
        """
        n, norms, own = len(self.points), (self.points**2).sum(1), (x**2).sum(1)
        gaps = np.full((len(x), n), np.inf)
        walked = np.zeros((len(x), n), bool)
        entry = np.unique(np.linspace(0, n - 1, min(n, 16)).astype(np.int64))
        new = (np.repeat(np.arange(len(x)), len(entry)) * n + np.tile(entry, len(x))) if len(x) else np.zeros(0, np.int64)
        while len(new):
            q, c = new // n, new % n
            squares = own[q] + norms[c] - 2 * _products(x, q, self.points, c)
            gaps.ravel()[new] = np.sqrt(np.maximum(squares, 0))
            bound = ratio * gaps.min(1)
            if n > VIEW:
                bound = np.maximum(bound, np.partition(gaps, VIEW, axis=1)[:, VIEW])
            q, c = np.nonzero(~walked & np.isfinite(gaps) & (gaps <= bound[:, None]))
            walked[q, c] = True
            reached = np.zeros(gaps.size, bool)
            for at in range(0, len(q), PAIRS):
                reached[q[at : at + PAIRS, None] * n + self.graph[c[at : at + PAIRS]]] = True
            new = np.flatnonzero(reached & np.isinf(gaps.ravel()))
        return gaps

    def pieces(self, x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """The points in pieces that a walk has memory for, each with the number of its first."""
        step = max(1, CELLS // len(self.points))
        for at in range(0, len(x), step):
            yield at, x[at : at + step]

    def filed(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and list of every entry: the nearest list, and further ones for vectors near a boundary.

        A further list counts only if its centroid is nearer to the vector than to the centroids that the vector is filed
        under: between those it adds a way to the vector, and else the same queries read both lists.
        """
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for at, part in self.pieces(x):
            row, lists = self._kept(self.walk(part, BOUNDARY))
            found.append((at + row, lists))
        return tuple(map(np.concatenate, zip(*found, strict=True)))

    def _kept(self, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(gaps, 1, kind="stable")[:, :REPLICAS]
        near = np.take_along_axis(gaps, order, 1)
        kept = near <= BOUNDARY * near[:, :1]
        centres = self.points[order]
        for j in range(1, order.shape[1]):
            apart = np.sqrt(((centres[:, j, None] - centres[:, :j]) ** 2).sum(2))
            kept[:, j] &= ((near[:, j, None] < apart) | ~kept[:, :j]).all(1)
        row, at = np.nonzero(kept)
        return row, order[row, at]

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """Distances of points to all centroids."""
        squares = (x**2).sum(1)[:, None] + (self.points**2).sum(1) - 2 * x @ self.points.T
        return np.sqrt(np.maximum(squares, 0))

    def read(self, x: np.ndarray) -> np.ndarray:
        """Whether a query reads a list, as (queries, lists)."""
        out = np.zeros((len(x), len(self.points)), bool)
        for at, part in self.pieces(x):
            gaps = self.walk(part, self.prune)
            out[at : at + len(part)] = gaps <= self.prune * gaps.min(1, keepdims=True)
        return out


def learn(x: np.ndarray, lists: int, radius: float, k: int = 20, seed: int = 5) -> Centroids:
    """Centroids of `lists` parts of the sample, equal in size but for one vector or so."""
    empty = Centroids(np.zeros((1, x.shape[1] + 1)), np.zeros((1, 1), np.int64), radius)
    if not len(x):
        return empty
    points, rng = empty.lifted(x), np.random.default_rng(seed)
    parts, todo = [], [(np.arange(len(points)), lists)]
    while todo:
        rows, share = todo.pop()
        if share <= 1 or len(rows) < 2:
            parts.append(rows)
            continue
        part = points[rows]
        a, b = part[rng.choice(len(rows), 2, replace=False)]
        for _ in range(4):  # two means give the direction to cut across
            side = part @ (b - a) > (b @ b - a @ a) / 2
            if side.all() or not side.any():
                break
            a, b = part[~side].mean(0), part[side].mean(0)
        order = np.argsort(part @ (b - a), kind="stable")
        left = share // 2
        cut = max(1, min(len(rows) - 1, len(rows) * left // share))
        todo += [(rows[order[:cut]], left), (rows[order[cut:]], share - left)]
    means = np.stack([points[p].mean(0) for p in parts])
    return _calibrated(Centroids(means, _graph(means, rng), radius), x, k)


def _calibrated(centroids: Centroids, x: np.ndarray, k: int) -> Centroids:
    """The centroids with the least `prune` by which queries of the sample find RECALL of their k nearest in the sample."""
    rows = np.unique(np.linspace(0, len(x) - 1, min(ASKED, len(x))).astype(np.int64))
    asked = np.hstack([_scaled(x[rows], centroids.radius), np.zeros((len(rows), 1))]) if len(rows) else np.zeros((0, 1))
    lists = np.full((len(x), REPLICAS), -1)
    for at in range(0, len(x), 1024):
        row, found = centroids._kept(centroids.gaps(centroids.lifted(x[at : at + 1024])))
        lists[at + row, np.arange(len(row)) - np.searchsorted(row, row)] = found
    needed = [np.ones(1)]
    for at in range(0, len(rows), 64):
        some = rows[at : at + 64]
        scores = x[some] @ x.T
        scores[np.arange(len(some)), some] = -np.inf
        best = np.argpartition(-scores, min(k, scores.shape[1]) - 1, axis=1)[:, :k] if len(x) > 1 else np.zeros((0, 0), np.int64)
        gaps = centroids.gaps(asked[at : at + 64])
        gaps = np.hstack([gaps / gaps.min(1, keepdims=True), np.full((len(some), 1), np.inf)])  # the last stands for no list
        for q in range(len(best)):
            needed.append(gaps[q][lists[best[q]]].min(axis=1))
    return replace(centroids, prune=float(np.quantile(np.concatenate(needed), RECALL, method="higher")))


def _graph(points: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Each point's nearest others, and a few at random so that no part is cut off."""
    n = len(points)
    if n <= EDGES:
        return np.tile(np.arange(n), (n, 1))
    norms = (points**2).sum(1)
    out = np.empty((n, EDGES), np.int64)
    far = EDGES // 6
    for at in range(0, n, 1024):
        gaps = norms - 2 * points[at : at + 1024] @ points.T
        gaps[np.arange(len(gaps)), np.arange(at, at + len(gaps))] = np.inf
        out[at : at + len(gaps), far:] = np.argpartition(gaps, EDGES - far, 1)[:, : EDGES - far]
    out[:, :far] = rng.integers(0, n, (n, far))
    out[:, 0] = (np.arange(n) + 1) % n
    return out


def _usable(vector: Column) -> Column:
    """Vectors that are not null, empty or zero and hold only finite numbers."""
    finite = F.forall(vector, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def _column(points: np.ndarray) -> pa.Array:
    offsets = np.arange(len(points) + 1, dtype=np.int32) * np.int32(points.shape[1])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(points.ravel()))


def _products(x: np.ndarray, q: np.ndarray, y: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of the rows x[q] and y[v], pair by pair, in slices."""
    out = np.empty(len(q))
    for at in range(0, len(q), PAIRS):
        some = slice(at, at + PAIRS)
        out[some] = np.einsum("ij,ij->i", x[q[some]], y[v[some]])
    return out


def _slots(counts: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Each list's first slot and how many it has: lists in sequence share one of at most `most` entries, a longer list has several."""
    first, parts = np.zeros(len(counts), np.int64), np.maximum(-(-counts // most), 1)
    slot, filled = -1, most
    for i, n in enumerate(counts):
        if slot < 0 or filled + n > most:
            slot, filled = slot + 1, 0
        first[i] = slot
        slot, filled = slot + parts[i] - 1, filled + n
    return first, parts


def nearest_vectors(
    vectors: DataFrame,
    every: int = 20,
    k: int = 20,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row whose id is divisible by `every`, itself left out.

    Nearness is the inner product in double precision, ties go to the smaller id; with fewer candidates all that are found
    come back. Vectors that are null, zero, hold null or non-finite components, lack an id, or have another length
    than the longest take no part. Of rows with the same id and vector one counts; with other vectors, each id's best counts.
    """
    spark = vectors.sparkSession
    usable = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")
    ).filter(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    is_asked = F.col("vec_id") % every == 0
    n, n_asked, size, reach = usable.agg(F.count(F.lit(1)), F.count_if(is_asked), F.max(F.size("v")), F.max(F.sqrt(square))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n:
        return spark.createDataFrame([], schema)
    usable = usable.filter(F.size("v") == size)
    # Hashes are even, so a bound on them leaves enough rows, but for ids that many rows share.
    hashed = F.xxhash64("vec_id")
    bound = int(min(1.25 * SAMPLE / n, 1) * (1 << 64)) - (1 << 63)
    for rows in (usable.filter(hashed < bound), usable) if bound < 1 << 63 else (usable,):
        sample = rows.orderBy(hashed, "vec_id", F.xxhash64("v")).limit(SAMPLE).select("v").toArrow()
        if len(sample) == SAMPLE:
            break
    x = _matrix(sample.column("v").combine_chunks()) if len(sample) else np.zeros((0, size))
    lists = max(1, min(n // LIST_SIZE, len(x) // SAMPLE_PER_LIST))
    # As large as the sample allows: SAMPLE / SAMPLE_PER_LIST points.
    centroids = spark.sparkContext.broadcast(learn(x, lists, float(reach), k))
    # Vectors travel in the type that they came in.
    vector = vectors.select(vector_column).schema[0].dataType
    width, kind = (4, "float") if isinstance(vector.elementType, FloatType) else (8, "double")

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, points = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"))
            row, at = centroids.value.filed(centroids.value.lifted(points))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(ids[row]), _column(points[row].astype(f"f{width}"))], ["list", "vec_id", "v"])

    base = stored(usable.mapInArrow(file, f"list int, vec_id long, v array<{kind}>"))
    counts = np.zeros(len(centroids.value.points), np.int64)
    for row in base.groupBy("list").count().collect():
        counts[row["list"]] = row["count"]
    # Two slots a core, unless they would be short or above SLOT_BYTES.
    even = counts.sum() // (2 * spark.sparkContext.defaultParallelism)
    first, parts = _slots(counts, int(min(max(4 * LIST_SIZE, even), max(1, SLOT_BYTES // (width * size)))))
    shares = -(-n_asked * width * size // ASK_BYTES) or 1

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, share, points = batch.column("vec_id").to_numpy(), batch.column("share").to_numpy(), _matrix(batch.column("v"))
            lifted = np.hstack([_scaled(points, centroids.value.radius), np.zeros((len(points), 1))])
            read, points = centroids.value.read(lifted), points.astype(f"f{width}")
            for slot in range(first[-1] + parts[-1]):
                own = read[:, _lists(first, parts, slot)]
                rows = np.flatnonzero(own.any(1))
                if len(rows):
                    bits = [x.tobytes() for x in np.packbits(own[rows], axis=1)]
                    arrays = [pa.array(np.full(len(rows), slot, np.int32)), pa.array(share[rows]), pa.array(ids[rows]), _column(points[rows]), pa.array(bits, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, ["slot", "share", "query_id", "v", "lists"])

    def of(per_list: np.ndarray) -> Column:
        return F.get(F.split(F.lit(",".join(map(str, per_list))), ",").cast("array<int>"), F.col("list"))

    number = F.monotonically_increasing_id()
    asked = usable.filter(is_asked).withColumn("share", F.pmod(number, F.lit(shares)).cast("int"))
    asked = asked.mapInArrow(ask, f"slot int, share int, query_id long, v array<{kind}>, lists binary")
    base = base.withColumn("slot", (of(first) + F.pmod(number, of(parts))).cast("int"))
    base = base.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def best(key: tuple, ask: pa.Table, base: pa.Table) -> pa.Table:
        """Each query's k best of a slot; what is not above the k-th best found so far is no result."""
        held = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if len(ask) and len(base):
            lists = _lists(first, parts, key[0].as_py())
            read = np.frombuffer(b"".join(ask.column("lists").to_pylist()), np.uint8).reshape(len(ask), -1)
            read = np.unpackbits(read, axis=1, count=lists.stop - lists.start).astype(bool)
            asks, points = (_matrix(t.column("v").combine_chunks()) for t in (ask, base))
            ids, at = base.column("vec_id").to_numpy(), base.column("list").to_numpy()
            queries, known_at = np.unique(ask.column("query_id").to_numpy(), return_inverse=True)
            least = np.full(len(queries), -np.inf)
            count = limit = 0
            order = np.argsort(at, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                asking = np.flatnonzero(read[:, at[rows[0]] - lists.start])
                for some, q in product(_cut(rows), _cut(asking)):
                    held.append(_best_of(queries[known_at[q]], asks[q].astype(float), ids[some], points[some].astype(float), least[known_at[q]], k))
                    count += len(held[-1][0])
                    if count > limit + HELD:
                        held = [_best(*map(np.concatenate, zip(*held, strict=True)), k)]
                        count = limit = len(held[0][0])
                        full, start, found = np.unique(held[0][0], return_index=True, return_counts=True)
                        least[np.searchsorted(queries, full)] = np.where(found == k, held[0][2][start + found - 1], -np.inf)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), _best(*map(np.concatenate, zip(*held, strict=True)), k), strict=True)))

    by_slot = asked.groupBy("slot", "share").cogroup(base.groupBy("slot", "share"))
    met = by_slot.applyInArrow(best, "query_id long, vec_id long, score double")
    pairs = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))  # lists overlap
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _lists(first: np.ndarray, parts: np.ndarray, slot: int) -> slice:
    """The lists that have entries in a slot."""
    return slice(int(np.searchsorted(first + parts - 1, slot)), int(np.searchsorted(first, slot, "right")))


def _cut(rows: np.ndarray) -> list[np.ndarray]:
    return [rows[at : at + BLOCK_ROWS] for at in range(0, len(rows), BLOCK_ROWS)]


def _best_of(
    ask: np.ndarray, asks: np.ndarray, ids: np.ndarray, points: np.ndarray, known: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, vector and score of those pairs of a block pair that may be among a query's k best.

    `known` is the k-th best score that each query has already, or minus infinity.
    """
    # A matrix product may round the same pair of vectors in several ways, so it only tells which pairs come into question.
    near = asks @ points.T
    near[ask[:, None] == ids[None, :]] = -np.inf
    slack = 4 * asks.shape[1] * np.finfo(float).eps * np.sqrt((asks**2).sum(1) * (points**2).sum(1).max())
    new = np.isneginf(known)
    if len(ids) > k and new.any() and len(np.unique(ids)) == len(ids):  # rows with one id count once
        known = known.copy()
        known[new] = np.partition(near[new], -k, axis=1)[:, -k] - slack[new]
    q, v = np.nonzero((near >= (known - slack)[:, None]) & np.isfinite(near))
    scores = _products(asks, q, points, v)
    kept = (scores >= known[q]) & np.isfinite(scores)
    return ask[q[kept]], ids[v[kept]], scores[kept]


def _best(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each query's k best, ties to the smaller id; of a vector that was met several times, its best."""
    order = np.lexsort((-score, vec, query))
    query, vec, score = query[order], vec[order], score[order]
    new = np.ones(len(query), bool)
    new[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
    query, vec, score = query[new], vec[new], score[new]
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    first = np.searchsorted(query, query)
    kept = np.arange(len(query)) - first < k
    return query[kept], vec[kept], score[kept]


def _scaled(x: np.ndarray, radius: float) -> np.ndarray:
    """Queries brought to the vectors' length, which changes no ranking but lets distances be compared."""
    return x * (radius / np.sqrt((x**2).sum(1)))[:, None]
