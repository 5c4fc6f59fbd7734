"""A quality score learnt from preference pairs.

Bradley-Terry ranking: of two labelled documents, the one labelled 1 is preferred; the score is a linear function of
the text's features, learnt by logistic loss on the features' differences. A quantile of the scores of the labelled
documents becomes the threshold, and the score that documents get is a logistic curve through it.

All labelled documents that aren't held out are learnt from. They are dealt by the hash of their id to blocks of about
BLOCK, and every document is compared with all of the other label in its block. Each step of Newton's method sums slopes
and curvatures over all blocks as a Spark job; the threshold is found exactly among the scores of all of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.llm.shared import frugal, frugal_group, remainder, stored
from metricwatch.llm.text import PIECE_BYTES, buffers, gather, is_space, mix, shingles, slices, span_hashes, word_bounds

#: A document with a score of so much or more is accepted.
ACCEPT = 0.3
#: Labelled documents that are compared with each other, and of each label at least, on average: rarer ones are in several blocks.
BLOCK, LEAST = 4096, 32
#: Documents and pairs of them that Newton's method gets its first weights from; where it ends doesn't depend on them.
START = 20_000
PAIRS = 200_000
#: Pairs whose differences are held at a time, and documents of a block whose pairs are.
BLOCK_PAIRS = 8192
STRIP = 512
#: Every so manieth id by remainder() is held out of learning.
FOLDS = 5

_SIGNS = b"|!*#$%&@<>{}[]\\^~=_+/"


@dataclass(frozen=True)
class Model:
    """Weights of standardised features and their squares; a score is 1 / (1 + exp(-(w . x - threshold) + offset))."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = _expanded(features, self.mean, self.spread) @ self.weights - self.threshold
        return 1 / (1 + np.exp(-np.clip(raw + np.log(ACCEPT / (1 - ACCEPT)), -500, 500)))


def _expanded(features: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    scaled = np.clip((features - mean) / spread, -8, 8)
    return np.hstack([scaled, scaled**2])


def _features(texts: pa.Array) -> np.ndarray:
    data, starts = buffers(texts)
    n = np.diff(starts)

    def per_text(marks: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(marks, dtype=np.int64)])
        return (sums[starts[1:]] - sums[starts[:-1]]).astype(np.float64)

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    def distinct(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        _, at = np.unique(mix(hashes + mix(owner.astype(np.uint64) + np.uint64(1))), return_index=True)
        return np.bincount(owner[at], minlength=len(n)).astype(np.float64)

    space, upper = is_space(data), (data >= 65) & (data <= 90)
    letter = upper | (data >= 97) & (data <= 122) | (data >= 128)
    digit = (data >= 48) & (data <= 57)
    sign = ~space & ~letter & ~digit
    again = np.zeros(len(data), bool)
    again[1:] = sign[1:] & (data[1:] == data[:-1])
    first, end, owner = word_bounds(data, starts)
    words = np.bincount(owner, minlength=len(n)).astype(np.float64)
    hashes = span_hashes(data, first, end, lower=True)
    last = data[end - 1] if len(end) else data[:0]
    signed = np.bincount(owner, weights=np.isin(last, np.frombuffer(_SIGNS, np.uint8)), minlength=len(n))
    short = np.bincount(owner, weights=(end - first) <= 3, minlength=len(n))
    long = np.bincount(owner, weights=(end - first) >= 15, minlength=len(n))
    breaks = np.flatnonzero(data == 10)
    line_first = np.unique(np.concatenate([starts[:-1][n > 0], breaks + 1]))
    line_first = line_first[line_first < len(data)]
    line_end = np.append(line_first[1:], len(data))
    line_owner = np.searchsorted(starts, line_first, "right") - 1
    lines = np.bincount(line_owner, minlength=len(n)).astype(np.float64)
    line_hashes = span_hashes(data, line_first, line_end)
    _, shingle_starts = shingles(texts)
    letters, visible = per_text(letter), per_text(~space)
    columns = [
        np.log1p(n),
        np.log1p(words),
        share(visible, words),
        share(per_text(upper), letters),
        share(letters, visible),
        share(per_text(digit), visible),
        share(per_text(sign), visible),
        share(per_text(data >= 128), visible),
        share(per_text(again), visible),
        share(signed, words),
        share(short, words),
        share(long, words),
        share(distinct(hashes, owner), words),
        share(np.diff(shingle_starts).astype(np.float64), np.maximum(words - 4, 1)),
        share(lines, words),
        share(distinct(line_hashes, line_owner), lines),
        *(share(per_text(data == c), visible) for c in b".,|!*#$%&?"),
    ]
    return np.stack(columns, axis=1).astype(np.float64) if len(n) else np.zeros((0, len(columns)))


def features(texts: pa.Array) -> np.ndarray:
    """Shape, marks and repetition of whole texts, one row each; null counts as empty."""
    parts = [_features(piece) for _, piece in slices(texts, PIECE_BYTES)]
    return np.concatenate(parts) if parts else _features(texts)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> Model:
    """Learns from all labelled documents that aren't held out; only sums over them are collected, and START to begin with.

    Labels other than 0 and 1 and null ids are left out; of documents or labels with the same id one counts. Without
    documents of both labels, every score is the same and accepts.
    """
    read = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))
    return _learnt(_featured(read.filter(remainder("id", FOLDS) != 0)), labels, id_column, label_column)


def scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score: what `with_score` gives by the model of `fit`, from features that are made once and written."""
    kept = stored(_featured(docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))))
    model = _learnt(kept.filter(remainder("id", FOLDS) != 0), labels, "doc_id", "quality")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = pa.array(model.score(_matrix(batch.column("x"))))
                yield pa.RecordBatch.from_arrays([batch.column("id"), found], ["doc_id", "score"])

    return kept.mapInArrow(scored, "doc_id long, score double")


def _featured(read: DataFrame) -> DataFrame:
    """id and features of each text, which are much smaller than texts."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("id"), _listed(features(batch.column("text")))], ["id", "x"])

    return read.mapInArrow(frugal(rows), "id long, x array<double>")


def _learnt(featured: DataFrame, labels: DataFrame, id_column: str, label_column: str) -> Model:
    """The model of documents with features, none of them held out."""
    learnt = labels.filter((remainder(id_column, FOLDS) != 0) & F.col(label_column).isin(0, 1))
    learnt = learnt.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("int").alias("label"))
    found = featured.join(learnt.groupBy("id").agg(F.min("label").alias("label")), "id")
    found = stored(found.groupBy("id").agg(F.min(F.struct("label", "x")).alias("v")).select("id", "v.label", "v.x"))
    counts = {r["label"]: r["count"] for r in found.groupBy("label").count().collect()}
    if len(counts) < 2:
        n = _features(pa.array([], pa.string())).shape[1]
        return Model(np.zeros(n), np.ones(n), np.zeros(2 * n), 0.0)
    mean, spread = _moments(found)
    spread = np.where(spread > 1e-9, spread, 1.0)
    weights = _fitted(_dealt(found, counts), mean, spread, _start(found, mean, spread))
    # As many labelled documents lie below the threshold as are labelled 0.
    threshold = _quantile(_raw(found, Model(mean, spread, weights, 0.0)), counts[0], sum(counts.values()))
    return Model(mean, spread, weights, threshold)


def _listed(x: np.ndarray) -> pa.Array:
    """A list of numbers per row."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * np.int32(x.shape[1])), pa.array(x.ravel()))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The lists of a column of at least one row, all of one length, as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if isinstance(column, pa.Array) else _matrix(column.combine_chunks())


def _moments(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each feature, from those of each task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                own = len(x), x.mean(0), ((x - x.mean(0)) ** 2).sum(0)
                total = own if total is None else _merged(total, own)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total[0]], pa.int64()), _listed(total[1][None]), _listed(total[2][None])], ["n", "mean", "squares"])

    tasks = found.select("x").mapInArrow(task, "n long, mean array<double>, squares array<double>").collect()
    n, mean, squares = reduce(_merged, ((r["n"], np.array(r["mean"]), np.array(r["squares"])) for r in tasks))
    return mean, np.sqrt(squares / n)


def _merged(a: tuple, b: tuple) -> tuple:
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap**2 * (a[0] * b[0] / n)


def _dealt(found: DataFrame, counts: dict[int, int]) -> DataFrame:
    """block, id, label, x: every document in a block, those of a rare label in as many as it takes for each to have some."""
    blocks = -(-sum(counts.values()) // BLOCK)
    copies = {label: min(blocks, -(-LEAST * blocks // n)) for label, n in counts.items()}
    first = F.pmod(F.xxhash64("id"), F.lit(blocks))
    k = F.when(F.col("label") == 1, copies[1]).otherwise(copies[0])
    turn = F.explode(F.sequence(F.lit(0), k - 1))
    dealt = found.select("id", "label", "x", first.alias("first"), k.alias("k"), turn.alias("turn"))
    block = F.pmod(F.col("first") + F.floor(F.col("turn") * blocks / F.col("k")), F.lit(blocks))
    return stored(dealt.select(block.cast("long").alias("block"), "id", "label", "x"))


def _start(found: DataFrame, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Weights to begin with, from some pairs of some documents."""
    some = found.orderBy(F.xxhash64("id"), "id").limit(START).select("label", "x").toArrow()
    z, label = _expanded(_matrix(some["x"]), mean, spread), some["label"].to_numpy()
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return np.zeros(z.shape[1])
    rng = np.random.default_rng(7)
    return _logistic(z, rng.choice(good, PAIRS), rng.choice(bad, PAIRS))


def _fitted(dealt: DataFrame, mean: np.ndarray, spread: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Weights with the least mean loss over all pairs of all blocks."""
    n = len(start)

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int]:
        def block(group: pa.Table) -> pa.Table:
            group = group.sort_by("id")
            z, label = _expanded(_matrix(group["x"]), mean, spread), group["label"].to_numpy()
            loss, slope, curve, pairs = _block_sums(z[label == 1], z[label == 0], w)
            return pa.Table.from_arrays([_listed(np.concatenate([[pairs, loss], slope, curve.ravel()])[None])], ["sums"])

        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2 + n + n * n)
            for batch in batches:
                total += _matrix(batch.column("sums")).sum(0) if batch.num_rows else 0
            yield pa.RecordBatch.from_arrays([_listed(total[None])], ["sums"])

        found = dealt.groupBy("block").applyInArrow(frugal_group(block), "sums array<double>").mapInArrow(task, "sums array<double>")
        total = _matrix(found.toArrow()["sums"]).sum(0)
        return total[1], total[2 : n + 2], total[n + 2 :].reshape(n, n), int(total[0])

    return _newton(start, sums)


def _losses(gap: np.ndarray) -> tuple[np.ndarray, float]:
    """How likely each pair is the other way round by the gap of its scores, and the sum of log(1 + exp(-gap))."""
    p = 1 / (1 + np.exp(np.clip(gap, -500, 500)))
    return p, float((np.log1p(np.exp(-np.abs(gap))) - np.minimum(gap, 0)).sum())


def _block_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int]:
    """Loss, slope and curvature summed over all pairs of a good and a bad row, and how many these are.

    No gap is made: sums over pairs are those over rows, weighted by each row's sums, less the mixed products.
    """
    loss, slope, curve = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
    low = bad @ w
    for at in range(0, len(good), STRIP):
        z = good[at : at + STRIP]
        p, own = _losses((z @ w)[:, None] - low)
        loss += own
        slope -= p.sum(1) @ z - p.sum(0) @ bad
        p *= 1 - p
        mixed = z.T @ (p @ bad)
        curve += (z * p.sum(1)[:, None]).T @ z + (bad * p.sum(0)[:, None]).T @ bad - mixed - mixed.T
    return loss, slope, curve, len(good) * len(bad)


def _raw(found: DataFrame, model: Model) -> DataFrame:
    """key: the linear scores, stored as numbers whose unsigned order is theirs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                raw = _expanded(_matrix(batch.column("x")), model.mean, model.spread) @ model.weights
                bits = (raw + 0.0).view(np.int64)  # -0.0 becomes 0.0
                yield pa.RecordBatch.from_arrays([pa.array(np.where(bits < 0, ~bits, bits ^ np.int64(-(2**63))))], ["key"])

    return stored(found.select("x").mapInArrow(rows, "key long"))


def _quantile(keys: DataFrame, below: int, n: int) -> float:
    """The quantile below / n of all n scores, interpolated as numpy does."""
    place = below / n * (n - 1)
    rank = min(int(place), n - 2)
    low, high = _ranked(keys, rank), _ranked(keys, rank + 1)
    return low + (high - low) * (place - rank)


def _ranked(keys: DataFrame, rank: int) -> float:
    """The score of a rank, from 0 on: its bits are found 16 at a time, by counting scores that share those before."""
    key = 0
    for shift in (48, 32, 16, 0):
        digit = F.shiftrightunsigned("key", shift).bitwiseAND(F.lit(0xFFFF))
        for value, n in sorted(map(tuple, keys.groupBy(digit.alias("digit")).count().collect())):
            if rank < n:
                break
            rank -= n
        key, keys = key << 16 | value, keys.filter(digit == value)
    bits = key ^ (1 << 63) if key >> 63 else ~key & (2**64 - 1)
    return float(np.array([bits], np.uint64).view(np.float64)[0])


def _logistic(z: np.ndarray, better: np.ndarray, worse: np.ndarray) -> np.ndarray:
    """Weights with the least mean loss over pairs of rows `better` and `worse` of z.

    A gap is a row `better` of z less a row `worse`; they are made and summed up in blocks, never all at once.
    """

    def sums(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, int]:
        loss, slope, curve = 0.0, np.zeros(len(w)), np.zeros((len(w), len(w)))
        for at in range(0, len(better), BLOCK_PAIRS):
            gap = z[better[at : at + BLOCK_PAIRS]] - z[worse[at : at + BLOCK_PAIRS]]
            p, own = _losses(gap @ w)
            loss += own
            slope -= gap.T @ p
            curve += (gap * (p * (1 - p))[:, None]).T @ gap
        return loss, slope, curve, len(better)

    return _newton(np.zeros(z.shape[1]), sums)


def _newton(w: np.ndarray, sums: Callable, penalty: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights with the least mean of log(1 + exp(-gap . w)) over all pairs + penalty / 2 * |w|**2, by Newton's method.

    `sums` gives loss, slope and curvature summed over the pairs at some weights, and how many pairs there are. A step that
    would raise the loss is halved until it doesn't.
    """

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, slope, curve, n = sums(w)
        return loss / n + penalty / 2 * (w @ w), slope / n + penalty * w, curve / n + penalty * np.eye(len(w))

    loss, slope, curve = at(w)
    for _ in range(steps):
        step = np.linalg.solve(curve, slope)
        if np.abs(step).max() < 1e-8:
            return w - step
        while True:
            further, *rest = at(w - step)
            if further <= loss + 1e-12 * abs(loss) or np.abs(step).max() < 1e-8:
                break
            step = step / 2
        w, loss, (slope, curve) = w - step, further, rest
    return w


def with_score(docs: DataFrame, model: Model, score_column: str = "score", text_column: str = "text") -> DataFrame:
    """Adds each whole text's score, from 0 to 1; all other columns are carried along. A null text counts as empty."""
    schema = T.StructType([f for f in docs.schema if f.name != score_column] + [T.StructField(score_column, T.DoubleType())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [name for name in batch.schema.names if name != score_column]
            scores = pa.array(model.score(features(batch.column(text_column).cast(pa.string()))))
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in keep), scores], [*keep, score_column])

    return docs.mapInArrow(frugal(scored), schema)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model learnt from `labels` accepts, with their columns."""
    model = fit(docs, labels)
    return with_score(docs, model, "llm quality score").filter(F.col("llm quality score") >= ACCEPT).select(*_names(docs))


def _names(df: DataFrame) -> list[str]:
    return [f"`{name.replace('`', '``')}`" for name in df.columns]
