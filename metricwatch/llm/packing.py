"""Best-fit packing of token documents into sequences of a fixed length.

Bounded-space online best fit: a task holds a fixed number of open bins, found through a bitset with one bit for
each amount of free space. A piece goes to the open bin with the least space that holds it, or else to a new bin; when too
many are open, the fullest closes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwatch.llm.shared import frugal, stored
from metricwatch.llm.text import gather
from metricwatch.llm.tokens import encoder

CAPACITY = 2048
OPEN_BINS = 4096
#: Pieces that one task packs, in a stream; the bins left open at its end are the only loss against one single task.
TASK_PIECES = 500_000


class OpenBins:
    """Sequences that still take pieces, by free space."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def place(self, length: int) -> tuple[int, int]:
        """The bin that takes a piece of this length, and its offset there."""
        fits = self.bits >> length
        if fits:
            space = length + (fits & -fits).bit_length() - 1
            bins = self.by_space[space]
            bin_ = bins.pop()
            if not bins:
                self.bits ^= 1 << space
            self.open -= 1
        else:
            bin_, space = self.made, self.capacity
            self.made += 1
        left = space - length
        if left:
            self.by_space[left].append(bin_)
            self.bits |= 1 << left
            self.open += 1
            if self.open > self.most:  # the fullest closes
                least = (self.bits & -self.bits).bit_length() - 1
                self.by_space[least].pop()
                if not self.by_space[least]:
                    self.bits ^= 1 << least
                self.open -= 1
        return bin_, self.capacity - space


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int = 0,
    capacity: int = CAPACITY,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """The pieces that each document's ids, with `end_id` after them, are cut into: doc_id, piece, start, length, ids_crc32.

    Only documents longer than `capacity` are cut, into pieces of `capacity`, of which the first may be shorter. A
    null text counts as empty; rows with equal ids are documents of their own. `keep_ids` adds the ids as int arrays.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            flat, n = encode(batch.column("text"))
            total = n + 1
            ends = np.cumsum(total)
            ids = np.full(int(total.sum()), end_id, "<u4")
            ids[gather(ends - total, n)] = flat
            count = -(-total // capacity)
            owner = np.repeat(np.arange(len(total)), count)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
            short = total - (count - 1) * capacity
            length = np.where(piece == 0, short[owner], capacity)
            start = np.where(piece == 0, 0, short[owner] + (piece - 1) * capacity)
            begin = (ends - total)[owner] + start
            raw = memoryview(ids.tobytes())
            spans = list(zip((4 * begin).tolist(), (4 * (begin + length)).tolist(), strict=True))
            columns = [
                batch.column("doc_id").take(pa.array(owner)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array([ids[a // 4 : b // 4] for a, b in spans], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * keep_ids
    read = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return read.mapInArrow(frugal(pieces), schema)


def best_fit(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to `capacity`; all other columns are carried along.

    The rows are dealt out evenly, whatever their keys, and mixed in an order that depends on their values only, so that
    long and short ones alternate. Rows without a length, or with one that doesn't fit, are an error.
    """
    spark = pieces.sparkSession
    pieces = stored(pieces.drop("sequence_id", "offset"))
    tasks = max(1, -(-pieces.count() // task_pieces))
    order = [F.xxhash64(*pieces.columns), *(c.name for c in pieces.schema if not isinstance(c.dataType, T.MapType))]
    mixed = pieces.repartition(tasks).sortWithinPartitions(*order)
    schema = T.StructType([*pieces.schema, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, bins = TaskContext.get().partitionId() << 32, OpenBins(capacity, open_bins)
        for batch in batches:
            lengths = batch.column("length").to_pylist()
            if any(x is None or not 0 < x <= capacity for x in lengths):
                raise ValueError(f"lengths must be from 1 to {capacity}")
            found = [bins.place(x) for x in lengths]
            columns = [*batch.columns, pa.array([first + x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "sequence_id", "offset"])

    return mixed.mapInArrow(frugal(placed), schema) if pieces.columns else spark.createDataFrame([], schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence in order, from rows that carry `ids`."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # at most `capacity` ids a sequence
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
