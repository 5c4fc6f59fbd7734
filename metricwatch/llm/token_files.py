"""Token ids in files of patched frame-of-reference blocks.

A file holds segments of whole documents in ascending id order. The ids of a segment are cut into blocks of
BLOCK ids. A block stores its least id, the bit width that the given percentile of its differences from that id
needs, all differences packed at that width, and for the few wider ones a list of places and of their upper bits.
Each segment carries the byte offsets of its blocks, so that any stretch of ids is read without decoding the rest.

The container is Parquet, so that every store that Spark reaches will do: columns shard, segment, start (ids before it
in the shard), n_ids, doc_ids, lengths, block_starts, payload. Beside it lies a table of the ids before each shard.

Block layout, little-endian: least id (4 bytes), width (1), number of exceptions (2), packed differences
(BLOCK * width / 8), places of exceptions (1 each), their upper bits (4 each).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metricwatch.llm.shared import new_folder, partitions, write
from metricwatch.llm.text import gather
from metricwatch.llm.tokens import encoder

BLOCK = 256
#: A segment ends with the document that reaches so many ids.
SEGMENT_IDS = 1 << 18
#: Of the differences in a block, the share in percent that must fit the packed width.
PERCENTILE = 99
HEADER = 7

_SEGMENTS = "shard int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, block_starts array<int>, payload binary"


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """Byte offset of every block, and the blocks."""
    n = -(-len(ids) // BLOCK)
    if not n:
        return np.zeros(0, np.int32), b""
    padded = np.full(n * BLOCK, ids[-1], np.uint32)
    padded[: len(ids)] = ids
    least = padded.reshape(n, BLOCK).min(1)
    rest = padded.reshape(n, BLOCK) - least[:, None]
    chosen = min(BLOCK - 1, int(np.ceil(BLOCK * percentile / 100)) - 1)
    limit = np.partition(rest, chosen, axis=1)[:, chosen].astype(np.float64)
    width = np.ceil(np.log2(limit + 1)).astype(np.int64)
    over = (rest.astype(np.uint64) >> width[:, None].astype(np.uint64)).astype(np.uint32)
    rows, places = np.nonzero(over)
    exceptions = np.bincount(rows, minlength=n)
    sizes = HEADER + width * (BLOCK // 8) + 5 * exceptions
    starts = np.cumsum(sizes) - sizes
    out = np.zeros(int(sizes.sum()), np.uint8)
    out[starts[:, None] + np.arange(4)] = least.astype("<u4").view(np.uint8).reshape(n, 4)
    out[starts + 4] = width
    out[starts[:, None] + np.array([5, 6])] = exceptions.astype("<u2").view(np.uint8).reshape(n, 2)
    for w in np.unique(width[width > 0]):
        of = np.flatnonzero(width == w)
        bits = ((rest[of][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
        packed = np.packbits(bits.reshape(len(of), -1), axis=1, bitorder="little")
        out[starts[of][:, None] + HEADER + np.arange(packed.shape[1])] = packed
    tail = starts + HEADER + width * (BLOCK // 8)
    out[gather(tail, exceptions)] = places
    upper = over[rows, places].astype("<u4").view(np.uint8)
    out[gather(tail + exceptions, 4 * exceptions)] = upper
    return starts.astype(np.int32), out.tobytes()


def unpack(payload: bytes, block_starts: np.ndarray, n_ids: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids number first to last - 1 of a segment; only the blocks that hold them are decoded."""
    last = n_ids if last is None else min(last, n_ids)
    if first >= last:
        return np.zeros(0, np.uint32)
    begin, data = first // BLOCK, np.frombuffer(payload, np.uint8)
    starts = np.asarray(block_starts, np.int64)[begin : -(-last // BLOCK)]
    least = data[starts[:, None] + np.arange(4)].copy().view("<u4")[:, 0]
    width = data[starts + 4].astype(np.int64)
    exceptions = data[starts[:, None] + np.array([5, 6])].copy().view("<u2")[:, 0].astype(np.int64)
    rest = np.zeros((len(starts), BLOCK), np.uint32)
    for w in np.unique(width[width > 0]):
        of = np.flatnonzero(width == w)
        packed = data[starts[of][:, None] + HEADER + np.arange(w * (BLOCK // 8))]
        bits = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(of), BLOCK, w)
        value = np.zeros((len(of), BLOCK), np.uint32)
        for j in range(w):
            value |= bits[:, :, j].astype(np.uint32) << np.uint32(j)
        rest[of] = value
    tail = starts + HEADER + width * (BLOCK // 8)
    rows = np.repeat(np.arange(len(starts)), exceptions)
    places = data[gather(tail, exceptions)]
    upper = data[gather(tail + exceptions, 4 * exceptions)].copy().view("<u4")
    rest[rows, places] |= (upper.astype(np.uint64) << width[rows].astype(np.uint64)).astype(np.uint32)
    flat = (rest + least[:, None]).reshape(-1)
    return flat[first - begin * BLOCK : last - begin * BLOCK]


def write_token_files(
    docs: DataFrame,
    vocabulary: str,
    path: str | None = None,
    end_id: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    percentile: float = PERCENTILE,
) -> str:
    """Encodes every whole text, appends `end_id`, and writes all ids in ascending id order; returns the path.

    Null texts count as empty, null ids come first, and rows with the same id stand in the order of their texts, each
    with its own entry. An empty table gives empty files. Other columns are not read.
    The texts are dealt out by ranges of ids once and encoded where they are written; equal ids are split by a row
    number, so that an id that holds many rows is no hot range.
    """
    spark = docs.sparkSession
    path = path or new_folder(spark)
    keys = [F.asc_nulls_first("doc_id"), F.xxhash64("text").asc(), F.asc("row")]
    ranged = (
        docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
        .withColumn("row", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), *keys)
        .sortWithinPartitions(*keys)
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, encode = TaskContext.get().partitionId(), encoder(vocabulary)
        number = start = waiting = 0
        held: list[tuple[list, np.ndarray, np.ndarray]] = []

        def segment() -> pa.RecordBatch:
            ids = np.concatenate([x[2] for x in held])
            starts, payload = pack(ids, percentile)
            values = [[shard], [number], [start], [len(ids)], [[i for x in held for i in x[0]]], [np.concatenate([x[1] for x in held])], [starts], [payload]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
            names = ["shard", "segment", "start", "n_ids", "doc_ids", "lengths", "block_starts", "payload"]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            flat, n = encode(batch.column("text"))
            total = n + 1
            ends = np.cumsum(total)
            ids = np.full(int(total.sum()), end_id, np.uint32)
            ids[gather(ends - total, n)] = flat
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            while at < len(total):
                before = ends[at] - total[at]
                stop = min(len(total), int(np.searchsorted(ends, before + SEGMENT_IDS - waiting)) + 1)
                held.append((doc_ids[at:stop], total[at:stop], ids[before : ends[stop - 1]]))
                waiting += int(ends[stop - 1] - before)
                at = stop
                if waiting >= SEGMENT_IDS:
                    yield segment()
                    number, start, waiting, held = number + 1, start + waiting, 0, []
        if held:
            yield segment()

    written = ranged.select("doc_id", "text").mapInArrow(segments, _SEGMENTS)
    write(written, f"{path}/segments")
    written = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    # One row per shard, of which there are as many as shuffle partitions.
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = written.groupBy("shard").agg(F.sum("n_ids").alias("ids"), F.count(F.lit(1)).alias("segments"))
    write(shards.withColumn("shard_start", F.coalesce(F.sum("ids").over(before), F.lit(0))), f"{path}/shards")
    return path


def _segments(spark: SparkSession, path: str) -> DataFrame:
    shards = spark.read.schema("shard int, shard_start long").parquet(f"{path}/shards")
    written = spark.read.schema(_SEGMENTS).parquet(f"{path}/segments")
    return written.join(F.broadcast(shards), "shard").withColumn("start", F.col("start") + F.col("shard_start"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Each document's ids as read from the files: doc_id, start, n_tokens, ids_crc32, ids."""
    return _decoded(spark, path, keep_ids=True)


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """As read_documents(), without the ids themselves."""
    return _decoded(spark, path, keep_ids=False)


def _decoded(spark: SparkSession, path: str, keep_ids: bool) -> DataFrame:
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack(row["payload"], row["block_starts"], row["n_ids"]).astype("<u4")
                lengths = np.asarray(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids.tobytes())
                spans = list(zip((4 * (ends - lengths)).tolist(), (4 * ends).tolist(), strict=True))
                columns = [
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(row["start"] + ends - lengths),
                    pa.array(lengths),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in spans], pa.int64()),
                ]
                if keep_ids:
                    columns.append(pa.array([ids[a // 4 : b // 4] for a, b in spans], pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * keep_ids
    read = _segments(spark, path).select("start", "n_ids", "doc_ids", "lengths", "block_starts", "payload")
    return read.mapInArrow(documents, schema)


def read_range(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """Ids number first to last - 1 of the whole corpus, one row per segment touched: start, ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                a = max(0, first - row["start"])
                ids = unpack(row["payload"], row["block_starts"], row["n_ids"], a, last - row["start"])
                columns = [pa.array([row["start"] + a]), pa.array([ids], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["start", "ids"])

    touched = _segments(spark, path).filter((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first))
    return touched.select("start", "n_ids", "block_starts", "payload").mapInArrow(cut, "start long, ids array<long>")
