"""Benchmark items inside long documents: containment search by MinHash, verified exactly.

Items are parted by the size of their shingle set. A class of sizes has its own sketch: the items' least shingle
hashes, as many as an item of that class can lack and still reach the threshold, and one more. So a document that holds
enough of an item holds a hash of its sketch for certain, however long the document is; banded signatures of
whole documents can't promise that, as the Jaccard similarity of a short item and a long document is near zero.

Two bitmaps of a fixed size, one of all sketch hashes and one of all item hashes, are sent to the tasks. A task keeps of a
document only the hashes that the second has, and nothing if the first has none. Candidates are then joined on
sketch hashes, and verified by the number of the item's shingles among the kept ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.shared import frugal, stored
from metricwatch.llm.text import SHINGLE_WORDS, shingles, slices, words

#: The share of an item's shingles that a document must hold, in percent.
PERCENT = 75
#: Bits of a bitmap, as a power of two, and of a part of it that one row carries.
BITMAP_BITS, PART_BITS = 26, 16


def _grams(texts: pa.Array, widths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """shingles(), and with them all word sequences of the widths, which are hashed as a whole text of so many words is."""
    found = [shingles(texts), *(shingles(texts, width) for width in widths)]
    hashes = np.concatenate([h for h, _ in found])
    owner = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(starts)) for _, starts in found])
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(texts)))])


def item_shingles(items: DataFrame, percent: int = PERCENT, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Each item's distinct shingles: item_id, item_text (a hash of it), width (words in one), n, need, size_class, hash, sketched."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                hashes, starts = shingles(texts)
                n = np.diff(starts)
                owner = np.repeat(np.arange(len(n)), n)
                width = np.minimum(np.diff(words(texts)[1]), SHINGLE_WORDS)
                need = -(-n * percent // 100)
                size_class = np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)
                # What the largest item of the class can lack, and one more.
                largest = 2 ** (size_class + 1) - 1
                sketch = largest - -(-largest * percent // 100) + 1
                place = np.arange(len(hashes)) - starts[owner]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("item_id").slice(at, len(texts)).take(pa.array(owner)),
                        batch.column("item_text").slice(at, len(texts)).take(pa.array(owner)),
                        pa.array(width[owner]),
                        pa.array(n[owner]),
                        pa.array(need[owner]),
                        pa.array(size_class[owner]),
                        pa.array(hashes.view(np.int64)),
                        pa.array(place < sketch[owner]),
                    ],
                    ["item_id", "item_text", "width", "n", "need", "size_class", "hash", "sketched"],
                )

    text = F.col(text_column).cast("string")
    read = items.select(F.col(id_column).cast("long").alias("item_id"), F.xxhash64(text).alias("item_text"), text.alias("text"))
    schema = "item_id long, item_text long, width long, n long, need long, size_class long, hash long, sketched boolean"
    return read.filter("item_id IS NOT NULL").mapInArrow(frugal(rows), schema)


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """One bit per value of the upper BITMAP_BITS bits of a hash, put together from parts made in tasks."""
    parts = hashes.select(
        F.shiftrightunsigned("hash", 64 - BITMAP_BITS + PART_BITS).cast("int").alias("part"),
        F.expr(f"shiftrightunsigned(hash, {64 - BITMAP_BITS}) & {(1 << PART_BITS) - 1}").cast("int").alias("bit"),
    ).distinct()

    def rows(key: tuple, group: pa.Table) -> pa.Table:
        bits = np.zeros(1 << PART_BITS, np.uint8)
        bits[group.column("bit").to_numpy()] = 1
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    out = np.zeros((1 << (BITMAP_BITS - PART_BITS), 1 << (PART_BITS - 3)), np.uint8)
    # At most 2 ** (BITMAP_BITS - 3) bytes, however many items there are.
    for row in parts.groupBy("part").applyInArrow(rows, "part int, bits binary").collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.reshape(-1)


def _in_bitmap(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes >> np.uint64(64 - BITMAP_BITS)
    return (bitmap[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & 1 == 1


def contained(
    docs: DataFrame,
    items: DataFrame,
    percent: int = PERCENT,
    id_column: str = "doc_id",
    text_column: str = "text",
    inside: bool = False,
) -> DataFrame:
    """Pairs of a document and an item of whose distinct shingles it holds at least `percent` percent.

    Returns doc_id, text_hash (xxhash64 of the text, which tells rows of the same id apart), item_id, n_shingles (the
    item's), overlap, containment; each pair of different rows once, repeated rows as one. Shingles are SHINGLE_WORDS words in lower
    case; a shorter item is one shingle, which only an equally short text holds, or if `inside` any text with its words in sequence. Null texts count as empty; empty
    items and documents are in no pair, nor are items without an id. Items with the same id but other texts are items of their own.
    """
    spark = docs.sparkSession
    wanted = stored(item_shingles(items, percent).distinct())
    # At most SHINGLE_WORDS - 1 numbers.
    short = wanted.filter(F.col("width") < SHINGLE_WORDS).select("width").distinct().collect() if inside else []
    widths = [r["width"] for r in short]
    sketch = spark.sparkContext.broadcast(_bitmap(wanted.filter("sketched")))
    every = spark.sparkContext.broadcast(_bitmap(wanted))

    def hits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                hashes, starts = _grams(texts, widths) if widths else shingles(texts)
                owner = np.repeat(np.arange(len(texts)), np.diff(starts))
                found = _in_bitmap(sketch.value, hashes)
                docs_hit = np.unique(owner[found])
                if not len(docs_hit):
                    continue
                keep = np.isin(owner, docs_hit)
                keep[keep] = _in_bitmap(every.value, hashes[keep])
                counts = np.bincount(owner[keep], minlength=len(texts))[docs_hit]
                kept = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(hashes[keep].view(np.int64))
                )
                take = pa.array(docs_hit + at)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(take), batch.column("text_hash").take(take), kept], ["doc_id", "text_hash", "hashes"])

    text = F.col(text_column).cast("string")
    read = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    found = read.mapInArrow(frugal(hits), "doc_id long, text_hash long, hashes array<long>")
    found = stored(found.withColumn("row", F.monotonically_increasing_id()))
    held = found.select("row", F.explode("hashes").alias("hash"))
    item = ["item_id", "item_text", "n", "need"]
    pairs = held.join(wanted.filter("sketched"), "hash").select("row", *item).distinct()
    sets = wanted.groupBy(*item).agg(F.collect_list("hash").alias("wanted"))  # one item's shingles
    checked = pairs.join(sets, item).join(found, "row")
    checked = checked.withColumn("overlap", F.size(F.array_intersect("hashes", "wanted")).cast("long")).filter("overlap >= need")
    return checked.select(
        "doc_id",
        "text_hash",
        "item_id",
        F.col("n").alias("n_shingles"),
        "overlap",
        (F.col("overlap") / F.col("n")).alias("containment"),
    ).distinct()


def decontaminated(docs: DataFrame, items: DataFrame, percent: int = PERCENT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that hold no item, however short, with all their columns; of rows with the same id each is judged by its own text."""
    leaks = contained(docs, items, percent, id_column, text_column, inside=True)
    leaks = leaks.select(F.col("doc_id").alias("leaking id"), F.col("text_hash").alias("leaking text")).distinct()
    same = F.col(id_column).cast("long").eqNullSafe(F.col("leaking id"))
    same &= F.xxhash64(F.col(text_column).cast("string")) == F.col("leaking text")
    return docs.join(leaks, same, "left_anti")
