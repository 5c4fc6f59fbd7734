"""Alignment of two tokenizers' ids over the same texts, and how often each pair of ids is linked in the corpus.

Both tokenizers see a space and then the text. Where a token of the first (A) and one of the second (B) end at the same
byte, the text is cut: dictionaries from end to index of each side are intersected as hash sets, and the sorted common ends
slice both id lists into groups. Within a group no inner end is shared, so its links, the pairs of tokens that share bytes,
are the steps of the merged ends.

A text has no tokens if it is null or empty, or if the bytes of either side's tokens differ from the space and the text.
Strings of special tokens are plain text. Rows with a null id and repeated rows are texts of their own and count as such;
other columns of the documents, whatever their names, are left out. An empty table gives empty results.

Texts are worked on in slices of bounded size, where equal groups (told apart by 64-bit hashes) are worked out once. Pairs
are counted per slice and task, then merged in buckets of B's ids, so a pair that every text holds is one entry per task. The
number of different pairs is bounded by the vocabularies. A slice asks the buckets for the counts of its different pairs, by
a shuffle in which each bucket is repeated for its salts; no side is broadcast and no bucket is asked by all in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.shared import partitions, stored
from metricwatch.llm.text import buffers, gather, mix, slices
from metricwatch.llm.tokens import BYTE_BPE, Encoder, vocabulary

PIECE_BPE = "piece_bpe_32k.model"
#: Buckets of B's ids in which pairs are counted; a bucket's different pairs fit in a task many times over.
BUCKETS = 16
#: Bytes of a text whose ends stand in dictionaries at a time.
WINDOW = 1 << 20
#: Bytes of a slice of texts, and texts of it at most, so that their numbers take two bytes.
SLICE_BYTES, SLICE_TEXTS = 2 << 20, 1 << 16
#: Pairs merged at a time, and pairs of a row of the counts at most.
HELD_PAIRS = 4_000_000

_SPACE_MARK = "▁"
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_loaded: dict[tuple[str, str], Plain | Pieces] = {}


class Plain(Encoder):
    """Byte-level ids, with strings of special tokens as plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens = True
        taken = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        others = [byte for byte in range(256) if byte not in set(taken)]
        byte_of = {chr(byte): byte for byte in taken} | {chr(256 + n): byte for n, byte in enumerate(others)}
        self.names = _names(
            {i: bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s, i in self.tokenizer.get_vocab().items()}
        )


class Pieces(Encoder):
    """Ids of a sentencepiece model. No piece has a space after other characters, so a text is cut before each first space."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model, self.by_words = SentencePieceProcessor(model_file=path), False
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(_SPACE_MARK in name.lstrip(_SPACE_MARK) for name in names):
            raise ValueError("a piece of this vocabulary goes on after a space")
        self.names = _names({i: self._bytes(i, name) for i, name in enumerate(names)})
        self._clear()

    def _bytes(self, i: int, name: str) -> bytes:
        return bytes([int(name[3:-1], 16)]) if self.model.is_byte(i) else name.replace(_SPACE_MARK, " ").encode()

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode([piece[1:] for piece in pieces], num_threads=1)  # the model adds the space again
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum())), lengths

    def _bounds(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        space = data == 0x20
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[starts[:-1][np.diff(starts) > 0]] = True
        first = np.flatnonzero(cut)
        return first, np.append(first[1:], len(data)) if len(first) else first, np.searchsorted(starts, first, "right") - 1

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Texts that end in a space, which the model doesn't add when it stands alone."""
        return pc.ends_with(texts, " ").to_numpy(zero_copy_only=False)


def _names(by_id: dict[int, bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all ids in a row, where each id's start, and how many they are."""
    parts = [by_id.get(i, b"") for i in range(max(by_id) + 1)]
    sizes = np.array([len(x) for x in parts], np.int64)
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes


def _encoder(kind: type, vocab: str) -> Plain | Pieces:
    """The worker's encoder of a vocabulary, a file's path or the name of a public one."""
    if (kind.__name__, vocab) not in _loaded:
        _loaded[kind.__name__, vocab] = kind(vocab if "/" in vocab else vocabulary(vocab))
    return _loaded[kind.__name__, vocab]


@dataclass(frozen=True)
class Side:
    """One tokenizer's ids of a slice of texts, in a row."""

    ids: np.ndarray
    sizes: np.ndarray  # bytes of each id
    starts: np.ndarray  # first id of each text, with the end of the last


def _whole(encoder: Plain | Pieces, texts: pa.Array) -> tuple[Side, np.ndarray]:
    """The ids, and of each text whether their bytes are the text's."""
    data, starts = buffers(texts)
    ids, counts = encoder(texts)
    flat, begins, sizes = encoder.names
    own = sizes[ids]
    id_starts = np.concatenate([[0], np.cumsum(counts)])
    length = np.diff(np.concatenate([[0], np.cumsum(own)])[id_starts])
    same = length == np.diff(starts)
    kept = np.repeat(same, counts)
    spelt = flat[gather(begins[ids[kept]], own[kept])]
    differs = np.zeros(len(spelt) + 1, np.int64)
    wanted = data[np.repeat(same, np.diff(starts))]
    np.cumsum(spelt != wanted, out=differs[1:])
    ends = np.cumsum(np.where(same, length, 0))
    same &= differs[ends] == differs[ends - np.where(same, length, 0)]
    return Side(ids, own, id_starts), same


def _only(side: Side, kept: np.ndarray) -> Side:
    counts = np.diff(side.starts) * kept
    held = np.repeat(kept, np.diff(side.starts))
    return Side(side.ids[held], side.sizes[held], np.concatenate([[0], np.cumsum(counts)]))


def _both(texts: pa.Array, a: str, b: str) -> tuple[Side, Side]:
    given = pc.fill_null(texts, "").cast(pa.large_string())
    spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), given, pa.scalar(" ", pa.large_string()))
    left, left_same = _whole(_encoder(Plain, a), spaced)
    right, right_same = _whole(_encoder(Pieces, b), spaced)
    kept = left_same & right_same & (pc.binary_length(given).to_numpy(zero_copy_only=False) > 0)
    return _only(left, kept), _only(right, kept)


def group_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[list[int], list[int]]:
    """Of each group of one text: how many tokens of A, and of B, there are up to its end."""
    cuts_a: list[int] = []
    cuts_b: list[int] = []
    done_a = done_b = 0
    while done_a < len(ends_a) and done_b < len(ends_b):
        limit = max(int(min(ends_a[done_a], ends_b[done_b])) + WINDOW, 0)
        to_a, to_b = (int(np.searchsorted(x, limit)) for x in (ends_a, ends_b))
        index_a = dict(zip(ends_a[done_a:to_a].tolist(), range(done_a + 1, to_a + 1), strict=True))
        index_b = dict(zip(ends_b[done_b:to_b].tolist(), range(done_b + 1, to_b + 1), strict=True))
        common = sorted(index_a.keys() & index_b.keys())
        cuts_a += map(index_a.__getitem__, common)
        cuts_b += map(index_b.__getitem__, common)
        done_a, done_b = to_a, to_b
    return cuts_a, cuts_b


def _hashes(ids: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of ids, which end at `ends`."""
    sums = np.zeros(len(ids) + 1, np.uint64)
    powers = np.cumprod(np.full(len(ids) + 1, _STEP))
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * powers[1:], out=sums[1:])
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    inverse = np.cumprod(np.full(len(ids) + 1, _BACK))
    return mix((sums[ends] - sums[begins]) * inverse[begins] + (ends - begins).astype(np.uint64))


@dataclass(frozen=True)
class Groups:
    """The groups of a slice of texts. Equal groups are worked out once, as a kind."""

    starts: np.ndarray  # first group of each text, with the end of the last
    kind: np.ndarray  # of each group
    ends_a: np.ndarray  # of each group, ids of A up to its end, all texts in a row
    ends_b: np.ndarray
    example: np.ndarray  # a group of each kind


def grouped(left: Side, right: Side) -> Groups:
    cuts_a, cuts_b, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    for i in range(len(left.starts) - 1):
        a, b = slice(left.starts[i], left.starts[i + 1]), slice(right.starts[i], right.starts[i + 1])
        to_a, to_b = group_cuts(np.cumsum(left.sizes[a]), np.cumsum(right.sizes[b]))
        cuts_a.append(np.array(to_a, np.int64) + a.start)
        cuts_b.append(np.array(to_b, np.int64) + b.start)
        counts.append(len(to_a))
    ends_a, ends_b = np.concatenate(cuts_a), np.concatenate(cuts_b)
    both = mix(_hashes(left.ids, ends_a) * np.uint64(3) + _hashes(right.ids, ends_b))
    _, example, kind = np.unique(both, return_index=True, return_inverse=True)
    return Groups(np.concatenate([[0], np.cumsum(counts)]).astype(np.int64), kind, ends_a, ends_b, example)


def _only_kinds(side: Side, ends: np.ndarray, example: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ids and bytes of one group of each kind in a row, and how many ids each has."""
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)[example] if len(example) else example
    lengths = ends[example] - begins
    at = gather(begins, lengths)
    return side.ids[at], side.sizes[at], lengths


def links(left: Side, right: Side, groups: Groups) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the kinds of groups in a row, the linked ids of A and of B, and how many links each kind has.

    Within a group no inner end is shared, so each step of its merged ends is a link of the two tokens that it lies in.
    """
    ids_a, sizes_a, n_a = _only_kinds(left, groups.ends_a, groups.example)
    ids_b, sizes_b, n_b = _only_kinds(right, groups.ends_b, groups.example)
    ends_a, ends_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
    steps = np.union1d(ends_a, ends_b)
    return ids_a[np.searchsorted(ends_a, steps)], ids_b[np.searchsorted(ends_b, steps)], n_a + n_b - 1


def _spelt(left: Side, right: Side, groups: Groups) -> list[str]:
    """Each kind of group as `a1,a2|b1`."""
    ids_a, _, n_a = _only_kinds(left, groups.ends_a, groups.example)
    ids_b, _, n_b = _only_kinds(right, groups.ends_b, groups.example)
    spelt_a, spelt_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    out, from_a, from_b = [], 0, 0
    for more_a, more_b in zip(n_a.tolist(), n_b.tolist(), strict=True):
        out.append(",".join(spelt_a[from_a : from_a + more_a]) + "|" + ",".join(spelt_b[from_b : from_b + more_b]))
        from_a, from_b = from_a + more_a, from_b + more_b
    return out


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    for at, texts in slices(batch.column("text"), SLICE_BYTES):
        for more in range(0, len(texts), SLICE_TEXTS):
            yield at + more, texts.slice(more, SLICE_TEXTS)


def aligned(docs: DataFrame, a: str = BYTE_BPE, b: str = PIECE_BPE) -> DataFrame:
    """doc_id, a_ids, b_ids, a_ends, b_ends: both id lists of each text and, of each group, the ids up to its end.

    `a` names a byte-level vocabulary of the tokenizers library, `b` a sentencepiece model.
    """

    def align(batches):
        for batch in batches:
            for at, texts in _slices(batch):
                left, right = _both(texts, a, b)
                groups = grouped(left, right)
                ends = [cuts - np.repeat(side.starts[:-1], np.diff(groups.starts)) for side, cuts in ((left, groups.ends_a), (right, groups.ends_b))]
                lists = ((left.starts, left.ids), (right.starts, right.ids), (groups.starts, ends[0]), (groups.starts, ends[1]))
                columns = [pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.astype(np.int32))) for starts, flat in lists]
                ids = batch.column("doc_id").slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([ids, *columns], ["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"])

    lists = ", ".join(f"{name} array<int>" for name in ("a_ids", "b_ids", "a_ends", "b_ends"))
    return docs.select("doc_id", "text").mapInArrow(align, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {lists}")


_ROW = {
    "doc_id": pa.int64(),
    "slice": pa.int64(),
    "place": pa.int32(),
    "n_a": pa.int64(),
    "n_b": pa.int64(),
    "n_groups": pa.int64(),
    "n_links": pa.int64(),
    "groups_sha256": pa.string(),
    "bucket": pa.int32(),
    "pairs": pa.binary(),
    "counts": pa.binary(),
    "links": pa.binary(),
    "links_per_kind": pa.binary(),
    "texts_per_kind": pa.binary(),
    "places": pa.binary(),
    "times": pa.binary(),
}
_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
_MATRIX = ("links", "links_per_kind", "texts_per_kind", "places", "times")


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    made = [pa.array(columns[k], t) if k in columns else pa.nulls(n, t) for k, t in _ROW.items()]
    return pa.RecordBatch.from_arrays(made, list(_ROW))


def _slice_rows(left: Side, right: Side, groups: Groups, number: int) -> pa.RecordBatch:
    """One row per bucket, with the slice's pairs in order and the links of each, and one with what its texts hold.

    That is, for each kind of group, its links as numbers of pairs, and the texts it is in with how often.
    """
    ids_a, ids_b, per_kind = links(left, right, groups)
    key = ids_b.astype(np.uint64) << np.uint64(32) | ids_a.astype(np.uint64)
    pairs, number_of = np.unique(key, return_inverse=True)
    place = np.repeat(np.arange(len(groups.starts) - 1), np.diff(groups.starts))
    held, times = np.unique(groups.kind * SLICE_TEXTS + place, return_counts=True)
    kind, place = held // SLICE_TEXTS, held % SLICE_TEXTS
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, number_of, np.repeat(np.bincount(groups.kind, minlength=len(per_kind)), per_kind))
    bucket = _bucket(pairs)
    rows: dict[str, list] = {name: [] for name in ("slice", "bucket", "pairs", "counts", *_MATRIX)}
    for k in np.unique(bucket).tolist():
        chosen = bucket == k
        for name, value in (("slice", number), ("bucket", k), ("pairs", pairs[chosen].tobytes()), ("counts", counts[chosen].tobytes())):
            rows[name].append(value)
        for name in _MATRIX:
            rows[name].append(None)
    texts_per_kind = np.bincount(kind, minlength=len(per_kind))
    arrays = (number_of.astype(np.uint32), per_kind.astype(np.uint32), texts_per_kind.astype(np.uint32), place.astype(np.uint16), times.astype(np.uint32))
    for name, value in (("slice", number), ("bucket", -1), ("pairs", pairs.tobytes()), ("counts", None), *zip(_MATRIX, (x.tobytes() for x in arrays), strict=True)):
        rows[name].append(value)
    return _batch(**rows)


def _bucket(pairs: np.ndarray) -> np.ndarray:
    return (mix(pairs >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int32)


def _aligned_slices(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row per text, without a bucket, per slice of texts and bucket of pairs, and per slice, with bucket -1."""

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at, texts in _slices(batch):
                left, right = _both(texts, a, b)
                groups = grouped(left, right)
                spelt, shas = _spelt(left, right, groups), []
                for begin, end in zip(groups.starts[:-1].tolist(), groups.starts[1:].tolist(), strict=True):
                    text = ";".join(map(spelt.__getitem__, groups.kind[begin:end].tolist()))
                    shas.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
                n_a, n_b, n_groups = np.diff(left.starts), np.diff(right.starts), np.diff(groups.starts)
                yield _batch(
                    doc_id=batch.column("doc_id").slice(at, len(texts)),
                    slice=[number] * len(texts),
                    place=np.arange(len(texts), dtype=np.int32),
                    n_a=n_a,
                    n_b=n_b,
                    n_groups=n_groups,
                    n_links=n_a + n_b - n_groups,
                    groups_sha256=shas,
                )
                if len(left.ids):
                    yield _slice_rows(left, right, groups, number)
                number += 1

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return given.mapInArrow(run, ", ".join(f"`{k}` {_TYPES[t]}" for k, t in _ROW.items()))


def _summed(pairs: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    flat, weights = np.concatenate(pairs), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat, weights = flat[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]])) if len(flat) else np.zeros(0, np.int64)
    return flat[first], np.add.reduceat(weights, first) if len(first) else weights


def _merge(batches) -> Iterator[pa.RecordBatch]:
    """Sums the counts of equal pairs of a task, holding the different pairs and a bounded number of others."""
    pairs, counts, held, kept = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0, 0
    for batch in batches:
        for row in range(batch.num_rows):
            pairs.append(np.frombuffer(batch.column("pairs")[row].as_buffer(), np.uint64))
            counts.append(np.frombuffer(batch.column("counts")[row].as_buffer(), np.int64))
            held += len(pairs[-1])
            if held > HELD_PAIRS + kept:
                flat, weights = _summed(pairs, counts)
                pairs, counts, held, kept = [flat], [weights], 0, len(flat)
    flat, weights = _summed(pairs, counts)
    bucket = _bucket(flat)
    for k in np.unique(bucket).tolist():
        chosen = np.flatnonzero(bucket == k)
        for at in range(0, len(chosen), HELD_PAIRS):
            some = chosen[at : at + HELD_PAIRS]
            columns = [pa.array([k], pa.int32()), pa.array([flat[some].tobytes()], pa.binary()), pa.array([weights[some].tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["bucket", "pairs", "counts"])


def pair_counts(found: DataFrame) -> DataFrame:
    """bucket, pairs, counts: the corpus-wide links of every pair of ids, as packed arrays of B's id << 32 | A's id.

    Pairs are summed in each task, then by bucket and salt, then by bucket.
    """
    schema, salts = "bucket int, pairs binary, counts binary", _salts(found)
    each = found.filter("bucket >= 0").select("bucket", "pairs", "counts").mapInArrow(_merge, schema)
    if salts > 1:
        salted = each.repartition(salts * BUCKETS, "bucket", F.pmod(F.xxhash64("pairs"), F.lit(salts)))
        each = salted.mapInArrow(_merge, schema)
    return each.repartition(BUCKETS, "bucket").mapInArrow(_merge, schema)


def _salts(df: DataFrame) -> int:
    return max(1, -(-partitions(df.sparkSession) // BUCKETS))


def _best(pairs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether a pair's count is the highest of its B id; pairs are in order and have all of their B ids."""
    of_b = pairs >> np.uint64(32)
    first = np.flatnonzero(np.concatenate([[True], of_b[1:] != of_b[:-1]]))
    return counts == np.repeat(np.maximum.reduceat(counts, first), np.diff(np.append(first, len(of_b))))


def _answered(batches) -> Iterator[pa.RecordBatch]:
    """Per slice and bucket, of each of its pairs the corpus-wide count and whether that is the highest of its B id.

    Of each bucket and salt, the rows of counts, which have no slice, come first.
    """
    now, pairs, counts, ready = None, [], [], False
    for batch in batches:
        for row in range(batch.num_rows):
            where = (batch.column("bucket")[row].as_py(), batch.column("salt")[row].as_py())
            own, number = np.frombuffer(batch.column("pairs")[row].as_buffer(), np.uint64), batch.column("slice")[row].as_py()
            if where != now:
                now, pairs, counts, ready = where, [], [], False
            if number is None:
                pairs.append(own)
                counts.append(np.frombuffer(batch.column("counts")[row].as_buffer(), np.int64))
                continue
            if not ready:
                all_pairs, all_counts = _summed(pairs, counts)
                best, ready, pairs, counts = _best(all_pairs, all_counts), True, [], []
            at = np.searchsorted(all_pairs, own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([own.tobytes()]), pa.array([all_counts[at].tobytes()]), pa.array([best[at].tobytes()])],
                ["slice", "pairs", "counts", "best"],
            )


def _scored(batches) -> Iterator[pa.RecordBatch]:
    """Per text: links whose count is the highest of their B id, and the sum of all links' counts.

    The answers to a slice's pairs come before the row with what its texts hold.
    """
    answers: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        for row in range(batch.num_rows):

            def array(name: str, dtype) -> np.ndarray:
                return np.frombuffer(batch.column(name)[row].as_buffer(), dtype)  # noqa: B023

            if not batch.column("links")[row].is_valid:
                answers.append((array("pairs", np.uint64), array("counts", np.int64), array("best", bool)))
                continue
            pairs, counts, best = (np.concatenate(x) for x in zip(*answers, strict=True))
            order, answers = np.argsort(pairs), []
            link, per_kind, texts = order[array("links", np.uint32)], array("links_per_kind", np.uint32), array("texts_per_kind", np.uint32)
            first, places, times = np.cumsum(per_kind.astype(np.int64)) - per_kind, array("places", np.uint16), array("times", np.uint32).astype(np.int64)
            of_texts = []
            for value in (best.astype(np.int64), counts):
                per_group = np.repeat(np.add.reduceat(value[link], first.astype(np.int64)), texts)
                of_texts.append(np.zeros(int(places.max()) + 1, np.int64))
                np.add.at(of_texts[-1], places, times * per_group)
            full = np.unique(places)
            number = np.full(len(full), batch.column("slice")[row].as_py())
            columns = [number, full.astype(np.int32), *(x[full] for x in of_texts)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["slice", "place", "n_best", "count_sum"])


def alignment_counts(docs: DataFrame, a: str = BYTE_BPE, b: str = PIECE_BPE) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best counts the links whose pair is linked most often, corpus-wide, of all pairs with its B id, ties included;
    count_sum sums the corpus-wide counts over the links; the hash is of the groups as `a1,a2|b1;a3|b2,b3`.
    """
    spark, salts = docs.sparkSession, _salts(docs)
    found = stored(_aligned_slices(docs, a, b))
    counts = stored(pair_counts(found))
    asked = found.filter("bucket >= 0").select("bucket", F.pmod(F.xxhash64("slice"), F.lit(salts)).cast("int").alias("salt"), "slice", "pairs")
    repeated = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    dealt = asked.unionByName(repeated, allowMissingColumns=True).repartition(salts * BUCKETS, "bucket", "salt")
    answers = dealt.sortWithinPartitions("bucket", "salt", F.col("slice").asc_nulls_first()).mapInArrow(
        _answered, "slice long, pairs binary, counts binary, best binary"
    )
    held = found.filter("bucket = -1").select("slice", *_MATRIX)
    met = answers.unionByName(held, allowMissingColumns=True).repartition(partitions(spark), "slice")
    scores = met.sortWithinPartitions("slice", F.col("links").isNotNull()).mapInArrow(_scored, "slice long, place int, n_best long, count_sum long")
    texts = found.filter("bucket IS NULL").select("doc_id", "slice", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return texts.join(scores, ["slice", "place"], "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"),
        "groups_sha256",
    )
