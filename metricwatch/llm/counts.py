"""Token counts that follow edits.

A document's pre-tokens are grouped into leaves of a few, and a segment tree over the leaves holds sums of
characters and tokens. An edit is located by characters; the leaves it touches are encoded again, with the next leaf on a side
where the edit comes so close to the border that it could move it; then the sums above them are renewed. Leaves
begin where the tokenizer certainly splits, so the sum at the root is the count of the whole text.

The trees can be stored as plain columns and taken up again, so that later edits need no encoding of whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metricwatch.llm.text import slices
from metricwatch.llm.tokens import Encoder, encoder

#: Pre-tokens of a leaf.
LEAF = 24
#: Characters next to a border that decide whether it is one.
CONTEXT = 3

_TREE = "doc_id long, text string, chars array<int>, tokens array<int>"


class Tree:
    """One document: its text by leaves, and the sums of characters and tokens over them."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray):
        self.encoded = 0
        if not len(chars):
            chars = tokens = np.zeros(1, np.int64)
        ends = np.cumsum(chars).tolist()
        self.leaves = [text[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = self._sums(chars), self._sums(tokens)

    def _sums(self, values: np.ndarray) -> list[int]:
        levels = [np.zeros(self.size, np.int64)]
        levels[0][: len(values)] = values
        while len(levels[-1]) > 1:
            levels.append(levels[-1][0::2] + levels[-1][1::2])
        return [0, *np.concatenate(levels[::-1]).tolist()]

    @property
    def count(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at a place (at the end of the text, the last that has any), and the place within it."""
        node = 1
        while node < self.size:
            node *= 2
            if place >= self.chars[node] and self.chars[node + 1]:
                place -= self.chars[node]
                node += 1
        return node - self.size, place

    def touched(self, at: int, removed: int, inserted: str) -> tuple[int, int, str]:
        """First and last leaf that an edit touches, and their text after it."""
        at = min(max(at, 0), self.chars[1])
        stop = min(at + max(removed, 0), self.chars[1])
        first, begin = self.leaf_at(at)
        last, end = self.leaf_at(stop)
        text = "".join(self.leaves[first : last + 1])
        end = begin + stop - at
        while first > 0 and begin < CONTEXT:
            first -= 1
            text = self.leaves[first] + text
            begin, end = begin + len(self.leaves[first]), end + len(self.leaves[first])
        while last < len(self.leaves) - 1 and len(text) - end < CONTEXT:
            last += 1
            text += self.leaves[last]
        return first, last, text[:begin] + inserted + text[end:]

    def renew(self, first: int, last: int, text: str, tokens: int) -> None:
        """Puts a text and its count in the place of the leaves."""
        self.encoded += len(text)
        for leaf in range(first, last + 1):
            self.leaves[leaf] = text if leaf == first else ""
            for sums, value in ((self.chars, len(text)), (self.tokens, tokens)):
                node = leaf + self.size
                sums[node] = value if leaf == first else 0
                while node > 1:
                    node //= 2
                    sums[node] = sums[2 * node] + sums[2 * node + 1]


def _leaves(encode: Encoder, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Characters and tokens of each text's leaves."""
    for _, part in slices(texts):
        odd = encode.odd(part)
        data, starts, first, owner, sizes = encode.counted(part)
        # The first piece of every leaf.
        n = np.bincount(owner, minlength=len(part))
        begins = np.cumsum(n) - n
        heads = np.flatnonzero((np.arange(len(first)) - begins[owner]) % LEAF == 0)
        tokens = np.add.reduceat(sizes, heads) if len(heads) else np.zeros(0, np.int64)
        sofar = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # characters
        edges = np.append(first[heads], len(data))
        chars = np.diff(sofar[edges])
        at = np.searchsorted(owner[heads], np.arange(len(part) + 1))
        whole = iter(encode.count(part.filter(pa.array(odd)).to_pylist()))
        lengths = np.diff(sofar[starts])
        for i in range(len(part)):
            if odd[i]:
                yield lengths[i : i + 1], np.array([next(whole)])
            else:
                yield chars[at[i] : at[i + 1]], tokens[at[i] : at[i + 1]]


def token_trees(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, text, and the characters and tokens of its leaves; null texts count as empty, every row is returned."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            found = list(_leaves(encode, batch.column("text")))
            arrays = [pa.array([x[k] for x in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), *arrays], ["doc_id", "text", "chars", "tokens"])

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), text.alias("text")).mapInArrow(rows, _TREE)


def _apply(encode: Encoder, trees: list[Tree], edits: list[list[dict]]) -> None:
    """All trees' first edits, then their second ones, and so on, so that each round is encoded as one batch."""
    for number in range(max(map(len, edits), default=0)):
        work = []
        for tree, row in zip(trees, edits, strict=True):
            if number >= len(row) or row[number] is None or row[number]["at"] is None:
                continue
            edit = row[number]
            work.append((tree, *tree.touched(edit["at"], edit["removed"] or 0, edit["inserted"] or "")))
        odd = encode.odd(pa.array([w[3] for w in work], pa.string()))
        for i in np.flatnonzero(odd).tolist():  # from now on the whole text is one leaf
            tree, first, last, text = work[i]
            whole = "".join([*tree.leaves[:first], text, *tree.leaves[last + 1 :]])
            work[i] = (tree, 0, len(tree.leaves) - 1, whole)
        for (tree, first, last, text), n in zip(work, encode.count([w[3] for w in work]), strict=True):
            tree.renew(first, last, text, n)


def _edits(column: pa.Array) -> list[list[dict]]:
    return [x or [] for x in column.to_pylist()]


def apply_edits(trees: DataFrame, vocabulary: str) -> DataFrame:
    """The trees after the edits in their column `edits`, an array of (at, removed, inserted) in the order they happen.

    Places and lengths are in characters of the text as the edits before have left it, cut to the text; an edit
    that is null or has no place does nothing, null lengths and texts count as none.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            held = [
                Tree(t, np.array(c, np.int64), np.array(n, np.int64))
                for t, c, n in zip(*(batch.column(k).to_pylist() for k in ("text", "chars", "tokens")), strict=True)
            ]
            _apply(encode, held, _edits(batch.column("edits")))
            columns = [
                batch.column("doc_id"),
                pa.array([t.text() for t in held], pa.string()),
                pa.array([t.chars[t.size : t.size + len(t.leaves)] for t in held], pa.list_(pa.int32())),
                pa.array([t.tokens[t.size : t.size + len(t.leaves)] for t in held], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "chars", "tokens"])

    return trees.select("doc_id", "text", "chars", "tokens", "edits").mapInArrow(rows, _TREE)


def edited_counts(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text", edits_column: str = "edits") -> DataFrame:
    """doc_id, n_tokens, n_edits, n_tokens_after, n_chars_encoded: counts before and after the edits of each row.

    `n_chars_encoded` says how much text the edits made the tokenizer read. See apply_edits() for edits, null ones are none.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            for at, texts in slices(batch.column("text")):
                part = batch.slice(at, len(texts))
                held = [Tree(t, c, n) for t, (c, n) in zip(texts.to_pylist(), _leaves(encode, texts), strict=True)]
                before = [t.count for t in held]
                edits = _edits(part.column("edits"))
                _apply(encode, held, edits)
                columns = [before, list(map(len, edits)), [t.count for t in held], [t.encoded for t in held]]
                names = ["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_chars_encoded"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)], names)

    read = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
        F.col(edits_column).cast("array<struct<at:int,removed:int,inserted:string>>").alias("edits"),
    )
    return read.mapInArrow(rows, "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_chars_encoded long")
