"""Alignment of two tokenizers against a plain walk over token bytes."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from metricwatch.llm import alignment
from metricwatch.llm.queries import QUERIES
from metricwatch.llm.tokens import BYTE_BPE, vocabulary


def byte_names():
    taken = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names, extra = {}, 0
    for byte in range(256):
        if byte in taken:
            names[chr(byte)] = byte
        else:
            names[chr(256 + extra)] = byte
            extra += 1
    return names


class Plain:
    """The contract, token by token."""

    def __init__(self):
        self.a = Tokenizer.from_file(vocabulary(BYTE_BPE))
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_file=vocabulary(alignment.PIECE_BPE))
        self.byte_of = byte_names()

    def tokens(self, text):
        if not text:
            return [], []
        ids = self.a.encode(" " + text, add_special_tokens=False).ids
        left = [(i, bytes(self.byte_of[c] for c in self.a.id_to_token(i))) for i in ids]
        right = []
        for i in self.b.encode(text):
            name = self.b.id_to_piece(i)
            right.append((i, bytes([int(name[3:5], 16)]) if self.b.is_byte(i) else name.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        same = b"".join(x for _, x in left) == whole == b"".join(x for _, x in right)
        return (left, right) if same else ([], [])

    def rows(self, texts):
        made, counts = [], Counter()
        for text in texts:
            left, right = self.tokens(text)
            spans_a, spans_b = self.spans(left), self.spans(right)
            pairs = [(a, b) for a, a0, a1 in spans_a for b, b0, b1 in spans_b if a0 < b1 and b0 < a1] if left else []
            counts.update(pairs)
            ends = sorted({x[2] for x in spans_a} & {x[2] for x in spans_b})
            groups, start = [], 0
            for end in ends:
                inside = [",".join(str(i) for i, s, e in spans if start < e <= end) for spans in (spans_a, spans_b)]
                groups.append("|".join(inside))
                start = end
            made.append((len(left), len(right), len(groups), pairs, ";".join(groups)))
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        return [
            (
                n_a,
                n_b,
                n_groups,
                len(pairs),
                sum(counts[p] == best[p[1]] for p in pairs),
                sum(counts[p] for p in pairs),
                hashlib.sha256(groups.encode()).hexdigest() if groups else "",
            )
            for n_a, n_b, n_groups, pairs, groups in made
        ]

    @staticmethod
    def spans(tokens):
        ends = np.cumsum([len(x) for _, x in tokens]).tolist()
        return [(i, end - len(x), end) for (i, x), end in zip(tokens, ends, strict=True)]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    words = ["the", "Über", "naïve", "tokenization", "don't", "3.14", "日本", "x▁y", "<s>", "<|endoftext|>", "\x00", "\xa0", "ﬁ", "😀", "\r\n", "\t"]
    made = [rng.choice(["", " "]) + rng.choice([" ", "  ", "\n"]).join(rng.choice(words) for _ in range(rng.randint(1, 25))) for _ in range(150)]
    return [*made, None, "", " ", "   ", "a ", " a", "x▁", "▁", "é", "same text", "same text", "long word " * 300]


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_counts_are_those_of_a_plain_walk(spark, texts):
    rows = [(i, t, 1, "x", 2, 3) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slice long, pairs string, bucket int, n_a long").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in alignment.alignment_counts(docs).collect()}
    wanted = Plain().rows(texts)
    assert len(got) == len(texts)
    for i, row in enumerate(wanted):
        assert got[i] == row, texts[i]
    assert sum(1 for r in wanted if r[0] == 0) > 4 and any(r[2] < min(r[0], r[1]) for r in wanted)


def test_repeated_and_unnamed_rows_are_texts_of_their_own(spark):
    docs = spark.createDataFrame([(1, "a text"), (1, "a text"), (None, "a text"), (None, None)], "doc_id long, text string")
    rows = alignment.alignment_counts(docs).collect()
    alone = alignment.alignment_counts(docs.limit(1)).first()
    assert len(rows) == 4 and sorted(r.count_sum for r in rows) == [0] + [3 * alone.count_sum] * 3


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment_counts(docs).collect() == [] and alignment.aligned(docs).collect() == []


def test_groups_hold_the_ids_in_order(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    plain = Plain()
    for row in alignment.aligned(docs).collect():
        left, right = plain.tokens(texts[row.doc_id])
        assert (row.a_ids, row.b_ids) == ([i for i, _ in left], [i for i, _ in right])
        if left:
            assert (row.a_ends[-1], row.b_ends[-1]) == (len(left), len(right)) and row.a_ends == sorted(set(row.a_ends))


def test_long_texts_are_cut_in_windows(monkeypatch):
    rng = np.random.default_rng(3)
    ends = [np.unique(np.append(rng.integers(1, 5000, 900), 5000)) for _ in range(2)]
    whole = alignment.group_cuts(*ends)
    monkeypatch.setattr(alignment, "WINDOW", 37)
    assert alignment.group_cuts(*ends) == whole
    common = np.intersect1d(*ends)
    assert whole[0] == (np.searchsorted(ends[0], common) + 1).tolist()


def test_pairs_are_merged_in_bounded_steps(monkeypatch):
    rng = np.random.default_rng(4)
    arrays = [np.sort(rng.integers(0, 500, 200).astype(np.uint64) << np.uint64(32)) for _ in range(9)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([0] * 9, pa.int32()), pa.array([x.tobytes() for x in arrays]), pa.array([np.ones(len(x), np.int64).tobytes() for x in arrays])],
        ["bucket", "pairs", "counts"],
    )
    monkeypatch.setattr(alignment, "HELD_PAIRS", 150)
    found = Counter()
    for out in alignment._merge([batch]):
        for pairs, counts in zip(out.column("pairs").to_pylist(), out.column("counts").to_pylist(), strict=True):
            found.update(dict(zip(np.frombuffer(pairs, np.uint64).tolist(), np.frombuffer(counts, np.int64).tolist(), strict=True)))
    assert found == Counter(np.concatenate(arrays).tolist())


def test_query(spark):
    rows = QUERIES["op13_token_alignment"](spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", *COLUMNS] and rows.count() == 200
