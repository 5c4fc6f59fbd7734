"""Word hashes against their definition, worked out with whole numbers."""

import ctypes
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from metricwatch.llm import quality, text
from metricwatch.llm.shared import frugal
from metricwatch.llm.tokens import BYTE_BPE, Encoder, vocabulary


def plain_hash(word: bytes) -> int:
    total = sum(int(text._LOWER[b]) * pow(int(text._PRIME), i, 1 << 64) for i, b in enumerate(word))
    return int(text.mix(np.array([(total + len(word) * 0xD6E8FEB86659FD93) % (1 << 64)], np.uint64))[0])


def test_hashes_are_those_of_their_definition_wherever_a_word_stands():
    words = ["Ab", "é" * 40, "x" * (2 * text.POWERS + 3), "ab", "y" * (text.POWERS - 1), "c", "AB"] * 3
    hashes, starts = text.words(pa.array([" ".join(words), "", "ab"]))
    assert hashes.tolist() == [plain_hash(w.encode()) for w in [*words, "ab"]] and starts.tolist() == [0, 21, 21, 22]


def test_powers_are_not_worked_out_for_every_byte(monkeypatch):
    made = []
    plain = text._powers
    monkeypatch.setattr(text, "_powers", lambda base, n: made.append(n) or plain(base, n))
    hashes, _ = text.words(pa.array(["word " * 100_000]))
    assert len(hashes) == 100_000 and len(set(hashes.tolist())) == 1 and sum(made) < 20_000


def test_shingles_and_features_of_a_slice_are_made_in_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    given = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 600)) for _ in range(1100)]
    texts = pa.array([*given, None, "", " ", "one two", given[0]])
    pieced = text.shingles(texts), quality.features(texts)
    tracemalloc.start()
    try:
        for work in (text.shingles, quality.features):
            tracemalloc.reset_peak()
            work(texts)
            assert tracemalloc.get_traced_memory()[1] < 40e6  # 98 and 143 MB before
    finally:
        tracemalloc.stop()
    monkeypatch.setattr(text, "PIECE_BYTES", 1 << 30)
    monkeypatch.setattr(quality, "PIECE_BYTES", 1 << 30)
    (hashes, starts), whole = text.shingles(texts), quality.features(texts)
    assert np.array_equal(pieced[0][0], hashes) and np.array_equal(pieced[0][1], starts) and np.array_equal(pieced[1], whole)
    assert [len(x) for x in text.shingles(pa.array([], pa.string()))] == [0, 1]


def test_encoding_takes_little_memory_at_a_time():
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(map(str, rng.integers(0, 10**9, 400))) for _ in range(1000)])  # 4 MB, almost all pieces new
    encode = Encoder(vocabulary(BYTE_BPE))
    tracemalloc.start()
    try:
        ids, n = encode(texts)
        assert tracemalloc.get_traced_memory()[1] < 30 * texts.nbytes  # 281 MB before
    finally:
        tracemalloc.stop()
    again, n_again = encode(texts)  # all pieces known
    assert np.array_equal(again, ids) and np.array_equal(n_again, n)


@pytest.mark.skipif(not hasattr(ctypes.CDLL(None), "malloc_trim"), reason="only glibc hands memory back when asked")
def test_a_task_s_end_hands_memory_back():
    kept = []

    def own() -> float:
        return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

    def rows(batches):
        for batch in batches:
            held = [np.ones(1 << 12) for _ in range(6400)]  # 200 MB in arrays that the allocator doesn't return one by one
            kept.append(np.ones(1 << 12))  # lies behind them
            del held
            yield batch

    before, batch = own(), pa.RecordBatch.from_pydict({"x": [1]})
    work = frugal(rows)([batch])
    assert next(work) is batch and own() > before + 150
    assert not list(work) and own() < before + 50
