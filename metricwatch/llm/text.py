"""Whole Arrow batches of text as numpy arrays: word bounds, word hashes and shingle hashes.

A word is `[^\\x20\\x09-\\x0D]+` of the UTF-8 bytes, with A-Z in lower case if asked. Hashes are 64 bits wide: among
n different strings, a chance collision is expected about n * n / 2**65 times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SHINGLE_WORDS = 5
#: Ends one slice of a text column: numpy works on several arrays of this many bytes at a time.
SLICE_BYTES = 4 << 20
#: Of these, so many bytes at a time are hashed, with arrays of eight bytes for each byte; Python keeps such memory for long.
PIECE_BYTES = 512 << 10

_PRIME = np.uint64(0x9E3779B97F4A7C15 | 1)
#: Powers of a base in a table; the higher ones are products of two.
POWERS = 2048
_INVERSE = np.uint64(pow(int(_PRIME), -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = np.asarray(x, np.uint64).copy()
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    x ^= x >> np.uint64(31)
    return x


#: A random number per byte value, the second table with A-Z as a-z.
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _PRIME)
_LOWER = _BYTES.copy()
_LOWER[65:91] = _BYTES[97:123]
_STEPS = mix(np.arange(1001, 1001 + SHINGLE_WORDS, dtype=np.uint64)) | np.uint64(1)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    filled, step = 1, np.array([base], np.uint64)
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * step
        filled, step = filled + more, step * step
    return out[:n]


def _power_tables(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of which a product, `low[i % POWERS] * high[i // POWERS]`, is base**i for each i below n."""
    return _powers(base, POWERS), _powers(np.uint64(pow(int(base), POWERS, 1 << 64)), -(-n // POWERS))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, and where each text starts, with the end of the last; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    starts = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES):
    """The column in pieces of about `size` bytes, each of one whole text at least, with the number of the first."""
    _, starts = buffers(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(starts, starts[at] + size, "right")) - 1)
        yield at, texts.slice(at, end - at)
        at = end


def is_space(data: np.ndarray) -> np.ndarray:
    return _SPACE[data]


def word_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte, end byte and text number of every word."""
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)  # where a text begins no word goes on
    edge[starts] = True
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    first = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return first, end, np.searchsorted(starts, first, "right") - 1


def span_hashes(data: np.ndarray, first: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each span of bytes: a polynomial in random numbers per byte value, mixed with the length."""
    if not len(first):
        return np.zeros(0, np.uint64)
    low, high = _power_tables(_PRIME, len(data))
    terms = (high[:, None] * low).ravel()[: len(data)]
    terms *= (_LOWER if lower else _BYTES)[data]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=sums[1:])
    low, high = _power_tables(_INVERSE, len(data))
    found = (sums[end] - sums[first]) * (low[first % POWERS] * high[first // POWERS])
    return mix(found + (end - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in lower case, and where each text's words start, with the end of the last."""
    data, starts = buffers(texts)
    first, end, owner = word_bounds(data, starts)
    counts = np.bincount(owner, minlength=len(texts))
    return span_hashes(data, first, end, lower=True), np.concatenate([[0], np.cumsum(counts)])


def shingles(texts: pa.Array, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within it, and where each text's shingles start.

    A text with fewer words than `size` has its whole word sequence as one shingle, and none without words.
    """
    parts = [_shingles(piece, size) for _, piece in slices(texts, PIECE_BYTES)]
    if len(parts) < 2:
        return parts[0] if parts else _shingles(texts, size)
    lengths = np.concatenate([np.diff(starts) for _, starts in parts])
    return np.concatenate([hashes for hashes, _ in parts]), np.concatenate([[0], np.cumsum(lengths)])


def _shingles(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    hashes, starts = words(texts)
    n = np.diff(starts)
    short, long = (n > 0) & (n < size), n >= size
    owner = np.repeat(np.arange(len(n)), n)
    place = np.arange(len(hashes)) - starts[owner]
    takes = np.where(long[owner], place <= n[owner] - size, (place == 0) & short[owner])
    at = np.flatnonzero(takes)
    steps = _STEPS if size == SHINGLE_WORDS else mix(np.arange(1001, 1001 + size, dtype=np.uint64)) | np.uint64(1)
    total, width = np.zeros(len(at), np.uint64), np.minimum(n[owner[at]], size)
    padded = np.concatenate([hashes, np.zeros(size, np.uint64)])
    for j in range(size):
        total += np.where(j < width, padded[at + j] * steps[j], np.uint64(0))
    found, owner = mix(total + width.astype(np.uint64)), owner[at]
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    keep = np.ones(len(found), bool)
    keep[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
    return found[keep], np.concatenate([[0], np.cumsum(np.bincount(owner[keep], minlength=len(n)))])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indexes starts[0] .. starts[0] + lengths[0] - 1, then those of the second span, and so on."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)
