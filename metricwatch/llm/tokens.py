"""Token ids of text columns by a public tokenizer, with each distinct piece of text encoded once per worker.

The tokenizers split a text before they merge, and never across the bounds used here, so the ids of a text are the
ids of its pieces in a row. Pieces are told apart by a 64-bit hash; a worker keeps the ids of at most
CACHED_PIECES of them. Texts in which the bounds aren't certain are encoded whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from metricwatch.llm.text import PIECE_BYTES, buffers, gather, is_space, slices, span_hashes

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
CACHED_PIECES = 2_000_000
#: Pieces that the library encodes at a time; what it returns is many times larger than the ids.
PIECES_AT_ONCE = 10_000

#: White space other than ASCII's, next to which the bounds of the byte-level vocabulary aren't certain; so are they in
#: strings of special tokens, which begin with <|.
_WIDE_SPACE = "[\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200b}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}\\x{feff}]"
_LETTER, _SIGN = np.zeros(256, bool), np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_SIGN[0x21:0x7F] = ~_LETTER[0x21:0x7F]
_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; its cache lasts from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, added special tokens left out; strings of special tokens in a text count as the library takes them."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = '"end_of_word_suffix":"</w>"' in self.tokenizer.to_str()
        self._clear()

    def _clear(self) -> None:
        self.keys, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _library(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [x.ids for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(lengths.sum()))
        return flat, lengths

    def _bounds(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First byte, end byte and text number of every piece."""
        if not len(data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        space, letter = is_space(data), _LETTER[data]
        begins = np.zeros(len(data), bool)  # the first byte of a text
        begins[starts[:-1][np.diff(starts) > 0]] = True
        ends = np.append(begins[1:], True)
        before, after = np.ones(len(data), bool), np.ones(len(data), bool)  # white space or nothing stands there
        before[1:], after[:-1] = space[:-1], space[1:]
        before |= begins
        after |= ends
        cut = begins.copy()
        # Between a letter and another visible ASCII character, other than an apostrophe that a letter follows.
        cut[1:] |= (letter[:-1] & _SIGN[data[1:]]) | (letter[1:] & (_SIGN[data[:-1]] & (data[:-1] != 0x27)))
        if self.by_words:  # white space parts all else, and belongs to no piece
            cut = ~space & (cut | before)
            end = ~space & np.append(cut[1:] | space[1:], True) | ~space & ends
            first, end = np.flatnonzero(cut), np.flatnonzero(end) + 1
        else:
            # Before the first of several spaces and before the last, where text follows; around a lone line end.
            lone = space & ~before & ~after & (data != 0x20)
            cut |= space & ~(before & after) & ((data == 0x20) | ~before)
            cut[1:] |= lone[:-1]
            first = np.flatnonzero(cut)
            end = np.append(first[1:], len(data))
        return first, end, np.searchsorted(starts, first, "right") - 1

    def _learn(self, data: np.ndarray, keys: np.ndarray, first: np.ndarray, end: np.ndarray) -> None:
        """Adds pieces that aren't known yet; keys are in order."""
        raw, parts = memoryview(data), []
        for at in range(0, len(keys), PIECES_AT_ONCE):
            spans = zip(first[at : at + PIECES_AT_ONCE].tolist(), end[at : at + PIECES_AT_ONCE].tolist(), strict=True)
            parts.append(self._library([str(raw[a:b], "utf-8") for a, b in spans]))
        flat, lengths = (np.concatenate(x) for x in zip(*parts, strict=True))
        place = np.searchsorted(self.keys, keys)
        self.begins = np.insert(self.begins, place, len(self.ids) + np.cumsum(lengths) - lengths)
        self.sizes = np.insert(self.sizes, place, lengths)
        self.keys = np.insert(self.keys, place, keys)
        self.ids = np.concatenate([self.ids, flat])

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, ...]:
        """The texts' bytes, where each text starts, and of every piece: first byte, text number, place in the cache."""
        data, starts = buffers(texts)
        found = []
        for at, part in slices(texts, PIECE_BYTES):  # the arrays that have an entry for each byte are for a part only
            own, own_starts = buffers(part)
            first, end, owner = self._bounds(own, own_starts)
            found.append((first + starts[at], end + starts[at], owner + at, span_hashes(own, first, end, lower=self.by_words)))
        if not found:
            none = np.zeros(0, np.int64)
            return data, starts, none, none, none
        first, end, owner, hashes = (np.concatenate(x) for x in zip(*found, strict=True))
        return data, starts, first, owner, self._known(data, first, end, hashes)

    def _known(self, data: np.ndarray, first: np.ndarray, end: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Where each piece stands in the cache, in which all are now."""
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = place < len(self.keys)
        known[inside] = self.keys[place[inside]] == keys[inside]
        if not known.all():
            if len(self.keys) + np.count_nonzero(~known) > CACHED_PIECES:
                self._clear()
                known[:] = False
            new = np.flatnonzero(~known)
            self._learn(data, keys[new], first[where[new]], end[where[new]])
            place = np.searchsorted(self.keys, keys)
        return place[back]

    def _pieces(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, _, _, owner, place = self._cut(texts)
        begins, sizes = self.begins[place], self.sizes[place]
        per_text = np.bincount(owner, weights=sizes, minlength=len(texts)).astype(np.int64)
        return self.ids[gather(begins, sizes)], per_text

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Texts in which the bounds aren't certain."""
        pattern = "<[|]" if self.by_words else _WIDE_SPACE + "|<[|]"
        return pc.match_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)

    def counted(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The texts' bytes, where each text starts, and of every piece: first byte, text number, number of ids."""
        data, starts, first, owner, place = self._cut(texts)
        return data, starts, first, owner, self.sizes[place]

    def count(self, pieces: list[str]) -> list[int]:
        """Ids of each text, encoded whole by the library."""
        return [len(x) for x in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text; null counts as empty."""
        texts = texts.fill_null("") if texts.null_count else texts
        odd = self.odd(texts)
        parts, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        for at, piece in slices(texts):
            ids, n = self._pieces(piece)
            parts.append(ids)
            counts[at : at + len(piece)] = n
        flat = np.concatenate(parts)
        if odd.any():  # encoded whole, and put in the place of what the pieces gave
            whole, lengths = self._library(texts.filter(pa.array(odd)).to_pylist())
            begins, sizes = np.cumsum(counts) - counts, counts.copy()
            begins[odd], sizes[odd] = len(flat) + np.cumsum(lengths) - lengths, lengths
            flat, counts = np.concatenate([flat, whole])[gather(begins, sizes)], sizes
        return flat, counts
