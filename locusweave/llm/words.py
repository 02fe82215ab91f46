"""Word and shingle hashes for whole Arrow batches, in numpy.

The bytes of many texts are hashed together. With powers of an odd number, prefix sums give the polynomial hash of any
byte range as (S[end] - S[start]) / P**start modulo 2**64, which is then mixed. A long text is taken in pieces that end
at white space, so memory follows the piece and not the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from locusweave.llm.common import runs_on_executors

runs_on_executors(__name__)
PIECE_BYTES = 1 << 20
_P = 0x9E3779B97F4A7C15
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose output bits depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_powers: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of P and of its inverse, n of each at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE_BYTES + 1)
        for base in (_P, pow(_P, -1, 1 << 64)):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers.append(np.multiply.accumulate(row))
        del _powers[:-2]
    return _powers[0], _powers[1]


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and its offsets; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), offsets


class Piece:
    """Words of consecutive texts (or of a part of one long text).

    low: the lower-cased bytes; start, end: byte places of the words in it; text: number of the text of each word.
    """

    def __init__(self, raw: np.ndarray, bounds: np.ndarray, first: int):
        n = len(raw)
        self.raw, self.low = raw, _LOWER[raw]
        blank = _BLANK[raw]
        edge = np.zeros(n + 1, bool)
        edge[bounds] = True
        before, after = edge[:n].copy(), edge[1:].copy()
        before[1:] |= blank[:-1]
        after[:-1] |= blank[1:]
        self.start = np.flatnonzero(before & ~blank)
        self.end = np.flatnonzero(after & ~blank) + 1
        self.text = first + np.searchsorted(bounds, self.start, "right") - 1

    def _sums(self) -> np.ndarray:
        if not hasattr(self, "_prefix"):
            power, _ = _tables(len(self.low) + 1)
            self._prefix = np.zeros(len(self.low) + 1, np.uint64)
            np.cumsum((self.low.astype(np.uint64) + np.uint64(1)) * power[: len(self.low)], out=self._prefix[1:])
        return self._prefix

    def hashes(self, start=None, end=None) -> np.ndarray:
        """64-bit hashes of byte ranges; of the words if none are given."""
        start, end = (self.start, self.end) if start is None else (start, end)
        sums = self._sums()
        return mix64((sums[end] - sums[start]) * _tables(len(self.low) + 1)[1][start])


def pieces(column: pa.Array) -> Iterator[Piece]:
    data, offsets = texts_of(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1
        if j > i:
            low, high = int(offsets[i]), int(offsets[j])
            yield Piece(data[low:high], offsets[i : j + 1] - low, i)
            i = j
            continue
        at, end = int(offsets[i]), int(offsets[i + 1])
        while at < end:
            to = min(at + PIECE_BYTES, end)
            if to < end:
                gaps = np.flatnonzero(_BLANK[data[at:to]])
                while not len(gaps) and to < end:  # a word longer than a piece
                    was, to = to, min(to + PIECE_BYTES, end)
                    gaps = np.flatnonzero(_BLANK[data[was:to]]) + (was - at)
                to = at + int(gaps[-1]) + 1 if len(gaps) else end
            yield Piece(data[at:to], np.array([0, to - at]), i)
            at = to
        i += 1


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch in order, and offsets by text."""
    found = [(p.hashes(), p.text) for p in pieces(column)]
    hashes = np.concatenate([h for h, _ in found]) if found else np.zeros(0, np.uint64)
    texts = np.concatenate([t for _, t in found]) if found else np.zeros(0, np.int64)
    return hashes, np.searchsorted(texts, np.arange(len(column) + 1))


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of `words` words; of the whole text if it has fewer."""
    hashes, offsets = word_hashes(column)
    turn = [mix64(np.array([k + 1], np.uint64))[0] | np.uint64(1) for k in range(words)]
    n = len(hashes)
    runs = np.zeros(max(0, n - words + 1), np.uint64)
    for k in range(words):
        runs += hashes[k : k + len(runs)] * turn[k]
    runs = mix64(runs)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            short = np.array([b - a], np.uint64)
            for k in range(a, b):
                short = mix64(short * np.uint64(_P) + hashes[k])
            yield short
        else:
            yield np.zeros(0, np.uint64)
