"""Hashes of all words and word shingles of a batch of texts, in numpy.

Texts are handled as one byte buffer with document offsets, in pieces of
bounded size, so a batch of many short texts and one very long text cost the
same memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
GOLDEN = 0x9E3779B97F4A7C15
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LETTERS_DIGITS = np.zeros(256, bool)
LETTERS_DIGITS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` odd 64-bit multipliers that depend on nothing but ``seed``."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(GOLDEN)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


class WordHasher:
    """Hashes words: maximal runs of ``word_bytes``, with A-Z in lower case."""

    def __init__(self, word_bytes: np.ndarray):
        self.is_word = word_bytes
        self.values = constants(256, 1)[LOWER]
        self.step = np.uint64(GOLDEN | 1)
        self.back = np.uint64(pow(int(self.step), -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) >= n:
            return
        n = max(n, 2 * PIECE)
        up, down = np.full(n, self.step), np.full(n, self.back)
        up[0] = down[0] = 1
        self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)

    def _bounds(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        word = self.is_word[data]
        before = np.empty_like(word)
        before[:1] = False
        before[1:] = word[:-1]
        before[cuts[cuts < len(data)]] = False
        starts = np.flatnonzero(word & ~before)
        after = np.empty_like(word)
        after[-1:] = False
        after[:-1] = word[1:]
        inner = cuts[(cuts > 0) & (cuts <= len(data))] - 1
        after[inner] = False
        return starts, np.flatnonzero(word & ~after) + 1

    def words(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the words of one piece; no word spans a cut."""
        starts, ends = self._bounds(data, cuts)
        self._powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.up[: len(data)], out=sums[1:])
        return starts, ends, mix((sums[ends] - sums[starts]) * self.down[starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the offsets of its rows; null is empty."""
    column = column.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes, one row at least."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, rows)
        yield first, last
        first = last


def _long_words(hasher: WordHasher, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes for one long text, cut at separators."""
    starts, hashes, at = [], [], 0
    separators = np.flatnonzero(~hasher.is_word[data])
    while at < len(data):
        to = at + 4 * PIECE
        if to < len(data):
            k = np.searchsorted(separators, to)
            to = int(separators[k]) if k < len(separators) else len(data)
        to = min(to, len(data))
        s, _, h = hasher.words(data[at:to], np.zeros(0, np.int64))
        starts.append(s + at)
        hashes.append(h)
        at = to
    return np.concatenate(starts), np.concatenate(hashes)


def batch_words(hasher: WordHasher, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per piece: first row, word bounds per row, byte starts in the row's text, word hashes."""
    data, offsets = text_bytes(column)
    for first, last in pieces(offsets):
        part = data[offsets[first] : offsets[last]]
        cuts = offsets[first : last + 1] - offsets[first]
        if len(part) > 8 * PIECE:
            starts, hashes = _long_words(hasher, part)
        elif len(part):
            starts, _, hashes = hasher.words(part, cuts)
        else:
            starts, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        bounds = np.searchsorted(starts, cuts)
        starts = starts - np.repeat(cuts[:-1], np.diff(bounds))
        yield first, bounds, starts, hashes


def shingle_hashes(words: np.ndarray, width: int, multipliers: np.ndarray) -> np.ndarray:
    """Hash of every run of ``width`` words; of all words if there are fewer."""
    n = len(words)
    if n == 0:
        return words
    width = min(width, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out += words[k : n - width + 1 + k] * multipliers[k]
    return mix(out + np.uint64(width))


def batch_shingle_sets(hasher: WordHasher, column: pa.Array, width: int) -> Iterator[np.ndarray]:
    """Per row, the sorted distinct shingle hashes."""
    multipliers = constants(width, 2)
    for _, bounds, _, words in batch_words(hasher, column):
        runs = shingle_hashes(words, width, multipliers) if len(words) >= width else None
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a >= width:
                yield np.unique(runs[a : b - width + 1])
            else:
                yield shingle_hashes(words[a:b], width, multipliers)
