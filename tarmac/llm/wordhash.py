"""Word hashes of whole Arrow text columns, in numpy.

Words are the maximal runs outside space and \\x09-\\x0D; A-Z count as a-z.  All
functions work on concatenated UTF-8 bytes: both classes are ASCII, so a word never
cuts a character.  A word's hash is a polynomial over random byte values modulo
2**64, then mixed; two seeds give 128 bits where a hash stands for the words
themselves.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes of text hashed at once; a longer text is one piece of its own

_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def _odd(rng) -> np.uint64:
    return np.uint64(int(rng.integers(1 << 62)) * 2 + 1)


class Seed:
    """Byte values and multipliers of one hash function."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.values[65:91] = self.values[97:123]
        self.base, self.gram = _odd(rng), _odd(rng)
        self._powers: dict = {}

    def powers(self, base: np.uint64, n: int):
        """Powers 0..n of ``base`` and of its inverse modulo 2**64."""
        up, down = self._powers.get(int(base), (None, None))
        if up is None or len(up) < n + 1:
            n = max(n, 1 << 16)
            with np.errstate(over="ignore"):
                steps = np.full(n + 1, base, np.uint64)
                steps[0] = 1
                up = np.multiply.accumulate(steps)
                steps[1:] = np.uint64(pow(int(base), -1, 1 << 64))
                down = np.multiply.accumulate(steps)
            self._powers[int(base)] = (up, down)
        return up, down


SEEDS = (Seed(7), Seed(8))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of ``h`` over all 64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def pieces(texts: pa.Array, limit: int = PIECE):
    """Slices (first row, text bytes, offsets) of a text column; nulls are empty."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset: texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def bounds(data: np.ndarray, offsets: np.ndarray):
    """Start and end byte of every word, and the first word of every text (one more at the end)."""
    inside = ~_SPACES[data]
    change = np.empty(len(data) + 1, bool)
    if len(data):
        change[0], change[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
    else:
        change[:] = False
    # a text's edge also cuts words
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    joined = edges[inside[edges] & inside[edges - 1]] if len(edges) else edges
    marks = np.flatnonzero(change)
    if len(joined):
        joined = np.unique(joined)
        marks = np.sort(np.concatenate([marks, joined, joined]))
    starts, ends = marks[0::2], marks[1::2]
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


def words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: Seed = SEEDS[0]) -> np.ndarray:
    """Hash of every word."""
    up, down = seed.powers(seed.base, len(data))
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(seed.values[data] * up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts])


def grams(hashes: np.ndarray, n: int, seed: Seed = SEEDS[0]) -> np.ndarray:
    """Hash of the ``n`` words from every word on (the last n - 1 positions are left out)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    up, down = seed.powers(seed.gram, len(hashes))
    with np.errstate(over="ignore"):
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=total[1:])
        return mix((total[n:] - total[:-n]) * down[:len(hashes) - n + 1])


def rows_of(first: np.ndarray) -> np.ndarray:
    """The text that each word belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def whole_grams(first: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of the ``total`` gram positions lie within one text."""
    last = np.repeat(first[1:], np.diff(first))[:total]
    return np.arange(total) + n <= last
