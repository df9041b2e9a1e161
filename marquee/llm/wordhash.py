"""Words and word windows of many texts at once, as numpy arrays over the bytes of an Arrow column.

All functions run inside Spark tasks. A word is a run of bytes of one class, which equals a run of characters,
since every byte of a character outside ASCII is 0x80 or more. Hashes are polynomials over 64 bits with a final mix.
They are the same in every task.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 20  # bytes hashed in one step, which bounds memory for texts of any length
STEP = 1 << 12

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Everything but blank and the controls 9 to 13.
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[32, 9, 10, 11, 12, 13]] = False

#: ASCII digits and letters, and everything outside ASCII.
ALPHANUMERIC = np.zeros(256, dtype=bool)
ALPHANUMERIC[48:58] = ALPHANUMERIC[65:91] = ALPHANUMERIC[97:123] = ALPHANUMERIC[128:] = True

_BYTE = np.random.default_rng(20_240_229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Words(NamedTuple):
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray
    first: np.ndarray  # for each text the number of words before it, and the total at the end

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and the last ends. NULL is empty."""
    if pa.types.is_null(column.type):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def shards(batch: pa.RecordBatch, text: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of about `most` bytes of text; a longer text is a slice of its own."""
    _, offsets = text_bytes(batch.column(batch.schema.get_field_index(text)))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def find_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> Words:
    inside = kind[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    after[cuts[cuts > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of 64 bits under which near numbers become unrelated ones."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base, modulo 2^64, from two short tables."""

    def __init__(self, base: int):
        self.base = base % 2**64
        self.fine = np.array([pow(self.base, i, 2**64) for i in range(STEP)], np.uint64)
        self.coarse = np.ones(1, np.uint64)

    def _reach(self, n: int) -> None:
        while len(self.coarse) * STEP <= n:
            more = 2 * len(self.coarse)
            self.coarse = np.array([pow(self.base, i * STEP, 2**64) for i in range(more)], np.uint64)

    def upto(self, n: int) -> np.ndarray:
        self._reach(n)
        return np.multiply.outer(self.coarse[: n // STEP + 1], self.fine).ravel()[:n]

    def at(self, places: np.ndarray) -> np.ndarray:
        if len(places):
            self._reach(int(places.max()))
        return self.fine[places & (STEP - 1)] * self.coarse[places >> 12]


class Rolling:
    """Hashes of stretches of a sequence from one running sum."""

    def __init__(self, base: int):
        self.up, self.down = Powers(base), Powers(pow(base, -1, 2**64))

    def sums(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up.upto(len(values)), out=out[1:])
        return out

    def between(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.down.at(starts) + (ends - starts).astype(np.uint64))


_LETTERS, _WINDOWS, _WINDOWS_2 = Rolling(0x9E3779B97F4A7C15), Rolling(0xD6E8FEB86659FD93), Rolling(0xA0761D6478BD642F)


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    out = np.empty(len(words.starts), np.uint64)
    at = 0
    while at < len(out):
        low = words.starts[at]
        to = max(at + 1, int(np.searchsorted(words.ends, low + SEGMENT, "right")))
        sums = _LETTERS.sums(_BYTE[data[low : words.ends[to - 1]]])
        out[at:to] = _LETTERS.between(sums, words.starts[at:to] - low, words.ends[at:to] - low)
        at = to
    return out


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int, second: bool = False) -> np.ndarray:
    """Hashes of the windows of `size` words that begin at the given words."""
    rolling = _WINDOWS_2 if second else _WINDOWS
    return rolling.between(rolling.sums(hashes), starts, starts + size)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """The words at which a window of `size` words of one text begins."""
    counts = np.diff(first)
    fits = np.maximum(counts - size + 1, 0)
    skipped = np.repeat(first[:-1] - (np.cumsum(fits) - fits), fits)
    return np.arange(int(fits.sum())) + skipped


def covered(starts: np.ndarray, ends: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0
