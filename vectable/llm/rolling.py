"""Words and n-grams of many texts at once, on the flat bytes of an Arrow text column.

A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; UTF-8 never uses these bytes
inside a character, so words of bytes are words of characters. Hashes are 64-bit: the
hash of any span is a difference of prefix sums of ``byte * P**position`` (modulo 2**64,
``P`` odd, so positions can be divided out), finalised by a mixer. No step loops over
words or characters in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vectable.llm.worker import kept_by_worker

P = 0x9E3779B97F4A7C15 | 1
P_INVERSE = pow(P, -1, 1 << 64)
SLICE_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser, so that close inputs give unrelated hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """What ``mix`` makes ``x`` of."""
    x = x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))
    x = x * np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
    x = x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))
    x = x * np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
    return x ^ (x >> np.uint64(30)) ^ (x >> np.uint64(60))


def _power_table(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _powers(base: int, n: int) -> np.ndarray:
    if n > SLICE_BYTES + 1:
        return _power_table(base, n)
    return kept_by_worker(("powers", base), lambda: _power_table(base, SLICE_BYTES + 1))[:n]


class Texts:
    """A slice of a text column: its bytes, and where each text begins and ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first_row: int) -> None:
        self.data = data
        self.offsets = offsets
        self.first_row = first_row

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower_ascii(self) -> Texts:
        """A-Z as a-z, all else unchanged."""
        capital = (self.data - np.uint8(65)) < 26
        return Texts(self.data + capital.astype(np.uint8) * np.uint8(32), self.offsets, self.first_row)

    def prefix_hashes(self) -> np.ndarray:
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum(self.data * _powers(P, len(self.data)), out=sums[1:])
        return sums

    def inverse_powers(self) -> np.ndarray:
        """What takes the position out of a difference of prefix hashes."""
        return _powers(P_INVERSE, len(self.data) + 1)

    def words(self, apart: np.ndarray | None = None) -> Words:
        """``apart``: marks bytes that begin a new word although no blank stands before them."""
        data, offsets = self.data, self.offsets
        inside = ~((data == 32) | ((data - np.uint8(9)) < 5))
        joined = np.zeros(len(data) + 1, bool)  # byte i continues the word of byte i - 1
        joined[1:-1] = inside[1:] & inside[:-1]
        joined[offsets] = False
        if apart is not None:
            joined[:-1] &= ~apart
        starts = np.flatnonzero(inside & ~joined[:-1])
        ends = np.flatnonzero(inside & ~joined[1:]) + 1
        bounds = np.searchsorted(starts, offsets)
        return Words(self, starts, ends, bounds)


class Words:
    """Word spans of a slice; words ``bounds[i]:bounds[i + 1]`` belong to text ``i``."""

    def __init__(self, texts: Texts, starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray) -> None:
        self.texts = texts
        self.starts = starts
        self.ends = ends
        self.bounds = bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.texts)), self.counts)

    def hashes(self) -> np.ndarray:
        sums = self.texts.prefix_hashes()
        raw = (sums[self.ends] - sums[self.starts]) * self.texts.inverse_powers()[self.starts]
        return mix(raw + (self.ends - self.starts).astype(np.uint64))


MULTIPLIERS = tuple((0xD6E8FEB86659FD93 * (2 * k + 1) | 1) & (1 << 64) - 1 for k in range(16))


def combine(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of every window of ``size`` consecutive words, by the window's first word."""
    n = max(len(hashes) - size + 1, 0)
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += mix(hashes[k : k + n] + np.uint64(MULTIPLIERS[k])) * np.uint64(MULTIPLIERS[k])
    return mix(total)


def slices(
    column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES, rows: int | None = None
) -> Iterator[Texts]:
    """The column in runs of whole texts of about ``limit`` bytes; a longer text stands alone. Null: empty.

    A run has ``rows`` texts at most, for callers whose memory grows with the texts, however short.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.cast(pa.large_string()).combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    if len(column) == 0:
        return
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1, row + 1)
        end = min(end, len(column), row + (rows or len(column)))
        yield Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], row)
        row = end


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's windows of ``size`` words.

    A text with fewer words gives its whole word sequence as one; a text without words
    gives an empty array.
    """
    words = texts.lower_ascii().words()
    hashes = words.hashes()
    windows = combine(hashes, size)
    sets = []
    for low, high in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist(), strict=True):
        if high - low >= size:
            sets.append(np.unique(windows[low : high - size + 1]))
        elif high > low:
            sets.append(combine(hashes[low:high], high - low))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets
