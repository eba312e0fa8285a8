"""Words, lines and their 64-bit hashes for whole Arrow batches of texts, by numpy.

A text is cut at the bytes 0x20 and 0x09-0x0D. Hashes are polynomial over mixed bytes and
computed for any byte range from one running sum, so nothing loops over words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
WORD_BASE = np.uint64(0xD1B54A32D192ED03 | 1)
# Bytes of text handled at once; a longer text is handled alone.
SLICE_BYTES = 1 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place on a copy."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd number and of its inverse, modulo 2^64, grown on demand."""

    def __init__(self, base: np.uint64):
        inverse = pow(int(base), -1, 1 << 64)
        self.base, self.inverse = base, np.uint64(inverse)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up, self.down


_bytes, _words = Powers(BASE), Powers(WORD_BASE)


def running(codes: np.ndarray, powers: Powers) -> np.ndarray:
    up, _ = powers.upto(len(codes) + 1)
    sums = np.empty(len(codes) + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum(codes * up[: len(codes)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    _, down = powers.upto(len(sums))
    lengths = (end - start).astype(np.uint64)
    return mix((sums[end] - sums[start]) * down[start] + lengths * np.uint64(0xA24BAED4963EE407))


class Texts:
    """A slice of texts as one byte array; ``bounds`` has the start of each text and the end."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        self.bounds = bounds
        self._sums: np.ndarray | None = None

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def sums(self) -> np.ndarray:
        if self._sums is None:
            self._sums = running(BYTE_CODES[self.data], _bytes)
        return self._sums

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return range_hash(self.sums, start, end, _bytes)

    def spans(self, cut: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes outside ``cut`` (a 256-entry mask), none across texts.

        Returns starts, ends and ``first``: the index of each text's first run, and the end.
        """
        inside = ~cut[self.data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        inner = self.bounds[:-1][self.bounds[:-1] < len(inside)]
        before[inner] = False
        starts = np.flatnonzero(inside & ~before)
        # A run ends where the next byte is cut or opens another text.
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[inner[inner > 0] - 1] = False
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.spans(SPACE)


def owners(first: np.ndarray) -> np.ndarray:
    """The text of each run."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def windows(first: np.ndarray, size: int) -> np.ndarray:
    """Indexes of the runs at which a window of ``size`` runs of one text starts."""
    last = np.repeat(first[1:], np.diff(first))
    at = np.arange(len(last))
    return at[at + size <= last]


class Sequences:
    """Hashes of windows over a sequence of word hashes."""

    def __init__(self, hashes: np.ndarray):
        self.sums = running(hashes, _words)

    def hashes(self, start: np.ndarray, size) -> np.ndarray:
        return range_hash(self.sums, start, start + size, _words)


def slices(column: pa.Array, lower: bool = False, most: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """Cut a string column into (first row, Texts); null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    n = len(column)
    if n == 0:
        return
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1
        stop = min(max(stop, row + 1), n)
        bounds = offsets[row : stop + 1]
        yield row, Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0], lower)
        row = stop


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
