"""Words and their hashes, straight from the buffers of Arrow string columns.

A batch of texts is one byte buffer plus offsets. All functions work on the whole buffer with
numpy, so their cost per byte does not depend on how texts are cut into rows, and a text of
many megabytes is handled like any other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that part words: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Bytes that part terms: all of ASCII but digits and letters.
MARKS = np.zeros(256, dtype=bool)
MARKS[[*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection of 64-bit words with no visible structure."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """The first ``n`` words of a pseudo-random sequence."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * GOLDEN + np.uint64(seed))


BYTE_KEYS = stream(256, 11)
BYTE_KEYS[SPACE] = 0


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and their ``n + 1`` offsets; null is an empty text."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches, column: str | int, limit: int = 2 << 20):
    """Cut record batches so that the texts of each piece have at most ``limit`` bytes, or are one
    row. It bounds the memory that numpy needs beside a text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
        total = np.cumsum(sizes)
        begin = 0
        while begin < batch.num_rows:
            done = total[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(total, done + limit, side="right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


class Words:
    """All words of a batch: ``start`` and ``end`` bytes, the ``row`` each is in, and ``first``,
    the number of the first word of each row (``n + 1`` entries). ``gaps`` marks the bytes that
    part them, ``SPACE`` among them."""

    def __init__(self, column: pa.Array, gaps: np.ndarray = SPACE):
        self.data, self.offsets = buffer_of(column)
        self.gaps = gaps
        solid = ~gaps[self.data]
        edge = np.empty(len(solid) + 1, dtype=bool)
        edge[:-1] = solid
        edge[-1] = False
        edge[1:] &= ~solid  # a word ended just before
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        ends = np.zeros(len(solid) + 1, dtype=bool)
        ends[1:] = solid
        ends[:-1] &= ~solid
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(solid))]
        if len(cuts):  # texts that touch are parted as well
            begins[cuts] |= solid[cuts]
            ends[cuts] |= solid[cuts - 1]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, self.offsets)
        self.counts = np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word: byte keys times position keys, summed, then mixed with
        the length. ``lower`` folds A-Z."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        keys = np.where(self.gaps, np.uint64(0), BYTE_KEYS)
        keys = keys[LOWER] if lower else keys
        length = self.end - self.start
        places = stream(int(length.max()), 29) | np.uint64(1)
        out = np.empty(len(self.start), dtype=np.uint64)
        block, begin = 1 << 16, 0  # words at a time, to bound the temporary arrays
        with np.errstate(over="ignore"):
            while begin < len(self.start):
                stop = int(np.searchsorted(self.start, self.start[begin] + (block << 2)))
                stop = max(begin + 1, min(stop, begin + block))
                lo, hi = int(self.start[begin]), int(self.end[stop - 1])
                own, size = self.start[begin:stop] - lo, length[begin:stop]
                inside = np.arange(hi - lo, dtype=np.int64)
                gaps = np.diff(own, append=hi - lo)
                inside -= np.repeat(own, gaps)
                value = keys[self.data[lo:hi]] * places[np.minimum(inside, len(places) - 1)]
                out[begin:stop] = np.add.reduceat(value, own) + size.astype(np.uint64) * GOLDEN
                begin = stop
            return mix(out)


def rolling(symbols: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` neighbours; entry ``i`` is the run that starts at ``i``."""
    size = len(symbols) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint64)
    keys = stream(n, 101 + seed) | np.uint64(1)
    with np.errstate(over="ignore"):
        total = symbols[:size] * keys[0]
        for k in range(1, n):
            total += mix_light(symbols[k : k + size]) * keys[k] if k % 2 else symbols[k : k + size] * keys[k]
        return mix(total)


def mix_light(x: np.ndarray) -> np.ndarray:
    return x ^ (x >> np.uint64(29))


def pack(values: np.ndarray, sort: bool = False) -> bytes:
    """Integers as compressed byte planes; ``sort``: ascending ones, by their differences."""
    if sort:
        values = np.diff(values, prepend=values[:1] * 0)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T)
    return pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpack(blob: bytes, n: int, kind, sort: bool = False) -> np.ndarray:
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * width, "zstd", asbytes=True), np.uint8)
    values = np.ascontiguousarray(planes.reshape(width, n).T).view(kind).reshape(n)
    return np.cumsum(values, dtype=kind) if sort else values
