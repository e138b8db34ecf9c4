"""Array kernels over Arrow text columns, shared by the operators that run
Python inside tasks.

Words are maximal runs of bytes other than 0x20 and 0x09-0x0D of the UTF-8
text; a null text counts as empty. All hashes are seedless 64-bit values, so
every executor, and every rerun after a lost one, computes the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Odd multipliers of the polynomial word hash and of the mixers (arbitrary, fixed).
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX_A, MIX_B = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)
#: Text bytes handled at once; longer single texts are handled alone.
SLICE_BYTES = 4 << 20
#: Rows handled at once: many tiny texts must not make wide arrays.
SLICE_ROWS = 4096

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash; one to one."""
    x = x ^ (x >> U64(30))
    x = x * MIX_A
    x = x ^ (x >> U64(27))
    x = x * MIX_B
    return x ^ (x >> U64(31))


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column, nulls as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after the last one the worker gives Arrow's free memory
    back: it stays with its executor, idle, while later steps run."""
    yield from batches
    pa.default_memory_pool().release_unused()


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of at most ``SLICE_ROWS`` rows holding about ``limit`` text bytes."""
    for batch in freed(batches):
        if not batch.num_rows:
            continue
        _, offsets = text_buffer(batch.column(batch.schema.get_field_index(text)))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), start + SLICE_ROWS, batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop


class Words:
    """Words of a run of texts: ``start``/``end`` byte positions, ``hash``, and
    ``first``, the index of each text's first word (one more entry at the end)."""

    def __init__(self, column: pa.Array, lower: bool = False):
        raw, offsets = text_buffer(column)
        self.raw, self.offsets = (LOWER[raw] if lower else raw), offsets
        n = len(raw)
        inside = np.zeros(n + 1, bool)
        np.logical_not(SPACE[raw], out=inside[:n])
        begins = inside[:n].copy()
        begins[1:] &= ~inside[:n - 1]
        heads = offsets[:-1][offsets[:-1] < n]
        begins[heads] = inside[heads]
        ends = inside[:n] & ~inside[1:]
        tails = offsets[1:][offsets[1:] > 0] - 1
        ends[tails] = inside[tails]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._hash = None

    @property
    def count(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.first)

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            n = len(self.raw)
            power = np.full(n + 1, U64(BASE))
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            total = np.zeros(n + 1, U64)
            np.cumsum((self.raw.astype(U64) + U64(1)) * power[:n], out=total[1:])
            back = np.full(n + 1, U64(BASE_INVERSE))
            back[0] = 1
            np.multiply.accumulate(back, out=back)
            spans = (total[self.end] - total[self.start]) * back[self.start]
            self._hash = mix(spans + (self.end - self.start).astype(U64) * MIX_A)
        return self._hash

    def windows(self, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """(hash, valid) of the window of ``size`` words starting at each word;
        valid: the window ends inside its text."""
        h, n = self.hash, len(self.start)
        if n < size:
            return np.zeros(n, U64), np.zeros(n, bool)
        out = np.full(n - size + 1, U64((seed * 0x632BE59BD9B4E019 + size) & (2**64 - 1)))
        for k in range(size):
            out = out * U64(BASE) + h[k:n - size + 1 + k]
            out ^= out >> U64(32)
        left = np.repeat(self.first[1:], self.count) - np.arange(n)
        return np.concatenate([mix(out), np.zeros(size - 1, U64)]), left >= size


def per_text_unique(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each segment ``values[bounds[i]:bounds[i+1]]``, and the new bounds."""
    parts = [np.unique(values[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    return (np.concatenate(parts) if parts else values[:0]), np.concatenate([[0], np.cumsum(sizes)])
