"""Small helpers that turn Arrow text columns into numpy arrays of bytes and words, inside tasks."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_POWERS = [np.ones(1, U64), np.ones(1, U64)]


def give_back() -> None:
    """Freed memory goes back to the system: a worker that waits for its next task would keep it otherwise."""
    for k, known in enumerate(_POWERS):
        _POWERS[k] = known[: 1 << 12].copy() if len(known) > 1 << 12 else known
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def task(run: Callable) -> Callable:
    """``run`` of mapInArrow, which gives memory back at its end."""

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return own


def group(run: Callable) -> Callable:
    """``run`` of a group of applyInArrow, which gives memory back at its end."""

    def own(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return own


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n at least; grown by doubling and kept."""
    for k, base in enumerate((_BASE, _INV)):
        while len(_POWERS[k]) < n:
            m = len(_POWERS[k])
            _POWERS[k] = np.concatenate([_POWERS[k], _POWERS[k] * U64(pow(base, m, 1 << 64))])
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: spreads polynomial hashes over all bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def pieces(batch: pa.RecordBatch, column: str, limit: int = 1 << 20, rows: int = 1 << 30) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, row offsets) of runs of rows of about ``limit`` bytes of UTF-8, ``rows`` at most.

    A null is an empty text. A row is never cut, so a piece is at most ``limit`` plus one row.
    """
    col = batch.column(batch.schema.get_field_index(column))
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type)
    _, off, data = col.buffers()
    n = len(col)
    if n == 0:
        return
    offs = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset : col.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1)
        hi = min(hi, n, lo + rows)
        yield lo, hi, raw[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def table(chars: bytes | str, high: bool) -> np.ndarray:
    """A 256-entry mask: True for these ASCII bytes, ``high`` for bytes from 0x80."""
    out = np.zeros(256, bool)
    out[list(chars.encode() if isinstance(chars, str) else chars)] = True
    out[128:] = high
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased, and of [^\x20\x09-\x0D]+.
ALNUM = table("0123456789abcdefghijklmnopqrstuvwxyz", True)
NONSPACE = ~table(bytes([32, 9, 10, 11, 12, 13]), False)


def words(data: np.ndarray, offs: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, word offsets of each row) of the maximal runs of ``mask`` bytes; none crosses a row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    m = mask[data]
    first, last = m.copy(), m.copy()
    first[1:] &= ~m[:-1]
    last[:-1] &= ~m[1:]
    cut = offs[(offs > 0) & (offs < n)]
    first[cut] = m[cut]
    last[cut - 1] = m[cut - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offs)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span; equal bytes give equal hashes wherever they stand."""
    up, down = powers(len(data) + 1)
    acc = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * up[: len(data)], out=acc[1:])
    return mix((acc[ends] - acc[starts]) * down[starts] + (ends - starts).astype(U64))


def gram_hash(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position; shorter than ``word`` by k - 1."""
    n = len(word) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for j in range(k):
        out = out * U64(_BASE) + word[j : j + n]
    return mix(out)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each (start, count), end to end."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(counts)
    return np.arange(total) - np.repeat(ends - counts - starts, counts)


def sliding(x: np.ndarray, run: int, op) -> np.ndarray:
    """Sliding ``op`` (minimum or maximum) over ``run`` values; by doubling."""
    width = 1
    while width * 2 <= run:
        x = op(x[:-width], x[width:])
        width *= 2
    return op(x[: len(x) - (run - width)], x[run - width :]) if run > width else x
