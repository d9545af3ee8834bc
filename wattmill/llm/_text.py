"""Words, windows and their hashes, on byte arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .bpe import mix, slice_hashes, spread, text_batches

__all__ = ["mix", "slice_hashes", "spread", "text_batches", "table_batches", "words", "windows", "distinct", "lower"]

_U = np.uint64
#: The bytes between words.
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTORS = np.random.default_rng(20240101).integers(0, 1 << 63, 4096, dtype=np.int64).astype(_U) * _U(2) + _U(1)


def table_batches(table: pa.Table, column: str, limit: int = 1 << 20):
    """(first row, end row, bytes, offsets) over a table's binary column."""
    base = 0
    for batch in table.select([column]).combine_chunks().to_batches():
        for i, j, buf, offsets in text_batches(batch, 0, limit):
            yield base + i, base + j, buf, offsets
        base += batch.num_rows


def lower(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z; all other bytes stay."""
    return _LOWER[buf]


def words(buf: np.ndarray, offsets: np.ndarray, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end of every word, number of words before each text and in all); `blank` marks the bytes between words."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    full = ~blank[buf]
    cut = np.zeros(len(buf) + 1, bool)
    cut[offsets] = True
    start = full.copy()
    start[1:] &= ~full[:-1] | cut[1:-1]
    end = full.copy()
    end[:-1] &= ~full[1:] | cut[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def windows(hashes: np.ndarray, size: int, at: np.ndarray | None = None) -> np.ndarray:
    """A hash of each run of `size` items, by the item it starts at, or of those that start `at` places; runs across texts are included."""
    if size > len(_FACTORS):
        raise ValueError(f"a run has at most {len(_FACTORS)} items")
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, _U)
    if at is not None and len(at) > n // 4:
        return windows(hashes, size)[at]
    part = (lambda j: hashes[j : j + n]) if at is None else (lambda j: hashes[at + j])
    out = part(0) * _FACTORS[0]
    for j in range(1, size):
        out += part(j) * _FACTORS[j]
    return mix(out)


def distinct(keys: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an order in which equal rows of the columns are neighbours, where in it a new one begins)."""
    order = np.lexsort((*more[::-1], keys)) if more else np.argsort(keys)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = keys[order][1:] != keys[order][:-1]
        for c in more:
            new[1:] |= c[order][1:] != c[order][:-1]
    return order, new
