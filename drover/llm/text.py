"""Vectorised work on whole texts inside Arrow tasks: bytes, words, hashes.

Texts are handled as UTF-8 bytes. A word is `[^\\x20\\x09-\\x0D]+` after A-Z are
lower-cased. Words and word sequences are compared by 64-bit hashes.
"""

from __future__ import annotations

import ctypes
import functools
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_RANDOM = np.random.default_rng(20240229)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_tables: dict[int, np.ndarray] = {}


def release() -> None:
    """Give free memory back to the system; the Python worker lives on and its next task may need little."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(function: Callable) -> Callable:
    """A task or group function that releases its memory when it is done."""
    if inspect.isgeneratorfunction(function):

        @functools.wraps(function)
        def stream(batches):
            try:
                yield from function(batches)
            finally:
                release()

        return stream

    def whole(*tables):
        try:
            return function(*tables)
        finally:
            release()

    # Spark counts the parameters, so they are spelled out.
    if len(inspect.signature(function).parameters) == 1:
        return functools.wraps(function)(lambda table: whole(table))
    return functools.wraps(function)(lambda left, right: whole(left, right))


def _powers(base: np.uint64, length: int) -> np.ndarray:
    """base ** 0 .. base ** (length - 1) modulo 2 ** 64; kept for the next call."""
    table = _tables.get(int(base))
    if table is None or len(table) < length:
        table = np.full(max(length, 1 << 16), base, dtype=np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        if length <= 1 << 23:
            _tables[int(base)] = table
    return table[:length]


def mix(values: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit of a 64-bit value over all bits."""
    z = values.astype(np.uint64)
    z ^= z >> np.uint64(30)
    z *= np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(27)
    z *= np.uint64(0x94D049BB133111EB)
    z ^= z >> np.uint64(31)
    return z


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column, and where each text begins (one more entry: the end)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def lots(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about `limit` bytes: first row, end row, bytes, offsets."""
    data, offsets = utf8(column)
    at, rows = 0, len(offsets) - 1
    while at < rows:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), rows)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Prefix:
    """Hash of any byte range in constant time, from running sums modulo 2 ** 64."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=self.sums[1:])
        self.inverse = _powers(_INVERSE, len(data) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.inverse[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * _BASE)


class Words:
    """Words of several texts: `start` and `end` in the bytes, `text` index and `hash` of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = LOWER[data]
        inside = ~SPACE[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        # A text ends where the next one begins, with or without white space between.
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        begins[filled] = inside[filled]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        ends[last] = inside[last]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.data = data
        self.hash = Prefix(data).of(self.start, self.end)
        self.counts = np.bincount(self.text, minlength=len(offsets) - 1)


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins."""
    if not len(sorted_keys):
        return np.zeros(0, dtype=np.int64)
    return np.flatnonzero(np.concatenate([[True], sorted_keys[1:] != sorted_keys[:-1]]))


def shingles(words: Words, texts: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of `size` words of each text: text index and hash, sorted by both.

    A text with fewer words has its whole word sequence as its one shingle.
    """
    count = len(words.hash)
    parts, owners = [], []
    if count >= size:
        total = np.zeros(count - size + 1, dtype=np.uint64)
        for k in range(size):
            total = (total + words.hash[k : count - size + 1 + k]) * _BASE
        same = words.text[size - 1 :] == words.text[: count - size + 1]
        parts.append(mix(total[same]))
        owners.append(words.text[: count - size + 1][same])
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    if len(short):
        first = np.concatenate([[0], np.cumsum(words.counts)])[short]
        total = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = words.counts[short] > k
            step = (total + words.hash[np.minimum(first + k, count - 1)]) * _BASE
            total = np.where(has, step, total)
        parts.append(mix(total ^ words.counts[short].astype(np.uint64)))
        owners.append(short)
    if not parts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    owner, value = np.concatenate(owners), np.concatenate(parts)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return owner[keep], value[keep]
