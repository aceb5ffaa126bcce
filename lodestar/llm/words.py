"""Vectorised words, hashes and n-grams over Arrow text columns.

A word is a maximal run of bytes other than ``\\x20`` and ``\\x09-\\x0D``.  All
helpers work on a bounded slice of rows (``slices``), so a task holds a few MB of
text at a time whatever the size of its partition; a single text is never cut.
Word and n-gram identities are 64-bit hashes.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
_WORKER = "_lodestar_worker_cache"


def worker_cache() -> dict:
    """A dictionary that lives as long as this Python worker, whatever tasks it runs."""
    return sys.modules.setdefault(_WORKER, types.ModuleType(_WORKER)).__dict__


def drop_worker_cache() -> None:
    """Let go what another operator's tasks kept in this Python worker: workers outlive
    jobs, and a task of another operator needs the memory."""
    sys.modules.pop(_WORKER, None)


SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], dtype=np.uint64)
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xBF58476D1CE4E5B9)
_C = np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def texts(column) -> pa.Array:
    """A text column as one Arrow array without nulls (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    return pc.fill_null(column, "")


def release_memory() -> None:
    """Give freed memory back: Arrow's pool and the C library keep what a slice's
    arrays took, and a Python worker outlives its tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc has it
    if trim is not None:
        trim(0)


def slices(batches, text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into runs of rows with at most ``limit`` bytes of text
    (a longer text is a run of its own); freed memory is given back after each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts(batch.column(text))), 0), dtype=np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(at, to - at)
            release_memory()
            at = to


def buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text array; offsets start at 0."""
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(array.type) else np.int32
    _, offsets, data = array.buffers()
    off = np.frombuffer(offsets, dtype=kind)[array.offset:array.offset + len(array) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


@dataclass
class Words:
    """Words of a run of texts: ``start``/``end`` are byte positions in ``raw``,
    ``first[i]:first[i+1]`` are the words of text ``i``."""

    raw: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        return hash_spans(self.raw, self.start, self.end)


def find_words(array: pa.Array, lower: bool = False) -> Words:
    raw, off = buffers(array)
    if lower:
        raw = LOWER[raw]
    solid = ~SPACE[raw]
    n = len(raw)
    before = np.zeros(n, dtype=bool)
    before[1:] = solid[:-1]
    cuts = off[1:-1]
    cuts = cuts[cuts < n]
    before[cuts] = False
    start = np.flatnonzero(solid & ~before)
    after = np.zeros(n, dtype=bool)
    after[:-1] = solid[1:]
    cuts = off[1:-1]
    after[cuts[cuts > 0] - 1] = False
    end = np.flatnonzero(solid & ~after) + 1
    return Words(raw, off, start, end, np.searchsorted(start, off))


def hash_spans(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span, eight bytes a step."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    size = end - start
    h = size.astype(np.uint64) * _A
    if not len(size):
        return h
    h = mix(h ^ (lanes[start] & _KEEP[np.minimum(size, 8)]) * _C)
    live = np.flatnonzero(size > 8)
    k = 8
    while len(live):
        at, left = start[live] + k, size[live] - k
        h[live] = mix((h[live] + _A) ^ (lanes[at] & _KEEP[np.minimum(left, 8)]) * _C)
        k += 8
        live = live[left > 8]
    return h


def same_bytes(raw: np.ndarray, start: np.ndarray, store: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Are the bytes of each span of ``raw`` those of ``store`` from ``at``?  Eight bytes
    a step; ``store`` has eight more bytes than its last span."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    a = np.ndarray((len(raw) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    b = np.ndarray((len(store) - 7,), dtype="<u8", buffer=store, strides=(1,))
    same = ((a[start] ^ b[at]) & _KEEP[np.minimum(size, 8)]) == 0
    live = np.flatnonzero(same & (size > 8))
    k = 8
    while len(live):
        left = size[live] - k
        same[live] = ((a[start[live] + k] ^ b[np.minimum(at[live] + k, len(b) - 1)]) & _KEEP[np.minimum(left, 8)]) == 0
        k += 8
        live = live[same[live] & (left > 8)]
    return same


def powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    x = 1
    for i in range(n):
        out[i] = x
        x = x * 0xD6E8FEB86659FD93 % 2**64
    return out


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` word hashes from each position (``len(h) - n + 1`` of them);
    windows that run over the end of a text are the caller's to drop."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    p = powers(n)
    out = h[: len(h) - n + 1] * p[0]
    for i in range(1, n):
        out += h[i: len(h) - n + 1 + i] * p[i]
    return mix(out)


def window_ok(first: np.ndarray, n: int) -> np.ndarray:
    """For each word position: does an ``n``-word window from it stay in its text?"""
    total = int(first[-1])
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return left >= n


def cover(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Positions covered by windows of ``n`` from ``starts``."""
    d = np.bincount(starts, minlength=total + 1) - np.bincount(np.minimum(starts + n, total), minlength=total + 1)
    return np.cumsum(d[:total]) > 0


def per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over each text's range."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


def dictionary(raw: np.ndarray, keep: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """(distinct strings, index of each) of the consecutive runs of kept bytes with
    the given sizes."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    made = pa.StringArray.from_buffers(len(sizes), pa.py_buffer(ends), pa.py_buffer(raw[keep])).dictionary_encode()
    return made.dictionary.to_pylist(), made.indices.to_numpy()
