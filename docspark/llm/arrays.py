"""Texts of Arrow batches as numpy arrays: bounded slices, words, hashes."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext

#: Bytes of text that are worked on at once; one longer text is worked on alone.
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values: the finalizer of the splitmix64 generator."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


_BYTE = stream(1, 256)
_STEP = np.uint64(0x2545F4914F6CDD1D)


def _store() -> dict:
    """What a Python worker keeps. Functions reach the workers by value, so a module's own globals end with the task."""
    return sys.modules.setdefault("docspark_kept", types.ModuleType("docspark_kept")).__dict__


def _task() -> int | None:
    context = TaskContext.get()
    return context.taskAttemptId() if context else None


def kept(name: str, make: Callable[[], Any], large: bool = False) -> Any:
    """A value made once per Python worker, not once per task. A large one stays until the worker's first task without it."""
    store = _store()
    if name not in store:
        store[name] = make()
    if large:
        store.setdefault("_large", {})[name] = _task()
    return store[name]


def give_back() -> None:
    """Let go of large values that this task has not asked for, and of freed memory: a worker lives on from stage to stage."""
    store, task = _store(), _task()
    for name in [n for n, t in store.get("_large", {}).items() if t != task]:
        store.pop(name, None)
        del store["_large"][name]
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def remembered(f: Callable) -> Callable:
    """``f`` with its results kept per Python worker."""
    def g(*key):
        memo = kept(f"results of {f.__module__}.{f.__name__}", dict)
        if key not in memo:
            memo[key] = f(*key)
        return memo[key]

    return g


class Memo:
    """A dict of bounded size: two generations, the older one is dropped when the younger is full."""

    def __init__(self, size: int) -> None:
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys) -> list:
        """The keys without a value; those of the older generation move to the younger one."""
        if len(self.young) > self.size:
            self.old, self.young = self.young, {}
        young, old, out = self.young, self.old, []
        for k in [k for k in keys if k not in young]:
            v = old.get(k)
            if v is None:
                out.append(k)
            else:
                young[k] = v
        return out


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in order, in pieces of at most ``limit`` bytes of text or one row."""
    give_back()
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes)
        at = 0
        while at < len(sizes):
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def larger(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at least ``rows`` rows (the last may be short)."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each begins (and the last ends); null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def run_hashes(letters: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of bytes that begin at ``begins``; the last one ends with the bytes."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    length = np.diff(np.append(begins, len(letters)))
    within = np.arange(len(letters)) - np.repeat(begins, length)
    power = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(int(length.max()) - 1, 0), _STEP))])
    sums = np.add.reduceat(_BYTE[letters] * power[within], begins)
    return mix(sums + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def run_starts(inside: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where runs of ``inside`` begin; none runs from one text into the next."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[offsets < len(inside)]
    first[at] = inside[at]
    return first


def word_hashes(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+``, with A-Z in lower case if ``lower``, and where each text's words begin."""
    data, offsets = buffers(column)
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    first = run_starts(solid, offsets)
    bounds = np.searchsorted(np.flatnonzero(first), offsets)
    letters = data[solid]
    return run_hashes(_LOWER[letters] if lower else letters, np.flatnonzero(first[solid])), bounds


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words; fewer words make one shingle, no words none."""
    n = len(words)
    if not n:
        return words
    size = min(size, n)
    salt = stream(7 + size, size)
    total = np.zeros(n - size + 1, np.uint64)
    for k in range(size):
        total += mix(words[k : n - size + 1 + k] ^ salt[k])
    return np.unique(mix(total))
