"""Worker-side text helpers: Arrow batches as flat numpy byte arrays.

A slice of documents is one UTF-8 buffer plus document offsets; words,
hashes and shingles of the whole slice are computed together.
"""

from __future__ import annotations

import sys
import types
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once in a worker (a longer single text is one slice).
SLICE_BYTES = 1 << 20


def worker_store() -> dict:
    """A dictionary that lives as long as the (reused) Python worker."""
    return sys.modules.setdefault("_quarry_llm_store", types.ModuleType("_quarry_llm_store")).__dict__


def bounded_cache(name: str, limit: int) -> dict:
    """A memo that is emptied when full: it affects speed, never results."""
    cache = worker_store().setdefault(name, {})
    if len(cache) > limit:
        cache.clear()
    return cache


def memo(f):
    """Remember results by arguments in a bounded cache of the worker
    (``functools`` caches are pickled by name, which a worker may not know)."""
    def known(*args):
        cache = bounded_cache(f"memo_{f.__name__}", 50_000)
        if args not in cache:
            cache[args] = f(*args)
        return cache[args]

    known.__doc__ = f.__doc__
    return known


def as_utf8(col) -> pa.Array:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return col if pa.types.is_string(col.type) else col.cast(pa.string())


def offsets_of(col: pa.Array) -> np.ndarray:
    if len(col) == 0:
        return np.zeros(1, np.int64)
    return np.frombuffer(col.buffers()[1], np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)


def slices(batches: Iterator[pa.RecordBatch], text: str, budget: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in slices of at most ``budget`` bytes of text (or one row)."""
    for b in batches:
        off = offsets_of(as_utf8(b.column(text)))
        at = 0
        while at < b.num_rows:
            to = int(np.searchsorted(off, off[at] + budget, side="right")) - 1
            to = min(max(to, at + 1), b.num_rows)
            yield b.slice(at, to - at)
            at = to


def flat_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    col = as_utf8(col)
    if col.null_count:
        col = col.fill_null("")
    off = offsets_of(col)
    if off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def space_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


IS_SPACE, TO_LOWER = space_table(), lower_table()


def word_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+`` of every text,
    and for each text the number of its first word."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    solid = ~IS_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = off[(off > 0) & (off < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


_BASE = 0x9E3779B97F4A7C15
_M64 = (1 << 64) - 1


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    store = worker_store()
    have = store.get("powers")
    if have is None or len(have[0]) < n + 1:
        size = max(n + 1, SLICE_BYTES + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = np.multiply.accumulate(up), np.multiply.accumulate(down)
        if n <= SLICE_BYTES:
            store["powers"] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (every bit of the input reaches every bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``data`` (polynomial prefix sums)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, off: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the slice, and each text's first word number."""
    if lower and len(data):
        data = TO_LOWER[data]
    starts, ends, first = word_spans(data, off)
    return span_hashes(data, starts, ends), first


def shingle_sets(words: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes (uint64) of each text: windows of
    ``width`` words; a shorter text is one shingle, no words none."""
    n = len(words)
    factors = [pow(_BASE, 2 * j + 3, 1 << 64) for j in range(width)]
    windows = np.zeros(max(n - width + 1, 0), np.uint64)
    for j in range(width):
        windows += words[j:j + len(windows)] * np.uint64(factors[j])
    windows = mix(windows)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(windows[a:b - width + 1]))
        elif b > a:
            whole = sum(int(w) * f for w, f in zip(words[a:b].tolist(), factors)) + (b - a) & _M64
            out.append(mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)
