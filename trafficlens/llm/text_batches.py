"""Arrow text batches as numpy arrays: slicing, word bounds, word digests.

Operators that work per document run in ``mapInArrow``. A batch is cut
into chunks of a few megabytes of text (one longer document is a chunk of
its own), so a task's memory follows the chunk and not the batch.
"""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

# Byte classes of the documented word patterns.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
ALNUM = np.zeros(256, bool)  # digits, letters, every byte of a non-ASCII character
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_MULT = np.uint64(0x9E3779B97F4A7C15)


def of_worker(name: str, key, build: Callable[[], object]):
    """The object that this Python worker keeps under a name for as long as the
    key stays the same: tasks that a worker runs one after the other share it.
    (This package travels with each task, so its own globals do not last.)"""
    kept = sys.modules.setdefault("_kept_by_python_worker", types.ModuleType("_kept_by_python_worker")).__dict__
    if kept.get(name, (None,))[0] != key:
        kept[name] = key, build()
    return kept[name][1]


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """The named column as large_string; null is the empty text."""
    col = batch.column(batch.schema.get_field_index(name)).cast(pa.large_string())
    return pc.fill_null(col, "")


def buffer_of(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and the len+1 byte offsets of a large_string array."""
    bufs = col.buffers()
    offs = np.frombuffer(bufs[1], np.int64, len(col) + 1 + col.offset)[col.offset:]
    if bufs[2] is None or bufs[2].size == 0:
        return np.zeros(0, np.uint8), offs - offs[0]
    data = np.frombuffer(bufs[2], np.uint8)
    return data[offs[0]:offs[-1]], offs - offs[0]


def release() -> None:
    """Give freed memory back: a Python worker lives on and counts for its
    executor in the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def chunks(batch: pa.RecordBatch, text: str = "text",
           limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """(rows, their texts) pieces of about ``limit`` bytes of text."""
    if batch.num_rows == 0:
        return
    col = text_column(batch, text)
    _, offs = buffer_of(col)
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo), col.slice(lo, hi - lo)
        lo = hi
    del col
    release()  # an idle worker should not hold a batch


def word_bounds(data: np.ndarray, offs: np.ndarray, member: np.ndarray):
    """Byte starts, byte ends and row numbers of the maximal runs of member
    bytes; a run never crosses a row."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = member[data]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:n]
    finishes = inside.copy()
    finishes[:-1] &= ~inside[1:] | cut[1:n]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes) + 1
    rows = np.searchsorted(offs, starts, side="right") - 1
    return starts, ends, rows


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser: spreads a digest over all bits."""
    h = h.astype(np.uint64, copy=True)
    for shift, mult in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(mult)
    return h ^ (h >> np.uint64(31))


def word_digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit digest of each run: a polynomial over its bytes, mixed with
    its length. Equal words have equal digests; two different words of one
    corpus of 10^12 words meet with a chance of about 10^-7 a pair table."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    total = int(lens.sum())
    within = np.arange(total, dtype=np.int64) - np.repeat(first, lens)
    power = np.full(int(lens.max()), _MULT, np.uint64)
    power[0] = 1
    np.multiply.accumulate(power, out=power)
    at = within + np.repeat(starts, lens)
    h = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * power[within], first)
    return mix(h + lens.astype(np.uint64) * _MULT)


def counts_by_row(rows: np.ndarray, n_rows: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(rows, weights=weights, minlength=n_rows).astype(np.int64)


def covered(starts: np.ndarray, lens: np.ndarray, n: int) -> np.ndarray:
    """Mask over n positions: those inside at least one [start, start+len)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + lens, -1)
    return np.cumsum(edge[:n]) > 0
