"""Arrow text columns as byte arrays: slices, words, hashes, without a Python loop over words.

A word is ``[^\\x20\\x09-\\x0D]+``. Its hash is the sum, modulo 2**64, of a random number per byte times a
power of an odd base, mixed at the end; hashes depend on the bytes alone and are the same in every process.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
#: Bytes hashed at a time: their numbers and powers stay in a core's cache.
SPAN_BYTES = 1 << 14
try:
    _trim = ctypes.CDLL(None).malloc_trim
except (OSError, AttributeError):  # another C library keeps its memory its own way
    _trim = None
_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit words; equal inputs stay equal, and differing ones differ."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_RANDOM = mix((np.arange(1, 257, dtype=np.uint64)) * np.uint64(_BASE))
#: The number of each byte; white space counts nothing.
EXACT = np.where(WHITE, np.uint64(0), _RANDOM)
FOLDED = EXACT[LOWER]


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base; grows with the longest word seen."""
    global _powers
    if len(_powers) < n:
        more = np.full(max(n, 64, 2 * len(_powers)), np.uint64(_BASE))
        more[0] = 1
        _powers = np.cumprod(more)
    return _powers[:n]


_back = np.full(SPAN_BYTES, pow(_BASE, -1, 1 << 64), np.uint64)
_back[0] = 1
#: The powers of the base's inverse modulo 2**64.
_back = np.cumprod(_back)


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; after each one, memory that its work has freed goes back to the system, as workers live long."""
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if _trim is not None:
            _trim(0)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each value starts and ends; null counts as empty."""
    column = pc.fill_null(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, at.astype(np.int64)


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, bytes, offsets from 0."""
    if not len(column):
        return
    data, at = column_bytes(column)
    first = 0
    while first < len(at) - 1:
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(at) - 1)
        yield first, data[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte positions at which the words start and end; no word crosses a text's end."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~WHITE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[at] = True
    before = np.empty(len(data), bool)
    before[0] = True
    np.logical_not(inside[:-1], out=before[1:])
    after = np.empty(len(data), bool)
    after[-1] = True
    np.logical_not(inside[1:], out=after[:-1])
    starts = np.flatnonzero(inside & (before | cut[:-1]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = EXACT) -> np.ndarray:
    """A hash of each span of bytes; spans are in order and do not overlap. Bounded temporary memory."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        begin = int(starts[first])
        last = max(int(starts.searchsorted(begin + SPAN_BYTES, "left")), first + 1)
        s, e = starts[first:last] - begin, ends[first:last] - begin
        # each byte's number times a power by its place in the stretch; a span's sum is divided by the power of its start
        size = int(e.max())
        sums = np.zeros(size + 1, np.uint64)
        values = table[data[begin : begin + size]]
        values *= powers(size)
        np.cumsum(values, out=sums[1:])
        out[first:last] = (sums[e] - sums[s]) * _back[s]
        first = last
    return mix(out)


def words(data: np.ndarray, at: np.ndarray, table: np.ndarray = EXACT):
    """Starts, ends, text number and hash of all words of a slice."""
    starts, ends = word_spans(data, at)
    owner = np.searchsorted(at, starts, "right") - 1
    return starts, ends, owner, span_hashes(data, starts, ends, table)


def shingle_hashes(hashes: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and text numbers of all runs of ``width`` words; a shorter text is one run, one without words none."""
    n = len(hashes)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    total = np.zeros(n, np.uint64)
    same = np.ones(n, bool)
    first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
    for j in range(width):
        if j < n:
            part = hashes[j:] * factors[j]
            if j:
                crossing = owner[j:] != owner[:-j]
                part[crossing] = 0
                same[: n - j] &= ~crossing
                same[n - j :] = False
                total[: n - j] += part
            else:
                total += part
        else:
            same[:] = False
    # a text of fewer words: the sum over the words that it has, at its first word
    lengths = np.diff(np.r_[first, n])
    short = first[lengths < width]
    keep = same.copy()
    keep[short] = True
    total[short] += np.uint64(_BASE) * lengths[lengths < width].astype(np.uint64)
    return mix(total[keep]), owner[keep]


def batches_of(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
