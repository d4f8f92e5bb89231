"""Vectorised helpers over Arrow string columns, shared by the text operators.

A task receives its documents as Arrow batches; the UTF-8 bytes of a batch are
one numpy buffer, so words are found and hashed without building a Python
string per word.  Working memory is a small multiple of :data:`SLICE_BYTES`
plus a few bytes per byte of the longest single document.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20  # bytes of text worked on at once; bounds memory, never cuts a document

# The fixed word separators of all word-based contracts: space and \t \n \v \f \r.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER_ASCII = np.arange(256, dtype=np.uint8)
LOWER_ASCII[0x41:0x5B] += 32

_BASE = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_BASE = 0xD6E8FEB86659FD93
_WINDOW_INVERSE = pow(_WINDOW_BASE, -1, 1 << 64)


@cache
def _trim():
    """glibc's call that gives freed memory back to the system; None with another C library."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return None


def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; what was freed while one was worked on goes back to the system before the next.

    A Python worker outlives its task, so what its allocators keep would add to
    all later stages of a job.
    """
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()
        if _trim():
            _trim()(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (multiply-xorshift), element by element."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _byte_table(seed: int) -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * _BASE + np.uint64(seed * 7919 + 1))


def string_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer document is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        yield at, min(end, n)
        at = min(end, n)


def word_spans(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and the number of words before each document.

    The third array has one entry more than there are documents.  ``apart``
    marks the bytes that separate words.
    """
    if len(raw) == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, np.zeros(len(offsets), np.int64)
    word = ~apart[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)  # True where a document begins
    cut[offsets] = True
    before = np.empty(len(raw), dtype=bool)
    before[0] = False
    before[1:] = word[:-1]
    starts = np.flatnonzero(word & (~before | cut[:-1]))
    after = np.empty(len(raw), dtype=bool)
    after[-1] = False
    after[:-1] = word[1:]
    ends = np.flatnonzero(word & (~after | cut[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of every byte span; spans are in order and do not overlap, and may be empty."""
    out = np.zeros(len(starts), dtype=np.uint64)
    full = np.flatnonzero(ends > starts)
    table, at = _byte_table(seed), 0
    while at < len(full):
        end = max(at + 1, int(np.searchsorted(starts[full], starts[full[at]] + SLICE_BYTES)))
        s, e = starts[full[at:end]], ends[full[at:end]]
        lo, hi = s[0], e[-1]
        inside = np.arange(lo, hi, dtype=np.int32 if hi < 2**31 else np.int64)
        inside -= np.repeat(s.astype(inside.dtype), np.diff(np.append(s, hi)))
        powers = np.cumprod(np.full(int(inside.max()) + 1, _BASE, dtype=np.uint64))
        values = table[raw[lo:hi]]
        values *= powers[inside]
        gaps = ragged(e[:-1], s[1:] - e[:-1]) - lo  # bytes between spans do not count
        values[gaps] = 0
        out[full[at:end]] = np.add.reduceat(values, s - lo) + (e - s).astype(np.uint64)
        at = end
    return mix64(out)


def window_hashes(words: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes (the caller drops windows across documents)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    w = mix64(words + np.uint64(seed)) if seed else words
    powers = np.cumprod(np.full(len(w), _WINDOW_BASE, dtype=np.uint64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w * powers)])
    inverse = np.cumprod(np.full(n, _WINDOW_INVERSE, dtype=np.uint64))
    return mix64((sums[size:] - sums[:n]) * inverse)


def doc_of(first: np.ndarray) -> np.ndarray:
    """Document number of every item, from the number of items before each document."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Indexes of the items that begin a window of ``size`` items inside one document."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    total = int(counts.sum())
    ahead = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    return np.arange(total) - np.repeat(ahead, counts) + np.repeat(first[:-1], counts)


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + counts[i] - 1`` for every i, one after the other."""
    total = int(counts.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    ahead = np.concatenate([[0], np.cumsum(counts)[:-1]])
    return np.arange(total) - np.repeat(ahead - starts, counts)


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of the values of each document (0 for a document without items)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[first[1:]] - total[first[:-1]]


def line_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every ``\\n``-split line, and the number of lines before each document.

    A document has one line more than newlines; an empty one has one empty line.
    """
    breaks = np.flatnonzero(raw == 0x0A)
    in_doc = np.searchsorted(offsets, breaks, side="right") - 1  # empty documents hold no byte
    n = len(offsets) - 1
    counts = np.bincount(in_doc, minlength=n) + 1 if n else np.zeros(0, np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.empty(first[-1], np.int64)
    ends = np.empty(first[-1], np.int64)
    own = np.arange(len(breaks)) + in_doc  # the line that each newline ends
    starts[first[:-1]] = offsets[:-1]
    starts[own + 1] = breaks + 1
    ends[own] = breaks
    ends[first[1:] - 1] = offsets[1:]
    return starts, ends, first


def code_point_starts(raw: np.ndarray) -> np.ndarray:
    """Byte positions at which a UTF-8 code point begins."""
    return np.flatnonzero((raw & 0xC0) != 0x80)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word shingles and the number of them before each document.

    A document of 1 to ``size - 1`` words has one shingle, all its words.
    """
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < size))
    n_shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_first = np.concatenate([[0], np.cumsum(n_shingles)])
    out = np.empty(out_first[-1], dtype=np.uint64)
    whole = np.ones(len(out), dtype=bool)
    whole[out_first[short]] = False
    starts = window_starts(first, size)
    if len(starts):
        out[whole] = window_hashes(words, size, seed)[starts]
    for k in range(1, size):
        rows = short[counts[short] == k]
        if len(rows):
            out[out_first[rows]] = mix64(window_hashes(words, k, seed)[first[rows]] + np.uint64(k))
    return out, out_first
