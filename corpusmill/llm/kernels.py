"""Vectorised text kernels over Arrow batches: word boundaries and 64-bit word hashes without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = b" \t\n\x0b\x0c\r"
IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes that are hashed at once; bounds the memory of the power tables and prefix sums.
WINDOW = 1 << 17
_tables: dict[str, np.ndarray] = {}


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, in place on a uint64 array."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        size = max(n, WINDOW + 4096)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _tables[name] = np.multiply.accumulate(table)
    return _tables["up"][:n], _tables["down"][:n]


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its texts; null counts as empty."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    else:
        offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, most: int = 1 << 18) -> list[tuple[int, int]]:
    """Ranges of rows with at most `most` bytes of text (one row at least): what a kernel holds at a time."""
    _, offsets = text_buffer(column)
    out, a = [], 0
    while a < len(column):
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        out.append((a, b))
        a = b
    return out


def runs_of(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True that lie within one text."""
    n = len(mask)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = mask[:-1]
    starts = np.flatnonzero(mask & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = mask[1:]
    ends = np.flatnonzero(mask & (~after | edge[1:])) + 1
    return starts, ends


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for spans in order that don't overlap; equal bytes have equal hashes."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + WINDOW, "right")))
        low, high = int(starts[first]), int(ends[last - 1])
        up, down = _powers(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[: high - low], out=sums[1:])
        s, e = starts[first:last] - low, ends[first:last] - low
        out[first:last] = (sums[e] - sums[s]) * down[s]
        first = last
    return mix64(out)


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a string column; words are runs without white space, A-Z lower-cased if asked.

    Returns (hashes, first word of each text as n + 1 indices, starts, ends, bytes).
    """
    data, offsets = text_buffer(column)
    if lower:
        data = LOWER[data]
    starts, ends = runs_of(~IS_SPACE[data], offsets)
    return hash_spans(data, starts, ends), np.searchsorted(starts, offsets), starts, ends, data


def shingle_hashes(words_: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of `width` words; fewer words than that: none."""
    n = len(words_) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words_[:n].copy()
    for k in range(1, width):
        out *= np.uint64(0xD6E8FEB86659FD93)
        out += words_[k : k + n]
    return mix64(out)


def sequence_hash(words_: np.ndarray) -> np.uint64:
    """One hash for a short sequence of words, apart from the hashes of full shingles."""
    value = np.array([0xA5A5A5A5 + len(words_)], np.uint64)
    for w in words_:
        value = mix64(value * np.uint64(0xD6E8FEB86659FD93) + w)
    return value[0]
