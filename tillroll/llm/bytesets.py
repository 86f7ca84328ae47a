"""Byte-level helpers that the text operators share: Arrow string buffers, word spans, word hashes.

Everything here works on whole UTF-8 buffers with numpy, so a batch costs a few passes over its
bytes and never a Python string per word.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19
_BLOCK = 1 << 20  # bytes that one run of the prefix-sum hash covers


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers derived from a seed."""
    return mix64(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed)) | np.uint64(1)


_VALUES = seeded(256, 11)
_BASE = 0xD6E8FEB86659FD93  # odd, so invertible modulo 2**64
_powers: tuple[np.ndarray, np.ndarray] | None = None


def _power_tables() -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, once per worker process."""
    global _powers
    if _powers is None:
        def table(base: int) -> np.ndarray:
            out = np.full(_BLOCK + 1, base, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)
        _powers = table(_BASE), table(pow(_BASE, -1, 1 << 64))
    return _powers


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; a null counts as empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return offsets, data


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Consecutive row ranges of at most ``limit`` bytes each (one longer row stands alone)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def joined(offsets: np.ndarray, data: np.ndarray, i: int, j: int, gap: int = 0x20) -> tuple[np.ndarray, np.ndarray]:
    """Rows i..j copied into one buffer with a gap byte after each; also where each row starts."""
    lengths = np.diff(offsets[i:j + 1])
    starts = np.zeros(j - i + 1, np.int64)
    np.cumsum(lengths + 1, out=starts[1:])
    out = np.full(int(starts[-1]), gap, np.uint8)
    for k in range(j - i):
        a, b = offsets[i + k], offsets[i + k + 1]
        out[starts[k]:starts[k] + b - a] = data[a:b]
    return out, starts


def byte_table(drop: str | bytes) -> np.ndarray:
    """True for each byte value that belongs to a word."""
    table = np.ones(256, bool)
    table[list(drop if isinstance(drop, bytes) else drop.encode("latin-1"))] = False
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def word_spans(data: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of word bytes."""
    flags = np.zeros(len(data) + 2, np.int8)
    flags[1:-1] = is_word[data]
    edges = np.flatnonzero(flags[1:] != flags[:-1])
    return edges[0::2], edges[1::2]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes that depends on these bytes alone.

    Prefix sums of byte values times powers of an odd base give each span's polynomial without a
    loop over spans. Spans longer than a block are hashed by BLAKE2b instead.
    """
    power, inverse = _power_tables()
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = int(np.searchsorted(ends, base + _BLOCK, "right"))
        if j <= i:
            whole = hashlib.blake2b(data[base:ends[i]].tobytes(), digest_size=8).digest()
            out[i] = np.frombuffer(whole, np.uint64)[0]
            i += 1
            continue
        piece = data[base:int(ends[j - 1])]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VALUES[piece] * power[:len(piece)], out=sums[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix64((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
        i = j
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` consecutive words, by the position of the first."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k, factor in enumerate(seeded(size, 29)):
        out += words[k:k + n] * factor
    return mix64(out)


def binary_column(rows: np.ndarray) -> pa.Array:
    """A binary column from a 2-D array, one fixed-width value per row."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize if rows.ndim == 2 else rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def list_column(values: pa.Array, counts: np.ndarray) -> pa.Array:
    """A list column that deals ``values`` out by ``counts``."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
