"""Vectorised text kernels shared by the corpus operators.

All of them work on one Arrow string column at a time, in slices of a few
hundred kilobytes of UTF-8, so that memory follows the longest single text and
not the batch.  Null texts count as empty.  Nothing here needs a Spark session.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one numpy slice holds, unless a single text is longer.
SLICE_BYTES = 1 << 19

#: The six ASCII white-space characters of the word rule [^\x20\x09-\x0D]+.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z on bytes; all other bytes stay.
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(h: np.ndarray) -> np.ndarray:
    """Avalanche 64-bit values (the public MurmurHash3 finaliser)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes, end to end, and the len + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, where, data = column.buffers()
    at = np.frombuffer(where, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges that hold at most so many bytes and rows each, or one longer row."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        high = min(high, n, low + rows)
        yield low, high
        low = high


def text_slices(column: pa.Array, most: int = SLICE_BYTES, rows: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets) of each slice."""
    data, at = utf8(column)
    for low, high in slices(at, most, rows):
        yield low, high, data[at[low] : at[high]], at[low : high + 1] - at[low]


def runs(mask: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True that no row boundary of at crosses."""
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    inner = at[1:-1]
    inner = inner[(inner > 0) & (inner < len(mask))]
    begins[inner] = mask[inner]
    ends[inner - 1] = mask[inner - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the words in each row."""
    begins, ends = runs(~IS_SPACE[data], at)
    return begins, ends, np.diff(np.searchsorted(begins, at))


#: Keeps the bytes of a 64-bit word that belong to a span's last one, by their number.
_LAST = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def span_words(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans' bytes as 64-bit words, the last of each filled up with zeros, and the words of each span (1 at least)."""
    sizes = ends - begins
    counts = np.maximum((sizes + 7) >> 3, 1)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    whole = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    if counts.max(initial=1) == 1:
        return whole[begins] & _LAST[sizes], counts
    step = 8 * (np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts))
    return whole[np.repeat(begins, counts) + step] & _LAST[np.minimum(np.repeat(sizes, counts) - step, 8)], counts


def word_hashes(words: np.ndarray, counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of span_words(): every word is scrambled with its place by a function
    that cannot be inverted step by step, the results are added, and the sum is scrambled with the length."""
    if not len(counts):
        return np.zeros(0, np.uint64)
    first = np.cumsum(counts) - counts
    if len(words) == len(counts):
        key = np.full(1, _BASE, np.uint64)
    else:
        key = (np.arange(len(words)) - np.repeat(first, counts) + 1).astype(np.uint64) * np.uint64(_BASE)
    h = mix(words + key) * (mix(words ^ (key * np.uint64(0xD1B54A32D192ED03))) | np.uint64(1))
    if len(words) > len(counts):
        h = np.add.reduceat(h, first)
    return mix(h ^ (sizes.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes; where a span stands does not matter."""
    if not len(begins):
        return np.zeros(0, np.uint64)
    return word_hashes(*span_words(data, begins, ends), ends - begins)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """64-bit hashes of the windows of n consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        total += mix(words[i : len(words) - n + 1 + i] + np.uint64((i + 1) * _BASE & (1 << 64) - 1))
    return mix(total)


def rows_of(counts: np.ndarray) -> np.ndarray:
    """The row number of each item, from the items in each row."""
    return np.repeat(np.arange(len(counts)), counts)
