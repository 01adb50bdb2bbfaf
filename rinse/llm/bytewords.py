"""Words of UTF-8 text in Arrow batches, found and hashed with numpy; used inside tasks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20
#: Longer spans are hashed one by one.
_LONG = 64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Space and the control characters 9 to 13 separate words.
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True


def text_slices(column: pa.Array, most: int = _BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of these rows in the bytes) with about `most` bytes or a single row.

    Null texts are empty.
    """
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each row (one entry more than rows)."""
    inside = ~_GAP[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one integer, zeros behind the end."""
    padded = np.zeros(len(data) + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray(shape=(len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))


_FRONT = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; the spans are in order.

    Eight bytes at a time go through a mixing function that is not linear, chained from one to the next, so that
    no sum of bytes decides. Spans of more than 64 bytes are hashed by BLAKE2.
    """
    data = _LOWER[data] if lower else data
    length = ends - starts
    words = eights(data)
    out = mix(length.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    todo = np.flatnonzero((length > 0) & (length <= _LONG))
    at = 0
    while len(todo):
        left = length[todo] - at
        part = words[starts[todo] + at] & _FRONT[np.minimum(left, 8)]
        out[todo] = mix(out[todo] ^ (mix(part ^ np.uint64(0xD6E8FEB86659FD93)) + np.uint64(at)))
        todo, at = todo[left > 8], at + 8
    for k in np.flatnonzero(length > _LONG).tolist():
        digest = hashlib.blake2b(data[starts[k] : ends[k]], digest_size=8).digest()
        out[k] = np.frombuffer(digest, dtype="<u8")[0]
    return out


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """An Arrow array of lists with these lengths over the flat values."""
    offsets = np.zeros(len(counts) + 1, dtype=np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, type=kind))
