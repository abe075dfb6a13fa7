"""Words and rolling hashes of whole texts, as numpy arrays.

A word is a run of bytes other than 0x20 and 0x09-0x0D. All functions work on UTF-8 bytes, in
pieces of bounded size, so that a very long text costs 8 bytes per word and no more per byte.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD1342543DE82EF95)
_PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of each text's first word (one more than texts)."""
    first, last = int(offsets[0]), int(offsets[-1])
    inside = ~_SPACE[data[first:last]]
    cuts = offsets[1:-1] - first
    cuts = cuts[(cuts > 0) & (cuts < len(inside))]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    begins[cuts] = inside[cuts]
    ends[:-1] &= ~inside[1:]
    ends[cuts - 1] = inside[cuts - 1]
    starts = np.flatnonzero(begins) + first
    return starts, np.flatnonzero(ends) + first + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every word's bytes; `lower` takes A-Z as a-z."""
    table = _BYTE[_LOWER] if lower else _BYTE
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    weight = powers(int(lengths.max(initial=1)))
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + _PIECE)))
        size = lengths[i:j]
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        value = table[data[place + np.repeat(starts[i:j], size)]] * weight[place]
        out[i:j] = np.add.reduceat(value, at)
        i = j
    return mix(out + lengths.astype(np.uint64) * _STEP)


def rolling(values: np.ndarray, n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """Hash of every n consecutive values; entry i covers values[i:i+n]."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out, width, done, tail = None, 1, 0, values
    power = base
    with np.errstate(over="ignore"):
        while True:  # powers of two of n, joined from the left
            if n & width:
                if out is None:
                    out = tail
                else:
                    keep = len(tail) - done
                    out = tail[:keep] * _pow(base, done) + out[width : width + keep]
                done += width
            width *= 2
            if width > n:
                return mix(out[: len(values) - n + 1])
            tail = tail[: len(tail) - width // 2] * power + tail[width // 2 :]
            power = power * power


def _pow(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's n-word shingles; fewer words make one, none makes none."""
    if not len(hashes):
        return hashes
    if len(hashes) < n:
        return rolling(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(rolling(hashes, n))
