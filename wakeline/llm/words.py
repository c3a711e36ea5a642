"""Words, lines and hashes of whole Arrow text batches, as numpy work on their UTF-8 bytes.

A word is a maximal run of bytes other than space and the control characters 9 to 13, which in UTF-8 is
``[^\\x20\\x09-\\x0D]+`` over characters. Null text counts as empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

#: Bytes of a range that is hashed together with others.
SHORT = 64
#: Bytes whose rolling hashes are worked out at once.
SEGMENT = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_POWERS: list[np.ndarray] = []


def _powers() -> list[np.ndarray]:
    if not _POWERS:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            table = np.full(SEGMENT + 1, base, np.uint64)
            table[0] = 1
            _POWERS.append(np.multiply.accumulate(table))
    return _POWERS


def slices(column: pa.Array, most: int = 2 << 20, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes of text and ``rows`` rows at most; a longer text is a range of its own."""
    offsets = raw(column)[1]
    i, n = 0, len(column)
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, i + rows, n)
        yield i, j
        i = j


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def fold(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _FOLD[data]


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of True that no text boundary crosses, and the first run of each text."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(~_SPACE[data], offsets)


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte range.

    Short ranges take in eight bytes a round, all of them at once, by a bijection of what they have so far; long ones go to xxh3 one
    by one. Nothing is linear in the bytes, so no pattern of theirs cancels out.
    """
    starts, length = np.asarray(starts, np.int64), np.asarray(ends, np.int64) - starts
    out = mix(length.astype(np.uint64) * np.uint64(0xA0761D6478BD642F) + np.uint64(_BASE))
    long = length > SHORT
    if long.any():
        view = memoryview(np.ascontiguousarray(data))
        at = np.flatnonzero(long)
        found = [xxhash.xxh3_64_intdigest(view[x : x + n]) for x, n in zip(starts[at].tolist(), length[at].tolist())]
        out[at] = np.array(found, np.uint64)
    at = np.flatnonzero((length > 0) & ~long)
    if not len(at):
        return out
    # Eight bytes from any place; the last ones of the data need something behind them.
    low = int(starts[at].min())
    part = np.concatenate((data[low : int((starts[at] + length[at]).max())], np.zeros(8, np.uint8)))
    eight = np.ndarray((len(part) - 7,), "<u8", part, strides=(1,))
    place, left, state = starts[at] - low, length[at], out[at]
    while len(at):
        chunk = eight[place] & _LOW[np.minimum(left, 8)]
        state = mix((state ^ chunk) * np.uint64(0x9FB21C651E98DF25) + np.uint64(0xC2B2AE3D27D4EB4F))
        done = left <= 8
        out[at[done]] = state[done]
        at, place, left, state = at[~done], place[~done] + 8, left[~done] - 8, state[~done]
    return out


def grams(hashed: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``n`` neighbours (length ``len - n + 1``)."""
    m = len(hashed) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, seed, np.uint64)
    for k in range(n):
        out += hashed[k : k + m] * np.uint64(pow(_BASE, 2 * k + 3, 1 << 64))
    return mix(out)


def owners(first: np.ndarray) -> np.ndarray:
    """The text each run belongs to."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The concatenated integer ranges ``start .. start + length``."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(lengths)[:-1])), lengths)
    return shift + np.arange(total)
