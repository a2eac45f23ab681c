"""Words of whole texts as 64-bit hashes, straight from Arrow buffers.

All helpers take a batch of texts as an Arrow string array and work on pieces of about
a quarter of a megabyte, so memory follows the batch's longest text and not its length.
A null text has no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15 | 1)

#: Bytes that end a word: white space, or every ASCII byte that is no letter or digit.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[:128] = True
SYMBOLS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = np.asarray(x, U64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def seeds(n: int, start: int) -> np.ndarray:
    """n odd 64-bit constants, the same in every process."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * _BASE + U64(start)) | U64(1)


def strings(column) -> pa.Array:
    """The column as one plain string array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.string()) if not pa.types.is_string(column.type) else column


def pieces(texts: pa.Array, most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `most` bytes, or one row."""
    ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield lo, min(hi, len(texts))
        lo = min(hi, len(texts))


def raw(texts: pa.Array, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of rows lo to hi, and where each begins (one more: the end). Nulls are empty."""
    part = texts.slice(lo, hi - lo)
    if part.null_count:
        part = part.fill_null("")
    ends = np.frombuffer(part.buffers()[1], np.int32)[part.offset : part.offset + len(part) + 1].astype(np.int64)
    data = part.buffers()[2]
    buf = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, ends - ends[0]


def word_marks(buf: np.ndarray, at: np.ndarray, stops: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(is part of a word per byte, first byte of each word, index of each row's first word)."""
    inside = ~stops[buf]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    rows = at[:-1][at[:-1] < len(buf)]
    begins[rows] = inside[rows]
    starts = np.flatnonzero(begins)
    return inside, starts, np.searchsorted(starts, at)


def hashed(buf: np.ndarray, inside: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """One 64-bit hash per word, from its bytes alone."""
    if not len(starts):
        return np.zeros(0, U64)
    gaps = np.diff(np.append(starts, len(buf)))
    place = np.arange(starts[0], len(buf)) - np.repeat(starts, gaps)
    power = np.cumprod(np.full(int(gaps.max()), _BASE, U64))
    value = (buf[starts[0] :].astype(U64) + U64(1)) * power[place]
    value *= inside[starts[0] :]
    return mix(np.add.reduceat(value, starts - starts[0]))


def word_hashes(texts: pa.Array, lo: int, hi: int, lower: bool = True, stops: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of rows lo to hi, and the index of each row's first (one more: the end)."""
    buf, at = raw(texts, lo, hi)
    if lower:
        buf = LOWER[buf]
    inside, starts, first = word_marks(buf, at, stops)
    return hashed(buf, inside, starts), first


def runs(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` successive words that stay within their row, and each row's first.

    A row with fewer words than `size`, but at least one, has its whole sequence as one.
    """
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    if not begin[-1]:
        return np.zeros(0, U64), begin
    start = np.repeat(first[:-1] - begin[:-1], count) + np.arange(begin[-1])
    width = np.repeat(np.minimum(n, size), count)
    total = width.astype(U64) * U64(0xD6E8FEB86659FD93)
    for k, c in enumerate(seeds(size, 7)):
        there = np.minimum(start + k, len(hashes) - 1)
        total += np.where(k < width, hashes[there] * c, U64(0))
    return mix(total), begin
