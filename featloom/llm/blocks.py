"""Numpy helpers on Arrow batches of texts, run inside tasks.

A batch is handled in chunks of about ``CHUNK_BYTES`` (one row at least), so
memory follows the longest text, not the table. Words, word hashes and hashes
of runs of words are computed for all rows of a chunk at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19
_U = np.uint64
_MASK = (1 << 64) - 1

_BYTE = np.arange(256)
#: Bytes of words that blanks (space, \t \n \v \f \r) part.
BLANK_PARTED = ~((_BYTE == 32) | ((_BYTE >= 9) & (_BYTE <= 13)))
#: Bytes of words made of ASCII letters, digits and everything beyond ASCII.
ALPHANUMERIC = (_BYTE >= 128) | ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122))

_LETTERS = np.random.Generator(np.random.PCG64(20)).integers(0, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, CHUNK_BYTES + 1)
            grow = lambda b: np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(size - 1, b, np.uint64))])
            self.up, self.down = grow(self.base), grow(self.inverse)


_IN_WORD = _Powers(0x9E3779B97F4A7C15)
_ACROSS = (_Powers(0xD6E8FEB86659FD93), _Powers(0xA0761D6478BD642F))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit integers."""
    x = x ^ (x >> _U(31))
    x = x * _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x = x * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _run_sums(x: np.ndarray, powers: _Powers, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of ``x[start:end]`` for each pair, the same wherever the run stands."""
    powers.need(len(x) + 1)
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x * powers.up[: len(x)], out=total[1:])
    return (total[ends] - total[starts]) * powers.down[starts]


@dataclass
class Chunk:
    """Rows ``low`` to ``high`` of a batch: their bytes, and where each row begins in them."""

    low: int
    high: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.high - self.low

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The rows of a text column, null as empty, in order."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, where, body = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    low = 0
    while low < len(column):
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, side="right")) - 1)
        high = min(high, low + 4096, len(column))
        yield Chunk(low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low])
        low = high


@dataclass
class Words:
    """The words of a chunk in order: byte range, row, place in the row; ``first`` has each row's first word."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    place: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(chunk: Chunk, is_word: np.ndarray) -> Words:
    inside = is_word[chunk.data]
    begins, stops = inside.copy(), inside.copy()
    if len(inside):
        full = chunk.offsets[1:] > chunk.offsets[:-1]
        after, before = np.zeros_like(inside), np.zeros_like(inside)
        after[1:] = inside[:-1]
        after[chunk.offsets[:-1][full]] = False
        before[:-1] = inside[1:]
        before[chunk.offsets[1:][full] - 1] = False
        begins &= ~after
        stops &= ~before
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, chunk.offsets)
    row = np.repeat(np.arange(chunk.rows), np.diff(first))
    return Words(starts, ends, row, np.arange(len(starts)) - first[row], first)


def word_hashes(chunk: Chunk, found: Words, fold_case: bool = False) -> np.ndarray:
    table = _FOLDED if fold_case else _LETTERS
    raw = _run_sums(table[chunk.data], _IN_WORD, found.starts, found.ends)
    return mix(raw + (found.ends - found.starts).astype(np.uint64))


def span_hashes(chunk: Chunk, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte ranges, as they stand."""
    return mix(_run_sums(_LETTERS[chunk.data], _IN_WORD, starts, ends) + (ends - starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, length: int, variant: int = 0) -> np.ndarray:
    """Hash of each run of ``length`` consecutive words, whatever the rows they belong to."""
    begin = np.arange(max(len(hashes) - length + 1, 0))
    return mix(_run_sums(hashes, _ACROSS[variant], begin, begin + length) + _U(length))


def whole_runs(found: Words, length: int) -> np.ndarray:
    """Starts (word numbers) of the runs of ``length`` words that lie in one row."""
    n = len(found.row) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(found.row[:n] == found.row[length - 1 :])


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in one of the ranges ``[start, start + length)``."""
    edge = np.bincount(starts, minlength=n + 1) - np.bincount(np.minimum(starts + length, n), minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def spread(begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``[begin, begin + count)``, one range after the other."""
    total = int(count.sum())
    shift = np.repeat(begin - np.concatenate([[0], np.cumsum(count)[:-1]]), count) if len(count) else np.zeros(0, np.int64)
    return shift + np.arange(total)


def prime_from(n: int) -> int:
    """The smallest prime that is at least ``n``; keys in regular steps spread evenly over so many parts."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def free_name(columns: list[str], name: str) -> str:
    """``name``, or if a column is called so, ``name`` with underscores before it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
