"""Hashes of words and n-grams over Arrow batches of whole texts, in numpy.

A text column is taken as one byte buffer; words and their 64-bit polynomial hashes come from a few
vector operations over pieces of about ``CHUNK`` bytes, so memory does not depend on the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def give_back() -> None:
    """Return the memory that numpy and Arrow have freed to the system (what glibc keeps, where that is the C library)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(task: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``task``, for mapInArrow, after which its worker gives freed memory back.

    Spark keeps workers for later tasks: what an idle one holds is missing beside the heap of its executor.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def powers(multiplier: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """multiplier**i and its inverse (mod 2**64) for i below n at least."""
    up, down = _powers.get(multiplier, (np.empty(0, np.uint64),) * 2)
    if len(up) < n:
        size = max(n, 2 * CHUNK)
        pair = []
        for base in (multiplier, pow(multiplier, -1, 1 << 64)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            pair.append(np.cumprod(steps, dtype=np.uint64))
        up, down = pair
        if size <= 8 * CHUNK:
            _powers[multiplier] = (up, down)
    return up, down


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit value over the others (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span of ``codes``; equal spans have equal hashes wherever they stand."""
    up, down = powers(MULTIPLIER, len(codes) + 1)
    total = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column, nulls as empty, and the n + 1 offsets of its texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(separator: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run that holds no separator and lies in one text."""
    n = len(separator)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    inside = ~separator
    starts = np.flatnonzero(inside & (edge[:-1] | np.r_[True, separator[:-1]])) if n else np.empty(0, np.int64)
    ends = np.flatnonzero(inside & (edge[1:] | np.r_[separator[1:], True])) + 1 if n else np.empty(0, np.int64)
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def words(column: pa.Array, separators: np.ndarray = SPACES, fold: np.ndarray | None = LOWER):
    """For ranges of texts: (first text, last text, bytes, starts, ends, text number from first, hashes)."""
    data, offsets = text_buffer(column)
    for first, last in chunks(offsets):
        piece = data[offsets[first]:offsets[last]]
        starts, ends, text = spans(separators[piece], offsets[first:last + 1] - offsets[first])
        codes = piece if fold is None else fold[piece]
        yield first, last, codes, starts, ends, text, span_hashes(codes, starts, ends)


def shingle_sets(column: pa.Array, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(text number, sorted distinct hashes of its ``width``-word shingles); fewer words count as one shingle.

    A text without words has an empty set. Nulls count as empty texts.
    """
    factors = [np.uint64(pow(0xA24BAED4963EE407, i, 1 << 64)) for i in range(width)]
    for first, last, _, _, _, text, h in words(column):
        count = np.bincount(text, minlength=last - first)
        begin = np.r_[0, np.cumsum(count)]
        if len(h) >= width:
            run = np.zeros(len(h) - width + 1, np.uint64)
            for i, f in enumerate(factors):
                run += h[i:len(h) - width + 1 + i] * f
            run = mix(run)
        for k in range(last - first):
            b, c = begin[k], count[k]
            if c >= width:
                yield first + k, np.unique(run[b:b + c - width + 1])
            elif c:
                whole = (h[b:b + c] * np.array(factors[:c], np.uint64)).sum(dtype=np.uint64) + np.uint64(c)
                yield first + k, mix(np.array([whole], np.uint64))
            else:
                yield first + k, np.empty(0, np.uint64)


#: Class of each byte: 0 white space, 1 letter (all of a multi-byte character counts as letters), 2 digit, 3 other.
BYTE_CLASS = np.full(256, 3, np.uint8)
BYTE_CLASS[SPACES] = 0
BYTE_CLASS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
BYTE_CLASS[48:58] = 2


def class_runs(piece: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of bytes of one class other than white space."""
    kind = BYTE_CLASS[piece]
    n = len(kind)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    change = edge.copy()
    change[1:n] |= kind[1:] != kind[:-1]
    starts = np.flatnonzero(change[:n] & (kind != 0))
    ends = np.flatnonzero(change[1:] & (kind != 0)) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1
