"""Vectorised byte-level text kernels shared by the operators (they run inside Arrow batches).

A chunk of documents is one contiguous ``uint8`` buffer plus offsets.  Words are maximal runs of bytes
outside ``\\x20 \\x09-\\x0D``; these bytes never occur inside a multi-byte UTF-8 sequence, so byte logic
equals code-point logic.  Spans get 62-bit polynomial hashes from prefix sums, spread over 64 bits by a mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
CHUNK_ROWS = 8192
PRIME = (1 << 31) - 1
_P, _31 = np.uint64(PRIME), np.uint64(31)
# bases of the two lanes of a span's hash, drawn once at random below PRIME
_BASES = (1_279_365_593, 1_803_416_927)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[int, np.ndarray] = {}


def _fold(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, for x below 2^62."""
    x = (x & _P) + (x >> _31)
    x = (x & _P) + (x >> _31)
    return x - _P * (x >= _P)


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base`` modulo PRIME."""
    table = _powers.get(base, np.ones(1, np.uint64))
    while len(table) < n:
        step = np.uint64(pow(base, len(table), PRIME))
        table = np.concatenate([table, _fold(table * step)])
    _powers[base] = table
    return table[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads all 64 bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class Spans:
    """Hashes of arbitrary spans of one sequence of bytes, or of 64-bit hashes of words.

    A hash has two polynomials modulo the prime 2^31 - 1 with fixed random bases: two different spans of n units agree with
    odds of (n / 2^31)^2, whatever their content (a polynomial modulo 2^64 has strings that always agree)."""

    def __init__(self, values: np.ndarray):
        narrow = values.dtype.itemsize < 4
        wide = values.astype(np.uint64)
        lanes = (wide, wide) if narrow else (wide & _P, wide >> np.uint64(33))
        self.prefix = []
        for base, lane in zip(_BASES, lanes, strict=True):
            terms = (lane + np.uint64(1)) * _power(base, len(values))
            if not narrow or len(values) > 1 << 24:
                terms = _fold(terms)  # else their sums stay below 2^64
            total = np.zeros(len(values) + 1, np.uint64)
            np.cumsum(terms, out=total[1:])
            self.prefix.append(total)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = np.zeros(len(start), np.uint64)
        for base, total in zip(_BASES, self.prefix, strict=True):
            shift = _power(pow(base, -1, PRIME), len(total))
            out = (out << _31) | _fold(_fold(total[end] - total[start]) * shift[start])
        return mix(out)


def raw(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary()
    column = column.cast(pa.large_string()).cast(kind) if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else column.cast(kind)
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and len(column) else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, past row, bytes, offsets) of runs of rows of about ``most`` bytes, and CHUNK_ROWS rows at most; one row is never split."""
    buf, off = raw(column)
    row, n = 0, len(off) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + most, "right")) - 1)
        end = min(end, n, row + CHUNK_ROWS)
        yield row, end, buf[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def words(buf: np.ndarray, off: np.ndarray, space: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each document and the total): all words of a chunk."""
    if not len(buf):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    inside = ~space[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values`` over [bounds[i], bounds[i+1])."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def owners(bounds: np.ndarray) -> np.ndarray:
    """The document of each item."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def shingles(hashes: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words that stay inside a document, and their document bounds.

    A document with 1 to k-1 words has its whole word sequence as its only shingle."""
    count = np.diff(bounds)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    out = np.zeros(len(count) + 1, np.int64)
    np.cumsum(number, out=out[1:])
    start = bounds[:-1].repeat(number) + np.arange(out[-1]) - out[:-1].repeat(number)
    end = np.minimum(start + k, bounds[1:].repeat(number))
    return Spans(hashes).hash(start, end), out


def distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each document, and their bounds."""
    doc = owners(bounds)
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    h, d = h[keep], d[keep]
    return h, np.searchsorted(d, np.arange(len(bounds)))


def take_spans(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of the spans, joined, and their offsets."""
    size = end - start
    off = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=off[1:])
    return buf[np.repeat(start - off[:-1], size) + np.arange(off[-1])], off


def strings(buf: np.ndarray, off: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(off) - 1, pa.py_buffer(off.astype(np.int64).tobytes()), pa.py_buffer(buf.tobytes())).cast(pa.string())
