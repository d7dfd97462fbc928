"""Vectorised helpers shared by the operators: hashing, word spans, sliding minima.

Everything here works on one Arrow batch inside a task; Spark does the
partitioning, shuffling and sorting around it.  Positions are int64 offsets
into the batch's concatenated UTF-8 buffer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)
# Sequence hashes are polynomials over a prime field, one for each base.  (Modulo a power of two every base
# collides on the same repetitive strings, such as a Thue-Morse word and its complement.)
PRIME = (1 << 31) - 1
BASES = (1_117_905_173, 1_850_468_293)
_P, _BITS = _U(PRIME), _U(31)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that near inputs get unrelated values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


# One unrelated 64-bit value per byte; entry i is the finaliser of i + 1.
BYTE_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * _GOLDEN)
# The same with A-Z folded onto a-z (other letters are left alone).
_FOLD = np.arange(256)
_FOLD[65:91] += 32
FOLDED_BYTE_VALUES = BYTE_VALUES[_FOLD]


def _folded(x: np.ndarray, spare: np.ndarray) -> np.ndarray:
    """An equal value modulo the prime, in place: below 2**32 from below 2**62, near 2**31 from below 2**34."""
    np.right_shift(x, _BITS, out=spare)
    x &= _P
    x += spare
    return x


_POWERS: dict[int, np.ndarray] = {}
POWERS_KEPT = 8 << 20
_STRIDE = 1 << 15  # items worked on at a time, so that they stay in the processor's cache


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1), below 2**32 modulo the prime; up to POWERS_KEPT of them are kept per worker."""
    known = _POWERS.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    out = np.ones(max(n, 1024) if n > POWERS_KEPT else 1 << max(10, (n - 1).bit_length()), dtype=np.uint32)
    size = 1
    while size < len(out):
        more = min(size, len(out) - size)
        next_part = out[:more] * _U(pow(base, size, PRIME))
        spare = np.empty_like(next_part)
        out[size:size + more] = _folded(_folded(next_part, spare), spare)
        size += more
    if len(out) <= POWERS_KEPT:
        _POWERS[base] = out
    return out[:n]


class SequenceHash:
    """62-bit hash of any slice of a sequence of 64-bit values, from prefix sums in two prime fields.

    Two different slices of n values collide in one field for at most n of its 2**31 bases.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.prefix = [np.zeros(n + 1, dtype=np.uint32) for _ in BASES]
        self.unshift = [powers(pow(base, -1, PRIME), n + 1) for base in BASES]
        shift = [powers(base, n) for base in BASES]
        part, spare = np.empty((2, min(n, _STRIDE)), dtype=np.uint64)
        for at in range(0, n, _STRIDE):
            chunk = values[at:at + _STRIDE]
            x, y = part[:len(chunk)], spare[:len(chunk)]
            for lane, (prefix, power) in enumerate(zip(self.prefix, shift)):
                if lane:
                    np.bitwise_and(chunk, _P, out=x)
                else:
                    np.right_shift(chunk, _U(33), out=x)
                x *= power[at:at + _STRIDE]
                _folded(x, y)
                x[0] += prefix[at]
                np.cumsum(x, out=x)
                prefix[at + 1:at + 1 + len(chunk)] = _folded(x, y)

    def _between(self, size: int, low, high, unshift, count) -> np.ndarray:
        """Hashes of ``size`` slices; low, high and unshift give each field's values of a run of slices."""
        out = np.empty(size, dtype=np.uint64)
        gap, spare = np.empty((2, min(size, _STRIDE)), dtype=np.uint64)
        for at in range(0, size, _STRIDE):
            run = slice(at, min(size, at + _STRIDE))
            x, y, found = gap[:run.stop - at], spare[:run.stop - at], out[run]
            for lane in range(len(BASES)):
                x[:] = high(lane, run)
                x += _U(4 * PRIME)
                x -= low(lane, run)
                _folded(x, y)
                x *= unshift(lane, run)
                _folded(_folded(x, y), y)
                np.floor_divide(x, _P, out=y)  # 0 or 1: the least value of its class
                y *= _P
                x -= y
                if lane:
                    found |= x
                else:
                    np.left_shift(x, _BITS, out=found)
            if count is not None:
                found += count(run).astype(np.uint64) * _U(0xD6E8FEB86659FD93)
            out[run] = mix64(found)
        return out

    def slices(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self._between(len(start), lambda k, run: self.prefix[k][start[run]],
                             lambda k, run: self.prefix[k][end[run]], lambda k, run: self.unshift[k][start[run]],
                             lambda run: end[run] - start[run])

    def grams(self, k: int) -> np.ndarray:
        """Hash of every k consecutive values (length n - k + 1, empty when n < k)."""
        size = max(0, len(self.prefix[0]) - k)
        return self._between(size, lambda lane, run: self.prefix[lane][run],
                             lambda lane, run: self.prefix[lane][run.start + k:run.stop + k],
                             lambda lane, run: self.unshift[lane][run], None)


class RollingHash(SequenceHash):
    """Slices of a byte buffer; ``folded`` reads A-Z as a-z."""

    def __init__(self, data: np.ndarray, folded: bool = False):
        super().__init__((FOLDED_BYTE_VALUES if folded else BYTE_VALUES)[data])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` consecutive values, by doubling."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    span, current = 1, values
    while span * 2 <= width:
        current = np.minimum(current[:-span], current[span:])
        span *= 2
    rest = width - span
    return np.minimum(current[:n], current[rest:rest + n]) if rest else current[:n]


def utf8_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls read as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type)
                                  or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    n = len(column)
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + n + 1]
    if data is None or off[-1] == off[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]], off - off[0]


_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each row: (start, end, first word of each row + total).

    Words never cross rows.
    """
    n = len(data)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z, np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    row_starts = offsets[:-1][offsets[:-1] < n]
    first[row_starts] = inside[row_starts]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    row_ends = offsets[1:][offsets[1:] > 0] - 1
    last[row_ends] = inside[row_ends]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def row_of(counts_index: np.ndarray, total: int) -> np.ndarray:
    """Row number of each item, from the first-item index of every row."""
    return np.repeat(np.arange(len(counts_index) - 1), np.diff(counts_index))[:total]


def value_runs(values: np.ndarray, rows: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, count) of maximal runs of equal value within one row, cut every ``limit`` items."""
    n = len(values)
    if n == 0:
        z = np.zeros(0, dtype=np.int64)
        return z, z
    change = np.empty(n, dtype=bool)
    change[0] = True
    np.not_equal(values[1:], values[:-1], out=change[1:])
    change[1:] |= rows[1:] != rows[:-1]
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, n))
    if (count > limit).any():
        pieces = -(-count // limit)
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        whole_first, whole_count = np.repeat(first, pieces), np.repeat(count, pieces)
        first = whole_first + inner * limit
        count = np.minimum(whole_count - inner * limit, limit)
    return first, count


def row_blocks(offsets: np.ndarray, limit: int):
    """(first row, end row) pairs whose bytes stay near ``limit``; one row may exceed it."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def byte_windows(offsets: np.ndarray, limit: int, overlap: int):
    """(first row, end row, from byte, to byte) pieces of about ``limit`` bytes.

    Whole rows, or parts of one long row that share ``overlap`` bytes, so that
    every window of overlap + 1 bytes starts in exactly one piece.
    """
    for a, b in row_blocks(offsets, limit):
        lo, hi = int(offsets[a]), int(offsets[b])
        if b - a > 1 or hi - lo <= limit + overlap:
            yield a, b, lo, hi
            continue
        for at in range(lo, max(lo + 1, hi - overlap), limit):
            yield a, b, at, min(hi, at + limit + overlap)


def covered_runs(start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of [start, start + length) as disjoint, non-touching runs (start, end), ascending."""
    if not len(start):
        z = np.zeros(0, dtype=np.int64)
        return z, z
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate((start + length)[order])
    first = np.flatnonzero(np.append(True, s[1:] > e[:-1]))
    return s[first], e[np.append(first[1:], len(s)) - 1]
