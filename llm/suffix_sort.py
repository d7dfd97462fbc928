"""External induced suffix sorting with common prefixes, for one shard of text.

Suffixes are ordered by their first ``depth`` bytes (ties beyond that are
arbitrary), together with the common prefix of neighbours, capped at ``depth``.

Every symbol is S (its suffix is smaller than the next one) or L.  The leftmost
S of every run (LMS) is a sample.  The method:

1. name each sample's substring up to the next sample by its rank;
2. if names repeat, recurse on the string of names, at most half as long;
3. the samples' order and common prefixes are now known; every other suffix is
   the tuple (its symbols up to the next sample, that sample's rank), and the
   common prefix of two neighbours with the same symbols is the length of those
   symbols plus the smallest common prefix carried between the two ranks.

Tuples go through ``TupleQueue``, a bulk priority queue: runs of bounded size
are sorted and spilled to disk and drained in order by block-wise merging.
Level arrays are files mapped into memory and read in blocks, so a shard may be
far larger than memory.  All files are unlinked at once and vanish with the task.
"""

from __future__ import annotations

import os
import tempfile

import numpy as np

BLOCK = 1 << 19
RUN = 1 << 20
IN_MEMORY = 1 << 23
_TUPLE = np.dtype([("w", np.uint64), ("t", np.uint64), ("i", np.int64)])


def scratch_array(n: int, dtype) -> np.ndarray:
    """An array in an unlinked temporary file (in memory up to ``IN_MEMORY`` bytes)."""
    dtype = np.dtype(dtype)
    if n * dtype.itemsize <= IN_MEMORY:
        return np.zeros(n, dtype=dtype)
    fd, name = tempfile.mkstemp(prefix="suffix-")
    os.close(fd)
    try:
        return np.memmap(name, dtype=dtype, mode="w+", shape=(n,))
    finally:
        os.unlink(name)


class TupleQueue:
    """Bulk priority queue of (w, t, i) tuples, smallest (w, t) first, spilled to disk."""

    def __init__(self, run: int = RUN):
        self.run, self.held, self.size, self.runs = run, [], 0, []

    def push(self, w: np.ndarray, t: np.ndarray, i: np.ndarray) -> None:
        block = np.empty(len(w), dtype=_TUPLE)
        block["w"], block["t"], block["i"] = w, t, i
        self.held.append(block)
        self.size += len(block)
        if self.size >= self.run:
            self._spill()

    @staticmethod
    def _sorted(block: np.ndarray) -> np.ndarray:
        return block[np.lexsort((block["t"], block["w"]))]

    def _spill(self) -> None:
        block = self._sorted(np.concatenate(self.held))
        stored = scratch_array(len(block), _TUPLE)
        stored[:] = block
        self.runs.append(stored)
        self.held, self.size = [], 0

    def drain(self):
        """Blocks of tuples in order; equal (w, t) never straddle two blocks' order."""
        if not self.runs:
            if self.held:
                yield self._sorted(np.concatenate(self.held))
            self.held = []
            return
        if self.held:
            self._spill()
        runs, self.runs = self.runs, []
        at = [0] * len(runs)
        step = max(1, self.run // len(runs))
        while True:
            heads = [(k, run[at[k]:at[k] + step]) for k, run in enumerate(runs) if at[k] < len(run)]
            if not heads:
                return
            # Nothing beyond the smallest last key of a head block can be missing from the heads.
            ends = [(int(h["w"][-1]), int(h["t"][-1])) for k, h in heads if at[k] + len(h) < len(runs[k])]
            if ends:
                cw, ct = min(ends)
                cw, ct = np.uint64(cw), np.uint64(ct)
                part = []
                for k, h in heads:
                    take = int(np.count_nonzero((h["w"] < cw) | ((h["w"] == cw) & (h["t"] <= ct))))
                    part.append(h[:take])
                    at[k] += take
            else:
                part = [h for _, h in heads]
                for k, h in heads:
                    at[k] += len(h)
            yield self._sorted(np.concatenate(part))


class RangeMinimum:
    """Minimum of any slice of a small-integer array, from doubled windows."""

    def __init__(self, values: np.ndarray):
        self.rows = [values]
        span = 1
        while span * 2 <= len(values):
            last = self.rows[-1]
            row = scratch_array(len(last) - span, values.dtype)
            for a in range(0, len(row), BLOCK):
                b = min(a + BLOCK, len(row))
                np.minimum(last[a:b], last[a + span:b + span], out=row[a:b])
            self.rows.append(row)
            span *= 2

    def query(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum over [first, last], first <= last."""
        out = np.zeros(len(first), dtype=self.rows[0].dtype)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            on = level == k
            row = self.rows[k]
            out[on] = np.minimum(row[first[on]], row[last[on] - (1 << int(k)) + 1])
        return out


def _byte_lcp(text: np.ndarray, n: int, a: np.ndarray, b: np.ndarray, start, depth: int) -> np.ndarray:
    """Common prefix of text[a:] and text[b:], capped; ``text`` is padded by depth + 8 bytes."""
    out = np.zeros(len(a), dtype=np.int64)
    out += start
    live = np.arange(len(a))
    step = np.arange(8)
    while len(live):
        live = live[out[live] < depth]
        x = text[(a[live] + out[live])[:, None] + step]
        y = text[(b[live] + out[live])[:, None] + step]
        differ = x != y
        same = np.where(differ.any(axis=1), differ.argmax(axis=1), 8)
        out[live] += same
        live = live[same == 8]
    return np.minimum(np.minimum(out, depth), n - np.maximum(a, b))


class _Level:
    """One string of the recursion: symbols, types, samples and (later) the samples' ranks."""

    def __init__(self, symbols: np.ndarray, byte_at: np.ndarray | None, text: np.ndarray, n_bytes: int,
                 depth: int, run: int):
        self.n, self.byte_at, self.text, self.n_bytes = len(symbols), byte_at, text, n_bytes
        self.depth, self.run = depth, run
        n = self.n
        top = max([int(symbols[a:a + BLOCK].max()) for a in range(0, n, BLOCK)], default=0)
        self.bits = (2 * top + 2).bit_length()
        self.count = max(1, 63 // self.bits)
        # code = 2 * symbol + type + 1, and 0 for the end of the string
        self.code = scratch_array(n + 1, np.uint16 if self.bits <= 16 else np.uint64)
        chunks, carry = [], 0
        for b in range(n, 0, -BLOCK):
            a = max(0, b - BLOCK)
            here = symbols[a:b].astype(np.int64)
            after = np.append(here[1:], symbols[b] if b < n else -1)
            known = np.flatnonzero(here != after)
            kind = np.full(b - a, carry, dtype=np.int64)
            if len(known):
                upto = np.searchsorted(known, np.arange(b - a))
                inside = upto < len(known)
                at = known[upto[inside]]
                kind[inside] = here[at] < after[at]
            carry = int(kind[0])
            self.code[a:b] = (2 * here + kind + 1).astype(self.code.dtype)
        for a in range(0, n, BLOCK):
            kind = (self.code[max(a - 1, 0):min(a + BLOCK, n)] - 1) & 1
            chunks.append(np.flatnonzero((kind[1:] == 1) & (kind[:-1] == 0)) + max(a - 1, 0) + 1)
        self.samples = scratch_array(sum(map(len, chunks)), np.int64)
        at = 0
        for c in chunks:
            self.samples[at:at + len(c)] = c
            at += len(c)
        self.rank = self.lcp = None

    def bytes_of(self, position: np.ndarray) -> np.ndarray:
        if self.byte_at is None:
            return position
        out = np.full(len(position), self.n_bytes, dtype=np.int64)
        inside = position < self.n
        out[inside] = self.byte_at[position[inside]]
        return out

    def _stop(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the next sample, its position; the string's end after the last)."""
        j = np.searchsorted(self.samples, position, side="right")
        stop = np.full(len(position), self.n, dtype=np.int64)
        inside = j < len(self.samples)
        stop[inside] = self.samples[j[inside]]
        return j, stop

    def _word(self, position: np.ndarray, stop: np.ndarray) -> np.ndarray:
        w = np.zeros(len(position), dtype=np.uint64)
        for k in range(self.count):
            at = position + k
            v = self.code[np.minimum(at, self.n)].astype(np.uint64)
            v[at > stop] = 0
            w = (w << np.uint64(self.bits)) | v
        return w

    def ordered(self, positions: np.ndarray, use_rank: bool, spent: int = 0):
        """Sorted blocks of tuples over ``positions``: t is the rank of what follows the first word."""
        queue = TupleQueue(self.run)
        far, starts = [], [0]
        for a in range(0, len(positions), BLOCK):
            p = np.asarray(positions[a:a + BLOCK])
            far.append(p[self._stop(p)[1] - p >= self.count] + self.count)
            starts.append(starts[-1] + len(far[-1]))
        tails = scratch_array(starts[-1], np.int64)
        for a, f in zip(starts, far):
            tails[a:a + len(f)] = f
        del far
        tail_rank = self.ranked(tails, use_rank, spent + self.count)[0] if len(tails) else None
        for k, a in enumerate(range(0, len(positions), BLOCK)):
            p = np.asarray(positions[a:a + BLOCK])
            j, stop = self._stop(p)
            t = np.zeros(len(p), dtype=np.uint64)
            long = stop - p >= self.count
            if use_rank:
                inside = ~long & (stop < self.n)
                t[inside] = self.rank[j[inside]]
            if tail_rank is not None:
                t[long] = tail_rank[starts[k]:starts[k + 1]]
            queue.push(self._word(p, stop), t, np.arange(a, a + len(p)))
        return queue.drain()

    def ranked(self, positions: np.ndarray, use_rank: bool, spent: int = 0):
        """(dense rank of each position's key, order of the positions, number of ranks)."""
        out = scratch_array(len(positions), np.int64)
        if spent >= self.depth:
            return out, None, 1
        order = scratch_array(len(positions), np.int64)
        at, name, before = 0, -1, None
        for block in self.ordered(positions, use_rank, spent):
            new = np.empty(len(block), dtype=bool)
            new[0] = before is None or (block["w"][0], block["t"][0]) != before
            new[1:] = (block["w"][1:] != block["w"][:-1]) | (block["t"][1:] != block["t"][:-1])
            names = np.cumsum(new) + name
            out[block["i"]] = names
            order[at:at + len(block)] = block["i"]
            at, name, before = at + len(block), int(names[-1]), (block["w"][-1], block["t"][-1])
        return out, order, name + 1

    def resolve_samples(self) -> None:
        """Rank 1.. of every sample (0 is the string's end) and common prefixes by rank."""
        m = len(self.samples)
        self.rank = scratch_array(m, np.int64)
        lcp = scratch_array(m + 1, np.uint16)
        if m:
            names, order, distinct = self.ranked(self.samples, use_rank=False)
            if distinct < m:
                byte_at = scratch_array(m, np.int64)
                for a in range(0, m, BLOCK):
                    byte_at[a:a + BLOCK] = self.bytes_of(self.samples[a:a + BLOCK])
                order, below = _sort_all(names, byte_at, self.text, self.n_bytes, self.depth, self.run)
                lcp[1:] = below
            else:
                for a in range(1, m, BLOCK):
                    b = min(a + BLOCK, m)
                    x = self.bytes_of(self.samples[order[a - 1:b - 1]])
                    y = self.bytes_of(self.samples[order[a:b]])
                    lcp[a + 1:b + 1] = _byte_lcp(self.text, self.n_bytes, x, y, 0, self.depth)
            for a in range(0, m, BLOCK):
                o = order[a:a + BLOCK]
                self.rank[o] = np.arange(a + 1, a + 1 + len(o))
        self.lcp = RangeMinimum(lcp)

    def induced(self, positions: np.ndarray):
        """Blocks (index into positions, common prefix with the one before), in suffix order."""
        before = None
        for block in self.ordered(positions, use_rank=True):
            if before is not None:
                block = np.concatenate([before, block])
            w, t, i = block["w"], block["t"], block["i"]
            p = np.asarray(positions[i])
            _, stop = self._stop(p)
            a, b = p[:-1], p[1:]
            short = stop - p < self.count
            same = w[1:] == w[:-1]
            lcp = np.zeros(len(block) - 1, dtype=np.int64)
            carried = np.flatnonzero(same & short[1:])
            if len(carried):
                low, high = t[:-1][carried].astype(np.int64) + 1, t[1:][carried].astype(np.int64)
                length = self.bytes_of(stop[1:][carried]) - self.bytes_of(b[carried])
                lcp[carried] = np.minimum(length + self.lcp.query(np.minimum(low, high), high), self.depth)
            rest = np.flatnonzero(~(same & short[1:]))
            if len(rest):
                lcp[rest] = _byte_lcp(self.text, self.n_bytes, self.bytes_of(a[rest]),
                                      self.bytes_of(b[rest]), 0, self.depth)
            if before is None:
                yield i, np.concatenate([[0], lcp])
            else:
                yield i[1:], lcp
            before = block[-1:]


def _sort_all(symbols, byte_at, text, n_bytes, depth, run):
    """(order, common prefix with the one before) of all suffixes of ``symbols``."""
    level = _Level(symbols, byte_at, text, n_bytes, depth, run)
    level.resolve_samples()
    n = level.n
    order, lcp, at = scratch_array(n, np.int64), scratch_array(n, np.uint16), 0
    every = scratch_array(n, np.int64)
    for a in range(0, n, BLOCK):
        every[a:a + BLOCK] = np.arange(a, min(a + BLOCK, n))
    for i, prefix in level.induced(every):
        order[at:at + len(i)], lcp[at:at + len(i)] = i, prefix
        at += len(i)
    return order, lcp


def sorted_suffixes(text: np.ndarray, n: int, positions: np.ndarray, depth: int, run: int = RUN):
    """Blocks (position, common prefix with the suffix before) of ``positions`` in suffix order.

    ``text`` is a byte array of at least n + depth + 8 bytes whose tail is padding.
    """
    level = _Level(text[:n], None, text, n, depth, run)
    level.resolve_samples()
    for i, prefix in level.induced(positions):
        yield np.asarray(positions[i]), prefix
