"""Removal of every byte covered by a repeated ``length``-byte string, through suffix arrays.

Equal windows (``length`` bytes) must meet in one shard without shipping every
window.  Each window belongs to its anchor, the smallest hash of the 64-byte
grams inside it; consecutive windows with the same anchor form one piece
(content-defined, so equal text is cut alike).  Then

1. one shuffle brings small rows (anchor, content hash, place) together, sorted;
   copies inside a batch are collapsed to one witness row beforehand.  A piece
   whose content occurs twice is repeated throughout: no text is needed.
2. What is left are single pieces that share their anchor with other contents,
   and pieces that hold their anchor twice: the edges of repeats.  Their bytes,
   and one copy of each repeated content beside them, go to shards by anchor
   (anchors with very many contents are cut again by a second anchor).
3. Every shard builds a suffix array with common prefixes by external induced
   sorting (``suffix_sort``); neighbouring windows with a common prefix of
   ``length`` bytes are repeats.
4. Spans are gathered per document and joined back to the texts.

Nothing is sampled, capped or compared pairwise.  Places are carried as
(key, hash of the text, offset): rows equal in both are copies of each other
and get the same spans.  Contents are compared by a 64-bit hash next to an equal
64-bit anchor.

Defined results: null text is empty; empty and short texts lose nothing;
repeated rows repeat each other and vanish wherever they have ``length`` bytes;
null keys are kept; a long text is read in overlapping parts, whole; an empty
table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import col, fresh, written
from llm.kernels import (RollingHash, byte_windows, covered_runs, mix64, sliding_min, utf8_column,
                         value_runs)
from llm.suffix_sort import scratch_array, sorted_suffixes
from millstar.session import shuffle_partitions

LENGTH = 200
GRAM = 64
MAX_RUN = 512          # windows in one piece
BATCH_BYTES = 1 << 20
HOT_CONTENTS = 2000    # contents of one anchor beyond which a second anchor splits them
OPEN_ROWS = 100_000    # rows of one anchor held before they are settled early
SHARD_BYTES = 1 << 20  # wished bytes of a shard, with at most SHARDS_PER_PARTITION of them
SHARDS_PER_PARTITION = 4
_SEED = pa.schema([(c, pa.int64()) for c in ("anchor", "content", "key", "text_hash", "start", "n", "weight")])
_MARK = pa.schema([(c, pa.int64()) for c in ("key", "text_hash", "start", "n", "anchor", "kind")])
REPEATED, SINGLE, WITNESS = 0, 1, 2


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def _pieces(data: np.ndarray, row: np.ndarray, room: np.ndarray, length: int, gram: int, second: bool = False):
    """Pieces of a byte buffer: (anchor, content, first window, windows, anchor occurs twice).

    ``row`` numbers the row of every byte and ``room`` the bytes left in it.
    """
    rolling = RollingHash(data)
    grams = rolling.grams(gram)
    if second:
        grams = mix64(grams + np.uint64(0x51ED270B))
    smallest = sliding_min(grams, length - gram + 1)
    at = np.flatnonzero(room[:len(smallest)] >= length)
    first, count = value_runs(smallest[at], row[at], MAX_RUN)
    start = at[first]
    anchor = smallest[start]
    content = rolling.slices(start, start + count + length - 1)
    return anchor, content, start, count, _anchor_twice(grams, smallest, length - gram + 1, anchor, start, count)


def _anchor_twice(grams, smallest, width, anchor, start, count) -> np.ndarray:
    """Whether the grams of a piece hold its anchor at two places or more."""
    if not len(anchor):
        return np.zeros(0, dtype=bool)
    # A gram is some window's smallest iff the largest of its windows' minima equals it.
    edge = np.full(width - 1, ~np.uint64(0))
    largest = ~sliding_min(np.concatenate([edge, ~smallest, edge]), width)
    hits = np.flatnonzero(largest == grams)
    values, slot = np.unique(grams[hits], return_inverse=True)
    span = len(grams) + 1
    keyed = np.sort(slot * span + hits)
    mine = np.searchsorted(values, anchor) * span
    end = start + count + width - 1
    return np.searchsorted(keyed, mine + end) - np.searchsorted(keyed, mine + start) >= 2


def _seed_rows(length: int, gram: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            key = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            text_hash = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b, lo, hi in byte_windows(offsets, BATCH_BYTES, length - 1):
                part = data[lo:hi]
                ends = np.clip(offsets[a + 1:b + 1] - lo, 0, hi - lo)
                begins = np.clip(offsets[a:b] - lo, 0, hi - lo)
                row = np.repeat(np.arange(a, b), ends - begins)
                room = np.repeat(ends, ends - begins) - np.arange(len(part))
                anchor, content, start, count, twice = _pieces(part, row, room, length, gram)
                if len(anchor):
                    r = row[start]
                    yield _collapsed(anchor, content, key[r], text_hash[r], start + lo - offsets[r], count, twice)
    return run


def _collapsed(anchor, content, key, text_hash, start, count, twice) -> pa.RecordBatch:
    """Seed rows of one batch.  Contents seen twice here are repeats already: their places
    become weight-0 rows, merged along the document and keyed by it; one witness goes on."""
    order = np.lexsort((content, anchor))
    anchor, content, key, text_hash, start, count, twice = (
        x[order] for x in (anchor, content, key, text_hash, start, count, twice))
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(anchor)))
    many = np.repeat(size >= 2, size)
    lead = first
    weight = np.where(size >= 2, 2, 1) + 4 * twice[lead]
    columns = [_signed(anchor[lead]), _signed(content[lead]), key[lead], text_hash[lead], start[lead],
               count[lead], weight]
    if many.any():
        k, h, s, n = key[many], text_hash[many], start[many], count[many]
        o = np.lexsort((s, h, k))
        k, h, s, n = k[o], h[o], s[o], n[o]
        gap = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (s[1:] > (s + n)[:-1]))
        f = np.flatnonzero(gap)
        last = np.append(f[1:], len(s)) - 1
        spread = _signed(mix64((k[f] * 31 + h[f]).astype(np.int64).view(np.uint64)))
        zero = np.zeros(len(f), dtype=np.int64)
        columns = [np.concatenate(x) for x in zip(columns, [spread, zero, k[f], h[f], s[f],
                                                            (s + n)[last] - s[f], zero])]
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], schema=_SEED)


class _Settler:
    """Streams seed rows sorted by (anchor, content) and settles every piece.

    Holds the rows of the anchor that may go on in the next batch; beyond
    ``OPEN_ROWS`` its finished contents are settled early, as one of several.
    """

    def __init__(self):
        self.held = None
        self.several = None  # anchor already known to have other contents

    def feed(self, rows: np.ndarray, final: bool):
        """rows: int64 matrix (7, n) in the order of the seed schema."""
        passing = rows[6] == 0
        if passing.any():
            yield self._marks(rows[:, passing], REPEATED)
            rows = rows[:, ~passing]
        if self.held is not None:
            rows = np.concatenate([self.held, rows], axis=1)
            self.held = None
        if not rows.shape[1]:
            return
        anchor, content = rows[0], rows[1]
        early = {int(self.several)} if self.several is not None else set()
        if not final:
            cut = int(np.searchsorted(anchor[::-1] != anchor[-1], True))
            cut = len(anchor) - cut if (anchor != anchor[-1]).any() else 0
            if len(anchor) - cut > OPEN_ROWS:
                same = np.flatnonzero((anchor == anchor[-1]) & (content != content[-1]))
                done = rows[:, :same[-1] + 1] if len(same) else rows[:, :cut]
                rest = rows[:, done.shape[1]:]
                several = len(same) > 0 or self.several == anchor[-1]
                if done.shape[1]:
                    yield from self._settle(done, early | {int(anchor[-1])} if several else early)
                if several:
                    self.several = anchor[-1]
                if rest.shape[1] > 1:  # one content with very many places
                    plain = rest[:, rest[6] & 3 == 1]
                    if plain.shape[1]:
                        yield self._marks(plain, REPEATED)
                    rest = rest[:, :1].copy()
                    rest[6] = 2
                self.held = rest
                return
            self.held = rows[:, cut:]
            rows = rows[:, :cut]
            if not rows.shape[1]:
                return
        yield from self._settle(rows, early)

    @staticmethod
    def _marks(rows: np.ndarray, kind) -> pa.RecordBatch:
        n = rows.shape[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[k]) for k in (2, 3, 4, 5, 0)] + [pa.array(np.full(n, kind, dtype=np.int64))],
            schema=_MARK)

    def _settle(self, rows: np.ndarray, several: set[int]):
        anchor, content, weight, twice = rows[0], rows[1], rows[6] & 3, rows[6] >= 4
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, content[1:] != content[:-1])
        group = np.cumsum(new) - 1
        total = np.bincount(group, weights=weight).astype(np.int64)
        lead = np.flatnonzero(new)
        at = np.cumsum(new_anchor)[lead] - 1
        contents = np.bincount(at)
        singles = np.bincount(at, weights=total == 1)
        # Other chunks of an anchor settled early may hold singles: all its repeated contents are witnesses.
        early = np.isin(anchor[lead], np.array(sorted(several), dtype=np.int64))
        crowd = (contents[at] >= 2) | early
        repeated = (total[group] >= 2) & (weight == 1)
        if repeated.any():
            yield self._marks(rows[:, repeated], REPEATED)
        single = lead[(total == 1) & (crowd | twice[lead])]
        if len(single):
            yield self._marks(rows[:, single], SINGLE)
        beside = lead[(total >= 2) & crowd & ((singles[at] > 0) | early)]
        if len(beside):
            yield self._marks(rows[:, beside], WITNESS)


def _settled(batches):
    settler = _Settler()
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        yield from settler.feed(rows, final=False)
    yield from settler.feed(np.zeros((7, 0), dtype=np.int64), final=True)


_PIECE = pa.schema([("shard", pa.int64()), ("key", pa.int64()), ("text_hash", pa.int64()), ("start", pa.int64()),
                    ("n", pa.int64()), ("kind", pa.int64()), ("piece", pa.binary())])


def _cut_pieces(length: int, gram: int):
    """Cut the marked pieces out of their texts; those of hot anchors are cut again."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            for i in range(batch.num_rows):
                text = texts[i].as_py() or b""
                key, text_hash = batch.column("key")[i].as_py(), batch.column("text_hash")[i].as_py()
                marks = batch.column("marks")[i].values
                out = []
                for start, n, anchor, kind, hot in zip(*[marks.field(k).to_pylist() for k in range(5)]):
                    piece = text[start:start + n + length - 1]
                    if not hot:
                        out.append((anchor, key, text_hash, start, n, kind, piece))
                        continue
                    data = np.frombuffer(piece, np.uint8)
                    size = len(data)
                    again, _, at, count, _ = _pieces(data, np.zeros(size, np.int64), size - np.arange(size),
                                                     length, gram // 2, second=True)
                    shards = _signed(mix64(again ^ np.uint64(anchor & 0xFFFFFFFFFFFFFFFF)))
                    out += [(int(x), key, text_hash, start + int(s), int(c), kind,
                             piece[int(s):int(s) + int(c) + length - 1]) for x, s, c in zip(shards, at, count)]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*out), _PIECE.types)], schema=_PIECE)
    return run


_SPAN = pa.schema([(c, pa.int64()) for c in ("key", "text_hash", "start", "n")])


def _shard_spans(length: int):
    """One shard: its pieces' bytes in one text, suffixes of all windows, neighbours compared."""
    def run(batches):
        sizes, heads, chunks = [], [], []
        total = 0
        for batch in batches:
            data, offsets = utf8_column(batch.column("piece"))
            stored = scratch_array(len(data), np.uint8)
            stored[:] = data
            chunks.append(stored)
            sizes.append(np.diff(offsets))
            heads.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 6)]))
            total += len(data)
        if not total:
            return
        text = scratch_array(total + length + 8, np.uint8)
        at = 0
        for c in chunks:
            text[at:at + len(c)] = c
            at += len(c)
        del chunks
        head, sizes = np.concatenate(heads, axis=1), np.concatenate(sizes)
        begin = np.cumsum(sizes) - sizes
        windows = head[3]
        ends = np.cumsum(windows)
        positions = scratch_array(int(ends[-1]), np.int64)
        repeated = scratch_array(int(ends[-1]), np.uint8)
        step = max(1, (1 << 19) // int(windows.max()))
        for a in range(0, len(windows), step):
            n = windows[a:a + step]
            lo = int(ends[a] - windows[a])
            inner = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            positions[lo:lo + len(inner)] = np.repeat(begin[a:a + step], n) + inner
        before = None
        for place, prefix in sorted_suffixes(text, total, positions, length):
            index = np.searchsorted(positions, place)
            hit = prefix >= length
            repeated[index[hit]] = 1
            previous = np.append(before if before is not None else 0, index[:-1])
            repeated[previous[hit]] = 1
            before = index[-1]
        for a in range(0, len(windows), step):
            n = windows[a:a + step]
            lo = int(ends[a] - windows[a])
            flags = np.asarray(repeated[lo:lo + int(n.sum())])
            of = np.repeat(np.arange(a, a + len(n)), n)
            flags = flags.astype(bool) & (head[4][of] == SINGLE)
            first, count = value_runs(flags.astype(np.uint8), of, 1 << 40)
            on = flags[first]
            first, count = first[on], count[on]
            if len(first):
                p = of[first]
                start = head[2][p] + first + lo - (ends[p] - windows[p])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x.astype(np.int64)) for x in (head[0][p], head[1][p], start, count)], schema=_SPAN)
    return run


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                   gram: int = GRAM, partitions: int | None = None) -> DataFrame:
    """(key, text_hash, spans array<struct<start, n>>): first bytes of repeated windows, by document.

    ``key`` reads 0 where null; ``text_hash`` is ``xxhash64(text)``.
    """
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    docs = df.select(F.coalesce(col(key).cast("long"), F.lit(0)).alias("key"),
                     F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    seeds = docs.mapInArrow(_seed_rows(length, gram), _ddl(_SEED))
    marks = written(seeds.repartition(n, "anchor").sortWithinPartitions("anchor", "content")
                    .mapInArrow(_settled, _ddl(_MARK)), "suffix-marks")
    edges = marks.where(F.col("kind") != REPEATED)
    hot = edges.groupBy("anchor").count().where(F.col("count") > HOT_CONTENTS).select(
        "anchor", F.lit(True).alias("hot"))
    listed = (edges.join(hot, "anchor", "left")
              .groupBy("key", "text_hash")
              .agg(F.collect_list(F.struct("start", "n", "anchor", "kind",
                                           F.coalesce("hot", F.lit(False)).alias("hot"))).alias("marks")))
    pieces = docs.join(listed, ["key", "text_hash"]).mapInArrow(_cut_pieces(length, gram), _ddl(_PIECE))
    bytes_left = edges.agg(F.sum(F.col("n") + length - 1)).first()[0] or 0
    shards = max(n, min(n * SHARDS_PER_PARTITION, bytes_left // SHARD_BYTES))
    spans = pieces.repartition(shards, "shard").mapInArrow(_shard_spans(length), _ddl(_SPAN))
    both = marks.where(F.col("kind") == REPEATED).select(*_SPAN.names).unionByName(spans)
    return both.groupBy("key", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def _with_spans(df: DataFrame, key: str, text: str, length: int, **options) -> tuple[DataFrame, str]:
    """``df`` left-joined with its spans (null where none) in a fresh column."""
    found = written(repeated_spans(df, key, text, length, **options), "suffix-spans")
    k, h, s = fresh(df, "sd_key"), fresh(df, "sd_hash"), fresh(df, "sd_spans")
    found = found.toDF(k, h, s)
    keyed = (df.withColumn(k, F.coalesce(col(key).cast("long"), F.lit(0)))
               .withColumn(h, F.xxhash64(col(text))))
    return keyed.join(found, [k, h], "left").drop(k, h), s


def _kept(text: bytes, spans, length: int) -> tuple[bytes, int, int]:
    if not spans:
        return text, 0, 0
    pairs = np.array([(x["start"], x["n"]) for x in spans], dtype=np.int64)
    start, end = covered_runs(pairs[:, 0], pairs[:, 1] + length - 1)
    keep, at = [], 0
    for a, b in zip(start.tolist(), end.tolist()):
        keep.append(text[at:a])
        at = b
    keep.append(text[at:])
    return b"".join(keep), int((end - start).sum()), len(start)


def dedup_report(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: the key, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256."""
    joined, s = _with_spans(df.select(col(key), col(text)), key, text, length)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out = []
            for i in range(batch.num_rows):
                whole = texts[i].as_py() or b""
                kept, removed, runs = _kept(whole, batch.column(2)[i].as_py(), length)
                out.append((len(whole), removed, runs, hashlib.sha256(kept).hexdigest()))
            if out:
                sizes, removed, runs, digest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(runs, pa.int64()), pa.array(digest)],
                    names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    return joined.select(col(key).cast("long"), col(text), col(s)).mapInArrow(
        run, f"`{key}` long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def remove_repeats(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with the repeated bytes gone from ``text`` (null stays null; bytes of a character
    cut in two go with it)."""
    joined, s = _with_spans(df, key, text, length)
    place = joined.columns.index(text)

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(place).cast(pa.binary()), batch.column(batch.num_columns - 1)
            new = []
            for i in range(batch.num_rows):
                whole = texts[i].as_py()
                new.append(None if whole is None else
                           _kept(whole, spans[i].as_py(), length)[0].decode("utf-8", "ignore"))
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
    ordered = joined.select(*[col(c) for c in df.columns], col(s))
    return ordered.mapInArrow(run, df.schema)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return dedup_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_suffix_dedup": op1_suffix_dedup}
ORACLE: dict[str, str] = {}
