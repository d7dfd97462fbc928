"""Substring dedup on words: seed and extend over winnowed anchors.

A window is ``length`` consecutive words.  A word goes when a window that
covers it also starts in a document with a smaller key.

Seeds.  The anchor of a window is the smallest hash of the ``gram``-word grams
in it (winnowing: every window holds its anchor, so no repeat is missed);
consecutive windows with the same anchor form one seed.  One shuffle joins all
documents on the anchors, sorted by (anchor, content, key).  Copies of a whole
seed are settled there, and within a batch even before it: every place in a
document after the first is a repeat.

Extension.  Seeds that share their anchor with other contents stay open and are
extended from the anchor to both sides.  A window has ``length - gram`` words
beside its anchor, so half of them lie on one side: places meet again on the
anchor and that arm (left or right), carrying the few words further out and
those on the other side.  There all places of an arm are extended together, one
word at a time to either side: each step splits the classes of places that
agree so far, so no pair is listed.  Places that agree over ``length`` words in
some class hold a repeat; consecutive ones make the maximal repeat that is kept.
An arm that would fill more than HOT_SLACK average tasks, or a group of more
than OPEN_ROWS places, is not extended in one task: its extensions go out as
hashes, and one aggregate over (anchor, extension) finds the smallest key of
each.

Spans are judged on the input.  Words and contents are compared by 62-bit hashes.

Defined results: null or empty text has no words; a null key is smaller than no
other and others are not compared with it as smaller; rows that share key and
text get the same spans, and a window is no repeat of one in the same key;
empty tables give empty results; other columns pass through; texts are read whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import col, fresh, written
from llm.kernels import (RollingHash, SequenceHash, covered_runs, mix64, row_blocks, row_of, sliding_min,
                         utf8_column, value_runs, word_spans)
from millstar.session import shuffle_partitions

LENGTH = 13
GRAM = 4
MAX_RUN = 64
BATCH_BYTES = 1 << 20
OPEN_ROWS = 100_000
HOT_SLACK = 2              # average tasks that one arm's places may fill
NO_KEY = (1 << 63) - 1     # stands for a null key: smaller than no other
REPEATED, OPEN = 0, 1
_SEED = pa.schema([(c, pa.int64()) for c in ("anchor", "content", "key", "text_hash", "start", "n")])
_MARK = pa.schema([(c, pa.int64()) for c in ("key", "text_hash", "start", "n", "anchor", "kind")])
_REPEAT = pa.schema([(c, pa.int64()) for c in ("anchor", "extension", "key", "text_hash", "start", "n")])
_PLACE = ("anchor", "arm", "key", "text_hash", "base", "side", "low", "high")  # and the words beside the arm
LEFT, RIGHT = 0, 1


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} long" for f in schema)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def _batch(columns, schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64, copy=False)) for c in columns], schema=schema)


def _word_hashes(data: np.ndarray, offsets: np.ndarray):
    start, end, first = word_spans(data, offsets)
    return RollingHash(data).slices(start, end), first


def _seed_rows(length: int, gram: int):
    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column(2))
            key = batch.column(0).to_numpy(zero_copy_only=False)
            text_hash = batch.column(1).to_numpy(zero_copy_only=False)
            for a, b in row_blocks(offsets, BATCH_BYTES):
                words, first = _word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                sequence = SequenceHash(words)
                smallest = sliding_min(sequence.grams(gram), length - gram + 1)
                row = row_of(first, len(words))
                n = len(smallest)
                at = np.flatnonzero(first[row[:n] + 1] - np.arange(n) >= length)
                lead, count = value_runs(smallest[at], row[at], MAX_RUN)
                if not len(lead):
                    continue
                start = at[lead]
                r = row[start]
                yield from _collapsed(smallest[start], sequence.slices(start, start + count + length - 1),
                                      key[a:b][r], text_hash[a:b][r], start - first[r], count)
    return run


def _collapsed(anchor, content, key, text_hash, start, count):
    """Seeds of one batch.  Places after the batch's first document of a content are repeats
    already: they go on merged, keyed by document, with n < 0, and meet no anchor."""
    anchor, content = _signed(anchor), _signed(content)
    order = np.lexsort((key, content, anchor))
    rows = [x[order] for x in (anchor, content, key, text_hash, start, count)]
    anchor, content, key = rows[:3]
    new = np.append(True, (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1]))
    later = key > key[np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
    yield _batch([x[~later] for x in rows], _SEED)
    if later.any():
        k, h, s, n = (x[later] for x in rows[2:])
        o = np.lexsort((s, h, k))
        k, h, s, n = k[o], h[o], s[o], n[o]
        gap = np.append(True, (k[1:] != k[:-1]) | (h[1:] != h[:-1]) | (s[1:] > (s + n)[:-1]))
        f = np.flatnonzero(gap)
        last = np.append(f[1:], len(s)) - 1
        spread = _signed(mix64((k[f] * 31 + h[f]).astype(np.int64).view(np.uint64)))
        yield _batch([spread, np.zeros(len(f)), k[f], h[f], s[f], s[f] - (s + n)[last]], _SEED)


class _Settler:
    """Streams seeds sorted by (anchor, content, key); holds only the anchor that may go on."""

    def __init__(self):
        self.held = None
        self.several = None  # an anchor settled early: known to have other contents

    def feed(self, rows: np.ndarray, final: bool):
        """rows: int64 matrix (6, n) in the order of the seed schema."""
        if self.held is not None:
            rows, self.held = np.concatenate([self.held, rows], axis=1), None
        passing = rows[5] < 0
        if passing.any():
            done = rows[:, passing]
            yield _batch([done[2], done[3], done[4], -done[5], done[0], np.full(done.shape[1], REPEATED)], _MARK)
            rows = rows[:, ~passing]
        if not rows.shape[1]:
            return
        cut = rows.shape[1]
        if not final:
            cut = int(np.searchsorted(rows[0], rows[0][-1]))
            if rows.shape[1] - cut > OPEN_ROWS:
                yield from self._settle(rows, int(rows[0][-1]))
                self.several = int(rows[0][-1])
                # The open content's first document is remembered by one row, already settled.
                same = rows[:, (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1])]
                self.held = same[:, :1].copy()
                return
            self.held = rows[:, cut:]
        if cut:
            yield from self._settle(rows[:, :cut], self.several)

    @staticmethod
    def _settle(rows: np.ndarray, several: int | None):
        anchor, content, key = rows[:3]
        new_anchor = np.append(True, anchor[1:] != anchor[:-1])
        new = new_anchor | np.append(True, content[1:] != content[:-1])
        place = np.arange(len(new))
        earliest = key[np.maximum.accumulate(np.where(new, place, 0))]
        group = np.cumsum(new_anchor) - 1
        low = np.minimum.reduceat(earliest, np.flatnonzero(new_anchor))[group]
        high = np.maximum.reduceat(earliest, np.flatnonzero(new_anchor))[group]
        # Contents of one anchor that first occur in different documents must be extended.
        extend = low < high
        if several is not None:
            extend |= anchor == several
        later = key > earliest
        for chosen, kind in ((later, REPEATED), (~later & extend, OPEN)):
            if chosen.any():
                r = rows[:, chosen]
                yield _batch([r[2], r[3], r[4], r[5], r[0], np.full(r.shape[1], kind)], _MARK)


def _settled(batches):
    settler = _Settler()
    for batch in batches:
        yield from settler.feed(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]), False)
    yield from settler.feed(np.zeros((6, 0), dtype=np.int64), True)


class _Arms:
    """How a window's words beside its anchor are shared out.

    A window with ``left`` words before its anchor belongs to the left arm when they are at least
    ``half``, else to the right arm.  Step i of an arm takes i words beyond it (near) and
    ``depth[side] - i`` words on the other side of the anchor (far).
    """

    def __init__(self, length: int, gram: int):
        self.gram = gram
        self.other = length - gram
        self.half = (self.other + 1) // 2
        self.arm = (self.half, self.other - self.half + 1)
        self.depth = (self.other - self.half, self.half - 1)
        self.words = max(self.depth)
        self.schema = pa.schema([(c, pa.int64()) for c in _PLACE]
                                + [(f"{w}{i}", pa.int64()) for w in ("near", "far") for i in range(self.words)])

    def step(self, side: int, left: np.ndarray) -> np.ndarray:
        return left - self.half if side == LEFT else self.half - 1 - left

    def start(self, side, base, step):
        """First word of the window of a step; ``base`` is that of step 0."""
        return np.where(side == LEFT, base - step, base + step)


def _places(length: int, gram: int):
    """The anchors of all open seeds with the words around them, one row per arm that a window needs."""
    arms = _Arms(length, gram)

    def rows_of(side, words, sequence, anchor, row, first, at, left, key, text_hash):
        chosen = np.flatnonzero((left >= arms.half) == (side == LEFT))
        if not len(chosen):
            return None
        anchor, row, at, left = anchor[chosen], row[chosen], at[chosen], left[chosen]
        place = at + left
        lead = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (row[1:] != row[:-1])
                                        | (at[1:] != at[:-1] + 1)))
        last = np.append(lead[1:], len(at)) - 1
        steps = np.sort([arms.step(side, left[lead]), arms.step(side, left[last])], axis=0)
        row, anchor, place = row[lead], anchor[lead], place[lead]
        word = first[row] + place
        if side == LEFT:
            arm = sequence.slices(word - arms.half, word)
            near, far, base = word - arms.half - 1, word + gram, place - arms.half
            out = -1
        else:
            arm = sequence.slices(word + gram, word + gram + arms.arm[RIGHT])
            near, far, base = word + gram + arms.arm[RIGHT], word - 1, place - arms.half + 1
            out = 1
        columns = [anchor, _signed(mix64(arm + np.uint64(side))), key[row], text_hash[row], base,
                   np.full(len(row), side), steps[0], steps[1]]
        for origin, way, reach in ((near, out, steps[1]), (far, -out, arms.depth[side] - steps[0])):
            for i in range(arms.words):
                # Words that no window of this place reaches may lie outside the text: they read 0.
                inside = i < reach
                columns.append(np.where(inside, _signed(words)[np.where(inside, origin + way * i, 0)], 0))
        return _batch(columns, arms.schema)

    def run(batches):
        for batch in batches:
            data, offsets = utf8_column(batch.column("text"))
            marks = batch.column("marks")
            key = batch.column("key").to_numpy(zero_copy_only=False)
            text_hash = batch.column("text_hash").to_numpy(zero_copy_only=False)
            flat, lists = marks.flatten(), np.diff(marks.offsets.to_numpy())
            begin = np.cumsum(lists) - lists
            start, n, anchor = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            for a, b in row_blocks(offsets, BATCH_BYTES):
                words, first = _word_hashes(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                sequence = SequenceHash(words)
                grams = _signed(sequence.grams(gram))
                lo, hi = begin[a], begin[b - 1] + lists[b - 1]
                count = n[lo:hi]
                of = np.repeat(np.arange(hi - lo), count)
                row = np.repeat(np.arange(b - a), lists[a:b])[of]
                at = start[lo:hi][of] + np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
                wanted, from_word = anchor[lo:hi][of], first[row] + at
                left = np.zeros(len(at), dtype=np.int64)
                for i in range(arms.other, -1, -1):  # the leftmost of equal anchors
                    left[grams[from_word + i] == wanted] = i
                for side in (LEFT, RIGHT):
                    found = rows_of(side, words, sequence, wanted, row, first, at, left, key[a:b], text_hash[a:b])
                    if found is not None:
                        yield found
    return run, arms.schema


def _split(classes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Classes of places that agree in their class and in one more word."""
    order = np.lexsort((word, classes))
    c, w = classes[order], word[order]
    out = np.empty(len(classes), dtype=np.int64)
    out[order] = np.cumsum(np.append(True, (c[1:] != c[:-1]) | (w[1:] != w[:-1])))
    return out


class _Extender:
    """Streams places sorted by (anchor, arm); holds only the group that may go on."""

    def __init__(self, length: int, gram: int):
        self.arms = _Arms(length, gram)
        self.held = np.zeros((len(self.arms.schema), 0), dtype=np.int64)
        self.wide = None  # (anchor, arm) of a group beyond OPEN_ROWS that may go on

    def feed(self, rows: np.ndarray, final: bool):
        rows = np.concatenate([self.held, rows], axis=1)
        if self.wide is not None:
            more = (rows[0] == self.wide[0]) & (rows[1] == self.wide[1])
            yield from self._hashed(rows[:, more])
            rows = rows[:, ~more]
            if rows.shape[1]:
                self.wide = None
        total = rows.shape[1]
        new = np.flatnonzero((rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])) + 1
        cut = total if final else int(new[-1]) if len(new) else 0
        self.held = rows[:, cut:]
        if self.held.shape[1] > OPEN_ROWS:
            self.wide = tuple(int(x) for x in self.held[:2, 0])
            yield from self._hashed(self.held)
            self.held = self.held[:, :0]
        yield from self._extended(rows[:, :cut])

    def _extended(self, rows: np.ndarray):
        """Extends all places of their groups together and keeps what reaches the full length."""
        if not rows.shape[1]:
            return
        new = np.append(True, (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1]))
        begin, group = np.flatnonzero(new), np.cumsum(new) - 1
        keys = rows[2]
        shared = (np.minimum.reduceat(keys, begin) < np.maximum.reduceat(keys, begin))[group]
        rows, group = rows[:, shared], group[shared]
        if not rows.shape[1]:
            return
        keys, side, low, high = rows[2], rows[5], rows[6], rows[7]
        near, far = [group], [group]
        for i in range(self.arms.words):
            near.append(_split(near[i], rows[len(_PLACE) + i]))
            far.append(_split(far[i], rows[len(_PLACE) + self.arms.words + i]))
        reached = np.zeros((len(group), self.arms.words + 3), dtype=bool)  # a false column before and after
        for s in (LEFT, RIGHT):
            for i in range(self.arms.depth[s] + 1):
                at = np.flatnonzero((side == s) & (low <= i) & (i <= high))
                if len(at):
                    classes = _split(near[i][at], far[self.arms.depth[s] - i][at])
                    order = np.argsort(classes, kind="stable")
                    lead = np.flatnonzero(np.diff(classes[order], prepend=0))
                    earliest = np.minimum.reduceat(keys[at][order], lead)[classes - 1]
                    reached[at, i + 1] = keys[at] > earliest
        place, first = np.nonzero(reached[:, 1:-1] & ~reached[:, :-2])
        _, last = np.nonzero(reached[:, 1:-1] & ~reached[:, 2:])
        if len(place):
            r = rows[:, place]
            start = self.arms.start(r[5], r[4], np.where(r[5] == LEFT, last, first))
            yield _batch([r[0], np.zeros(len(place)), r[2], r[3], start, last - first + 1], _REPEAT)

    def _hashed(self, rows: np.ndarray):
        """The extensions of a large group, one row per window with n = 0."""
        words = rows[len(_PLACE):].view(np.uint64)
        for s in (LEFT, RIGHT):
            for i in range(self.arms.depth[s] + 1):
                at = np.flatnonzero((rows[5] == s) & (rows[6] <= i) & (i <= rows[7]))
                if not len(at):
                    continue
                extension = mix64(rows[1, at].view(np.uint64) + np.uint64(i))
                far = self.arms.words
                for w in [*range(i), *range(far, far + self.arms.depth[s] - i)]:
                    extension = mix64(extension * np.uint64(0xD6E8FEB86659FD93) + words[w, at])
                r = rows[:, at]
                yield _batch([r[0], _signed(extension), r[2], r[3], self.arms.start(r[5], r[4], i),
                              np.zeros(len(at))], _REPEAT)


def _spread(length: int, gram: int):
    """The extensions of places whose arm is hot, one row per window."""
    def run(batches):
        extender = _Extender(length, gram)
        for batch in batches:
            yield from extender._hashed(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
    return run


def _extended(length: int, gram: int):
    def run(batches):
        extender = _Extender(length, gram)
        for batch in batches:
            yield from extender.feed(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]), False)
        yield from extender.feed(extender.held[:, :0], True)
    return run


def repeated_passages(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH,
                      gram: int = GRAM, partitions: int | None = None) -> DataFrame:
    """(key, text_hash, spans array<struct<start, n>>): windows that also start under a smaller key."""
    spark = df.sparkSession
    n = partitions or shuffle_partitions(spark)
    docs = df.select(F.coalesce(col(key).cast("long"), F.lit(NO_KEY)).alias("key"),
                     F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    seeds = docs.mapInArrow(_seed_rows(length, gram), _ddl(_SEED))
    marks = written(seeds.repartition(n, "anchor").sortWithinPartitions("anchor", "content", "key")
                    .mapInArrow(_settled, _ddl(_MARK)), "passage-marks")
    listed = (marks.where(F.col("kind") == OPEN).groupBy("key", "text_hash")
              .agg(F.collect_list(F.struct("start", "n", "anchor")).alias("marks")))
    places, schema = _places(length, gram)
    found = written(docs.join(listed, ["key", "text_hash"]).mapInArrow(places, _ddl(schema)), "passage-places")
    # Joined again on (anchor, arm): a frequent anchor spreads over the words beside it.  At most n / HOT_SLACK arms
    # are hot, which bounds the broadcast.
    hot = F.broadcast(written(found.groupBy("anchor", "arm").agg(F.count(F.lit(1)).alias("places"))
                              .where(F.col("places") * n > F.lit(HOT_SLACK * found.count())).select("anchor", "arm"),
                              "passage-arms"))
    extended = (found.join(hot, ["anchor", "arm"], "left_anti").repartition(n, "anchor", "arm")
                .sortWithinPartitions("anchor", "arm").mapInArrow(_extended(length, gram), _ddl(_REPEAT)))
    spread_out = (found.join(hot, ["anchor", "arm"], "left_semi")
                  .mapInArrow(_spread(length, gram), _ddl(_REPEAT)))
    repeats = written(extended.unionByName(spread_out), "passage-repeats")
    wide = repeats.where(F.col("n") == 0)
    earliest = wide.groupBy("anchor", "extension").agg(F.min("key").alias("first_key"))
    spread = (wide.join(earliest, ["anchor", "extension"]).where(F.col("key") > F.col("first_key"))
              .select("key", "text_hash", "start", F.lit(1).cast("long").alias("n")))
    both = (marks.where(F.col("kind") == REPEATED).select("key", "text_hash", "start", "n")
            .unionByName(repeats.where(F.col("n") > 0).select("key", "text_hash", "start", "n"))
            .unionByName(spread))
    return both.groupBy("key", "text_hash").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def _with_spans(df: DataFrame, key: str, text: str, length: int) -> tuple[DataFrame, str]:
    """``df`` left-joined with its spans (null where none) in a fresh column."""
    k, h, s = fresh(df, "p_key"), fresh(df, "p_hash"), fresh(df, "p_spans")
    found = written(repeated_passages(df, key, text, length), "passage-spans").toDF(k, h, s)
    keyed = (df.withColumn(k, F.coalesce(col(key).cast("long"), F.lit(NO_KEY)))
               .withColumn(h, F.xxhash64(col(text))))
    return keyed.join(found, [k, h], "left").drop(k, h), s


def _kept_words(text: bytes, spans, length: int) -> tuple[list[bytes], int]:
    words = text.split()  # bytes.split: exactly the ASCII white space of the word rule
    if not spans:
        return words, len(words)
    pairs = np.array([(x["start"], x["n"]) for x in spans], dtype=np.int64)
    kept, at = [], 0
    for a, b in zip(*(x.tolist() for x in covered_runs(pairs[:, 0], pairs[:, 1] + length - 1))):
        kept += words[at:a]
        at = b
    return kept + words[at:], len(words)


def passage_report(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """Per document: the key, n_words, n_removed, kept_sha256 of the kept words joined by one space."""
    joined, s = _with_spans(df.select(col(key), col(text)), key, text, length)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            out = []
            for i in range(batch.num_rows):
                kept, n = _kept_words(texts[i].as_py() or b"", batch.column(2)[i].as_py(), length)
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            if out:
                n, removed, digest = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(digest)],
                    names=[key, "n_words", "n_removed", "kept_sha256"])
    return joined.select(col(key).cast("long"), col(text), col(s)).mapInArrow(
        run, f"`{key}` long, n_words long, n_removed long, kept_sha256 string")


def remove_passages(df: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """``df`` with repeated words gone; changed texts hold their kept words joined by one space."""
    joined, s = _with_spans(df, key, text, length)
    place = df.columns.index(text)

    def run(batches):
        for batch in batches:
            texts, spans = batch.column(place).cast(pa.binary()), batch.column(batch.num_columns - 1)
            new = []
            for i in range(batch.num_rows):
                whole, found = texts[i].as_py(), spans[i].as_py()
                new.append(whole if not found else b" ".join(_kept_words(whole, found, length)[0]))
            columns = list(batch.columns[:-1])
            columns[place] = pa.array(new, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])
    return joined.select(*[col(c) for c in df.columns], col(s)).mapInArrow(run, df.schema)


def op6_substring_dedup(spark, sf_dir: str) -> DataFrame:
    return passage_report(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op6_substring_dedup": op6_substring_dedup}
# The same result by listing every window.
ORACLE = {"op6_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM d, unnest(range(1, len(w) - 11)) AS u(i)),
f AS (SELECT g, min(doc_id) AS first_id FROM x GROUP BY g),
r AS (SELECT DISTINCT doc_id, i + k AS pos FROM x JOIN f USING (g), unnest(range(0, 13)) AS v(k)
      WHERE doc_id > first_id),
c AS (SELECT doc_id, count(*) AS n, list(pos) AS gone FROM r GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
              list_transform(list_filter(list_zip(w, range(1, len(w) + 1)),
                                         lambda p: NOT list_contains(gone, p[2])), lambda p: p[1]) END, ' '))
       AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""}
