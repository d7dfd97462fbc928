"""Exact n-gram Jaccard self-join of documents, as a prefix-tree join.

A document is its set of distinct 5-word shingles; two link when
intersection / union >= 4 / 5.  Result: the connected components.

1. One scan gives every document its set size and an order-free hash of its set
   (documents with equal sets are one class from here on), and counts shingles
   in ``BUCKETS`` buckets, a table of fixed size; tasks report the buckets that
   hold ``HEAVY`` times their mean.  The global order of shingles is (reported
   count in powers of two; hash): shingles of common lines and passages come last.
2. Linked sets share one of their first n - ceil(4n/5) + 1 shingles.  These
   prefixes are shuffled as (shingle, size, class), sorted, and streamed: sets
   that share a shingle form a run as long as neighbours' sizes keep the ratio
   4/5, and every member is named with the run's first class, its pivot.  Any two
   classes that could link are thus together in the block of some pivot, at one
   row per class and pivot instead of one per pair.
3. Members whose parity bit map (about one bit per shingle) shows that they differ
   too much from every other member of the block drop out of it, exactly (blocks
   beyond ``MAP_BLOCK`` members keep all).  The texts of the rest are fetched and their ordered sets stored in a
   trie per block.  Each set walks the trie, adding up its overlap along shared
   paths, and leaves a subtree when overlap plus what remains on either side
   cannot reach the bound, or when all of it is already in the set's component.
4. A block of more than ``BLOCK`` members is dealt into parts, each with the
   pivot.  What then still lies outside the block's largest component walks the
   tries of all parts, in chunks of at most about ``BLOCK``, so no pair between
   components is left out and no task grows with the block.
5. Components of all links found give the answer.

Classes are named by a 64-bit hash and their size; shingles are 64-bit hashes of
the folded words.  No candidate, bucket or partner is capped.

Defined results: null or empty text has size 0 and links with nothing; one to
four words are one shingle; repeated rows and equal sets share a component; a
null key never names a component while another key does; empty tables give
empty results; texts are read whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import col, fresh, written
from llm.components import components
from llm.kernels import RollingHash, SequenceHash, mix64, row_blocks, utf8_column, word_spans
from millstar.session import shuffle_partitions

WORDS = 5
BUCKETS = 1 << 22
HEAVY = 8
BLOCK = 512
MAP_BLOCK = 8192
SEGMENT = 48
LEAST_BITS = 128
BATCH_BYTES = 1 << 20
NO_KEY = (1 << 63) - 1


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64, copy=False).view(np.int64)


def _schema(*names: str) -> pa.Schema:
    return pa.schema([(n, pa.int64()) for n in names])


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if pa.types.is_binary(f.type) else 'long'}" for f in schema)


def _batch(columns, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c).astype(np.int64, copy=False)) for c in columns],
                                      schema=schema)


def shingles(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct shingles of every row, ordered by row and hash."""
    start, end, first = word_spans(data, offsets)
    sequence = SequenceHash(RollingHash(data, folded=True).slices(start, end))
    count = np.diff(first)
    grams = np.maximum(0, count - words + 1)
    row = np.repeat(np.arange(len(count)), grams)
    at = np.arange(int(grams.sum())) - np.repeat(np.cumsum(grams) - grams, grams) + first[row]
    value = sequence.slices(at, at + words)
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        value = np.concatenate([value, sequence.slices(first[short], first[short] + count[short])])
        row = np.concatenate([row, short])
    order = np.lexsort((value, row))
    value, row = value[order], row[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
    return value[new], row[new]


def _bucket(value: np.ndarray) -> np.ndarray:
    return (value >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64)


def _required(n: np.ndarray) -> np.ndarray:
    """Least overlap of a set of size n with any set it links to: ceil(4n/5)."""
    return -(-4 * n // 5)


_SIZE = pa.schema([*_schema("key", "text_hash", "n", "class"), ("parity", pa.binary())])


def _parities(value: np.ndarray, row: np.ndarray, n: np.ndarray) -> list[bytes]:
    """A bit map of each row: which of its places an odd number of shingles fall on.

    The places are a power of two, n at least and ``LEAST_BITS``; two maps differ in
    at most as many places as the sets differ in shingles.
    """
    places = 1 << np.ceil(np.log2(np.maximum(n, LEAST_BITS))).astype(np.int64)
    base = np.cumsum(places) - places
    at = base[row] + (mix64(value).astype(np.uint64) & (places[row] - 1).astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=int(places.sum())) & 1).astype(np.uint8), bitorder="little")
    return [bits[a:b].tobytes() for a, b in zip((base // 8).tolist(), ((base + places) // 8).tolist())]


def _sizes_and_counts(batches):
    """Rows (key, text_hash, n, class, parity) per document; (null, bucket, count, null, null) per task."""
    counts = np.zeros(BUCKETS, dtype=np.int32)
    for batch in batches:
        data, offsets = utf8_column(batch.column(2))
        n = np.zeros(batch.num_rows, dtype=np.int64)
        name = np.zeros(batch.num_rows, dtype=np.uint64)
        parity: list[bytes] = []
        for a, b in row_blocks(offsets, BATCH_BYTES):
            value, row = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            place, times = np.unique(_bucket(value), return_counts=True)
            counts[place] += times.astype(np.int32)
            n[a:b] = np.bincount(row, minlength=b - a)
            total = np.zeros(len(value) + 1, dtype=np.uint64)
            np.cumsum(mix64(value ^ np.uint64(0xA5A5A5A5)), out=total[1:])
            end = np.cumsum(n[a:b])
            name[a:b] = mix64(total[end] - total[end - n[a:b]])
            parity += _parities(value, row, n[a:b])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n), pa.array(_signed(name)),
             pa.array(parity, pa.binary())], schema=_SIZE)
    seen = np.flatnonzero(counts >= HEAVY * max(1.0, counts.sum() / BUCKETS))
    if len(seen):
        nothing = pa.nulls(len(seen), pa.int64())
        yield pa.RecordBatch.from_arrays([nothing, pa.array(seen), pa.array(counts[seen]), nothing,
                                          pa.nulls(len(seen), pa.binary())], schema=_SIZE)


def _ordered(value: np.ndarray, row: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Permutation into the global shingle order within each row."""
    return np.lexsort((value, levels[_bucket(value)], row))


_PREFIX = _schema("shingle", "n", "class")


def _prefixes(levels):
    def run(batches):
        order_of = levels.value
        for batch in batches:
            data, offsets = utf8_column(batch.column(0))
            seen: set[int] = set()  # classes of this batch: copies go out once
            for a, b in row_blocks(offsets, BATCH_BYTES):
                value, row = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
                if not len(value):
                    continue
                order = _ordered(value, row, order_of)
                n = np.bincount(row, minlength=b - a)
                end = np.cumsum(n)
                total = np.zeros(len(value) + 1, dtype=np.uint64)
                np.cumsum(mix64(value ^ np.uint64(0xA5A5A5A5)), out=total[1:])
                name = _signed(mix64(total[end] - total[end - n]))
                fresh_class = np.zeros(b - a, dtype=bool)
                for i, c in enumerate(name.tolist()):
                    fresh_class[i] = c not in seen
                    seen.add(c)
                place = np.arange(len(row)) - (end - n)[row]
                take = (place < (n - _required(n) + 1)[row]) & fresh_class[row]
                yield _batch([_signed(value[order][take]), n[row[take]], name[row[take]]], _PREFIX)
    return run


_MEMBER = _schema("pivot", "class")


def _runs(batches):
    """Streams rows sorted by (shingle, n, class); keeps one row and its pivot between batches."""
    carry = None  # shingle, n, class, pivot, whether the pivot was named as a member
    for batch in batches:
        shingle, n, name = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if carry is not None:
            shingle, n, name = (np.concatenate([[x], y]) for x, y in zip(carry, (shingle, n, name)))
        start = np.ones(len(shingle), dtype=bool)
        start[1:] = (shingle[1:] != shingle[:-1]) | (5 * n[:-1] < 4 * n[1:])
        lead = np.maximum.accumulate(np.where(start, np.arange(len(start)), 0))
        pivot = name[lead]
        if carry is not None:
            pivot[lead == 0] = carry[3]
        member = pivot != name
        if member.any():
            pair = np.unique(np.stack([pivot[member], name[member]]), axis=1)
            yield _batch([pair[0], pair[1]], _MEMBER)
        carry = (shingle[-1], n[-1], name[-1], pivot[-1])


class _Union:
    """Components of a block's members; equal initial names start joined."""

    def __init__(self, component):
        first: dict = {}
        self.parent = [first.setdefault(c, i) for i, c in enumerate(component)]

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
        return i != j


class ShingleTrie:
    """Ordered sets stored by shared prefixes, in segments of at most ``SEGMENT`` shingles.

    Every node knows the sizes below it and, while they are all in one component
    of ``union``, one member below it.
    """

    def __init__(self, union: _Union):
        self.union = union
        self.tokens, self.kids, self.ends = [[]], [{}], [[]]
        self.low, self.high, self.member = [1 << 62], [0], [None]

    def _node(self, tokens) -> int:
        self.tokens.append(tokens)
        self.kids.append({})
        self.ends.append([])
        self.low.append(1 << 62)
        self.high.append(0)
        self.member.append(None)
        return len(self.tokens) - 1

    def _pass(self, node: int, n: int, item: int) -> None:
        self.low[node], self.high[node] = min(self.low[node], n), max(self.high[node], n)
        if self.member[node] is None:
            self.member[node] = item
        elif self.member[node] >= 0 and self.union.root(self.member[node]) != self.union.root(item):
            self.member[node] = -1

    def add(self, tokens: np.ndarray, item: int) -> None:
        n, at, node = len(tokens), 0, 0
        self._pass(node, n, item)
        while at < n:
            head = int(tokens[at])
            child = self.kids[node].get(head)
            if child is None:
                child = self._node(tokens[at:at + SEGMENT])
                self.kids[node][head] = child
            else:
                own = self.tokens[child]
                size = min(len(own), n - at)
                differ = np.flatnonzero(own[:size] != tokens[at:at + size])
                shared = int(differ[0]) if len(differ) else size
                if shared < len(own):
                    top = self._node(own[:shared])
                    self.low[top], self.high[top], self.member[top] = (
                        self.low[child], self.high[child], self.member[child])
                    self.kids[top][int(own[shared])] = child
                    self.tokens[child] = own[shared:]
                    self.kids[node][head] = child = top
            at += len(self.tokens[child])
            node = child
            self._pass(node, n, item)
        self.ends[node].append(item)

    def _settled(self, node: int, item: int) -> bool:
        return self.member[node] >= 0 and self.union.root(self.member[node]) == self.union.root(item)

    def walk(self, values: np.ndarray, item: int):
        """Yield stored items that link ``item`` (its shingles sorted by value) to another component."""
        n = len(values)
        pending = [(child, 0, 0) for child in self.kids[0].values()]
        while pending:
            node, depth, overlap = pending.pop()
            if not self._reachable(n, overlap, depth, self.low[node], self.high[node]) or self._settled(node, item):
                continue
            tokens = self.tokens[node]
            at = np.searchsorted(values, tokens)
            at[at == n] = 0
            overlap += int(np.count_nonzero(values[at] == tokens))
            depth += len(tokens)
            for stored in self.ends[node]:
                if 9 * overlap >= 4 * (n + depth) and self.union.join(stored, item):
                    yield stored
            pending += [(child, depth, overlap) for child in self.kids[node].values()]

    @staticmethod
    def _reachable(n: int, overlap: int, depth: int, low: int, high: int) -> bool:
        """Whether a stored size m in [low, high] allows 9 I >= 4 (n + m), that is I / U >= 4 / 5,
        where at most min(n - overlap, m - depth) more shingles can be shared."""
        best = min(high, max(low, n - overlap + depth))  # where the difference is largest
        return 9 * (overlap + min(n - overlap, best - depth)) >= 4 * (n + best)


def _block_links(sets: list[np.ndarray], levels: np.ndarray, component, probe) -> list[tuple[int, int]]:
    """Links that join components within one block.

    Without probes every set walks the trie of the smaller sets, then enters it.
    Probes walk the trie of all others, whose own pairs are known, and don't enter.
    """
    union = _Union(component)
    links, trie = [], ShingleTrie(union)
    probes = bool(np.any(probe))
    for i in sorted(range(len(sets)), key=lambda k: (bool(probe[k]), len(sets[k]))):
        values = sets[i]
        if probe[i] or not probes:
            links += [(i, j) for j in trie.walk(values, i)]
        if not probe[i]:
            trie.add(values[np.lexsort((values, levels[_bucket(values)]))], i)
    return links


_NEAR = pa.schema([("pivot", pa.int64()), ("class", pa.int64())])


def _near(batches):
    """Members of a block that some other member's parity map allows to link with.

    Linked sets differ in at most (n + m) / 9 shingles, so their maps differ in at most
    as many places; the larger map is folded onto the smaller one first.
    """
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        pivot = batch.column(0).to_numpy(zero_copy_only=False)
        edge = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1]))
        yield from _near_members(batch.slice(0, edge[-1]), edge[:-1])
        held = batch.slice(edge[-1])
    if held is not None:
        yield from _near_members(held, np.array([0]))


def _near_members(batch: pa.RecordBatch, edges: np.ndarray):
    if not batch.num_rows:
        return
    pivot, name, n = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
    data, offsets = utf8_column(batch.column(3))
    keep = np.zeros(batch.num_rows, dtype=bool)
    for a, b in zip(edges.tolist(), np.append(edges[1:], batch.num_rows).tolist()):
        maps = [data[offsets[k]:offsets[k + 1]] for k in range(a, b)]
        size, count = n[a:b], np.diff(offsets[a:b + 1])
        folded: dict[int, np.ndarray] = {}
        for width in np.unique(count).tolist():
            table = np.zeros((b - a, width), dtype=np.uint8)
            for k, m in enumerate(maps):
                if len(m) == width:
                    table[k] = m
                elif len(m) == 2 * width:
                    table[k] = m[:width] ^ m[width:]
            folded[width] = table.view(np.uint64)
        for i in range(b - a - 1):  # sorted by size
            end = int(np.searchsorted(size, 5 * size[i] // 4, side="right"))
            if end <= i + 1:
                continue
            table = folded[int(count[i])]
            apart = np.bitwise_count(table[i + 1:end] ^ table[i]).sum(axis=1, dtype=np.int64)
            near = np.flatnonzero(9 * apart <= size[i] + size[i + 1:end])
            if len(near):
                keep[a + i] = True
                keep[a + i + 1 + near] = True
    if keep.any():
        yield _batch([pivot[keep], name[keep]], _NEAR)


_TEXT = pa.schema([("pivot", pa.int64()), ("part", pa.int64()), ("class", pa.int64()), ("component", pa.int64()),
                   ("probe", pa.int64()), ("text", pa.binary())])
_LINK = _schema("a", "b")


def _linked(levels):
    """Rows sorted by (pivot, part): one block at a time; a block has a bounded number of members."""
    def run(batches):
        order_of = levels.value
        held = None
        for batch in batches:
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            place = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 4)])
            new = np.append(True, (place[:, 1:] != place[:, :-1]).any(axis=0))
            if not new.all():  # repeated rows of one class
                batch, place = batch.filter(pa.array(new)), place[:, new]
            edge = np.flatnonzero(np.append(True, (place[:2, 1:] != place[:2, :-1]).any(axis=0)))
            yield from _blocks(batch.slice(0, edge[-1]), edge[:-1], order_of)
            held = batch.slice(edge[-1])
        if held is not None:
            yield from _blocks(held, np.array([0]), order_of)
    return run


def _blocks(batch: pa.RecordBatch, edges: np.ndarray, levels: np.ndarray):
    if not batch.num_rows:
        return
    name, component, probe = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3, 4))
    data, offsets = utf8_column(batch.column(5))
    ends = np.append(edges[1:], batch.num_rows)
    out = []
    for a, b in zip(edges.tolist(), ends.tolist()):
        value, row = shingles(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
        sets = np.split(value, np.cumsum(np.bincount(row, minlength=b - a))[:-1])
        own = component[a:b].tolist()
        links = _block_links(sets, levels, own, probe[a:b])
        if links:  # as stars: every member of a joined component on its smallest class
            union = _Union(own)
            for i, j in links:
                union.join(i, j)
            joined = {union.root(i) for i, _ in links}
            low: dict[int, int] = {}
            for i in range(b - a):
                root = union.root(i)
                low[root] = min(low.get(root, name[a + i]), name[a + i])
            out += [(name[a + i], low[union.root(i)]) for i in range(b - a) if union.root(i) in joined]
    if out:
        yield _batch(list(zip(*out)), _LINK)


def near_duplicate_groups(df: DataFrame, key: str = "doc_id", text: str = "text",
                          partitions: int | None = None) -> DataFrame:
    """Per input row: key, text_hash, n_shingles, component_id and first (the row that stands for
    its component: smallest key, then smallest text hash; rows without shingles stand for themselves)."""
    spark = df.sparkSession
    parts = partitions or shuffle_partitions(spark)
    docs = df.select(F.coalesce(col(key).cast("long"), F.lit(NO_KEY)).alias("key"),
                     F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    scanned = written(docs.mapInArrow(_sizes_and_counts, _ddl(_SIZE).replace("class", "`class`")), "shingle-sizes")
    sizes = scanned.where(F.col("key").isNotNull())
    order = np.zeros(BUCKETS, dtype=np.uint8)
    level = F.floor(F.log2(F.sum("n"))).cast("int").alias("level")
    for bucket, high in scanned.where(F.col("key").isNull()).groupBy("text_hash").agg(level).toLocalIterator():
        order[bucket] = high  # at most BUCKETS rows, a small part of them reported
    levels = spark.sparkContext.broadcast(order)  # BUCKETS bytes

    prefixes = docs.select("text").mapInArrow(_prefixes(levels), _ddl(_PREFIX).replace("class", "`class`"))
    members = written(prefixes.repartition(parts, "shingle").sortWithinPartitions("shingle", "n", "class")
                      .mapInArrow(_runs, _ddl(_MEMBER).replace("class", "`class`")).distinct(), "shingle-members")
    # The pivot is a member of its own block.
    counted = members.groupBy("pivot").agg(F.count(F.lit(1)).alias("members"))
    whole = written(members.join(counted, "pivot").unionByName(
        counted.select("pivot", F.col("pivot").alias("class"), "members")), "shingle-blocks")
    classes = written(sizes.where("n > 0").groupBy("class").agg(
        F.min(F.struct("key", "text_hash")).alias("row"), F.min("n").alias("n"), F.min("parity").alias("parity")),
        "shingle-classes")
    maps = classes.select("class", "n", "parity")
    near = written(whole.where(F.col("members") < MAP_BLOCK).join(maps, "class").select("pivot", "class", "n", "parity")
                   .repartition(parts, "pivot").sortWithinPartitions("pivot", "n", "class")
                   .mapInArrow(_near, "pivot long, `class` long")
                   .unionByName(whole.where(F.col("members") >= MAP_BLOCK).select("pivot", "class")), "shingle-near")
    # Blocks beyond BLOCK members come in parts, each with the pivot.
    blocks = near.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("parts"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))
    left = near.join(blocks, "pivot")
    dealt = written(left.where("pivot != class").withColumn("part", F.pmod(F.xxhash64("class"), "parts")).unionByName(
        left.where("pivot = class").withColumn("part", every)), "shingle-dealt")
    stands = classes.select("class", "row")

    # The texts of all block members, fetched once.  The list of members grows with the
    # data, so the join is a shuffle at every size.
    wanted = stands.join(dealt.select("class").distinct(), "class").select("row.key", "row.text_hash", "class")
    texts = written(docs.join(wanted.hint("merge"), ["key", "text_hash"])
                    .select("class", F.col("text").cast("binary").alias("text")), "shingle-texts")

    def walk(rows: DataFrame) -> DataFrame:
        """Links of blocks given as rows (class, pivot, part, component, probe)."""
        return (rows.join(texts, "class").select("pivot", "part", "class", "component", "probe", "text")
                .repartition(parts, "pivot", "part").sortWithinPartitions("pivot", "part", "class", "probe")
                .mapInArrow(_linked(levels), _ddl(_LINK)))

    plain = F.lit(0).cast("long")
    links = written(walk(dealt.select("class", "pivot", "part", F.col("class").alias("component"),
                                      plain.alias("probe"))), "shingle-links")
    large = dealt.where("parts > 1")
    if not large.isEmpty():
        links = _between_parts(large, links, walk)
    groups = components(links)
    result = sizes.join(groups.withColumnRenamed("node", "class"), "class", "left").withColumn(
        "component", F.when(F.col("n") > 0, F.coalesce("component", "class")))
    result = written(result.select("key", "text_hash", "n", "component"), "shingle-result")
    lowest = result.where("n > 0").groupBy("component").agg(F.min(F.struct("key", "text_hash")).alias("low"))
    named = result.join(lowest, "component", "left")
    known = F.when(F.col("low").isNull(), F.col("key")).otherwise(F.col("low.key"))
    return named.select(
        F.nullif("key", F.lit(NO_KEY)).alias("key"), "text_hash", F.col("n").alias("n_shingles"),
        F.nullif(known, F.lit(NO_KEY)).alias("component_id"),
        F.coalesce((F.col("key") == F.col("low.key")) & (F.col("text_hash") == F.col("low.text_hash")),
                   F.lit(True)).alias("first"))


def _between_parts(large: DataFrame, links: DataFrame, walk) -> DataFrame:
    """Links between the parts of large blocks: what is outside a block's largest component
    walks the tries of all its parts."""
    groups = components(links).withColumnRenamed("node", "class").withColumnRenamed("component", "known")
    placed = large.join(groups, "class", "left").select(
        "pivot", "class", "parts", "part", F.coalesce("known", "class").alias("component"))
    once = placed.where(F.col("class") != F.col("pivot")).groupBy("pivot", "component").agg(
        F.count(F.lit(1)).alias("size"))
    largest = once.groupBy("pivot").agg(F.max(F.struct("size", "component")).alias("top"),
                                        F.count(F.lit(1)).alias("components"))
    open_blocks = written(placed.join(largest.where("components > 1"), "pivot").select(
        "pivot", "class", "parts", "part", "component",
        (F.col("component") != F.col("top.component")).cast("long").alias("probe")), "shingle-open")
    if open_blocks.isEmpty():
        return links
    # Parts and chunks of probes meet two by two, so that no task grows with the block.
    chunks = open_blocks.where("probe = 1").groupBy("pivot").agg(
        F.ceil(F.countDistinct("class") / BLOCK).cast("long").alias("chunks"))

    def each(n: str):
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    probes = (open_blocks.where("probe = 1").select("pivot", "class", "parts", "component", "probe").distinct()
              .join(chunks, "pivot").withColumn("chunk", F.pmod(F.xxhash64("class", F.lit(1)), "chunks"))
              .withColumn("part", each("parts")))
    stay = open_blocks.withColumn("probe", F.lit(0).cast("long")).join(chunks, "pivot").withColumn(
        "chunk", each("chunks"))
    wanted = ["pivot", "class", "component", "probe", (F.col("part") * F.col("chunks") + F.col("chunk")).alias("part")]
    stay, probes = stay.select(*wanted), probes.select(*wanted)
    more = written(walk(stay.unionByName(probes)), "shingle-links")
    return links.unionByName(more)


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every near-duplicate group, columns unchanged; rows without shingles stay."""
    k, h = fresh(df, "s_key"), fresh(df, "s_hash")
    groups = near_duplicate_groups(df, key, text).where("first").select(
        F.coalesce("key", F.lit(NO_KEY)).alias(k), F.col("text_hash").alias(h),
        (F.col("n_shingles") > 0).alias("some")).distinct()
    joined = (df.withColumn(k, F.coalesce(col(key).cast("long"), F.lit(NO_KEY)))
                .withColumn(h, F.xxhash64(col(text))).join(groups, [k, h]))
    # Equal rows stand for their group together: one of them stays.
    alone = joined.where("some").dropDuplicates([k, h]).unionByName(joined.where("not some"))
    return alone.select(*[col(c) for c in df.columns])


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicate_groups(docs).select(F.col("key").alias("doc_id"), "n_shingles", "component_id")


QUERIES = {"op2_ngram_jaccard": op2_ngram_jaccard}

#: Sets, links and components of a table {docs}, as DuckDB SQL by comparing all pairs that share a shingle.
GROUPS_SQL = r"""
jd AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM {docs}),
js AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ')
              ELSE array_to_string(w[i:i + 4], ' ') END AS s
       FROM jd, unnest(range(1, greatest(len(w) - 3, 2))) AS u(i) WHERE len(w) > 0),
jn AS (SELECT doc_id, count(*) AS n FROM js GROUP BY doc_id),
jp AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM js x JOIN js y ON x.s = y.s AND x.doc_id <> y.doc_id
       GROUP BY x.doc_id, y.doc_id),
jl AS (SELECT a, b FROM jp JOIN jn p ON p.doc_id = a JOIN jn q ON q.doc_id = b
       WHERE 100 * k >= 80 * (p.n + q.n - k)),
jr(a, b) AS (SELECT a, b FROM jl UNION SELECT jr.a, jl.b FROM jr JOIN jl ON jr.b = jl.a),
jc AS (SELECT a, min(b) AS low FROM jr GROUP BY a),
jg AS (SELECT jd.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(jd.doc_id, coalesce(low, jd.doc_id)) AS component_id
       FROM jd LEFT JOIN jn ON jn.doc_id = jd.doc_id LEFT JOIN jc ON jc.a = jd.doc_id)
"""
ORACLE = {"op2_ngram_jaccard": "WITH RECURSIVE " + GROUPS_SQL.format(docs="documents") + " SELECT * FROM jg"}
