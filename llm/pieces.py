"""Sampled SentencePiece segmentation: forward filtering, backward sampling; lossless decoding.

A text is read as the model reads it (a blank before it, blanks as part of the
pieces) and falls into units that no piece crosses: a run of blanks with the
signs after it, or one byte of a character the model has no piece for (byte
fallback).  For the distinct units of a batch the lattice of all pieces is built
at once and filtered forward: the log weight of all ways to reach each place.
Every occurrence then samples backwards from its end, choosing the incoming
piece by its share of that weight, so whole segmentations come out with
probability proportional to exp(alpha * sum of piece scores).  Random numbers
are hashes of (seed, row key, unit, step): the same key and text give the same
segmentation wherever and however often they are encoded.

Scores of a BPE model are ranks of merges; they are read as log weights
-log(1 + rank) (Zipf).  Pieces concatenate to the text's bytes, so decoding
gives the text back exactly.

Defined results: null text gives null ids, empty text no ids; a null key is a
key like others; repeated rows are encoded alike; literal U+2581 and characters
without a piece go through byte pieces; empty tables give empty results; other
columns pass through; texts are encoded whole.
"""

from __future__ import annotations



import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import col, fresh
from llm.kernels import RollingHash, mix64, row_blocks, utf8_column

BLOCK_BYTES = 1 << 19
DECODE_ROWS = 256
_SPACE = 32


def _byte_trie(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A trie as a double array: (below, parent, word).

    The child of node n by byte b is node t = below[n] + b if parent[t] == n; word[t] is the number of the word
    that ends there, or -1.  Node 0 is the root.
    """
    root: dict = {}
    for k, word in enumerate(words):
        node = root
        for byte in word:
            node = node.setdefault(byte, {})
        node[-1] = k
    size = sum(map(len, words)) + 1024
    below, parent, ends = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    # Nodes of one child fill the gaps behind ``free``; others are tried at 256 places from ``front`` on.
    free, front, pending, places = 1, 1, [(0, root)], np.arange(256)[:, None]
    while pending:
        at, node = pending.pop()
        ends[at] = node.pop(-1, -1)
        if not node:
            continue
        byte = np.fromiter(node, np.int64, len(node))
        if len(byte) == 1:
            while parent[free] >= 0 or free <= byte[0]:
                free += 1
            slot = free - int(byte[0])
        else:
            while True:
                if front + 1024 > len(parent):
                    below, parent, ends = (np.append(x, np.full(len(x), fill, np.int32))
                                           for x, fill in ((below, 0), (parent, -1), (ends, -1)))
                fits = (parent[front + places + byte] < 0).all(axis=1)
                if fits.any():
                    break
                front += 64
            slot = front + int(fits.argmax())
        below[at], parent[slot + byte] = slot, at
        pending += [(slot + int(b), child) for b, child in node.items()]
    return below, parent, ends


class PieceModel:
    """Pieces as a trie over their bytes, weights, and which characters have a piece."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.bytes: list[bytes] = [b""] * n
        self.byte_piece = np.full(256, -1, dtype=np.int64)
        normal = []
        for i in range(n):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:5], 16)
                self.byte_piece[value] = i
                self.bytes[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.bytes[i] = piece.replace("▁", " ").encode()
                normal.append(i)
        if (self.byte_piece < 0).any():
            raise ValueError("the model needs byte fallback to decode every text")
        if any(b" " in self.bytes[i].lstrip(b" ") for i in normal):
            raise ValueError("pieces must not hold blanks after other signs")
        score = np.array([model.get_score(i) for i in normal])
        if score.min() < -100:  # ranks of merges
            score = -np.log1p(-np.maximum(score, -float(n)))
        self.longest = max(len(self.bytes[i]) for i in normal)
        self.below, self.parent, self.piece = _byte_trie([self.bytes[i] for i in normal])
        self.ids, self.weight = np.array(normal), alpha * score
        # Characters with a piece of their own; a character inside longer pieces only counts as unknown.
        self.known = np.zeros(0x110000, dtype=bool)
        for i in normal:
            text = self.bytes[i].decode()
            if len(text) == 1:
                self.known[ord(text)] = True


_MODELS: dict[tuple[str, float], PieceModel] = {}


def piece_model(path: str, alpha: float) -> PieceModel:
    """One model per worker process, file and alpha."""
    if (path, alpha) not in _MODELS:
        _MODELS[path, alpha] = PieceModel(path, alpha)
    return _MODELS[path, alpha]


def _unknown_bytes(data: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Bytes of characters without a piece."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    if not len(at):
        return np.ones(len(data), dtype=bool)
    first = data[at].astype(np.int64)
    size = np.where(first < 0x80, 1, np.where(first < 0xE0, 2, np.where(first < 0xF0, 3, 4)))
    padded = np.append(data, np.zeros(4, np.uint8)).astype(np.int64)
    point = np.where(size == 1, first, first & (0xFF >> (size + 1)))
    for k in range(1, 4):
        more = size > k
        point[more] = (point[more] << 6) | (padded[at[more] + k] & 0x3F)
    strange = ~known[np.minimum(point, 0x10FFFF)]
    out = np.zeros(len(data), dtype=bool)
    for k in range(4):
        chosen = at[strange & (size > k)] + k
        out[chosen[chosen < len(data)]] = True
    return out


def _units(data: np.ndarray, offsets: np.ndarray, strange: np.ndarray) -> np.ndarray:
    """Starts of the units of all rows, ascending."""
    start = np.zeros(len(data), dtype=bool)
    blank = data == _SPACE
    start[1:] = blank[1:] & ~blank[:-1]
    start |= strange
    start[1:] |= strange[:-1]
    begins = offsets[:-1][np.diff(offsets) > 0]
    start[begins] = True
    return np.flatnonzero(start)


def _distinct(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one unit of every distinct byte string, the place of each unit's string in that list).

    Units meet by hash and are then compared byte by byte.
    """
    _, sample, of = np.unique(RollingHash(data).slices(start, start + length), return_index=True, return_inverse=True)
    alike = length == length[sample][of]
    for a, b in row_blocks(np.append(0, np.cumsum(length)), 1 << 18):
        size = length[a:b]
        inner = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        mine, other = start[a:b], start[sample][of[a:b]]
        same = (data[np.repeat(mine, size) + inner]
                == data[np.minimum(np.repeat(other, size) + inner, len(data) - 1)])
        alike[a:b] &= np.logical_and.reduceat(same, np.cumsum(size) - size)
    if not alike.all():
        own: dict[bytes, int] = {}
        for k in np.flatnonzero(~alike).tolist():  # equal hashes of different units
            of[k] = own.setdefault(data[start[k]:start[k] + length[k]].tobytes(), len(sample) + len(own))
        first = {of[k]: k for k in np.flatnonzero(~alike)[::-1].tolist()}
        sample = np.append(sample, [first[len(sample) + j] for j in range(len(own))]).astype(np.int64)
    return sample, of


def _lattice(model: PieceModel, data: np.ndarray, start: np.ndarray, length: np.ndarray, strange: np.ndarray):
    """Edges of the lattices of distinct units, ordered by end place.

    Places of unit k are base[k] .. base[k] + length[k].  Returns (base, first, share, begin, piece):
    the edges that end at place p begin at first[p], their cumulative shares end with 1.
    """
    base = np.cumsum(length + 1) - (length + 1)
    unit = np.repeat(np.arange(len(start)), length)
    inner = np.arange(len(unit)) - np.repeat(np.cumsum(length) - length, length)
    at, room, place = start[unit] + inner, length[unit] - inner, base[unit] + inner
    odd = strange[start]
    begins, ends, ids, weights, offsets = [], [], [], [], []
    single = np.flatnonzero(odd)
    if len(single):  # a byte of an unknown character: one edge
        begins.append(base[single])
        ends.append(base[single] + 1)
        ids.append(model.byte_piece[data[start[single]]])
        weights.append(np.zeros(len(single)))
        offsets.append(np.ones(len(single), dtype=np.int64))
    live = np.flatnonzero(~odd[unit])
    node = np.zeros(len(live), dtype=np.int32)
    padded = np.append(data, np.zeros(model.longest, np.uint8))
    for size in range(1, model.longest + 1):
        node = model.below[node] + padded[at[live] + (size - 1)]
        alive = (model.parent[node] == came) & (room[live] >= size) if size > 1 else model.parent[node] == 0
        live, node = live[alive], node[alive]
        if not len(live):
            break
        came = node
        found = model.piece[node]
        hit = found >= 0
        here, found = live[hit], found[hit]
        begins.append(place[here])
        ends.append(place[here] + size)
        ids.append(model.ids[found])
        weights.append(model.weight[found])
        offsets.append(inner[here] + size)
    # Edges in order of their end place, the longest piece first: one size has at most one edge to a place.
    reach = np.full(int(base[-1] + length[-1] + 1), -np.inf)
    reach[base] = 0.0
    into = sum(np.bincount(x, minlength=len(reach)) for x in ends)
    first_edge = np.cumsum(into) - into
    begin, piece, weight, offset, end = (np.empty(int(into.sum()), x.dtype) for x in (
        base, model.ids, model.weight, base, base))
    cursor = first_edge.copy()
    for k in reversed(range(len(ends))):
        at = cursor[ends[k]]
        cursor[ends[k]] += 1
        begin[at], end[at], piece[at], weight[at], offset[at] = begins[k], ends[k], ids[k], weights[k], offsets[k]
    # Forward filtering, one distance from the unit's start at a time.
    order = np.argsort(offset.astype(np.uint16) if len(offset) and offset.max() < 1 << 16 else offset, kind="stable")
    share, source, target, gain, offset = np.empty(len(begin)), begin[order], end[order], weight[order], offset[order]
    edges = np.flatnonzero(np.append(True, offset[1:] != offset[:-1]))
    for a, b in zip(edges, np.append(edges[1:], len(offset))):
        total = reach[source[a:b]] + gain[a:b]
        first = np.flatnonzero(np.append(True, target[a + 1:b] != target[a:b - 1]))
        size = np.diff(np.append(first, b - a))
        top = np.maximum.reduceat(total, first)
        top[np.isneginf(top)] = 0.0
        part = np.exp(total - np.repeat(top, size))
        mass = np.add.reduceat(part, first)
        with np.errstate(divide="ignore"):
            reach[target[a:b][first]] = top + np.log(mass)
        running = np.cumsum(part)
        before = np.repeat(running[first] - part[first], size)
        part = (running - before) / np.repeat(np.where(mass > 0, mass, 1.0), size)
        part[np.append(first[1:], b - a) - 1] = 1.0
        share[order[a:b]] = part
    return base, first_edge, share, begin, piece


def encode_block(model: PieceModel, data: np.ndarray, offsets: np.ndarray, key: np.ndarray):
    """(ids of all rows, first id of each row + total): one sampled segmentation per row.

    ``data`` holds the rows with their leading blank; ``key`` is one uint64 per row.
    """
    rows = len(offsets) - 1
    if not len(data):
        return np.zeros(0, dtype=np.int32), np.zeros(rows + 1, dtype=np.int64)
    strange = _unknown_bytes(data, model.known)
    start = _units(data, offsets, strange)
    length = np.diff(np.append(start, len(data)))
    sample, of = _distinct(data, start, length)
    base, into, share, begin, piece = _lattice(model, data, start[sample], length[sample], strange)
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(rows), np.diff(first))
    chance = mix64(key[row] + np.arange(len(start), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                   - first[row].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    floor = base[of]
    at = floor + length[sample][of]
    live = np.arange(len(start))
    count = np.zeros(len(start), dtype=np.int64)
    steps = []
    while len(live):
        draw = (mix64(chance[live] + np.uint64(len(steps) + 1)) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53
        edge = into[at[live]]
        beyond = np.flatnonzero(share[edge] <= draw)
        while len(beyond):  # few edges end at one place, the longest piece comes first
            edge[beyond] += 1
            beyond = beyond[share[edge[beyond]] <= draw[beyond]]
        steps.append((live, piece[edge]))
        at[live] = begin[edge]
        count[live] += 1
        live = live[at[live] > floor[live]]
    end = np.cumsum(count)
    ids = np.empty(int(end[-1]), dtype=np.int32)
    for k, (who, what) in enumerate(steps):
        ids[end[who] - 1 - k] = what
    return ids, np.append(0, end)[first]


def _with_blank(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a blank before every non-empty text."""
    size = np.diff(offsets)
    some = size > 0
    moved = np.append(0, np.cumsum(size + some))
    out = np.full(int(moved[-1]), _SPACE, dtype=np.uint8)
    shift = np.repeat((moved[:-1] + some) - offsets[:-1], size)
    out[np.arange(len(data)) + shift] = data
    return out, moved


def decode(model: PieceModel, ids) -> bytes:
    """The text's bytes back from its ids (without the blank put before it)."""
    return b"".join(map(model.bytes.__getitem__, ids))[1:]


def encode_sampled(df: DataFrame, model_path: str, key: str = "doc_id", text: str = "text", out: str = "ids",
                   alpha: float = 1.0, seed: int = 0) -> DataFrame:
    """``df`` plus ``out``, the sampled piece ids of every text (array<int>)."""
    out, seeded = fresh(df, out), fresh(df, "p_seed")
    place = df.columns.index(text)
    marked = df.withColumn(seeded, F.xxhash64(F.lit(seed), col(key)))
    names = [*df.columns, out]

    def run(batches):
        model = piece_model(model_path, alpha)
        for batch in batches:
            data, offsets = utf8_column(batch.column(place))
            keys = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in row_blocks(offsets, BLOCK_BYTES):
                ids, first = encode_block(model, *_with_blank(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]),
                                          keys[a:b])
                rows = batch.slice(a, b - a)
                absent = rows.column(place).is_null()
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids),
                                                 mask=absent if absent.true_count else None)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], lists], names=names)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType()))])
    return marked.mapInArrow(run, schema)


def decode_ids(df: DataFrame, model_path: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` plus ``out``, the text of every id list (null for null)."""
    out = fresh(df, out)
    place, names = df.columns.index(ids), [*df.columns, out]

    def run(batches):
        model = piece_model(model_path, 1.0)
        for whole in batches:
            for lo in range(0, whole.num_rows, DECODE_ROWS):
                batch = whole.slice(lo, DECODE_ROWS)
                lists = batch.column(place)
                at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
                texts = [None if gone else decode(model, flat[a:b].tolist())
                         for a, b, gone in zip(at, at[1:], lists.is_null().to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(texts, pa.binary()).cast(pa.string())], names=names)
    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField(out, T.StringType())]))


def encoded_documents(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_ids, ids and whether decoding the ids gives the text back."""
    decoded = decode_ids(encode_sampled(docs.select("doc_id", "text"), model_path), model_path)
    return decoded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_ids"), "ids",
                          F.col("decoded").eqNullSafe(F.col("text")).alias("lossless"))


def op3_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encoded_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op3_sentencepiece": op3_sentencepiece}
ORACLE: dict[str, str] = {}
