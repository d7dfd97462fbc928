"""Token-id output: blocks of concatenated ids with Elias-Fano document boundaries.

File format (one block = one binary value, little-endian throughout):

    8 bytes   magic "TIDBLK01"
    4 x u32   id width in bytes (2 or 4), documents, low bits per boundary, select samples
    2 x u64   ids, bytes of the upper bit vector
    u32 ...   select samples: bit position of every 64th set bit of the upper vector
    u64 ...   upper bit vector, padded to whole words
    u64 ...   lower bits of all boundaries, packed, padded to whole words
    ids       concatenated, ``width`` bytes each

Document i covers ids [b(i), b(i+1)) where b is the monotone sequence of
documents + 1 boundaries.  Elias-Fano keeps about 2 + log2(ids / documents)
bits per boundary instead of a 64-bit table; ``select`` finds one boundary from
the nearest sample without decoding the others.

``write_token_files`` range-partitions documents by id, encodes each range in
its task and writes the blocks as rows of a Parquet dataset (commit protocol
and any Hadoop store included); block rows carry their partition and order, so
the whole is the ids in ascending document order.  ``read_token_files`` needs
one count per partition to know how many ids come before.

Defined results: null and empty texts give only the end id; null document ids
sort first; repeated rows are separate documents in any order; an empty table
gives no block and no row.  Texts of any length are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from llm.common import col
from millstar.session import scratch_path, shuffle_partitions

MAGIC = b"TIDBLK01"
_HEAD = struct.Struct("<8s4I2Q")
SAMPLE = 64
BLOCK_IDS = 2_000_000
CACHE_SIZE = 400_000


def _padded(bits: np.ndarray) -> bytes:
    """Bits (uint8 0/1, lowest first) as whole little-endian 64-bit words."""
    packed = np.packbits(bits, bitorder="little").tobytes()
    return packed + b"\0" * (-len(packed) % 8)


class EliasFano:
    """Monotone integers in near-minimal space; build with ``pack``, open with the parts."""

    def __init__(self, n: int, low_bits: int, samples: np.ndarray, upper: np.ndarray, lower: np.ndarray):
        self.n, self.low_bits = n, low_bits
        self.samples, self.upper, self.lower = samples, upper, lower

    @staticmethod
    def pack(values: np.ndarray) -> tuple[int, np.ndarray, bytes, bytes]:
        """(low bits, samples, upper bytes, lower bytes) of an ascending int64 array."""
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        places = (values >> low_bits) + np.arange(n)
        bits = np.zeros(int(places[-1]) + 1 if n else 0, dtype=np.uint8)
        bits[places] = 1
        low = values & ((1 << low_bits) - 1)
        lower = ((low[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8).ravel()
        return low_bits, places[::SAMPLE].astype(np.uint32), _padded(bits), _padded(lower)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        at = i * self.low_bits
        word, shift = at >> 6, at & 63
        got = int(self.lower[word]) >> shift
        if shift + self.low_bits > 64:
            got |= int(self.lower[word + 1]) << (64 - shift)
        return got & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """Value i: from the sample at or before it, popcounts up to the word that holds its bit."""
        place = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        word = place >> 6
        bits = int(self.upper[word]) & ~((1 << (place & 63)) - 1)
        while (here := bits.bit_count()) <= left:
            left -= here
            word += 1
            bits = int(self.upper[word])
        for _ in range(left):
            bits &= bits - 1
        place = (word << 6) + (bits & -bits).bit_length() - 1
        return ((place - i) << self.low_bits) | self._low(i)

    def all(self) -> np.ndarray:
        """Every value at once."""
        places = np.flatnonzero(np.unpackbits(self.upper.view(np.uint8), bitorder="little"))[:self.n]
        high = places - np.arange(self.n)
        if not self.low_bits:
            return high
        bits = np.unpackbits(self.lower.view(np.uint8), bitorder="little")[:self.n * self.low_bits]
        low = bits.reshape(self.n, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits))
        return (high << self.low_bits) | low


def pack_block(ids: bytes, width: int, bounds: np.ndarray) -> bytes:
    """One block from concatenated ids (``width`` bytes each) and documents + 1 boundaries."""
    low_bits, samples, upper, lower = EliasFano.pack(bounds)
    head = _HEAD.pack(MAGIC, width, len(bounds) - 1, low_bits, len(samples), int(bounds[-1]), len(upper))
    return b"".join((head, samples.astype("<u4").tobytes(), b"\0" * (-4 * len(samples) % 8), upper, lower, ids))


class TokenBlock:
    """Reader of one block."""

    def __init__(self, data: bytes):
        magic, width, self.documents, low_bits, n_samples, self.n_ids, n_upper = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a token block")
        at = _HEAD.size
        samples = np.frombuffer(data, "<u4", n_samples, at)
        at += -(-4 * n_samples // 8) * 8
        upper = np.frombuffer(data, "<u8", n_upper // 8, at)
        at += n_upper
        n_lower = -(-(self.documents + 1) * low_bits // 64)
        lower = np.frombuffer(data, "<u8", n_lower, at)
        at += 8 * n_lower
        self.bounds = EliasFano(self.documents + 1, low_bits, samples, upper, lower)
        self.flat = np.frombuffer(data, "<u2" if width == 2 else "<u4", self.n_ids, at)

    def ids(self, i: int) -> np.ndarray:
        """Ids of document i, by two selects."""
        return self.flat[self.bounds.select(i):self.bounds.select(i + 1)]


# Fixed values of the tokenizer file that the word-wise path below relies on.
_WORD_WISE = {
    "normalizer": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                   {"type": "Lowercase"}],
    "split": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+",
    "suffix": "</w>",
}
# Letters whose normal form, lower case and class need no tables: ASCII and Latin with
# diacritics, without the dotted capital I and the two signs among them.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u0148\u014a-\u017e"
_PLAIN = re.compile(f"[!-~{_LATIN}]+")
_PARTS = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[a-z{_LATIN}]+|[0-9]|[^a-z0-9{_LATIN}]+")


def _byte_characters() -> list[str]:
    """The byte-level alphabet: printable bytes stand for themselves, the rest for 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class WordEncoder:
    """Ids of whole texts, ``width`` little-endian bytes each, equal to the tokenizer's own.

    The tokenizer's rules decide the path.  Where white space is only a boundary
    (lower case, split on letters, digits and signs, word-end suffix), texts are
    encoded word by word: words and their parts are looked up in two caches of at
    most ``cache_size`` entries, and only unknown parts reach the merge model.
    Words outside the plain alphabet, or with a special token's first characters,
    go through the tokenizer as they are.  Other tokenizers encode whole texts.
    """

    def __init__(self, path: str, cache_size: int = CACHE_SIZE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = "<u2" if self.width == 2 else "<u4"
        self.cache_size = cache_size
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.byte_characters = _byte_characters()
        rules = json.loads(self.tokenizer.to_str())
        steps = (rules.get("normalizer") or {}).get("normalizers")
        splits = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.word_wise = (
            steps == _WORD_WISE["normalizer"]
            and splits[0].get("pattern", {}).get("Regex") == _WORD_WISE["split"]
            and [x.get("type") for x in splits] == ["Split", "ByteLevel"]
            and rules["model"].get("end_of_word_suffix") == _WORD_WISE["suffix"]
            and all(t["content"].startswith("<|") for t in rules.get("added_tokens", [])))

    def _ids(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.width == 2 else 'I'}", *ids)

    def _part(self, part: str) -> bytes:
        known = self.parts.get(part)
        if known is None:
            spelled = part if part.isascii() else "".join([self.byte_characters[b] for b in part.encode()])
            known = self._ids([t.id for t in self.tokenizer.model.tokenize(spelled)])
            if len(self.parts) < self.cache_size:
                self.parts[part] = known
        return known

    def _word(self, word: bytes) -> bytes:
        if word.isalpha():  # ASCII letters only: one part
            return self._part(word.lower().decode())
        if word[:-1].isalpha() and 33 <= word[-1] <= 126 and not word[-1:].isalnum():
            return self._part(word[:-1].lower().decode()) + self._part(chr(word[-1]))
        text = word.decode("utf-8", "replace")
        if _PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join([self._part(p) for p in _PARTS.findall(text.lower())])
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if not self.word_wise:
            got = self.tokenizer.encode_batch([t.decode("utf-8", "replace") for t in texts],
                                              add_special_tokens=False)
            return [self._ids(e.ids) for e in got]
        split = [t.split() for t in texts]  # bytes.split: ASCII white space
        known = self.words
        extra = {w: self._word(w) for w in set().union(*split).difference(known)}
        if extra:
            room = max(0, self.cache_size - len(known))
            both = {**known, **extra}
            known.update(islice(extra.items(), room))
            known = both
        find = known.__getitem__
        return [b"".join(map(find, words)) for words in split]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder, with its caches, per worker process and tokenizer."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _text_groups(batches, text: int, key: int, limit: int = 8 << 20):
    """(keys, texts) with at most about ``limit`` bytes of text at a time."""
    for batch in batches:
        column = batch.column(text).cast(pa.binary())
        keys = batch.column(key).to_pylist()
        texts, size, first = [], 0, 0
        for i, value in enumerate(column):
            texts.append(value.as_py() or b"")
            size += len(texts[-1])
            if size >= limit:
                yield keys[first:i + 1], texts
                texts, size, first = [], 0, i + 1
        if texts:
            yield keys[first:], texts


def _block_writer(path: str, end_id: int, block_ids: int):
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("before", pa.int64()),
                        ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("payload", pa.binary())])

    def run(batches):
        encode = encoder(path)
        end = np.array([end_id], dtype=encode.dtype).tobytes()
        part, block, before = TaskContext.get().partitionId(), 0, 0
        keys, parts, sizes = [], [], []

        def flush():
            bounds = np.zeros(len(sizes) + 1, dtype=np.int64)
            np.cumsum(sizes, out=bounds[1:])
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int64()), pa.array([before], pa.int64()),
                 pa.array([int(bounds[-1])], pa.int64()), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([pack_block(b"".join(parts), encode.width, bounds)], pa.binary())], schema=schema)

        for doc_ids, texts in _text_groups(batches, 1, 0):
            for doc_id, ids in zip(doc_ids, encode.encode(texts)):
                keys.append(doc_id)
                parts += (ids, end)
                sizes.append(len(ids) // encode.width + 1)
            if (n := sum(sizes)) >= block_ids:
                yield flush()
                block, before = block + 1, before + n
                keys, parts, sizes = [], [], []
        if keys:
            yield flush()
    return run


def write_token_files(docs: DataFrame, out: str, tokenizer_path: str, end_id: int, key: str = "doc_id",
                      text: str = "text", block_ids: int = BLOCK_IDS, partitions: int | None = None) -> None:
    """Encode every text and write the blocks to ``out`` in ascending ``key`` order."""
    n = partitions or shuffle_partitions(docs.sparkSession)
    rows = docs.select(col(key).cast("long").alias("doc_id"), col(text).alias("text"))
    (rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id")
         .mapInArrow(_block_writer(tokenizer_path, end_id, block_ids),
                     "part int, block long, before long, n_ids long, doc_ids array<long>, payload binary")
         .write.parquet(out))


def _read_blocks(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("block", pa.int64()), ("part", pa.int32())])
    for batch in batches:
        for row in range(batch.num_rows):
            block = TokenBlock(batch.column("payload")[row].as_py())
            # Where each document starts is looked up in the block's select structure.
            bounds = np.array([block.bounds.select(i) for i in range(block.documents + 1)], dtype=np.int64)
            wide = block.flat.astype("<u4")
            crc = [zlib.crc32(wide[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:])]
            n = block.documents
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[row].values.cast(pa.int64()),
                 pa.array(bounds[:-1] + batch.column("start")[row].as_py()),
                 pa.array(np.diff(bounds)), pa.array(crc, pa.int64()),
                 pa.array(np.full(n, batch.column("block")[row].as_py())),
                 pa.array(np.full(n, batch.column("part")[row].as_py(), dtype=np.int32))], schema=schema)


def read_token_files(spark, path: str) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32, block, part."""
    blocks = spark.read.parquet(path)
    per_part = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # One row per partition of the write: a bound known beforehand.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    placed = blocks.join(F.broadcast(offsets), "part").select(
        "part", "block", (F.col("base") + F.col("before")).alias("start"), "doc_ids", "payload")
    return placed.mapInArrow(_read_blocks, "doc_id long, start long, n_tokens long, ids_crc32 long, "
                                           "block long, part int")


def op5_token_files(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = scratch_path(spark, "token-files")
    write_token_files(docs, out, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, out).select("doc_id", "start", "n_tokens", "ids_crc32")


QUERIES = {"op5_token_files": op5_token_files}
ORACLE: dict[str, str] = {}
