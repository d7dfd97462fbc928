"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams of 1 to ``ORDERS`` bytes
present in both (blended spectrum, presence not counts), divided by the root of
the two texts' own numbers.  A-Z read as a-z and every other ASCII sign as a
blank; n-grams are told apart by a hash into ``DIMS`` places.

A long text would fill the places and look like any other, so texts are read in
parts of at most ``PART_BYTES`` bytes; no presence vector covers more.

Fit.  From a bounded sample of labelled rows (about ``FIT_ROWS``, spread evenly
over the ``MAX_LANGUAGES`` most frequent labels, drawn by a hash of the key) tasks
return the presence bit vector of one part per row, also drawn by the key.  ``LANDMARKS`` of them span the Nystroem map
k(x, L) (K_LL + e)^-1/2; one-versus-rest kernel ridge regression with equal
class weights is solved there.  The sample and landmarks are the only things the
driver holds: FIT_ROWS * DIMS / 8 bytes however long the texts are.

Score.  As kernel and map are linear in the presence vector, landmarks, map and
weights multiply out to one DIMS x languages matrix; every batch of texts is one
presence matrix times that matrix.  Every part of a text votes: with its shares of
the languages (a softmax of its scores), weighed by its bytes and by how far its
best score lies above zero, so that parts which resemble no language say little.
The score is the winner's share of all votes.

Defined results: null, empty and letterless texts are ``und`` with score 0;
rows with a null label or key are scored but not learnt from; repeated rows get
equal predictions, ties go to the language first in code-point order; without
any label every text is ``und``; empty tables give empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import col, fresh
from llm.kernels import row_blocks, utf8_column

ORDERS = 4
DIMS = 1 << 15
FIT_ROWS = 4000
LANDMARKS = 192
PART_BYTES = 4096
MAX_LANGUAGES = 256
RIDGE = 1e-3
SHARPNESS = 6.0
_ROWS = 96
_BYTES = 1 << 19
_UND = "und"

# Byte classes: a-z (and A-Z folded onto it) and bytes of other letters stay, the rest is blank.
_CLASS = np.full(256, 32, dtype=np.uint32)
_CLASS[97:123] = np.arange(97, 123)
_CLASS[65:91] = np.arange(97, 123)
_CLASS[128:] = np.arange(128, 256)


def held_out(key: Column) -> Column:
    """Whether crc32 of the key as text is divisible by 5 (null for a null key)."""
    return F.crc32(key.cast("string").cast("binary")) % 5 == 0


def part_offsets(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets of all parts, number of each row's first part + total); an empty row is one empty part."""
    size = np.diff(offsets)
    count = np.maximum(1, -(-size // PART_BYTES))
    first = np.append(0, np.cumsum(count))
    inner = np.arange(first[-1]) - np.repeat(first[:-1], count)
    return np.append(np.repeat(offsets[:-1], count) + inner * PART_BYTES, offsets[-1]), first


def presence(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Presence matrix (rows x DIMS, uint8) of a few texts."""
    n = len(offsets) - 1
    out = np.zeros((n, DIMS), dtype=np.uint8)
    flat = out.reshape(-1)
    for lo in range(0, len(data), _BYTES):
        part = _CLASS[data[lo:lo + _BYTES + ORDERS - 1]]
        size = min(_BYTES, len(data) - lo)
        at = np.arange(lo, lo + size)
        row = np.searchsorted(offsets, at, side="right") - 1
        room = offsets[row + 1] - at
        base = row * DIMS
        gram = np.zeros(len(part), dtype=np.uint32)
        for order in range(1, ORDERS + 1):
            gram = gram[:len(part) - order + 1] * np.uint32(2654435761) + part[order - 1:] + np.uint32(order)
            count = min(size, len(gram))
            here = gram[:count]
            place = ((here ^ (here >> np.uint32(15))) * np.uint32(2246822519)) >> np.uint32(32 - DIMS.bit_length() + 1)
            inside = room[:count] >= order
            flat[(base[:count] + place)[inside]] = 1
    return out


def _presence_bits(batches):
    """(lang, text, key) to the presence bits of one part of each text, drawn by the key."""
    for batch in batches:
        data, offsets = utf8_column(batch.column(1))
        parts, first = part_offsets(offsets)
        draw = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) >> np.uint64(8)
        chosen = first[:-1] + (draw % np.diff(first).astype(np.uint64)).astype(np.int64)
        for lo in range(0, len(chosen), _ROWS):
            mine = chosen[lo:lo + _ROWS]
            texts = [data[parts[k]:parts[k + 1]] for k in mine]
            found = presence(np.concatenate(texts), np.append(0, np.cumsum([len(t) for t in texts])))
            bits = [x.tobytes() for x in np.packbits(found, axis=1)]
            here = batch.slice(lo, len(mine))
            yield pa.RecordBatch.from_arrays(
                [here.column(0), pa.array(bits, pa.binary()), here.column(2).cast(pa.int64())],
                names=["lang", "bits", "key"])


class Model:
    """Languages, weights (DIMS x languages) and biases; ``classify`` scores one presence matrix."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights, bias

    def raw(self, found: np.ndarray) -> np.ndarray:
        """Kernel ridge scores (rows x languages) of presence vectors."""
        norm = np.sqrt(np.maximum(1, found.sum(axis=1, dtype=np.int64)))
        return found.astype(np.float32) @ self.weights / norm[:, None] + self.bias

    def votes(self, found: np.ndarray, size: np.ndarray) -> np.ndarray:
        """What each part of ``size`` bytes says for each language."""
        raw = self.raw(found).astype(np.float64)
        top = raw.max(axis=1, keepdims=True)
        share = np.exp(SHARPNESS * (raw - top))
        share /= share.sum(axis=1, keepdims=True)
        return share * np.maximum(top, 1e-3) * np.maximum(size, 1)[:, None]

    def classify(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(language index, its share of the votes) of each text."""
        parts, first = part_offsets(offsets)
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        for lo in range(0, len(row), _ROWS):
            hi = min(len(row), lo + _ROWS)
            found = presence(data[parts[lo]:parts[hi]], parts[lo:hi + 1] - parts[lo])
            np.add.at(total, row[lo:hi], self.votes(found, np.diff(parts[lo:hi + 1])))
        best = total.argmax(axis=1)
        return best, total[np.arange(len(best)), best] / total.sum(axis=1)


def fit(labelled: DataFrame, lang: str, text: str, key: str, fit_rows: int = FIT_ROWS,
        landmarks: int = LANDMARKS, ridge: float = RIDGE) -> Model | None:
    """Model from at most about ``fit_rows`` labelled rows; None without labels."""
    rows = labelled.where(col(key).isNotNull()).select(
        col(lang).alias("lang"), col(text).alias("text"), F.xxhash64(col(key)).alias("key")).where(
        "lang is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    if not counts:
        return None
    quota = max(8, fit_rows // len(counts))
    draw = F.pmod(F.xxhash64("key", F.lit(8)), F.lit(1 << 24))
    limit = F.lit(0)
    for name, n in counts.items():
        limit = F.when(F.col("lang") == name, F.lit(int((1 << 24) * min(1.0, quota / n)))).otherwise(limit)
    sample = (rows.where(draw < limit).select("lang", "text", "key")
              .mapInArrow(_presence_bits, "lang string, bits binary, key long").collect())
    sample.sort(key=lambda r: (r["lang"], r["key"], bytes(r["bits"])))
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    of = np.array([languages.index(r["lang"]) for r in sample])
    packed = np.frombuffer(b"".join(bytes(r["bits"]) for r in sample), dtype=np.uint8).reshape(len(sample), -1)
    norm = np.sqrt(np.maximum(1, np.bitwise_count(packed).sum(axis=1, dtype=np.int64)))

    def unit(index):
        return np.unpackbits(packed[index], axis=1).astype(np.float32) / norm[index][:, None].astype(np.float32)

    each = max(1, landmarks // len(languages))
    chosen = np.concatenate([np.flatnonzero(of == k)[np.linspace(0, (of == k).sum() - 1, min(each, (of == k).sum()))
                                                     .astype(int)] for k in range(len(languages))])
    base = unit(chosen)
    value, vector = np.linalg.eigh(base.astype(np.float64) @ base.T.astype(np.float64) + 1e-6 * np.eye(len(chosen)))
    nystroem = (vector / np.sqrt(np.maximum(value, 1e-9))) @ vector.T
    left, right = np.zeros((len(chosen) + 1,) * 2), np.zeros((len(chosen) + 1, len(languages)))
    weight = 1.0 / np.bincount(of)[of]
    for lo in range(0, len(sample), 256):
        index = np.arange(lo, min(lo + 256, len(sample)))
        mapped = np.hstack([(unit(index) @ base.T).astype(np.float64) @ nystroem, np.ones((len(index), 1))])
        target = np.where(of[index][:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
        left += mapped.T @ (mapped * weight[index][:, None])
        right += mapped.T @ (target * weight[index][:, None])
    solved = np.linalg.solve(left + ridge * np.eye(len(left)), right)
    weights = base.T.astype(np.float64) @ (nystroem @ solved[:-1])
    return Model(languages, weights.astype(np.float32), solved[-1].astype(np.float32))


def predict(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` plus lang_pred and score (in fresh names where these are taken)."""
    pred, score, letter = fresh(df, "lang_pred"), fresh(df, "score"), fresh(df, "has_letter")
    if model is None:
        return df.withColumn(pred, F.lit(_UND)).withColumn(score, F.lit(0.0))
    shared = df.sparkSession.sparkContext.broadcast(model)  # DIMS x languages floats
    marked = df.withColumn(letter, F.coalesce(col(text).rlike(r"\p{L}"), F.lit(False)))
    place = df.columns.index(text)

    def run(batches):
        model = shared.value
        names = np.array([*model.languages, _UND], dtype=object)
        for batch in batches:
            data, offsets = utf8_column(batch.column(place))
            best, share = np.zeros(batch.num_rows, dtype=np.int64), np.zeros(batch.num_rows)
            for a, b in row_blocks(offsets, _BYTES):
                best[a:b], share[a:b] = model.classify(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            silent = ~batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            best[silent], share[silent] = len(model.languages), 0.0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names[best], pa.string()), pa.array(share)],
                names=[*batch.schema.names[:-1], pred, score])
    schema = df.withColumn(pred, F.lit("")).withColumn(score, F.lit(0.0)).schema
    return marked.mapInArrow(run, schema)


def op8_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit(docs.where(~held_out(F.col("doc_id"))), "lang", "text", "doc_id")
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


QUERIES = {"op8_language_id": op8_language_id}
ORACLE: dict[str, str] = {}
