import math
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F

from llm import pieces
from llm.kernels import utf8_column
from small_corpus import corpus, docs, no_docs  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["Hello world", "  two  spaces \n\n tab\t▁x▁▁ ", "", "日本語テスト 🎉 ü ß ñ ́", "a", "\x00\x01\x7f", "x" * 3000,
        "á" * 50 + " " * 40 + "end", "ﬀ 龘龘 word"]


def encode(model, texts, keys):
    data, offsets = utf8_column(pa.array(texts))
    ids, first = pieces.encode_block(model, *pieces._with_blank(data, offsets), np.array(keys, dtype=np.uint64))
    return [ids[a:b].tolist() for a, b in zip(first, first[1:])]


def test_decoding_is_lossless_and_batches_do_not_matter():
    model = pieces.piece_model(MODEL, 1.0)
    got = encode(model, HARD, range(len(HARD)))
    assert [pieces.decode(model, ids) for ids in got] == [t.encode() for t in HARD]
    assert encode(model, HARD[::-1], list(range(len(HARD)))[::-1]) == got[::-1]


def test_segmentations_come_in_proportion_to_their_weight():
    model = pieces.piece_model(MODEL, 1.0)
    weight = {model.bytes[i]: w for i, w in zip(model.ids, model.weight)}

    def ways(s):
        if not s:
            yield (), 0.0
        for k in range(1, len(s) + 1):
            if s[:k] in weight:
                for rest, w in ways(s[k:]):
                    yield (s[:k], *rest), w + weight[s[:k]]

    n = 20_000
    keys = np.random.default_rng(1).integers(0, 2**62, n).tolist()
    seen = Counter(tuple(model.bytes[i] for i in ids) for ids in encode(model, ["there"] * n, keys))
    total = sum(math.exp(w) for _, w in ways(b" there"))
    want = {s: n * math.exp(w) / total for s, w in ways(b" there")}
    assert set(seen) <= set(want)
    often = [s for s in want if want[s] > 5]
    chi2 = sum((seen[s] - want[s]) ** 2 / want[s] for s in often)
    assert chi2 < 4 * len(often) + 15


def test_columns_round_trip_and_reruns(docs, corpus):
    clash = docs.withColumn("ids", F.lit(1)).withColumn("p_seed", F.lit("s"))
    out = pieces.encode_sampled(clash, MODEL)
    assert out.columns == [*clash.columns, "_ids"]
    back = pieces.decode_ids(out, MODEL, "_ids").collect()
    assert len(back) == len(corpus) and all(r["decoded"] == r["text"] for r in back)
    assert all((r["_ids"] is None) == (r["text"] is None) for r in back)
    again = pieces.encode_sampled(docs.repartition(2), MODEL).select("doc_id", "text", "ids")
    assert out.select("doc_id", "text", F.col("_ids").alias("ids")).exceptAll(again).isEmpty()
    seeded = pieces.encode_sampled(docs, MODEL, seed=1).select("doc_id", "text", "ids")
    assert not again.exceptAll(seeded).isEmpty()


def test_empty_table(no_docs):
    assert pieces.encode_sampled(no_docs, MODEL).isEmpty()
