import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import tokens
from small_corpus import corpus, docs, no_docs  # noqa: F401

MODEL = public_tokenizers.path("word_bpe_49k.json")
HARD = ["It's we'll 'tis DON'T x²½ ①② Ünï ŉot İstanbul ΣΑΣ straße ǅ ĳ ſ", "<|startoftext|>abc<|endoftext|> a<|b",
        "\x00\x01 a\x7fb  x y é ́z", "日本語テスト１２３ mixed日本a1b2", "'s'S'll 'LL ''s ###$$$ !!a!!", "", "   \n\t",
        "À̀ ×÷ µ ª º", "a\x1cb \x85c", "word\x7f end.", "x" * 5000]


def test_word_encoder_equals_the_tokenizer(corpus):
    encode, plain = tokens.WordEncoder(MODEL, cache_size=50), Tokenizer.from_file(MODEL)
    assert encode.word_wise
    texts = HARD + [t for _, t, *_ in corpus if t]
    for _ in range(2):  # with cold and with full caches
        for text, ids in zip(texts, encode.encode([t.encode() for t in texts])):
            assert np.frombuffer(ids, encode.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encode, plain = tokens.WordEncoder(path), Tokenizer.from_file(path)
    assert not encode.word_wise
    for text, ids in zip(HARD, encode.encode([t.encode() for t in HARD])):
        assert np.frombuffer(ids, encode.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_elias_fano_select_and_all():
    rnd = np.random.default_rng(1)
    for n in (1, 2, 63, 64, 65, 1000):
        for top in (0, 1, 10, 10**6, 2**40):
            values = np.sort(rnd.integers(0, top + 1, n))
            low, samples, upper, lower = tokens.EliasFano.pack(values)
            ef = tokens.EliasFano(n, low, samples, np.frombuffer(upper, "<u8"), np.frombuffer(lower, "<u8"))
            assert (ef.all() == values).all() and [ef.select(i) for i in range(n)] == values.tolist()
            assert 8 * (len(upper) + len(lower)) <= n * (low + 3) + 128


def test_block_round_trip():
    docs = [np.arange(k, dtype="<u2") for k in (0, 3, 0, 70, 1)]
    bounds = np.cumsum([0] + [len(d) for d in docs])
    block = tokens.TokenBlock(tokens.pack_block(b"".join(d.tobytes() for d in docs), 2, bounds))
    assert block.documents == 5 and [block.ids(i).tolist() for i in range(5)] == [d.tolist() for d in docs]


def test_files_hold_all_ids_in_ascending_key_order(spark, docs, corpus, tmp_root):
    tokens.write_token_files(docs, f"{tmp_root}/t", MODEL, end_id=2, block_ids=500)
    got = tokens.read_token_files(spark, f"{tmp_root}/t").collect()
    plain, want = Tokenizer.from_file(MODEL), []
    for key, text, *_ in corpus:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((key, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    as_key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=as_key) == sorted(want, key=as_key)
    start, before = 0, (False, 0)
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start and (r["doc_id"] is not None, r["doc_id"] or 0) >= before
        start, before = start + r["n_tokens"], (r["doc_id"] is not None, r["doc_id"] or 0)
    assert len({(r["part"], r["block"]) for r in got}) > 3


def test_clashing_columns_and_empty_table(spark, no_docs, docs, tmp_root):
    clash = docs.withColumn("part", F.lit(1)).withColumn("payload", F.lit("x"))
    tokens.write_token_files(clash, f"{tmp_root}/c", MODEL, end_id=2)
    assert tokens.read_token_files(spark, f"{tmp_root}/c").count() == docs.count()
    tokens.write_token_files(no_docs, f"{tmp_root}/e", MODEL, end_id=2)
    assert tokens.read_token_files(spark, f"{tmp_root}/e").isEmpty()
