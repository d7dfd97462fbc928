"""The corpus pipeline against brute-force versions of its stages, and the registered queries."""

import random

import public_tokenizers
import pytest

import corpus_pipeline as cp
from llm import pieces
from llm.registry import ORACLE, QUERIES
from llm.common import written
from test_mixing import targets_of
from test_quality import brute as quality
from test_shingle_join import brute as groups
from test_suffix_dedup import removed_bytes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(21)
    vocab = [f"{a}{b}" for a in "bcdfglmnprst" for b in ("a", "e", "in", "on", "ar", "um")]
    passage = " ".join(rnd.choice(vocab) for _ in range(70))
    out = []
    for i in range(50):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([20, 90, 160]))]
        text = " ".join(words)
        if i % 4 == 0:
            text += "\n" + passage + "\n" + " ".join(rnd.choice(vocab) for _ in range(30))
        if i % 6 == 5:
            near = out[-1][1].split(" ")
            near[0] = "other"
            text = " ".join(near)
        if i % 9 == 8:
            text = text.upper()
        out.append((i, text, "en", f"s{i % 3}" if i % 10 else None, len(text)))
    return out + [(60, None, None, None, None), (61, "", "en", "s0", 0), out[3]]


def test_stages_match_brute_force(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).repartition(4)
    frames = {}
    for name, stage in cp.STAGES:
        docs = written(stage(spark, docs, ""), "test-stage")
        frames[name] = docs
        if name != "sentencepiece":
            assert docs.columns == [c.split()[0] for c in DOCS.split(", ")]
    good = [r for r in rows if quality(r[1])[-1]]
    assert sorted(r["doc_id"] for r in frames["quality_rules"].collect()) == sorted(r[0] for r in good)
    low = {c for _, n, c in groups([(r[0], r[1]) for r in good])}
    one = [r for r in {r[0]: r for r in good}.values() if r[0] in low]
    assert sorted(r["doc_id"] for r in frames["ngram_jaccard"].collect()) == sorted(low)
    gone = removed_bytes([r[1].encode() for r in one], 200)
    left = {r[0]: bytes(b for b, g in zip(r[1].encode(), flags) if not g).decode("utf-8", "ignore")
            for r, flags in zip(one, gone)}
    cleaned = {r["doc_id"]: r for r in frames["suffix_dedup"].collect()}
    assert {k: r["text"] for k, r in cleaned.items()} == left
    assert all(r["n_chars"] == len(r["text"]) for r in cleaned.values())
    sizes = {}
    for r in cleaned.values():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len(r["text"].split())
    target, taken = targets_of(sizes), dict.fromkeys(sizes, 0)
    for r in frames["mixing"].collect():
        assert r["text"] == left[r["doc_id"]]
        taken[r["source"]] += len(r["text"].split())
    biggest = max(len(t.split()) for t in left.values())
    assert all(abs(taken[s] - target[s]) <= biggest / 2 + 1 for s in sizes)
    model = pieces.piece_model(public_tokenizers.path(cp.PIECE_MODEL), 1.0)
    last = frames["sentencepiece"].collect()
    assert len(last) == frames["mixing"].count()
    assert all(pieces.decode(model, r["ids"]).decode() == left[r["doc_id"]] and r["n_ids"] == len(r["ids"]) for r in last)


def test_empty_table_passes_every_stage(spark):
    docs = spark.createDataFrame([], DOCS)
    for _, stage in cp.STAGES:
        docs = written(stage(spark, docs, ""), "test-empty")
        assert docs.isEmpty()


def test_registry_names_one_query_per_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "ngram_jaccard", "suffix_dedup", "mixing", "sentencepiece"]
