import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm import passages
from small_corpus import corpus, docs, no_docs  # noqa: F401


def brute(rows, length=13):
    first = {}
    for key, text in rows:
        w = (text or "").encode().split()
        for i in range(len(w) - length + 1):
            if key is not None:
                g = tuple(w[i:i + length])
                first[g] = min(first.get(g, key), key)
    out = []
    for key, text in rows:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - length + 1):
            low = first.get(tuple(w[i:i + length]))
            if low is not None and (key is None or low < key):
                gone |= set(range(i, i + length))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((-1 if key is None else key, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out)


def report(df):
    return sorted((-1 if r["doc_id"] is None else r["doc_id"], *tuple(r)[1:])
                  for r in passages.passage_report(df).collect())


def test_report_matches_brute_force(docs, corpus):
    assert report(docs) == brute([(d, t) for d, t, *_ in corpus])


@pytest.mark.parametrize("settings", [{"OPEN_ROWS": 2}, {"MAX_RUN": 2}, {"BATCH_BYTES": 200}, {"HOT_SLACK": 0},
                                      {"HOT_SLACK": 10 ** 6}])
def test_every_path_gives_the_same_words(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(passages, name, value)
    rnd = random.Random(6)
    vocab = ["a", "b", "c", "dd", "e"]
    base = [rnd.choice(vocab) for _ in range(120)]
    rows = []
    for i in range(40):
        a = rnd.randrange(90)
        rows.append((rnd.randrange(30), " ".join([rnd.choice(vocab) for _ in range(rnd.randrange(40))]
                                                 + base[a:a + rnd.randrange(12, 30)])))
    rows = list({k: (k, t) for k, t in rows}.values()) + [(77, "a " * 80), (78, "a " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert report(df) == brute(rows)


@pytest.mark.parametrize("length, gram", [(13, 4), (12, 4), (6, 5), (5, 5), (3, 1)])
@pytest.mark.parametrize("open_rows, slack", [(3, 10 ** 6), (100_000, 10 ** 6), (100_000, 2)])
def test_extension_over_small_batches(spark, monkeypatch, length, gram, open_rows, slack):
    """Groups that cross Arrow batches, both arms, even and odd lengths, repeated anchors."""
    monkeypatch.setattr(passages, "OPEN_ROWS", open_rows)
    monkeypatch.setattr(passages, "HOT_SLACK", slack)
    rnd = random.Random(length * 10 + gram)
    base = [rnd.choice("abcdefgh") for _ in range(200)]
    rows = []
    for i in range(50):
        at, size = rnd.randrange(180), rnd.randrange(2, 40)
        middle = base[at:at + size]
        if rnd.random() < 0.5:
            middle[rnd.randrange(len(middle))] = "z"
        rows.append((i, " ".join([rnd.choice("xy")] * rnd.randrange(9) + middle + [rnd.choice("uvw")] * 3)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        spans = passages.repeated_passages(df, length=length, gram=gram).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = {(r["key"], x["start"] + i) for r in spans for x in r["spans"] for i in range(x["n"])}
    first, want = {}, set()
    for key, text in rows:
        w = text.split()
        for i in range(len(w) - length + 1):
            if first.setdefault(tuple(w[i:i + length]), key) < key:
                want.add((key, i))
    assert want and got == want


def test_open_seeds_are_extended_as_maximal_repeats(spark, monkeypatch):
    """One shared passage between different neighbours: the edge windows of each seed come in runs."""
    monkeypatch.setattr(passages, "HOT_SLACK", 10 ** 6)
    shared = [f"s{i}" for i in range(30)]
    rows = [(k, " ".join([f"p{k}_{i}" for i in range(20)] + shared + [f"q{k}_{i}" for i in range(20)]))
            for k in range(6)]
    spans = {r["key"]: r["spans"] for r in passages.repeated_passages(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(spans) == [1, 2, 3, 4, 5]
    for found in spans.values():
        starts = sorted(x["start"] + i for x in found for i in range(x["n"]))
        assert starts == list(range(20, 38)) and len(found) < len(starts)


def test_remove_passages_keeps_columns(docs, corpus):
    clash = docs.withColumn("p_key", F.lit(1)).withColumn("marks", F.lit("m"))
    out = passages.remove_passages(clash)
    assert out.columns == clash.columns and out.count() == len(corpus)
    counts = {(r[0], r[1], r[2]) for r in brute([(d, t) for d, t, *_ in corpus])}
    for r in out.collect():
        key = -1 if r["doc_id"] is None else r["doc_id"]
        left = len((r["text"] or "").encode().split())
        assert any(k == key and n - gone == left for k, n, gone in counts)


def test_empty_table(no_docs):
    assert passages.passage_report(no_docs).isEmpty() and passages.remove_passages(no_docs).isEmpty()
