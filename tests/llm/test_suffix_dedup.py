import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import suffix_dedup as sd
from llm import suffix_sort as ss
from small_corpus import corpus, docs, no_docs  # noqa: F401


def removed_bytes(texts, length):
    """Per text: whether each byte is covered by a repeated window."""
    count = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if count[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append(gone)
    return out


def brute(texts, length):
    out = []
    for t, gone in zip(texts, removed_bytes(texts, length)):
        kept = bytes(b for b, g in zip(t, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def report(df, length=200):
    return sorted(tuple(r)[1:] for r in sd.dedup_report(df, length=length).collect())


def test_report_matches_brute_force(docs, corpus):
    texts = [(t or "").encode() for _, t, *_ in corpus]
    assert report(docs) == sorted(brute(texts, 200))


@pytest.mark.parametrize("settings", [{}, {"HOT_CONTENTS": 1}, {"OPEN_ROWS": 2}, {"MAX_RUN": 7},
                                      {"BATCH_BYTES": 300}])
def test_every_path_gives_the_same_spans(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(sd, name, value)
    rnd = random.Random(3)
    base = "".join(rnd.choice("abc ") for _ in range(900))
    rows = []
    for i in range(40):
        a = rnd.randrange(700)
        text = "".join(rnd.choice("abc ") for _ in range(rnd.randrange(300))) + base[a:a + rnd.randrange(200, 420)]
        rows.append((i, text + "".join(rnd.choice("abc ") for _ in range(rnd.randrange(200)))))
    rows += [(90, "ab" * 400), (91, "z" * 700), (92, base[:199]), (93, base[:200])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert report(df) == sorted(brute([t.encode() for _, t in rows], 200))


def settled(rows, size):
    """Marks of seed rows (7 numbers each) fed to a settler in batches of ``size``: sets by kind."""
    settler, marks = sd._Settler(), []
    for a in range(0, len(rows), size):
        marks += settler.feed(np.array(rows[a:a + size], dtype=np.int64).T, final=False)
    marks += settler.feed(np.zeros((7, 0), dtype=np.int64), final=True)
    out = {sd.REPEATED: set(), sd.SINGLE: set(), sd.WITNESS: set()}
    for batch in marks:
        for *place, kind in zip(*(c.to_pylist() for c in batch.columns)):
            out[kind].add(tuple(place))
    return out


def test_anchors_settled_early_lose_nothing(monkeypatch):
    rnd = random.Random(5)
    for _ in range(300):
        rows = []
        for anchor in range(rnd.randint(1, 4)):
            for content in range(rnd.randint(1, 7)):
                weights = [rnd.choice([1, 1, 2]) for _ in range(rnd.choice([1, 1, 2, 3, 9]))]
                rows += [(anchor, content, len(rows) + k, 0, 0, 1, w) for k, w in enumerate(weights)]
        rows += [(9, 0, 1000, 7, 300 * k, 40, 0) for k in range(rnd.choice([0, 1, 12]))]  # merged places of one text
        monkeypatch.setattr(sd, "OPEN_ROWS", 10**6)
        whole, of = settled(rows, len(rows)), {(r[2], r[3]): r[:2] for r in rows}
        for open_rows in (1, 2, 5):
            monkeypatch.setattr(sd, "OPEN_ROWS", open_rows)
            got = settled(rows, rnd.choice([1, 2, 3, 8, 100]))
            assert got[sd.REPEATED] == whole[sd.REPEATED] and got[sd.SINGLE] == whole[sd.SINGLE]
            assert {of[m[:2]] for m in got[sd.WITNESS]} >= {of[m[:2]] for m in whole[sd.WITNESS]}


def test_small_arrow_batches_and_open_anchors_give_the_same_spans(spark, monkeypatch):
    settle = sd._settled

    def settled_early(batches):
        before, sd.OPEN_ROWS = sd.OPEN_ROWS, 2  # in the worker
        try:
            yield from settle(batches)
        finally:
            sd.OPEN_ROWS = before

    monkeypatch.setattr(sd, "_settled", settled_early)
    rnd = random.Random(6)

    def noise(n):
        return "".join(rnd.choice("abcdefgh ") for _ in range(n))

    base, texts = noise(480), []
    for copies in [3] * 20 + [1] * 3:  # most contents of an anchor are repeated, singles are rare
        a = rnd.randrange(150)
        texts += [noise(40) + base[a:a + rnd.randrange(230, 330)] + noise(40)] * copies
    rnd.shuffle(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(12)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "10")
    try:
        assert report(df) == sorted(brute([t.encode() for t in texts], 200))
    finally:
        spark.conf.set(name, before)


def test_suffix_order_and_prefixes_match_sorting(monkeypatch):
    rnd = random.Random(4)
    for _ in range(120):
        monkeypatch.setattr(ss, "BLOCK", rnd.choice([7, 64, 1 << 19]))
        monkeypatch.setattr(ss, "IN_MEMORY", rnd.choice([0, 1 << 23]))
        letters, n = rnd.choice([1, 2, 3, 256]), rnd.randint(1, 300)
        text = bytes(rnd.randrange(letters) for _ in range(n))
        if rnd.random() < .5:
            text = (text[:20] * 40)[:n]
        depth, n = rnd.choice([5, 30, 200]), len(text)
        places = np.array(sorted(rnd.sample(range(n), rnd.randint(1, n))))
        padded = np.frombuffer(text + bytes(depth + 8), np.uint8)
        order, prefixes = [], []
        for p, lcp in ss.sorted_suffixes(padded, n, places, depth, rnd.choice([5, 50, 1 << 20])):
            order += p.tolist()
            prefixes += lcp.tolist()
        want = sorted(places.tolist(), key=lambda p: text[p:p + depth])
        assert sorted(order) == places.tolist()
        assert [text[p:p + depth] for p in order] == [text[p:p + depth] for p in want]
        for k in range(1, len(order)):
            a, b = text[order[k - 1]:][:depth], text[order[k]:][:depth]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefixes[k] == same


def test_remove_repeats_keeps_columns_and_null_texts(docs, corpus):
    clash = docs.withColumn("sd_key", F.lit(5)).withColumn("spans", F.lit("s"))
    out = sd.remove_repeats(clash)
    assert out.columns == clash.columns
    texts = [(t or "").encode() for _, t, *_ in corpus]
    want = []
    for (_, t, *_), gone in zip(corpus, removed_bytes(texts, 200)):
        kept = bytes(b for b, g in zip((t or "").encode(), gone) if not g)
        want.append("null" if t is None else kept.decode("utf-8", "ignore"))
    assert sorted("null" if r["text"] is None else r["text"] for r in out.collect()) == sorted(want)


def test_empty_table(no_docs):
    assert sd.dedup_report(no_docs).isEmpty() and sd.remove_repeats(no_docs).isEmpty()
