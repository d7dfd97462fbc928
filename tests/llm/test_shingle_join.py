import random
import re

import pytest
from pyspark.sql import functions as F

from llm import shingle_join as sj
from small_corpus import corpus, docs, no_docs  # noqa: F401

_FOLD = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_set(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_FOLD))
    if len(words) >= 5:
        return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    return frozenset([tuple(words)]) if words else frozenset()


def brute(rows):
    """component number of every row, by comparing all pairs of sets."""
    sets = [shingle_set(t) for _, t in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                part[max(root(i), root(j))] = min(root(i), root(j))
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[root(i)] = min(low.get(root(i), key), key)
    return [(key, len(sets[i]), low.get(root(i))) for i, (key, _) in enumerate(rows)]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def got(df, **options):
    return ordered([(r["key"], r["n_shingles"], r["component_id"])
                    for r in sj.near_duplicate_groups(df, **options).collect()])


def test_groups_match_all_pairs(docs, corpus):
    assert got(docs) == ordered(brute([(d, t) for d, t, *_ in corpus]))


@pytest.mark.parametrize("block,segment,map_block", [(4, 3, 8192), (3, 48, 6)])
def test_large_blocks_come_in_parts_without_losing_links(spark, monkeypatch, block, segment, map_block):
    monkeypatch.setattr(sj, "BLOCK", block)
    monkeypatch.setattr(sj, "SEGMENT", segment)
    monkeypatch.setattr(sj, "MAP_BLOCK", map_block)
    rnd = random.Random(block)
    vocab = [f"w{i}" for i in range(200)]
    rows = []
    for base in range(6):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([20, 60, 90]))]
        for _ in range(rnd.choice([2, 30])):
            copy = list(words)
            for _ in range(rnd.randint(0, 3)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocab)
            rows.append((len(rows) + 1, " ".join(copy)))
    rnd.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert got(df) == ordered(brute(rows))


def test_ratio_exactly_four_fifths_links(spark):
    a = " ".join(f"a{i}" for i in range(13))                       # 9 shingles
    b = " ".join([f"a{i}" for i in range(12)] + ["z"])             # shares 8 of 10: links
    c = " ".join([f"a{i}" for i in range(11)] + ["y", "x"])        # shares 7 of 11 with a
    df = spark.createDataFrame([(3, a), (2, b), (1, c)], "doc_id long, text string")
    assert got(df) == ordered(brute([(3, a), (2, b), (1, c)]))
    assert got(df)[2] == (3, 9, 2)


def test_keep_first_keeps_one_of_each_group(docs, corpus):
    clash = docs.withColumn("s_key", F.lit(1)).withColumn("component", F.lit("c"))
    kept = sj.keep_first(clash)
    assert kept.columns == clash.columns
    rows = [(d, t) for d, t, *_ in corpus]
    groups = {c for (d, n, c) in brute(rows) if n and c is not None}
    alone = sum(n == 0 or c is None for _, n, c in brute(rows))  # no words, or a null key without partners
    out = kept.collect()
    assert len(out) == len(groups) + alone
    assert {r["doc_id"] for r in out if shingle_set(r["text"]) and r["doc_id"] is not None} == groups


def test_trie_finds_every_link_of_random_sets():
    import numpy as np
    rnd = random.Random(2)
    levels = np.zeros(sj.BUCKETS, dtype=np.uint8)
    for _ in range(60):
        base = [np.uint64(rnd.getrandbits(64)) for _ in range(rnd.choice([5, 20, 70]))]
        sets = []
        for _ in range(8):
            s = {x for x in base if rnd.random() > rnd.choice([0.02, 0.15])} | {
                np.uint64(rnd.getrandbits(64)) for _ in range(rnd.randint(0, 3))}
            sets.append(np.array(sorted(s), dtype=np.uint64))
        sets = [s for s in sets if len(s)]
        n = len(sets)
        links = sj._block_links(sets, levels, list(range(n)), np.zeros(n, dtype=np.int64))
        part = sj._Union(list(range(n)))
        for i, j in links:
            a, b = set(sets[i].tolist()), set(sets[j].tolist())
            assert 5 * len(a & b) >= 4 * len(a | b)
            part.join(i, j)
        for i in range(n):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if 5 * len(a & b) >= 4 * len(a | b):
                    assert part.root(i) == part.root(j)


def test_empty_table(no_docs):
    assert sj.near_duplicate_groups(no_docs).isEmpty() and sj.keep_first(no_docs).isEmpty()
