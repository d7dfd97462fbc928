import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import mixing
from small_corpus import corpus, docs, no_docs  # noqa: F401


def targets_of(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare the excess by weight until no source is above its cap."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    capped, goal = set(), share * sum(sizes.values())
    while True:
        left = goal - sum(cap * sizes[s] for s in capped)
        open_weight = sum(weight[s] for s in order if s not in capped)
        target = {s: cap * sizes[s] if s in capped else left * weight[s] / open_weight for s in order}
        over = {s for s in order if s not in capped and target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def mixed(df, **options):
    return mixing.mix_sources(df, **options)


def test_sizes_targets_and_taken(docs, corpus):
    rows = mixed(docs).collect()
    assert len(rows) == len(corpus)
    sizes = defaultdict(int)
    for _, text, _, source, _ in corpus:
        sizes[source] += len((text or "").encode().split())
    target, taken, biggest = targets_of(sizes), defaultdict(int), defaultdict(int)
    for r in rows:
        m = r["mix"]
        size = len((r["text"] or "").encode().split())
        assert m["size"] == size and m["source_size"] == sizes[r["source"]]
        assert m["target"] == pytest.approx(target[r["source"]])
        assert m["taken"] == m["copies"] * size and m["copies"] <= 2
        taken[r["source"]] += m["taken"]
        biggest[r["source"]] = max(biggest[r["source"]], size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= biggest[s] / 2 + 1


def test_reruns_agree_whatever_the_partitioning(docs):
    a = mixed(docs, keep=["doc_id", "text"])
    b = mixed(docs.repartition(2, "text"), keep=["doc_id", "text"])
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_residuals_meet_over_several_levels(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 3)
    rnd = random.Random(1)
    rows = [(i, " ".join(["w"] * rnd.randint(1, 40)), "hot" if i % 3 else f"s{i % 4}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixed(df, chunk_rows=8)
    gap = out.groupBy("source").agg((F.sum("mix.taken") - F.first("mix.target")).alias("gap"))
    assert all(abs(r["gap"]) <= 20 for r in gap.collect())


def test_pivotal_rounding_keeps_the_weighted_sum_and_the_expectation():
    sizes, p = np.array([5, 9, 2, 7, 3, 11]), np.array([.2, .5, .9, .4, .75, .3])
    total = np.zeros(6)
    for seed in range(4000):
        out = mixing.pivotal(sizes, p, random.Random(seed))
        assert sum((out > 0) & (out < 1)) <= 1
        assert (sizes * out).sum() == pytest.approx((sizes * p).sum())
        total += out
    assert np.allclose(total / 4000, p, atol=0.03)


def test_repeated_gives_each_row_its_copies(docs):
    out = mixed(docs)
    wanted = out.agg(F.sum("mix.copies")).first()[0]
    again = mixing.repeated(out)
    assert again.columns == docs.columns and again.count() == wanted


def test_clashing_columns_empty_table_and_one_source(spark, docs, no_docs):
    clash = docs.withColumn("mix", F.lit(1)).withColumn("size", F.lit(2)).withColumn("tie", F.lit("t"))
    out = mixed(clash)
    assert out.columns == [*clash.columns, "_mix"]
    assert mixing.repeated(out, "_mix").columns == clash.columns
    assert mixed(no_docs).isEmpty()
    one = spark.createDataFrame([(1, None, None), (2, "a b", None)], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r["mix"] for r in mixed(one).collect()}
    assert rows[1]["taken"] == 0 and rows[1]["copies"] == 1 and rows[2]["target"] == 3.0
