import re

from pyspark.sql import functions as F

from llm import quality
from small_corpus import corpus, docs, no_docs  # noqa: F401


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    loud, letters = len(re.findall("[A-Z]", text)), len(re.findall("[A-Za-z]", text))
    kept = not (failed or symbols * 10 > len(words) or loud * 2 > letters or len(set(lines)) * 2 < len(lines))
    return (len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed, kept)


def test_metrics_and_verdict_match_brute_force(docs, corpus):
    out = quality.quality_report(docs.select("doc_id", "text")).select("doc_id", "text", "quality.*")
    got = sorted((tuple(r)[2:], r["text"] or "") for r in out.collect())
    assert got == sorted((brute(t), t or "") for _, t, *_ in corpus)


def test_order_of_rules_does_not_change_verdicts(docs):
    text = F.col("text")
    forward = docs.select(quality.first_rejection(text, quality.RULES).isNull().alias("k"), "doc_id", "text")
    back = docs.select(quality.first_rejection(text, quality.RULES[::-1]).isNull().alias("k"), "doc_id", "text")
    assert forward.exceptAll(back).isEmpty()


def test_cascade_puts_the_best_rejection_per_cost_first(spark):
    df = spark.createDataFrame([("ONE TWO " * 30 + str(i),) for i in range(200)], "text string")
    assert quality.cascade_order(df)[0].name == "shouting"
    assert quality.cascade_order(df.where("text = ''")) == quality.RULES


def test_keep_good_keeps_columns_and_clashing_names(docs, spark):
    clash = docs.withColumn("quality", F.lit(1)).withColumn("w0", F.lit("x")).withColumn("row", F.lit(2))
    kept = quality.keep_good(clash)
    assert kept.columns == clash.columns
    wanted = {r["doc_id"] for r in quality.quality_report(docs).where("quality.kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == wanted and wanted


def test_no_python_in_the_plan(docs):
    plan = quality.quality_report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan


def test_empty_table(no_docs):
    assert quality.quality_report(no_docs).isEmpty() and quality.keep_good(no_docs).isEmpty()


def test_kept_documents_do_not_depend_on_the_order(spark, docs, monkeypatch):
    want = sorted(r["doc_id"] or -1 for r in quality.quality_report(docs).where("quality.kept").collect())
    assert want
    for shift in range(len(quality.RULES)):
        order = quality.RULES[shift:] + quality.RULES[:shift]
        monkeypatch.setattr(quality, "cascade_order", lambda *a, order=order: order)
        assert sorted(r["doc_id"] or -1 for r in quality.keep_good(docs).collect()) == want


def test_windows_are_computed_behind_cheaper_rules(docs, monkeypatch):
    monkeypatch.setattr(quality, "cascade_order", lambda *a: quality.RULES)
    plan = quality.keep_good(docs)._jdf.queryExecution().optimizedPlan().toString()
    windows = min(i for i, line in enumerate(plan.splitlines()) if "xxhash64" in line)
    first = max(i for i, line in enumerate(plan.splitlines()) if "too_short" in line)
    assert first > windows      # the filter of the rules before lies below the windows
