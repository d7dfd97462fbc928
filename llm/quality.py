"""Quality rules as a short-circuit cascade (DataFrame functions only).

Every rule is true for documents it rejects; the base rules (too few words, too
many repeated windows) are rules like others.  On a random sample of about
``sample_rows`` rows (default 1,024) each rule's rejection rate and run time are
measured, the time of an empty job taken off; the rules then run in order of
rejection per cost, and a document that one rejects is not shown to the next.
``keep_good`` computes no metric but what the rules ask for, and the three-word
windows, by far the costliest, only of documents that all rules before them let
pass.  The report returns every metric, so there the order only saves the rules
after the base.  The order changes only the work done, never a verdict.

Defined results: null text counts as empty (no words, rejected as too short);
repeated rows and ties are judged one by one; an empty table gives an empty
result; other columns pass through untouched, also when their names clash with
the metrics (metrics live in one struct column whose name the caller chooses).
Texts are judged whole.  Three-word windows and lines are compared by value
(windows through a 64-bit hash within one document).
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import WORD, col, fresh

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rule:
    """``reject(text)`` is true for documents the rule turns away."""

    name: str
    reject: Callable[[Column], Column]


def word_list(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(pattern)).cast("long")


def _lines(text: Column) -> Column:
    lines = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    return F.filter(lines, lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def _too_short(text: Column) -> Column:
    return _count(text, WORD) < 50


def _symbols(text: Column) -> Column:
    # more than one symbol per ten words
    return _count(text, SYMBOLS) * 10 > _count(text, WORD)


def _shouting(text: Column) -> Column:
    return _count(text, "[A-Z]") * 2 > _count(text, "[A-Za-z]")


def _repeated_lines(text: Column) -> Column:
    # over half of the lines equal an earlier line
    lines = _lines(text)
    return F.size(F.array_distinct(lines)) * 2 < F.size(lines)


#: Over half of the words lie in three-word windows found twice: takes the stacked projections of ``with_metrics``.
REPEATED_WORDS = Rule("repeated_words", lambda text: F.lit(False))
RULES = (Rule("too_short", _too_short), Rule("symbols", _symbols), Rule("shouting", _shouting),
         Rule("repeated_lines", _repeated_lines), REPEATED_WORDS)


def with_metrics(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add struct column ``out``: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    ``out`` must not be a column of ``df``.  Stacked projections keep each
    array materialised once per row; nothing is exploded or shuffled.  A filter on
    the metrics would be pushed below them and copy their expressions into lambdas,
    to be computed anew for every word; Catalyst leaves it above a projection that
    holds a row number.
    """
    words, grams, order, counts = (fresh(df, n) for n in ("w0", "w1", "w2", "w3"))
    t = F.coalesce(col(text), F.lit(""))
    w = F.col(words)
    df = df.withColumn(words, word_list(col(text)))
    df = df.withColumn(counts, F.struct(
        F.size(w).cast("long").alias("n_words"),
        (F.length(t) - F.regexp_count(t, F.lit(SPACE))).cast("long").alias("word_chars"),
        _count(t, SYMBOLS).alias("n_symbols"),
        (lambda lines: (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"))(
            _lines(t)).alias("n_dup_lines")))
    df = df.withColumn(grams, F.when(F.size(w) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3),
        lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))))
    g = F.col(grams)
    # Only documents that repeat some window pay for the sort.
    df = df.withColumn(order, F.when(
        F.size(F.array_distinct(g)) < F.size(g),
        F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col(order)
    repeated = F.sort_array(F.filter(
        F.transform(s, lambda x, k: F.when(
            (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)))
            | (F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))), x["i"])),
        lambda p: p.isNotNull()))
    covered = F.aggregate(
        repeated,
        F.struct(F.lit(-3).alias("at"), F.lit(0).cast("long").alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(3), p - a["at"])).alias("n")),
        lambda a: a["n"])
    n_repeat = F.when(F.size(s) > 0, covered).otherwise(F.lit(0)).cast("long")
    n_repeat = F.when(F.monotonically_increasing_id() >= 0, n_repeat)
    df = df.withColumn(out, F.struct(
        *[F.col(counts)[c].alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")],
        n_repeat.alias("n_repeat_words")))
    return df.drop(words, grams, order, counts)


def _repeats(metrics: Column) -> Column:
    return 100 * metrics["n_repeat_words"] > 50 * metrics["n_words"]


def base_failed(metrics: Column) -> Column:
    return (metrics["n_words"] < 50) | _repeats(metrics)


def _rejections(sample: DataFrame, rule: Rule) -> DataFrame:
    if rule is REPEATED_WORDS:
        rejected = _repeats(F.col("m"))
        sample = with_metrics(sample, "text", "m")
    else:
        rejected = rule.reject(F.col("text"))
    return sample.agg(F.sum(rejected.cast("long")).alias("n"))


def cascade_order(df: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES,
                  sample_rows: int = 1024) -> tuple[Rule, ...]:
    """Rules by measured rejection per second, best first, from a random sample of about ``sample_rows`` rows.

    The sample only decides the order of evaluation, never a verdict.
    """
    total = df.count()
    texts = df.select(col(text).alias("text"))
    sample = (texts.sample(False, sample_rows / total, 9) if total > sample_rows else texts).persist()
    try:
        n = sample.count()
        if not n:
            return rules

        def timed(ask: DataFrame) -> tuple[float, int]:
            took, found = [], 0
            for _ in range(2):
                began = time.perf_counter()
                found = ask.first()["n"] or 0
                took.append(time.perf_counter() - began)
            return min(took), found
        idle, _ = timed(sample.agg(F.count(F.lit(1)).alias("n")))
        scored = []
        for place, rule in enumerate(rules):
            took, rejected = timed(_rejections(sample, rule))
            scored.append((-(rejected / n) / max(took - idle, 1e-3), place, rule))
        return tuple(r for _, _, r in sorted(scored, key=lambda x: x[:2]))
    finally:
        sample.unpersist()


def first_rejection(text: Column, rules: tuple[Rule, ...]) -> Column:
    """Name of the first rule that rejects the text, else null; later rules are not evaluated."""
    return F.coalesce(*[F.when(r.reject(text), F.lit(r.name)) for r in rules],
                      F.lit(None).cast(T.StringType()))


def quality_report(df: DataFrame, text: str = "text", sample_rows: int = 1024) -> DataFrame:
    """``df`` plus ``quality`` (struct of the metrics, base_failed, kept)."""
    out, m = fresh(df, "quality"), fresh(df, "m0")
    order = cascade_order(df, text, RULES, sample_rows)
    scored = with_metrics(df, text, m)
    failed = base_failed(F.col(m))
    rest = tuple(r for r in order if r is not REPEATED_WORDS and r.name != "too_short")
    kept = F.when(failed, F.lit(False)).otherwise(first_rejection(col(text), rest).isNull())
    return scored.withColumn(out, F.struct(f"{m}.*", failed.alias("base_failed"),
                                           kept.alias("kept"))).drop(m)


def keep_good(df: DataFrame, text: str = "text", sample_rows: int = 1024) -> DataFrame:
    """The documents every rule lets pass, with their columns unchanged."""
    order = cascade_order(df, text, RULES, sample_rows)
    at = order.index(REPEATED_WORDS)
    passed = df.where(first_rejection(col(text), order[:at]).isNull())
    m = fresh(df, "m0")
    passed = with_metrics(passed, text, m).where(~_repeats(F.col(m))).drop(m)
    return passed.where(first_rejection(col(text), order[at + 1:]).isNull())


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return quality_report(docs).select("doc_id", "quality.*")


#: Documents the operator keeps or rejects, with its metrics, as DuckDB SQL over a table {docs}.
QUALITY_SQL = r"""
w AS (SELECT doc_id, coalesce(text, '') AS t,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)),
                         lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM {docs}),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
      FROM w, unnest(range(1, len(w) - 1)) AS u(i)),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
p AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM r, (VALUES (0), (1), (2)) AS v(d) GROUP BY doc_id),
m AS (SELECT w.doc_id, t, l, len(w)::BIGINT AS n_words,
             (length(t) - len(regexp_extract_all(t, '[\x20\x09-\x0D]')))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(p.n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN p USING (doc_id)),
q AS (SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
             n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
             NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR n_symbols * 10 > n_words
                  OR len(regexp_extract_all(t, '[A-Z]')) * 2 > len(regexp_extract_all(t, '[A-Za-z]'))
                  OR len(list_distinct(l)) * 2 < len(l)) AS kept FROM m)
"""

QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE = {"op9_quality_rules": "WITH " + QUALITY_SQL.format(docs="documents") + " SELECT * FROM q"}
