from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def corpus():
    """Rows (doc_id, text, lang, source, n_chars): shared passages, copies, near copies, nulls, ties,
    repeated rows, empty, very short and long texts, odd characters."""
    rnd = random.Random(11)
    vocab = [f"{a}{b}" for a in ("ba", "cu", "dé", "fo", "gu", "lö", "the", "and") for b in
             ("", "ka", "mi", "no", "ru", "st", "ing", "tion")]
    passage = " ".join(rnd.choice(vocab) for _ in range(60))
    rows = []
    for i in range(60):
        words = [rnd.choice(vocab) for _ in range(rnd.choice([3, 30, 80, 200]))]
        text = " ".join(words)
        if i % 3 == 0:
            text += "\n" + passage + ".\n" + " ".join(rnd.choice(vocab) for _ in range(25))
        if i % 7 == 0 and rows:
            text = rows[rnd.randrange(len(rows))][1] or text        # an exact copy
        elif i % 5 == 0 and rows:
            near = (rows[-1][1] or text).split(" ")                  # a near copy
            near[rnd.randrange(len(near))] = "changed"
            text = " ".join(near)
        rows.append((i + 1, text, rnd.choice(["en", "de", None]), rnd.choice(["s1", "s2", "z", None]), len(text)))
    rows += [
        (100, None, "en", "s1", None), (101, "", "en", None, 0), (102, " \n\t ", None, "s2", 4),
        (103, "one two", "de", "s1", 7), (104, "ONE\ttwo", "de", "s1", 7),
        (105, "ab " * 3000, "en", "z", 9000), (106, "x" * 5000, "en", "z", 5000),
        (107, "日本語 テスト ▁▁ \x00 é́ 🎉 ### | | |", None, "s2", 20),
        (None, "a text of a null key " + passage, "en", "s2", 10),
        (None, "another null key", None, None, None),
    ]
    rows += [rows[5], rows[5], (105, "ab " * 3000, "en", "z", 9000)]  # repeated rows
    rnd.shuffle(rows)
    return rows


@pytest.fixture()
def docs(spark, corpus):
    return spark.createDataFrame(corpus, DOCS).repartition(5)


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def as_utf8(text):
    return (text or "").encode()
