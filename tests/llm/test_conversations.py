"""Conversation repair against a search over all edits."""
from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from llm import conversations as cv
from llm import repair_tables as rt

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
GOOD = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows, faults):
    """(cost, letters, messages) by search: all edit strings whose roles can still become legal."""
    best = {}

    def live(letters):
        return re.match(r"(s?(ua)*u?)?\Z", letters)

    states = {"": (0, "", ())}
    for k in range(len(rows) + 1):
        while True:  # inserts
            grown = dict(states)
            for have, (cost, letters, out) in states.items():
                for role in ("user", "assistant"):
                    to = have + role[0]
                    if live(to) and cost + 5 <= 2 * len(rows) + 12:
                        put(grown, short(to), (cost + 5, letters + "I", out + ((role, ""),)))
            if grown == states:
                break
            states = grown
        if k == len(rows):
            break
        (role, text), fault = rows[k], faults[k]
        after = {}
        for have, (cost, letters, out) in states.items():
            put(after, have, (cost + 2, letters + "D", out))
            if fault in ("blank", "duplicate"):
                continue
            extra = 5 if fault == "truncated" else 0
            if role[:1] and live(have + role[0]):
                put(after, short(have + role[0]), (cost + extra, letters + "K", out + ((role, text),)))
            for new in ("user", "assistant"):
                if live(have + new[0]):
                    put(after, short(have + new[0]), (cost + 1 + extra, letters + "R", out + ((new, text),)))
        states = after
    return min(v for have, v in states.items() if GOOD.match(have))


def short(have):
    """Role letters, without earlier pairs: what may follow is the same."""
    head, rest = ("s", have[1:]) if have[:1] == "s" else ("", have)
    return head + rest[-2 + len(rest) % 2:] if rest else head


def put(table, key, value):
    if key not in table or value[:2] < table[key][:2]:
        table[key] = value


def brute(rows):
    """Per conversation: the query's columns, rows being (conv, turn, role, text) as the operator gets them."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x, t)
                       for c, t, r, x in rows if c == conv))
        said, faults = set(), []
        for _, _, role, text, _ in mine:
            body = text.strip(WHITE)
            faults.append("blank" if not body else "duplicate" if (role, text) in said
                          else "truncated" if body[-1] not in ".!?" else "")
            said.add((role, text))
        turns = [t for *_, t in mine if t is not None]
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:])]
        cost, letters, messages = cheapest([(r, x) for _, _, r, x, _ in mine], faults)
        digest = hashlib.sha256("\n".join(f"{r}:{x}" for r, x in messages).encode()).hexdigest()
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"),
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, digest)
    return out


def got(spark, rows, **limits):
    df = spark.createDataFrame(rows, SCHEMA)
    report = cv.repair_report(cv.repair(df, **limits)).collect()
    assert len({r["conv"] for r in report}) == len(report)
    return {r["conv"]: tuple(r)[1:] for r in report}


def talk(seed, convs=60, longest=14):
    rnd = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "uploader", "Assistant"]
    texts = ["Yes.", "No!", "why", "Is it? ", "", " \n", None, "é ü?", "well\t", "ok.\x0b", "…", "a" * 40 + "."]
    rows = []
    for c in range(convs):
        for k in range(rnd.randrange(longest)):
            turn = rnd.choice([k, k, k + rnd.randrange(3), None])
            rows.append((rnd.choice([c, c, c, None]), turn, rnd.choice(roles), rnd.choice(texts)))
    return rows + rows[:7]


@pytest.mark.parametrize("seed", [1, 2])
def test_repair_is_the_least_of_the_cheapest(spark, seed):
    rows = talk(seed)
    assert got(spark, rows) == brute(rows)


def test_long_conversations_are_cut_and_chained(spark):
    rows = talk(3, convs=25, longest=40)
    rnd = random.Random(4)
    rows += [(7, rnd.choice([None, *range(30)]), rnd.choice(["user", "assistant"]), rnd.choice(["a.", "b", "c?"]))
             for _ in range(300)]
    rows += [(8, 5, "user", "the same.")] * 200   # copies of one row beyond the limit
    want = brute(rows)
    assert got(spark, rows, long_rows=4) == want
    assert got(spark, rows, long_rows=1) == want
    assert got(spark, rows, long_bytes=30) == want


def test_pieces_are_bounded_and_add_up(spark):
    rows = [(1, k, ("user", "assistant")[k % 2], f"text {k}.") for k in range(100)]
    pieces = cv.repair(spark.createDataFrame(rows, SCHEMA), long_rows=10).orderBy("piece").collect()
    assert len(pieces) >= 10 and all(len(p["messages"]) <= 11 for p in pieces)
    assert [m["text"] for p in pieces for m in p["messages"]] == [r[3] for r in rows]
    assert "".join(p["audit"] for p in pieces) == "K" * 100


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(6)] + [(None, None, None, None)]
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        want += [(c, t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    got = [tuple(r) for r in cv.damaged(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_query_keeps_every_conversation(spark, tmp_root):
    rows = [(c, 0, "user", "Hi.") for c in range(200)] + [(None, 1, "user", None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_root}/conversations.parquet")
    found = {r["conv_id"]: r for r in cv.op11_conversation_repair(spark, tmp_root).collect()}
    assert set(found) == {r[0] for r in rows}
    gone = [c for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    nothing = hashlib.sha256(b"").hexdigest()
    assert gone and all(tuple(found[c])[1:] == (0, 0, 0, 0, 0, 0, "", nothing) for c in gone)


def test_empty_table_extra_columns_and_long_text(spark):
    assert got(spark, []) == {}
    text = "word " * 400_000 + "end."
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "Yes.")], SCHEMA)
    for name in ("conv", "piece", "kind", "of", "at", "said", "audit"):
        df = df.withColumn(name, F.lit("x"))
    (row,) = cv.repair_report(cv.repair(df)).collect()
    assert row["audit"] == "KK" and row["cost"] == 0
    assert row["repaired_sha256"] == hashlib.sha256(f"user:{text}\nassistant:Yes.".encode()).hexdigest()


def test_block_tables_agree_with_single_rows():
    rnd = random.Random(9)
    t = rt.tables()
    for _ in range(300):
        symbols = bytes(rnd.randrange(rt.SYMBOLS) for _ in range(rnd.randrange(25)))
        vector = rt.END
        for symbol in reversed(symbols):
            vector = rt.before(symbol, vector)
        front, cost = rt.front_of(symbols)
        assert tuple(x + cost for x in t.vectors[front]) == vector
        assert rt.trace(symbols)[2] == vector[rt.START]
