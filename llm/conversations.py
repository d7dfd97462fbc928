"""Conversation structure repair at least cost, by Four-Russians block tables (``repair_tables``).

Rows of a conversation are taken by turn (nulls first; equal turns by role, then text).  The first fault of a row
counts: blank (nothing but white space), duplicate (role and text were there before), truncated (the last sign is no
full stop, exclamation or question mark).  Keeping a row costs 0, reroling it to user or assistant 1, deleting it 2
(blank rows and duplicates have to go), inserting an empty row 5; a truncated row that stays costs 5 more.  The
repaired roles read ``(s?(ua)+)?`` by their first letters; among cheapest repairs the ASCII-least letters win.

``repair`` returns the repaired messages in pieces of bounded size.  A conversation of at most ``LONG_ROWS`` rows and
``LONG_BYTES`` of text is one piece, made where its rows meet.  Longer ones never meet in one task: copies of a row are
counted before the shuffle, first occurrences come from a partial aggregate, rows are range-partitioned by conversation
and turn and cut into segments.  A segment tells, for every cost vector behind it, the vector in front of it and where
each state leads; these few hundred bytes are chained per conversation, and every segment is then edited on its own.

Defined results: a null role or text is one space; a null turn comes first and counts for no gap; null keys are one
conversation.  A role without a first letter s, u or a (case counts; the empty role too) can be reroled or deleted,
not kept.  Repeated rows are duplicates of each other.  Rows that tie are ordered by their values, so reruns agree.
Very long texts are read whole; an empty table gives an empty table; columns of other names do not matter.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import repair_tables as rt
from llm.common import col, written
from millstar.session import shuffle_partitions

LONG_ROWS, LONG_BYTES = 2048, 8 << 20
#: Conversations that may be broadcast as the list of long ones.
BROADCAST_LONG = 100_000
_SPACE = " \t\n\x0b\x0c\r"
_COUNTS = ["min_turn", "max_turn", "n_turns", "blank", "duplicate", "truncated", "illegal", "cost"]
_PIECE = ("conv long, piece long, n_pieces long, " + ", ".join(f"{c} long" for c in _COUNTS)
          + ", audit string, messages array<struct<role: string, text: string>>")
_MESSAGES = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_PIECE_ARROW = pa.schema([("conv", pa.int64()), ("piece", pa.int64()), ("n_pieces", pa.int64()),
                          *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()), ("messages", _MESSAGES)])
_SEGMENT_ARROW = pa.schema([
    ("part", pa.int32()), ("segment", pa.int64()), ("conv", pa.int64()), ("symbols", pa.binary()),
    ("copies", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    ("front", pa.binary()), ("leave", pa.binary()), ("first_role", pa.int32()), ("last_role", pa.int32()),
    ("first_turn", pa.int64()), ("last_turn", pa.int64()), *[(c, pa.int64()) for c in _COUNTS]])
_SEGMENT = ("part int, segment long, conv long, symbols binary, copies array<long>, roles array<string>, "
            "texts array<string>, front binary, leave binary, first_role int, last_role int, first_turn long, "
            "last_turn long, " + ", ".join(f"{c} long" for c in _COUNTS))
#: Adjacent first letters that may stand side by side.
_LEGAL = {(rt.SYSTEM, rt.USER), (rt.USER, rt.ASSISTANT), (rt.ASSISTANT, rt.USER)}


def symbol(role: Column, text: Column) -> Column:
    """The row's symbol before duplicates are known."""
    trimmed = F.rtrim(text, F.lit(_SPACE))
    first = F.substring(role, 1, 1)
    kind = (F.when(first == "s", rt.SYSTEM).when(first == "u", rt.USER).when(first == "a", rt.ASSISTANT)
            .otherwise(rt.OTHER))
    return (F.when(trimmed == "", rt.GONE)
            .otherwise(kind + F.when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), 0).otherwise(rt.UNFINISHED))
            .cast("int"))


class _Rows:
    """Rows of one conversation in order, with their counts."""

    def __init__(self, conv):
        self.conv = conv
        self.symbols, self.copies, self.rows = bytearray(), [], []
        self.counts = dict.fromkeys(_COUNTS, 0) | {"min_turn": None, "max_turn": None}
        self.first_turn = self.last_turn = self.first_role = self.last_role = None

    def add(self, turn, role, text, kind: int, seen: bool, copies: int = 1) -> None:
        c = self.counts
        if turn is not None:
            if c["min_turn"] is None:
                c["min_turn"] = turn
            c["n_turns"] += turn != c["max_turn"]
            c["max_turn"] = turn
        place = rt.role_symbol(role)
        if not self.rows:
            self.first_turn, self.first_role = turn, place
        elif (self.last_role, place) not in _LEGAL:
            c["illegal"] += 1
        c["illegal"] += copies - 1
        self.last_turn, self.last_role = turn, place
        if kind == rt.GONE:
            c["blank"] += copies
        else:
            c["duplicate"] += copies - 1 + seen
            c["truncated"] += not seen and kind >= rt.UNFINISHED
        self.symbols.append(rt.GONE if seen else kind)
        self.copies.append(copies)
        self.rows.append((role, text))

    def edited(self, behind: int, state: int, last: bool) -> tuple[str, list, int]:
        """(letters, messages, cost) for the cost vector behind and the state in front."""
        edits, _, cost = rt.trace(bytes(self.symbols), behind, state, last)
        messages = rt.repaired(self.rows, edits, state)
        letters = "".join(e + "D" * (n - 1) for e, n in zip(edits, self.copies)) + "".join(edits[len(self.copies):])
        return letters, messages, cost + rt.DELETE * (sum(self.copies) - len(self.copies))


def _pieces(found: list[tuple]) -> pa.RecordBatch:
    """Rows (conv, piece, n_pieces, counts, audit, messages) as one batch."""
    columns = [[conv, piece, n, *[counts[c] for c in _COUNTS], audit,
                [{"role": r, "text": t} for r, t in messages]] for conv, piece, n, counts, audit, messages in found]
    return pa.RecordBatch.from_arrays([pa.array([x[i] for x in columns], f.type) for i, f in enumerate(_PIECE_ARROW)],
                                      schema=_PIECE_ARROW)


def _whole(batches):
    """Sorted rows (conv, turn, role, text, kind) to one piece a conversation."""
    now, said, ready, size = None, set(), [], 0

    def done():
        audit, messages, cost = now.edited(0, rt.START, True)
        return now.conv, 0, 1, now.counts | {"cost": cost}, audit, messages

    for batch in batches:
        for conv, turn, role, text, kind in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or conv != now.conv:
                if now is not None:
                    ready.append(done())
                    if len(ready) >= 1024 or size > LONG_BYTES:
                        yield _pieces(ready)
                        ready, size = [], 0
                now, said = _Rows(conv), set()
            seen = kind != rt.GONE and (role, text) in said
            said.add((role, text))
            size += len(text)
            now.add(turn, role, text, kind, seen)
    if now is not None:
        ready.append(done())
    if ready:
        yield _pieces(ready)


def _segments(limit_rows: int, limit_bytes: int):
    """Sorted, collapsed rows (conv, turn, role, text, kind, seen, copies) to segments of bounded size."""
    def run(batches):
        part = TaskContext.get().partitionId()
        now, number, size = None, 0, 0

        def done():
            front, leave = rt.passage(bytes(now.symbols))
            roles, texts = zip(*now.rows)
            row = [part, number, now.conv, bytes(now.symbols), now.copies, roles, texts, front.astype("<i4").tobytes(),
                   leave.tobytes(), now.first_role, now.last_role, now.first_turn, now.last_turn,
                   *[now.counts[c] for c in _COUNTS]]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SEGMENT_ARROW)],
                                              schema=_SEGMENT_ARROW)

        for batch in batches:
            for conv, turn, role, text, kind, seen, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and (conv != now.conv or len(now.rows) >= limit_rows or size >= limit_bytes):
                    yield done()
                    now, number = None, number + 1
                if now is None:
                    now, size = _Rows(conv), 0
                now.add(turn, role, text, kind, seen and kind != rt.GONE, copies)
                size += len(text)
        if now is not None:
            yield done()
    return run


def _chained(table: pa.Table) -> pa.Table:
    """For each segment of a conversation: its place, the vector behind it, the state in front, and what its border
    with the segment before it adds."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["segment"]))
    behind, vectors = 0, []
    for row in reversed(rows):
        vectors.append(behind)
        behind = int(np.frombuffer(row["front"], "<i4")[behind])
    out, state, before = [], rt.START, None
    for k, (row, behind) in enumerate(zip(rows, reversed(vectors))):
        border = before is not None
        out.append({"part": row["part"], "segment": row["segment"], "piece": k, "n_pieces": len(rows),
                    "behind": behind, "state": state,
                    "joint": int(border and (before["last_role"], row["first_role"]) not in _LEGAL),
                    "shared": int(border and row["first_turn"] is not None
                                  and before["last_turn"] == row["first_turn"])})
        state = int(np.frombuffer(row["leave"], np.int8).reshape(-1, 4)[behind, state])
        before = row
    return pa.Table.from_pylist(out, schema=_CHAIN_ARROW)


_CHAIN = "part int, segment long, piece long, n_pieces long, behind int, state int, joint long, shared long"
_CHAIN_ARROW = pa.schema([("part", pa.int32()), ("segment", pa.int64()), ("piece", pa.int64()), ("n_pieces", pa.int64()),
                          ("behind", pa.int32()), ("state", pa.int32()), ("joint", pa.int64()), ("shared", pa.int64())])


def _edited(batches):
    """Segments with their place in the chain to pieces."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
            held = _Rows(row["conv"])
            held.symbols, held.copies = bytearray(row["symbols"]), row["copies"]
            held.rows = list(zip(row["roles"], row["texts"]))
            audit, messages, cost = held.edited(row["behind"], row["state"], row["piece"] == row["n_pieces"] - 1)
            counts = {c: row[c] for c in _COUNTS} | {"cost": cost}
            counts["illegal"] += row["joint"]
            counts["n_turns"] -= row["shared"]
            yield _pieces([(row["conv"], row["piece"], row["n_pieces"], counts, audit, messages)])


def _long_pieces(rows: DataFrame, limit_rows: int, limit_bytes: int) -> DataFrame:
    """Pieces of the conversations in ``rows`` (conv, turn, role, text), which may be of any size."""
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"))
    unique = written(rows.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
                     .withColumn("at", at).withColumn("said", F.sha2(F.concat(
                         F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)),
                     "conversation-rows")
    first = written(unique.groupBy("conv", "said").agg(F.min("at").alias("first_at")), "conversation-firsts")
    first = first.select(F.col("conv").alias("of"), F.col("said").alias("what"), "first_at")
    told = unique.join(first, F.col("conv").eqNullSafe(F.col("of")) & (F.col("said") == F.col("what"))).select(
        "conv", "at", "role", "text", "copies", (F.col("at") != F.col("first_at")).alias("seen"))
    parts = shuffle_partitions(rows.sparkSession)
    placed = (told.withColumn("head", F.substring("text", 1, 64))
              .repartitionByRange(parts, "conv", "at", "role", "head").sortWithinPartitions("conv", "at", "role", "text"))
    segments = written(placed.select(
        "conv", F.when(F.col("at.known"), F.col("at.turn")).alias("turn"), "role", "text",
        symbol(F.col("role"), F.col("text")).alias("kind"), "seen", "copies")
        .mapInArrow(_segments(limit_rows, limit_bytes), _SEGMENT), "conversation-segments")
    light = segments.select("conv", "part", "segment", "front", "leave", "first_role", "last_role", "first_turn",
                            "last_turn")
    chain = written(light.groupBy("conv").applyInArrow(_chained, _CHAIN), "conversation-chain")
    return segments.join(chain, ["part", "segment"]).mapInArrow(_edited, _PIECE)


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           long_rows: int = LONG_ROWS, long_bytes: int = LONG_BYTES) -> DataFrame:
    """Repaired conversations in pieces: conv, piece (from 0), n_pieces, min_turn, max_turn, n_turns, blank, duplicate,
    truncated, illegal, cost, audit, messages array<struct<role, text>>.

    Numbers, letters and messages of a conversation's pieces add up, in order of ``piece``, to the whole.
    """
    rows = df.select(col(conv).cast("long").alias("conv"), col(turn).cast("long").alias("turn"),
                     F.coalesce(col(role), F.lit(" ")).alias("role"), F.coalesce(col(text), F.lit(" ")).alias("text"))
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long_ones = written(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > long_bytes))
                        .select(F.col("conv").alias("of")), "long-conversations")
    many = long_ones.count()
    short = rows
    if many:
        listed = F.broadcast(long_ones) if many <= BROADCAST_LONG else long_ones
        is_long = F.col("conv").eqNullSafe(F.col("of"))
        short = rows.join(listed, is_long, "left_anti")
    pieces = (short.withColumn("kind", symbol(F.col("role"), F.col("text")))
              .repartition(shuffle_partitions(df.sparkSession), "conv")
              .sortWithinPartitions("conv", "turn", "role", "text").mapInArrow(_whole, _PIECE))
    if many:
        pieces = pieces.unionByName(_long_pieces(rows.join(listed, is_long, "left_semi"), long_rows, long_bytes))
    return pieces


def _summed(batches):
    """Sorted pieces to one row a conversation; only one piece and the letters are held."""
    held = None

    def done():
        counts, audit, digest = held[1:4]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], f.type) for v, f in zip([held[0], *[counts[c] for c in _COUNTS], "".join(audit),
                                                    digest.hexdigest()], _REPORT_ARROW)], schema=_REPORT_ARROW)

    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(j)[i].as_py() for j, n in enumerate(batch.schema.names)}
            if held is None or held[0] != row["conv"]:
                if held is not None:
                    yield done()
                held = [row["conv"], dict.fromkeys(_COUNTS, 0) | {"min_turn": None, "max_turn": None}, [],
                        hashlib.sha256(), True]
            counts = held[1]
            for c in _COUNTS[2:]:
                counts[c] += row[c]
            for c, choose in (("min_turn", min), ("max_turn", max)):
                counts[c] = choose((x for x in (counts[c], row[c]) if x is not None), default=None)
            held[2].append(row["audit"])
            for message in row["messages"]:
                line = f"{message['role']}:{message['text']}"
                held[3].update((line if held[4] else "\n" + line).encode())
                held[4] = False
    if held is not None:
        yield done()


_REPORT = "conv long, " + ", ".join(f"{c} long" for c in _COUNTS) + ", audit string, repaired_sha256 string"
_REPORT_ARROW = pa.schema([("conv", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("audit", pa.string()),
                           ("repaired_sha256", pa.string())])


def repair_report(pieces: DataFrame) -> DataFrame:
    """One row a conversation: the sums over its pieces, its letters and the SHA-256 of its repaired messages.

    A hash over a whole conversation is read in order by one task, piece by piece, in bounded memory; conversations of
    one piece need no shuffle.
    """
    pieces = written(pieces, "conversation-pieces")
    lines = F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["text"]))
    one = pieces.where("n_pieces = 1").select(
        "conv", *_COUNTS, "audit", F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    more = pieces.where("n_pieces > 1")
    if not more.isEmpty():
        one = one.unionByName(more.repartition(shuffle_partitions(pieces.sparkSession), "conv")
                              .sortWithinPartitions("conv", "piece").mapInArrow(_summed, _REPORT))
    gaps = F.coalesce(F.col("max_turn") - F.col("min_turn") + 1 - F.col("n_turns"), F.lit(0))
    return one.select("conv", gaps.alias("gaps"), *_COUNTS[3:], "audit", "repaired_sha256")


def damaged(df: DataFrame) -> DataFrame:
    """The query's damage, chosen by crc32 of ``conv_id:turn`` modulo 20 (nulls are one space)."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return (df.withColumn("_kind", kind).where("_kind <> 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1))))
            .select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(role).alias("role"),
                    F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate(text, ".!?", ""))
                    .otherwise(text).alias("text")))


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    report = repair_report(repair(damaged(table)))
    numbers = ["gaps", *_COUNTS[3:]]
    return table.select("conv_id").distinct().join(report, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast(T.LongType()).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


QUERIES = {"op11_conversation_repair": op11_conversation_repair}
# The same, row by row: for every state the cheapest and least letters and the messages so far.
ORACLE = {"op11_conversation_repair": r"""
WITH RECURSIVE
crc AS MATERIALIZED (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  (4294967295 - list_reduce(list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' ||
      coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)::UBIGINT),
    lambda c, b: list_reduce(range(8)::UBIGINT[], lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)),
    4294967295::UBIGINT)) % 20 AS kind FROM conversations),
d AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
  CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM crc, unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS u(copy) WHERE kind <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM d),
f AS MATERIALIZED (SELECT *, left(role, 1) AS i,
  CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
       WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS prior FROM n),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
  count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated,
  count(*) FILTER (prior IS NOT NULL AND prior || i NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS rows
  FROM f GROUP BY conv_id),
t(state, letter, cost, goal) AS (VALUES ('0', 's', 0, 's'), ('0', 'u', 0, 'u'), ('s', 'u', 0, 'u'), ('u', 'a', 0, 'a'),
  ('a', 'u', 0, 'u')),
j(state, goal, role) AS (VALUES ('0', 'u', 'user'), ('s', 'u', 'user'), ('u', 'a', 'assistant'), ('a', 'u', 'user')),
p(conv_id, k, state, cost, audit, said) AS (
  SELECT conv_id, 0::BIGINT, s.state, s.cost, s.audit, s.said FROM c, (VALUES ('0', 0, '', []::VARCHAR[]),
    ('u', 5, 'I', ['user:']), ('a', 10, 'II', ['user:', 'assistant:'])) AS s(state, cost, audit, said)
  UNION ALL
  SELECT conv_id, k, state, best.cost, best.audit, best.said FROM (
    SELECT conv_id, k, state, min({'cost': cost, 'audit': audit, 'said': said}) AS best FROM (
      SELECT e.conv_id, e.k, z.state, z.cost, z.audit, z.said FROM (
        SELECT p.conv_id, f.k, x.state, x.cost, x.audit, x.said FROM p JOIN f
          ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.k = p.k + 1,
        LATERAL (SELECT p.state, p.cost + 2 AS cost, p.audit || 'D' AS audit, p.said
          UNION ALL SELECT t.goal, p.cost + CASE f.fault WHEN 't' THEN 5 ELSE 0 END, p.audit || 'K',
            list_append(p.said, f.role || ':' || f.text) FROM t
            WHERE t.state = p.state AND t.letter = f.i AND f.fault IN ('', 't')
          UNION ALL SELECT j.goal, p.cost + 1 + CASE f.fault WHEN 't' THEN 5 ELSE 0 END, p.audit || 'R',
            list_append(p.said, j.role || ':' || f.text) FROM j
            WHERE j.state = p.state AND f.fault IN ('', 't')) AS x) AS e,
      LATERAL (SELECT e.state, e.cost, e.audit, e.said
        UNION ALL SELECT j.goal, e.cost + 5, e.audit || 'I', list_append(e.said, j.role || ':') FROM j
          WHERE j.state = e.state
        UNION ALL SELECT i.goal, e.cost + 10, e.audit || 'II', list_append(list_append(e.said, j.role || ':'),
          i.role || ':') FROM j JOIN j i ON i.state = j.goal WHERE j.state = e.state) AS z)
    GROUP BY conv_id, k, state)),
b AS (SELECT p.conv_id, min({'cost': p.cost, 'audit': p.audit, 'said': p.said}) AS best FROM p JOIN c
  ON c.conv_id IS NOT DISTINCT FROM p.conv_id AND p.k = c.rows WHERE state IN ('0', 'a') GROUP BY p.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost, coalesce(best.audit, '') AS audit,
  sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""}
