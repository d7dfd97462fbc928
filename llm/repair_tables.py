"""Least-cost conversation repair over symbols, by block tables (Four Russians).

A row is one symbol: the first letter of its role (system, user, assistant, other), whether it ends unfinished, or
that it has to go.  The repaired roles must read ``(s?(ua)+)?``; the reader of that pattern has four states.  A cost
vector holds, for every state, the least cost of repairing the rows still to come.  Its entries differ by at most a few
units, so with the least one taken off only a handful of vectors exist.  The tables give for every such vector and every
block of BLOCK symbols the vector before the block and the cost taken off: rows are read from the end, a block a lookup.

For the trace each block is expanded backward once more, from the vector behind it, and its rows are edited from the
left, always by the first of D, I, K, R that keeps the cost least.  All choices are compared at the same place and
state, so the edits are the ASCII-least of all cheapest ones.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BLOCK = 4
SYSTEM, USER, ASSISTANT, OTHER = range(4)
UNFINISHED = 4   # added to the role
GONE = 8         # blank or said before
SYMBOLS = 9
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
# The costs of the edits.
REROLE, DELETE, INSERT, UNFINISHED_COST = 1, 2, 5, 5
#: What the pattern expects next; also where an inserted or reroled row leads.
TURN = (AFTER_USER, AFTER_USER, AFTER_ASSISTANT, AFTER_USER)
ROLE = {AFTER_USER: "user", AFTER_ASSISTANT: "assistant"}
END = (0, 2 * INSERT, INSERT, 0)


def kept_state(role: int, state: int) -> int | None:
    """The state after a row kept as it is, or None."""
    if role == SYSTEM:
        return AFTER_SYSTEM if state == START else None
    turn = TURN[state]
    return turn if role < OTHER and turn == (AFTER_USER if role == USER else AFTER_ASSISTANT) else None


def _edits(symbol: int, state: int, behind) -> list[tuple[str, int, int]]:
    """(letter, cost with all that follows, state after it) of the row's edits but inserting, in order of letters."""
    out = [("D", DELETE + behind[state], state)]
    if symbol != GONE:
        extra = UNFINISHED_COST if symbol >= UNFINISHED else 0
        kept = kept_state(symbol % UNFINISHED, state)
        if kept is not None:
            out.append(("K", extra + behind[kept], kept))
        out.append(("R", REROLE + extra + behind[TURN[state]], TURN[state]))
    return out


def before(symbol: int, behind) -> tuple[int, ...]:
    """The cost vector in front of a row, from the one behind it."""
    least = [min(cost for _, cost, _ in _edits(symbol, s, behind)) for s in range(4)]
    user = min(least[AFTER_USER], INSERT + least[AFTER_ASSISTANT])
    assistant = min(least[AFTER_ASSISTANT], INSERT + least[AFTER_USER])
    return (min(least[START], INSERT + user), min(least[AFTER_SYSTEM], INSERT + user), user, assistant)


def _row_edits(symbol: int, state: int, behind) -> tuple[str, int]:
    """(inserts and the row's own edit, state after it)."""
    front, letters = before(symbol, behind), ""
    while True:
        choices = _edits(symbol, state, behind) + [("I", INSERT + front[TURN[state]], TURN[state])]
        letter, _, after = min(c for c in choices if c[1] == front[state])
        letters += letter
        state = after
        if letter != "I":
            return letters, state


class Tables:
    """All normalised cost vectors and their transitions by rows and by blocks."""

    def __init__(self):
        self.vectors: list[tuple[int, ...]] = [END]
        number = {END: 0}
        rows = []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(SYMBOLS):
                front = before(symbol, vector)
                off = min(front)
                front = tuple(x - off for x in front)
                if front not in number:
                    number[front] = len(self.vectors)
                    self.vectors.append(front)
                row.append((number[front], off, [_row_edits(symbol, s, vector) for s in range(4)]))
            rows.append(row)
        self.edits = [[x[2] for x in row] for row in rows]
        self.row = np.array([[x[0] for x in row] for row in rows], dtype=np.int32)
        self.row_cost = np.array([[x[1] for x in row] for row in rows], dtype=np.int32)
        self.row_exit = np.array([[[s for _, s in x[2]] for x in row] for row in rows], dtype=np.int8)
        n = len(self.vectors)
        front = np.arange(n, dtype=np.int32)[:, None]
        cost = np.zeros((n, 1), dtype=np.int32)
        leave = np.broadcast_to(np.arange(4, dtype=np.int8), (n, 1, 4))
        for _ in range(BLOCK):  # one more row on the left
            size = front.shape[1]
            entered = self.row_exit[front]                                    # vector, code, symbol, state
            leave = np.take_along_axis(np.broadcast_to(leave[:, :, None, :], entered.shape), entered.astype(np.int64), 3)
            leave = leave.transpose(0, 2, 1, 3).reshape(n, SYMBOLS * size, 4)
            cost = (cost[:, :, None] + self.row_cost[front]).transpose(0, 2, 1).reshape(n, SYMBOLS * size)
            front = self.row[front].transpose(0, 2, 1).reshape(n, SYMBOLS * size)
        #: [vector behind, block]: vector in front, cost taken off; and by state in front: state behind.
        self.block, self.block_cost, self.block_exit = front, cost, leave
        self.expanded = lru_cache(maxsize=1 << 16)(self._expanded)

    def _expanded(self, behind: int, code: int, state: int) -> tuple[list[str], int]:
        """Edits of a block's rows entered in ``state``, and the state behind it."""
        symbols = [code // SYMBOLS ** (BLOCK - 1 - i) % SYMBOLS for i in range(BLOCK)]
        vectors = [behind]
        for symbol in reversed(symbols[1:]):
            vectors.append(int(self.row[vectors[-1], symbol]))
        out = []
        for symbol, vector in zip(symbols, reversed(vectors)):
            letters, state = self.edits[vector][symbol][state]
            out.append(letters)
        return out, state


@lru_cache(maxsize=1)
def tables() -> Tables:
    return Tables()


def _cut(symbols: bytes) -> tuple[list[int], list[int]]:
    """(symbols in front of the first whole block, block codes)."""
    odd = len(symbols) % BLOCK
    rest = np.frombuffer(symbols, np.uint8)[odd:].reshape(-1, BLOCK).astype(np.int64)
    return list(symbols[:odd]), (rest @ SYMBOLS ** np.arange(BLOCK - 1, -1, -1)).tolist()


def front_of(symbols: bytes, behind: int = 0) -> tuple[int, int]:
    """(vector in front of the rows, cost taken off) for the vector behind them."""
    t = tables()
    single, blocks = _cut(symbols)
    cost = 0
    for code in reversed(blocks):
        cost += int(t.block_cost[behind, code])
        behind = int(t.block[behind, code])
    for symbol in reversed(single):
        cost += int(t.row_cost[behind, symbol])
        behind = int(t.row[behind, symbol])
    return behind, cost


def trace(symbols: bytes, behind: int = 0, state: int = START, last: bool = True) -> tuple[list[str], int, int]:
    """(edits of every row with the inserts before it, state behind, cost).

    ``last``: nothing follows; the inserts that end the pattern come as one more element.
    """
    t = tables()
    single, blocks = _cut(symbols)
    vectors, cost = [behind], 0
    for code in reversed(blocks):
        cost += int(t.block_cost[vectors[-1], code])
        vectors.append(int(t.block[vectors[-1], code]))
    for symbol in reversed(single):
        cost += int(t.row_cost[vectors[-1], symbol])
        vectors.append(int(t.row[vectors[-1], symbol]))
    cost += t.vectors[vectors.pop()][state]
    out = []
    for symbol in single:
        letters, state = t.edits[vectors.pop()][symbol][state]
        out.append(letters)
    for code in blocks:
        letters, state = t.expanded(vectors.pop(), code, state)
        out += letters
    if not last:
        return out, state, cost - t.vectors[behind][state]
    out.append("I" * (END[state] // INSERT))
    return out, state, cost


def passage(symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For every vector behind the rows: the vector in front, and for each state in front the state behind."""
    t = tables()
    single, blocks = _cut(symbols)
    front, seen = np.arange(len(t.vectors)), []
    for code in reversed(blocks):
        seen.append(front)
        front = t.block[front, code]
    for symbol in reversed(single):
        seen.append(front)
        front = t.row[front, symbol]
    state = np.broadcast_to(np.arange(4), (len(front), 4))
    for symbol in single:
        behind = seen.pop()
        state = t.row_exit[behind[:, None], symbol, state]
    for code in blocks:
        behind = seen.pop()
        state = t.block_exit[behind[:, None], code, state]
    return front.astype(np.int32), state.astype(np.int8)


def repaired(rows, edits: list[str], state: int = START) -> list[tuple[str, str]]:
    """The (role, text) list that the edits make of ``rows`` (role, text), entered in ``state``."""
    out = []
    for k, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "K":
                out.append(rows[k])
                state = kept_state(role_symbol(rows[k][0]), state)
                continue
            state = TURN[state]
            out.append((ROLE[state], rows[k][1] if letter == "R" else ""))
    return out


def role_symbol(role: str) -> int:
    at = "sua".find(role[0]) if role else -1
    return at if at >= 0 else OTHER
