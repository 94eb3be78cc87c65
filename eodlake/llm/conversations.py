"""Conversation structure repair by iterative-deepening A*.

Rows of a conversation, in order of turn, are kept, given a role, deleted, or preceded by inserted empty rows, so that
the roles read system?, (user, assistant)+ or there is no row. `search` goes depth first through the edits in ASCII order
(D, I, K, R) under a bound on the cost; a bound that fails is raised to the least estimate beyond it, and states
that failed with as much left are not entered again. So the first accepting path is a cheapest one, and the ASCII-least
of those. Where a role must be given or a row inserted the pattern leaves one choice, so the letters tell all.

A conversation of up to WHOLE rows is one search. A longer one is searched piece by piece, for each pair of states
at the ends of a piece; pieces end on a row, so of two different edits of a piece neither begins the other, and joining
the best ones piece by piece keeps both cost and order exact. Memory is WHOLE rows and up to four open paths (their letters
and running hashes), however long the conversation.

A repaired conversation is hashed as a whole, which only works from its first row to its last. So a conversation
goes through one task, as a sorted stream; faults are found and texts damaged before that, spread over all tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eodlake.llm.common import WORD

#: Rows of a conversation that is searched as a whole, and of a piece of a longer one.
WHOLE, PIECE = 64, 8
# Costs of the edits, as the contract states them.
GIVE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: State after each role: 0 nothing yet, 1 after system, 2 after user, 3 after assistant.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an inserted or re-roled row gets in a state, user or assistant.
GIVEN = ("u", "u", "a", "u")
ACCEPTS = (True, False, False, True)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


@lru_cache(maxsize=1 << 16)
def search(rows: str, start: int, goal: int | None) -> tuple[int, str] | None:
    """(cost, letters) of the cheapest edits of `rows` from state `start`, the ASCII-least of them; None if there are none.

    `rows` has two signs a row: the initial of its role (`?` for one that can't be kept) and its fault: `-` none,
    `x` must go, `t` truncated. Goal None: any accepting state, at the end of a conversation. Otherwise that state,
    reached by an edit of the last row.
    """
    n = len(rows) // 2
    roles, faults = rows[::2], rows[1::2]
    least = [0] * (n + 1)  # no edits cost less from row i on
    system = [False] * (n + 1)  # a system row can be kept from row i on
    for i in range(n - 1, -1, -1):
        if faults[i] == "x":
            row = DELETE
        else:
            row = min(DELETE, (TRUNCATED if faults[i] == "t" else 0) + (GIVE if roles[i] not in "sua" else 0))
        least[i] = least[i + 1] + row
        system[i] = system[i + 1] or (roles[i] == "s" and faults[i] != "x")

    def estimate(i: int, state: int) -> int | None:
        """A bound from below on the cost of what is left; None if the goal is out of reach."""
        if goal is None or goal > 1:
            return least[i]
        if state == goal:  # a role can't be taken back: all the rest goes
            return DELETE * (n - i)
        return DELETE * (n - i - 1) if goal == 1 and state == 0 and system[i] else None

    failed: dict[tuple[int, int], int] = {}

    def steps(i: int, state: int):
        """(letter, cost, next row, next state) of the edits possible here, in ASCII order."""
        if i < n:
            yield "D", DELETE, i + 1, state
        if i < n or goal is None:
            yield "I", INSERT, i, NEXT[state][GIVEN[state]]
        if i < n and faults[i] != "x":
            extra = TRUNCATED if faults[i] == "t" else 0
            kept = NEXT[state].get(roles[i])
            if kept is not None:
                yield "K", extra, i + 1, kept
            yield "R", GIVE + extra, i + 1, NEXT[state][GIVEN[state]]

    bound = estimate(0, start)
    while bound is not None:
        beyond = None
        # a stack of (row, state, cost so far, letter that led here, edits left to try)
        stack = [(0, start, 0, "", steps(0, start))]
        while stack:
            i, state, cost, _, left = stack[-1]
            if i == n and (ACCEPTS[state] if goal is None else state == goal):
                return cost, "".join(s[3] for s in stack)
            for letter, price, row, to in left:
                spent, more = cost + price, estimate(row, to)
                if more is None:
                    continue
                if spent + more > bound:
                    beyond = spent + more if beyond is None else min(beyond, spent + more)
                elif failed.get((row, to), -1) < bound - spent:
                    stack.append((row, to, spent, letter, steps(row, to)))
                    break
            else:
                # nothing led on: what was left to spend does not suffice from here
                failed[i, state] = max(failed.get((i, state), -1), bound - cost)
                stack.pop()
        bound = beyond
    return None


class _Path:
    """Edits so far that end in one state, with the running hash of the repaired rows.

    `rank` orders the letters of the open paths: pieces of different paths differ before either ends.
    """

    def __init__(self):
        self.cost, self.rank, self.before, self.letters, self.sha, self.begun = 0, 0, None, "", hashlib.sha256(), False

    def text(self) -> str:
        parts, path = [], self
        while path is not None:
            parts.append(path.letters)
            path = path.before
        return "".join(reversed(parts))

    def add(self, cost: int, letters: str, state: int, rows: list[tuple[str, str]]) -> _Path:
        new = _Path()
        new.cost, new.before, new.letters, new.sha, new.begun = self.cost + cost, self, letters, self.sha.copy(), self.begun
        i = 0
        for letter in letters:
            if letter == "D":
                i += 1
                continue
            role, text = ("", "") if letter == "I" else rows[i]
            given = role[:1] if letter == "K" else GIVEN[state]
            role = role if letter == "K" else NAMES[given]
            new.sha.update((("\n" if new.begun else "") + f"{role}:{text}").encode())
            new.begun, state = True, NEXT[state][given]
            i += letter != "I"
        return new


def _open(costs: dict[int, int]) -> list[int]:
    """States that can still be on the cheapest path: the others cost more than the way over a better one.

    One inserted row leads from 2 to 3 and back; 3 goes on like 1, and like 0 but for a system row, which can be deleted.
    """
    never = max(costs.values()) + 1
    two, three = costs.get(2, never), costs.get(3, never)
    beaten = {0: three + DELETE, 1: three, 2: three + INSERT, 3: two + INSERT}
    return [s for s, cost in costs.items() if cost <= beaten[s]]


class Repair:
    """Repairs one conversation as its rows come."""

    def __init__(self, whole: int = WHOLE, piece: int = PIECE):
        self.whole, self.piece = whole, piece
        self.paths = {0: _Path()}
        self.rows: list[tuple[str, str]] = []
        self.signs: list[str] = []

    def row(self, role: str, text: str, sign: str) -> None:
        if len(self.rows) == self.whole:
            self._join(self.piece, range(4))
        self.rows.append((role, text))
        self.signs.append(sign)

    def _join(self, n: int, goals) -> None:
        """Lead the open paths over the next `n` rows."""
        signs = "".join(self.signs[:n])
        best: dict[int | None, tuple] = {}
        for state, path in self.paths.items():
            for goal in goals:
                if (found := search(signs, state, goal)) is not None:
                    this = path.cost + found[0], path.rank, found[1], state, found[0]
                    best[goal] = min(this, best.get(goal, this))
        if None not in best:
            best = {g: best[g] for g in _open({g: b[0] for g, b in best.items()})}
        ranked = sorted(best, key=lambda g: best[g][1:3])
        paths = {}
        for goal, (_, _, letters, state, cost) in best.items():
            paths[goal] = self.paths[state].add(cost, letters, state, self.rows[:n])
            paths[goal].rank = ranked.index(goal)
        self.paths, self.rows, self.signs = paths, self.rows[n:], self.signs[n:]

    def done(self) -> tuple[int, str, str]:
        """(cost, letters, sha256 of the repaired rows)."""
        self._join(len(self.rows), (None,))
        path = self.paths[None]
        return path.cost, path.text(), path.sha.hexdigest()


REPORT = (
    "key long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)
_LEGAL = {"su", "ua", "au"}


def _report(whole: int, piece: int):
    """Rows sorted by (key, there, turn, ..): one report per key."""
    names = [c.split()[0] for c in REPORT.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.string()] * 2

    def pack(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, out = None, []
        for batch in batches:
            for key, there, turn, role, text, fault in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if state is None or state.key != key:
                    if state is not None:
                        out.append(state.done())
                    state = _Conversation(key, whole, piece)
                if there:  # a dropped row only shows that the conversation exists
                    state.row(turn, role, text, fault)
            if len(out) >= 1000:
                yield pack(out)
                out = []
        if state is not None:
            out.append(state.done())
        if out:
            yield pack(out)

    return report


class _Conversation:
    """Facts of one conversation beside its repair."""

    def __init__(self, key: int | None, whole: int, piece: int):
        self.key, self.repair = key, Repair(whole, piece)
        self.first = self.last = self.before = None
        self.turns = self.illegal = 0
        self.faults = [0, 0, 0, 0]

    def row(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        self.faults[fault] += 1
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        sign = initial if initial in ("s", "u", "a") else "?"
        self.repair.row(role, text, sign + "-xxt"[fault])

    def done(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return self.key, gaps, *self.faults[1:], self.illegal, *self.repair.done()


def _fault(key: str, there: str, turn: str, role: str, text: str) -> Column:
    """The first fault of a row: 1 blank, 2 duplicate, 3 truncated, else 0."""
    same = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    again = F.row_number().over(Window.partitionBy(key, there, same).orderBy(F.asc_nulls_first(turn)))
    last = F.regexp_extract(text, r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return (
        F.when(~F.col(there), 0)
        .when(~F.rlike(F.col(text), F.lit(WORD)), 1)
        .when(again > 1, 2)
        .when(~last.isin(".", "!", "?"), 3)
        .otherwise(0)
    )


def repair(
    rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    there: Column | None = None, whole: int = WHOLE, piece: int = PIECE,
) -> DataFrame:
    """Per conversation (`key`): its faults and the cheapest repair, columns as in REPORT.

    Order is by turn, nulls first; equal turns by role, text. A null role or text counts as one space; such a role, an
    empty one or one that doesn't begin with s, u or a can't be kept, only changed or deleted. Rows for which `there` is
    false are no rows of their conversation but keep it in the result, with zeros, no edits and the hash of nothing if
    that is all it has. Rows with a null id form a conversation of their own; a row that stands twice is a duplicate. An
    empty table has no report. Other columns are not read.
    """
    space = F.lit(" ")
    rows = rows.select(
        F.col(conv_id).cast("long").alias("key"), (F.lit(True) if there is None else there).alias("there"),
        F.col(turn).cast("long").alias("turn"), F.coalesce(role, space).alias("role"), F.coalesce(text, space).alias("text"),
    )
    # one shuffle: the window and the report both need the rows of a conversation together
    rows = rows.repartition("key").withColumn("fault", _fault("key", "there", "turn", "role", "text"))
    order = ["key", "there", F.asc_nulls_first("turn"), "role", "text", F.col("fault") == 2]
    return rows.sortWithinPartitions(*order).mapInArrow(_report(whole, piece), REPORT)
