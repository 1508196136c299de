"""Repair of conversations whose turns do not alternate: depth-first branch-and-bound.

A conversation is repaired when the initials of its roles read `(s?(ua)+)?`. Rows are kept (free),
given the role user or assistant (2) or deleted (3; blank rows and duplicates always are); empty
rows of these two roles are inserted anywhere (2); a truncated row that stays costs 1 more. Among
the cheapest repairs the one whose edits, by their initials, come first in ASCII order is taken.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 16
NEVER = 1 << 60

# States of the grammar: nothing yet, after s, after u, after a.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
COMPLETE = (EMPTY, ASSISTANT)
ANSWER = {EMPTY: "user", SYSTEM: "user", ASSISTANT: "user", USER: "assistant"}
ORDERLY = {"su", "ua", "au"}
MOST_LONG = (1 << 63) - 1

SCHEMA = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)
BLANKS = " \t\n\x0b\x0c\r"


class Row(NamedTuple):
    role: str
    text: str
    fault: str | None

    @property
    def initial(self) -> str:
        return self.role[:1]

    @property
    def doomed(self) -> bool:
        return self.fault in ("blank", "duplicate")


def least_costs(rows: list[Row]) -> list[int]:
    """Lower bounds of the cost of the rows from each place on.

    Each row alone costs at least what its fault and its role ask for. On top, two rows that follow
    each other among those that could stay and do not fit cost 1: they take an insertion (2) or a
    change of one of them, which costs 2 more than the row alone and mends two such pairs at most.
    """
    bounds, follower = [0] * (len(rows) + 1), None
    for i in range(len(rows) - 1, -1, -1):
        row = rows[i]
        if row.doomed:
            bounds[i] = bounds[i + 1] + 3
            continue
        fits = row.initial in NEXT
        own = (0 if fits else 2) + (row.fault == "truncated")
        clash = fits and follower is not None and follower in NEXT and row.initial + follower not in ORDERLY
        bounds[i] = bounds[i + 1] + min(own, 3) + clash
        follower = row.initial
    return bounds


def moves(row: Row, state: int) -> Iterator[tuple[int, str, int, int]]:
    """(cost, edit, next state, rows used), cheapest first, of equal ones by ASCII."""
    if not row.doomed:
        extra = row.fault == "truncated"
        after = NEXT.get(row.initial, {}).get(state)
        if after is not None:
            yield extra, "K", after, 1
        yield 2, "I", NEXT[ANSWER[state][0]][state], 0
        yield 2 + extra, "R", NEXT[ANSWER[state][0]][state], 1
    else:
        yield 2, "I", NEXT[ANSWER[state][0]][state], 0
    yield 3, "D", state, 1


Label = tuple[int, int, str]
"""Cost, rank of the entry among entries, edits since: what a prefix is judged by."""


def search(rows: list[Row], entries: dict[int, tuple[int, int]], exits: tuple[int, ...], last: bool) -> dict[int, Label]:
    """The best way through a block of rows to each of `exits`.

    `entries` holds the states a block can be entered in, with cost and rank. Prefixes wait on an
    explicit stack, the cheapest continuation on top. A node is a place and a state; its table
    entry is the best prefix seen there, and a prefix that is no better is dropped, since whatever
    follows is open to both. Incumbents are the best ways to the exits so far; a prefix whose cost and
    lower bound exceed all of them is dropped. What is left when the stack is empty is optimal.
    Insertions behind the last row belong to the block only if it is the `last` one.
    """
    bounds, best, stack = least_costs(rows), {}, []
    incumbents: dict[int, Label] = {}
    worst = NEVER
    for state, (cost, rank) in sorted(entries.items(), key=lambda e: e[1], reverse=True):
        stack.append((0, state, (cost, rank, "")))
    while stack:
        place, state, label = stack.pop()
        if label[0] + bounds[place] > worst:
            continue
        known = best.get((place, state))
        if known is not None and known <= label:
            continue
        best[place, state] = label
        cost, rank, edits = label
        if place == len(rows):
            if state in exits:
                incumbents[state] = label
                if len(incumbents) == len(exits):
                    worst = max(c for c, _, _ in incumbents.values())
            if last:
                stack.append((place, NEXT[ANSWER[state][0]][state], (cost + 2, rank, edits + "I")))
            continue
        for more, edit, after, used in reversed(list(moves(rows[place], state))):
            stack.append((place + used, after, (cost + more, rank, edits + edit)))
    return incumbents


class Prefix(NamedTuple):
    cost: int
    edits: tuple  # (edits of the prefix before, edits of a block), back to ()
    said: object  # running digest of the repaired rows


def extend(prefix: Prefix, state: int, rows: list[Row], edits: str, cost: int) -> Prefix:
    """A prefix with the rows of one block repaired as `edits` say."""
    said, waiting = prefix.said.copy(), iter(rows)
    for edit in edits:
        row = next(waiting) if edit != "I" else None
        if edit == "D":
            continue
        role = row.role if edit == "K" else ANSWER[state]
        line = f"{role}:{row.text if row else ''}"
        said.update((line if state == EMPTY else "\n" + line).encode())
        state = NEXT[role[0]][state]
    return Prefix(cost, (prefix.edits, edits), said)


class Repair:
    """Repairs the rows of one conversation as they come, a block at a time.

    Only one prefix per state can be part of the answer at the border of blocks, so four prefixes
    and one block of rows are held, and the digests of rows seen for duplicates. A prefix at a
    border ends with the edit of a row; none is then the beginning of another, and their order
    decides ties whatever follows.
    """

    def __init__(self) -> None:
        self.prefixes = {EMPTY: Prefix(0, (), hashlib.sha256())}
        self.ranks = {EMPTY: 0}
        self.rows: list[Row] = []
        self.seen: set[bytes] = set()
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.before = 0, None
        self.least = self.most = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        solid = text.rstrip(BLANKS)[-1:]
        key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
        if not solid:
            fault = "blank"
        elif key in self.seen:
            fault = "duplicate"
        else:
            fault = None if solid in ".!?" else "truncated"
        self.seen.add(key)
        if fault:
            self.faults[fault] += 1
        row = Row(role, text, fault)
        self.illegal += self.before is not None and self.before + row.initial not in ORDERLY
        self.before = row.initial
        if turn is not None:
            self.turns += turn != self.most
            self.least = turn if self.least is None else self.least
            self.most = turn
        self.rows.append(row)
        if len(self.rows) > BLOCK_ROWS:
            self.close(self.rows[:BLOCK_ROWS], tuple(range(4)), False)
            self.rows = self.rows[BLOCK_ROWS:]

    def close(self, rows: list[Row], exits: tuple[int, ...], last: bool) -> None:
        entries = {s: (p.cost, self.ranks[s]) for s, p in self.prefixes.items()}
        entered = {rank: s for s, rank in self.ranks.items()}
        found = search(rows, entries, exits, last)
        order = sorted(found, key=lambda s: found[s][1:])
        self.prefixes = {
            s: extend(self.prefixes[entered[rank]], entered[rank], rows, edits, cost) for s, (cost, rank, edits) in found.items()
        }
        self.ranks = {s: i for i, s in enumerate(order)}

    def result(self) -> tuple:
        self.close(self.rows, COMPLETE, True)
        _, _, state = min((p.cost, self.ranks[s], s) for s, p in self.prefixes.items())
        cost, edits, said = self.prefixes[state]
        parts = []
        while edits:
            edits, part = edits
            parts.append(part)
        gaps = 0 if self.least is None else min(self.most - self.least + 1 - self.turns, MOST_LONG)
        return (gaps, *self.faults.values(), self.illegal, cost, "".join(reversed(parts)), said.hexdigest())


def repaired(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from rows sorted by conversation and turn; rows marked `gone` only name theirs."""
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    kinds = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in names])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "gone")))

    ready = []
    for conv_id, group in itertools.groupby(rows(), key=lambda r: r[0]):
        work = Repair()
        for _, turn, role, text, gone in group:
            if not gone:
                work.add(turn, role, text)
        ready.append((conv_id, *work.result()))
        if len(ready) == 1000:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds.types)], schema=kinds)
            ready = []
    if ready:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds.types)], schema=kinds)


def plain(name: str) -> Column:
    """A column as a string, null as one blank."""
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def tidy(conversations: DataFrame) -> DataFrame:
    """The rows as `repair` takes them: nulls in role and text are one blank."""
    rows = conversations.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"))
    return rows.withColumn("gone", F.lit(False))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with the faults that the contract's query plants, by crc32 of `conv_id:turn`."""
    code = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = tidy(conversations).select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (code == 0).alias("gone"),
        F.when(code == 3, 2).otherwise(1).alias("times"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times", "copy")


def repair(rows: DataFrame) -> DataFrame:
    """One row per `conv_id` of `rows` (`conv_id`, `turn`, `role`, `text`, `gone`; see `tidy`).

    Rows count by turn, nulls first, rows of one turn by role and text. Returns `gaps` (turns missing
    between the smallest and the largest, ignoring nulls), rows `blank`, `duplicate` (role and text
    seen earlier) and `truncated` (not ending in `.!?`) by the first fault of each, `illegal`
    neighbours, the least `cost`, the edits (`audit`) and the digest of the repaired `role:text` lines.
    The result is proved optimal, see `search`.

    Rows are dealt by conversation and sorted; a task reads them as a stream and holds one block of
    rows, besides one letter and one digest for each row of the conversation at hand. The digest of a
    conversation runs over all its rows, so one task must read it all. A null `conv_id` is a
    conversation of its own; an empty role fits nowhere; a conversation whose rows are all gone has
    zeros, no audit and the digest of the empty string; no rows give no rows; other columns are ignored.
    """
    rows = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id")
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "text"]
    return rows.sortWithinPartitions(*order).mapInArrow(repaired, SCHEMA)
