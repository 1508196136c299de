"""Repairs of conversations against a search of all edits and a plain dynamic programme."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from statloom.llm import repair
from statloom.llm.catalogue import QUERIES
from statloom.llm.repair import ANSWER, NEXT

SOLID = re.compile(r"[^\x20\x09-\x0D]")
EMPTY_HASH = hashlib.sha256(b"").hexdigest()


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = SOLID.findall(text)[-1:]
        fault = "blank" if not last else "duplicate" if (role, text) in seen else None if last[0] in ".!?" else "truncated"
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def ways(row, state):
    """All edits of one row: (edit, cost, state, line)."""
    role, text, fault = row
    yield "D", 3, state, None
    if fault in ("blank", "duplicate"):
        return
    extra = fault == "truncated"
    after = NEXT.get(role[:1], {}).get(state)
    if after is not None:
        yield "K", extra, after, f"{role}:{text}"
    yield "R", 2 + extra, NEXT[ANSWER[state][0]][state], f"{ANSWER[state]}:{text}"


def all_edits(rows):
    """The best of every sequence of edits with at most two insertions in a row."""
    best = None

    def go(i, state, cost, edits, lines):
        nonlocal best
        if best and cost > best[0]:
            return
        if i == len(rows) and state in (0, 3) and (best is None or (cost, edits) < best[:2]):
            best = (cost, edits, lines)
        if not edits.endswith("II"):
            go(i, NEXT[ANSWER[state][0]][state], cost + 2, edits + "I", [*lines, ANSWER[state] + ":"])
        for edit, more, after, line in ways(rows[i], state) if i < len(rows) else ():
            go(i + 1, after, cost + more, edits + edit, lines if line is None else [*lines, line])

    go(0, 0, 0, "", [])
    return best


def programme(rows):
    """The best prefix per state after each row."""

    def with_insertions(table):
        for _ in range(4):
            for state, (cost, edits, lines) in list(table.items()):
                put(table, NEXT[ANSWER[state][0]][state], (cost + 2, edits + "I", [*lines, ANSWER[state] + ":"]))
        return table

    def put(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    table = with_insertions({0: (0, "", [])})
    for row in rows:
        after = {}
        for state, (cost, edits, lines) in table.items():
            for edit, more, then, line in ways(row, state):
                put(after, then, (cost + more, edits + edit, lines if line is None else [*lines, line]))
        table = with_insertions(after)
    return min((table[s] for s in (0, 3) if s in table), key=lambda v: v[:2])


def defined(rows, best=programme):
    """All measures of the rows of a conversation, in order."""
    marked = faults(rows)
    cost, edits, lines = best(marked)
    turns = [t for t, _, _ in rows if t is not None]
    count = lambda f: sum(m[2] == f for m in marked)
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def repaired(rows):
    work = repair.Repair()
    for row in rows:
        work.add(*row)
    return work.result()


def some_rows(rng, n):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", " ", "ü"]
    return [(i + rng.randrange(2) if rng.random() < 0.9 else None, rng.choice(roles), rng.choice(["", "hi.", "yes", "ok! ", f"t{i}.", f"ü{i}\n"])) for i in range(n)]


@pytest.mark.parametrize("block", [1, 2, 16])
def test_optimal_whatever_the_block(monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK_ROWS", block)
    rng = random.Random(block)
    for _ in range(150):
        rows = sorted(some_rows(rng, rng.randrange(6)), key=lambda r: (r[0] is not None, r[0] or 0))
        assert repaired(rows) == defined(rows, all_edits) == defined(rows)
    for _ in range(20):
        rows = sorted(some_rows(rng, rng.randrange(20, 120)), key=lambda r: (r[0] is not None, r[0] or 0))
        assert repaired(rows) == defined(rows)


def test_bounds_hold():
    rng = random.Random(4)
    for _ in range(200):
        rows = [repair.Row(*r) for r in faults(some_rows(rng, 5))]
        bounds = repair.least_costs(rows)
        for i in range(len(rows) + 1):
            for state in range(4):
                found = repair.search(rows[i:], {state: (0, 0)}, repair.COMPLETE, True)
                assert bounds[i] <= min(c for c, _, _ in found.values())


def test_long_conversation():
    rows = [(i, "user" if i % 3 else "assistant", f"t{i}" + ("." if i % 5 else "")) for i in range(30_000)]
    got = repaired(rows)
    assert len(got[6].replace("I", "")) == 30_000 and got[3] == 6_000
    head = rows[:300]
    assert repaired(head) == defined(head)


def damaged(conversations):
    """The contract's damage in plain Python, per conversation and in order."""
    plain = lambda v: " " if v is None else str(v)
    out = defaultdict(list)
    for conv_id, turn, role, text in conversations:
        role, text = plain(role), plain(text)
        code = zlib.crc32(f"{plain(conv_id)}:{plain(turn)}".encode()) % 20
        rows = out[conv_id]
        if code == 0:
            continue
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        rows += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode())
    return {c: sorted(rows, key=order) for c, rows in out.items()}


def test_query(spark, root):
    table = spark.read.parquet(f"{root}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    got = {r.conv_id: tuple(r)[1:] for r in QUERIES["op12_repair"](spark, root).collect()}
    assert got == {c: defined(rows) for c, rows in damaged(table).items()}
    assert len({g[5] for g in got.values()}) > 3


def test_odd_rows(spark):
    kinds = "conv_id long, turn long, role string, text string, gone string, copy int, times int"
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice([None, "", "Hm.", "no", "é" * 20_000])) for c in (1, 2, None) for t in (None, 0, 1, 1, 5, 7, -(2**62), 2**62)]
    rows += [(8, t, None, None) for t in range(3)] + [(9, None, "user", "Yes.")] * 3 + [(c, 0, "user", "Hi.") for c in range(100, 200)]
    table = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], kinds)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(repair.damage(table)).collect()}
    want = {c: list(v) for c, v in {c: defined(r) for c, r in damaged(rows).items()}.items()}
    for v in want.values():
        v[0] = min(v[0], 2**63 - 1)
    assert got == {c: tuple(v) for c, v in want.items()}
    gone = [c for c, r in damaged(rows).items() if not r]
    assert gone and all(got[c] == (0, 0, 0, 0, 0, 0, "", EMPTY_HASH) for c in gone)
    assert repair.repair(repair.tidy(table.limit(0))).collect() == []
    undamaged = {r.conv_id: r.blank for r in repair.repair(repair.tidy(table)).collect()}
    assert undamaged[8] == 3 and undamaged[100] == 0
