"""Periodic runs against their definition."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from statloom.llm import periodic
from statloom.llm import text as tx
from statloom.llm.catalogue import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def defined_runs(words):
    """All stretches on which words q apart are identical, for each q on its own."""
    n, found = len(words), []
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.array([number[w] for w in words])
    for q in range(1, n // 4 + 1):
        edges = np.diff(np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(int))
        for i, j in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
            size = int(j - i) + q
            if size >= max(6, 4 * q):
                run = ids[i : i + size]
                if not any((run[:-p] == run[p:]).all() for p in range(1, q)):
                    found.append((int(i), size, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def defined(doc_id, text, loop):
    words = WORD.findall(text or "")
    where = loop(doc_id, len(words))
    if where:
        a, p = where
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = defined_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = (None,) * 4
    if runs:
        s, n, q = min(runs, key=lambda r: (-r[1], r[0], r[2]))
        best = (s, n, q, 1000 * n // q)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (len(words), len(runs), *best, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(kept))


def measured(docs, loop, limit=1 << 20):
    rows, at = [], 0
    for data, offsets in tx.pieces(pa.array([t for _, t in docs], pa.string()), limit):
        rows += periodic.measure(data, offsets, lambda t, n, at=at: loop(docs[at + t][0], n))
        at += len(offsets) - 1
    return rows


def phrase(draw):
    block = draw(st.lists(st.sampled_from(["a", "b", "é", "zz"]), min_size=1, max_size=9))
    return block * draw(st.integers(1, 7)) + block[: draw(st.integers(0, 8))]


@st.composite
def texts(draw):
    words = [w for _ in range(draw(st.integers(0, 4))) for w in phrase(draw)]
    return (words * draw(st.sampled_from([1, 1, 2, 5]))) and draw(st.sampled_from([" ", "\n", " \t "])).join(words)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 99), st.one_of(st.none(), texts().map(lambda t: t or ""))), max_size=5), st.sampled_from([20, 1 << 20]))
def test_definition(docs, limit):
    for loop in (periodic.no_loop, periodic.planted_loop):
        assert measured(docs, loop, limit) == [defined(*d, loop) for d in docs]


def test_nested_and_self_similar():
    fibonacci, before = ["a"], ["b"]
    for _ in range(9):
        fibonacci, before = fibonacci + before, fibonacci
    morse = ["a"]
    for _ in range(8):
        morse += ["b" if w == "a" else "a" for w in morse]
    nested = ((["a"] * 7 + ["b"]) * 5 + ["c"]) * 4
    for words in (fibonacci, morse * 4, nested, ["a"] * 5, ["a"] * 6, ["a", "b"] * 4, ["a", "b"] * 3 + ["a"]):
        docs = [(1, " ".join(words))]
        assert measured(docs, periodic.no_loop) == [defined(*docs[0], periodic.no_loop)]


def test_time_follows_the_words():
    rng = random.Random(0)
    docs = [(1, "a " * 200_000), (1, " ".join(rng.choice("ab") for _ in range(200_000))), (1, " ".join(f"w{i % 40_000}" for i in range(200_000)))]
    rows = measured(docs, periodic.no_loop)
    assert rows[0][1:6] == (1, 0, 200_000, 1, 200_000_000)
    assert rows[2][1:6] == (1, 0, 200_000, 40_000, 5_000)


def test_query(spark, root, texts):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_runs"](spark, root).collect()}
    assert got == {d: defined(d, t, periodic.planted_loop) for d, t in texts.items()}
    assert sum(r[1] > 0 for r in got.values()) > 5


def test_odd_rows(odd, nothing):
    rows = periodic.periodic_runs(odd).collect()
    assert len(rows) == odd.count()
    want = [(r.doc_id, *defined(r.doc_id, r.text, periodic.no_loop)) for r in odd.collect() if len(r.text or "") < 1000]
    got = [tuple(r) for r in rows if r.doc_id != 7]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    long = next(r for r in rows if r.doc_id == 7)
    assert (long.n_words, long.n_runs, long.start, long.length, long.period) == (9002, 1, 0, 9000, 3)
    empty = next(r for r in rows if r.doc_id == 3)
    assert empty.n_words == empty.n_runs == 0 and empty.start is None and empty.collapsed_sha256 == sha("")
    assert periodic.periodic_runs(nothing).collect() == []
