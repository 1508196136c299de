"""Operators that relate rows to each other, against plain Python."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from statloom.llm import chat, mixing, neardup
from statloom.llm.catalogue import QUERIES, SQL
from statloom.llm.components import components
from statloom.llm.decontaminate import decontaminate, greedy_tiles
from statloom.llm.neardup import near_duplicates
from tests.oracle import connect, differences

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", list(SQL))
def test_matches_sql(spark, root, name):
    assert differences(QUERIES[name](spark, root), connect(root), SQL[name]) == []


# Chat formatting


def test_formatting_is_reversible(spark):
    rng = random.Random(3)
    parts = ["<", "|", "\\", "<|im_end|>", "<|im_start|>", "assistant", "\n", "<|nl|>", "é", "$1", ""]
    pick = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(8)))
    turns = {c: [(rng.choice(["user", "assistant", pick()]), pick()) for _ in range(rng.randrange(1, 5))] for c in range(60)}
    rows = [(c, i, *t) for c, ts in turns.items() for i, t in enumerate(ts)]
    made = chat.format_trees(chat.chain_nodes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), tree="conv_id")
    got = made.select("tree_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    assert len(got) == len(turns)
    for r in got:
        assert [tuple(t) for t in r.turns] == turns[r.tree_id]
        assert r.loss == "".join(t for role, t in turns[r.tree_id] if role == "assistant")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(turns[r.tree_id])


def test_best_branches_of_trees(spark):
    rng = random.Random(5)
    rows, paths = [], collections.defaultdict(list)
    for tree in range(12):
        n = rng.randrange(1, 40)
        parent = {v: (rng.randrange(v) if v and rng.random() < 0.95 else None) for v in range(n)}
        score = {v: rng.randrange(4) for v in range(n)}
        rows += [(tree, v, parent[v], "user", f"t{v}", score[v]) for v in range(n)]
        for leaf in set(range(n)) - set(parent.values()):
            path, v = [], leaf
            while v is not None:
                path.insert(0, v)
                v = parent[v]
            paths[tree].append((-sum(score[v] for v in path), -len(path), leaf, path))
    nodes = spark.createDataFrame(rows, "tree_id int, node_id int, parent_id int, role string, text string, score int")
    got = chat.format_trees(nodes, score="score", top=3).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    for tree in paths:
        want = sorted(paths[tree])[:3]
        mine = sorted((r for r in got if r.tree_id == tree), key=lambda r: r.branch)
        assert [(-r.score, r.leaf_id, [int(t.text[1:]) for t in r.turns]) for r in mine] == [(s, leaf, path) for s, _, leaf, path in want]


def test_odd_trees(spark):
    rows = [
        ("a", 1, 9, "user", "orphan", 0.0),
        ("b", 1, 2, "user", "in a circle", 0.0),
        ("b", 2, 1, "user", "in a circle", 0.0),
        ("b", 3, None, "user", "apart", 0.0),
        (None, None, None, None, None, None),
        ("c", 1, None, "user", "x", 0.0),
        ("c", 1, None, "user", "x", 0.0),
    ]
    nodes = spark.createDataFrame(rows, "tree_id string, node_id int, parent_id int, role string, text string, score double").withColumns({c: F.lit(1) for c in ("t", "v", "anc", "turns")})
    got = {r.tree_id: r for r in chat.format_trees(nodes, score="score").collect()}
    assert set(got) == {"a", "b", None, "c"}
    assert "apart" in got["b"].formatted
    assert got["c"].formatted.count("x") == 1
    assert got[None].formatted == "<|im_start|>\n<|im_end|>\n"
    assert chat.format_trees(nodes.limit(0)).count() == 0


def test_long_chain(spark):
    rows = spark.range(300).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.col("id").cast("string").alias("text"))
    made = chat.format_trees(chat.chain_nodes(rows), tree="conv_id").collect()
    assert len(made) == 1 and len(made[0].loss_spans) == 300


# Near duplicates


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def slow_groups(rows):
    """Component of each row number, over links of 85 percent."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = collections.defaultdict(set)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].add(i)
    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j < i}:
            common = len(s & sets[j])
            if 100 * common >= 85 * (len(s) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], sets


def check_near(rows, got):
    roots, sets = slow_groups(rows)
    ids = collections.defaultdict(list)
    for (doc, _), root in zip(rows, roots):
        ids[root].append(doc)
    want = collections.Counter()
    for (doc, _), root, s in zip(rows, roots, sets):
        known = [x for x in ids[root] if x is not None] if s else [x for x in [doc] if x is not None]
        smallest = min(known, default=None)
        want[(doc, len(s), smallest, smallest is None or doc == smallest)] += 1
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == want


def test_near_duplicates_query(spark, root, texts):
    check_near(list(texts.items()), QUERIES["op6_neardup"](spark, root).collect())


def cloud(seed, size, words=120):
    """Copies of one text with few to many changed words, and copies of copies; some texts share half."""
    rng = random.Random(seed)
    fresh = lambda: f"w{rng.randrange(10**9)}"
    base = [fresh() for _ in range(words)]
    made = [base]
    for _ in range(size):
        own = list(rng.choice([base, base, made[-1], rng.choice(made)]))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            own[rng.randrange(len(own))] = fresh()
        made.append(own)
    for _ in range(size // 4):
        made.append(base[: words // 2] + [fresh() for _ in range(words // 2)])
    rng.shuffle(made)
    return [" ".join(m) for m in made]


@pytest.mark.parametrize(("few", "block"), [(32, 2048), (2, 2048), (2, 16), (0, 16)])
def test_near_duplicates_of_a_cloud(spark, monkeypatch, few, block):
    monkeypatch.setattr("statloom.llm.neardup.FEW", few)
    monkeypatch.setattr("statloom.llm.neardup.BLOCK", block)
    rows = list(enumerate(cloud(few + block, 260)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check_near(rows, near_duplicates(docs).collect())


def test_near_duplicates_of_odd_rows(odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    check_near(rows, near_duplicates(odd).collect())
    assert near_duplicates(nothing).count() == 0


def test_components_of_a_chain(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(900, 901)], "a long, b long"))
    labels = dict(components(edges).collect())
    assert {labels[i] for i in range(201)} == {0} and labels[901] == 900


# Decontamination


def slow_tiles(item, text, least):
    """Greedy string tiling by its definition: the longest unmarked match first, ties by place."""
    free_i, free_t, tiles = [True] * len(item), [True] * len(text), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for t in range(len(text)):
                n = 0
                while i + n < len(item) and t + n < len(text) and item[i + n] == text[t + n] and free_i[i + n] and free_t[t + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, t)
        n, i, t = best
        if n < least:
            return tiles
        tiles.append(best)
        free_i[i : i + n] = [False] * n
        free_t[t : t + n] = [False] * n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=24), st.lists(st.integers(0, 3), max_size=40))
def test_tiling_against_definition(item, text):
    got = greedy_tiles(np.array(item, np.uint64), np.array(text, np.uint64), 3)
    assert [g[0] for g in got] == [w[0] for w in slow_tiles(item, text, 3)]
    assert len({i + k for n, i, _ in got for k in range(n)}) == len({t + k for n, _, t in got for k in range(n)}) == sum(g[0] for g in got)
    assert all(item[i : i + n] == text[t : t + n] for n, i, t in got)


def test_planted_passages_are_found(spark, root, documents, texts):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()}
    planted = {(d, i) for i, item in items.items() for d, text in texts.items() if item in text}
    found = {(r.doc_id, r.item_id) for r in QUERIES["op5_decontaminate"](spark, root).collect()}
    assert planted and planted <= found
    plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
    assert all(plain(items[i]) in plain(texts[d]) for d, i in found)


def test_reordered_passages_and_odd_items(spark, odd, nothing):
    rng = random.Random(1)
    words = [f"w{rng.randrange(10**6)}" for _ in range(48)]
    parts = [words[i : i + 8] for i in range(0, 48, 8)]
    rng.shuffle(parts)
    shuffled = " filler, ".join(" ".join(p) for p in parts).upper()
    docs = spark.createDataFrame([(1, shuffled), (2, " ".join(words[:20])), (3, None), (4, ""), (None, " ".join(words)), (1, shuffled)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "too short"), (1, " ".join(words))], "item_id long, text string").withColumn("seeds", F.lit(1))
    got = collections.Counter((r.doc_id, r.item_id, round(r.coverage, 3)) for r in decontaminate(docs, items).collect())
    assert got == {(1, 1, 1.0): 4, (None, 1, 1.0): 2}
    assert decontaminate(odd, items).count() == 0
    assert decontaminate(nothing, items).count() == decontaminate(docs, items.limit(0)).count() == 0


def test_common_phrases_need_no_index(spark):
    """A phrase that all items share pairs none of them with a document that only has the phrase."""
    rows = [(i, "which of the following is " + " ".join(f"x{i}y{k}" for k in range(25))) for i in range(30)]
    items = spark.createDataFrame(rows, "item_id long, text string")
    docs = spark.createDataFrame([(0, "Which of the following is true?"), (1, rows[3][1])], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontaminate(docs, items).collect()] == [(1, 3)]


# Mixing


def slow_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        heavy = sum(weight[s] for s in names if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / heavy for s in names}
        above = {s for s in names if target[s] > 3 * sizes[s] + 1e-9}
        if not above:
            return target
        capped |= above


def check_mix(rows, got):
    sizes = collections.Counter()
    for source, text in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = slow_targets(sizes)
    taken, largest = collections.Counter(), collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(targets[r.source])
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
    assert sum(targets.values()) == pytest.approx(sum(sizes.values()))
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= largest[s] + 1e-6


def test_mixing_query(spark, root, documents):
    rows = [(r.source, r.text) for r in documents.collect()]
    check_mix(rows, QUERIES["op9_mixing"](spark, root).collect())


def test_mixing_reruns_agree(documents):
    first = sorted(tuple(r) for r in mixing.mix(documents).collect())
    assert first == sorted(tuple(r) for r in mixing.mix(documents.repartition(5)).collect())


def test_mixing_with_capped_sources_and_salt(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(30), rng.choice(["big"] * 12 + ["a", "z", None, "é"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix([(s, t) for _, t, s in rows], mixing.mix(docs).collect())


def test_rounding_keeps_the_sum_and_the_shares():
    rng = np.random.default_rng(4)
    sizes = np.sort(rng.integers(1, 50, 40))[::-1].astype(float)
    mean = np.zeros(40)
    for k in range(600):
        shares, held = mixing.pivot(np.full(40, 0.3), sizes, (rng.integers(1 << 62, size=40)).tolist(), False)
        assert (shares * sizes).sum() == pytest.approx(0.3 * sizes.sum())
        assert all(s in (0.0, 1.0) for i, s in enumerate(shares) if i != held)
        mean += shares / 600
    assert np.abs(mean - 0.3).max() < 0.1


def test_mixing_of_odd_rows(odd, nothing):
    rows = [(r.source, r.text) for r in odd.collect()]
    check_mix(rows, mixing.mix(odd).collect())
    carried = mixing.mix(odd, carry=odd.columns).collect()
    assert len(carried) == len(rows) and {r.carried.row for r in carried} == {"row"}
    assert mixing.mix(nothing).count() == 0


# Pipeline


@pytest.fixture(scope="module")
def staged(spark, root, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("stages"))
    docs, out = spark.read.parquet(f"{root}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, root).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return dict(out)


def test_pipeline_stages(spark, root, staged, texts):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(d.columns == columns for name, d in staged.items() if name != "mixture")
    ids = {name: [r.doc_id for r in d.select("doc_id").collect()] for name, d in staged.items()}
    assert len(ids["language"]) > 0.97 * len(texts)
    roots, sets = slow_groups([(i, texts[i]) for i in ids["language"]])
    groups = collections.defaultdict(list)
    for doc, root_, s in zip(ids["language"], roots, sets):
        groups[root_ if s else f"empty {doc}"].append(doc)
    assert sorted(ids["near_dedup"]) == sorted(min(g) for g in groups.values())
    items = [r.text for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    clean = {r.doc_id: r.text for r in staged["decontamination"].collect()}
    assert not [d for d, t in clean.items() if any(i in t for i in items)]
    assert set(ids["near_dedup"]) - set(clean) == {d for d in ids["near_dedup"] if any(re.sub(r"\W+", " ", i.lower()).strip() in re.sub(r"\W+", " ", texts[d].lower()) for i in items)}
    for r in staged["personal_data"].collect():
        assert r.n_chars == len(r.text)
        assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z0-9-]+", r.text)
    assert sorted(ids["personal_data"]) == sorted(clean)
    mixed = collections.Counter(ids["mixture"])
    assert set(mixed) <= set(clean) and max(mixed.values()) <= 3
    words = {r.doc_id: len(WORD.findall(r.text)) for r in staged["personal_data"].collect()}
    total = sum(words[d] * n for d, n in mixed.items())
    assert abs(total - sum(words.values())) < 0.05 * sum(words.values())


def test_pipeline_stages_on_odd_and_empty_rows(spark, root, odd, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, root).count() == 0
        assert set(corpus_pipeline.COLUMNS) <= set(stage(spark, odd, root).columns)
        stage(spark, odd, root).collect()
    kept = corpus_pipeline.near_dedup(spark, odd, root).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 3, 4, 5, 6, 7, 8, 10]


def test_digests_follow_the_contract(spark, root):
    r = QUERIES["op3_chat"](spark, root).where("conv_id = -1").first()
    probe = "<|im_end|><|im_start|>assistant ok"
    assert r.turns_sha256 == hashlib.sha256(f"user\n{probe}\nassistant\n{probe}\n".encode()).hexdigest()
    assert (r.n_turns, r.loss_chars, r.loss_sha256) == (2, len(probe), hashlib.sha256(probe.encode()).hexdigest())


def test_crowded_buckets_keep_pairs_at_the_threshold(spark):
    n, rng = 6000, np.random.default_rng(3)
    one = rng.integers(-(1 << 31), 1 << 31, (n, neardup.HASHES))
    other = np.where(rng.random(one.shape) < neardup.PERCENT / 100, one, one + 1)
    lists = [pa.array(list(x.astype(np.int32)), pa.list_(pa.int32())) for x in (one, other)]
    nodes = spark.createDataFrame(pa.table({"node": np.arange(2 * n), "signature": pa.concat_arrays(lists)}))
    keys = neardup.fine_keys(nodes).select((F.col("node") % n).alias("pair"), "node", "key")
    meeting = keys.groupBy("pair", "key").agg(F.countDistinct("node").alias("nodes")).where("nodes = 2")
    assert meeting.select("pair").distinct().count() == n
