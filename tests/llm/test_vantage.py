"""Nearest neighbours by vantage-point trees against brute force."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from statloom.llm import vantage
from statloom.llm.catalogue import QUERIES

TABLE = "vec_id long, embedding array<float>, label int, vector string, shard int, block int"


def score(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += x * y
    return total


def defined(vectors, asked, k):
    """All candidates in order, by definition."""
    out = []
    for q in sorted(asked):
        near = sorted((-score(vectors[q], v), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(near[:k])]
    return out


def found(rows, **options):
    got = vantage.neighbours(rows, F.col("vec_id") % 20 == 0, **options).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


@pytest.fixture(scope="module")
def embeddings(spark, root):
    return spark.read.parquet(f"{root}/embeddings.parquet")


def test_query(spark, root, embeddings):
    vectors = {r.vec_id: r.embedding for r in embeddings.collect()}
    want = defined(vectors, [i for i in vectors if i % 20 == 0], 20)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op13_neighbours"](spark, root).collect())
    hits = len({(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want})
    assert hits >= 0.9 * len(want) and len(got) == len(want)
    assert all(s == score(vectors[q], vectors[v]) for q, _, v, s in got)


def test_factor_one_is_exact(spark, embeddings, monkeypatch):
    monkeypatch.setattr(vantage, "LEAF_ROWS", 8)
    vectors = {r.vec_id: r.embedding for r in embeddings.collect()}
    index = vantage.build_index(vantage.usable(embeddings, "vec_id", "embedding"), shard_rows=100)
    asked = vantage.query_blocks(vantage.usable(embeddings.where("vec_id % 20 = 0"), "vec_id", "embedding"), block_queries=7)
    got = sorted(tuple(r) for r in vantage.nearest(index, asked, 20, 1.0).collect())
    assert got == defined(vectors, [i for i in vectors if i % 20 == 0], 20)


def test_trees_prune_and_lose_nothing():
    """Clusters of unequal lengths, many copies: factor one is exact on a part of the leaves."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8)) * 5
    rows = centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 8)) * 0.1
    rows[1000:2000] = rows[7]
    ids = rng.permutation(4000)
    asked = np.flatnonzero(ids % 20 == 0)
    exact = vantage.Nearest(ids[asked], rows[asked], 20)
    for i in range(0, 4000, 500):
        q, c = np.meshgrid(np.arange(len(asked)), np.arange(i, i + 500), indexing="ij")
        exact.offer(q.ravel(), ids[c.ravel()], vantage.inner_products(rows[asked][q.ravel()], rows[c.ravel()]))
    shares, recalls = [], []
    for factor in (1.0, 2.0, 50.0):
        near, looked, leaves = vantage.Nearest(ids[asked], rows[asked], 20), 0, 0
        for half in (slice(0, 1900), slice(1900, 4000)):
            tree = vantage.plant(ids[half], rows[half], leaf_rows=16)
            looked += vantage.search(near, tree, factor)
            leaves += len(asked) * (len(tree["leaves"]) - 1)
        shares.append(looked / leaves)
        recalls.append(np.mean([len(set(a) & set(b)) / 20 for a, b in zip(near.ids, exact.ids)]))
        if factor == 1:
            assert np.array_equal(near.ids, exact.ids) and np.array_equal(near.scores, exact.scores)
    assert shares[0] < 0.6 and shares == sorted(shares, reverse=True) and recalls[0] == 1


def test_huge_and_tiny_components():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(600, 4)) * 10.0 ** rng.integers(-100, 100, 600)[:, None]
    near = vantage.Nearest(np.arange(600), rows, 5)
    vantage.search(near, vantage.plant(np.arange(600), rows, leaf_rows=32), 1.0)
    for q in range(0, 600, 40):
        want = sorted((-score(rows[q], rows[i]), i) for i in range(600) if i != q)[:5]
        assert [(-s, i) for s, i in zip(near.scores[q], near.ids[q])] == want


def test_one_long_vector_hides_no_neighbour(spark, tmp_path):
    """A vector much longer than the others lifts them all to about the same distance from a query."""
    rng = np.random.default_rng(5)
    values = rng.normal(size=(2000, 8)).astype(np.float32)
    values[7] = 1000
    lengths = np.exp(rng.normal(size=2000)).astype(np.float32)
    rows = [(i, v.tolist(), 0, "", 0, 0) for i, v in enumerate(values)] + [(i + 3000, [*v.tolist(), 0.5], 0, "", 0, 0) for i, v in enumerate(values[:, :5] * lengths[:, None])]
    spark.createDataFrame(rows, TABLE).write.parquet(f"{tmp_path}/embeddings.parquet")
    vectors = {i: np.array(v, dtype=np.float32).astype(float).tolist() for i, v, *_ in rows}
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in QUERIES["op13_neighbours"](spark, str(tmp_path)).collect())
    assert got == defined(vectors, [i for i in vectors if i % 20 == 0], 20)


def test_short_vectors_beside_a_long_one_are_told_apart(monkeypatch):
    """Few pairs are scored one by one even where all products are tiny beside the longest vector."""
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(1000, 6)) * 1e-20
    rows[3] = 1.0
    scored, plain = [], vantage.inner_products
    monkeypatch.setattr(vantage, "inner_products", lambda a, b: scored.append(len(a)) or plain(a, b))
    monkeypatch.setattr(vantage, "SCORED_CELLS", 6 * 500, raising=False)
    asked = np.arange(0, 1000, 20)
    near = vantage.Nearest(asked, rows[asked], 5)
    vantage.search(near, vantage.plant(np.arange(1000), rows, leaf_rows=50), 1.0)
    assert max(scored) <= 500 and sum(scored) < 0.5 * 50 * 1000
    for q in range(50):
        want = sorted((-score(rows[asked[q]], rows[i]), i) for i in range(1000) if i != asked[q])[:5]
        assert [(-s, i) for s, i in zip(near.scores[q], near.ids[q])] == want


def test_odd_rows(spark):
    nan, inf = math.nan, math.inf
    vectors = [(i, [float(i % 7), 1.0, -2.0]) for i in range(60)] + [(i, [1.0, float(i)]) for i in range(100, 122)]
    bad = [(200, None), (220, []), (240, [0.0, 0.0, 0.0]), (260, [nan, 1.0, 1.0]), (280, [inf, 1.0, 1.0]), (300, [None, 1.0, 1.0]), (None, [1.0, 1.0, 1.0])]
    again = [(20, [6.0, 1.0, -2.0]), (20, [9.0, 9.0, 9.0]), (3, [3.0, 1.0, -2.0])]
    rows = spark.createDataFrame([(i, v, 1, "v", 2, 3) for i, v in vectors + bad + again], TABLE)
    least = defaultdict(list)
    for i, v in vectors + again:
        least[i].append(v)
    least = {i: min(v) for i, v in least.items()}
    assert found(rows, factor=1.0) == defined(least, [i for i in least if i % 20 == 0], 20)
    lone = rows.where("vec_id = 40")
    assert found(lone) == [] and found(rows.limit(0)) == [] and found(rows.where("vec_id % 20 = 1")) == []
    few = rows.where("vec_id in (40, 41, 42)")
    assert found(few, k=20) == defined({i: least[i] for i in (40, 41, 42)}, [40], 20)


def test_one_vector_many_times(spark):
    rows = spark.range(0, 3000).select(F.col("id").alias("vec_id"), F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(2.0))).otherwise(F.array(F.col("id") / 3000, F.lit(1.0))).cast("array<float>").alias("embedding"))
    vectors = {r.vec_id: r.embedding for r in rows.collect()}
    assert found(rows, k=5, factor=1.0) == defined(vectors, [i for i in vectors if i % 20 == 0], 5)
