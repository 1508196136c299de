"""Nearest neighbours by inner product: a vantage-point tree per shard of the vectors.

The largest inner product is the smallest distance once each vector gets one more component that
brings all of a shard to the same length, and queries a zero. The triangle inequality then bounds
from below how near a leaf can come, by the distances of the query to the vantage points above it.
The bound is relaxed by what rounding may take. A factor on it, as `factor` allows, is not safe: one
vector much longer than the others lifts all of them to about the same large distance from any query,
and then a factor skips nearly every leaf.
"""

from __future__ import annotations

import io
from collections import OrderedDict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.session import materialise

SHARD_ROWS = 16_384
LEAF_ROWS = 256
BLOCK_QUERIES = 2_048
SEARCH_PARTS = 64
HELD_BLOCKS = 16
TRIALS, TRIAL_ROWS = 8, 256
FACTOR = 1.0
SLACK = 1e-7
NEAR = 1e-12
SCORED_CELLS = 1 << 22

INDEX = "shard int, dim int, tree binary"
BLOCK = "block int, dim int, queries binary"
FOUND = "block int, found binary"
RESULT = "query_id long, rank int, vec_id long, score double"


def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(data: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(data)) as stored:
        return {name: stored[name] for name in stored.files}


def by_dimension(table: pa.Table) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dimension, ids, matrix) for each length of `vector`, by id."""
    vectors = table["vector"].combine_chunks()
    ids = table["vec_id"].combine_chunks().to_numpy()
    lengths = np.diff(vectors.offsets.to_numpy())
    values = vectors.flatten().to_numpy().astype(np.float64) + 0.0
    begins = np.cumsum(lengths) - lengths
    for dim in np.unique(lengths):
        rows = np.flatnonzero(lengths == dim)
        rows = rows[np.argsort(ids[rows])]
        yield int(dim), ids[rows], values[begins[rows, None] + np.arange(dim)]


def distances(rows: np.ndarray, point: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", rows - point, rows - point))


def vantage_point(rows: np.ndarray) -> np.ndarray:
    """Of a few rows spread over the node, the one whose distances to others differ most."""
    pick = rows[np.linspace(0, len(rows) - 1, TRIALS).astype(int)]
    seen = rows[np.linspace(0, len(rows) - 1, TRIAL_ROWS).astype(int)]
    return pick[int(np.argmax([distances(seen, p).var() for p in pick]))]


def plant(ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """The tree of one shard, as arrays.

    Equal vectors are one entry with all their ids, so copies neither deepen the tree nor crowd a
    leaf. A node is split at the median distance from its vantage point; for each leaf the tree keeps
    the vantage points above it and the smallest and largest distance of its side from each.
    """
    rows_as_bytes = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel()
    _, first, entry = np.unique(rows_as_bytes, return_index=True, return_inverse=True)
    distinct = vectors[first]
    scale = float(np.abs(distinct).max())
    lifted = distinct / scale
    norms = np.einsum("ij,ij->i", lifted, lifted)
    top = float(norms.max())
    lifted = np.column_stack([lifted, np.sqrt(np.maximum(top - norms, 0))])

    points, leaves, paths = [], [], []
    stack = [(np.arange(len(distinct)), [])]
    while stack:
        node, path = stack.pop()
        if len(node) <= leaf_rows:
            leaves.append(node)
            paths.append(path)
            continue
        point = vantage_point(lifted[node])
        away = distances(lifted[node], point)
        order = np.argsort(away, kind="stable")
        half = len(node) // 2
        for side in (order[:half], order[half:]):
            stack.append((node[side], [*path, (len(points), away[side[0]], away[side[-1]])]))
        points.append(point)

    depth = max(map(len, paths))
    steps = np.array([[*p, *[(-1, 0.0, np.inf)] * (depth - len(p))] for p in paths]).reshape(len(paths), depth, 3)
    order = np.concatenate(leaves)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    by_place = np.lexsort((ids, place[entry]))
    exact = distinct[order]
    with np.errstate(over="ignore"):
        small = exact.astype(np.float32)
    return {
        "ids": ids[by_place],
        "first_id": np.append(0, np.cumsum(np.bincount(place[entry], minlength=len(order)))),
        "vectors": small if np.array_equal(small.astype(np.float64), exact) else exact,
        "leaves": np.append(0, np.cumsum([len(x) for x in leaves])),
        "points": np.array(points).reshape(len(points), lifted.shape[1])[:, :-1],
        "above": steps[:, :, 0].astype(np.int64),
        "low": steps[:, :, 1],
        "high": steps[:, :, 2],
        "shape": np.array([scale, top]),
    }


class Nearest:
    """The best `k` candidates of each query of a block so far, by score and then by id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> None:
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.ids = np.zeros((len(query_ids), k), dtype=np.int64)
        self.scores = np.full((len(query_ids), k), -np.inf)
        self.counts = np.zeros(len(query_ids), dtype=np.int64)

    def offer(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Candidates (number of the query, id, score); the query's own id is none."""
        other = ids != self.query_ids[query]
        held = np.arange(self.k) < self.counts[:, None]
        query = np.concatenate([np.nonzero(held)[0], query[other]])
        ids = np.concatenate([self.ids[held], ids[other]])
        scores = np.concatenate([self.scores[held], scores[other]])
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        begins = np.searchsorted(query, np.arange(len(self.query_ids) + 1))
        rank = np.arange(len(query)) - begins[query]
        best = rank < self.k
        self.ids[query[best], rank[best]] = ids[best]
        self.scores[query[best], rank[best]] = scores[best]
        self.counts = np.minimum(np.diff(begins), self.k)

    def pack(self) -> bytes:
        return packed(query_ids=self.query_ids, ids=self.ids, scores=self.scores, counts=self.counts)


def inner_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of rows in double precision, summed component by component in order, so that
    equal vectors get equal scores."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j].astype(np.float64)
    return total


def search(near: Nearest, tree: dict[str, np.ndarray], factor: float) -> int:
    """Offer the candidates of one tree to a block of queries; the number of leaves looked at.

    Each query takes the leaves by their bound, nearest first, and stops at the first whose bound,
    times `factor`, is beyond its k-th best distance so far. Products of whole leaves only choose what
    is scored; they are trusted up to their rounding, which follows from the two vectors and not from
    the longest of the tree.
    """
    k, (scale, top) = near.k, tree["shape"]
    size = np.abs(near.queries).max(axis=1)
    queries = near.queries / size[:, None]
    length = np.einsum("ij,ij->i", queries, queries)
    reach = np.sqrt(length) + np.sqrt(top)
    vectors = tree["vectors"].astype(np.float64) / scale
    to_points = np.sqrt(np.maximum(length[:, None] + top - 2 * queries @ tree["points"].T, 0))
    bounds = np.zeros((len(queries), len(tree["leaves"]) - 1))
    for level in range(tree["above"].shape[1]):
        there = tree["above"][:, level] >= 0
        away = to_points[:, tree["above"][there, level]]
        gap = np.maximum(tree["low"][there, level] - away, away - tree["high"][there, level])
        bounds[:, there] = np.maximum(bounds[:, there], gap)
    order = np.argsort(bounds, axis=1, kind="stable")
    # One more than k, as the query may find itself; what other trees gave does not hold it.
    best = np.full((len(queries), k + 1), -np.inf)
    full = near.counts == k
    with np.errstate(over="ignore", invalid="ignore"):
        best[full, :k] = near.scores[full] / size[full, None] / scale
    best[~np.isfinite(best)] = -np.inf
    known = np.where(full, best[:, k - 1], -np.inf)
    known[full] -= NEAR * np.abs(known[full])
    dim = queries.shape[1]
    loose = max(SLACK, 2 * np.sqrt(dim * np.finfo(float).eps))
    rounding = max(NEAR, 4 * dim * np.finfo(float).eps) * np.sqrt(dim) * np.abs(vectors).max(axis=1)
    active, looked, kept, waiting = np.arange(len(queries)), 0, [], 0

    def score() -> None:
        if not kept:
            return
        query, place, most = (np.concatenate(x) for x in zip(*kept))
        kept.clear()
        still = most >= np.maximum(known, best.min(axis=1))[query]
        query, place = query[still], place[still]
        step = max(1, SCORED_CELLS // dim)
        for begin in range(0, len(query), step):
            q, p = query[begin : begin + step], place[begin : begin + step]
            scores = inner_products(near.queries[q], tree["vectors"][p])
            # Of equal vectors only the k + 1 smallest ids can be among k neighbours, one being the query's own.
            copies = np.minimum(np.diff(tree["first_id"])[p], k + 1)
            ids = tree["ids"][np.repeat(tree["first_id"][p] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())]
            near.offer(np.repeat(q, copies), ids, np.repeat(scores, copies))

    for turn in range(order.shape[1]):
        leaf = order[active, turn]
        least = np.maximum(known[active], best[active].min(axis=1))
        kth = np.sqrt(np.maximum(length[active] + top - 2 * least, 0))
        open_ = factor * (bounds[active, leaf] - loose * reach[active]) <= kth
        active, leaf = active[open_], leaf[open_]
        if not len(active):
            break
        looked += len(active)
        by_leaf = np.argsort(leaf, kind="stable")
        for group in np.split(by_leaf, np.flatnonzero(np.diff(leaf[by_leaf])) + 1):
            a, b = tree["leaves"][leaf[group[0]] : leaf[group[0]] + 2]
            who = active[group]
            products = queries[who] @ vectors[a:b].T
            error = np.sqrt(length[who])[:, None] * rounding[a:b]
            both = np.concatenate([best[who], products - error], axis=1)
            best[who] = -np.partition(-both, k, axis=1)[:, : k + 1]
            least = np.maximum(known[who], best[who].min(axis=1))
            most = products + error
            row, column = np.nonzero(most >= least[:, None])
            kept.append((who[row], a + column, most[row, column]))
            waiting += len(row)
            if waiting * dim > SCORED_CELLS:
                score()
                waiting = 0
    score()
    return looked


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """`vec_id` and `vector` of the rows that take part, one for each id. Repeated ids meet by a
    partial aggregate, so one that many rows share is no task of its own."""
    vector = F.col(vec_col).cast("array<double>")
    sound = F.size(vector) > 0
    sound &= F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(vector, lambda x: x != 0)
    named = rows.where(F.col(id_col).isNotNull() & sound).select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))
    return named.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def dealt(rows: DataFrame, name: str, size: int) -> DataFrame:
    """Rows with a number from 0 on that about `size` of them share."""
    parts = max(1, -(-rows.count() // size))
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int"))


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One tree per shard (and dimension) of (`vec_id`, `vector`): `shard`, `dim`, `tree`, written.

    Shards are dealt by a hash of the id, so copies of one vector are spread over all of them and a
    shard's size does not depend on what its vectors are.
    """

    def planted(key: tuple, table: pa.Table) -> pa.Table:
        found = [(key[0].as_py(), dim, packed(**plant(ids, rows))) for dim, ids, rows in by_dimension(table)]
        return pa.table(dict(zip(("shard", "dim", "tree"), zip(*found))), schema=pa.schema([("shard", pa.int32()), ("dim", pa.int32()), ("tree", pa.binary())]))

    return materialise(dealt(vectors, "shard", shard_rows).groupBy("shard").applyInArrow(planted, INDEX), "vantage-index")


def query_blocks(queries: DataFrame, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """Queries (`vec_id`, `vector`) in blocks: `block`, `dim`, `queries`, written."""

    def gathered(key: tuple, table: pa.Table) -> pa.Table:
        found = [(key[0].as_py(), dim, packed(ids=ids, vectors=rows)) for dim, ids, rows in by_dimension(table)]
        return pa.table(dict(zip(("block", "dim", "queries"), zip(*found))), schema=pa.schema([("block", pa.int32()), ("dim", pa.int32()), ("queries", pa.binary())]))

    return materialise(dealt(queries, "block", block_queries).groupBy("block").applyInArrow(gathered, BLOCK), "vantage-queries")


def nearest(index: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR) -> DataFrame:
    """The `k` nearest found for each query: `query_id`, `rank`, `vec_id`, `score`.

    Every block of queries meets every tree: both are few rows, of some thousand vectors each, and the
    SEARCH_PARTS cells of their grid are as many tasks at most. A task carries what its blocks have found from tree to tree, so later trees are pruned by it, and
    hands on one row per block; `k` candidates per query and task are all that is shuffled.
    """

    def searched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int32()), ("found", pa.binary())])
        work: OrderedDict[tuple, Nearest] = OrderedDict()

        def handed(key: tuple) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"block": key[0], "found": work.pop(key).pack()}], schema=schema)

        for batch in batches:
            for i in range(batch.num_rows):
                block, dim, tree_dim, held, tree = (batch.column(c)[i].as_py() for c in ("block", "dim", "tree_dim", "queries", "tree"))
                if dim != tree_dim:
                    continue
                if (block, dim) not in work:
                    stored = unpacked(held)
                    work[block, dim] = Nearest(stored["ids"], stored["vectors"], k)
                work.move_to_end((block, dim))
                search(work[block, dim], unpacked(tree), factor)
                if len(work) > HELD_BLOCKS:
                    yield handed(next(iter(work)))
        for key in list(work):
            yield handed(key)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        parts = [unpacked(x) for x in table["found"].to_pylist()]
        query_ids = np.unique(np.concatenate([p["query_ids"] for p in parts]))
        near = Nearest(query_ids, np.zeros((len(query_ids), 0)), k)
        for p in parts:
            held = np.arange(k) < p["counts"][:, None]
            near.offer(np.searchsorted(query_ids, p["query_ids"])[np.nonzero(held)[0]], p["ids"][held], p["scores"][held])
        row, rank = np.nonzero(np.arange(k) < near.counts[:, None])
        columns = [query_ids[row], (rank + 1).astype(np.int32), near.ids[row, rank], near.scores[row, rank]]
        return pa.table(columns, schema=pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())]))

    # The grid of blocks and trees is cut into SEARCH_PARTS cells: parts of the trees, each met by teams
    # of blocks if there are fewer parts than that.
    parts = max(1, min(index.count(), SEARCH_PARTS))
    teams = max(1, min(queries.count(), SEARCH_PARTS // parts))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = queries.select("block", "dim", "queries", (F.col("block") % teams).alias("team"), every(parts).alias("part"))
    trees = index.select(F.col("dim").alias("tree_dim"), "tree", (F.col("shard") % parts).alias("part"), every(teams).alias("team"))
    # Dimensions are compared in the task: as a join key they would gather all pairs in one.
    pairs = blocks.join(trees, ["part", "team"]).select("block", "dim", "tree_dim", "queries", "tree")
    return pairs.mapInArrow(searched, FOUND).groupBy("block").applyInArrow(merged, RESULT)


def neighbours(
    rows: DataFrame, is_query, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 20, factor: float = FACTOR
) -> DataFrame:
    """The `k` rows of largest inner product for each row for which the column `is_query` holds.

    Candidates are all rows but those of the query's own id; scores are inner products of the
    original vectors in double precision; ties go to the smaller id. With `factor` 1 the result is
    exact; a larger one skips leaves that could hold a neighbour, of unequally long vectors most.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor do
    null ids. An id names one vector, the least of its rows (as arrays sort). Vectors meet those of
    their own dimension only. With fewer candidates than `k` there are fewer rows; without queries or
    vectors there are none. Other columns are ignored. No task holds more than a shard, or some blocks
    of queries and a tree, whatever the vectors are; all trees and blocks are in written tables.
    """
    vectors = materialise(usable(rows, id_col, vec_col), "vantage-vectors")
    asked = vectors.where(is_query)
    return nearest(build_index(vectors), query_blocks(asked), k, factor)
