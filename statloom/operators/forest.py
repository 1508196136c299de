"""Isolation forest: rows that few random cuts set apart are anomalies.

Each tree is grown on 256 rows. The sample pool is the rows with the smallest key hashes, so it has
a fixed size and does not depend on partitioning; trees then draw from the pool by a second hash.
Trees are grown in parallel, one group of 256 rows each. All rows are scored, by a batch-wise walk
through the broadcast forest of at most trees x 511 nodes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from statloom.operators import ranks
from statloom.operators.features import key_hash
from statloom.operators.ranks import attach, col
from statloom.session import materialise

EULER = 0.5772156649015329
NODE = "tree int, node int, feature int, cut double, left int, right int, size int, depth int"


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    many = 2.0 * (np.log(np.maximum(n - 1.0, 1.0)) + EULER) - 2.0 * (n - 1.0) / np.maximum(n, 1.0)
    return np.where(n > 2, many, np.where(n == 2, 1.0, 0.0))


def grow(x: np.ndarray, seed: int, limit: int) -> list[tuple]:
    """Nodes (node, feature, cut, left, right, size, depth); feature -1 marks a leaf."""
    rng = np.random.default_rng(seed)
    nodes: list[list] = []
    stack = [(np.arange(len(x)), 0, -1, 0)]
    while stack:
        rows, depth, parent, side = stack.pop()
        here = len(nodes)
        if parent >= 0:
            nodes[parent][3 + side] = here
        low, high = (x[rows].min(axis=0), x[rows].max(axis=0)) if len(rows) else (None, None)
        open_features = np.flatnonzero(high > low) if len(rows) > 1 and depth < limit else []
        if len(open_features) == 0:
            nodes.append([here, -1, 0.0, -1, -1, len(rows), depth])
            continue
        feature = int(rng.choice(open_features))
        cut = float(rng.uniform(low[feature], high[feature]))
        nodes.append([here, feature, cut, -1, -1, len(rows), depth])
        goes_left = x[rows, feature] < cut
        stack.append((rows[~goes_left], depth + 1, here, 1))
        stack.append((rows[goes_left], depth + 1, here, 0))
    return [tuple(n) for n in nodes]


def sample_pool(df: DataFrame, cols: Sequence[str], key: str, n_trees: int, sample: int) -> DataFrame:
    """The rows with the smallest key hashes, about n_trees x sample of them, or all of a smaller
    table. The hash bound follows from the row count, a scalar subquery, so no row is sorted."""
    digits = 13
    wanted = n_trees * sample
    n = df.agg(F.count(F.lit(1)).alias("rows"))
    rows = F.greatest(F.col("__size")["rows"], F.lit(1))
    share = F.least(F.lit(1.0), F.lit(1.2 * wanted) / rows)
    return (
        attach(df, n, "__size")
        .where(key_hash(col(key), "pool", digits) < share * F.lit(float(16**digits)))
        .select(
            col(key).alias("__key"),
            F.array(*[col(c).cast("double") for c in cols]).alias("x"),
            F.least(rows.cast("double"), F.lit(1.2 * wanted)).alias("__pool"),
        )
    )


def draw(pool: DataFrame, n_trees: int, sample: int) -> DataFrame:
    """(tree, x): the `sample` rows with the smallest hashes of key and tree, without replacement.
    Only hashes in the lowest part, where four times as many rows are expected, are ranked."""
    tree = F.explode(F.sequence(F.lit(0), F.lit(n_trees - 1))).alias("tree")
    part = F.least(F.lit(1.0), F.lit(4.0 * sample) / F.col("__pool"))
    hashed = (
        pool.select("x", "__key", "__pool", tree)
        .withColumn("__h", F.xxhash64(F.col("__key").cast("string"), F.col("tree")))
        .where(F.col("__h") <= (part * 2 - 1) * F.lit(float(2**63)))
    )
    order = Window.partitionBy("tree").orderBy("__h", "__key")
    return hashed.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= sample).select("tree", "x", "__r")


@dataclass(frozen=True)
class Forest:
    cols: tuple[str, ...]
    sample: int
    nodes: pd.DataFrame

    def score(self, df: DataFrame, name: str = "score") -> DataFrame:
        """Adds the anomaly score 2^(-mean depth / expected depth)."""
        trees, d = [], len(self.cols)
        for _, t in self.nodes.sort_values(["tree", "node"]).groupby("tree"):
            # A leaf is its own child and sends every row there, so all rows walk equally far.
            leaf = (t["feature"] < 0).to_numpy()
            here = np.arange(len(t))
            child = np.stack(
                [np.where(leaf, here, t["left"]), np.where(leaf, here, t["right"])], axis=1
            ).ravel()
            trees.append(
                (
                    np.where(leaf, 0, t["feature"]),
                    np.where(leaf, np.inf, t["cut"]),
                    child,
                    t["depth"].to_numpy() + average_path(t["size"].to_numpy()),
                    int(t["depth"].max()),
                )
            )
        forest = df.sparkSession.sparkContext.broadcast(trees)
        norm = float(average_path(np.array(self.sample)))
        norm = norm if norm > 0 else 1.0

        @F.pandas_udf(DoubleType())
        def walk(*columns: pd.Series) -> pd.Series:
            values = np.stack([c.to_numpy(dtype=float) for c in columns], axis=1).ravel()
            first = np.arange(len(values) // d) * d
            depth = np.zeros(len(first))
            for feature, cut, child, path, steps in forest.value:
                at = np.zeros(len(first), dtype=np.int64)
                for _ in range(steps):
                    at = child[2 * at + (values[first + feature[at]] >= cut[at])]
                depth += path[at]
            return pd.Series(np.exp2(-depth / len(forest.value) / norm))

        return df.withColumn(name, walk(*[col(c).cast("double") for c in self.cols]))


def fit_forest(
    df: DataFrame, cols: Sequence[str], key: str, n_trees: int = 100, sample: int = 256, seed: int = 42
) -> Forest:
    """Grow the trees on the executors and bring the nodes, at most n_trees x (2 sample - 1), back."""
    limit = int(np.ceil(np.log2(max(sample, 2))))
    rows = draw(sample_pool(df.dropna(subset=list(cols)), cols, key, n_trees, sample), n_trees, sample)

    def build(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("__r")
        tree = int(ordered["tree"].iloc[0])
        nodes = grow(np.array(ordered["x"].tolist(), dtype=float), seed * 100_003 + tree, limit)
        names = ["node", "feature", "cut", "left", "right", "size", "depth"]
        return pd.DataFrame(nodes, columns=names).assign(tree=tree)[
            ["tree", "node", "feature", "cut", "left", "right", "size", "depth"]
        ]

    nodes = rows.groupBy("tree").applyInPandas(build, NODE).toPandas()
    used = int(nodes[nodes["node"] == 0]["size"].max()) if len(nodes) else 0
    return Forest(tuple(cols), used, nodes)


def flag_outliers(
    df: DataFrame,
    cols: Sequence[str],
    key: str,
    contamination: float = 0.05,
    n_trees: int = 100,
    sample: int = 256,
    seed: int = 42,
) -> DataFrame:
    """Adds `score` and `outlier_flag`: -1 for scores above the (1 - contamination) quantile, else 1.
    The scores are written once, as finding the quantile and flagging both read them."""
    scored = materialise(fit_forest(df, cols, key, n_trees, sample, seed).score(df), "scores")
    limit = ranks.quantile_row(scored, ["score"], {"cut": 1.0 - contamination})
    return (
        attach(scored, limit, "__limit")
        .withColumn("outlier_flag", F.when(F.col("score") > F.col("__limit")["score"]["cut"], -1).otherwise(1))
        .drop("__limit")
    )
