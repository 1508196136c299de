"""Predictive power scores of all ordered column pairs.

Each score is the cross-validated gain of predicting y from x alone over predicting y without x, by a
fully grown tree of one feature. Numeric x has a bin per value if it has few, else bins of equal
numbers of rows; other x has a bin per category. Grown out, the tree answers with the mean (numeric
y) or the most frequent class (other y) of the training rows of a bin, whatever the widths of the
steps; a bin without training rows takes the answer of all. Numeric y is scored by its absolute error
against the overall median, other y by weighted F1 against the better of the constant and the random
guess. Folds come from the key's hash. A pair leaves out the rows that lack one of its two columns;
the overall median is that of all values of y.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators import ranks, relate
from statloom.operators.features import fit_categories, key_hash
from statloom.operators.ranks import col

FOLDS = 4
BINS = 64
# Categories beyond this many are told apart by a hash of so many buckets.
MAX_CODES = 1 << 16
# Counts of a pair up to this size are summed in the task before they leave it.
DENSE = 1 << 20

COUNTS = "x int, y int, fold int, bin int, class int, n long, total double"


@dataclass(frozen=True)
class Columns:
    """How the columns are read: numbers with the edges of their bins, then codes."""

    numeric: list[str]
    categorical: list[str]
    edges: list[np.ndarray]
    sizes: list[int]  # bins of each column, numeric ones first

    @property
    def names(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def bins(self, batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Folds, numbers and bins (-1 for a missing value) of a batch."""
        at = len(self.numeric) + 1
        values = [batch.column(1 + i).to_numpy(zero_copy_only=False) for i in range(len(self.numeric))]
        binned = [np.where(np.isnan(v), -1, np.searchsorted(e, v, "left")) for v, e in zip(values, self.edges)]
        codes = [batch.column(at + i).to_numpy(zero_copy_only=False) for i in range(len(self.categorical))]
        return batch.column(0).to_numpy(), values, [*binned, *codes]


def prepared(df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], bins: int) -> tuple[DataFrame, Columns, dict[str, float]]:
    """(fold, numbers, codes) of the rows, the columns, and the median of each number."""
    estimates = df.agg(*[F.approx_count_distinct(ranks.observed(df, c)).alias(c) for c in numeric]).first() if numeric else {}
    few = [c for c in numeric if estimates[c] <= 1.2 * bins]
    sets = df.agg(*[F.sort_array(F.collect_set(ranks.observed(df, c).cast("double"))).alias(c) for c in few]).first() if few else {}
    probs = {f"q{k}": k / bins for k in range(1, bins)} | {"median": 0.5}
    found = {r["column"]: r for r in ranks.quantiles(df, numeric, probs).collect()} if numeric else {}
    edges = []
    for c in numeric:
        if c in few and len(sets[c]) <= bins:
            edges.append(np.array(sets[c], dtype=float))
        else:
            edges.append(np.unique([found[c][f"q{k}"] for k in range(1, bins)]))
    known = fit_categories(df, categorical, MAX_CODES) if categorical else {}
    codes, sizes = [], [len(e) + 1 for e in edges]
    for c in categorical:
        if known[c] is None:
            codes.append(F.coalesce(F.pmod(F.xxhash64(col(c)), F.lit(MAX_CODES)), F.lit(-1)).cast("int"))
            codes[-1] = F.when(col(c).isNotNull(), codes[-1]).otherwise(-1)
            sizes.append(MAX_CODES)
        else:
            place = F.array_position(F.array(*[F.lit(v) for v in known[c]]), col(c).cast("string"))
            codes.append(F.coalesce(F.nullif(place, F.lit(0)) - 1, F.lit(-1)).cast("int") if known[c] else F.lit(-1))
            sizes.append(max(len(known[c]), 1))
    rows = df.select(
        (key_hash(col(key)) % FOLDS).cast("int").alias("fold"),
        *[F.coalesce(ranks.observed(df, c).cast("double"), F.lit(float("nan"))).alias(f"v{i}") for i, c in enumerate(numeric)],
        *[code.alias(f"c{i}") for i, code in enumerate(codes)],
    )
    return rows, Columns(list(numeric), list(categorical), edges, sizes), {c: found[c]["median"] for c in numeric if c in found}


def histograms(rows: DataFrame, columns: Columns) -> DataFrame:
    """Counts and sums of every pair by fold and bin of x, and by class where y has classes."""
    first_class, n_columns = len(columns.numeric), len(columns.names)

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense: dict[tuple[int, int], np.ndarray] = {}

        def table(x: int, y: int, code: np.ndarray, n: np.ndarray, total: np.ndarray) -> pa.RecordBatch:
            classes = columns.sizes[y] if y >= first_class else 1
            place, kind = np.divmod(code, classes)
            fold, bin_ = np.divmod(place, columns.sizes[x])
            kind = kind if y >= first_class else np.full(len(kind), -1)
            ints = [pa.array(np.broadcast_to(a, len(code)).astype(np.int32)) for a in (np.int32(x), np.int32(y), fold, bin_, kind)]
            return pa.RecordBatch.from_arrays([*ints, pa.array(n.astype(np.int64)), pa.array(total.astype(float))], ["x", "y", "fold", "bin", "class", "n", "total"])

        for batch in batches:
            fold, values, binned = columns.bins(batch)
            for x in range(n_columns):
                for y in range(n_columns):
                    if x == y:
                        continue
                    held = (binned[x] >= 0) & (binned[y] >= 0)
                    code = fold[held].astype(np.int64) * columns.sizes[x] + binned[x][held]
                    weight = values[y][held] if y < first_class else None
                    if y >= first_class:
                        code = code * columns.sizes[y] + binned[y][held]
                    size = FOLDS * columns.sizes[x] * (columns.sizes[y] if y >= first_class else 1)
                    if size <= DENSE:
                        sums = dense.setdefault((x, y), np.zeros((2, size)))
                        sums[0] += np.bincount(code, minlength=size)
                        if weight is not None:
                            sums[1] += np.bincount(code, weight, size)
                        continue
                    found, which, n = np.unique(code, return_inverse=True, return_counts=True)
                    yield table(x, y, found, n, np.bincount(which, weight, len(found)) if weight is not None else np.zeros(len(found)))
        for (x, y), sums in dense.items():
            code = np.flatnonzero(sums[0])
            yield table(x, y, code, sums[0][code], sums[1][code])

    keys = ["x", "y", "fold", "bin", "class"]
    return rows.mapInArrow(counted, COUNTS).groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def tree_means(counts: list, columns: Columns, medians: dict[str, float]) -> dict[tuple[int, int], np.ndarray]:
    """For each pair with numeric y the answers (fold left out, bin of x)."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for r in counts:
        sums.setdefault((r["x"], r["y"]), np.zeros((2, FOLDS, columns.sizes[r["x"]])))[:, r["fold"], r["bin"]] = r["n"], r["total"]
    out = {}
    for (x, y), s in sums.items():
        n, total = s.sum(axis=1, keepdims=True) - s
        out[x, y] = np.where(n > 0, total / np.maximum(n, 1), medians[columns.names[y]])
    return out


def numeric_scores(rows: DataFrame, columns: Columns, answers: dict[tuple[int, int], np.ndarray], medians: dict[str, float]) -> DataFrame:
    """(x, y, score) for numeric y, from absolute errors of held-out rows."""
    middle = [medians.get(c, 0.0) for c in columns.numeric]

    def missed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {pair: np.zeros(2) for pair in answers}
        for batch in batches:
            fold, values, binned = columns.bins(batch)
            for (x, y), answer in answers.items():
                held = (binned[x] >= 0) & (binned[y] >= 0)
                actual = values[y][held]
                total[x, y] += np.abs(actual - answer[fold[held], binned[x][held]]).sum(), np.abs(actual - middle[y]).sum()
        pairs = np.array(list(total), dtype=np.int32).reshape(-1, 2)
        sums = np.array(list(total.values())).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in (*pairs.T, *sums.T)], ["x", "y", "error", "naive"])

    errors = rows.mapInArrow(missed, "x int, y int, error double, naive double").groupBy("x", "y").agg(F.sum("error").alias("e"), F.sum("naive").alias("b"))
    return errors.select("x", "y", F.when(F.col("b") > 0, F.greatest(F.lit(0.0), 1 - F.col("e") / F.col("b"))).otherwise(0.0).alias("score"))


def most_frequent(group: np.ndarray, kind: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Groups in order and the class of each with the largest sum of `n`, the smallest on ties."""
    order = np.lexsort((kind, group))
    group, kind, n = group[order], kind[order], n[order]
    opens = np.ones(len(group), dtype=bool)
    opens[1:] = (group[1:] != group[:-1]) | (kind[1:] != kind[:-1])
    first = np.flatnonzero(opens)
    group, kind, n = group[first], kind[first], np.add.reduceat(n, first) if len(first) else n[:0]
    order = np.lexsort((kind, -n, group))
    _, best = np.unique(group[order], return_index=True)
    return group[order][best], kind[order][best]


def weighted_f1_gain(actual: np.ndarray, called: np.ndarray, n: np.ndarray) -> float:
    """Weighted F1 of the calls, as a gain over the better of the constant and the random guess."""
    kinds, place = np.unique(np.concatenate([actual, called]), return_inverse=True)
    a, c = place[: len(actual)], place[len(actual) :]
    support, guessed = np.bincount(a, n, len(kinds)), np.bincount(c, n, len(kinds))
    hits = np.bincount(a, n * (a == c), len(kinds))
    total = support.sum()
    model = (2 * hits / np.maximum(support + guessed, 1) * support).sum() / total
    share = support.max() / total
    base = max(2 * share**2 / (1 + share), (support**2).sum() / total**2)
    return max(0.0, (model - base) / (1 - base)) if base < 1 else 0.0


def class_score(table: pa.Table) -> float:
    """The score of one pair from its counts by fold, bin and class."""
    fold, bin_, kind, n = (table[c].to_numpy() for c in ("fold", "bin", "class", "n"))
    called = np.empty(len(n), dtype=np.int64)
    for held in range(FOLDS):
        own, rest = fold == held, fold != held
        if not rest.any():
            called[own] = -1
            continue
        _, usual = most_frequent(np.zeros(rest.sum(), dtype=int), kind[rest], n[rest])
        bins, best = most_frequent(bin_[rest], kind[rest], n[rest])
        at = np.minimum(np.searchsorted(bins, bin_[own]), len(bins) - 1)
        called[own] = np.where(bins[at] == bin_[own], best[at], usual[0])
    return weighted_f1_gain(kind.astype(np.int64), called, n.astype(float))


def class_scores(counts: DataFrame) -> DataFrame:
    """(x, y, score) for y with classes; the counts of a pair are as large as bins and classes are."""

    def scored(key: tuple, table: pa.Table) -> pa.Table:
        x, y = (k.as_py() for k in key)
        return pa.table({"x": pa.array([x], pa.int32()), "y": pa.array([y], pa.int32()), "score": [class_score(table)]})

    return counts.where("class >= 0").groupBy("x", "y").applyInArrow(scored, "x int, y int, score double")


def pps_matrix(df: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], bins: int = BINS) -> DataFrame:
    """(x, y, score) with 1 on the diagonal and 0 where x adds nothing.

    Rows are read for the edges of the bins, for the histograms of all pairs at once, and for the
    errors of numeric y; nothing of row size is shuffled. A pair without common rows scores 0.
    """
    rows, columns, medians = prepared(df, key, numeric, categorical, bins)
    counts = histograms(rows, columns).persist()
    answers = tree_means(counts.where("class < 0").collect(), columns, medians)
    parts = class_scores(counts)
    if answers:
        parts = numeric_scores(rows, columns, answers, medians).unionByName(parts)
    spark, names = df.sparkSession, columns.names
    found = {(r["x"], r["y"]): r["score"] for r in parts.collect()}
    counts.unpersist()
    scores = [(a, b, 1.0 if a == b else float(found.get((i, j), 0.0))) for i, a in enumerate(names) for j, b in enumerate(names)]
    return as_table(spark, scores)


def as_table(spark: SparkSession, scores: list[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame(scores, "x string, y string, score double")


def pps_wide(scores: DataFrame, names: Sequence[str] | None = None) -> DataFrame:
    """One row per x, one column per y; without `names` in the order of the names."""
    return relate.pivot(scores, "x", "y", "score", names)
