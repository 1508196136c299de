"""Linear models from moment matrices.

Spark reduces the rows to counts, means and covariances, per fold where needed, in one aggregation.
The rest is algebra on matrices whose size is the number of features, and happens on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from statloom.operators.ranks import col

# Above this many columns pairwise aggregate expressions give way to blocked matrix products.
MAX_EXPRESSION_COLUMNS = 12
# Normal equations lose about as many digits as the condition of the correlations has.
WORST_CONDITION = 1e7
REDUCERS = 64
# A fit that takes longer is reported as an error, never returned.
MAX_SWEEPS = 1_000_000


@dataclass(frozen=True)
class Moments:
    """Row count, means and population covariances."""

    n: int
    mean: np.ndarray
    cov: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        n = self.n + other.n
        shift = other.mean - self.mean
        cov = (
            self.n * self.cov
            + other.n * other.cov
            + np.outer(shift, shift) * self.n * other.n / n
        ) / n
        return Moments(n, self.mean + shift * other.n / n, cov)


def fit_moments(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> dict[tuple, Moments]:
    """Moments of complete rows, per group of `by` (folds or classes, so a handful)."""
    d = len(cols)
    if d > MAX_EXPRESSION_COLUMNS:
        array = F.array(*[col(c).cast("double") for c in cols])
        rows = df.dropna(subset=list(cols))
        if by:
            return grouped_moments(rows.select(F.struct(*[col(b) for b in by]).alias("__g"), array.alias("__x")), d)
        return {(): array_moments(rows.select(array.alias("__x")), "__x", d)}
    rows = (
        df.dropna(subset=list(cols))
        .select(*[col(b) for b in by], *[col(c).cast("double").alias(f"__{i}") for i, c in enumerate(cols)])
        .groupBy(*[col(b) for b in by])
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.array(*[F.avg(f"__{i}") for i in range(d)]).alias("mean"),
            F.array(*[F.covar_pop(f"__{i}", f"__{j}") for i in range(d) for j in range(i + 1)]).alias("cov"),
        )
        .collect()
    )
    found = {}
    for row in rows:
        if not row["n"]:
            continue
        cov = np.zeros((d, d))
        cov[np.tril_indices(d)] = row["cov"]
        cov = cov + np.tril(cov, -1).T
        found[tuple(row[b] for b in by)] = Moments(row["n"], np.array(row["mean"], dtype=float), cov)
    return found


def array_moments(df: DataFrame, name: str, size: int) -> Moments:
    """Moments of an array column: first the means, then blocked products of centred rows. Each
    task sends one size x size block, summed entry by entry."""
    wide = df.select(*[F.get(col(name), i).cast("double").alias(f"m{i}") for i in range(size)])
    head = wide.agg(F.count("m0").alias("n"), F.array(*[F.avg(f"m{i}") for i in range(size)]).alias("mean")).first()
    mean = np.array(head["mean"], dtype=float)

    def products(batches):
        total = np.zeros((size, size))
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(-1, size) - mean
            total += x.T @ x
        i, j = np.divmod(np.arange(size * size), size)
        yield pd.DataFrame({"i": i, "j": j, "s": total.ravel()})

    blocks = (
        df.select(col(name).alias("x"))
        .mapInPandas(products, "i int, j int, s double")
        .groupBy("i", "j")
        .agg(F.sum("s").alias("s"))
        .collect()
    )
    cov = np.zeros((size, size))
    for b in blocks:
        cov[b["i"], b["j"]] = b["s"] / head["n"]
    return Moments(head["n"], mean, cov)


def grouped_moments(df: DataFrame, size: int) -> dict[tuple, Moments]:
    """Moments of the array column `__x` per group `__g`, of which there is a handful. Products are
    centred on the mean of all rows, and each task sends one block per group."""
    wide = df.select(*[F.get("__x", i).alias(f"m{i}") for i in range(size)])
    head = wide.agg(F.array(*[F.avg(f"m{i}") for i in range(size)]).alias("mean")).first()
    centre = np.array(head["mean"], dtype=float)
    if not centre.size or np.isnan(centre).any():
        return {}

    def products(batches):
        found: dict[str, list] = {}
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(-1, size) - centre
            for name in batch["g"].unique():
                own = x[(batch["g"] == name).to_numpy()]
                n, s, p = found.get(name, (0, 0.0, 0.0))
                found[name] = (n + len(own), s + own.sum(axis=0), p + own.T @ own)
        i, j = np.divmod(np.arange(size * size), size)
        for name, (n, s, p) in found.items():
            yield pd.DataFrame({"g": name, "i": i, "j": j, "n": float(n), "s": s[i], "p": p.ravel()})

    named = df.select(F.to_json("__g").alias("g"), F.col("__x").alias("x"))
    blocks = named.mapInPandas(products, "g string, i int, j int, n double, s double, p double")
    sums = blocks.groupBy("g", "i", "j").agg(*[F.sum(c).alias(c) for c in "nsp"]).collect()
    keys = {r["g"]: tuple(r["k"]) for r in df.select(F.to_json("__g").alias("g"), F.col("__g").alias("k")).distinct().collect()}
    out = {}
    for name, key in keys.items():
        own = sorted((r for r in sums if r["g"] == name), key=lambda r: (r["i"], r["j"]))
        n = own[0]["n"]
        s = np.array([r["s"] for r in own]).reshape(size, size)[:, 0] / n
        p = np.array([r["p"] for r in own]).reshape(size, size) / n
        out[key] = Moments(int(n), centre + s, p - np.outer(s, s))
    return out


@dataclass(frozen=True)
class LinearFit:
    """Coefficients in the units of the columns as given."""

    cols: tuple[str, ...]
    intercept: float
    coef: np.ndarray
    penalty: float = 0.0

    def predict(self) -> Column:
        """The prediction as a column expression."""
        terms = [col(c).cast("double") * F.lit(float(w)) for c, w in zip(self.cols, self.coef)]
        return reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))

    def table(self, spark: SparkSession) -> DataFrame:
        """(feature, coefficient), strongest first."""
        rows = sorted(zip(self.cols, map(float, self.coef)), key=lambda r: (-abs(r[1]), r[0]))
        return spark.createDataFrame(rows, "feature string, coefficient double")


def _split(m: Moments) -> tuple[np.ndarray, np.ndarray]:
    """Feature covariance and feature-target covariance; the target is the last column."""
    return m.cov[:-1, :-1], m.cov[:-1, -1]


def _finish(m: Moments, cols: Sequence[str], coef: np.ndarray, penalty: float) -> LinearFit:
    return LinearFit(tuple(cols), float(m.mean[-1] - m.mean[:-1] @ coef), coef, penalty)


def triangle(df: DataFrame, cols: Sequence[str], centre: np.ndarray) -> np.ndarray:
    """The R factor of the complete rows of `cols` minus `centre`. Each task reduces its rows to one
    factor of the size of the column list, factors meet in REDUCERS groups, and those on the driver."""
    size, middle = len(cols), np.asarray(centre, dtype=float)

    def reduced(blocks) -> pa.Table:
        r = np.zeros((0, size))
        for block in blocks:
            r = np.linalg.qr(np.vstack([r, block]), mode="r")
        return pa.table({"r": pa.array([r.ravel()], pa.list_(pa.float64()))})

    def factor(batches):
        yield from reduced(b.column(0).flatten().to_numpy().reshape(-1, size) - middle for b in batches if b.num_rows).to_batches()

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        return reduced(np.array(r).reshape(-1, size) for r in table["r"].to_pylist())

    rows = df.dropna(subset=list(cols)).select(F.array(*[col(c).cast("double") for c in cols]).alias("x"))
    factors = rows.mapInArrow(factor, "r array<double>").where(F.size("r") > 0)
    groups = factors.groupBy(F.pmod(F.xxhash64("r"), F.lit(REDUCERS)).alias("g")).applyInArrow(merged, "r array<double>")
    return np.linalg.qr(np.vstack([np.zeros((1, size)), *[np.array(g["r"]).reshape(-1, size) for g in groups.collect()]]), mode="r")


def ols(df: DataFrame, cols: Sequence[str], target: str) -> LinearFit:
    """Least squares. Normal equations square the condition of the features; where that leaves too few
    digits, the rows are read again and reduced to triangles instead."""
    m = fit_moments(df, [*cols, target])[()]
    a, b = _split(m)
    spread = np.sqrt(np.maximum(np.diag(a), 0))
    scale = np.where(spread > 0, spread, 1.0)
    if len(b) > 1 and np.linalg.cond(a / np.outer(scale, scale)) > WORST_CONDITION:
        r = triangle(df, [*cols, target], m.mean)
        return _finish(m, cols, np.linalg.lstsq(r[:, :-1] / scale, r[:, -1], rcond=None)[0] / scale, 0.0)
    return _finish(m, cols, np.linalg.lstsq(a, b, rcond=None)[0], 0.0)


def ridge(df: DataFrame, cols: Sequence[str], target: str, alpha: float) -> LinearFit:
    """Minimises ||y - Xw||^2 + alpha ||w||^2 with a free intercept."""
    m = fit_moments(df, [*cols, target])[()]
    return _ridge_of(m, cols, alpha)


def _ridge_of(m: Moments, cols: Sequence[str], alpha: float) -> LinearFit:
    a, b = _split(m)
    return _finish(m, cols, np.linalg.solve(a + alpha / m.n * np.eye(len(b)), b), alpha)


def ridge_cv(
    df: DataFrame, cols: Sequence[str], target: str, alphas: Sequence[float] = (0.1, 1.0, 10.0)
) -> tuple[LinearFit, dict[float, float]]:
    """Ridge with the penalty of the smallest leave-one-out error, and that error per penalty. The
    held-out residual of a row is its residual over one minus its leverage; leverages of all
    penalties are expressions of one second scan."""
    m = fit_moments(df, [*cols, target])[()]
    fits = {a: _ridge_of(m, cols, a) for a in alphas}
    centred = [col(c).cast("double") - F.lit(float(mu)) for c, mu in zip(cols, m.mean)]
    errors = []
    for i, (alpha, fit) in enumerate(fits.items()):
        inverse = np.linalg.inv(m.n * m.cov[:-1, :-1] + alpha * np.eye(len(cols)))
        leverage = F.lit(1.0 / m.n)
        for p in range(len(cols)):
            for q in range(p + 1):
                weight = float(inverse[p, q]) * (1.0 if p == q else 2.0)
                leverage = leverage + centred[p] * centred[q] * F.lit(weight)
        residual = (col(target).cast("double") - fit.predict()) / (F.lit(1.0) - leverage)
        errors.append(F.avg(residual * residual).alias(f"e{i}"))
    row = df.dropna(subset=[*cols, target]).agg(*errors).first()
    scores = {a: row[f"e{i}"] for i, a in enumerate(fits)}
    return fits[min(scores, key=scores.get)], scores


def _descend(a: np.ndarray, b: np.ndarray, alpha: float, w: np.ndarray) -> np.ndarray:
    """Coordinate descent for w'aw/2 - b'w + alpha |w|_1, until it has converged."""
    w = w.copy()
    for _ in range(MAX_SWEEPS):
        largest = 0.0
        for j in range(len(b)):
            if a[j, j] <= 0:
                continue
            slope = b[j] - a[j] @ w + a[j, j] * w[j]
            fresh = np.sign(slope) * max(abs(slope) - alpha, 0.0) / a[j, j]
            largest = max(largest, abs(fresh - w[j]) * np.sqrt(a[j, j]))
            w[j] = fresh
        if largest < 1e-12 * max(np.sqrt(np.abs(b)).max(initial=0.0), 1e-300):
            return w
    raise RuntimeError(f"lasso did not converge in {MAX_SWEEPS} sweeps")


def lasso(df: DataFrame, cols: Sequence[str], target: str, alpha: float) -> LinearFit:
    """Minimises ||y - Xw||^2 / (2n) + alpha |w|_1 with a free intercept."""
    m = fit_moments(df, [*cols, target])[()]
    a, b = _split(m)
    return _finish(m, cols, _descend(a, b, alpha, np.zeros(len(b))), alpha)


def lasso_cv(
    df: DataFrame, cols: Sequence[str], target: str, fold: str, n_alphas: int = 100, eps: float = 1e-3
) -> tuple[LinearFit, dict[float, float]]:
    """Lasso with the penalty of the smallest cross-validated squared error. The path runs over
    `n_alphas` log-spaced penalties from the smallest one that gives zero coefficients down to
    `eps` times it. One aggregation per fold serves both training and validation, as the held-out
    error is a quadratic form of the fold's own moments."""
    folds = fit_moments(df, [*cols, target], [fold])
    whole = reduce(lambda x, y: x + y, folds.values())
    a, b = _split(whole)
    top = float(np.abs(b).max())
    alphas = np.geomspace(top, top * eps, n_alphas)
    error = np.zeros(n_alphas)
    for key, held in folds.items():
        train = reduce(lambda x, y: x + y, [m for k, m in folds.items() if k != key])
        ta, tb = _split(train)
        w = np.zeros(len(cols))
        for i, alpha in enumerate(alphas):
            w = _descend(ta, tb, alpha, w)
            direction = np.append(-w, 1.0)
            bias = (held.mean - train.mean) @ direction
            error[i] += (direction @ held.cov @ direction + bias * bias) / len(folds)
    best = float(alphas[int(error.argmin())])
    fit = _finish(whole, cols, _descend(a, b, best, np.zeros(len(cols))), best)
    return fit, dict(zip(map(float, alphas), map(float, error)))
