"""Logistic regression and support vector machines with C-style penalties.

A penalty C against the summed loss equals `regParam = 1 / (C n)` against the mean loss that Spark
ML minimises. Machines with a Gaussian or cubic kernel are those of `kernels`.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statloom.operators import kernels, linear, ranks
from statloom.operators.features import key_hash
from statloom.operators.kernels import Machine
from statloom.operators.ranks import col


def compact(df: DataFrame, rows: int, width: int, bytes_each: int = 64 << 20) -> DataFrame:
    """Deal a mapped training table out to partitions of `bytes_each`: every step of an optimizer is
    a job, so its cost is the number of tasks. The mapping itself runs before, in as many tasks as
    its input has."""
    return df.repartition(max(1, -(-rows * width * 8 // bytes_each)))


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients in the units of the columns as given."""

    cols: tuple[str, ...]
    intercept: float
    coef: np.ndarray
    steps: int

    def probability(self) -> Column:
        """P(class 1) as a column expression."""
        terms = [col(c).cast("double") * F.lit(float(w)) for c, w in zip(self.cols, self.coef)]
        score = reduce(lambda a, b: a + b, terms, F.lit(float(self.intercept)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-score))


def fit_logistic(df: DataFrame, cols: Sequence[str], label: str, c: float = 1.0, tol: float = 1e-10, most: int = 100) -> LogisticFit:
    """Logistic regression with a squared penalty on the coefficients and none on the intercept, by Newton's
    method on the complete rows. Features are used as given.

    Each step is one pass in which tasks add up loss, gradient and curvature, matrices of the size of
    the column list. Steps that do not lower the loss are halved; a fit that needs more than `most`
    passes is an error. So the result is exact to rounding, and few passes are enough.
    """
    size = len(cols) + 1
    rows = df.dropna(subset=[*cols, label]).select(F.array(F.lit(1.0), *[col(x).cast("double") for x in cols]).alias("x"), col(label).cast("double").alias("y"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)

    def passed(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def summed(batches):
            loss, slope, bend = 0.0, np.zeros(size), np.zeros((size, size))
            for b in batches:
                if b.num_rows:
                    x, y = b.column(0).flatten().to_numpy().reshape(-1, size), b.column(1).to_numpy()
                    z = x @ w
                    p = 0.5 * (1 + np.tanh(z / 2))
                    loss += float((np.logaddexp(0, z) - y * z).sum())
                    slope += x.T @ (p - y)
                    bend += (x * (p * (1 - p))[:, None]).T @ x
            values = np.concatenate([[loss], slope, bend.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["i", "v"])

        sums = rows.mapInArrow(summed, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).orderBy("i").collect()
        v = np.array([r["v"] for r in sums])
        penalty = np.append(0.0, np.ones(size - 1))
        return c * v[0] + 0.5 * (penalty * w) @ w, c * v[1 : size + 1] + penalty * w, c * v[size + 1 :].reshape(size, size) + np.diag(penalty)

    try:
        w = np.zeros(size)
        loss, slope, bend = passed(w)
        for step in range(1, most + 1):
            move = np.linalg.lstsq(bend, -slope, rcond=None)[0]
            if np.abs(move).max() <= tol * max(1.0, np.abs(w).max()):
                return LogisticFit(tuple(cols), float(w[0]), w[1:], step)
            ahead = passed(w + move)
            while ahead[0] > loss + 1e-9 * abs(loss) and np.abs(move).max() > tol:
                move = move / 2
                ahead = passed(w + move)
            w, (loss, slope, bend) = w + move, ahead
        raise RuntimeError(f"no convergence in {most} steps")
    finally:
        rows.unpersist()


def linear_svm(n: int, c: float = 1.0, label: str = "label", max_iter: int = 100) -> LinearSVC:
    """Hinge-loss machine with a squared penalty on the coefficients."""
    return LinearSVC(
        featuresCol="features",
        labelCol=label,
        regParam=1.0 / (c * n),
        standardization=False,
        maxIter=max_iter,
        tol=1e-6,
        aggregationDepth=2,
    )


def gamma_scale(moments: linear.Moments) -> float:
    """1 / (d Var(X)), the variance taken over all entries of the feature matrix."""
    spread = float(np.mean(np.diag(moments.cov)) + np.var(moments.mean))
    return 1.0 / (len(moments.mean) * spread) if spread > 0 else 1.0


def converged_svm(train: DataFrame, n: int, c: float, max_iter: int = 1600, most: int = 25_600):
    """A linear machine whose optimizer has stopped by itself: with more steps as long as it used all."""
    while True:
        model = linear_svm(n, c, max_iter=max_iter).fit(train)
        if model.summary().totalIterations < max_iter:
            return model
        if max_iter >= most:
            raise RuntimeError(f"no convergence in {max_iter} steps")
        max_iter *= 4


def gamma_of(moments: linear.Moments, gamma: float | str | None) -> float:
    return gamma_scale(moments) if gamma in (None, "scale") else float(gamma)


def predicted(fits: kernels.Fits, df: DataFrame, which: int = 0) -> DataFrame:
    """`df` with the class that a machine calls as `prediction`: 1 where its decision value is above 0."""
    return fits.decide(df, which, "__decision").withColumn("prediction", F.when(F.col("__decision") > 0, 1.0).otherwise(0.0)).drop("__decision")


def fit_kernel_svm(
    train: DataFrame,
    test: DataFrame,
    cols: Sequence[str],
    label: str,
    key: str,
    kernel: str,
    c: float = 1.0,
    gamma: float | None = None,
) -> DataFrame:
    """Train on one table and predict another: `test` with a `prediction` column. The linear kernel is
    solved in the primal, by Spark's optimizer, the others in the dual on true kernel values."""
    if kernel == "linear":
        if gamma is not None:
            raise ValueError("the linear kernel has no gamma")
        mapped = linear_features(train, cols).select(col(label).cast("double").alias("label"), "features")
        n = train.count()
        mapped = compact(mapped, n, len(cols)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            model = converged_svm(mapped, n, c)
        finally:
            mapped.unpersist()
        return model.transform(linear_features(test, cols)).drop("features", "rawPrediction")
    value = gamma_of(linear.fit_moments(train, cols)[()], gamma)
    return predicted(kernels.fit(train, cols, label, key, [Machine(kernel, c, value)]), test)


def linear_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumn("features", array_to_vector(F.array(*[col(c).cast("double") for c in cols])))


def accuracy(scored: DataFrame, label: str) -> float:
    return scored.agg(F.avg((col(label) == F.col("prediction")).cast("int"))).first()[0]


def compare_kernels(
    train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, key: str, names: Sequence[str]
) -> DataFrame:
    """(kernel, accuracy), best first. The kernels that are solved in the dual are fitted together."""
    curved = [k for k in names if k != "linear"]
    value = gamma_of(linear.fit_moments(train, cols)[()], None)
    rows = [(k, float(accuracy(fit_kernel_svm(train, test, cols, label, key, k), label))) for k in names if k == "linear"]
    if curved:
        fits = kernels.fit(train, cols, label, key, [Machine(k, 1.0, value) for k in curved])
        rows += [(k, float(accuracy(predicted(fits, test, i), label))) for i, k in enumerate(curved)]
    return train.sparkSession.createDataFrame(rows, "kernel string, accuracy double").orderBy(F.desc("accuracy"), "kernel")


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 5) -> DataFrame:
    """Adds `fold`: rows are numbered by label, hash of the key and key, and dealt out in turn, so
    the numbers of a label in two folds differ by one at most."""
    keyed = df.withColumn("__hash", key_hash(col(key), digits=13))
    placed = ranks.positional_index(keyed, [label, "__hash", key], "__place")
    return placed.withColumn("fold", (F.col("__place") % folds).cast("int")).drop("__hash", "__place")


def fit_grid(
    train: DataFrame,
    cols: Sequence[str],
    label: str,
    key: str,
    cs: Sequence[float] = (0.1, 1.0, 10.0),
    gammas: Sequence[float | str] = ("scale", 0.1, 0.01),
    folds: int = 5,
) -> tuple[kernels.Fits, DataFrame]:
    """The Gaussian machines of all settings, one on all rows and one without each fold, and the table
    (c, gamma, accuracy, rank) of their mean accuracies on the folds left out, best first. All are
    fitted at once: rows are read once per round, and kernel values serve all penalties and folds."""
    moments = linear.fit_moments(train, cols)[()]
    settings = [(float(c), str(g), gamma_of(moments, g)) for g in gammas for c in cs]
    machines = [Machine("rbf", c, value, held) for c, _, value in settings for held in range(-1, folds)]
    fits = kernels.fit(stratified_folds(train, label, key, folds), cols, label, key, machines, "fold")
    scores = fits.held_out_accuracy().reshape(len(settings), folds + 1)[:, 1:].mean(axis=1)
    rows = [(c, g, float(a)) for (c, g, _), a in zip(settings, scores)]
    table = train.sparkSession.createDataFrame(rows, "c double, gamma string, accuracy double")
    best = Window.orderBy(F.desc("accuracy"), "c", "gamma")
    return fits, table.withColumn("rank", F.row_number().over(best))


def grid_search(train: DataFrame, cols: Sequence[str], label: str, key: str, **options) -> DataFrame:
    """(c, gamma, accuracy, rank), see `fit_grid`."""
    return fit_grid(train, cols, label, key, **options)[1]


def best_of_grid(
    train: DataFrame, test: DataFrame, cols: Sequence[str], label: str, key: str, **options
) -> DataFrame:
    """Search the grid on `train` and predict `test` by its best setting on all training rows."""
    fits, found = fit_grid(train, cols, label, key, **options)
    best = found.where("rank = 1").first()
    value = gamma_of(linear.fit_moments(train, cols)[()], best["gamma"])
    scored = predicted(fits, test, fits.machines.index(Machine("rbf", best["c"], value)))
    return scored.withColumns({"c": F.lit(best["c"]), "gamma": F.lit(best["gamma"])})
