"""Schema, quality and distribution profiles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statloom.operators import ranks
from statloom.operators.ranks import col

Stat = Callable[[Column], Column]
QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}
WIDE = 24


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Names of the "numeric" columns, or of the "other" ones."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if kind == "numeric":
        return numeric
    if kind == "string":
        return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if kind == "other":
        return [c for c in df.columns if c not in numeric]
    raise ValueError(f"unknown kind of column: {kind}")


def existing(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """The given names that the table has, in the given order."""
    return [c for c in cols if c in df.columns]


def column_sums(df: DataFrame, cols: Sequence[str], stats: Mapping[str, Stat]) -> list[Column]:
    return [fn(ranks.observed(df, c)).alias(f"{c}__{s}") for c in cols for s, fn in stats.items()]


def per_column(
    df: DataFrame,
    cols: Sequence[str],
    stats: Mapping[str, Stat],
    by: Sequence[str] = (),
    sums: DataFrame | None = None,
) -> DataFrame:
    """Statistics of many columns from a single aggregation: (by..., column, stat...). `sums` may hold
    the `column_sums` already."""
    if sums is None:
        source = df
        for b in by:
            source = source.where(col(b).isNotNull())
        sums = source.groupBy(*[col(b) for b in by]).agg(*column_sums(df, cols, stats))
    rows = [
        F.struct(F.lit(c).alias("column"), *[col(f"{c}__{s}").alias(s) for s in stats]) for c in cols
    ]
    return sums.select(*[col(b) for b in by], F.inline(F.array(*rows)))


def is_missing(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    c = col(name)
    return (c.isNull() | F.isnan(c)) if isinstance(kind, (T.DoubleType, T.FloatType)) else c.isNull()


def adjusted_skew(c: Column) -> Column:
    """Bias-adjusted sample skewness, null below three values or without spread."""
    n = F.count(c)
    return F.when(
        (n > 2) & (F.stddev_pop(c) > 0), F.skewness(c) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0))
    )


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(df.columns)).cast("bigint")
    )


def info(df: DataFrame) -> DataFrame:
    """(position, column, non_null, dtype) from one pass."""
    fields = {
        name: (i, dtype, F.count(F.when(~is_missing(df, name), F.lit(1))))
        for i, (name, dtype) in enumerate(df.dtypes)
    }
    wide = df.agg(*[expr.alias(f"__{i}") for i, _, expr in fields.values()])
    rows = [
        F.struct(
            F.lit(i).cast("bigint").alias("position"),
            F.lit(name).alias("column"),
            F.col(f"__{i}").alias("non_null"),
            F.lit(dtype).alias("dtype"),
        )
        for name, (i, dtype, _) in fields.items()
    ]
    return wide.select(F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls): null and NaN both count as missing."""
    wide = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in df.columns])
    rows = [F.struct(F.lit(c).alias("column"), col(c).alias("nulls")) for c in df.columns]
    return wide.select(F.inline(F.array(*rows)))


def sentinel_counts(df: DataFrame, sentinel: str, cols: Sequence[str] | None = None) -> DataFrame:
    """(column, hits): cells equal to the sentinel, blanks included."""
    names = list(cols) if cols is not None else columns_by_type(df, "string")
    return per_column(df, names, {"hits": lambda c: F.count_if(c == sentinel)})


MOMENTS = {
    "count": F.count,
    "mean": F.avg,
    "std": F.stddev_samp,
    "min": lambda c: F.min(c).cast("double"),
    "max": lambda c: F.max(c).cast("double"),
}


def moments(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), sums: DataFrame | None = None
) -> DataFrame:
    return per_column(df, cols, MOMENTS, by, sums)


def describe(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    quartiles: DataFrame | None = None,
    sums: DataFrame | None = None,
) -> DataFrame:
    """(column, count, mean, std, min, q1, median, q3, max) with exact quartiles. A caller may have the
    quartiles, and the other statistics as `shared_sums`."""
    names = list(cols) if cols is not None else columns_by_type(df, "numeric")
    return (
        moments(df, names, sums=sums)
        .join(ranks.quantiles(df, names, QUARTILES) if quartiles is None else quartiles, "column", "left")
        .select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")
    )


def describe_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """`describe` turned: one row per statistic, one column per described column."""
    stats = ["count", "mean", "std", "min", "q1", "median", "q3", "max"]
    one_row = ranks.as_row(
        describe(df, cols).withColumn("count", F.col("count").cast("double")), cols, stats
    )
    rows = [F.struct(F.lit(s).alias("stat"), *[col(c)[s].alias(c) for c in cols]) for s in stats]
    return one_row.select(F.inline(F.array(*rows)))


def descriptive_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, mean, median, mode, std, skew)."""
    base = per_column(df, cols, {"mean": F.avg, "std": F.stddev_samp, "skew": adjusted_skew})
    freq = ranks.frequencies(df, cols)
    ordered = ranks.quantiles(df, cols, {"median": 0.5})
    return (
        base.join(ordered, "column", "left")
        .join(ranks.frequency_modes(freq, ["column"]), "column", "left")
        .select("column", "mean", "median", "mode", "std", "skew")
    )


def skew_ranking(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return per_column(df, cols, {"skew": adjusted_skew}).orderBy(
        F.col("skew").desc_nulls_last(), "column"
    )


def group_means(df: DataFrame, by: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column, or of the given ones, per group."""
    names = list(cols) if cols is not None else [c for c in columns_by_type(df, "numeric") if c != by]
    return (
        df.where(col(by).isNotNull())
        .groupBy(col(by))
        .agg(*[F.avg(ranks.observed(df, c)).alias(f"{c}_mean") for c in names])
    )


def group_sum(df: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Sum per group: null keys are dropped and a group without values sums to zero."""
    return (
        df.where(col(by).isNotNull())
        .groupBy(col(by))
        .agg(F.coalesce(F.sum(ranks.observed(df, value)), F.lit(0.0)).alias(name))
    )


def group_moments(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """(by, column, rows, n, mean, spread): rows of the group, values among them, and their squared
    deviations summed. Serves `group_mean_median`, `value_counts` and `infer.anova`."""
    return per_column(
        df,
        cols,
        {
            "rows": lambda c: F.count(F.lit(1)),
            "n": F.count,
            "mean": F.avg,
            "spread": lambda c: F.var_pop(c) * F.count(c),
        },
        [by],
    )


def group_mean_median(
    df: DataFrame, by: str, cols: Sequence[str], few_groups: bool = False, groups: DataFrame | None = None
) -> DataFrame:
    """(by, column, mean, median). A caller may have `group_moments`, and may have bounded the groups."""
    means = per_column(df, cols, {"mean": F.avg}, [by]) if groups is None else groups.select(col(by), "column", "mean")
    return means.join(
        ranks.quantiles(df, cols, {"median": 0.5}, [by], few_groups), [by, "column"], "left"
    )


def value_counts(df: DataFrame, name: str, counts: DataFrame | None = None) -> DataFrame:
    """(name, n, share) of the non-null values, most frequent first. A caller may have (name, n)."""
    if counts is None:
        counts = df.where(col(name).isNotNull()).groupBy(col(name)).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n") / total).orderBy(F.desc("n"), col(name))


def distinct_values(df: DataFrame, name: str) -> DataFrame:
    return df.select(col(name)).distinct().orderBy(col(name))


def cardinality(df: DataFrame, cols: Sequence[str], threshold: int = 5) -> DataFrame:
    """(column, n_distinct, band): columns below the threshold are "low", the rest "high"."""
    typed = df.select(*[col(c).cast("string").alias(c) for c in cols])
    long = typed.unpivot([], [col(c) for c in cols], "column", "value").where("value IS NOT NULL")
    counts = (
        long.groupBy("column", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("n_distinct"))
    )
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column")) for c in cols]))
    names = df.sparkSession.range(1).select(rows)
    return names.join(counts, "column", "left").select(
        "column",
        F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        F.when(F.coalesce("n_distinct", F.lit(0)) < threshold, "low").otherwise("high").alias("band"),
    )


def outlier_bounds(
    df: DataFrame, cols: Sequence[str], width: float = 1.5, quartiles: DataFrame | None = None
) -> DataFrame:
    """(column, q1, q3, lower, upper)."""
    q = ranks.quantiles(df, cols, {"q1": 0.25, "q3": 0.75}) if quartiles is None else quartiles
    reach = F.lit(width) * (F.col("q3") - F.col("q1"))
    return q.select(
        "column", "q1", "q3", (F.col("q1") - reach).alias("lower"), (F.col("q3") + reach).alias("upper")
    )


def with_outlier_bounds(
    df: DataFrame, cols: Sequence[str], width: float = 1.5, quartiles: DataFrame | None = None
) -> DataFrame:
    row = ranks.as_row(outlier_bounds(df, cols, width, quartiles), cols, ["lower", "upper"])
    return ranks.attach(df, row, "__limits")


def outlier_sums(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """To be taken of `with_outlier_bounds`."""
    limits = F.col("__limits")
    return [
        F.count_if((ranks.observed(df, c) < limits[c]["lower"]) | (ranks.observed(df, c) > limits[c]["upper"])).alias(f"{c}__outliers")
        for c in cols
    ]


def outlier_counts(
    df: DataFrame, cols: Sequence[str], width: float = 1.5, sums: DataFrame | None = None
) -> DataFrame:
    """(column, outliers): values strictly outside the quartiles -/+ width * IQR."""
    wide = with_outlier_bounds(df, cols, width).agg(*outlier_sums(df, cols)) if sums is None else sums
    rows = [F.struct(F.lit(c).alias("column"), col(f"{c}__outliers").alias("outliers")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def numbers(df: DataFrame, names: Sequence[str]) -> list[Column]:
    return [ranks.observed(df, c).cast("double").alias(f"__{i}") for i, c in enumerate(names)]


def correlation_sums(size: int) -> list[Column]:
    """To be taken of `numbers`."""
    return [
        *[F.corr(f"__{i}", f"__{j}").alias(f"r_{i}_{j}") for i, j in combinations(range(size), 2)],
        *[F.when(F.stddev_pop(f"__{i}") > 0, 1.0).alias(f"r_{i}_{i}") for i in range(size)],
    ]


def correlations(df: DataFrame, cols: Sequence[str], sums: DataFrame | None = None) -> DataFrame:
    """(x, y, r): Pearson, pairwise complete, symmetric, diagonal one. One scan; each unordered
    pair is computed once."""
    names = list(cols)
    if len(names) > WIDE:
        return wide_correlations(df, names)
    r = df.select(*numbers(df, names)).agg(*correlation_sums(len(names))) if sums is None else sums
    rows = [
        F.struct(
            F.lit(names[i]).alias("x"),
            F.lit(names[j]).alias("y"),
            F.col(f"r_{min(i, j)}_{max(i, j)}").alias("r"),
        )
        for i in range(len(names))
        for j in range(len(names))
    ]
    return r.select(F.inline(F.array(*rows)))


def wide_correlations(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """`correlations` of many columns: each task sums centred products and counts of all pairs in
    matrices of a size that the column list fixes."""
    size = len(names)
    values = [F.coalesce(ranks.observed(df, c).cast("double"), F.lit(float("nan"))) for c in names]
    means = df.agg(*[F.coalesce(F.avg(ranks.observed(df, c)), F.lit(0.0)).alias(f"m{i}") for i, c in enumerate(names)]).first()
    centre = np.array([float(v) for v in means])

    def sums(batches):
        total = np.zeros((4, size, size))
        for batch in batches:
            x = np.array(batch["x"].tolist(), dtype=float).reshape(-1, size) - centre
            held = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            # Of each pair the rows that have both: their number, sums of x, of x squared and of products.
            total += np.stack([held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x])
        i, j = np.divmod(np.arange(size * size), size)
        parts = {name: total[k].ravel() for k, name in enumerate(("n", "s", "ss", "xy"))}
        yield pd.DataFrame({"i": i, "j": j} | parts)

    blocks = df.select(F.array(*values).alias("x")).mapInPandas(sums, "i int, j int, n double, s double, ss double, xy double")
    one = blocks.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss", "xy")])
    other = one.select(F.col("i").alias("j"), F.col("j").alias("i"), F.col("s").alias("t"), F.col("ss").alias("tt"))
    both = one.join(other, ["i", "j"])
    spread = (F.col("ss") - F.col("s") * F.col("s") / F.col("n")) * (F.col("tt") - F.col("t") * F.col("t") / F.col("n"))
    r = F.when((F.col("n") > 1) & (spread > 0), (F.col("xy") - F.col("s") * F.col("t") / F.col("n")) / F.sqrt(spread))
    named = F.array(*[F.lit(c) for c in names])
    own = F.when(F.col("i") == F.col("j"), F.when(spread > 0, 1.0)).otherwise(r)
    return both.select(F.element_at(named, F.col("i") + 1).alias("x"), F.element_at(named, F.col("j") + 1).alias("y"), own.alias("r"))


def with_target(df: DataFrame, target: str) -> dict[str, Stat]:
    y = ranks.observed(df, target).cast("double")
    return {"r": lambda c: F.corr(c.cast("double"), y)}


def target_correlations(
    df: DataFrame, target: str, cols: Sequence[str], sums: DataFrame | None = None
) -> DataFrame:
    """(column, r) of each column with the target."""
    return per_column(df, [c for c in cols if c != target], with_target(df, target), sums=sums)


def top_correlated(
    df: DataFrame, target: str, cols: Sequence[str], k: int, sums: DataFrame | None = None
) -> DataFrame:
    """The k columns with the largest absolute correlation."""
    return (
        target_correlations(df, target, cols, sums)
        .orderBy(F.abs("r").desc_nulls_last(), "column")
        .limit(k)
    )


def extreme_correlated(df: DataFrame, target: str, cols: Sequence[str], k: int) -> DataFrame:
    """Head and tail of the signed ranking: (side, column, r), best first on both sides."""
    ranked = target_correlations(df, target, cols).where("r IS NOT NULL")
    head = ranked.orderBy(F.desc("r"), "column").limit(k).withColumn("side", F.lit("top"))
    tail = ranked.orderBy("r", F.desc("column")).limit(k).withColumn("side", F.lit("bottom"))
    return head.unionByName(tail).select("side", "column", "r")


def with_sides(df: DataFrame, a: str, b: str, med: DataFrame) -> DataFrame:
    ma, mb = F.col("__med")[a]["median"], F.col("__med")[b]["median"]
    va, vb = ranks.observed(df, a), ranks.observed(df, b)
    side = F.when((va > ma) & (vb > mb), "high").when((va <= ma) & (vb <= mb), "low")
    return ranks.attach(df, med, "__med").withColumn("__side", side)


def subset_sums(label: Column) -> list[Column]:
    """To be taken of `with_sides`."""
    hit = F.when(label, 1.0).otherwise(0.0)
    return [
        stat.alias(f"{s}_{n}")
        for s in ("high", "low")
        for n, stat in (
            ("n", F.count_if(F.col("__side") == s)),
            ("share", F.coalesce(F.avg(F.when(F.col("__side") == s, hit)), F.lit(0.0))),
        )
    ]


def subset_class_share(
    df: DataFrame, a: str, b: str, label: Column, name: str = "share", sums: DataFrame | None = None
) -> DataFrame:
    """Rows with both columns above their medians, and with both at or below: size of the subset
    and share of the rows where `label` holds."""
    if sums is None:
        sums = with_sides(df, a, b, ranks.quantile_row(df, [a, b], {"median": 0.5})).agg(*subset_sums(label))
    rows = [
        F.struct(F.lit(s).alias("subset"), F.col(f"{s}_n").alias("n"), F.col(f"{s}_share").alias(name))
        for s in ("high", "low")
    ]
    return sums.select(F.inline(F.array(*rows)))


def shared_sums(
    df: DataFrame, cols: Sequence[str], target: str, label: Column, quartiles: DataFrame
) -> DataFrame:
    """One row from one scan, to be written before it is read: with what `describe`, `outlier_counts`,
    `correlations`, `target_correlations` and `subset_class_share` (of the first two columns) would each
    take a scan for."""
    limited = with_outlier_bounds(df, cols, quartiles=quartiles)
    sided = with_sides(limited, cols[0], cols[1], ranks.as_row(quartiles, cols, ["median"]))
    return sided.select("*", *numbers(df, cols)).agg(
        *column_sums(df, cols, MOMENTS | with_target(df, target)),
        *outlier_sums(df, cols),
        *correlation_sums(len(cols)),
        *subset_sums(label),
    )


def derived_mismatches(df: DataFrame, stored: str, expected: Column, tolerance: float) -> DataFrame:
    """Audit of a stored column against its expression: (n_rows, mismatches)."""
    same = (F.abs(col(stored) - expected) <= tolerance) | (col(stored).isNull() & expected.isNull())
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.coalesce(same, F.lit(False))).alias("mismatches"),
    )


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[col(c) for c in order_by]).limit(n)


def tail(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """Last n rows of the given order, returned in that order."""
    return (
        df.orderBy(*[col(c).desc() for c in order_by]).limit(n).orderBy(*[col(c) for c in order_by])
    )
