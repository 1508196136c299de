"""Imputation, capping, string repair and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statloom.functions.scalar import clip
from statloom.operators import edit, profile, ranks
from statloom.operators.ranks import col
from statloom.session import materialise


def present(c: Column) -> Column:
    """The value, with NaN turned into null."""
    return F.when(~F.isnan(c), c)


def mean_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(present(col(c).cast("double"))).alias(c) for c in cols])


def median_row(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    row = ranks.quantile_row(df, cols, {"median": 0.5})
    return row.select(*[col(c)["median"].alias(c) for c in cols])


def fill_with(df: DataFrame, one_row: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill missing numbers of each column from a one-row table."""
    return (
        ranks.attach(df, one_row, "__fill")
        .withColumns(
            {c: F.coalesce(present(col(c).cast("double")), F.col("__fill")[c]) for c in cols}
        )
        .drop("__fill")
    )


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Most frequent value (smallest on ties) of columns of any type, as scalar subqueries."""
    values = {}
    for c in cols:
        counts = df.select(ranks.observed(df, c).alias(c)).where(col(c).isNotNull()).groupBy(col(c)).agg(F.count(F.lit(1)).alias("__n"))
        best = counts.agg(F.min_by(col(c), F.struct(-F.col("__n"), col(c))).alias(c))
        values[c] = best.scalar()
    return values


def fill_mean(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill with the column means of `fit_on`, or of the table itself."""
    return fill_with(df, mean_row(df if fit_on is None else fit_on, cols), cols)


def fill_median(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Fill with exact medians of `fit_on`, or of the table itself."""
    return fill_with(df, median_row(df if fit_on is None else fit_on, cols), cols)


def fill_mode(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | None = None) -> DataFrame:
    mode = mode_values(df if fit_on is None else fit_on, cols)
    return df.withColumns({c: F.coalesce(ranks.observed(df, c), mode[c]) for c in cols})


def fill_rounded_mean(df: DataFrame, name: str, places: int = 1) -> DataFrame:
    """Fill with the rounded mean and round every value of the column."""
    rounded_mean = mean_row(df, [name]).select(F.round(col(name), places).alias(name))
    return fill_with(df, rounded_mean, [name]).withColumn(name, F.round(col(name), places))


def sentinel_to_null(df: DataFrame, cols: Sequence[str], sentinel) -> DataFrame:
    """Whole-cell sentinel to null, for strings or numbers."""
    return df.withColumns({c: F.nullif(col(c), F.lit(sentinel)) for c in cols})


def fill_sentinel_median(
    df: DataFrame, cols: Sequence[str], sentinel: float = 0.0, fit_on: DataFrame | None = None
) -> DataFrame:
    """Sentinel to null, then the median of the remaining values. Give the training rows as
    `fit_on` to keep held-out rows out of the statistic."""
    numbers = {c: col(c).cast("double") for c in cols}
    cleaned = df.withColumns(numbers).transform(sentinel_to_null, cols, float(sentinel))
    basis = None
    if fit_on is not None:
        basis = fit_on.withColumns(numbers).transform(sentinel_to_null, cols, float(sentinel))
    return fill_median(cleaned, cols, basis)


def trim_strings(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Strip all leading and trailing white space of the string columns."""
    names = list(cols) if cols is not None else profile.columns_by_type(df, "string")
    return df.withColumns({c: F.regexp_replace(col(c), r"^\s+|\s+$", "") for c in names})


def cap_outliers(df: DataFrame, cols: Sequence[str], width: float = 1.5) -> DataFrame:
    """Limit values to the quartiles -/+ width * IQR; nulls stay null, and NaN becomes null."""
    limits = F.col("__limits")
    return (
        profile.with_outlier_bounds(df, cols, width)
        .withColumns(
            {c: clip(ranks.observed(df, c).cast("double"), limits[c]["lower"], limits[c]["upper"]) for c in cols}
        )
        .drop("__limits")
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def keep_first(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order. The aggregate keeps one candidate per key
    and task before the shuffle, so a dominating key does not travel."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = F.min_by(F.struct(*[col(c) for c in rest]), F.struct(*[col(c) for c in order_by]))
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(first.alias("__row"))
        .select(*[F.col("__row").getField(c).alias(c) if c in rest else col(c) for c in df.columns])
    )


def clean_measurements(
    df: DataFrame,
    mean_cols: Sequence[str],
    median_cols: Sequence[str],
    mode_cols: Sequence[str],
    label: str,
    classes: Sequence[int],
) -> DataFrame:
    """Cleaning chain in its fixed order: mean, median and mode fills, class membership, negatives
    to the median of the rows kept so far, distinct rows, integer label. The three fills touch
    different columns, so all of them are fitted on the raw table and computed once. The rows that are
    kept are written before the medians of the second half, which depend on them."""
    measures, classed = [*mean_cols, *median_cols], [*mode_cols, label]
    modes = df.sparkSession.range(1).select(*[v.alias(c) for c, v in mode_values(df, classed).items()])
    mode = F.col("__mode")
    filled = (
        df.transform(fill_with, ranks.fixed(mean_row(df, mean_cols)), mean_cols)
        .transform(fill_with, ranks.fixed(median_row(df, median_cols)), median_cols)
        .transform(ranks.attach, ranks.fixed(modes), "__mode")
        .withColumns({c: F.coalesce(ranks.observed(df, c), mode[c]) for c in classed})
        .drop("__mode")
        .transform(edit.keep_members, label, classes)
    )
    return (
        materialise(filled, "filled")
        .transform(edit.negatives_to_median, measures, now=True)
        .transform(distinct_rows)
        .transform(edit.cast, {label: "int"})
    )
