"""Confidence intervals, tests and analysis of variance. Raw rows are reduced to one row per group
first; only that small table reaches the distribution functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.functions.distributions import (
    f_survival_column,
    normal_survival_column,
    t_quantile_column,
)
from statloom.functions.scalar import normal_quantile
from statloom.operators.profile import group_moments
from statloom.operators.ranks import col, observed

REJECT, KEEP = "reject", "fail to reject"


def t_interval(df: DataFrame, value: str, by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """(by..., n, mean, std_error, t_crit, lower, upper) with sample deviation; the bounds are null
    for fewer than two values."""
    x = observed(df, value)
    stats = df.groupBy(*[col(b) for b in by]).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        (F.stddev_samp(x) / F.sqrt(F.nullif(F.count(x), F.lit(0)))).alias("std_error"),
    )
    p = F.lit(1 - (1 - level) / 2)
    bound = stats.withColumn("t_crit", t_quantile_column(p, (F.col("n") - 1).cast("double")))
    reach = F.col("t_crit") * F.col("std_error")
    return bound.withColumns({"lower": F.col("mean") - reach, "upper": F.col("mean") + reach})


def z_interval(
    df: DataFrame, value: str, sigma: float, by: Sequence[str] = (), level: float = 0.95
) -> DataFrame:
    """(by..., n, mean, lower, upper) for a known deviation."""
    z = normal_quantile(1 - (1 - level) / 2)
    stats = df.groupBy(*[col(b) for b in by]).agg(
        F.count(observed(df, value)).alias("n"), F.avg(observed(df, value)).alias("mean")
    )
    reach = F.lit(z * sigma) / F.sqrt(F.nullif(F.col("n"), F.lit(0)))
    return stats.withColumns({"lower": F.col("mean") - reach, "upper": F.col("mean") + reach})


def z_test(
    df: DataFrame, value: str, mu0: float, sigma: float, by: Sequence[str] = (), alpha: float = 0.05
) -> DataFrame:
    """Upper-tailed z-test per group: (by..., n, mean, z, p_value, decision, region). The boundary
    belongs to the critical region."""
    crit = normal_quantile(1 - alpha)
    stats = df.groupBy(*[col(b) for b in by]).agg(
        F.count(observed(df, value)).alias("n"), F.avg(observed(df, value)).alias("mean")
    )
    tested = stats.withColumn("z", (F.col("mean") - mu0) / (F.lit(sigma) / F.sqrt(F.nullif(F.col("n"), F.lit(0)))))
    inside = F.col("z") >= F.lit(crit)
    return tested.withColumns(
        {
            "p_value": normal_survival_column(F.col("z")),
            "decision": F.when(inside, REJECT).otherwise(KEEP),
            "region": F.when(inside, "in critical region").otherwise("not in critical region"),
        }
    )


def cost_hypothesis(fixed: float, variable: float, units: float, sigma_units: float) -> tuple[float, float]:
    """Mean and deviation of a linear cost model."""
    return fixed + variable * units, variable * sigma_units


def anova(df: DataFrame, label: str, cols: Sequence[str], groups: DataFrame | None = None) -> DataFrame:
    """One-way analysis of variance of many variables in one pass over the data:
    (column, df_between, df_within, f, p_value). F is null where the within-group variance is zero
    or the freedom is exhausted. A caller may have the `group_moments` of these variables."""
    if groups is None:
        groups = group_moments(df, label, [c for c in cols if c != label])
    groups = groups.where("n > 0")
    k = F.count(F.lit(1))
    n = F.sum("n")
    # Between-group sum of squares around the pooled mean, from group sizes and means.
    grand = F.sum(F.col("n") * F.col("mean")) / n
    table = groups.groupBy("column").agg(
        (k - 1).alias("df_between"),
        (n - k).alias("df_within"),
        grand.alias("grand"),
        F.sum("spread").alias("ss_within"),
    )
    between = (
        groups.join(table.select("column", "grand"), "column")
        .groupBy("column")
        .agg(F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2).alias("ss_between"))
    )
    mean_sq_within = F.col("ss_within") / F.nullif(F.col("df_within"), F.lit(0))
    mean_sq_between = F.col("ss_between") / F.nullif(F.col("df_between"), F.lit(0))
    return (
        table.join(between, "column")
        .withColumn("f", F.when(mean_sq_within > 0, mean_sq_between / F.nullif(mean_sq_within, F.lit(0.0))))
        .withColumn(
            "p_value",
            f_survival_column(
                F.col("f"), F.col("df_between").cast("double"), F.col("df_within").cast("double")
            ),
        )
        .select("column", "df_between", "df_within", "f", "p_value")
    )
