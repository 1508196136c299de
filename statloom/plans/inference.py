"""Queries that estimate and test."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import infer
from statloom.plans.profiling import GAPS, MEASURES, rounded, with_nan
from statloom.plans.registry import query
from statloom.sources.tables import table

Z_995 = 2.5758293035489004
Z_95 = 1.6448536269514722

# Normal tail for the oracle: rational approximation 7.1.26 of Abramowitz and Stegun (error 1.5e-7).
ERFC = """
    exp(-x * x) * (0.254829592 * u - 0.284496736 * u**2 + 1.421413741 * u**3
                   - 1.453152027 * u**4 + 1.061405429 * u**5)
"""


@query(
    "ci_z",
    "H2 X15",
    f"""
    SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean,
           round(avg(value) - {Z_995} * 10 / sqrt(count(value)), 4) AS lower,
           round(avg(value) + {Z_995} * 10 / sqrt(count(value)), 4) AS upper
    FROM events GROUP BY 1
    """,
)
def ci_z(spark, root):
    interval = infer.z_interval(table(spark, root, "events"), "value", 10.0, ["event_type"], level=0.99)
    return rounded(interval, "mean", "lower", "upper")


@query(
    "ci_t",
    "H1 X16",
    f"""
    WITH s AS (SELECT event_type, count(value) AS n, avg(value) AS mean,
                      stddev_samp(value) / sqrt(count(value)) AS se, count(value) - 1 AS v,
                      {Z_995}::double AS z
               FROM events GROUP BY 1),
    t AS (SELECT *, z + (z**3 + z) / (4 * v) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * v**2)
                      + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * v**3) AS t FROM s)
    SELECT event_type, n, round(mean, 4) AS mean, round(se, 4) AS std_error, round(t, 4) AS t_crit,
           round(mean - t * se, 4) AS lower, round(mean + t * se, 4) AS upper
    FROM t
    """,
)
def ci_t(spark, root):
    interval = infer.t_interval(table(spark, root, "events"), "value", ["event_type"], level=0.99)
    return rounded(interval, "mean", "std_error", "t_crit", "lower", "upper")


@query(
    "z_test",
    "H3 H5 X15",
    f"""
    WITH s AS (SELECT event_type, count(value) AS n, avg(value) AS mean,
                      (avg(value) - 10) / (10 / sqrt(count(value))) AS z FROM events GROUP BY 1),
    t AS (SELECT *, abs(z) / sqrt(2) AS x, 1 / (1 + 0.3275911 * abs(z) / sqrt(2)) AS u FROM s)
    SELECT event_type, n, round(mean, 4) AS mean, round(z, 4) AS z,
           round(CASE WHEN z >= 0 THEN {ERFC} / 2 ELSE 1 - {ERFC} / 2 END, 3) AS p_value,
           CASE WHEN z >= {Z_95} THEN 'reject' ELSE 'fail to reject' END AS decision,
           CASE WHEN z >= {Z_95} THEN 'in critical region' ELSE 'not in critical region' END AS region
    FROM t
    """,
)
def z_test(spark, root):
    mu0, sigma = infer.cost_hypothesis(fixed=4.0, variable=2.0, units=3.0, sigma_units=5.0)
    tested = infer.z_test(table(spark, root, "events"), "value", mu0, sigma, ["event_type"])
    return rounded(tested, "mean", "z").withColumn("p_value", F.round("p_value", 3))


@query(
    "ztest_nan",
    "H1 H2 H3",
    f"""
    WITH s AS (SELECT l_returnflag, count(l_tax) AS n, avg(l_tax) AS mean, stddev_samp(l_tax) / sqrt(count(l_tax)) AS se FROM {GAPS} GROUP BY 1)
    SELECT l_returnflag, n, round(mean, 4) AS mean, round((mean - 0.04) / (0.02 / sqrt(n)), 3) AS z,
           CASE WHEN (mean - 0.04) / (0.02 / sqrt(n)) >= {Z_95} THEN 'reject' ELSE 'fail to reject' END AS decision,
           round(mean - {Z_995} * 0.02 / sqrt(n), 4) AS lower, round(se, 5) AS std_error FROM s
    """,
)
def ztest_nan(spark, root):
    lines = with_nan(spark, root)
    tested = infer.z_test(lines, "l_tax", 0.04, 0.02, ["l_returnflag"]).select("l_returnflag", "n", "mean", "z", "decision")
    bounds = infer.z_interval(lines, "l_tax", 0.02, ["l_returnflag"], level=0.99).select("l_returnflag", "lower")
    spread = infer.t_interval(lines, "l_tax", ["l_returnflag"]).select("l_returnflag", "std_error")
    joined = tested.join(bounds, "l_returnflag").join(spread, "l_returnflag")
    return joined.withColumns({"mean": F.round("mean", 4), "z": F.round("z", 3), "lower": F.round("lower", 4), "std_error": F.round("std_error", 5)})


def anova_sql(source: str, label: str, cols, p: str) -> str:
    parts = [
        f"""SELECT '{c}' AS "column", count(*) - 1 AS df_between, sum(n)::bigint - count(*) AS df_within,
            (sum(n * (m - g)**2) / (count(*) - 1)) / (sum(s) / (sum(n) - count(*))) AS f
            FROM (SELECT count({c}) AS n, avg({c}) AS m, var_pop({c}) * count({c}) AS s,
                         (SELECT avg({c}) FROM {source}) AS g FROM {source} GROUP BY {label})"""
        for c in cols
    ]
    return f"""
        SELECT "column", df_between, df_within, round(f, 4) AS f{p} FROM ({' UNION ALL '.join(parts)})
    """


@query(
    "anova_f",
    "H4 X17 F5",
    anova_sql(
        "lineitem", "l_returnflag", MEASURES, ", round((1 + 2 * f / df_within) ** (-df_within / 2), 4) AS p_value"
    ),
)
def anova_f(spark, root):
    """Three classes, so the oracle has the tail of F(2, v) in closed form."""
    result = infer.anova(table(spark, root, "lineitem"), "l_returnflag", MEASURES)
    return rounded(result, "f", "p_value")


@query("anova_events", "H4", anova_sql("events", "event_type", ["value", "user_id"], ""))
def anova_events(spark, root):
    result = infer.anova(table(spark, root, "events"), "event_type", ["value", "user_id"])
    return rounded(result, "f").drop("p_value")
