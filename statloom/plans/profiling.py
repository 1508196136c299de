"""Queries that profile tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import profile, ranks
from statloom.plans.registry import query
from statloom.sources.tables import SCHEMAS, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def each(template: str, cols) -> str:
    """One SELECT per column, joined by UNION ALL."""
    return "\nUNION ALL\n".join(template.replace("$c", c) for c in cols)


def rounded(df, *cols, places=4):
    return df.withColumns({c: F.round(c, places) for c in cols})


def with_gaps(spark, root):
    """Line items whose zero discounts and taxes count as missing."""
    return table(spark, root, "lineitem").withColumns(
        {"l_discount": F.nullif(F.col("l_discount"), F.lit(0.0)), "l_tax": F.nullif(F.col("l_tax"), F.lit(0.0))}
    )


GAPS = """(SELECT * REPLACE (nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax) FROM lineitem)"""
FIELDS = [field.strip().split(" ") for field in SCHEMAS["lineitem"].split(",")]


@query(
    "table_shape",
    "I1 G16",
    "SELECT count(*) AS n_rows, 11::bigint AS n_columns FROM lineitem",
)
def table_shape(spark, root):
    return profile.shape(table(spark, root, "lineitem"))


@query(
    "column_info",
    "I2 I3",
    "\nUNION ALL\n".join(
        f"SELECT {i}::bigint AS position, '{name}' AS \"column\", count({name}) AS non_null, "
        f"'{kind}' AS dtype FROM {GAPS}"
        for i, (name, kind) in enumerate(FIELDS)
    ),
)
def column_info(spark, root):
    return profile.info(with_gaps(spark, root))


@query(
    "null_counts",
    "I7 F12",
    each("SELECT '$c' AS \"column\", count(*) - count($c) AS nulls FROM " + GAPS, [f for f, _ in FIELDS]),
)
def null_counts(spark, root):
    return profile.null_counts(with_gaps(spark, root))


@query(
    "sentinel_counts",
    "I8",
    """
    SELECT 'o_orderstatus' AS "column", count(*) FILTER (o_orderstatus = 'P') AS hits FROM orders
    UNION ALL SELECT 'o_orderpriority', count(*) FILTER (o_orderpriority = 'P') FROM orders
    """,
)
def sentinel_counts(spark, root):
    return profile.sentinel_counts(table(spark, root, "orders"), "P")


DESCRIBE_SQL = """
SELECT '$c' AS "column", count($c) AS count, round(avg($c), 4) AS mean, round(stddev_samp($c), 4) AS std,
       min($c)::double AS min, round(quantile_cont($c, 0.25), 4) AS q1,
       round(quantile_cont($c, 0.5), 4) AS median, round(quantile_cont($c, 0.75), 4) AS q3,
       max($c)::double AS max FROM """ + GAPS


def with_nan(spark, root):
    """Lines whose zero discounts and taxes are NaN."""
    nan = F.lit(float("nan"))
    lines = table(spark, root, "lineitem")
    return lines.withColumns({c: F.when(F.col(c) == 0, nan).otherwise(F.col(c)) for c in ("l_discount", "l_tax")})


@query("describe_long", "I4 I5 D6 G11", each(DESCRIBE_SQL, MEASURES))
def describe_long(spark, root):
    return rounded(profile.describe(with_gaps(spark, root), MEASURES), "mean", "std", "q1", "median", "q3")


@query(
    "describe_wide",
    "I4 D6",
    """
    WITH long AS (
        SELECT 'o' AS src, count(o_totalprice)::double AS count, avg(o_totalprice) AS mean,
               stddev_samp(o_totalprice) AS std, min(o_totalprice) AS min,
               quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.5) AS median,
               quantile_cont(o_totalprice, 0.75) AS q3, max(o_totalprice) AS max,
               count(o_custkey)::double AS count2, avg(o_custkey) AS mean2,
               stddev_samp(o_custkey) AS std2, min(o_custkey)::double AS min2,
               quantile_cont(o_custkey, 0.25) AS q12, quantile_cont(o_custkey, 0.5) AS median2,
               quantile_cont(o_custkey, 0.75) AS q32, max(o_custkey)::double AS max2
        FROM orders)
    """
    + "\nUNION ALL\n".join(
        f"SELECT '{s}' AS stat, round({s}, 4) AS o_totalprice, round({s}2, 4) AS o_custkey FROM long"
        for s in ["count", "mean", "std", "min", "q1", "median", "q3", "max"]
    ),
)
def describe_wide(spark, root):
    return rounded(
        profile.describe_wide(table(spark, root, "orders"), ["o_totalprice", "o_custkey"]),
        "o_totalprice",
        "o_custkey",
    )


@query(
    "descriptive_stats",
    "G6 G7 G8 G9 G10 G12",
    each(
        """
        SELECT '$c' AS "column", round(avg($c), 4) AS mean, round(quantile_cont($c, 0.5), 4) AS median,
               (SELECT $c FROM lineitem GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS mode,
               round(stddev_samp($c), 4) AS std, round(skewness($c), 4) AS skew FROM lineitem
        """,
        MEASURES,
    ),
)
def descriptive_stats(spark, root):
    stats = profile.descriptive_stats(table(spark, root, "lineitem"), MEASURES)
    return rounded(stats, "mean", "median", "std", "skew")


@query(
    "skew_rank",
    "M10 G10 O3",
    "SELECT * FROM ("
    + each("SELECT '$c' AS \"column\", round(skewness($c), 4) AS skew FROM lineitem", MEASURES)
    + ") ORDER BY skew DESC",
)
def skew_rank(spark, root):
    return rounded(profile.skew_ranking(table(spark, root, "lineitem"), MEASURES), "skew")


@query(
    "group_sums",
    "G1",
    """
    SELECT CASE WHEN l_returnflag <> 'R' THEN l_returnflag END AS flag,
           coalesce(round(sum(CASE WHEN l_returnflag = 'A' THEN l_extendedprice END), 2), 0) AS revenue
    FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1
    """,
)
def group_sums(spark, root):
    lines = table(spark, root, "lineitem").select(
        F.when(F.col("l_returnflag") != "R", F.col("l_returnflag")).alias("flag"),
        F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")).alias("price"),
    )
    return rounded(profile.group_sum(lines, "flag", "price", "revenue"), "revenue", places=2)


@query(
    "group_means",
    "G2 G3 G4",
    """
    SELECT l_linestatus, round(avg(l_quantity), 4) AS l_quantity_mean,
           round(avg(l_extendedprice), 4) AS l_extendedprice_mean,
           round(avg(l_discount), 4) AS l_discount_mean, round(avg(l_tax), 4) AS l_tax_mean
    FROM lineitem GROUP BY 1
    """,
)
def group_means(spark, root):
    means = profile.group_means(table(spark, root, "lineitem"), "l_linestatus", MEASURES)
    return rounded(means, *[f"{c}_mean" for c in MEASURES])


@query(
    "group_means_all",
    "G3 I6",
    """
    SELECT s_nationkey, round(avg(s_suppkey), 4) AS s_suppkey_mean, round(avg(s_acctbal), 4) AS s_acctbal_mean
    FROM supplier GROUP BY 1
    """,
)
def group_means_all(spark, root):
    means = profile.group_means(table(spark, root, "supplier"), "s_nationkey")
    return rounded(means, "s_suppkey_mean", "s_acctbal_mean")


@query(
    "group_stats",
    "G5 G7",
    """
    SELECT event_type, 'value' AS "column", round(avg(value), 4) AS mean,
           round(quantile_cont(value, 0.5), 4) AS median FROM events GROUP BY 1
    UNION ALL
    SELECT event_type, 'user_id', round(avg(user_id), 4), round(quantile_cont(user_id, 0.5), 4)
    FROM events GROUP BY 1
    """,
)
def group_stats(spark, root):
    stats = profile.group_mean_median(table(spark, root, "events"), "event_type", ["value", "user_id"])
    return rounded(stats, "mean", "median")


@query(
    "value_counts",
    "G13 G14 O3",
    """
    SELECT o_orderpriority, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 4) AS share
    FROM orders GROUP BY 1
    """,
)
def value_counts(spark, root):
    return rounded(profile.value_counts(table(spark, root, "orders"), "o_orderpriority"), "share")


@query("distinct_values", "I10 O5", "SELECT DISTINCT p_brand FROM part ORDER BY 1")
def distinct_values(spark, root):
    return profile.distinct_values(table(spark, root, "part"), "p_brand")


@query(
    "cardinality",
    "I11 I12 I13",
    each(
        "SELECT '$c' AS \"column\", count(DISTINCT $c) AS n_distinct, "
        "CASE WHEN count(DISTINCT $c) < 8 THEN 'low' ELSE 'high' END AS band FROM part",
        ["p_name", "p_brand", "p_type"],
    ),
)
def cardinality(spark, root):
    part = table(spark, root, "part")
    names = profile.existing(part, ["p_name", "p_brand", "p_type", "p_missing"])
    return profile.cardinality(part, names, threshold=8)


@query("describe_nan", "I4 G11", each(DESCRIBE_SQL, ["l_discount", "l_tax"]))
def describe_nan(spark, root):
    """NaN is missing in every statistic."""
    found = profile.describe(with_nan(spark, root), ["l_discount", "l_tax"])
    return rounded(found, "mean", "std", "q1", "median", "q3")


@query(
    "group_means_nan",
    "G3",
    f"SELECT l_linestatus, round(avg(l_discount), 6) AS l_discount_mean, round(avg(l_tax), 6) AS l_tax_mean FROM {GAPS} GROUP BY 1",
)
def group_means_nan(spark, root):
    means = profile.group_means(with_nan(spark, root), "l_linestatus", ["l_discount", "l_tax"])
    return means.withColumns({c: F.round(c, 6) for c in ("l_discount_mean", "l_tax_mean")})


@query(
    "corr_nan",
    "G17",
    "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 4) AS r FROM {GAPS}"
        for x in ("l_discount", "l_tax")
        for y in ("l_discount", "l_tax")
        if x != y
    )
    + "\nUNION ALL SELECT 'l_discount', 'l_discount', 1.0::double UNION ALL SELECT 'l_tax', 'l_tax', 1.0::double",
)
def corr_nan(spark, root):
    return rounded(profile.correlations(with_nan(spark, root), ["l_discount", "l_tax"]), "r")


@query(
    "corr_long",
    "G17 V7",
    "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, round(corr({x}, {y}), 4) AS r FROM {GAPS}"
        for x in MEASURES
        for y in MEASURES
        if x != y
    )
    + "\nUNION ALL\n"
    + "\nUNION ALL\n".join(f"SELECT '{x}', '{x}', 1.0::double" for x in MEASURES),
)
def corr_long(spark, root):
    return rounded(profile.correlations(with_gaps(spark, root), MEASURES), "r")


TARGET = "(SELECT *, (l_returnflag = 'R')::int AS returned FROM lineitem)"
TARGET_COLS = [*MEASURES, "l_linenumber", "l_partkey"]
RANKED = each(f"SELECT '$c' AS \"column\", corr($c, returned) AS r FROM {TARGET}", TARGET_COLS)


def with_target(spark, root):
    return table(spark, root, "lineitem").withColumn(
        "returned", (F.col("l_returnflag") == "R").cast("int")
    )


@query(
    "corr_target_topk",
    "G18 O4 O6 X7 U6",
    f"SELECT \"column\", round(r, 4) AS r FROM ({RANKED}) ORDER BY abs(r) DESC, \"column\" LIMIT 3",
)
def corr_target_topk(spark, root):
    return rounded(profile.top_correlated(with_target(spark, root), "returned", TARGET_COLS, 3), "r")


@query(
    "corr_target_extremes",
    "G18 O1 O2 O3",
    f"""
    WITH ranked AS ({RANKED})
    (SELECT 'top' AS side, "column", round(r, 4) AS r FROM ranked ORDER BY r DESC, "column" LIMIT 2)
    UNION ALL
    (SELECT 'bottom', "column", round(r, 4) FROM ranked ORDER BY r, "column" DESC LIMIT 2)
    """,
)
def corr_target_extremes(spark, root):
    return rounded(
        profile.extreme_correlated(with_target(spark, root), "returned", TARGET_COLS, 2), "r"
    )


@query(
    "head_rows",
    "O1 P1",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5",
)
def head_rows(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return profile.head(orders, ["o_totalprice", "o_orderkey"], 5)


@query(
    "tail_rows",
    "O2",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 3",
)
def tail_rows(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return profile.tail(orders, ["o_totalprice", "o_orderkey"], 3)


@query(
    "positional_index",
    "P9",
    """
    SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS position
    FROM orders
    """,
)
def positional_index(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_totalprice")
    return ranks.positional_index(orders, ["o_totalprice", "o_orderkey"])


@query(
    "subset_class_share",
    "F2 G15",
    """
    WITH m AS (SELECT quantile_cont(l_quantity, 0.5) AS mq, quantile_cont(l_extendedprice, 0.5) AS mp
               FROM lineitem)
    SELECT 'high' AS subset, count(*) AS n, round(coalesce(avg((l_returnflag = 'R')::int), 0), 4) AS share
    FROM lineitem, m WHERE l_quantity > mq AND l_extendedprice > mp
    UNION ALL
    SELECT 'low', count(*), round(coalesce(avg((l_returnflag = 'R')::int), 0), 4)
    FROM lineitem, m WHERE l_quantity <= mq AND l_extendedprice <= mp
    """,
)
def subset_class_share(spark, root):
    lines = table(spark, root, "lineitem")
    shares = profile.subset_class_share(
        lines, "l_quantity", "l_extendedprice", F.col("l_returnflag") == "R"
    )
    return rounded(shares, "share")


@query(
    "outlier_counts",
    "I9 G11 J3",
    each(
        """
        SELECT '$c' AS "column", count(*) AS outliers FROM events,
          (SELECT quantile_cont($c, 0.25) AS q1, quantile_cont($c, 0.75) AS q3 FROM events)
        WHERE $c < q1 - 1.5 * (q3 - q1) OR $c > q3 + 1.5 * (q3 - q1)
        """,
        ["value", "user_id"],
    ),
)
def outlier_counts(spark, root):
    return profile.outlier_counts(table(spark, root, "events"), ["value", "user_id"])


@query(
    "outliers_nan",
    "I9",
    each(
        f"""
        SELECT '$c' AS "column", count(*) AS outliers FROM {GAPS},
          (SELECT quantile_cont($c, 0.25) AS q1, quantile_cont($c, 0.75) AS q3 FROM {GAPS})
        WHERE $c < q1 - 0.2 * (q3 - q1) OR $c > q3 + 0.2 * (q3 - q1)
        """,
        ["l_discount", "l_tax"],
    ),
)
def outliers_nan(spark, root):
    return profile.outlier_counts(with_nan(spark, root), ["l_discount", "l_tax"], width=0.2)


@query(
    "subset_share_nan",
    "F2 G15",
    f"""
    WITH g AS (SELECT * FROM {GAPS}),
    m AS (SELECT quantile_cont(l_discount, 0.5) AS d, quantile_cont(l_tax, 0.5) AS t FROM g),
    s AS (SELECT CASE WHEN l_discount > d AND l_tax > t THEN 'high' WHEN l_discount <= d AND l_tax <= t THEN 'low' END AS subset,
                 (l_returnflag = 'A')::int AS hit FROM g, m)
    SELECT subset, count(*) AS n, round(avg(hit), 4) AS share FROM s WHERE subset IS NOT NULL GROUP BY 1
    """,
)
def subset_share_nan(spark, root):
    found = profile.subset_class_share(with_nan(spark, root), "l_discount", "l_tax", F.col("l_returnflag") == "A")
    return rounded(found, "share")


@query(
    "offset_quantiles",
    "G11 G7",
    """
    WITH v AS (SELECT event_type, 1e6::double + value / 1e3 AS x FROM events)
    SELECT event_type, round(quantile_cont(x, 0.01), 6) AS p1, round(quantile_cont(x, 0.5), 6) AS median,
           round(quantile_cont(x, 0.99), 6) AS p99 FROM v GROUP BY 1
    """,
)
def offset_quantiles(spark, root):
    """Values that differ in their last digits only."""
    shifted = table(spark, root, "events").select("event_type", (F.lit(1e6) + F.col("value") / 1e3).alias("x"))
    found = ranks.quantiles(shifted, ["x"], {"p1": 0.01, "median": 0.5, "p99": 0.99}, ["event_type"])
    return rounded(found.drop("column"), "p1", "median", "p99", places=6)


@query(
    "verify_derived",
    "I14 P6",
    """
    SELECT count(*) AS n_rows,
           count(*) FILTER (abs(l_extendedprice - (l_quantity * p_retailprice)) > 0.005
                            OR p_retailprice IS NULL) AS mismatches
    FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
    """,
)
def verify_derived(spark, root):
    lines = table(spark, root, "lineitem").join(
        table(spark, root, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"),
        "l_partkey",
        "left",
    )
    return profile.derived_mismatches(
        lines, "l_extendedprice", F.col("l_quantity") * F.col("p_retailprice"), 0.005
    )
