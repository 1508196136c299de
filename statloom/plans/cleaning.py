"""Queries that clean and impute."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions.scalar import day_first_date
from statloom.operators import clean, edit
from statloom.plans.profiling import rounded, with_gaps, with_nan
from statloom.plans.registry import query
from statloom.sources.tables import read_csv, table, write_csv
from statloom.session import scratch_path

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate"
GAP_COLS = "nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax"


@query(
    "iqr_cap",
    "C10 X9 U2",
    """
    WITH b AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3,
                      quantile_cont(user_id, 0.25) AS u1, quantile_cont(user_id, 0.75) AS u3 FROM events)
    SELECT event_id,
           round(least(greatest(value, q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)), 4) AS value,
           round(least(greatest(user_id, u1 - 1.5 * (u3 - u1)), u3 + 1.5 * (u3 - u1)), 4) AS user_id
    FROM events, b
    """,
)
def iqr_cap(spark, root):
    events = table(spark, root, "events").select("event_id", "value", "user_id")
    return rounded(clean.cap_outliers(events, ["value", "user_id"]), "value", "user_id")


@query(
    "cap_nan",
    "C10 U2",
    f"""
    WITH g AS (SELECT {LINE_KEY}, {GAP_COLS} FROM lineitem),
    b AS (SELECT quantile_cont(l_discount, 0.25) AS q1, quantile_cont(l_discount, 0.75) AS q3 FROM g)
    SELECT {LINE_KEY}, CASE WHEN l_discount IS NOT NULL
           THEN round(least(greatest(l_discount, q1 - 0.2 * (q3 - q1)), q3 + 0.2 * (q3 - q1)), 4) END AS l_discount FROM g, b
    """,
)
def cap_nan(spark, root):
    lines = with_nan(spark, root).selectExpr(*LINE_KEY.split(", "), "l_discount")
    return rounded(clean.cap_outliers(lines, ["l_discount"], width=0.2), "l_discount")


@query(
    "mode_nan",
    "C5 G8 U3",
    f"""
    WITH g AS (SELECT {LINE_KEY}, {GAP_COLS} FROM lineitem)
    SELECT {LINE_KEY}, coalesce(l_discount, (SELECT l_discount FROM g WHERE l_discount IS NOT NULL
                                             GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS l_discount FROM g
    """,
)
def mode_nan(spark, root):
    lines = with_nan(spark, root).selectExpr(*LINE_KEY.split(", "), "l_discount")
    return clean.fill_mode(lines, ["l_discount"])


@query(
    "impute_mean",
    "C1 C3 J3",
    f"""
    WITH g AS (SELECT {LINE_KEY}, {GAP_COLS} FROM lineitem)
    SELECT {LINE_KEY}, round(coalesce(l_discount, (SELECT avg(l_discount) FROM g)), 4) AS l_discount,
           round(coalesce(l_tax, (SELECT avg(l_tax) FROM g)), 4) AS l_tax FROM g
    """,
)
def impute_mean(spark, root):
    lines = with_gaps(spark, root).selectExpr(*LINE_KEY.split(", "), "l_discount", "l_tax")
    return rounded(clean.fill_mean(lines, ["l_discount", "l_tax"]), "l_discount", "l_tax")


@query(
    "impute_median",
    "C4 C7 C8",
    f"""
    WITH g AS (SELECT {LINE_KEY}, {GAP_COLS} FROM lineitem)
    SELECT {LINE_KEY}, round(coalesce(l_discount, (SELECT quantile_cont(l_discount, 0.5) FROM g)), 4) AS l_discount,
           round(coalesce(l_tax, (SELECT quantile_cont(l_tax, 0.5) FROM g)), 4) AS l_tax FROM g
    """,
)
def impute_median(spark, root):
    lines = table(spark, root, "lineitem").selectExpr(*LINE_KEY.split(", "), "l_discount", "l_tax")
    filled = clean.fill_sentinel_median(lines, ["l_discount", "l_tax"], sentinel=0)
    return rounded(filled, "l_discount", "l_tax")


@query(
    "impute_median_train_only",
    "C8 M1",
    """
    WITH g AS (
        SELECT o_orderkey, nullif(o_totalprice, 0) AS price,
               nullif(o_custkey % 10, 0) AS bonus,
               ('0x' || substr(md5(o_orderkey::varchar), 1, 8))::bigint % 100 < 20 AS held_out
        FROM orders)
    SELECT o_orderkey, held_out, price,
           coalesce(bonus, (SELECT quantile_cont(bonus, 0.5) FROM g WHERE NOT held_out))::double AS bonus
    FROM g
    """,
)
def impute_median_train_only(spark, root):
    from statloom.operators.features import in_test

    orders = table(spark, root, "orders").select(
        "o_orderkey",
        in_test(F.col("o_orderkey"), 0.2).alias("held_out"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_custkey") % 10).alias("bonus"),
    )
    return clean.fill_sentinel_median(orders, ["price", "bonus"], 0, fit_on=orders.where("NOT held_out"))


@query(
    "impute_mode",
    "C5 G8 U3",
    """
    WITH g AS (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus,
                      nullif(o_orderpriority, '1-URGENT') AS o_orderpriority FROM orders)
    SELECT o_orderkey,
           coalesce(o_orderstatus, (SELECT o_orderstatus FROM g WHERE o_orderstatus IS NOT NULL
                                    GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderstatus,
           coalesce(o_orderpriority, (SELECT o_orderpriority FROM g WHERE o_orderpriority IS NOT NULL
                                      GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderpriority
    FROM g
    """,
)
def impute_mode(spark, root):
    orders = (
        table(spark, root, "orders")
        .select("o_orderkey", "o_orderstatus", "o_orderpriority")
        .transform(clean.sentinel_to_null, ["o_orderstatus"], "P")
        .transform(clean.sentinel_to_null, ["o_orderpriority"], "1-URGENT")
    )
    return clean.fill_mode(orders, ["o_orderstatus", "o_orderpriority"])


@query(
    "impute_rounded",
    "C2 X8 U7",
    """
    WITH g AS (SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS c_acctbal FROM customer)
    SELECT c_custkey, round(coalesce(c_acctbal, round((SELECT avg(c_acctbal) FROM g), 0)), 0) AS c_acctbal FROM g
    """,
)
def impute_rounded(spark, root):
    customers = table(spark, root, "customer").select(
        "c_custkey", F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("c_acctbal")
    )
    return clean.fill_rounded_mean(customers, "c_acctbal", places=0)


CHAIN_SOURCE = """
    SELECT nullif(l_quantity, 1) AS quantity,
           CASE WHEN l_discount > 0 THEN l_extendedprice - 20000 END AS margin,
           nullif(l_tax, 0.08) AS tax, nullif(l_linenumber, 7)::double AS line
    FROM lineitem
"""


@query(
    "clean_chain",
    "C12 F1 F4 P7 D1",
    f"""
    WITH a AS ({CHAIN_SOURCE}),
    b AS (SELECT coalesce(quantity, (SELECT avg(quantity) FROM a)) AS quantity,
                 coalesce(margin, (SELECT quantile_cont(margin, 0.5) FROM a)) AS margin,
                 coalesce(tax, (SELECT tax FROM a WHERE tax IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS tax,
                 coalesce(line, (SELECT line FROM a WHERE line IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS line
          FROM a),
    c AS (SELECT * FROM b WHERE line IN (1, 2, 3)),
    d AS (SELECT CASE WHEN quantity < 0 THEN (SELECT quantile_cont(quantity, 0.5) FROM c) ELSE quantity END AS quantity,
                 CASE WHEN margin < 0 THEN (SELECT quantile_cont(margin, 0.5) FROM c) ELSE margin END AS margin,
                 tax, line FROM c)
    SELECT DISTINCT round(quantity, 4) AS quantity, round(margin, 4) AS margin, tax, line::int AS line FROM d
    """,
)
def clean_chain(spark, root):
    source = table(spark, root, "lineitem").select(
        F.nullif("l_quantity", F.lit(1.0)).alias("quantity"),
        F.when(F.col("l_discount") > 0, F.col("l_extendedprice") - 20000).alias("margin"),
        F.nullif("l_tax", F.lit(0.08)).alias("tax"),
        F.nullif("l_linenumber", F.lit(7)).cast("double").alias("line"),
    )
    cleaned = clean.clean_measurements(source, ["quantity"], ["margin"], ["tax"], "line", [1, 2, 3])
    return rounded(cleaned, "quantity", "margin")


@query(
    "clean_strings",
    "C6 C9 X11 U4 P5",
    """
    SELECT p_partkey, nullif(p_brand, '?') AS p_brand, p_type FROM (
        SELECT p_partkey, trim(CASE WHEN p_size % 5 = 0 THEN ' ?' ELSE '  ' || p_brand || ' ' END) AS p_brand,
               trim(' ' || p_type || '  ') AS p_type FROM part)
    """,
)
def clean_strings(spark, root):
    padded = table(spark, root, "part").select(
        F.col("p_partkey").alias(" p_partkey"),
        F.when(F.col("p_size") % 5 == 0, " ?")
        .otherwise(F.concat(F.lit("  "), "p_brand", F.lit("\t ")))
        .alias("p_brand "),
        F.concat(F.lit(" "), "p_type", F.lit("  ")).alias(" p_type "),
    )
    return (
        padded.transform(edit.trim_names)
        .transform(clean.trim_strings)
        .transform(clean.sentinel_to_null, ["p_brand", "p_type"], "?")
    )


@query(
    "drop_missing",
    "F12",
    f"SELECT {LINE_KEY}, {GAP_COLS} FROM lineitem WHERE l_discount <> 0 AND l_tax <> 0",
)
def drop_missing(spark, root):
    lines = with_gaps(spark, root).selectExpr(*LINE_KEY.split(", "), "l_discount", "l_tax")
    return edit.drop_missing(lines, ["l_discount", "l_tax"])


@query(
    "conditional_overwrite",
    "F3",
    "SELECT p_partkey, CASE WHEN p_size > 40 THEN 16 ELSE p_size END AS p_size FROM part",
)
def conditional_overwrite(spark, root):
    part = table(spark, root, "part").select("p_partkey", "p_size")
    return edit.overwrite_where(part, F.col("p_size") > 40, "p_size", 16)


@query(
    "date_parse_dayfirst",
    "S2 X13",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate::date END AS order_date FROM orders
    """,
)
def date_parse_dayfirst(spark, root):
    text = F.when(F.col("o_orderkey") % 7 != 0, F.date_format("o_orderdate", "dd-MM-yyyy"))
    orders = table(spark, root, "orders").select("o_orderkey", F.coalesce(text, F.lit("31-02-2020")).alias("t"))
    return orders.select("o_orderkey", day_first_date(F.col("t")).alias("order_date"))


@query(
    "csv_round_trip",
    "S1 S2",
    """
    SELECT o_orderkey, ' ' || o_orderstatus AS status, o_orderdate::date AS order_date,
           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price FROM orders
    """,
)
def csv_round_trip(spark, root):
    """Write the orders as day-first CSV to the shared folder and read them back typed."""
    path = scratch_path(spark, "orders-csv")
    orders = table(spark, root, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), "o_orderstatus").alias("status"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price"),
    )
    write_csv(orders, path)
    return read_csv(spark, path, "o_orderkey bigint, status string, order_date date, price double")
