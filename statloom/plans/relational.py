"""Queries over joins, unions, de-duplication and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import clean, edit, relate
from statloom.plans.registry import query
from statloom.sources.tables import from_columns, from_rows, table


@query(
    "keyed_update",
    "J2 D4 S3 P8",
    """
    WITH fresh AS (
        SELECT s_suppkey,
               CASE WHEN s_acctbal < 0 THEN 0.0 END AS s_acctbal,
               CASE WHEN s_nationkey = 3 THEN 'renamed ' || s_name END AS s_name
        FROM supplier WHERE s_suppkey % 2 = 0
        UNION ALL SELECT -1, 5.0, 'nobody'
    )
    SELECT s.s_suppkey, coalesce(f.s_name, s.s_name) AS s_name, s.s_nationkey,
           coalesce(f.s_acctbal, s.s_acctbal) AS s_acctbal
    FROM supplier s LEFT JOIN fresh f ON s.s_suppkey = f.s_suppkey
    """,
)
def keyed_update(spark, root):
    supplier = table(spark, root, "supplier")
    fresh = supplier.where("s_suppkey % 2 = 0").select(
        "s_suppkey",
        F.when(F.col("s_acctbal") < 0, 0.0).alias("s_acctbal"),
        F.when(F.col("s_nationkey") == 3, F.concat(F.lit("renamed "), "s_name")).alias("s_name"),
    )
    unknown = from_columns(
        spark,
        {"s_suppkey": [-1], "s_acctbal": [5.0], "s_name": ["nobody"]},
        "s_suppkey bigint, s_acctbal double, s_name string",
    )
    return relate.keyed_update(supplier, fresh.unionByName(unknown), "s_suppkey")


@query(
    "left_join_nullable",
    "J1",
    """
    WITH regions AS (
        SELECT CASE WHEN r_regionkey > 0 THEN r_regionkey END AS region, r_name FROM region
    ), nations AS (
        SELECT n_nationkey, CASE WHEN n_regionkey > 0 THEN n_regionkey END AS region FROM nation
    )
    SELECT n.n_nationkey, n.region, r.r_name
    FROM nations n LEFT JOIN regions r ON n.region IS NOT DISTINCT FROM r.region
    """,
)
def left_join_nullable(spark, root):
    regions = table(spark, root, "region").select(
        F.when(F.col("r_regionkey") > 0, F.col("r_regionkey")).alias("region"), "r_name"
    )
    nations = table(spark, root, "nation").select(
        "n_nationkey", F.when(F.col("n_regionkey") > 0, F.col("n_regionkey")).alias("region")
    )
    joined = relate.left_join(nations, regions, "region", nullable=True)
    return joined.select("n_nationkey", "region", "r_name")


@query(
    "left_join_totals",
    "J1 G16",
    """
    SELECT c.c_custkey, c.c_mktsegment, t.n_orders, round(t.total, 2) AS total
    FROM customer c LEFT JOIN (
        SELECT o_custkey, count(*) AS n_orders, sum(o_totalprice) AS total FROM orders GROUP BY 1
    ) t ON c.c_custkey = t.o_custkey
    """,
)
def left_join_totals(spark, root):
    totals = (
        table(spark, root, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.count(F.lit(1)).alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    )
    customers = edit.select(table(spark, root, "customer"), ["c_custkey", "c_mktsegment"])
    return relate.left_join(customers, totals, "c_custkey")


@query(
    "union_by_name",
    "D3 P4",
    """
    SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
    UNION ALL
    SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier
    """,
)
def union_by_name(spark, root):
    customers = table(spark, root, "customer").transform(
        edit.rename,
        {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance", "c_mktsegment": "segment"},
    )
    suppliers = table(spark, root, "supplier").transform(
        edit.rename, {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"}
    )
    both = relate.union_by_name(edit.drop(customers, ["c_nationkey"]), edit.drop(suppliers, ["s_nationkey"]))
    return both.select("id", "name", "balance", "segment")


LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


@query(
    "dedupe_keep_first",
    "D2",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate, l_partkey, l_suppkey) AS rn
        FROM lineitem) WHERE rn = 1
    """,
)
def dedupe_keep_first(spark, root):
    lines = edit.select(
        table(spark, root, "lineitem"),
        ["l_orderkey", "l_linenumber", *LINE_ORDER, "l_quantity", "l_extendedprice"],
    )
    first = clean.keep_first(lines, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return edit.drop(first, ["l_shipdate", "no_such_column"])


@query("distinct_rows", "D1", "SELECT DISTINCT text, lang FROM documents")
def distinct_rows(spark, root):
    return clean.distinct_rows(edit.select(table(spark, root, "documents"), ["text", "lang"]))


@query(
    "pivot_counts",
    "D5",
    """
    SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS "F",
           count(*) FILTER (l_linestatus = 'O') AS "O"
    FROM lineitem GROUP BY 1
    """,
)
def pivot_counts(spark, root):
    counts = (
        table(spark, root, "lineitem")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return relate.pivot(counts, "l_returnflag", "l_linestatus", "n", fill=0)


@query(
    "melt_prices",
    "D6",
    """
    SELECT p_partkey, 'size' AS "column", p_size::double AS value FROM part
    UNION ALL SELECT p_partkey, 'price', p_retailprice FROM part
    """,
)
def melt_prices(spark, root):
    wide = table(spark, root, "part").select(
        "p_partkey", F.col("p_size").cast("double").alias("size"), F.col("p_retailprice").alias("price")
    )
    return relate.melt(wide, ["p_partkey"], ["size", "price"])


@query(
    "literal_rates",
    "S3 S4 P6",
    """
    SELECT c_custkey, round(c_acctbal * r.rate, 4) AS interest
    FROM customer JOIN (VALUES ('AUTOMOBILE', 0.01), ('BUILDING', 0.02), ('FURNITURE', 0.03),
                               ('HOUSEHOLD', 0.04), ('MACHINERY', 0.05)) r(segment, rate)
      ON c_mktsegment = r.segment
    """,
)
def literal_rates(spark, root):
    rates = from_rows(
        spark,
        [["AUTOMOBILE", 0.01], ["BUILDING", 0.02], ["FURNITURE", 0.03], ["HOUSEHOLD", 0.04], ["MACHINERY", 0.05]],
        "c_mktsegment string, rate double",
    )
    return (
        table(spark, root, "customer")
        .join(F.broadcast(rates), "c_mktsegment")
        .select("c_custkey", F.round(F.col("c_acctbal") * F.col("rate"), 4).alias("interest"))
    )
