"""Queries over scalar, array and map expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.functions import arrays, scalar
from statloom.plans.registry import query
from statloom.sources.tables import integer_range, keyed_random_int, table


@query(
    "case_bands",
    "F7 F9",
    """
    SELECT p_partkey, CASE WHEN p_size * 2 >= 90 THEN 'A' WHEN p_size * 2 >= 75 THEN 'B'
                           WHEN p_size * 2 >= 50 THEN 'C' ELSE 'Fail' END AS grade,
           CASE WHEN p_size >= 18 THEN 'eligible' ELSE 'not eligible' END AS vote FROM part
    """,
)
def case_bands(spark, root):
    size = F.col("p_size")
    return table(spark, root, "part").select(
        "p_partkey",
        scalar.banded(size * 2, [(90, "A"), (75, "B"), (50, "C")], "Fail").alias("grade"),
        scalar.banded(size, [(18, "eligible")], "not eligible").alias("vote"),
    )


@query(
    "sign_parity",
    "F8 X2",
    """
    SELECT c_custkey, CASE WHEN n > 0 AND n % 2 = 0 THEN 'Positive and even' WHEN n > 0 THEN 'Positive but odd'
                           WHEN n = 0 THEN 'Zero' ELSE 'Negative' END AS class
    FROM (SELECT c_custkey, trunc(c_acctbal / 100)::bigint AS n FROM customer)
    """,
)
def sign_parity(spark, root):
    n = (F.col("c_acctbal") / 100).cast("bigint")
    return table(spark, root, "customer").select("c_custkey", scalar.sign_parity(n).alias("class"))


@query(
    "indicators",
    "F6 U1",
    """
    SELECT event_id, CASE WHEN value >= 40 THEN 1 ELSE 0 END AS is_large,
           CASE WHEN nullif(user_id, 3) > 0 THEN 1 ELSE 0 END AS has_user FROM events
    """,
)
def indicators(spark, root):
    return table(spark, root, "events").select(
        "event_id",
        scalar.indicator(F.col("value") >= 40).alias("is_large"),
        scalar.indicator(F.nullif("user_id", F.lit(3)) > 0).alias("has_user"),
    )


@query(
    "tiered_discount",
    "F10 X1 P6",
    """
    SELECT o_orderkey, round(CASE WHEN o_totalprice > 100000 THEN o_totalprice * 0.1 ELSE 0 END, 4) AS discount,
           round(o_totalprice - CASE WHEN o_totalprice > 100000 THEN o_totalprice * 0.1 ELSE 0 END, 4) AS final
    FROM orders
    """,
)
def tiered_discount(spark, root):
    discount = scalar.tiered_discount(F.col("o_totalprice"), 100000, 0.1)
    return table(spark, root, "orders").select(
        "o_orderkey",
        F.round(discount, 4).alias("discount"),
        F.round(F.col("o_totalprice") - discount, 4).alias("final"),
    )


@query(
    "prime_orders",
    "F13 X2",
    """
    SELECT o_orderkey FROM orders
    WHERE o_orderkey > 1 AND NOT EXISTS (
        SELECT 1 FROM range(2, 10000) d(i) WHERE i * i <= o_orderkey AND o_orderkey % i = 0)
    """,
)
def prime_orders(spark, root):
    return table(spark, root, "orders").select("o_orderkey").where(scalar.is_prime(F.col("o_orderkey")))


@query(
    "range_squares",
    "F11 S6 X3",
    """
    SELECT i AS id, i * i AS square, CASE WHEN i % 2 = 0 THEN 'even' ELSE 'odd' END AS parity,
           count(p_partkey) AS parts
    FROM range(1, (SELECT max(p_size) + 1 FROM part)) r(i) LEFT JOIN part ON p_size = i
    WHERE i % 2 = 0 GROUP BY ALL
    """,
)
def range_squares(spark, root):
    """Even sizes up to the largest one, with their squares and the number of parts of that size."""
    part = table(spark, root, "part")
    top = part.agg(F.max("p_size")).first()[0] or 0
    counts = part.groupBy(F.col("p_size").cast("bigint").alias("id")).agg(F.count(F.lit(1)).alias("parts"))
    parity = F.when(F.col("id") % 2 == 0, "even").otherwise("odd")
    return (
        integer_range(spark, 1, top + 1)
        .where("id % 2 = 0")
        .join(counts, "id", "left")
        .select(
            "id",
            scalar.square(F.col("id")).alias("square"),
            parity.alias("parity"),
            F.coalesce("parts", F.lit(0)).alias("parts"),
        )
    )


@query(
    "keyed_random",
    "S7",
    """
    SELECT o_orderkey,
           1 + ('0x' || substr(md5(o_orderkey::varchar || 'a'), 1, 8))::bigint % 12 AS a,
           ('0x' || substr(md5(o_orderkey::varchar || 'b'), 1, 8))::bigint % 101 AS b
    FROM orders
    """,
)
def keyed_random(spark, root):
    key = F.col("o_orderkey")
    return table(spark, root, "orders").select(
        "o_orderkey",
        keyed_random_int(key, 1, 12, "a").alias("a"),
        keyed_random_int(key, 0, 100, "b").alias("b"),
    )


@query(
    "scalar_math",
    "X1 X2 X3 X4 X5 X6 X7 X8",
    """
    SELECT c_custkey, round(c_acctbal / 7, 4) AS seventh,
           ((c_nationkey - 12) % 5 + 5) % 5 AS modulo,
           c_custkey * c_custkey AS square, round(sqrt(abs(c_acctbal)), 4) AS root,
           round(exp(c_acctbal / 10000), 4) AS growth, round(ln(1 + abs(c_acctbal)), 4) AS log_balance,
           abs(c_acctbal) AS magnitude, CASE WHEN c_nationkey <> 0 THEN round(c_acctbal / c_nationkey, 6) END AS per_nation
    FROM customer
    """,
)
def scalar_math(spark, root):
    balance = F.col("c_acctbal")
    return table(spark, root, "customer").select(
        "c_custkey",
        F.round(balance / 7, 4).alias("seventh"),
        scalar.floor_mod(F.col("c_nationkey") - 12, 5).alias("modulo"),
        scalar.square(F.col("c_custkey")).alias("square"),
        F.round(F.sqrt(F.abs(balance)), 4).alias("root"),
        F.round(F.exp(balance / 10000), 4).alias("growth"),
        F.round(F.log1p(F.abs(balance)), 4).alias("log_balance"),
        F.abs(balance).alias("magnitude"),
        F.round(F.try_divide(balance, F.col("c_nationkey")), 6).alias("per_nation"),
    )


@query(
    "format_numbers",
    "X10 X12",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           printf('%.2f', l_extendedprice) AS price, printf('%.0f%%', l_discount * 100) AS discount,
           l_returnflag || '/' || l_linestatus || ' ' || l_linenumber::varchar AS tag
    FROM lineitem
    """,
)
def format_numbers(spark, root):
    return table(spark, root, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        scalar.fixed(F.col("l_extendedprice"), 2).alias("price"),
        scalar.percent_text(F.col("l_discount"), 0).alias("discount"),
        F.concat(
            "l_returnflag", F.lit("/"), "l_linestatus", F.lit(" "), F.col("l_linenumber").cast("string")
        ).alias("tag"),
    )


@query(
    "value_map",
    "X14",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS code FROM orders",
)
def value_map(spark, root):
    return table(spark, root, "orders").select(
        "o_orderkey", scalar.mapped(F.col("o_orderstatus"), {"O": 0, "F": 1}).alias("code")
    )


ARRAY_BASE = "[p_size::varchar, '40', '30', (p_size % 5 * 10)::varchar, 'Alpha']"


def text_of(expr: str, name: str) -> str:
    return f"array_to_string({expr}, ',') AS {name}"


@query(
    "array_ops",
    "R1 R2 R3 R4 R5 R6 R7 R8 R9 R10 R11 R13",
    f"""
    WITH b AS (SELECT p_partkey, {ARRAY_BASE} AS a FROM part)
    SELECT p_partkey, {text_of("list_append(a, 'Beta')", "appended")},
           {text_of("a || ['Alpha', 'Sigma']", "extended")},
           {text_of("a[1:2] || ['Gamma'] || a[3:]", "inserted")},
           len(list_filter(a, lambda x: x = '30'))::bigint AS thirties,
           {text_of("list_sort(a)", "sorted")}, {text_of("list_reverse(a)", "reversed")},
           (list_position(a, '30') - 1)::bigint AS first_thirty,
           {text_of("a[:list_position(a, '30') - 1] || a[list_position(a, '30') + 1:]", "removed")},
           {text_of("a[:len(a) - 1]", "popped")}, a[len(a)] AS last, 0::bigint AS cleared,
           {text_of("list_sort(list_distinct(a))", "uniques")}, len(a)::bigint AS length
    FROM b
    """,
)
def array_ops(spark, root):
    size = F.col("p_size")
    a = F.col("a")
    base = table(spark, root, "part").select(
        "p_partkey",
        F.array(
            size.cast("string"), F.lit("40"), F.lit("30"), (size % 5 * 10).cast("string"), F.lit("Alpha")
        ).alias("a"),
    )
    shown = {
        "appended": arrays.append(a, F.lit("Beta")),
        "extended": arrays.extend(a, F.array(F.lit("Alpha"), F.lit("Sigma"))),
        "inserted": arrays.insert(a, 2, F.lit("Gamma")),
        "sorted": arrays.sort_as_text(a),
        "reversed": arrays.reverse(a),
        "removed": arrays.remove_first(a, F.lit("30")),
        "popped": arrays.pop_last(a),
        "uniques": arrays.unique_sorted(a),
    }
    return base.select(
        "p_partkey",
        *[F.array_join(expr, ",").alias(name) for name, expr in shown.items()],
        arrays.count_of(a, F.lit("30")).alias("thirties"),
        arrays.index_of(a, F.lit("30")).alias("first_thirty"),
        arrays.last_element(a).alias("last"),
        F.size(arrays.clear(a)).cast("bigint").alias("cleared"),
        F.size(a).cast("bigint").alias("length"),
    )


@query(
    "map_ops",
    "R12",
    """
    SELECT c_custkey, 'age' || '=' || (c_nationkey + 1)::varchar || ';' || 'city' || '=' || c_mktsegment || ';'
           || 'email' || '=' || lower(c_name) || '@example.com' || ';' || 'name' || '=' || c_name AS entries,
           c_mktsegment AS city, NULL::varchar AS missing
    FROM customer
    """,
)
def map_ops(spark, root):
    person = F.create_map(
        F.lit("name"), "c_name", F.lit("age"), F.col("c_nationkey").cast("string"), F.lit("city"), "c_mktsegment"
    )
    updated = arrays.map_put(person, "age", (F.col("c_nationkey") + 1).cast("string"))
    full = arrays.map_put(updated, "email", F.concat(F.lower("c_name"), F.lit("@example.com")))
    entries = F.transform(
        F.array_sort(F.map_entries(full)), lambda e: F.concat(e["key"], F.lit("="), e["value"])
    )
    return table(spark, root, "customer").select(
        "c_custkey",
        F.array_join(entries, ";").alias("entries"),
        F.try_element_at(full, F.lit("city")).alias("city"),
        F.try_element_at(full, F.lit("phone")).alias("missing"),
    )


@query(
    "matrix_columns",
    "R13 R14 S5",
    """
    SELECT vec_id, embedding[1]::double AS "A", embedding[2]::double AS "B", embedding[3]::double AS "C",
           8::bigint AS n_rows, round(embedding[17]::double, 6) AS row2_first
    FROM embeddings
    """,
)
def matrix_columns(spark, root):
    vector = F.transform("embedding", lambda x: x.cast("double"))
    matrix = arrays.reshape(vector, 8, 8)
    return table(spark, root, "embeddings").select(
        "vec_id",
        *arrays.element_columns(vector, ["A", "B", "C"]),
        F.size(matrix).cast("bigint").alias("n_rows"),
        F.round(F.get(F.get(matrix, 2), 0), 6).alias("row2_first"),
    )
