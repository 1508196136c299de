"""Queries that prepare chart data."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import chartdata, profile
from statloom.plans.profiling import each, rounded
from statloom.plans.registry import query
from statloom.sources.tables import table


def hist_sql(source: str, cols, bins: int) -> str:
    return each(
        f"""
        SELECT '$c' AS "column", b::int AS bin, round(lo + b * (hi - lo) / {bins}, 4) AS low,
               round(lo + (b + 1) * (hi - lo) / {bins}, 4) AS high, coalesce(n, 0)::bigint AS n
        FROM (SELECT min($c)::double AS lo, max($c)::double AS hi FROM {source}), range({bins}) r(b)
        LEFT JOIN (SELECT least({bins - 1}, floor(($c - lo) / ((hi - lo) / {bins})))::int AS bin, count(*) AS n
                   FROM {source}, (SELECT min($c)::double AS lo, max($c)::double AS hi FROM {source})
                   WHERE $c IS NOT NULL GROUP BY 1) ON bin = b
        """,
        cols,
    )


@query("hist20", "V1", hist_sql("events", ["value", "user_id"], 20))
def hist20(spark, root):
    bins = chartdata.histogram(table(spark, root, "events"), ["value", "user_id"], 20)
    return rounded(bins, "low", "high")


@query("hist30", "V1", hist_sql("lineitem", ["l_extendedprice", "l_quantity"], 30))
def hist30(spark, root):
    bins = chartdata.histogram(table(spark, root, "lineitem"), ["l_extendedprice", "l_quantity"], 30)
    return rounded(bins, "low", "high")


BOX = """
    SELECT {keys} '$c' AS "column", round(q1, 4) AS q1, round(med, 4) AS median, round(q3, 4) AS q3,
           min($c) FILTER (inside)::double AS whisker_low, max($c) FILTER (inside)::double AS whisker_high,
           count(*) FILTER (NOT inside) AS outliers
    FROM (SELECT *, $c BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
          FROM {table} JOIN (SELECT {keys} quantile_cont($c, 0.25) AS q1, quantile_cont($c, 0.5) AS med,
                            quantile_cont($c, 0.75) AS q3 FROM {table} {group}) {on})
    GROUP BY ALL
"""


@query("box_stats", "V2", each(BOX.format(keys="", table="events", group="", on="ON true"), ["value", "user_id"]))
def box_stats(spark, root):
    return rounded(
        chartdata.box_stats(table(spark, root, "events"), ["value", "user_id"]), "q1", "median", "q3"
    )


@query(
    "box_by_group",
    "V3",
    each(
        BOX.format(
            keys="o_orderpriority,", table="orders", group="GROUP BY 1", on="USING (o_orderpriority)"
        ),
        ["o_totalprice"],
    ),
)
def box_by_group(spark, root):
    box = chartdata.box_stats(table(spark, root, "orders"), ["o_totalprice"], ["o_orderpriority"])
    return rounded(box, "q1", "median", "q3")


@query(
    "bar_counts",
    "V4 G13 O5",
    "SELECT p_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM part), 4) AS share FROM part GROUP BY 1",
)
def bar_counts(spark, root):
    return rounded(profile.value_counts(table(spark, root, "part"), "p_type"), "share")


def kde_sql(source: str, value: str, key: str | None, points: int) -> str:
    k = f"{key}," if key else ""
    return f"""
        WITH s AS (SELECT {k} count({value}) AS n, min({value}) AS lo, max({value}) AS hi,
                          stddev_samp({value}) * count({value}) ** (-0.2) AS h
                   FROM {source} GROUP BY ALL),
        g AS (SELECT s.*, i::int AS point, lo + i * (hi - lo) / {points - 1} AS x FROM s, range({points}) r(i)),
        v AS (SELECT {k} {value} AS v, count(*) AS w FROM {source} GROUP BY ALL)
        SELECT {'g.' + k if k else ''} point, round(x, 4) AS x,
               round(sum(w * exp(-0.5 * ((x - v) / h) ** 2)) / (n * h * sqrt(2 * pi())), 8) AS density
        FROM g JOIN v ON {f'g.{key} = v.{key}' if key else 'true'}
        GROUP BY {'g.' + k if k else ''} point, x, n, h
    """


@query("kde_grid", "V5", kde_sql("events", "value", None, 50))
def kde_grid(spark, root):
    curve = chartdata.density(table(spark, root, "events"), "value", points=50)
    return rounded(curve, "x").withColumn("density", F.round("density", 8))


@query("kde_by_group", "V6", kde_sql("events", "value", "event_type", 30))
def kde_by_group(spark, root):
    curve = chartdata.density(table(spark, root, "events"), "value", points=30, by=["event_type"])
    return rounded(curve, "x").withColumn("density", F.round("density", 8))


def bin_sql(c: str, source: str, bins: int) -> str:
    lo, hi = f"(SELECT min({c})::double FROM {source})", f"(SELECT max({c})::double FROM {source})"
    return f"least({bins - 1}, floor(({c} - {lo}) / (({hi} - {lo}) / {bins})))::int"


PAIRS = [("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount")]


@query(
    "pair_bins",
    "V9",
    "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, l_returnflag, {bin_sql(x, 'lineitem', 10)} AS x_bin, "
        f"{bin_sql(y, 'lineitem', 10)} AS y_bin, count(*) AS n FROM lineitem GROUP BY ALL"
        for x, y in PAIRS
    ),
)
def pair_bins(spark, root):
    lines = table(spark, root, "lineitem")
    return chartdata.pair_bins(lines, ["l_quantity", "l_extendedprice", "l_discount"], "l_returnflag", 10)


CANDIDATES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
RETURNED = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"


def top_two_sql() -> str:
    """Rank the candidates in SQL too, and count the cells of the pair that comes out on top."""
    ranked = " UNION ALL ".join(f"SELECT '{c}' AS name, abs(corr({c}, {RETURNED})) AS r FROM lineitem" for c in CANDIDATES)
    cells = "\nUNION ALL\n".join(
        f"SELECT '{x}' AS x, '{y}' AS y, {RETURNED} AS returned, {bin_sql(x, 'lineitem', 25)} AS x_bin, "
        f"{bin_sql(y, 'lineitem', 25)} AS y_bin, count(*) AS n FROM lineitem GROUP BY ALL"
        for x in sorted(CANDIDATES) for y in sorted(CANDIDATES) if x < y
    )
    return f"""
    WITH best AS (SELECT name FROM ({ranked}) ORDER BY r DESC, name LIMIT 2), cells AS ({cells})
    SELECT * FROM cells WHERE x IN (SELECT name FROM best) AND y IN (SELECT name FROM best)
    """


@query("scatter_top2", "V8 O6 G18", top_two_sql())
def scatter_top2(spark, root):
    lines = table(spark, root, "lineitem").withColumn("returned", F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    return chartdata.scatter_top_two(lines, "returned", CANDIDATES, 25)
