"""Composed reports: several operators from scan to result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statloom.operators import (
    chartdata,
    classify,
    clean,
    edit,
    evaluate,
    features,
    forest,
    infer,
    power,
    profile,
    ranks,
    relate,
)
from statloom.plans import cleaning, models  # noqa: F401  (reports build on registered queries)
from statloom.plans.profiling import each, rounded
from statloom.plans.registry import REGISTRY, query
from statloom.session import materialise, scratch_path
from statloom.sources.tables import from_columns, read_csv, table, write_csv


def long_report(df: DataFrame, section: str, name: str, values: Sequence[str], places: int = 4) -> DataFrame:
    """(section, name, measure, value) rows of a report table."""
    typed = df.select(
        F.lit(section).alias("section"),
        F.col(name).cast("string").alias("name"),
        *[F.round(F.col(v).cast("double"), places).alias(v) for v in values],
    )
    return typed.unpivot(["section", "name"], list(values), "measure", "value")


def described_sql(source: str, c: str) -> str:
    """The describe section of one column of `source`."""
    stats = {
        "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "q1": f"quantile_cont({c}, 0.25)",
        "median": f"quantile_cont({c}, 0.5)", "q3": f"quantile_cont({c}, 0.75)", "max": f"max({c})",
    }
    return f"""SELECT 'describe' AS section, '{c}' AS name, unnest({list(stats)}) AS measure,
               round(unnest([{", ".join(f"({e})::double" for e in stats.values())}]), 4) AS value FROM {source}"""


STATS = ["count", "mean", "std", "min", "q1", "median", "q3", "max"]


def stack(*parts: DataFrame) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def revenue(
    visits: DataFrame, billing: DataFrame, additions: DataFrame, updates: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hospital-style revenue chain on visits(id, department, doctor, bill, seen), billing(id,
    insured, final), additions(id, department, doctor, bill) and updates(id, insured, final):
    revenue per department before cleaning and at the end, and mean final amount per doctor."""
    before = profile.group_sum(visits, "department", "bill", "revenue")
    cleaned = (
        visits.transform(clean.keep_first, ["id"], ["seen"])
        .transform(edit.drop, ["seen", "receptionist"])
        .transform(clean.fill_rounded_mean, "bill", 1)
    )
    merged = relate.left_join(cleaned, clean.keep_first(billing, ["id"], ["insured", "final"]), "id")
    everyone = relate.keyed_update(relate.union_by_name(merged, additions), updates, "id")
    after = profile.group_sum(everyone, "department", "bill", "revenue")
    doctors = profile.group_means(everyone, "doctor", ["final"])
    return before, after, doctors


@query(
    "revenue_report",
    "S1 P1 P3 P8 G1 G2 D2 C2 J1 D3 J2 D4",
    """
    WITH visits AS (SELECT o_custkey AS id, o_orderpriority AS department, o_orderstatus AS doctor,
                           CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS bill, o_orderkey AS seen FROM orders),
    firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seen) AS k FROM visits) WHERE k = 1),
    filled AS (SELECT id, department, doctor,
                      round(coalesce(bill, round((SELECT avg(bill) FROM firsts), 1)), 1) AS bill FROM firsts),
    everyone AS (SELECT f.*, c.c_acctbal * 2 AS final FROM filled f LEFT JOIN customer c ON f.id = c.c_custkey
                 UNION ALL SELECT -1 - s_suppkey, 'SUPPLIER', 'S', s_acctbal,
                                  CASE WHEN s_nationkey < 20 THEN s_acctbal / 2 END FROM supplier)
    SELECT 'before' AS section, department AS name, 'revenue' AS measure, coalesce(round(sum(bill), 1), 0) AS value
    FROM visits GROUP BY 2
    UNION ALL SELECT 'after', department, 'revenue', round(coalesce(sum(bill), 0), 1) FROM everyone GROUP BY 2
    UNION ALL SELECT 'doctor', doctor, 'final_mean', round(avg(final), 1) FROM everyone GROUP BY 2
    """,
)
def revenue_report(spark, root):
    """A customer's orders are visits, the earliest one counts; suppliers arrive as new patients. Visits
    and billing are written as CSV files and scanned with their schemas."""
    visits = table(spark, root, "orders").select(
        F.col("o_custkey").alias("id"),
        F.col("o_orderpriority").alias("department"),
        F.col("o_orderstatus").alias("doctor"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("bill"),
        F.col("o_orderkey").alias("seen"),
    )
    billing = table(spark, root, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").alias("insured"),
        (F.col("c_acctbal") * 2).alias("final"),
    )
    supplier = table(spark, root, "supplier").withColumn("id", -1 - F.col("s_suppkey"))
    additions = supplier.select(
        "id", F.lit("SUPPLIER").alias("department"), F.lit("S").alias("doctor"), F.col("s_acctbal").alias("bill")
    )
    updates = supplier.where("s_nationkey < 20").select(
        "id", F.col("s_acctbal").alias("insured"), (F.col("s_acctbal") / 2).alias("final")
    )
    scanned = []
    for name, rows, kinds in (
        ("visits", visits, "id bigint, department string, doctor string, bill double, seen bigint"),
        ("billing", billing, "id bigint, insured double, final double"),
    ):
        path = scratch_path(spark, f"{name}-csv")
        write_csv(rows, path)
        scanned.append(read_csv(spark, path, kinds))
    before, after, doctors = revenue(*scanned, additions, updates)
    return stack(
        long_report(before, "before", "department", ["revenue"], 1),
        long_report(after, "after", "department", ["revenue"], 1),
        long_report(doctors, "doctor", "doctor", ["final_mean"], 1),
    )


SEGMENT_BONUS = {"AUTOMOBILE": 100.0, "BUILDING": None, "FURNITURE": 250.0, "HOUSEHOLD": 0.0, "MACHINERY": 50.0}


@query(
    "salary_report",
    "S3 I2 I4 P1 P2 C1 D1",
    f"""
    WITH b(segment, bonus) AS (VALUES {", ".join(f"('{k}', {'NULL' if v is None else v}::double)" for k, v in SEGMENT_BONUS.items())}),
    r AS (SELECT c_name, c_mktsegment, c_nationkey, bonus, CASE WHEN c_acctbal >= 0 THEN round(c_acctbal, -3) END AS pay
          FROM customer LEFT JOIN b ON segment = c_mktsegment),
    f AS (SELECT DISTINCT c_mktsegment, c_nationkey, round(coalesce(pay, (SELECT avg(pay) FROM r)), 4) AS pay FROM r)
    """
    + "\nUNION ALL ".join(
        [f"SELECT 'info' AS section, '{c}' AS name, 'non_null' AS measure, count({c})::double AS value FROM r" for c in ("c_name", "c_mktsegment", "c_nationkey", "bonus", "pay")]
        + [described_sql("r", c) for c in ("bonus", "pay")]
        + ["SELECT 'rows', c_mktsegment || '/' || c_nationkey, 'pay', pay FROM f"]
    ),
)
def salary_report(spark, root):
    """A table literal beside the customers; info, describe, select, drop, mean fill, distinct rows."""
    bonus = from_columns(spark, {"c_mktsegment": list(SEGMENT_BONUS), "bonus": list(SEGMENT_BONUS.values())}, "c_mktsegment string, bonus double")
    people = relate.left_join(table(spark, root, "customer"), bonus, "c_mktsegment").withColumn(
        "pay", F.when(F.col("c_acctbal") >= 0, F.round("c_acctbal", -3))
    )
    people = people.transform(edit.select, ["c_name", "c_mktsegment", "c_nationkey", "bonus", "pay"])
    kept = people.transform(edit.drop, ["c_name", "bonus"])
    rows = clean.distinct_rows(rounded(clean.fill_mean(kept, ["pay"]), "pay"))
    return stack(
        long_report(profile.info(people), "info", "column", ["non_null"]),
        long_report(profile.describe(people, ["bonus", "pay"]), "describe", "column", STATS),
        long_report(rows.withColumn("name", F.concat_ws("/", "c_mktsegment", "c_nationkey")), "rows", "name", ["pay"]),
    )


PROFILE_SOURCE = """(SELECT DISTINCT trim(' ' || o_orderstatus) AS status, o_totalprice, o_custkey, o_orderdate::date AS day FROM orders)"""
PROFILED = ["o_totalprice", "o_custkey"]
CAP = "(SELECT quantile_cont($c, 0.25) AS q1, quantile_cont($c, 0.75) AS q3 FROM src)"
INSIDE = "$c BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"


@query(
    "profile_report",
    "S2 D1 P5 C9 I6 I5 G12 V1 V2 V4 C10",
    f"WITH src AS MATERIALIZED {PROFILE_SOURCE}"
    + each(
        f"""
        SELECT 'stats' AS section, '$c' AS name, unnest(['mean', 'median', 'mode', 'std', 'skew']) AS measure,
               round(unnest([avg($c), quantile_cont($c, 0.5), (SELECT $c::double FROM src GROUP BY $c ORDER BY count(*) DESC, $c LIMIT 1),
                             stddev_samp($c), skewness($c)]), 4) AS value
        FROM src
        UNION ALL {described_sql("src", "$c")}
        UNION ALL
        SELECT 'capped', '$c', unnest(['min', 'max']), unnest([round(greatest(min($c), q1 - 1.5 * (q3 - q1)), 4),
                                                             round(least(max($c), q3 + 1.5 * (q3 - q1)), 4)])
        FROM src, {CAP} GROUP BY q1, q3
        UNION ALL
        SELECT 'box', '$c', unnest(['q1', 'median', 'q3', 'whisker_low', 'whisker_high', 'outliers']),
               round(unnest([any_value(q1), quantile_cont($c, 0.5), any_value(q3), min($c) FILTER ({INSIDE}), max($c) FILTER ({INSIDE}),
                             count(*) FILTER (NOT ({INSIDE}))])::double, 4)
        FROM src, {CAP}
        UNION ALL
        SELECT 'histogram', '$c ' || i, 'n', (SELECT count(*) FROM src WHERE least(19, floor(($c - lo) / ((hi - lo) / 20))) = i)::double
        FROM range(20) r(i), (SELECT min($c)::double AS lo, max($c)::double AS hi FROM src)
        """,
        PROFILED,
    )
    + """
    UNION ALL SELECT 'counts', status, 'n', count(*)::double FROM src GROUP BY 2
    UNION ALL SELECT 'days', 'day', unnest(['distinct', 'span']), unnest([count(DISTINCT day)::double, (max(day) - min(day))::double]) FROM src
    """,
)
def profile_report(spark, root):
    """Scan a day-first CSV, repair names and strings, then describe, cap, draw and count."""
    written = table(spark, root, "orders").select(
        F.concat(F.lit(" "), "o_orderstatus").alias(" status"),
        F.col("o_totalprice").alias("o_totalprice "),
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("day"),
    )
    path = scratch_path(spark, "profile-csv")
    write_csv(written, path)
    raw = read_csv(spark, path, "` status` string, `o_totalprice ` double, o_custkey bigint, day date")
    data = raw.transform(clean.distinct_rows).transform(edit.trim_names).transform(clean.trim_strings)
    data = materialise(data, "profiled")
    numeric = profile.columns_by_type(data, "numeric")
    capped = profile.per_column(
        clean.cap_outliers(data, numeric),
        numeric,
        {"min": lambda c: F.min(c).cast("double"), "max": lambda c: F.max(c).cast("double")},
    )
    days = data.agg(F.count_distinct("day").alias("distinct"), F.date_diff(F.max("day"), F.min("day")).alias("span"))
    bins = chartdata.histogram(data, numeric, 20).withColumn("name", F.concat_ws(" ", "column", "bin"))
    return stack(
        long_report(profile.descriptive_stats(data, numeric), "stats", "column", ["mean", "median", "mode", "std", "skew"]),
        long_report(profile.describe(data, numeric), "describe", "column", STATS),
        long_report(capped, "capped", "column", ["min", "max"]),
        long_report(chartdata.box_stats(data, numeric), "box", "column", ["q1", "median", "q3", "whisker_low", "whisker_high", "outliers"]),
        long_report(bins, "histogram", "name", ["n"]),
        long_report(profile.value_counts(data, "status"), "counts", "status", ["n"]),
        long_report(days.withColumn("name", F.lit("day")), "days", "name", ["distinct", "span"]),
    )


CHAIN_SQL = REGISTRY["clean_chain"].sql


EDA = ["quantity", "margin"]
OUTSIDE = "{c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)"


@query(
    "eda_report",
    "C12 I9 I5 G13 G14 G17 G18 G3 H4 G5 F2 G15 O6",
    f"""
    WITH e AS MATERIALIZED (SELECT * FROM ({CHAIN_SQL})), n AS (SELECT count(*) AS n FROM e),
    sides AS (SELECT CASE WHEN quantity > q AND margin > m THEN 'high' WHEN quantity <= q AND margin <= m THEN 'low' END AS side, line
              FROM e, (SELECT quantile_cont(quantity, 0.5) AS q, quantile_cont(margin, 0.5) AS m FROM e))
    SELECT 'share' AS section, line::varchar AS name, unnest(['n', 'share']) AS measure,
           unnest([count(*)::double, round(count(*) / (SELECT n FROM n), 4)]) AS value FROM e GROUP BY 2
    UNION ALL SELECT 'matrix', x || '/' || y, 'r', round(r, 4) FROM (
        SELECT 'quantity' AS x, 'margin' AS y, corr(quantity, margin) AS r FROM e UNION ALL SELECT 'margin', 'quantity', corr(quantity, margin) FROM e
        UNION ALL SELECT 'quantity', 'quantity', 1 UNION ALL SELECT 'margin', 'margin', 1)
    UNION ALL (SELECT 'top', name, 'r', round(r, 4) FROM (SELECT 'quantity' AS name, corr(quantity, line) AS r FROM e
               UNION ALL SELECT 'margin', corr(margin, line) FROM e) ORDER BY abs(r) DESC, name LIMIT 1)
    UNION ALL SELECT 'subset', side, unnest(['n', 'share']), unnest([count(*)::double, round(avg((line = 2)::int), 4)])
              FROM sides WHERE side IS NOT NULL GROUP BY side
    """
    + "".join(
        f"""
    UNION ALL {described_sql("e", c)}
    UNION ALL SELECT 'outliers', '{c}', 'outliers', count(*) FILTER ({OUTSIDE.format(c=c)})::double
              FROM e, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM e)
    UNION ALL SELECT 'correlation', '{c}', 'r', round(corr({c}, line), 4) FROM e
    UNION ALL SELECT 'anova', '{c}', 'f', (SELECT round((sum(k * (m - g)**2) / (count(*) - 1)) / (sum(s) / (sum(k) - count(*))), 3)
        FROM (SELECT count({c}) AS k, avg({c}) AS m, var_pop({c}) * count({c}) AS s, (SELECT avg({c}) FROM e) AS g FROM e GROUP BY line))
    UNION ALL SELECT 'line ' || line, '{c}', unnest(['mean', 'median']), round(unnest([avg({c}), quantile_cont({c}, 0.5)]), 4) FROM e GROUP BY line
    """
        for c in EDA
    ),
)
def eda_report(spark, root):
    """Clean a labelled table, then outliers, description, class shares, correlations, analysis of variance,
    class means and medians, and the share of a class above and below the medians. The cleaned table
    is written once, as every section reads it; quartiles, and sums of all rows and of each class, are
    computed once for all sections. The cleaned table has the three classes that the chain keeps."""
    data = materialise(REGISTRY["clean_chain"].run(spark, root), "cleaned")
    quartiles = materialise(ranks.quantiles(data, EDA, profile.QUARTILES), "quartiles")
    second = F.col("line") == 2
    sums = materialise(profile.shared_sums(data, EDA, "line", second, quartiles), "sums")
    classes = materialise(profile.group_moments(data, "line", EDA), "classes")
    counts = classes.where(F.col("column") == EDA[0]).select("line", F.col("rows").alias("n"))
    groups = profile.group_mean_median(data, "line", EDA, few_groups=True, groups=classes).withColumn("section", F.concat(F.lit("line "), F.col("line").cast("string")))
    groups = groups.select("section", F.col("column").alias("name"), *[F.round(c, 4).alias(c) for c in ("mean", "median")])
    matrix = profile.correlations(data, EDA, sums).withColumn("name", F.concat_ws("/", "x", "y"))
    return stack(
        long_report(profile.outlier_counts(data, EDA, sums=sums), "outliers", "column", ["outliers"]),
        long_report(profile.describe(data, EDA, quartiles, sums), "describe", "column", STATS),
        long_report(profile.value_counts(data, "line", counts), "share", "line", ["n", "share"]),
        long_report(matrix, "matrix", "name", ["r"]),
        long_report(profile.target_correlations(data, "line", EDA, sums), "correlation", "column", ["r"]),
        long_report(profile.top_correlated(data, "line", EDA, 1, sums), "top", "column", ["r"]),
        long_report(infer.anova(data, "line", EDA, classes), "anova", "column", ["f"], 3),
        groups.unpivot(["section", "name"], ["mean", "median"], "measure", "value"),
        long_report(profile.subset_class_share(data, *EDA, second, sums=sums), "subset", "subset", ["n", "share"]),
    )


@query("regression_report", "P4 F3 M1 M7 M8 L1 L2 L3 L4 E1 E2 E3 E10 E11")
def regression_report(spark, root):
    """Rename a column and overwrite extreme values, then four linear models on held-out rows, and the
    coefficients of the best one."""
    named = table(spark, root, "lineitem").withColumnRenamed("l_quantity", "amount").transform(edit.rename, {"amount": "l_quantity"})
    extreme = F.col("l_tax") > 0.07
    changed = named.agg(F.count_if(extreme).alias("changed")).withColumn("name", F.lit("l_tax"))
    lines = named.transform(edit.overwrite_where, extreme, "l_tax", 0.04).transform(features.interaction, "l_quantity", "l_discount", "mix")
    fits, test = models.fitted_lines(lines)
    metrics = evaluate.compare_models(test, models.Y, {k: f.predict() for k, f in fits.items()})
    best = fits[metrics.first()["model"]]
    return stack(
        long_report(changed, "overwritten", "name", ["changed"]),
        long_report(metrics, "metrics", "model", ["mae", "rmse", "r2"]),
        long_report(best.table(spark), "best model", "feature", ["coefficient"]),
    )


CALLED = "count(*) FILTER (quality = {y} AND predicted = {p})"
HITS = {(y, p): CALLED.format(y=y, p=p) for y in (0, 1) for p in (0, 1)}


def report_sql() -> str:
    """Rows of the classification report from `called` and `odds`."""
    cells = ", ".join(f"{e}::double AS c{y}{p}" for (y, p), e in HITS.items())
    part = lambda a, b: f"coalesce({a} / nullif({b}, 0), 0)"
    of = {k: (part(f"c{k}{k}", f"(c0{k} + c1{k})"), part(f"c{k}{k}", f"(c{k}0 + c{k}1)"), part(f"2 * c{k}{k}", f"(c0{k} + c1{k} + c{k}0 + c{k}1)")) for k in (0, 1)}
    s0, s1, n = "(c00 + c01)", "(c10 + c11)", "(c00 + c01 + c10 + c11)"
    rows = [("metrics", "held out", dict(zip(["accuracy", "precision", "recall", "f1"], [f"(c00 + c11) / {n}", *of[1]])))]
    names = ["precision", "recall", "f1", "support"]
    rows += [("classes", str(k), dict(zip(names, [*of[k], s]))) for k, s in ((0, s0), (1, s1))]
    rows.append(("classes", "accuracy", dict(zip(names, [f"(c00 + c11) / {n}"] * 3 + [n]))))
    rows.append(("classes", "macro avg", dict(zip(names, [f"({a} + {b}) / 2" for a, b in zip(of[0], of[1])] + [n]))))
    rows.append(("classes", "weighted avg", dict(zip(names, [f"({a} * {s0} + {b} * {s1}) / {n}" for a, b in zip(of[0], of[1])] + [n]))))
    rows += [("confusion", f"{y} as {p}", {"n": f"c{y}{p}"}) for y in (0, 1) for p in (0, 1)]
    parts = [f"SELECT '{s}' AS section, '{name}' AS name, '{m}' AS measure, round({e}, 4) AS value FROM k" for s, name, found in rows for m, e in found.items()]
    parts.append("""SELECT 'roc', 'held out', 'auc', round((SELECT sum(CASE WHEN a.score > b.score THEN 1 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
                    FROM called a, called b WHERE a.quality = 1 AND b.quality = 0) / nullif(s1 * s0, 0), 4)
                    FROM (SELECT c10 + c11 AS s1, c00 + c01 AS s0 FROM k)""")
    parts += [f"SELECT 'odds', feature, '{m}', round({e}, 4) FROM odds" for m, e in (("coefficient", "coefficient"), ("odds_ratio", "exp(coefficient)"))]
    # The curve has one point per distinct score: its size, and its largest distance from the diagonal.
    parts.append("SELECT 'roc', 'held out', 'points', count(DISTINCT score) + 1.0 FROM called")
    parts.append("""SELECT 'roc', 'held out', 'distance', round(max(tpr - fpr), 4) FROM (SELECT
                    sum(sum(quality)) OVER w / sum(sum(quality)) OVER () AS tpr, sum(sum(1 - quality)) OVER w / sum(sum(1 - quality)) OVER () AS fpr
                    FROM called GROUP BY score WINDOW w AS (ORDER BY score DESC))""")
    return f", k AS MATERIALIZED (SELECT {cells} FROM called)\n" + "\nUNION ALL ".join(parts)


@query("classification_report", "M2 M3 L5 E4 E5 E6 E7 E8 E9 E12", models.LOGISTIC_SQL + report_sql())
def classification_report(spark, root):
    """Logistic regression on labelled documents: metrics and curve of the held-out rows, odds ratios."""
    fit, scored = models.fit_logistic(spark, root)
    scored = materialise(scored, "scored")
    odds = evaluate.coefficient_table(spark, models.DOC_FEATURES, fit.coef, odds=True)
    overall = evaluate.binary_metrics(scored, "quality", "predicted").withColumn("name", F.lit("held out"))
    auc = evaluate.roc_auc(scored, "quality", "score").withColumn("name", F.lit("held out"))
    curve = evaluate.roc_curve(scored, "quality", "score").agg(F.count(F.lit(1)).alias("points"), F.max(F.col("tpr") - F.col("fpr")).alias("distance"))
    per_class = evaluate.classification_report(scored, "quality", "predicted")
    pairs = evaluate.confusion(scored, "quality", "predicted").withColumn(
        "name", F.concat_ws(" as ", "actual", "predicted")
    )
    return stack(
        long_report(overall, "metrics", "name", ["accuracy", "precision", "recall", "f1"]),
        long_report(auc, "roc", "name", ["auc"]),
        long_report(curve.withColumn("name", F.lit("held out")), "roc", "name", ["points", "distance"]),
        long_report(per_class, "classes", "label", ["precision", "recall", "f1", "support"]),
        long_report(pairs, "confusion", "name", ["n"]),
        long_report(odds, "odds", "feature", ["coefficient", "odds_ratio"]),
    )


PREPARED = ["o_orderstatus_O", "o_orderstatus_P", "o_orderpriority", "is_large", "o_totalprice_log"]
STEPS_SQL = f"""
    WITH e AS MATERIALIZED (SELECT * FROM ({REGISTRY["encode_chain"].sql}))
    SELECT 'sentinel' AS section, 'o_orderpriority' AS name, 'hits' AS measure, count(*) FILTER (o_orderkey % 11 = 0)::double AS value FROM orders
    UNION ALL SELECT 'sentinel', 'o_orderstatus', 'hits', 0
""" + "".join(
    f"""
    UNION ALL SELECT 'categories', '{c}', 'n_distinct', count(DISTINCT {c})::double FROM e
    UNION ALL SELECT 'skew', '{c}', 'skew', round(skewness({c}), 4) FROM e
    UNION ALL SELECT 'standard', '{c}', unnest(['low', 'high']), unnest([round((min({c}) - avg({c})) / stddev_pop({c}), 4), round((max({c}) - avg({c})) / stddev_pop({c}), 4)]) FROM e
    UNION ALL SELECT 'minmax', '{c}', 'mean', round((avg({c}) - min({c})) / (max({c}) - min({c})), 4) FROM e
    """
    for c in PREPARED
)


def preparation(spark, root) -> tuple[DataFrame, DataFrame]:
    """The encoded orders, and the rows of the report that describe them."""
    raw = table(spark, root, "orders").select("o_orderstatus", F.when(F.col("o_orderkey") % 11 == 0, " ?").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"))
    encoded = materialise(REGISTRY["encode_chain"].run(spark, root), "encoded")
    standard = profile.per_column(features.standard_scale(encoded, PREPARED), PREPARED, {"low": F.min, "high": F.max})
    minmax = profile.per_column(features.minmax_scale(encoded, PREPARED), PREPARED, {"mean": F.avg})
    return encoded, stack(
        long_report(profile.sentinel_counts(raw, " ?"), "sentinel", "column", ["hits"]),
        long_report(profile.cardinality(encoded, PREPARED), "categories", "column", ["n_distinct"]),
        long_report(profile.skew_ranking(encoded, PREPARED), "skew", "column", ["skew"]),
        long_report(standard, "standard", "column", ["low", "high"]),
        long_report(minmax, "minmax", "column", ["mean"]),
    )


@query("preparation_steps", "I8 I12 M3 M4 M10 M15", STEPS_SQL)
def preparation_steps(spark, root):
    """The part of the preparation report that SQL can follow."""
    return preparation(spark, root)[1]


@query("preparation_report", "I8 C9 C6 C5 M3 M4 I12 M5 M6 X14 F6 M10 M11 L11 M9 D5")
def preparation_report(spark, root):
    """Encode a mixed table, scale and describe it, flag its anomalies, count the flags per target class,
    and score the power of each column for each other, as a wide table melted again."""
    encoded, described = preparation(spark, root)
    flagged = forest.flag_outliers(encoded, PREPARED, "o_orderkey")
    flags = flagged.groupBy("outlier_flag", "band").agg(F.count(F.lit(1)).alias("n"))
    named = encoded.withColumn("band", F.concat(F.lit("band "), F.col("band").cast("string")))
    wide = power.pps_wide(power.pps_matrix(named, "o_orderkey", PREPARED, ["band"]))
    scores = relate.melt(wide, ["x"], [*PREPARED, "band"]).withColumn("name", F.concat_ws("/", "x", "column"))
    return stack(
        described,
        long_report(flags.withColumn("name", F.concat_ws("/", "outlier_flag", "band")), "flags", "name", ["n"]),
        long_report(scores, "power", "name", ["value"]),
    )


@query("svm_report", "I5 G17 M2 M3 M12 L6 L7 L8 L9 L10 E6 E8 E13")
def svm_report(spark, root):
    """Describe the training rows and their main components, compare kernels, report on a Gaussian machine
    and on the grid of its settings. All Gaussian and cubic machines are fitted at once."""
    train, test, cols = models.embedded(spark, root)
    plane = features.fit_pca(train, cols, 2, standardise=False)
    parts = spark.createDataFrame([(f"pc{i + 1}", float(v)) for i, v in enumerate(plane.variance)], "name string, variance double")
    compared = classify.compare_kernels(train, test, cols, "label", "vec_id", ["linear", "poly", "rbf"])
    grid = classify.grid_search(train, cols, "label", "vec_id")
    grid = grid.withColumn("name", F.concat(F.lit("C="), F.col("c").cast("string"), F.lit(" gamma="), F.col("gamma")))
    scored = classify.fit_kernel_svm(train, test, cols, "label", "vec_id", "rbf", c=1.0, gamma=0.1)
    scored = materialise(scored.select("vec_id", "label", "prediction"), "predictions")
    per_class = evaluate.classification_report(scored, "label", "prediction")
    pairs = evaluate.confusion(scored, "label", "prediction").withColumn(
        "name", F.concat_ws(" as ", "actual", "predicted")
    )
    r = profile.correlations(train, cols).withColumn("name", F.concat_ws("/", "x", "y"))
    return stack(
        long_report(profile.describe(train, cols), "describe", "column", STATS),
        long_report(r, "correlation", "name", ["r"]),
        long_report(parts, "components", "name", ["variance"]),
        long_report(compared, "kernels", "kernel", ["accuracy"]),
        long_report(grid, "grid", "name", ["accuracy", "rank"]),
        long_report(per_class, "classes", "label", ["precision", "recall", "f1", "support"]),
        long_report(pairs, "confusion", "name", ["n"]),
    )
