"""Queries that split, scale, encode and score features."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from statloom.operators import features, power, profile, stages
from statloom.plans.cleaning import LINE_KEY
from statloom.plans.profiling import MEASURES, each, rounded, with_nan
from statloom.plans.registry import query
from statloom.session import scratch_path
from statloom.sources.tables import load_model, save_model, table

HASH = "('0x' || substr(md5({key}::varchar), 1, {digits}))::bigint"


@query(
    "split_counts",
    "M1",
    f"""
    SELECT o_orderstatus, count(*) FILTER (NOT held_out) AS train, count(*) FILTER (held_out) AS test
    FROM (SELECT *, {HASH.format(key='o_orderkey', digits=8)} % 100 < 20 AS held_out FROM orders) GROUP BY 1
    """,
)
def split_counts(spark, root):
    train, test = features.random_split(
        table(spark, root, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey", 0.2
    )
    sides = train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))
    return sides.groupBy("o_orderstatus").agg(
        F.count_if(F.col("side") == "train").alias("train"), F.count_if(F.col("side") == "test").alias("test")
    )


@query(
    "stratified_split",
    "M2",
    f"""
    SELECT o_orderkey, o_orderstatus,
           row_number() OVER (PARTITION BY o_orderstatus
                              ORDER BY {HASH.format(key='o_orderkey', digits=13)}, o_orderkey)
           <= floor(0.2 * count(*) OVER (PARTITION BY o_orderstatus) + 0.5) AS is_test
    FROM orders
    """,
)
def stratified_split(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", "o_orderstatus")
    return features.stratified_flag(orders, "o_orderstatus", "o_orderkey", 0.2)


@query(
    "standard_scale",
    "M3",
    f"SELECT {LINE_KEY}, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem), 4) AS {c}"
        for c in MEASURES
    )
    + " FROM lineitem",
)
def standard_scale(spark, root):
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), *MEASURES)
    return rounded(features.standard_scale(lines, MEASURES), *MEASURES)


@query(
    "minmax_scale",
    "M4",
    f"SELECT {LINE_KEY}, "
    + ", ".join(
        f"round(({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem), 6) AS {c}"
        for c in MEASURES
    )
    + " FROM lineitem",
)
def minmax_scale(spark, root):
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), *MEASURES)
    return features.minmax_scale(lines, MEASURES).withColumns({c: F.round(c, 6) for c in MEASURES})


@query(
    "one_hot",
    "M5",
    "SELECT p_partkey, "
    + ", ".join(
        f"(p_type = '{v}')::int AS \"p_type_{v}\"" for v in ["LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    )
    + " FROM part",
)
def one_hot(spark, root):
    return features.one_hot(table(spark, root, "part").select("p_partkey", "p_type"), ["p_type"])


@query(
    "label_encode",
    "M6",
    """
    SELECT p_partkey, (SELECT count(DISTINCT p_brand) FROM part b WHERE b.p_brand < a.p_brand) AS p_brand FROM part a
    """,
)
def label_encode(spark, root):
    return features.label_encode(table(spark, root, "part").select("p_partkey", "p_brand"), ["p_brand"])


@query(
    "label_encode_large",
    "M6 P9",
    "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS c_name FROM customer",
)
def label_encode_large(spark, root):
    return features.label_encode(table(spark, root, "customer").select("c_custkey", "c_name"), ["c_name"])


@query(
    "label_encode_numbers",
    "M6",
    f"SELECT {LINE_KEY}, dense_rank() OVER (ORDER BY l_quantity::int) - 1 AS code FROM lineitem",
)
def label_encode_numbers(spark, root):
    """Codes of few numbers follow their own order, not that of their texts."""
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), F.col("l_quantity").cast("int").alias("code"))
    return features.label_encode(lines, ["code"])


@query(
    "label_encode_numbers_large",
    "M6 P9",
    "SELECT o_orderkey, dense_rank() OVER (ORDER BY o_custkey) - 1 AS code FROM orders",
)
def label_encode_numbers_large(spark, root):
    return features.label_encode(table(spark, root, "orders").select("o_orderkey", F.col("o_custkey").alias("code")), ["code"])


@query(
    "one_hot_numbers",
    "M5",
    "SELECT c_custkey, " + ", ".join(f'(c_nationkey = {v})::int AS "c_nationkey_{v}"' for v in range(1, 25)) + " FROM customer",
)
def one_hot_numbers(spark, root):
    """The first level in the order of the numbers is dropped."""
    nations = table(spark, root, "nation").select("n_nationkey").collect()
    known = {"c_nationkey": [str(n) for n in sorted(r[0] for r in nations)]}
    return features.one_hot(table(spark, root, "customer").select("c_custkey", "c_nationkey"), ["c_nationkey"], categories=known)


@query(
    "scale_train_only",
    "M1 M3 M7",
    f"""
    WITH s AS (SELECT *, {HASH.format(key='l_orderkey', digits=8)} % 100 < 20 AS held FROM lineitem), fit AS (SELECT * FROM s WHERE NOT held)
    SELECT {LINE_KEY}, round((l_quantity - (SELECT avg(l_quantity) FROM fit)) / (SELECT stddev_pop(l_quantity) FROM fit), 6) AS l_quantity
    FROM s WHERE held
    """,
)
def scale_train_only(spark, root):
    """Test rows under the means and deviations of the training rows."""
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), "l_quantity")
    train, test = features.random_split(lines, "l_orderkey", 0.2)
    scaled = features.column_transform(test, ["l_quantity"], [], LINE_KEY.split(", "), fit_on=train)
    return scaled.withColumn("l_quantity", F.round("l_quantity", 6))


@query(
    "scale_nan",
    "M3",
    f"""
    WITH v AS (SELECT {LINE_KEY}, nullif(l_discount, 0) AS l_discount FROM lineitem)
    SELECT {LINE_KEY}, round((l_discount - (SELECT avg(l_discount) FROM v)) / (SELECT stddev_pop(l_discount) FROM v), 6) AS l_discount FROM v
    """,
)
def scale_nan(spark, root):
    scaled = features.standard_scale(with_nan(spark, root), ["l_discount"])
    return scaled.select(*LINE_KEY.split(", "), F.round("l_discount", 6).alias("l_discount"))


@query(
    "column_transform",
    "M7 I6",
    """
    SELECT c_custkey,
           round((c_acctbal - (SELECT avg(c_acctbal) FROM customer)) / (SELECT stddev_pop(c_acctbal) FROM customer), 4) AS c_acctbal,
           (c_mktsegment = 'BUILDING')::int AS "c_mktsegment_BUILDING", (c_mktsegment = 'FURNITURE')::int AS "c_mktsegment_FURNITURE",
           (c_mktsegment = 'HOUSEHOLD')::int AS "c_mktsegment_HOUSEHOLD", (c_mktsegment = 'MACHINERY')::int AS "c_mktsegment_MACHINERY"
    FROM customer
    """,
)
def column_transform(spark, root):
    out = features.column_transform(
        table(spark, root, "customer"), ["c_acctbal"], ["c_mktsegment"], keep=["c_custkey"]
    )
    return rounded(out, "c_acctbal")


@query(
    "interaction",
    "M8 P6 U5",
    f"SELECT {LINE_KEY}, round(l_quantity * l_discount, 4) AS l_quantity_l_discount_interaction FROM lineitem",
)
def interaction(spark, root):
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), "l_quantity", "l_discount")
    out = features.interaction(lines, "l_quantity", "l_discount").drop("l_quantity", "l_discount")
    return rounded(out, "l_quantity_l_discount_interaction")


@query(
    "one_hot_slots",
    "M5 M7 M15",
    """
    SELECT l_orderkey AS key, l_linenumber, l_partkey, l_suppkey, nullif(dense_rank() OVER (ORDER BY l_orderkey) - 2, -1) AS l_orderkey_slot,
           (SELECT count(DISTINCT l_orderkey) - 1 FROM lineitem) AS l_orderkey_size FROM lineitem
    """,
)
def one_hot_slots(spark, root):
    """A category per order: the encoding of as many columns as there are orders, as slots."""
    lines = table(spark, root, "lineitem").select(F.col("l_orderkey").alias("key"), "l_linenumber", "l_partkey", "l_suppkey", "l_orderkey")
    return features.one_hot_slots(lines, ["l_orderkey"])


@query(
    "saved_stages",
    "U5 M8 L13 S8",
    f"""
    WITH t AS (SELECT *, l_quantity * l_discount AS mix, {HASH.format(key='l_orderkey', digits=8)} % 100 < 20 AS held FROM lineitem),
    m AS (SELECT avg(mix) AS a, stddev_pop(mix) AS s, avg(l_quantity) AS qa, stddev_pop(l_quantity) AS qs FROM t
          WHERE NOT held AND l_returnflag <> 'R')
    SELECT stage, {LINE_KEY}, round((l_quantity - qa) / qs, 6) AS l_quantity, round((mix - a) / s, 6) AS mix, (l_returnflag = 'N')::int AS "l_returnflag_N"
    FROM t, m, (VALUES ('fitted'), ('loaded')) k(stage) WHERE held
    """,
)
def saved_stages(spark, root):
    """A pipeline of our own stages on held-out rows, as fitted and as loaded again; one return flag
    is not among the rows it was fitted on."""
    lines = table(spark, root, "lineitem").select(*LINE_KEY.split(", "), "l_quantity", "l_discount", "l_returnflag")
    train, test = features.random_split(lines, "l_orderkey", 0.2)
    plan = [
        stages.Interaction(["l_quantity", "l_discount"], "mix"),
        stages.PopulationScaler(["l_quantity", "mix"]),
        stages.CategoryFlags("l_returnflag"),
    ]
    fitted = Pipeline(stages=plan).fit(train.where("l_returnflag <> 'R'"))
    loaded = load_model(save_model(fitted, scratch_path(spark, "stages")))
    both = [m.transform(test).withColumn("stage", F.lit(n)) for n, m in (("fitted", fitted), ("loaded", loaded))]
    out = both[0].unionByName(both[1]).drop("l_discount")
    return rounded(out, "l_quantity", "mix", places=6)


@query("log_skew", "M11 X6", "SELECT event_id, value, round(ln(1 + value), 4) AS value_log FROM events")
def log_skew(spark, root):
    events = table(spark, root, "events").select("event_id", "value")
    return rounded(features.log_transform(events, "value"), "value_log")


@query(
    "feature_target",
    "M13 M14 I6 P2",
    """
    SELECT l_returnflag AS label, round(l_quantity + l_extendedprice + l_discount + l_tax, 4) AS total, 8::bigint AS width
    FROM lineitem
    """,
)
def feature_target(spark, root):
    """Numeric columns as one feature array next to the target."""
    lines = table(spark, root, "lineitem")
    numeric = profile.columns_by_type(lines.drop("l_returnflag"), "numeric")
    x = F.array(*[F.col(c).cast("double") for c in numeric])
    total = sum((F.get("x", numeric.index(c)) for c in MEASURES[1:]), F.get("x", numeric.index(MEASURES[0])))
    return lines.select(F.col("l_returnflag").alias("label"), x.alias("x")).select(
        "label", F.round(total, 4).alias("total"), F.size("x").cast("bigint").alias("width")
    )


CHAIN = """
    WITH raw AS (
        SELECT o_orderkey, o_orderstatus,
               CASE WHEN o_orderkey % 11 <> 0 THEN o_orderpriority END AS o_orderpriority,
               CASE WHEN o_totalprice > 250000 THEN '>250K' ELSE '<=250K' END AS band, o_totalprice
        FROM orders),
    filled AS (
        SELECT * REPLACE (coalesce(o_orderpriority, (
            SELECT o_orderpriority FROM raw WHERE o_orderpriority IS NOT NULL
            GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS o_orderpriority) FROM raw)
"""


@query(
    "encode_chain",
    "M15 M5 M6 C5 C6 C9 X14 F6 M11",
    CHAIN
    + """
    SELECT o_orderkey, (o_orderstatus = 'O')::int AS "o_orderstatus_O", (o_orderstatus = 'P')::int AS "o_orderstatus_P",
           dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS o_orderpriority,
           CASE band WHEN '<=250K' THEN 0 ELSE 1 END AS band,
           CASE WHEN o_totalprice >= 100000 THEN 1 ELSE 0 END AS is_large,
           round(ln(1 + o_totalprice), 4) AS o_totalprice_log
    FROM filled
    """,
)
def encode_chain(spark, root):
    orders = table(spark, root, "orders").select(
        "o_orderkey",
        F.concat(F.lit(" "), "o_orderstatus").alias("o_orderstatus"),
        F.when(F.col("o_orderkey") % 11 == 0, " ?")
        .otherwise(F.concat("o_orderpriority", F.lit(" ")))
        .alias("o_orderpriority"),
        F.when(F.col("o_totalprice") > 250000, " >250K").otherwise(" <=250K").alias("band"),
        "o_totalprice",
    )
    encoded = features.encode_table(orders, "band", {"<=250K": 0, ">250K": 1})
    return encoded.withColumn(
        "is_large", F.when(F.col("o_totalprice") >= 100000, 1).otherwise(0)
    ).transform(features.log_transform, "o_totalprice").transform(rounded, "o_totalprice_log").drop("o_totalprice")


@query(
    "pca_2d",
    "M12",
    """
    WITH m AS (SELECT corr(l_quantity, l_extendedprice) AS r, count(*) AS n FROM lineitem)
    SELECT 1 AS component, round((1 + abs(r)) * n / (n - 1), 4) AS fitted, round(1 + abs(r), 4) AS projected FROM m
    UNION ALL SELECT 2, round((1 - abs(r)) * n / (n - 1), 4), round(1 - abs(r), 4) FROM m
    """,
)
def pca_2d(spark, root):
    """Variance of each component as fitted, and as measured on the projected rows."""
    lines = table(spark, root, "lineitem")
    fit = features.fit_pca(lines, ["l_quantity", "l_extendedprice"], 2)
    measured = lines.select(*fit.columns()).agg(F.var_pop("pc1").alias("v1"), F.var_pop("pc2").alias("v2"))
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("component"),
                F.round(F.lit(float(fit.variance[k - 1])), 4).alias("fitted"),
                F.round(F.col(f"v{k}"), 4).alias("projected"),
            )
            for k in (1, 2)
        ]
    )
    return measured.select(F.inline(rows))


@query(
    "pca_eigen",
    "M12",
    """
    SELECT k AS component, 64::bigint AS loadings_that_hold, true AS centred, true AS unit, true AS in_order, true AS signed
    FROM (VALUES (1), (2)) t(k)
    """,
)
def pca_eigen(spark, root):
    """Whether the components of the embeddings are principal ones, measured on the projected rows: the
    covariance of each standardised column with a component is variance times loading, components
    are centred, loadings have length one, variances fall, and the largest loading is positive."""
    base = table(spark, root, "embeddings")
    names = [f"d{i}" for i in range(64)]
    wide = base.select(*[F.get("embedding", i).cast("double").alias(n) for i, n in enumerate(names)])
    fit = features.fit_pca(wide, names, 2)
    projected = wide.select("*", *fit.columns())
    sums = projected.agg(
        *[F.covar_samp(F.col(n) / F.lit(float(fit.scale[j])), f"pc{k}").alias(f"c{k}_{j}") for k in (1, 2) for j, n in enumerate(names)],
        *[f(f"pc{k}").alias(f"{m}{k}") for k in (1, 2) for m, f in (("mean", F.avg), ("var", F.var_samp))],
    ).first()
    rows = []
    for k in (1, 2):
        loading = fit.loadings[k - 1]
        holds = sum(abs(sums[f"c{k}_{j}"] - sums[f"var{k}"] * loading[j]) < 1e-9 for j in range(64))
        unit, signed = abs(float(loading @ loading) - 1) < 1e-9, bool(loading[abs(loading).argmax()] > 0)
        rows.append((k, int(holds), abs(sums[f"mean{k}"]) < 1e-9, unit, sums["var1"] >= sums["var2"], signed))
    kinds = "component int, loadings_that_hold long, centred boolean, unit boolean, in_order boolean, signed boolean"
    return spark.createDataFrame(rows, kinds)


@query("pca_embeddings", "M12 M14")
def pca_embeddings(spark, root):
    """Two components of all 64 embedding dimensions."""
    base = table(spark, root, "embeddings")
    names = [f"d{i}" for i in range(64)]
    wide = base.select("vec_id", "label", *[F.get("embedding", i).cast("double").alias(n) for i, n in enumerate(names)])
    fit = features.fit_pca(wide, names, 2)
    return rounded(wide.select("vec_id", "label", *fit.columns()), "pc1", "pc2")


PPS_NUM, PPS_CAT = ["o_totalprice", "o_custkey"], ["o_orderstatus", "o_orderpriority"]


def pps_sql() -> str:
    def bin_of(c: str) -> str:
        """A bin per value of few values, else one per 64th of the rows, by the exact quantiles."""
        if c in PPS_CAT:
            return c
        probs = [k / 64 for k in range(1, 64)]
        values = f"(SELECT list(DISTINCT {c}::double) FROM orders)"
        edges = f"CASE WHEN (SELECT count(DISTINCT {c}) FROM orders) <= 64 THEN {values} ELSE (SELECT list_distinct(quantile_cont({c}::double, {probs})) FROM orders) END"
        return f"len(list_filter({edges}, lambda e: e < {c}))::varchar"

    parts = []
    for x in PPS_NUM + PPS_CAT:
        for y in PPS_NUM + PPS_CAT:
            if x == y:
                parts.append(f"SELECT '{x}' AS x, '{y}' AS y, 1.0::double AS score")
                continue
            base = (
                f"SELECT {HASH.format(key='o_orderkey', digits=8)} % 4 AS fold, {bin_of(x)} AS bin, {y} AS y FROM orders"
            )
            if y in PPS_NUM:
                parts.append(f"""
                SELECT '{x}', '{y}', (SELECT greatest(0, 1 - sum(abs(r.y - coalesce(a.p, b.p))) / sum(abs(r.y - b.p)))
                FROM ({base}) r CROSS JOIN (SELECT quantile_cont({y}, 0.5) AS p FROM orders) b
                LEFT JOIN (SELECT h, bin, avg(y) AS p FROM ({base}), range(4) f(h)
                           WHERE h <> fold GROUP BY h, bin) a ON a.h = r.fold AND a.bin = r.bin)""")
            else:
                parts.append(f"""
                SELECT '{x}', '{y}', (WITH r AS ({base}),
                g AS (SELECT h, bin, y, row_number() OVER (PARTITION BY h, bin ORDER BY count(*) DESC, y) AS k
                      FROM r, range(4) f(h) WHERE h <> fold GROUP BY h, bin, y),
                p AS (SELECT r.y, g.y AS p FROM r JOIN g ON g.h = r.fold AND g.bin = r.bin AND k = 1),
                c AS (SELECT y, count(*) AS s, count(*) FILTER (y = p) AS hit FROM p GROUP BY 1),
                q AS (SELECT p, count(*) AS q FROM p GROUP BY 1),
                f1 AS (SELECT s, 2 * hit / (s + coalesce(q, 0)) AS f FROM c LEFT JOIN q ON q.p = c.y),
                t AS (SELECT sum(f * s) / sum(s) AS model, max(s) / sum(s) AS m, sum(s * s) / (sum(s) * sum(s)) AS rnd FROM f1)
                SELECT greatest(0, (model - greatest(2 * m * m / (1 + m), rnd)) / (1 - greatest(2 * m * m / (1 + m), rnd))) FROM t)""")
    body = "\nUNION ALL\n".join(parts)
    return f"SELECT x, y, round(score, 4)::double AS score FROM ({body})"


STEPS = "CASE WHEN l_quantity <= 1 THEN 100 WHEN l_quantity <= 3 THEN -50 WHEN l_quantity <= 4 THEN 300 WHEN l_quantity <= 30 THEN 0 ELSE 80 END"


@query(
    "pps_steps",
    "M9 J4",
    "SELECT x, y, score::double AS score FROM (VALUES ('l_quantity', 'step', 1.0), ('l_quantity', 'band', 1.0)) t(x, y, score)",
)
def pps_steps(spark, root):
    """Steps of very unequal widths: the tree tells them all, for a number and for classes."""
    lines = table(spark, root, "lineitem").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey").alias("key"),
        "l_quantity",
        F.expr(STEPS).cast("double").alias("step"),
        F.concat(F.lit("band "), F.expr(STEPS).cast("string")).alias("band"),
    )
    scores = power.pps_matrix(lines, "key", ["l_quantity", "step"], ["band"])
    return rounded(scores.where("x = 'l_quantity' AND y <> x"), "score")


def _pps(spark, root):
    orders = table(spark, root, "orders").select("o_orderkey", *PPS_NUM, *PPS_CAT)
    return power.pps_matrix(orders, "o_orderkey", PPS_NUM, PPS_CAT)


@query("pps_matrix", "M9 J4 V7", pps_sql())
def pps_matrix(spark, root):
    return rounded(_pps(spark, root), "score")


@query(
    "pps_pivot",
    "M9 D5 V7",
    "PIVOT (" + pps_sql() + ") ON y IN (" + ", ".join(f"'{c}'" for c in PPS_NUM + PPS_CAT) + ") USING max(score)",
)
def pps_pivot(spark, root):
    return rounded(power.pps_wide(_pps(spark, root)), *PPS_NUM, *PPS_CAT)
