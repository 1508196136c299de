"""Queries that fit models."""

from __future__ import annotations

from pyspark.sql import functions as F

from statloom.operators import classify, evaluate, features, forest, kernels, linear
from statloom.plans.features import HASH
from statloom.plans.profiling import MEASURES, rounded
from statloom.plans.registry import query
from statloom.session import materialise
from statloom.sources.tables import table

X, Y = ["l_quantity", "l_discount"], "l_extendedprice"

NORMAL_EQUATIONS = """
    WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS m1, avg(l_discount) AS m2, avg(l_extendedprice) AS my,
                      var_pop(l_quantity) + {a} / count(*) AS a, var_pop(l_discount) + {a} / count(*) AS d,
                      covar_pop(l_quantity, l_discount) AS b, covar_pop(l_quantity, l_extendedprice) AS p,
                      covar_pop(l_discount, l_extendedprice) AS q FROM lineitem),
    w AS (SELECT *, (d * p - b * q) / (a * d - b * b) AS w1, (a * q - b * p) / (a * d - b * b) AS w2 FROM m)
    SELECT 'intercept' AS term, round(my - w1 * m1 - w2 * m2, 2) AS coefficient FROM w
    UNION ALL SELECT 'l_quantity', round(w1, 2) FROM w UNION ALL SELECT 'l_discount', round(w2, 2) FROM w
"""


def eliminate(name: str, size: int) -> list[str]:
    """Common table expressions that solve the system (a<i>_<j>, right side a<i>_<size>) of `name`: one per
    pivot. The last, `name`_<size>, holds the solution as a<i>_<size>."""
    steps = []
    for k in range(size):
        cells = []
        for i in range(size):
            for j in range(k + 1, size + 1):
                cells.append(f"a{k}_{j} / a{k}_{k} AS a{k}_{j}" if i == k else f"a{i}_{j} - a{i}_{k} * a{k}_{j} / a{k}_{k} AS a{i}_{j}")
        steps.append(f"{name}_{k + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM {name}_{k})")
    return steps


def terms(spark, fit, places=2):
    rows = [("intercept", float(fit.intercept)), *zip(fit.cols, map(float, fit.coef))]
    frame = spark.createDataFrame(rows, "term string, coefficient double")
    return frame.withColumn("coefficient", F.round("coefficient", places))


@query("ols", "L1 M13", NORMAL_EQUATIONS.format(a=0))
def ols(spark, root):
    return terms(spark, linear.ols(table(spark, root, "lineitem"), X, Y))


@query("ridge", "L3", NORMAL_EQUATIONS.format(a="1000.0"))
def ridge(spark, root):
    return terms(spark, linear.ridge(table(spark, root, "lineitem"), X, Y, alpha=1000.0))


@query(
    "ridge_loo",
    "L3",
    """
    WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS v,
                      covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem),
    w AS (SELECT *, n * c / (n * v + alpha) AS w FROM m, (VALUES (0.1), (1.0), (1e7)) t(alpha))
    SELECT alpha::double AS alpha,
           round(avg(((l_extendedprice - my - w * (l_quantity - mx))
                      / (1 - 1 / n - (l_quantity - mx) ** 2 / (n * v + alpha))) ** 2) / 1e6, 4) AS loo_error
    FROM lineitem, w GROUP BY 1
    """,
)
def ridge_loo(spark, root):
    """Leave-one-out error per penalty, from which the penalty is chosen."""
    _, scores = linear.ridge_cv(table(spark, root, "lineitem"), ["l_quantity"], Y, [0.1, 1.0, 1e7])
    rows = [(float(a), float(e) / 1e6) for a, e in scores.items()]
    return rounded(spark.createDataFrame(rows, "alpha double, loo_error double"), "loo_error")


@query(
    "lasso",
    "L4",
    """
    WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS v,
                      covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem),
    w AS (SELECT *, sign(c) * greatest(abs(c) - 50.0, 0) / v AS w FROM m)
    SELECT 'intercept' AS term, round(my - w * mx, 2) AS coefficient FROM w
    UNION ALL SELECT 'l_quantity', round(w, 2) FROM w
    """,
)
def lasso(spark, root):
    """One feature, where the solution is the soft threshold."""
    return terms(spark, linear.lasso(table(spark, root, "lineitem"), ["l_quantity"], Y, alpha=50.0))


LINES_WITH_FOLD = f"(SELECT *, {HASH.format(key='l_orderkey', digits=8)} % 5 AS fold FROM lineitem)"


@query(
    "lasso_path",
    "L4",
    f"""
    WITH m AS (SELECT fold, count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS v,
                      var_pop(l_extendedprice) AS vy, covar_pop(l_quantity, l_extendedprice) AS c
               FROM {LINES_WITH_FOLD} GROUP BY 1),
    t AS (SELECT f AS held, avg(l_quantity) AS tx, avg(l_extendedprice) AS ty, var_pop(l_quantity) AS tv,
                 covar_pop(l_quantity, l_extendedprice) AS tc
          FROM {LINES_WITH_FOLD}, range(5) r(f) WHERE fold <> f GROUP BY 1),
    a AS (SELECT i, abs(c) * power(0.001, i / 99.0) AS alpha
          FROM (SELECT covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem), range(100) r(i)),
    w AS (SELECT *, sign(tc) * greatest(abs(tc) - alpha, 0) / tv AS w FROM m JOIN t ON fold = held, a)
    SELECT i AS step, round(any_value(alpha), 4) AS alpha,
           round(avg(vy + w * w * v - 2 * w * c + ((my - ty) - w * (mx - tx)) ** 2) / 1e6, 4) AS cv_error
    FROM w GROUP BY 1
    """,
)
def lasso_path(spark, root):
    """Cross-validated error along the default penalty path."""
    lines = table(spark, root, "lineitem").withColumn("fold", features.key_hash(F.col("l_orderkey")) % 5)
    _, path = linear.lasso_cv(lines, ["l_quantity"], Y, "fold")
    rows = [(i, a, e / 1e6) for i, (a, e) in enumerate(path.items())]
    return rounded(spark.createDataFrame(rows, "step bigint, alpha double, cv_error double"), "alpha", "cv_error")


def raw_lines(spark, root):
    return table(spark, root, "lineitem").transform(features.interaction, "l_quantity", "l_discount", "mix")


def prepared_lines(lines, fit_on):
    """Scaled numbers and one-hot flags next to the price, with what is learnt from `fit_on`."""
    numbers = ["l_quantity", "l_discount", "l_tax", "mix"]
    return features.column_transform(lines, numbers, ["l_returnflag"], keep=["l_orderkey", Y], fit_on=fit_on)


def fitted_lines(lines):
    """Models of the training rows, and the test rows under the preparation fitted to training rows."""
    raw_train, raw_test = features.random_split(lines, "l_orderkey", 0.2)
    train, test = (prepared_lines(d, raw_train) for d in (raw_train, raw_test))
    cols = [c for c in train.columns if c not in ("l_orderkey", Y)]
    plain = [c for c in cols if c != "mix"]
    fold = train.withColumn("fold", features.key_hash(F.col("l_orderkey"), "fold") % 5)
    fits = {
        "linear": linear.ols(train, plain, Y),
        "with interaction": linear.ols(train, cols, Y),
        "ridge": linear.ridge_cv(train, cols, Y)[0],
        "lasso": linear.lasso_cv(fold, cols, Y, "fold")[0],
    }
    return fits, test


HELD = HASH.format(key="l_orderkey", digits=8) + " % 100 < 20"
FLAGS = ["N", "R"]
NUMBERS = ["l_quantity", "l_discount", "l_tax", "mix"]


def least_squares_sql(rows: str, names: list[str]) -> str:
    """CTEs that fit z1, z2, ... and y of the query `rows` by normal equations; `fit_<size>` holds a<i>_<size>."""
    size = len(names)
    cells = [f"covar_pop(z{i}, z{j}) AS a{i}_{j}" for i in range(size) for j in range(size)]
    cells += [f"covar_pop(z{i}, y) AS a{i}_{size}" for i in range(size)]
    return ",\n".join([f"fit_0 AS MATERIALIZED (SELECT {', '.join(cells)} FROM ({rows}))", *eliminate("fit", size)])


COEF_NAMES = [*NUMBERS, *[f"l_returnflag_{v}" for v in FLAGS]]
SCALED_LINES = (
    "SELECT l_extendedprice AS y, held, "
    + ", ".join(f"({c} - avg({c}) FILTER (fit) OVER ()) / stddev_pop({c}) FILTER (fit) OVER () AS z{i}" for i, c in enumerate(NUMBERS))
    + ", "
    + ", ".join(f"(l_returnflag = '{v}')::int::double AS z{i}" for i, v in enumerate(FLAGS, len(NUMBERS)))
    + " FROM (SELECT *, l_quantity * l_discount AS mix, {fit} AS fit, {held} AS held FROM lineitem)"
)


@query(
    "coef_table",
    "E11 O4 L2 M8",
    f"""
    WITH r AS MATERIALIZED ({SCALED_LINES.format(fit="true", held="false")}), {least_squares_sql("SELECT * FROM r", COEF_NAMES)}
    SELECT unnest({COEF_NAMES}) AS feature, round(unnest([{", ".join(f"a{i}_6" for i in range(6))}]), 4) AS coefficient FROM fit_6
    """,
)
def coef_table(spark, root):
    lines = raw_lines(spark, root)
    data = prepared_lines(lines, lines)
    cols = [c for c in data.columns if c not in ("l_orderkey", Y)]
    fit = linear.ols(data, cols, Y)
    return rounded(evaluate.coefficient_table(spark, fit.cols, fit.coef), "coefficient")


@query(
    "interaction_metrics",
    "L2 E10 L12 E1 E2 E3 M1 M7",
    f"""
    WITH r AS MATERIALIZED ({SCALED_LINES.format(fit=f"NOT ({HELD})", held=HELD)}),
    {least_squares_sql("SELECT * FROM r WHERE NOT held", COEF_NAMES)},
    c AS (SELECT avg(y) AS my, {", ".join(f"avg(z{i}) AS m{i}" for i in range(6))} FROM r WHERE NOT held),
    p AS (SELECT y, my + {" + ".join(f"a{i}_6 * (z{i} - m{i})" for i in range(6))} AS p FROM r, c, fit_6 WHERE held)
    SELECT 'with interaction' AS model, round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) ** 2)), 3) AS rmse,
           round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2 FROM p
    """,
)
def interaction_metrics(spark, root):
    """Least squares with the interaction, fitted and prepared on training rows, on the test rows."""
    raw_train, raw_test = features.random_split(raw_lines(spark, root), "l_orderkey", 0.2)
    train, test = (prepared_lines(d, raw_train) for d in (raw_train, raw_test))
    cols = [c for c in train.columns if c not in ("l_orderkey", Y)]
    found = evaluate.compare_models(test, Y, {"with interaction": linear.ols(train, cols, Y).predict()})
    return found.withColumns({"mae": F.round("mae", 3), "rmse": F.round("rmse", 3), "r2": F.round("r2", 6)})


@query("model_comparison", "E10 L1 L2 L3 L4 L12")
def model_comparison(spark, root):
    fits, test = fitted_lines(raw_lines(spark, root))
    return rounded(
        evaluate.compare_models(test, Y, {k: f.predict() for k, f in fits.items()}), "mae", "rmse", "r2"
    )


DOC_FEATURES = ["n_chars", "n_words", "n_lines", "lang_en", "lang_es", "lang_fr"]


@query(
    "lasso_optimality",
    "L4 L3 L12",
    f"SELECT unnest({COEF_NAMES}) AS feature, true AS optimal",
)
def lasso_optimality(spark, root):
    """The lasso of the cross-validated penalty on six features: the mean product of each feature with
    the residual is the penalty, with the sign of its coefficient, or smaller where that is zero."""
    lines = raw_lines(spark, root)
    data = prepared_lines(lines, lines).withColumn("fold", features.key_hash(F.col("l_orderkey"), "fold") % 5)
    cols = [c for c in data.columns if c not in ("l_orderkey", "fold", Y)]
    fit, _ = linear.lasso_cv(data, cols, Y, "fold")
    rest = F.col(Y) - fit.predict()
    slopes = data.agg(*[F.covar_pop(c, rest).alias(c) for c in cols]).first()
    near = lambda a, b: abs(a - b) <= 1e-6 * max(1.0, abs(b))
    rows = []
    for c, w in zip(cols, fit.coef):
        s, a = slopes[c], fit.penalty
        rows.append((c, near(s, a if w > 0 else -a) if w else abs(s) <= a * (1 + 1e-9)))
    return spark.createDataFrame([(c, bool(o)) for c, o in rows], "feature string, optimal boolean")


def labelled_documents(spark, root):
    """Standardised features of the labelled documents, their label and an exact stratified flag."""
    docs = table(spark, root, "documents").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("n_chars"),
        F.size(F.split("text", r"\s+")).cast("double").alias("n_words"),
        F.size(F.split("text", "\n")).cast("double").alias("n_lines"),
        *[(F.col("lang") == v).cast("double").alias(f"lang_{v}") for v in ("en", "es", "fr")],
    )
    joined = table(spark, root, "labels").join(docs, "doc_id")
    flagged = features.stratified_flag(joined, "quality", "doc_id", 0.2)
    return features.standard_scale(flagged, DOC_FEATURES, fit_on=flagged.where("NOT is_test")).withColumn(
        "label", F.col("quality").cast("double")
    )


def fit_logistic(spark, root):
    data = materialise(labelled_documents(spark, root), "documents")
    fit = classify.fit_logistic(data.where("NOT is_test"), DOC_FEATURES, "label")
    scored = data.where("is_test").select("doc_id", "quality", fit.probability().alias("score"))
    return fit, scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def logistic_sql(size: int, steps: int = 10) -> str:
    """Newton's method on `train` (x0 = 1, x1, ..., y), from which CTEs w<step> (b0, b1, ...) follow."""
    parts = ["w0 AS MATERIALIZED (SELECT " + ", ".join(f"0.0::double AS b{i}" for i in range(size)) + ")"]
    for s in range(1, steps + 1):
        z = " + ".join(f"b{i} * x{i}" for i in range(size))
        cells = []
        for i in range(size):
            for j in range(size):
                ridge = " + 1" if i == j and i else ""
                cells.append(f"sum(p * (1 - p) * x{i} * x{j}){ridge} AS a{i}_{j}")
            cells.append(f"sum((y - p) * x{i}){f' - any_value(b{i})' if i else ''} AS a{i}_{size}")
        parts.append(f"n{s}_0 AS MATERIALIZED (SELECT {', '.join(cells)} FROM (SELECT *, 1 / (1 + exp(-({z}))) AS p FROM train, w{s - 1}))")
        parts += eliminate(f"n{s}", size)
        parts.append(f"w{s} AS MATERIALIZED (SELECT {', '.join(f'b{i} + a{i}_{size} AS b{i}' for i in range(size))} FROM w{s - 1}, n{s}_{size})")
    return ",\n".join(parts)


SIX = len(DOC_FEATURES)
LOGISTIC_SQL = f"""
    WITH d AS (SELECT l.doc_id, l.quality, n_chars::double AS f1, len(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'))::double AS f2,
                      len(string_split(text, chr(10)))::double AS f3, (lang = 'en')::int::double AS f4,
                      (lang = 'es')::int::double AS f5, (lang = 'fr')::int::double AS f6,
                      row_number() OVER (PARTITION BY l.quality ORDER BY {HASH.format(key="l.doc_id", digits=13)}, l.doc_id)
                      <= floor(0.2 * count(*) OVER (PARTITION BY l.quality) + 0.5) AS is_test
               FROM labels l JOIN documents USING (doc_id)),
    m AS (SELECT {", ".join(f"avg(f{i}) AS m{i}, stddev_pop(f{i}) AS s{i}" for i in range(1, SIX + 1))} FROM d WHERE NOT is_test),
    scaled AS MATERIALIZED (SELECT doc_id, quality, is_test, quality::double AS y, 1.0::double AS x0,
                      {", ".join(f"(f{i} - m{i}) / CASE WHEN s{i} > 0 THEN s{i} ELSE 1 END AS x{i}" for i in range(1, SIX + 1))} FROM d, m),
    train AS MATERIALIZED (SELECT * FROM scaled WHERE NOT is_test),
    {logistic_sql(SIX + 1)},
    scored AS (SELECT doc_id, quality, 1 / (1 + exp(-({" + ".join(f"b{i} * x{i}" for i in range(SIX + 1))}))) AS score
               FROM scaled, w10 WHERE is_test),
    called AS MATERIALIZED (SELECT doc_id, quality, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS predicted FROM scored),
    odds AS (SELECT unnest({DOC_FEATURES}) AS feature, unnest([{", ".join(f"b{i}" for i in range(1, SIX + 1))}]) AS coefficient FROM w10)
"""


@query("logistic", "L5 L12 F14 M2 M3 M13", LOGISTIC_SQL + "SELECT doc_id, quality, round(score, 4) AS score, predicted FROM called")
def logistic(spark, root):
    return rounded(fit_logistic(spark, root)[1], "score")


@query(
    "odds_ratios",
    "E12 E11 X5",
    LOGISTIC_SQL + "SELECT feature, round(coefficient, 4) AS coefficient, round(exp(coefficient), 4) AS odds_ratio FROM odds",
)
def odds_ratios(spark, root):
    fit, _ = fit_logistic(spark, root)
    report = evaluate.coefficient_table(spark, DOC_FEATURES, fit.coef, odds=True)
    return rounded(report, "coefficient", "odds_ratio")


DIMENSIONS = [f"d{i}" for i in range(64)]


def embedded(spark, root):
    """Class 0 against the rest, on all dimensions of the embeddings scaled by the training rows."""
    wide = table(spark, root, "embeddings").select(
        "vec_id",
        F.when(F.col("label") == 0, 1.0).otherwise(0.0).alias("label"),
        *[F.get("embedding", i).cast("double").alias(n) for i, n in enumerate(DIMENSIONS)],
    )
    flagged = features.stratified_flag(wide, "label", "vec_id", 0.2)
    scaled = features.standard_scale(flagged, DIMENSIONS, fit_on=flagged.where("NOT is_test"))
    # The optimizer of a machine passes over its rows many times.
    kept = materialise(scaled, "embedded")
    return kept.where("NOT is_test").drop("is_test"), kept.where("is_test").drop("is_test"), DIMENSIONS


def svm(spark, root, kernel, **options):
    train, test, cols = embedded(spark, root)
    return classify.fit_kernel_svm(train, test, cols, "label", "vec_id", kernel, **options).select(
        "vec_id", "label", "prediction"
    )


@query("svm_linear", "L6 M12")
def svm_linear(spark, root):
    """Linear machine on the two leading components of the training rows."""
    train, test, cols = embedded(spark, root)
    plane = features.fit_pca(train, cols, 2, standardise=False)
    train, test = (d.select("vec_id", "label", *plane.columns()) for d in (train, test))
    scored = classify.fit_kernel_svm(train, test, ["pc1", "pc2"], "label", "vec_id", "linear")
    return scored.select("vec_id", "label", "prediction")


@query("svm_rbf", "L7")
def svm_rbf(spark, root):
    return svm(spark, root, "rbf", c=1.0, gamma=0.1)


@query("svm_poly", "L8")
def svm_poly(spark, root):
    return svm(spark, root, "poly")


@query("kernel_table", "L10 L6 L7 L8 E4 O3")
def kernel_table(spark, root):
    train, test, cols = embedded(spark, root)
    return classify.compare_kernels(train, test, cols, "label", "vec_id", ["linear", "poly", "rbf"])


@query(
    "svm_duality",
    "L6 L7 L8 L10",
    """
    WITH c AS (SELECT (label = 0) AS y, count(*) AS n FROM embeddings GROUP BY 1),
    t AS (SELECT sum(n - floor(0.2 * n + 0.5))::bigint AS n_train FROM c)
    SELECT kernel, n_train, true AS optimal, true AS bounded FROM t, (VALUES ('linear'), ('poly'), ('rbf')) k(kernel)
    """,
)
def svm_duality(spark, root):
    """Machines of three kernels, each with the proof that it is the best: a duality gap below a
    thousandth of its objective, that is positive, with no more support vectors than rows."""
    train, _, cols = embedded(spark, root)
    gamma = classify.gamma_of(linear.fit_moments(train, cols)[()], "scale")
    fits = kernels.fit(train, cols, "label", "vec_id", [kernels.Machine(k, 1.0, gamma) for k in ("linear", "poly", "rbf")])
    n = train.agg(F.count(F.lit(1))).scalar()
    return fits.report().select(
        "kernel",
        n.alias("n_train"),
        F.col("gap").between(-1e-9, kernels.GAP).alias("optimal"),
        F.col("support").between(1, n).alias("bounded"),
    )


@query("grid_search", "L9")
def grid_search(spark, root):
    train, _, cols = embedded(spark, root)
    return classify.grid_search(train, cols, "label", "vec_id")


@query("grid_best_predictions", "L9 E13")
def grid_best_predictions(spark, root):
    """The best setting of the grid, fitted again on all training rows, on the test rows."""
    train, test, cols = embedded(spark, root)
    best = classify.best_of_grid(train, test, cols, "label", "vec_id")
    return best.select("vec_id", "label", "prediction", "c", "gamma")


@query(
    "forest_flags",
    "L11",
    """
    SELECT count(*) AS n_rows, round(0.05, 2)::double AS share, true AS in_range, true AS flags_are_the_highest, 20::bigint AS planted_found
    FROM (SELECT 1 FROM lineitem UNION ALL SELECT 1 FROM range(20))
    """,
)
def forest_flags(spark, root):
    """Twenty lines far from all others among the rest: how many rows, which share is flagged, whether
    scores are in range, whether the flagged ones are the highest, and how many planted ones are."""
    lines = table(spark, root, "lineitem").select(F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("line"), *MEASURES)
    far = spark.range(20).select(
        F.concat(F.lit("far "), F.col("id").cast("string")).alias("line"),
        *[(F.lit(1e6) * (i + 1) + F.col("id")).alias(c) for i, c in enumerate(MEASURES)],
    )
    flagged = forest.flag_outliers(lines.unionByName(far), MEASURES, "line")
    out = F.col("outlier_flag") == -1
    # The flags are read once, so the summary is written and not the flagged lines.
    summary = flagged.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.avg(out.cast("int")), 2).alias("share"),
        ((F.min("score") > 0) & (F.max("score") <= 1)).alias("in_range"),
        (F.min(F.when(out, F.col("score"))) > F.max(F.when(~out, F.col("score")))).alias("flags_are_the_highest"),
        F.count_if(out & F.col("line").startswith("far ")).alias("planted_found"),
    )
    return materialise(summary, "flagged")


@query("isolation_forest", "L11")
def isolation_forest(spark, root):
    lines = (
        table(spark, root, "lineitem")
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *MEASURES)
        .withColumn("line_key", F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    )
    flagged = forest.flag_outliers(lines, MEASURES, "line_key")
    return rounded(flagged.drop("line_key"), "score")
