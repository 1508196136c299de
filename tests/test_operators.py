import math
from types import SimpleNamespace

import numpy as np
import pytest
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
    linear,
    profile,
    ranks,
)
from statloom.plans import models
from statloom.plans.catalogue import REGISTRY
from statloom.plans.reports import revenue
from statloom.session import materialise
from statloom.sources.tables import from_rows, integer_range
from statloom.streaming.scoring import Field, accepted, rejects

NAN = float("nan")


def lineitem(spark, root, rows):
    """A folder with a table of line items: order, line, quantity, price, discount, tax."""
    kinds = "l_orderkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double"
    table = spark.createDataFrame(rows, kinds).withColumns({"l_partkey": F.lit(1).cast("bigint"), "l_suppkey": F.lit(2).cast("bigint")})
    texts = {c: F.lit("N") for c in ("l_returnflag", "l_linestatus")}
    table.withColumns(texts | {"l_shipdate": F.lit("1995-01-01").cast("timestamp_ntz")}).write.parquet(f"{root}/lineitem.parquet")
    return str(root)


ODD_LINES = [(i, 1 + i % 7, 1.0 + i % 50, 900.0 + 37.0 * (i * i % 997), (i % 11) / 100, (i % 9) / 100) for i in range(600)]
ODD_LINES += [*ODD_LINES[:40], (None, 1, 5.0, 1000.0, 0.01, 0.02), (None, None, None, None, None, None), (7, 2, None, 2000.0, 0.03, None), (8, 3, NAN, 3000.0, NAN, 0.01)]


def numbers(spark, values, parts=4):
    return spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "v double").repartition(parts)


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


@pytest.mark.parametrize(
    "values",
    [
        [1, 2, 3, 10],
        [5],
        [-3, -1, 0, 0, 0, 7, None, NAN],
        [1e12, 1, 2, 3, 4, 5, -1e9],
        [1.7e9 + i for i in range(50)],
        [0.0] * 40 + [1, 2],
        list(np.random.default_rng(1).lognormal(0, 3, 500)),
        [1e-12 * i for i in range(30)],
    ],
)
def test_quantiles_equal_linear_interpolation(spark, values):
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    row = ranks.quantiles(numbers(spark, values), ["v"], probs).first()
    kept = [v for v in values if v is not None and not math.isnan(v)]
    for name, p in probs.items():
        assert row[name] == pytest.approx(np.quantile(kept, p), rel=1e-12, abs=1e-15)


@pytest.mark.parametrize("few", [True, False])
def test_grouped_quantiles_with_a_dominating_group(spark, few):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        ((F.col("id") * 7919) % 1009).cast("double").alias("v"),
    )
    got = as_dict(ranks.quantiles(df, ["v"], {"m": 0.5}, ["k"], few_groups=few), "k", "m")
    pdf = df.toPandas().groupby("k")["v"].median()
    assert got == pytest.approx(pdf.to_dict())


def test_results_do_not_depend_on_partitions(spark):
    values = list(np.random.default_rng(2).normal(0, 5, 400))
    seen = set()
    for parts in (1, 4, 64):
        df = numbers(spark, values, parts)
        seen.add((ranks.quantiles(df, ["v"], {"m": 0.31}).first()["m"], ranks.modes(df, ["v"]).first()["mode"]))
    assert len(seen) == 1


def test_running_totals(spark):
    df = spark.createDataFrame([(3.0, 1), (1.0, 2), (2.0, 5), (900.0, 1)], "value double, n bigint")
    got = as_dict(ranks.running_totals(df, ["n"]), "value", "n_before")
    assert got == {1.0: 0, 2.0: 2, 3.0: 7, 900.0: 8}


def test_missing_values_and_sentinels(spark):
    df = from_rows(spark, [[1.0, " ?"], [NAN, "?"], [None, "a"]], "x double, s string")
    assert as_dict(profile.null_counts(df), "column", "nulls") == {"x": 2, "s": 0}
    assert profile.sentinel_counts(df, " ?").first()["hits"] == 1
    filled = clean.fill_mode(clean.sentinel_to_null(clean.trim_strings(df), ["s"], "?"), ["s"])
    assert {r["s"] for r in filled.collect()} == {"a"}


def test_group_sum_of_missing_values_is_zero(spark):
    df = from_rows(spark, [["a", None], ["a", None], ["b", 2.0], [None, 5.0]], "k string, v double")
    assert as_dict(profile.group_sum(df, "k", "v", "s"), "k", "s") == {"a": 0.0, "b": 2.0}


def test_hospital_chain(spark):
    visits = from_rows(
        spark,
        [
            [101, "Cardiology", "Dr. Smith", 5000.0, 1],
            [102, "Neurology", "Dr. John", None, 2],
            [103, "Orthopedics", "Dr. Lee", 7500.0, 3],
            [104, "Cardiology", "Dr. Smith", 6200.0, 4],
            [105, "Dermatology", "Dr. Rose", None, 5],
            [101, "Cardiology", "Dr. Smith", 5000.0, 6],
        ],
        "id int, department string, doctor string, bill double, seen int",
    )
    billing = from_rows(
        spark,
        [[101, 2000.0, 3000.0], [102, 1500.0, 3500.0], [103, 2500.0, 5000.0], [104, 3000.0, 3200.0], [105, 1000.0, 4000.0]],
        "id int, insured double, final double",
    )
    additions = from_rows(
        spark,
        [[106, "Cardiology", "Dr. Rao", 4500.0], [107, "Neurology", "Dr. Mehta", 5200.0]],
        "id int, department string, doctor string, bill double",
    )
    updates = from_rows(spark, [[106, 1800.0, 2700.0], [107, 2100.0, 3100.0]], "id int, insured double, final double")
    before, after, doctors = revenue(visits, billing, additions, updates)
    assert as_dict(before, "department", "revenue") == {
        "Cardiology": 16200.0, "Dermatology": 0.0, "Neurology": 0.0, "Orthopedics": 7500.0,
    }
    assert as_dict(after, "department", "revenue") == pytest.approx(
        {"Cardiology": 15700.0, "Dermatology": 6233.3, "Neurology": 11433.3, "Orthopedics": 7500.0}
    )
    assert as_dict(doctors, "doctor", "final_mean") == {
        "Dr. John": 3500.0, "Dr. Lee": 5000.0, "Dr. Mehta": 3100.0, "Dr. Rao": 2700.0, "Dr. Rose": 4000.0, "Dr. Smith": 3100.0,
    }


def test_cost_hypothesis(spark):
    mu0, sigma = infer.cost_hypothesis(1000, 5, 600, 25)
    df = integer_range(spark, 0, 25).select(F.lit(3050.0).alias("cost"))
    row = infer.z_test(df, "cost", mu0, sigma).first()
    assert (mu0, row["z"], row["decision"]) == (4000, -38.0, "fail to reject")


def test_t_interval_without_freedom(spark):
    row = infer.t_interval(numbers(spark, [4.0]), "v").first()
    assert row["lower"] is None and row["mean"] == 4.0


def test_capping_is_idempotent(spark):
    df = numbers(spark, [1, 2, 3, 4, 100, None])
    once = clean.cap_outliers(df, ["v"])
    assert once.agg(F.max("v")).first()[0] == 7.0
    assert sorted(r[0] for r in clean.cap_outliers(once, ["v"]).dropna().collect()) == [1, 2, 3, 4, 7]
    assert once.where("v IS NULL").count() == 1


def test_scaling_of_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert sorted(map(tuple, features.standard_scale(df, ["a", "b"]).collect())) == [(-1.0, 0.0), (1.0, 0.0)]
    assert sorted(map(tuple, features.minmax_scale(df, ["a", "b"]).collect())) == [(0.0, 0.0), (1.0, 0.0)]


def test_stratified_flag_is_exact(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") % 10 == 0, "rare").otherwise("hot").alias("y"))
    got = features.stratified_flag(df, "y", "id").groupBy("y").agg(F.count_if("is_test").alias("n"))
    assert as_dict(got, "y", "n") == {"rare": 20, "hot": 180}


def test_encoders(spark):
    df = from_rows(spark, [["b"], ["a"], ["c"], [None]], "s string")
    hot = features.one_hot(df.withColumn("k", F.col("s")), ["s"])
    assert {r["k"]: (r["s_b"], r["s_c"]) for r in hot.collect()} == {
        "a": (0, 0), "b": (1, 0), "c": (0, 1), None: (0, 0),
    }
    codes = features.label_encode(df.withColumn("k", F.col("s")), ["s"])
    assert as_dict(codes, "k", "s") == {"a": 0, "b": 1, "c": 2, None: None}
    joined = features.label_encode(df.withColumn("k", F.col("s")), ["s"], {"s": None})
    assert as_dict(joined, "k", "s") == as_dict(codes, "k", "s")


def test_saved_features_drop_the_first_category(spark):
    df = from_rows(spark, [[1.0, "a"], [2.0, "b"], [4.0, "c"]], "x double, s string")
    rows = features.feature_pipeline(["x"], ["s"]).fit(df).transform(df).collect()
    assert [r["features"].size for r in rows] == [3, 3, 3]
    assert list(rows[0]["features"])[1:] == [0.0, 0.0]


def test_drop_and_overwrite(spark):
    df = from_rows(spark, [[4000, 1], [None, 2]], "cc int, k int")
    assert edit.drop(df, ["nothing", "k"]).columns == ["cc"]
    out = edit.overwrite_where(df, F.col("cc") > 3000, "cc", 1600)
    assert as_dict(out, "k", "cc") == {1: 1600, 2: None}


def sample(spark, n=400, d=3, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1.0, 5.0, 0.2][:d] + 3
    y = x @ np.array([2.0, -1.0, 4.0][:d]) + 7 + rng.normal(size=n)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    names = [f"x{i}" for i in range(d)]
    df = spark.createDataFrame(rows, "id bigint, " + ", ".join(f"{c} double" for c in [*names, "y"]))
    return df, names, x, y


def test_linear_models_against_their_definitions(spark):
    df, names, x, y = sample(spark)
    a = np.c_[np.ones(len(y)), x]
    w = np.linalg.lstsq(a, y, rcond=None)[0]
    fit = linear.ols(df, names, "y")
    assert np.allclose([fit.intercept, *fit.coef], w)
    xc, yc = x - x.mean(0), y - y.mean()
    best, scores = linear.ridge_cv(df, names, "y", [0.1, 10.0])
    for alpha, got in scores.items():
        errors = []
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            mx, my = x[keep].mean(0), y[keep].mean()
            v = np.linalg.solve((x[keep] - mx).T @ (x[keep] - mx) + alpha * np.eye(3), (x[keep] - mx).T @ (y[keep] - my))
            errors.append((y[i] - my - (x[i] - mx) @ v) ** 2)
        # The leverage shortcut treats the intercept as free, so it is exact up to the penalty's share.
        assert got == pytest.approx(np.mean(errors), rel=1e-3)
    lasso = linear.lasso(df, names, "y", 0.5)
    grad = xc.T @ (yc - xc @ lasso.coef) / len(y)
    for g, c in zip(grad, lasso.coef):
        assert abs(g - 0.5 * np.sign(c)) < 1e-6 if c else abs(g) <= 0.5 + 1e-9
    predicted = df.select(fit.predict().alias("p")).agg(F.avg("p")).first()[0]
    assert predicted == pytest.approx(y.mean())


def test_moments_of_wide_tables(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 15))
    names = [f"c{i}" for i in range(15)]
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], names)
    m = linear.fit_moments(df, names)[()]
    assert m.n == 200 and np.allclose(m.mean, x.mean(0)) and np.allclose(m.cov, np.cov(x.T, ddof=0))
    fit = features.fit_pca(df, names, 2)
    v = df.select(*fit.columns()).agg(F.var_samp("pc1"), F.var_samp("pc2"), F.covar_samp("pc1", "pc2")).first()
    assert np.allclose(v[:2], fit.variance) and abs(v[2]) < 1e-9


def rings(spark, n=300):
    rng = np.random.default_rng(5)
    r = np.where(np.arange(n) % 2 == 0, 1.0, 3.0) + rng.normal(0, 0.1, n)
    t = rng.uniform(0, 2 * np.pi, n)
    rows = [(i, float(a), float(b), float(i % 2)) for i, (a, b) in enumerate(zip(r * np.cos(t), r * np.sin(t)))]
    return spark.createDataFrame(rows, "id bigint, a double, b double, y double").coalesce(1)


def test_gaussian_machine_separates_rings(spark):
    df = rings(spark)
    train, test = features.random_split(df, "id", 0.3)
    curved = classify.fit_kernel_svm(train, test, ["a", "b"], "y", "id", "rbf", c=10.0, gamma=0.5)
    assert classify.accuracy(curved, "y") > 0.95
    straight = classify.fit_kernel_svm(train, test, ["a", "b"], "y", "id", "linear")
    assert classify.accuracy(straight, "y") < 0.8


def test_grid_search(spark):
    found = classify.grid_search(rings(spark, 120), ["a", "b"], "y", "id", cs=[1.0, 10.0], gammas=[0.5], folds=2).collect()
    assert [r["rank"] for r in found] == [1, 2] and found[0]["accuracy"] >= found[1]["accuracy"] > 0.5


def test_forest_finds_planted_outliers(spark):
    rng = np.random.default_rng(6)
    x = np.r_[rng.normal(size=(990, 2)), rng.normal(size=(10, 2)) * 0.1 + 8]
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id bigint, a double, b double")
    flagged = forest.flag_outliers(df, ["a", "b"], "id", n_trees=40).toPandas()
    assert (flagged["outlier_flag"] == -1).sum() == 50
    assert (flagged[flagged["id"] >= 990]["outlier_flag"] == -1).all()
    assert flagged["score"].between(0, 1).all()
    again = forest.flag_outliers(df.repartition(13), ["a", "b"], "id", n_trees=40).toPandas()
    assert flagged.sort_values("id")["score"].to_list() == again.sort_values("id")["score"].to_list()


def test_roc_is_monotone_and_auc_agrees(spark):
    rng = np.random.default_rng(7)
    y, s = rng.integers(0, 2, 300), np.round(rng.normal(size=300), 1)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, s double")
    curve = sorted((r["fpr"], r["tpr"]) for r in evaluate.roc_curve(df, "y", "s").collect())
    assert curve[0] == (0.0, 0.0) and curve[-1] == (1.0, 1.0)
    assert all(b[1] >= a[1] for a, b in zip(curve, curve[1:]))
    area = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(curve, curve[1:]))
    assert evaluate.roc_auc(df, "y", "s").first()["auc"] == pytest.approx(area)


def test_confusion_has_absent_pairs(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    got = {(r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion(df, "y", "p").collect()}
    assert got == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert evaluate.binary_metrics(df, "y", "p").first().asDict() == {
        "accuracy": 0.5, "precision": 0.0, "recall": 0.0, "f1": 0.0,
    }


def test_histogram_of_a_constant(spark):
    got = chartdata.histogram(numbers(spark, [3, 3, None]), ["v"], 4).orderBy("bin").collect()
    assert [r["n"] for r in got] == [2, 0, 0, 0]


def test_contract(spark):
    fields = [Field("age", 1, 120, 33, "int"), Field("bmi", 0.0, 80.0, 30.0)]
    df = from_rows(spark, [["5", 20.0], [None, None], ["200", 10.0], ["x", -1.0]], "age string, bmi double")
    assert sorted(map(tuple, accepted(df, fields).collect())) == [(5, 20.0), (33, 30.0)]
    assert sorted(r["problems"] for r in rejects(df, fields).collect()) == [
        ["age: above 120"], ["age: not int", "bmi: below 0"],
    ]


def test_plans_keep_raw_rows_off_a_single_partition(spark, root):
    """No global sort or window over raw rows: the only single-partition exchanges carry one-row
    aggregates or cell counts."""
    from statloom.sources.tables import table

    lines = table(spark, root, "lineitem")
    plan = profile.describe(lines, ["l_quantity", "l_tax"])._jdf.queryExecution().toString()
    assert "RangePartitioning" not in plan and "CartesianProduct" not in plan
    scan = table(spark, root, "lineitem").select("l_tax").where("l_quantity > 5")
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,5.0)" in text and "l_extendedprice" not in text


def test_forest_flags_reads_and_writes_the_lines_no_more_than_needed(spark, tmp_path, monkeypatch):
    root, written, scored = lineitem(spark, tmp_path, ODD_LINES), [], []

    def flag_outliers(*args):
        scored.append(forest.flag_outliers(*args))
        return scored[-1]

    def write(df, name):
        written.append(df)
        return materialise(df, name)

    monkeypatch.setattr(models, "forest", SimpleNamespace(flag_outliers=flag_outliers))
    monkeypatch.setattr(models, "materialise", write)
    found = REGISTRY["forest_flags"].run(spark, root).collect()
    # Beside the scores only the summary is written, which reads three columns of them.
    assert [df.count() for df in written] == [1]
    out = scored[0].toPandas()
    worst = out["outlier_flag"] == -1
    assert found[0].asDict() == {
        "n_rows": len(ODD_LINES) + 20,
        "share": round(worst.mean(), 2),
        "in_range": True,
        "flags_are_the_highest": bool(out["score"][worst].min() > out["score"][~worst].max()),
        "planted_found": 20,
    }


def test_statistics_of_one_table_share_a_scan(spark, tmp_path):
    spark.createDataFrame([(float(i % 13), float(i * i % 101), i % 3) for i in range(300)] + [(NAN, None, 1), (None, 2.0, None)], "a double, b double, g int").write.parquet(str(tmp_path / "t"))
    df = spark.read.schema("a double, b double, g int").parquet(str(tmp_path / "t"))
    quartiles = ranks.quantiles(df, ["a", "b"], profile.QUARTILES)
    label = F.col("g") == 1
    sums = materialise(profile.shared_sums(df, ["a", "b"], "g", label, quartiles), "sums")
    parts = [
        profile.describe(df, ["a", "b"], quartiles, sums),
        profile.outlier_counts(df, ["a", "b"], sums=sums),
        profile.correlations(df, ["a", "b"], sums),
        profile.target_correlations(df, "g", ["a", "b"], sums),
        profile.top_correlated(df, "g", ["a", "b"], 1, sums),
        profile.subset_class_share(df, "a", "b", label, sums=sums),
    ]
    apart = [
        profile.describe(df, ["a", "b"]),
        profile.outlier_counts(df, ["a", "b"]),
        profile.correlations(df, ["a", "b"]),
        profile.target_correlations(df, "g", ["a", "b"]),
        profile.top_correlated(df, "g", ["a", "b"], 1),
        profile.subset_class_share(df, "a", "b", label),
    ]
    for part, other in zip(parts, apart, strict=True):
        assert part.dtypes == other.dtypes and sorted(map(str, part.collect())) == sorted(map(str, other.collect()))
        assert not {*part.inputFiles()} & {*df.inputFiles()} and {*other.inputFiles()} >= {*df.inputFiles()}


def test_statistics_per_group_from_sums_of_the_groups(spark):
    rows = [(i % 3 + 1, float(i % 7), float(i * i % 11)) for i in range(200)] + [(1, NAN, None), (2, None, 1.0), (None, 1.0, 2.0), (4, None, None)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    groups = profile.group_moments(df, "g", ["a", "b"])
    counts = groups.where("column = 'a'").select("g", F.col("rows").alias("n"))
    text = lambda found: sorted(map(str, found.collect()))
    assert text(profile.value_counts(df, "g", counts)) == text(profile.value_counts(df, "g"))
    assert text(infer.anova(df, "g", ["a", "b"], groups)) == text(infer.anova(df, "g", ["a", "b"]))
    assert text(profile.group_mean_median(df, "g", ["a", "b"], True, groups)) == text(profile.group_mean_median(df, "g", ["a", "b"]))


def test_eda_report_of_odd_lines(spark, tmp_path, monkeypatch):
    """Shared quartiles and sums give what every section would compute for itself."""
    root, calls = lineitem(spark, tmp_path, ODD_LINES), []
    quantiles = ranks.quantiles

    def counted(df, *args, **kwargs):
        calls.append("line" in df.columns and "tax" in df.columns)
        return quantiles(df, *args, **kwargs)

    monkeypatch.setattr(ranks, "quantiles", counted)
    found = {(r["section"], r["name"], r["measure"]): r["value"] for r in REGISTRY["eda_report"].run(spark, root).collect()}
    # The median of one fill, those for negatives, the quartiles of all sections, and the medians per class.
    assert len(calls) == 4
    data, cols = REGISTRY["clean_chain"].run(spark, root), ["quantity", "margin"]
    for r in profile.describe(data, cols).collect():
        assert all(found["describe", r["column"], s] == pytest.approx(r[s], abs=6e-5) for s in ("count", "mean", "std", "min", "q1", "median", "q3", "max"))
    for r in profile.outlier_counts(data, cols).collect():
        assert found["outliers", r["column"], "outliers"] == r["outliers"]
    for r in profile.value_counts(data, "line").collect():
        assert found["share", str(r["line"]), "n"] == r["n"]
    for r in profile.group_mean_median(data, "line", cols).collect():
        assert found[f"line {r['line']}", r["column"], "median"] == pytest.approx(r["median"], abs=6e-5)
    for r in infer.anova(data, "line", cols).collect():
        assert found["anova", r["column"], "f"] == pytest.approx(r["f"], abs=6e-4)
    for r in profile.subset_class_share(data, *cols, F.col("line") == 2).collect():
        assert found["subset", r["subset"], "n"] == r["n"]
