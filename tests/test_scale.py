"""Wide tables, missing values and lopsided data."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from statloom.functions import scalar
from statloom.operators import classify, clean, evaluate, features, infer, linear, power, profile, ranks, relate, stages


def test_numbers_of_doubles_keep_their_order(spark):
    rng = np.random.default_rng(0)
    odd = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, np.nextafter(2.0**-1022, 0), 1.7976931348623157e308, math.inf, -math.inf, 1.0, 2.0, 4.0]
    odd += [float(np.nextafter(2.0**k, d)) for k in range(-1000, 1001, 50) for d in (0, math.inf)] + [2.0**k for k in range(-1074, 1024)]
    values = np.array(odd + list(rng.normal(size=500) * 10.0 ** rng.integers(-300, 300, 500)))
    rows = spark.createDataFrame([(float(v),) for v in values], "value double")
    got = {r.value: r.number for r in rows.withColumn("number", ranks.sortable(F.col("value"))).collect()}
    bits = lambda v: int(np.float64(abs(v)).view(np.int64)) * (-1 if v < 0 else 1)
    assert all(number == bits(value) for value, number in got.items())


@pytest.mark.parametrize("kind", ["offset", "seconds", "outliers", "few", "negative"])
def test_selection_opens_small_cells_however_values_lie(spark, monkeypatch, kind):
    rng = np.random.default_rng(1)
    n = 60_000
    monkeypatch.setattr(ranks, "OPEN_ROWS", 500)
    x = {
        "offset": 1e6 + rng.random(n),
        "seconds": 1.7e9 + rng.random(n) * 3600,
        "outliers": np.concatenate([rng.random(n - 4), [1e300, -1e300, np.inf, -np.inf]]),
        "few": rng.integers(0, 3, n) + 1e9,
        "negative": -(1e6 + rng.random(n) ** 8),
    }[kind]
    rows = spark.createDataFrame(pd.DataFrame({"x": x, "g": np.arange(n) % 3}))
    opened = []
    counted = ranks.counted
    monkeypatch.setattr(ranks, "counted", lambda *a: opened.append(a[2]) or counted(*a))
    probs = {"a": 0.01, "b": 0.25, "c": 0.5, "d": 0.75, "e": 0.999}
    got = ranks.quantiles(rows, ["x"], probs).first()
    assert [got[p] for p in probs] == pytest.approx(list(np.quantile(x, list(probs.values()))), rel=1e-15)
    assert len(opened) <= 4
    for few in (True, False):
        for r in ranks.quantiles(rows, ["x"], probs, ["g"], few_groups=few).collect():
            assert [r[p] for p in probs] == pytest.approx(list(np.quantile(x[r.g::3], list(probs.values()))), rel=1e-15)


def test_running_totals_over_an_offset(spark):
    rng = np.random.default_rng(2)
    values = np.unique(1e9 + rng.random(20_000))
    frame = pd.DataFrame({"value": values, "n": rng.integers(1, 5, len(values))})
    got = ranks.running_totals(spark.createDataFrame(frame).repartition(7), ["n"]).toPandas().sort_values("value")
    assert (got["n_before"].to_numpy() == frame["n"].cumsum() - frame["n"]).all() and (got["n_total"] == frame["n"].sum()).all()


def test_nan_is_missing(spark):
    nan = float("nan")
    rows = spark.createDataFrame([(1.0, 2.0, "a"), (2.0, 4.1, "a"), (nan, 1.0, "a"), (4.0, nan, "b"), (7.0, 13.0, "b")], "x double, y double, g string")
    without = rows.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in "xy"], "g")
    same = lambda a, b: pd.testing.assert_frame_equal(a.toPandas(), b.toPandas())
    for fn in (
        lambda d: profile.describe(d, ["x", "y"]).orderBy("column"),
        lambda d: profile.correlations(d, ["x", "y"]).orderBy("x", "y"),
        lambda d: profile.wide_correlations(d, ["x", "y"]).orderBy("x", "y"),
        lambda d: profile.group_means(d, "g", ["x", "y"]).orderBy("g"),
        lambda d: profile.target_correlations(d, "y", ["x"]),
        lambda d: features.standard_scale(d, ["x"]),
        lambda d: features.minmax_scale(d, ["x"]),
        lambda d: ranks.extent(d, ["x", "y"]).select("x.*"),
        lambda d: profile.outlier_counts(d, ["x", "y"]).orderBy("column"),
        lambda d: profile.subset_class_share(d, "x", "y", F.col("g") == "a").orderBy("subset"),
        lambda d: clean.cap_outliers(d, ["x", "y"]),
        lambda d: clean.fill_mode(d, ["x", "y"]),
        lambda d: infer.t_interval(d, "x"),
        lambda d: infer.z_interval(d, "x", 2.0),
        lambda d: infer.z_test(d, "x", 1.0, 2.0),
    ):
        same(fn(rows), fn(without))


@pytest.mark.parametrize("width", [25, 60])
def test_many_correlations(spark, width):
    rng = np.random.default_rng(width)
    data = rng.normal(size=(300, width)) @ rng.normal(size=(width, width))
    data[rng.random(data.shape) < 0.05] = np.nan
    frame = pd.DataFrame(data, columns=[f"c{i}" for i in range(width)])
    want = frame.corr()
    for r in profile.correlations(spark.createDataFrame(frame), list(frame.columns)).collect():
        assert r.r == pytest.approx(want.loc[r.x, r.y], abs=1e-9)


def test_lasso_of_thirty_features(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 30))
    y = x[:, 0] * 3 - x[:, 5] * 2 + rng.normal(size=400) * 0.1
    frame = pd.DataFrame(x, columns=[f"f{i}" for i in range(30)]).assign(y=y, fold=np.arange(400) % 4)
    fit, _ = linear.lasso_cv(spark.createDataFrame(frame), [f"f{i}" for i in range(30)], "y", "fold", n_alphas=20)
    assert fit.coef[0] == pytest.approx(3, abs=0.1) and fit.coef[5] == pytest.approx(-2, abs=0.1)


def test_grouped_moments_of_many_columns(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(90, 14)) + 50, columns=[f"c{i}" for i in range(14)]).assign(g=np.arange(90) % 3)
    got = linear.fit_moments(spark.createDataFrame(frame), [f"c{i}" for i in range(14)], ["g"])
    for g in range(3):
        own = frame[frame.g == g].drop(columns="g").to_numpy()
        assert got[(g,)].n == 30
        assert got[(g,)].cov == pytest.approx(np.cov(own.T, bias=True), abs=1e-9)
        assert got[(g,)].mean == pytest.approx(own.mean(axis=0))


def test_codes_of_numbers_follow_their_order(spark):
    for n in (12, 400):
        rows = spark.range(n).select(F.col("id").cast("int").alias("k"), F.col("id").alias("at"))
        assert features.label_encode(rows, ["k"]).where("k <> at").count() == 0
    assert features.one_hot(spark.range(1, 13).toDF("k"), ["k"]).columns == [f"k_{i}" for i in range(2, 13)]
    named = spark.range(400).toDF("code")
    assert features.label_encode(named, ["code"]).agg(F.sum("code")).first()[0] == 399 * 200
    assert features.one_hot_slots(named, ["code"]).where("code_slot = 398 and code_size = 399").count() == 1


def test_one_hot_of_many_levels(spark):
    rows = spark.range(1000).toDF("k")
    wide = features.one_hot(rows, ["k"])
    assert len(wide.columns) == 999 and wide.where("k_999 = 1").count() == 1


def test_one_hot_beyond_the_columns(spark):
    rows = spark.range(6000).select((F.col("id") % 5000).alias("k"), F.col("id").alias("at"))
    with pytest.raises(ValueError, match="one_hot_slots"):
        features.one_hot(rows, ["k"])
    learnt = rows.where("k <> 7")
    slots = features.one_hot_slots(rows.union(spark.createDataFrame([(None, -1)], "k long, at long")), ["k"], fit_on=learnt)
    got = {r["at"]: (r.k_size, r.k_slot) for r in slots.collect()}
    assert got[0] == got[7] == got[-1] == got[5007] == (4998, None)
    assert got[1] == got[5001] == (4998, 0) and got[4999] == (4998, 4997) and got[8] == (4998, 6)
    vectors = {r["at"]: r.k_vector for r in features.one_hot_vectors(slots, ["k"]).collect()}
    assert len(vectors) == 6001 and all(v.size == 4998 for v in vectors.values())
    assert [list(vectors[i].indices) for i in (0, 7, -1, 1, 4999)] == [[], [], [], [0], [4997]]


def test_pivot_finds_names_and_loses_none(spark):
    cells = spark.createDataFrame([("a", "x", 1), ("a", "y", 2), ("b", "z", 3), ("b", None, 9), ("c", "x", None)], "i string, c string, v int")
    wide = relate.pivot(cells, "i", "c", "v", fill=0)
    assert wide.columns == ["i", "x", "y", "z"]
    assert sorted(map(tuple, wide.collect())) == [("a", 1, 2, 0), ("b", 0, 0, 3), ("c", 0, 0, 0)]
    assert sorted(map(tuple, relate.pivot(cells, "i", "c", "v", ["z"]).collect()), key=repr) == [("a", None), ("b", 3), ("c", None)]
    with pytest.raises(ValueError, match="more than 2"):
        relate.pivot(cells, "i", "c", "v", most=2)


def test_stages_are_saved_with_what_they_learnt(spark, tmp_path):
    rows = spark.createDataFrame([(1.0, 2.0, "b"), (3.0, float("nan"), "a"), (5.0, 6.0, None), (None, 1.0, "c")], "x double, y double, g string")
    plan = Pipeline(stages=[stages.Interaction(["x", "y"], "xy"), stages.PopulationScaler(["x"]), stages.CategoryFlags("g")])
    Pipeline.load(plan.write().overwrite().save(str(tmp_path / "plan")) or str(tmp_path / "plan")).fit(rows)
    fitted = plan.fit(rows)
    fitted.write().save(str(tmp_path / "fitted"))
    loaded = PipelineModel.load(str(tmp_path / "fitted"))
    new = spark.createDataFrame([(3.0, 2.0, "z"), (None, None, None), (5.0, 1.0, "c")], "x double, y double, g string")
    got = [tuple(r) for r in loaded.transform(new).collect()]
    assert got == [tuple(r) for r in fitted.transform(new).collect()]
    spread = (8 / 3) ** 0.5
    assert got[0][2:] == (6.0, 0, 0) and got[0][0] == 0.0 and got[1] == (None, None, None, 0, 0)
    assert got[2][0] == pytest.approx(2 / spread) and got[2][3:] == (0, 1)


def test_score_ignores_nulls_of_other_columns(spark):
    rows = spark.range(2000).select(
        F.col("id").alias("key"), (F.col("id") % 50).cast("double").alias("a"), ((F.col("id") % 50) * 2).cast("double").alias("b"),
        F.when(F.col("id") < 20, F.col("id") % 7 * 1.0).alias("c"), F.lit("u").alias("t"),
    )
    rows = rows.withColumn("b", F.when(F.col("key") < 20, float("nan")).otherwise(F.col("b")))
    scores = {(r.x, r.y): r.score for r in power.pps_matrix(rows, "key", ["a", "b", "c"], ["t"], bins=50).collect()}
    assert scores[("a", "b")] == pytest.approx(1) and scores[("b", "a")] == pytest.approx(1)


def test_large_primes(spark):
    primes = [2, 3, 997, 1009, 1018081 + 2, 2147483647, 9223372036854775783, 1000000007, 999999999989]
    others = [0, 1, -7, 1018081, 3215031751, 3825123056546413051, 341550071728321, 9223372036854775807, 2147483647 * 3, 4]
    primes = [p for p in primes if all(p % d for d in range(2, min(p, 2000))) or p < 2]
    rows = spark.createDataFrame([(n,) for n in primes + others], "n long")
    got = {r.n for r in rows.where(scalar.is_prime(F.col("n"))).collect()}
    assert got == set(primes)
    small = {r.id for r in spark.range(3000).where(scalar.is_prime(F.col("id"))).collect()}
    assert small == {n for n in range(2, 3000) if all(n % d for d in range(2, math.isqrt(n) + 1))}


def test_least_squares_of_nearly_equal_features(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=3000) * 100 + 1e4
    b = a + 1e-6 * rng.normal(size=3000)
    frame = pd.DataFrame({"a": a, "b": b, "c": rng.normal(size=3000)}).assign(y=lambda d: d.a + 2 * d.b - 3 * d.c + 5)
    fit = linear.ols(spark.createDataFrame(frame).repartition(5), ["a", "b", "c"], "y")
    assert fit.coef == pytest.approx([1, 2, -3], abs=1e-4) and fit.intercept == pytest.approx(5, abs=1e-4)
    unit = pd.DataFrame({"a": rng.normal(size=2000)}).assign(b=lambda d: d.a + 1e-8 * rng.normal(size=2000), y=lambda d: d.a + 2 * d.b)
    assert linear.ols(spark.createDataFrame(unit), ["a", "b"], "y").coef == pytest.approx([1, 2], abs=1e-6)
    twin = frame.assign(b=frame.a)
    same = linear.ols(spark.createDataFrame(twin), ["a", "b"], "y")
    assert same.coef[0] == pytest.approx(same.coef[1]) and np.isfinite(same.intercept)


def test_newton_finds_the_optimum(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(400, 3)) * [1, 10, 0.1] + [0, 5, -2]
    y = (rng.random(400) < 1 / (1 + np.exp(-(x @ [1.0, -0.2, 3.0] + 7)))).astype(float)
    frame = pd.DataFrame(x, columns=list("abc")).assign(y=y)
    frame.loc[0, "a"] = np.nan
    for c in (0.01, 1.0, 100.0):
        fit = classify.fit_logistic(spark.createDataFrame(frame), list("abc"), "y", c)
        z = x[1:] @ fit.coef + fit.intercept
        p = 1 / (1 + np.exp(-z))
        slope = c * (x[1:].T @ (p - y[1:])) + fit.coef
        assert np.abs(slope).max() < 1e-6 * c * 400 and abs((p - y[1:]).sum()) < 1e-6 * 400
        assert fit.steps < 30
    apart = spark.createDataFrame([(float(i), float(i > 5)) for i in range(12)], "a double, y double")
    assert classify.fit_logistic(apart, ["a"], "y", 1e6).coef[0] > 1


def test_too_many_classes_are_refused(spark):
    rows = spark.range(20).select(F.col("id").alias("a"), (F.col("id") % 3).alias("p"))
    with pytest.raises(ValueError, match="more than 5 classes"):
        evaluate.confusion(rows, "a", "p", most=5)
    assert evaluate.confusion(rows.where("a < 3"), "a", "p").count() == 9


def test_trees_of_one_feature(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("key"), (F.col("id") % 40).cast("double").alias("x"), F.when(F.col("id") % 40 < 2, 5.0).otherwise(F.when(F.col("id") % 40 < 3, -40.0).otherwise(1.0)).alias("y"),
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string")).alias("wide"), F.when(F.col("id") % 7 > 0, F.lit("only")).alias("one"),
    )
    scores = {(r.x, r.y): r.score for r in power.pps_matrix(rows, "key", ["x", "y"], ["wide", "one"]).collect()}
    assert len(scores) == 16 and all(0 <= s <= 1 for s in scores.values())
    assert scores[("x", "y")] == 1 and scores[("y", "x")] < 0.3 and scores[("one", "x")] == 0
    assert power.pps_matrix(rows.limit(0), "key", ["x", "y"], ["one"]).where("x <> y and score <> 0").count() == 0
