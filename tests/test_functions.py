import numpy as np
from pyspark.sql import functions as F

from statloom.functions import arrays, distributions, scalar


def test_student_quantile():
    assert abs(float(distributions.t_quantile(0.995, 14)) - 2.976842734) < 1e-8
    assert abs(float(distributions.t_quantile(0.005, 14)) + 2.976842734) < 1e-8
    assert abs(float(distributions.t_quantile(0.975, 1)) - 12.7062047) < 1e-6
    assert np.isnan(distributions.t_quantile(0.975, 0))


def test_f_survival():
    assert abs(float(distributions.f_survival(3.5, 2, 100)) - 0.0339478) < 1e-6
    # Two numerator degrees of freedom have a closed form.
    for f, v in [(0.1, 5), (2.0, 60), (7.0, 12345)]:
        assert abs(float(distributions.f_survival(f, 2, v)) - (1 + 2 * f / v) ** (-v / 2)) < 1e-10
    assert float(distributions.f_survival(0.0, 2, 5)) == 1.0


def test_normal():
    assert abs(scalar.normal_quantile(0.995) - 2.575829) < 1e-6
    assert abs(scalar.normal_quantile(0.95) - 1.644854) < 1e-6
    assert abs(float(distributions.normal_survival(1.644853627)) - 0.05) < 1e-9


def column(spark, values, expr, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_grade_bands_and_signs(spark):
    bands = [(90, "A"), (75, "B"), (50, "C")]
    got = column(spark, [90, 89, 75, 74, 50, 49, None], scalar.banded(F.col("x"), bands, "Fail"), "int")
    assert got == ["A", "B", "B", "C", "C", "Fail", None]
    got = column(spark, [4, 3, 0, -1, None], scalar.sign_parity(F.col("x")), "int")
    assert got == ["Positive and even", "Positive but odd", "Zero", "Negative", None]


def test_bill(spark):
    total = F.col("x")
    discount = scalar.tiered_discount(total, 10000, 0.1)
    assert column(spark, [12800.0, 10000.0], discount) == [1280.0, 0.0]
    assert column(spark, [12800.0], scalar.fixed(total - discount, 2)) == ["11520.00"]


def test_primes(spark):
    numbers = list(range(-3, 98))
    flags = column(spark, numbers, scalar.is_prime(F.col("x")), "bigint")
    want = [n > 1 and all(n % d for d in range(2, n)) for n in numbers]
    assert flags == want


def test_primes_of_all_sizes(spark):
    """By batches, with the remainders that each size needs, against trial division."""
    sieve = np.ones(1_100_000, bool)
    sieve[:2] = False
    for d in range(2, 1050):
        sieve[d * d :: d] &= not sieve[d]
    assert (scalar.primes(np.arange(1_100_000)) == sieve).all()
    divisors = np.flatnonzero(sieve)[:30_000]
    for start in (25_326_000, 3_215_031_000, 4_294_967_000, 60_000_000_001):
        some = np.arange(start, start + 2_000)
        want = ~np.array([(n % divisors == 0).any() for n in some])
        assert (scalar.primes(some) == want).all()
    odd = {2**61 - 1: True, 2**63 - 25: True, 2**63 - 1: False, 3_215_031_751: False, 3_825_123_056_546_413_051: False, 341_550_071_728_321: False, 1009**2: False, -7: False}
    odd |= {3_037_000_493**2: False, 1_021_457 * 3: False, 65_537: True, 4_294_967_291: True}
    numbers = [*odd, None]
    assert column(spark, numbers, scalar.is_prime(F.col("x")), "bigint") == [*odd.values(), None]
    assert column(spark, [2, 1009, 9, None], scalar.is_prime(F.col("x")), "int") == [True, True, False, None]
    plan = spark.range(10).where(scalar.is_prime(F.col("id")))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "exists" not in plan and "aggregate(" not in plan


def test_list_trace(spark):
    a = F.split("x", ",")
    a = arrays.append(a, F.lit("Alpha"))
    a = arrays.extend(a, F.array(*[F.lit(v) for v in ("Alpha", "Alpha", "Beta", "Sigma")]))
    a = arrays.insert(a, 8, F.lit("Gamma"))
    start = ["50,40,30,20,10"]
    assert column(spark, start, a, "string")[0] == [
        "50", "40", "30", "20", "10", "Alpha", "Alpha", "Alpha", "Gamma", "Beta", "Sigma",
    ]
    assert column(spark, start, arrays.count_of(a, F.lit("Alpha")), "string") == [3]
    back = arrays.reverse(arrays.sort_as_text(a))
    assert column(spark, start, arrays.index_of(back, F.lit("50")), "string") == [6]
    assert column(spark, start, arrays.index_of(back, F.lit("x")), "string") == [None]
    rest = arrays.remove_first(back, F.lit("Gamma"))
    assert column(spark, start, arrays.last_element(rest), "string") == ["10"]
    popped = column(spark, start, arrays.pop_last(rest), "string")[0]
    assert popped == ["Sigma", "Beta", "Alpha", "Alpha", "Alpha", "50", "40", "30", "20"]
    assert column(spark, start, arrays.clear(rest), "string") == [[]]
    twice = arrays.remove_first(F.split("x", ","), F.lit("b"))
    assert column(spark, ["a,b,b", "a"], twice, "string") == [["a", "b"], ["a"]]


def test_reshape(spark):
    m = arrays.reshape(F.transform(F.split("x", ","), lambda v: v.cast("int")), 2, 3)
    assert column(spark, ["10,20,30,40,50,60"], m, "string") == [[[10, 20, 30], [40, 50, 60]]]
