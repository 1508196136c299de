"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def floor_mod(a: Column, b: int) -> Column:
    """Remainder with the sign of the divisor."""
    return F.pmod(a, F.lit(b))


def square(c: Column) -> Column:
    """Integer square that stays an integer."""
    return c * c


def clip(c: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; null stays null."""
    return F.when(c.isNotNull(), F.greatest(low, F.least(high, c)))


def fixed(c: Column, places: int) -> Column:
    """Fixed-point text without thousands separators."""
    return F.printf(F.lit(f"%.{places}f"), c.cast("double"))


def percent_text(c: Column, places: int = 1) -> Column:
    return F.concat(fixed(c * 100, places), F.lit("%"))


def day_first_date(c: Column) -> Column:
    """DD-MM-YYYY text to date, null where it does not parse."""
    return F.try_to_date(c, "dd-MM-yyyy")


def mapped(c: Column, mapping: Mapping[str, int]) -> Column:
    """Value mapping; values outside of it become null."""
    expr = None
    for key, code in mapping.items():
        expr = F.when(c == key, F.lit(code)) if expr is None else expr.when(c == key, F.lit(code))
    return expr


def banded(c: Column, bands: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First band whose closed lower bound is reached."""
    expr = None
    for bound, label in bands:
        expr = F.when(c >= bound, label) if expr is None else expr.when(c >= bound, label)
    return F.when(c.isNotNull(), expr.otherwise(otherwise))


def indicator(condition: Column) -> Column:
    """1 where the condition holds, else 0; a null condition counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def sign_parity(c: Column) -> Column:
    return (
        F.when((c > 0) & (c % 2 == 0), "Positive and even")
        .when(c > 0, "Positive but odd")
        .when(c == 0, "Zero")
        .when(c < 0, "Negative")
    )


def tiered_discount(total: Column, above: float, rate: float) -> Column:
    return F.when(total > above, total * rate).when(total.isNotNull(), F.lit(0.0))


# Primes below 1000 decide numbers below 1009 * 1009 by division; the first twelve are witnesses that
# decide every 64-bit number, the first four those below WITNESSED.
SMALL_PRIMES = [p for p in range(2, 1000) if all(p % d for d in range(2, int(p**0.5) + 1))]
DIVIDED, WITNESSED = 1_018_081, 3_215_031_751


def is_prime(n: Column) -> Column:
    """Primality of an integer. 0, 1 and negatives are not prime. Small divisors are native expressions, which
    a filter evaluates first; batches of what they leave are divided by the other small primes, and
    larger numbers take the Miller-Rabin test with fixed witnesses."""
    found = n > 1
    for p in SMALL_PRIMES[:4]:
        found = found & ((n % p != 0) | (n == p))
    # The shift by 0 admits integers only.
    return found & _prime(F.call_function("shiftright", n, F.lit(0)).cast("bigint"))


@F.arrow_udf(BooleanType())
def _prime(values: pa.Array) -> pa.Array:
    missing = values.is_null().to_numpy(zero_copy_only=False)
    return pa.array(primes(values.fill_null(0).to_numpy(zero_copy_only=False)), pa.bool_(), mask=missing)


def primes(values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit integers are prime."""
    found = values > 1
    left = np.flatnonzero(found)
    for p in SMALL_PRIMES:
        left = left[values[left] >= p * p]
        hit = values[left] % p == 0
        found[left[hit]] = False
        left = left[~hit]
    left = left[values[left] >= DIVIDED]
    large = values[left] >= WITNESSED
    found[left[~large]] = _unwitnessed(values[left[~large]].astype(np.uint64))
    found[left[large]] = [_no_witness(n) for n in values[left[large]].tolist()]
    return found


def _unwitnessed(n: np.ndarray) -> np.ndarray:
    """Odd numbers below WITNESSED, whose products fit into 64 bits, by four witnesses at once: whether
    a^d is 1, or a^(d 2^r) is -1 for some r below s, where n - 1 = d 2^s."""
    one = np.uint64(1)
    low = (n - one) & (~(n - one) + one)
    d, found = (n - one) // low, np.ones(len(n), bool)
    for a in SMALL_PRIMES[:4]:
        x = np.ones_like(n)
        for bit in range(31, -1, -1):
            x = x * x % n
            x = np.where(d >> np.uint64(bit) & one == one, x * np.uint64(a) % n, x)
        fine, r = (x == one) | (x == n - one), one
        while (~fine & (r < low)).any():
            x = x * x % n
            r = r << one
            fine |= (r < low) & (x == n - one)
        found &= fine
    return found


def _no_witness(n: int) -> bool:
    s = ((n - 1) & (1 - n)).bit_length() - 1
    d = (n - 1) >> s
    for a in SMALL_PRIMES[:12]:
        x = pow(a, d, n)
        if x != 1 and not any((x if r == 0 else pow(a, d << r, n)) == n - 1 for r in range(s)):
            return False
    return True


def normal_quantile(p: float) -> float:
    return NormalDist().inv_cdf(p)
