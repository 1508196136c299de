"""Student-t, F and normal distribution functions, vectorised over small aggregated tables.

The regularised incomplete beta function is evaluated by its continued fraction (modified Lentz
method); the Student-t quantile is found by bisection. As DataFrame columns they are Arrow-batched
UDFs meant for the rows of an aggregate, one per group, never for raw rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_log_gamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def _beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    tiny, steps, precision = 1e-300, 10_000, 1e-15

    def safe(v: np.ndarray) -> np.ndarray:
        return np.where(np.abs(v) < tiny, tiny, v)

    c = np.ones_like(x)
    d = 1.0 / safe(1.0 - (a + b) * x / (a + 1.0))
    result = d.copy()
    for m in range(1, steps):
        even = m * (b - m) * x / ((a + 2 * m - 1.0) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1.0))
        for term in (even, odd):
            d = 1.0 / safe(1.0 + term * d)
            c = safe(1.0 + term / c)
            change = c * d
            result = result * change
        if np.all(np.abs(change - 1.0) < precision):
            break
    return result


def beta_regularised(a, b, x) -> np.ndarray:
    """I_x(a, b)."""
    a, b, x = np.broadcast_arrays(
        np.asarray(a, dtype=float), np.asarray(b, dtype=float), np.asarray(x, dtype=float)
    )
    inner = np.clip(x, 1e-300, 1.0 - 1e-16)
    front = np.exp(
        _log_gamma(a + b)
        - _log_gamma(a)
        - _log_gamma(b)
        + a * np.log(inner)
        + b * np.log1p(-inner)
    )
    swap = inner > (a + 1.0) / (a + b + 2.0)
    p, q = np.where(swap, b, a), np.where(swap, a, b)
    part = front * _beta_fraction(p, q, np.where(swap, 1.0 - inner, inner)) / p
    value = np.where(swap, 1.0 - part, part)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, value))


def t_cdf(t, df) -> np.ndarray:
    t, df = np.broadcast_arrays(np.asarray(t, dtype=float), np.asarray(df, dtype=float))
    tail = 0.5 * beta_regularised(df / 2.0, 0.5, df / (df + t * t))
    return np.where(t > 0, 1.0 - tail, tail)


def t_quantile(p, df) -> np.ndarray:
    p, df = np.broadcast_arrays(np.asarray(p, dtype=float), np.asarray(df, dtype=float))
    valid = (df > 0) & (p > 0) & (p < 1)
    target, freedom = np.where(valid, np.maximum(p, 1 - p), 0.5), np.where(valid, df, 1.0)
    low, high = np.zeros_like(target), np.ones_like(target)
    for _ in range(1000):
        short = t_cdf(high, freedom) < target
        if not short.any():
            break
        high = np.where(short, high * 2.0, high)
    for _ in range(200):
        mid = 0.5 * (low + high)
        below = t_cdf(mid, freedom) < target
        low, high = np.where(below, mid, low), np.where(below, high, mid)
    root = np.where(p < 0.5, -1.0, 1.0) * 0.5 * (low + high)
    return np.where(valid, root, np.nan)


def f_survival(f, df1, df2) -> np.ndarray:
    """P(F > f)."""
    f, df1, df2 = np.broadcast_arrays(
        np.asarray(f, dtype=float), np.asarray(df1, dtype=float), np.asarray(df2, dtype=float)
    )
    valid = (df1 > 0) & (df2 > 0) & ~np.isnan(f)
    a, b, x = np.where(valid, df2, 1.0), np.where(valid, df1, 1.0), np.where(valid, f, 1.0)
    return np.where(valid, beta_regularised(a / 2.0, b / 2.0, a / (a + b * x)), np.nan)


def normal_survival(z) -> np.ndarray:
    return 0.5 * _erfc(np.asarray(z, dtype=float) / math.sqrt(2.0))


def _series(values: np.ndarray) -> pd.Series:
    """NaN stands for "undefined" above; a column wants null."""
    return pd.Series(values, dtype="object").where(~np.isnan(values), None)


@F.pandas_udf(DoubleType())
def t_quantile_column(p: pd.Series, df: pd.Series) -> pd.Series:
    return _series(t_quantile(p.astype(float).to_numpy(), df.astype(float).to_numpy()))


@F.pandas_udf(DoubleType())
def f_survival_column(f: pd.Series, df1: pd.Series, df2: pd.Series) -> pd.Series:
    return _series(
        f_survival(f.astype(float).to_numpy(), df1.astype(float).to_numpy(), df2.astype(float).to_numpy())
    )


@F.pandas_udf(DoubleType())
def normal_survival_column(z: pd.Series) -> pd.Series:
    return _series(normal_survival(z.astype(float).to_numpy()))
