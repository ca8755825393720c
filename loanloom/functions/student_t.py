"""Two-sided p-value of the t distribution as a Spark column."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F, types as T

# Send these functions with the job, so that executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_TINY, _PRECISION, _MAX_TERMS = 1e-300, 1e-15, 10_000
#: Degrees of freedom from which the normal distribution and two corrections are exact to 1e-10 for any t that matters.
_MANY = 1e7


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by the modified Lentz method."""
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1 / (d if abs(d) > _TINY else _TINY)
    value = d
    for m in range(1, _MAX_TERMS):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1 + term * d
            d = 1 / (d if abs(d) > _TINY else _TINY)
            c = 1 + term / c
            c = c if abs(c) > _TINY else _TINY
            value *= c * d
        if abs(c * d - 1) < _PRECISION:
            break
    return value


def regularised_beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return 0.0 if x <= 0 else 1.0
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _beta_fraction(a, b, x) / a
    return 1 - front * _beta_fraction(b, a, 1 - x) / b


def _nearly_normal(t: float, df: float) -> float:
    """The normal tail and two terms of its expansion in 1 / df, where the beta function would lose digits."""
    if math.isinf(t):
        return 0.0
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    first = t * (t**2 + 1) / (4 * df)
    second = t * (3 * t**6 - 7 * t**4 - 5 * t**2 - 3) / (96 * df**2)
    return max(0.0, math.erfc(t / math.sqrt(2)) + 2 * density * (first + second))


def two_sided(t: float, df: float) -> float | None:
    if t is None or df is None or math.isnan(t) or math.isnan(df):
        return None
    if df > _MANY:
        return _nearly_normal(abs(t), df)
    return regularised_beta(df / 2, 0.5, df / (df + t * t))


@F.pandas_udf(T.DoubleType())
def p_value(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Runs on one row per tested variable, never on the data."""
    for t, df in batches:
        yield pd.Series([two_sided(a, b) for a, b in zip(t, df)], dtype="float64")
