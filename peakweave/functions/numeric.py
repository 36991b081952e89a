"""Scalar helpers: float32 rounding, guarded division, p-values."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def float32(c: str | Column) -> Column:
    return _col(c).cast("float")


def log1p_float32(c: str | Column) -> Column:
    """log1p of the float32 value, rounded to float32 again."""
    return F.log1p(float32(c).cast("double")).cast("float")


def ratio(num: Column, den: Column, otherwise=0.0) -> Column:
    """num / den, and `otherwise` (null for None) when den is zero."""
    other = F.lit(None).cast("double") if otherwise is None else F.lit(float(otherwise))
    return F.when(den != 0, num / den).otherwise(other)


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b) by its continued fraction (modified Lentz)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _incomplete_beta(b, a, 1.0 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    f = d
    # the fraction settles after some multiple of sqrt(max(a, b)) steps
    for m in range(1, 1000 + 20 * math.isqrt(int(max(a, b)) + 1)):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            f *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return front * f / a
    raise ArithmeticError(f"the incomplete beta fraction did not settle for a={a}, b={b}, x={x}")


#: Degrees of freedom from which the tail of Student's t follows from the normal one: the first term left out is below
#: 1e-12 there, while the logarithms of gamma functions begin to lose digits.
MANY = 10_000


def t_two_sided(t: float, freedom: float) -> float:
    """P(|T| >= t) of Student's t for t >= 0, by Fisher's expansion around the normal tail."""
    if t > 40:  # the density is below the smallest double
        return 0.0
    density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
    first = t * (t**2 + 1) / 4
    second = t * (3 * t**6 - 7 * t**4 - 5 * t**2 - 3) / 96
    third = t * (t**10 - 11 * t**8 + 14 * t**6 + 6 * t**4 - 3 * t**2 - 15) / 384
    return math.erfc(t / math.sqrt(2)) + 2 * density * (first / freedom + second / freedom**2 + third / freedom**3)


@F.pandas_udf(T.DoubleType())
def correlation_p_value(r: pd.Series, n: pd.Series) -> pd.Series:
    """Two-sided p-value of a correlation coefficient; runs on the aggregated rows only."""

    def one(rr, nn):
        if rr is None or nn is None or math.isnan(rr) or nn < 2:
            return None
        if nn == 2:
            return 1.0
        free, rest = float(nn - 2), max(0.0, 1.0 - rr * rr)
        if free >= MANY:
            return t_two_sided(abs(rr) * math.sqrt(free / rest), free) if rest else 0.0
        return _incomplete_beta(free / 2.0, 0.5, rest)

    return pd.Series([one(rr, nn) for rr, nn in zip(r, n)], dtype="float64")
