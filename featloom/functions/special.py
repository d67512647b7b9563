"""Normal quantile, inverse error function and normal tail as column expressions."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Acklam's rational approximation of the normal quantile.
CENTRAL_NUMERATOR = [
    -3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
    1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00,
]
CENTRAL_DENOMINATOR = [
    -5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
    6.680131188771972e01, -1.328068155288572e01, 1.0,
]
TAIL_NUMERATOR = [
    -7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
    -2.549732537343734e00, 4.374664141464968e00, 2.938163982698783e00,
]
TAIL_DENOMINATOR = [
    7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
    3.754408661907416e00, 1.0,
]
TAIL_BREAK = 0.02425

# Chebyshev fit of the complementary error function (Numerical Recipes).
ERFC_COEFFICIENTS = [
    0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807,
    -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223,
]


def _polynomial(coefficients: list[float], x: Column) -> Column:
    return reduce(lambda acc, k: acc * x + F.lit(k), coefficients[1:], F.lit(coefficients[0]))


def probit(p: Column) -> Column:
    """Quantile of the standard normal for ``0 < p < 1``, null elsewhere."""

    def tail(q: Column) -> Column:
        r = F.sqrt(-2.0 * F.log(q))
        return _polynomial(TAIL_NUMERATOR, r) / _polynomial(TAIL_DENOMINATOR, r)

    d = p - 0.5
    r = d * d
    central = _polynomial(CENTRAL_NUMERATOR, r) * d / _polynomial(CENTRAL_DENOMINATOR, r)
    return (
        F.when((p <= 0) | (p >= 1), None)
        .when(p < TAIL_BREAK, tail(p))
        .when(p > 1 - TAIL_BREAK, -tail(1 - p))
        .otherwise(central)
    )


def erfinv(x: Column) -> Column:
    return probit((x + 1) / 2) / math.sqrt(2)


def erfc(x: Column) -> Column:
    size = F.abs(x)
    t = 1 / (1 + 0.5 * size)
    tail = t * F.exp(-size * size + _polynomial(ERFC_COEFFICIENTS, t))
    return F.when(x >= 0, tail).otherwise(2 - tail)


def two_sided_p(z: Column) -> Column:
    return erfc(F.abs(z) / math.sqrt(2))
