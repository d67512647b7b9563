"""Null-safe scalar expressions.

A missing value is always SQL NULL here. NaN is turned into NULL at the
source, division by zero gives NULL, and flags treat an unknown comparison as
"no".
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

Operand = str | Column


def column(c: Operand) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Operand) -> Column:
    return F.nanvl(column(c), F.lit(None).cast("double"))


def finite_or_null(c: Operand) -> Column:
    c = column(c)
    return F.when(~(F.isnan(c) | (F.abs(c) == float("inf"))), c)


def sentinel_to_null(c: Operand, value: Any) -> Column:
    return F.nullif(column(c), F.lit(value))


def null_above(c: Operand, bound: float) -> Column:
    c = column(c)
    return F.when(c > bound, None).otherwise(c)


def null_below(c: Operand, bound: float) -> Column:
    c = column(c)
    return F.when(c < bound, None).otherwise(c)


def null_outside(c: Operand, low: float, high: float) -> Column:
    c = column(c)
    return F.when((c < low) | (c > high), None).otherwise(c)


def ratio(a: Operand, b: Operand) -> Column:
    return F.try_divide(column(a).cast("double"), column(b).cast("double"))


def difference(a: Operand, b: Operand) -> Column:
    return column(a) - column(b)


def product(*factors: Operand) -> Column:
    return reduce(lambda x, y: x * y, [column(f) for f in factors])


def flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def member_flag(c: Operand, values: Iterable[Any]) -> Column:
    return flag(column(c).isin(list(values)))


def is_not(c: Operand, value: Any) -> Column:
    """True for every row but a definite match, so NULL rows are kept."""
    return ~column(c).eqNullSafe(F.lit(value))


def clamp_zero(c: Operand, null_as_zero: bool) -> Column:
    c = column(c)
    if null_as_zero:
        return F.greatest(c, F.lit(0).cast("double"))
    return F.when(c > 0, c).when(c.isNotNull(), F.lit(0))


def clip(c: Operand, low: float, high: float) -> Column:
    c = column(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def sqrt_or_null(c: Operand) -> Column:
    return nan_to_null(F.sqrt(column(c)))


def log1p_or_null(c: Operand) -> Column:
    return F.log1p(column(c))
