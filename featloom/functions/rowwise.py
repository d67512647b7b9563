"""Horizontal statistics over a list of columns, as plain arithmetic inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT, MEAN, POWER = "__row_count", "__row_mean", "__row_power_"


def _plus(terms: list[Column]) -> Column:
    """Sum as a balanced tree: a chain over hundreds of columns is too deep for the analyser."""
    while len(terms) > 1:
        pairs = [a + b for a, b in zip(terms[::2], terms[1::2])]
        terms = pairs + terms[len(pairs) * 2 :]
    return terms[0]


def _present(cols: list[str]) -> Column:
    return _plus([F.col(c).isNotNull().cast("int") for c in cols])


def _filled(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def _double(c: str) -> Column:
    return F.col(c).cast("double")


def _all_present(cols: list[str], value: Column) -> Column:
    return F.when(_present(cols) == len(cols), value)


def row_null_count(cols: list[str]) -> Column:
    return _plus([F.col(c).isNull().cast("int") for c in cols])


def row_sum(cols: list[str], skip_nulls: bool = True) -> Column:
    """With ``skip_nulls`` an all-null row sums to 0, otherwise any null gives null."""
    if skip_nulls:
        return _plus([_filled(_double(c)) for c in cols])
    return _plus([_double(c) for c in cols])


def row_mean(cols: list[str], skip_nulls: bool = True) -> Column:
    mean = F.try_divide(row_sum(cols), _present(cols))
    return mean if skip_nulls else _all_present(cols, mean)


def _with_powers(df: DataFrame, cols: list[str], powers: tuple[int, ...]) -> DataFrame:
    """Adds the value count, the row mean and the sums of powers about it.

    The mean is a column of its own before it is used, so it is computed once
    per row instead of once per term.
    """
    staged = df.withColumns({COUNT: _present(cols), MEAN: row_mean(cols)})
    deviations = [_double(c) - F.col(MEAN) for c in cols]
    sums = {f"{POWER}{p}": _plus([_filled(reduce(lambda a, b: a * b, [d] * p)) for d in deviations]) for p in powers}
    return staged.withColumns(sums)


def _finish(df: DataFrame, out: str, value: Column) -> DataFrame:
    temporary = [c for c in df.columns if c in (COUNT, MEAN) or c.startswith(POWER)]
    return df.withColumn(out, value).drop(*temporary)


def with_row_std(df: DataFrame, cols: list[str], out: str, skip_nulls: bool = True) -> DataFrame:
    """Sample deviation; fewer than two values give null."""
    n = F.col(COUNT)
    std = F.when(n > 1, F.sqrt(F.try_divide(F.col(f"{POWER}2"), n - 1)))
    value = std if skip_nulls else F.when(n == len(cols), std)
    return _finish(_with_powers(df, cols, (2,)), out, value)


def with_row_kurtosis_sample(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Bias-corrected excess kurtosis; null below four values, 0 when all are equal."""
    n = F.col(COUNT).cast("double")
    m2, m4 = F.col(f"{POWER}2"), F.col(f"{POWER}4")
    denominator = (n - 2) * (n - 3)
    corrected = F.try_divide(n * (n + 1) * (n - 1) * m4, denominator * m2 * m2) - F.try_divide(
        3 * (n - 1) * (n - 1), denominator
    )
    value = F.when(n >= 4, F.when(m2 == 0, F.lit(0.0)).otherwise(corrected))
    return _finish(_with_powers(df, cols, (2, 4)), out, value)


def with_row_kurtosis_moment(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Fourth-moment ratio; null when any value is missing or all are equal."""
    m2, m4 = F.col(f"{POWER}2"), F.col(f"{POWER}4")
    value = F.when(F.col(COUNT) == len(cols), F.try_divide(len(cols) * m4, m2 * m2))
    return _finish(_with_powers(df, cols, (2, 4)), out, value)
