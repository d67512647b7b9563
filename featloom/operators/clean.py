"""Column choice, row filters, rule-driven null-out and type narrowing."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.functions.values import finite_or_null, is_not, nan_to_null

# Exclusive bounds of each integer type: a value on the bound needs the next wider type.
INTEGER_TYPES = [
    (T.ByteType(), -(1 << 7), (1 << 7) - 1),
    (T.ShortType(), -(1 << 15), (1 << 15) - 1),
    (T.IntegerType(), -(1 << 31), (1 << 31) - 1),
]
FLOAT_LIMIT = 3.4028234663852886e38


@dataclass(frozen=True)
class NullRule:
    """Values of ``column`` that count as missing."""

    column: str
    above: float | None = None
    below: float | None = None
    equals: Any = None

    def __post_init__(self):
        if self.above is None and self.below is None and self.equals is None:
            raise ValueError(f"the rule for {self.column} tests nothing")

    def test(self) -> Column:
        c = F.col(self.column)
        tests = []
        if self.above is not None:
            tests.append(c > self.above)
        if self.below is not None:
            tests.append(c < self.below)
        if self.equals is not None:
            tests.append(c == self.equals)
        return reduce(lambda a, b: a | b, tests)


def apply_null_rules(df: DataFrame, rules: Iterable[NullRule]) -> DataFrame:
    """Null out what any of a column's rules calls missing; rules of one column add up."""
    tests: dict[str, Column] = {}
    for r in rules:
        tests[r.column] = tests[r.column] | r.test() if r.column in tests else r.test()
    return df.withColumns({c: F.when(test, None).otherwise(F.col(c)) for c, test in tests.items()})


def exclude_values(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    """Drop rows holding the given value; rows with a missing value stay."""
    return df.where(reduce(lambda a, b: a & b, [is_not(c, v) for c, v in values.items()]))


def exclude_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop rows for which the condition is certainly true."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def numeric_columns(df: DataFrame) -> list[str]:
    numeric = (T.NumericType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, numeric)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def columns_matching(df: DataFrame, include: str, exclude: str | None = None) -> list[str]:
    return [
        c
        for c in df.columns
        if re.search(include, c) and not (exclude and re.search(exclude, c))
    ]


def feature_columns(df: DataFrame, label: str, ids: Iterable[str]) -> list[str]:
    reserved = {label, *ids}
    return [c for c in df.columns if c not in reserved]


def split_labelled(df: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(label).isNotNull()), df.where(F.col(label).isNull())


def _fractional(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.FractionalType)
            and not isinstance(f.dataType, T.DecimalType)]


def nan_columns_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: nan_to_null(c) for c in _fractional(df)})


def non_finite_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: finite_or_null(c) for c in _fractional(df)})


def narrowed_schema(df: DataFrame, narrow_floats: bool = False) -> dict[str, T.DataType]:
    """Smallest type per numeric column, from one min/max pass over the table."""
    integral = [f.name for f in df.schema if isinstance(f.dataType, T.IntegralType)]
    floats = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)] if narrow_floats else []
    cols = integral + floats
    if not cols:
        return {}
    bounds = df.agg(
        *[F.min(c).alias(f"lo_{i}") for i, c in enumerate(cols)],
        *[F.max(c).alias(f"hi_{i}") for i, c in enumerate(cols)],
    ).first()
    chosen: dict[str, T.DataType] = {}
    for i, c in enumerate(cols):
        low, high = bounds[f"lo_{i}"], bounds[f"hi_{i}"]
        if low is None:
            continue
        if c in floats:
            chosen[c] = T.FloatType() if -FLOAT_LIMIT < low and high < FLOAT_LIMIT else T.DoubleType()
            continue
        fits = [t for t, floor, ceiling in INTEGER_TYPES if floor < low and high < ceiling]
        chosen[c] = fits[0] if fits else T.LongType()
    return chosen


def narrow_types(df: DataFrame, narrow_floats: bool = False) -> DataFrame:
    types = narrowed_schema(df, narrow_floats)
    return df.select([F.col(c).cast(types[c]) if c in types else F.col(c) for c in df.columns])
