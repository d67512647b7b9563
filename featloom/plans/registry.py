"""Registered queries, each beside the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: QueryFn
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def add(run: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


# Means of a few decimal values often end in an exact 5 behind the last kept digit; sums in
# another order fall on either side of it. Both engines add this before rounding such columns.
OFF_TIE = 3e-7


def rounded(df: DataFrame, digits: int = 4, shift: float = 0.0) -> DataFrame:
    """Round every double, so that both engines agree on the printed value."""
    return df.select(
        [
            F.round(F.col(f.name) + shift, digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema
        ]
    )


def round_sql(expr: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DOUBLE) + {OFF_TIE}::DOUBLE, {digits})"


def hash32_sql(key: str, seed: int | str = 0) -> str:
    return f"('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{seed}'), 1, 8))::BIGINT"


def hash_text_sql(key: str, seed: int | str = 0) -> str:
    return f"md5(CAST({key} AS VARCHAR) || ':{seed}')"
