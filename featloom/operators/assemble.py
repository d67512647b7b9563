"""Star assembly of per-key tables, stacking of labelled and unlabelled rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def star_join(base: DataFrame, tables: Iterable[DataFrame], key: str) -> DataFrame:
    """Left join of tables that hold one row per key.

    A rollup leaves its output hashed on the key, so the base table is the only
    side that has to move.
    """
    return reduce(lambda left, right: left.join(right, key, "left"), tables, base)


def stack_labelled(train: DataFrame, test: DataFrame) -> DataFrame:
    """Union by name; columns the scoring rows lack become null."""
    return train.unionByName(test, allowMissingColumns=True)


def stack_runs(runs: dict[int, DataFrame], run_column: str) -> DataFrame:
    tagged = [df.withColumn(run_column, F.lit(run)) for run, df in runs.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def to_long(df: DataFrame, keep: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(keep.., feature, value) with one row per feature and row."""
    doubles = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])
    return doubles.unpivot(list(keep), list(features), "feature", "value")
