"""Per-feature class statistics: constant columns, separation and drift filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.functions.special import two_sided_p
from featloom.operators.assemble import to_long
from featloom.operators.rank import quantile_columns, running_totals

# Smallest class for a test, and the p value reported below it.
SMALLEST_CLASS = 20
UNTESTED_P = 2.0


def constant_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at most one distinct non-null value: min equals max, one pass."""
    row = df.agg(*[F.min(c).eqNullSafe(F.max(c)).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def drop_constant(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    tested = [c for c in df.columns if c not in keep]
    return df.drop(*constant_columns(df, tested))


def class_separation(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """One row per feature: class sizes, centre difference, rank-sum z and p, scaled difference.

    Rows are first collapsed to distinct (feature, value) with their class
    counts; mid-ranks, medians and means all come from that table. Rows without
    a label count only towards the overall mean.
    """
    long = to_long(df.withColumn("__y", F.col(label)), ["__y"], features)
    y = F.col("__y")
    counted = (
        long.where(F.col("value").isNotNull())
        .groupBy("feature", "value")
        .agg(
            F.count_if(y == 0).alias("n0"),
            F.count_if(y == 1).alias("n1"),
            F.count_if(y.isNotNull()).alias("n"),
            F.count("*").alias("n_all"),
        )
    )
    ordered = running_totals(counted, ["value"], ["n0", "n1", "n"], ["feature"])
    mid_rank = F.col("n_before") + (F.col("n") + 1) / 2
    value = F.col("value")
    # min/max of the labelled values decide whether a feature is a pure 0/1 flag.
    used = F.when(F.col("n") > 0, value)
    medians, centres = [], []
    for c in ("n0", "n1"):
        a, o = quantile_columns("value", c, {f"median_{c}": 0.5})
        medians += a
        centres += o
    per_feature = ordered.groupBy("feature").agg(
        F.sum("n0").alias("n0"),
        F.sum("n1").alias("n1"),
        F.sum(F.col("n0") * mid_rank).alias("rank_sum"),
        F.sum(F.col("n0") * value).alias("sum0"),
        F.sum(F.col("n1") * value).alias("sum1"),
        F.try_divide(F.sum(F.col("n_all") * value), F.sum("n_all")).alias("mean_all"),
        F.count_if(used.isin(0.0, 1.0)).alias("flag_values"),
        F.count(used).alias("values"),
        *medians,
    ).select("*", *centres)
    labelled = df.where(F.col(label).isNotNull()).agg(F.count("*")).scalar()
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    is_flag = (
        (F.col("flag_values") == 2) & (F.col("values") == 2) & (F.col("n0") + F.col("n1") == labelled)
    )
    means = F.abs(F.try_divide(F.col("sum0"), n0) - F.try_divide(F.col("sum1"), n1))
    diff = F.when(is_flag, means).otherwise(F.abs(F.col("median_n0") - F.col("median_n1")))
    expected = n0 * (n0 + n1 + 1) / 2
    spread = F.sqrt(n0 * n1 * (n0 + n1 + 1) / 12)
    enough = (n0 >= SMALLEST_CLASS) & (n1 >= SMALLEST_CLASS)
    z = F.when(enough, F.try_divide(F.col("rank_sum") - expected, spread))
    return per_feature.withColumns({"diff": diff, "z": z}).select(
        "feature",
        "n0",
        "n1",
        "diff",
        "z",
        F.coalesce(two_sided_p(F.col("z")), F.lit(UNTESTED_P)).alias("p"),
        F.abs(F.try_divide("diff", "mean_all")).alias("diff_norm"),
    )


def train_test_drift(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """The same statistics with "has a label" as the class."""
    marked = df.withColumn("__labelled", F.col(label).isNotNull().cast("int"))
    return class_separation(marked, features, "__labelled")


def weak_separation() -> Column:
    untested_or_weak = F.col("p") > 0.05
    return untested_or_weak & ((F.col("diff") == 0) | F.coalesce(F.col("diff_norm") < 0.5, F.lit(False)))


def weak_features(statistics: DataFrame, protected: Sequence[str] = ()) -> DataFrame:
    weak = statistics.where(weak_separation()).select("feature")
    return weak.where(~F.col("feature").isin(list(protected))) if protected else weak


def drifting_features(class_statistics: DataFrame, drift_statistics: DataFrame) -> DataFrame:
    """Features that move between train and test and do not separate the classes."""
    moving = drift_statistics.where((F.col("p") < 0.05) & (F.col("diff_norm") > 1)).select("feature")
    flat = class_statistics.where(F.col("diff_norm") == 0).select("feature")
    return moving.join(flat, "feature", "left_semi")


def remaining_features(statistics: DataFrame, dropped: DataFrame) -> DataFrame:
    return statistics.select("feature").join(dropped, "feature", "left_anti")


def drop_features(df: DataFrame, dropped: DataFrame) -> DataFrame:
    """Drop the listed columns; the list has at most one row per column of ``df``."""
    return df.drop(*[r["feature"] for r in dropped.select("feature").collect()])
