"""Global order without a global task: ranks, running totals, quantiles.

Every operator here sorts by range partitioning on a unique (or collapsed)
sort key, so equal values spread over as many tasks as they need, and then
adds a per-partition offset. The range-partitioned rows are written once; the
partition number is data from then on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.workspace import lookup_join, materialise, small_or_none

PART = "__part"
PLACE = "__place"
# The grouping columns as one value that is never null, so that null groups meet in joins as well.
GROUP = "__group"
ROW_BITS = 33  # monotonically_increasing_id keeps the partition above the low 33 bits


def _before(total: str, over) -> Column:
    return F.coalesce(F.sum(total).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))


def exact_rank(
    df: DataFrame, order_by: Sequence[str], by: Sequence[str] = (), out: str = "rank"
) -> DataFrame:
    """Zero-based position of each row in ``order_by`` order within ``by``.

    ``order_by`` has to be unique within ``by``: end it with the row key. Nulls in ``by`` are a group of their own.
    """
    by = list(by)
    group = [GROUP] if by else []
    placed = materialise(
        df.repartitionByRange(*by, *order_by)
        .sortWithinPartitions(*by, *order_by)
        .withColumn(PLACE, F.monotonically_increasing_id())
        .withColumn(PART, F.shiftright(PLACE, ROW_BITS))
        .withColumns({g: F.struct(*by) for g in group}),
        "rank",
    )
    parts = placed.groupBy(*group, PART).agg(
        F.count("*").alias("__n"), F.min(PLACE).alias("__first")
    )
    # One row per (group, partition): without groups this is at most one row per partition.
    ordered = Window.partitionBy(*group).orderBy(PART)
    offsets = parts.select(
        *group, PART, (_before("__n", ordered) - F.col("__first")).alias("__offset")
    )
    # Offsets are one row per partition, or per group and partition: broadcast when few, else joined by shuffle.
    small = None if by else small_or_none(offsets)
    joined = lookup_join(placed, offsets, [*group, PART]) if small is None else placed.join(F.broadcast(small), PART, "left")
    return joined.withColumn(out, F.col(PLACE) + F.col("__offset")).drop(*group, PLACE, PART, "__offset")


def running_totals(
    df: DataFrame, order_by: Sequence[str], totals: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Adds ``<c>_before`` (sum over earlier rows) and ``<c>_total`` for each column of ``totals``.

    Collapse equal keys first: a window covers one range partition of one group. Nulls in ``by`` are a group of their own.
    """
    by = list(by)
    group = [GROUP] if by else []
    ranged = df.repartitionByRange(*by, *order_by).withColumn(PART, F.spark_partition_id())
    placed = materialise(ranged.withColumns({g: F.struct(*by) for g in group}), "totals")
    parts = placed.groupBy(*group, PART).agg(*[F.sum(c).alias(c) for c in totals])
    ordered = Window.partitionBy(*group).orderBy(PART)
    whole = Window.partitionBy(*group)
    offsets = parts.select(
        *group,
        PART,
        *[_before(c, ordered).alias(f"__{c}_offset") for c in totals],
        *[F.sum(c).over(whole).alias(f"{c}_total") for c in totals],
    )
    inside = Window.partitionBy(*group, PART).orderBy(*order_by)
    running = placed.withColumns({f"__{c}_inside": _before(c, inside) for c in totals})
    # The window has already hashed the rows by group and partition, so this join moves no row again.
    return (
        running.join(offsets, [*group, PART])
        .withColumns({f"{c}_before": F.col(f"__{c}_inside") + F.col(f"__{c}_offset") for c in totals})
        .drop(*group, PART, *[f"__{c}_{k}" for c in totals for k in ("offset", "inside")])
    )


def top_k(df: DataFrame, value: str, k: int, key: str) -> DataFrame:
    """The ``k`` rows of largest ``value``; equal values go by ``key``, null values come last."""
    return df.orderBy(F.desc_nulls_last(value), key).limit(k)


def value_counts(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """Distinct non-null values per group with their row count ``n``."""
    return df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count("*").alias("n"))


def mid_ranks(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One-based average rank of each distinct value, ties sharing their mean position."""
    counted = running_totals(value_counts(df, value, by), [value], ["n"], by)
    return counted.select(
        *by, value, "n", (F.col("n_before") + (F.col("n") + 1) / 2).alias("mid_rank")
    )


def value_at(position: Column, value: str | Column, n: str) -> Column:
    """Aggregate picking the value that covers a zero-based position in a counted order."""
    value = F.col(value) if isinstance(value, str) else value
    before = F.col(f"{n}_before")
    return F.max(F.when((before <= position) & (position < before + F.col(n)), value))


def quantile_columns(value: str, n: str, quantiles: dict[str, float]) -> tuple[list[Column], list[Column]]:
    """Aggregates and final projection for linearly interpolated quantiles of a counted order."""
    aggregates, outputs = [], []
    for name, q in quantiles.items():
        place = (F.col(f"{n}_total") - 1) * F.lit(float(q))
        aggregates += [
            value_at(F.floor(place), value, n).cast("double").alias(f"__{name}_low"),
            value_at(F.ceil(place), value, n).cast("double").alias(f"__{name}_high"),
            F.max(place - F.floor(place)).alias(f"__{name}_share"),
        ]
        low, high = F.col(f"__{name}_low"), F.col(f"__{name}_high")
        outputs.append((low + (high - low) * F.col(f"__{name}_share")).alias(name))
    return aggregates, outputs


def quantiles_by(
    df: DataFrame, value: str, quantiles: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles per group, without holding a group in one task."""
    by = list(by)
    if by:
        df = df.dropna(subset=by)
    counted = running_totals(value_counts(df, value, by), [value], ["n"], by)
    aggregates, outputs = quantile_columns(value, "n", quantiles)
    return counted.groupBy(*by).agg(*aggregates).select(*by, *outputs)
