"""Spec-driven group-bys: per-key features, category shares, status subsets, column summaries."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.functions.values import flag
from featloom.operators.places import packed_period, packed_place
from featloom.operators.summaries import numeric_summaries, summarisable
from featloom.workspace import materialise

# SQL text keeps plan building cheap for specs with hundreds of outputs.
AGGREGATES: dict[str, str] = {
    "min": "min({c})",
    "max": "max({c})",
    "mean": "avg({c})",
    "sum": "coalesce(sum({c}), 0)",
    "var": "var_samp({c})",
    "std": "stddev_samp({c})",
    "count": "count({c})",
    "nunique": "count(DISTINCT {c})",
}
# A hash aggregate with more functions than this outgrows the size the JVM compiles.
AGGREGATES_PER_PASS = 50
DISTINCT_PER_PASS = 4
MERGEABLE = {"min", "max", "mean", "sum", "var", "std", "count"}
NULL_CATEGORY = "NaN"


def category_name(value: Any) -> str:
    return NULL_CATEGORY if value is None else re.sub(r"\W+", "_", str(value))


def category_columns(categories: dict[str, Sequence[Any]]) -> dict[str, tuple[str, Any]]:
    """Output name -> (column, value) for every category; a name that is taken gets a number.

    Null keeps the plain null name, also where a value reads the same.
    """
    names: dict[tuple[str, int], str] = {}
    taken: set[str] = set()
    cells = [(c, i, v) for c, values in categories.items() for i, v in enumerate(values)]
    for c, i, v in sorted(cells, key=lambda cell: cell[2] is not None):
        name = base = f"{c}_{category_name(v)}"
        suffix = 1
        while name in taken:
            suffix += 1
            name = f"{base}_{suffix}"
        taken.add(name)
        names[c, i] = name
    return {names[c, i]: (c, v) for c, i, v in cells}


def quoted(name: str) -> str:
    return f"`{name}`"


def grouped(df: DataFrame, keys: Sequence[str], aggregates: Sequence[tuple[str, str]]) -> DataFrame:
    """``groupBy(keys).agg`` of (name, SQL) pairs, in passes over disjoint columns if there are many.

    Each pass reads only its own columns, and the results are joined on the
    keys they are already hashed by. Distinct counts get passes of their own:
    they copy a row once per counted column, which the other functions must
    not be dragged into. The keys must not be null.
    """
    plain = [a for a in aggregates if "DISTINCT" not in a[1]]
    distinct = [a for a in aggregates if "DISTINCT" in a[1]]
    chunks = [plain[i : i + AGGREGATES_PER_PASS] for i in range(0, len(plain), AGGREGATES_PER_PASS)]
    chunks += [distinct[i : i + DISTINCT_PER_PASS] for i in range(0, len(distinct), DISTINCT_PER_PASS)]
    if not chunks:
        return df.select(*keys).distinct()
    passes = [df.groupBy(*keys).agg(*[F.expr(f"{sql} AS {quoted(name)}") for name, sql in chunk]) for chunk in chunks]
    joined = reduce(lambda a, b: a.join(b, list(keys)), passes)
    return joined.select(*keys, *[quoted(name) for name, _ in aggregates])


def indicator(column: str, value: Any) -> Column:
    return flag(F.col(column).eqNullSafe(F.lit(value)))


@dataclass(frozen=True)
class RollupSpec:
    """What to compute per key.

    ``measures`` maps a column to function names, ``shares`` maps a category
    column to the values whose row share is wanted, ``count_as`` names the row
    count. Output names are ``PREFIX_column_FUNC``.
    """

    key: str
    prefix: str
    measures: dict[str, Sequence[str]] = field(default_factory=dict)
    shares: dict[str, Sequence[Any]] = field(default_factory=dict)
    count_as: str | None = None

    def name(self, column: str, function: str, prefix: str | None = None) -> str:
        return f"{self.prefix if prefix is None else prefix}{column}_{function.upper()}"

    def share_columns(self) -> dict[str, Column]:
        return {name: indicator(c, v) for name, (c, v) in category_columns(self.shares).items()}


def category_shares(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Long form of the category shares: (key, column, value, share) for every value a key has.

    The number of categories is not bounded; null is a value of its own. Null keys are left out.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    source = df.where(F.col(key).isNotNull())
    counted = source.select(key, F.inline(cells)).groupBy(key, "column", "value").agg(F.count("*").alias("n"))
    sizes = source.groupBy(key).agg(F.count("*").alias("__rows"))
    return counted.join(sizes, key).select(key, "column", "value", (F.col("n") / F.col("__rows")).alias("share"))


def rollup(df: DataFrame, spec: RollupSpec) -> DataFrame:
    """One row per non-null key."""
    shares = spec.share_columns()
    source = df.where(F.col(spec.key).isNotNull())
    if shares:
        source = source.withColumns({f"share|{n}": c for n, c in shares.items()})
    aggregates = [
        (spec.name(c, f), AGGREGATES[f].format(c=quoted(c))) for c, functions in spec.measures.items() for f in functions
    ]
    aggregates += [(spec.name(n, "mean"), f"avg({quoted(f'share|{n}')})") for n in shares]
    if spec.count_as:
        aggregates.append((spec.count_as, "count(*)"))
    return grouped(source, [spec.key], aggregates)


PARTIALS = {"min": "min", "max": "max", "count": "count", "sum": "sum", "spread": "var_pop"}
NEEDED = {
    "min": {"min"},
    "max": {"max"},
    "count": {"count"},
    "sum": {"sum"},
    "mean": {"count", "sum"},
    "var": {"count", "sum", "spread"},
    "std": {"count", "sum", "spread"},
}


def _partials(measures: dict[str, Sequence[str]]) -> dict[str, list[str]]:
    """Per measure, the partial statistics its functions are made of."""
    return {c: [p for p in PARTIALS if any(p in NEEDED[f] for f in fs)] for c, fs in measures.items()}


def _final(c: str, function: str, squares: str) -> str:
    """SQL of one statistic from the partial columns of a measure."""
    n, total = f"`count|{c}`", f"`sum|{c}`"
    variance = f"CASE WHEN {n} > 1 THEN try_divide({squares}, {n} - 1) END"
    return {
        "min": f"`min|{c}`",
        "max": f"`max|{c}`",
        "count": n,
        "sum": f"coalesce({total}, 0)",
        "mean": f"try_divide(CAST({total} AS DOUBLE), {n})",
        "var": variance,
        "std": f"sqrt({variance})",
    }[function]


def rollup_with_subsets(
    df: DataFrame,
    spec: RollupSpec,
    status: str,
    subsets: dict[str, Any],
    subset_shares: bool = True,
) -> DataFrame:
    """The rollup of all rows beside the same rollup of the rows with each status.

    ``subsets`` maps a column prefix to a status value; a key without such rows
    gets null there. The detail rows are read and shuffled once: partial
    statistics per (key, status) are written, and both the subsets and the
    overall values are taken from that far smaller table.
    """
    unmergeable = {f for fs in spec.measures.values() for f in fs} - MERGEABLE
    if unmergeable:
        raise ValueError(f"not mergeable across statuses: {sorted(unmergeable)}")
    key, measures, shares = spec.key, spec.measures, spec.share_columns()
    labels = dict(enumerate(subsets.values()))
    part = F.lit(-1)
    for label, value in labels.items():
        part = F.when(F.col(status).eqNullSafe(F.lit(value)), label).otherwise(part)
    flagged = [c.alias(f"share|{n}") for n, c in shares.items()]
    detail = df.where(F.col(key).isNotNull()).select(key, *measures, *flagged, part.alias("part"))
    share_sums = [(f"share|{n}", f"sum(`share|{n}`)") for n in shares]
    needed = _partials(measures)
    partials = [("rows", "count(*)"), *share_sums]
    partials += [(f"{p}|{c}", f"{PARTIALS[p]}({quoted(c)})") for c, ps in needed.items() for p in ps]
    parts = materialise(grouped(detail, [key, "part"], partials), "parts")

    # Squares about the merged mean: within the part, plus the shift of the part mean.
    spread = [c for c, fs in measures.items() if {"var", "std"} & set(fs)]
    over_key = f"OVER (PARTITION BY {quoted(key)})"
    centred = parts.select(
        "*",
        *[
            F.expr(
                f"try_divide(CAST(sum(`sum|{c}`) {over_key} AS DOUBLE), sum(`count|{c}`) {over_key}) AS `centre|{c}`"
            )
            for c in spread
        ],
    )
    sums = [("rows", "sum(rows)"), *share_sums]
    for c, ps in needed.items():
        sums += [(f"{p}|{c}", f"{'sum' if p in ('count', 'sum') else p}(`{p}|{c}`)") for p in ps if p != "spread"]
    for c in spread:
        shift = f"try_divide(CAST(`sum|{c}` AS DOUBLE), `count|{c}`) - `centre|{c}`"
        sums.append((f"squares|{c}", f"sum(`count|{c}` * (`spread|{c}` + pow({shift}, 2)))"))
    merged = grouped(centred, [key], sums)

    def block(prefix: str, squares: str, with_shares: bool, count_as: str | None) -> list[Column]:
        stats = [
            (spec.name(c, f, prefix), _final(c, f, squares.format(c=c)))
            for c, functions in measures.items()
            for f in functions
        ]
        if with_shares:
            stats += [(spec.name(n, "mean", prefix), f"try_divide(`share|{n}`, rows)") for n in shares]
        if count_as:
            stats.append((count_as, "rows"))
        return [F.expr(f"{sql} AS {quoted(n)}") for n, sql in stats]

    out = merged.select(key, *block(spec.prefix, "`squares|{c}`", True, spec.count_as))
    for label, prefix in enumerate(subsets):
        count_as = f"{prefix}{spec.count_as}" if spec.count_as else None
        rows = parts.where(F.col("part") == label)
        own = block(prefix, "`spread|{c}` * `count|{c}`", subset_shares, count_as)
        out = out.join(rows.select(key, *own), key, "left")
    return out


def rollup_subsets_by_join(
    df: DataFrame, spec: RollupSpec, status: str, subsets: dict[str, Any]
) -> DataFrame:
    """Same result from one filtered rollup per status; needed for distinct counts."""
    out = rollup(df, spec)
    for prefix, value in subsets.items():
        count_as = f"{prefix}{spec.count_as}" if spec.count_as else None
        part = RollupSpec(spec.key, prefix, spec.measures, spec.shares, count_as)
        out = out.join(rollup(df.where(F.col(status) == value), part), spec.key, "left")
    return out


def summarise_all(df: DataFrame, key: str, functions: Sequence[str], prefix: str = "",
                  drop: Sequence[str] = (), count_as: str | None = None) -> DataFrame:
    """Every remaining column through every function.

    With distinct counts, numeric columns come from one histogram of their values, whatever their number; without, one
    hashed pass over the columns as they are is less work.
    """
    columns = [c for c in df.columns if c != key and c not in drop]
    numeric = summarisable(df, columns) if "nunique" in functions else []
    others = [c for c in columns if c not in numeric]
    if not numeric:
        return rollup(df, RollupSpec(key, prefix, {c: list(functions) for c in columns}, {}, count_as))
    out = numeric_summaries(df, key, numeric, functions, prefix, count_as)
    if others:
        out = out.join(rollup(df, RollupSpec(key, prefix, {c: list(functions) for c in others})), key)
    order = [f"{prefix}{c}_{f.upper()}" for c in columns for f in functions]
    return out.select(key, *[quoted(c) for c in order], *([count_as] if count_as else []))


def first_and_last(
    df: DataFrame, key: str, value: str, order_by: Sequence[str], first: str, last: str
) -> DataFrame:
    """First and last non-null value per key in an explicit, total order.

    Order and value are packed in one number where they fit, so that rows are aggregated by hash before they are shuffled; equal places
    go by value. Other orders compare the columns, which sorts the rows.
    """
    known = df.where(F.col(key).isNotNull() & F.col(value).isNotNull()).select(key, *dict.fromkeys(c for c in (value, *order_by) if c != key))
    packed = packed_place(known, order_by, value)
    if packed is None:
        place = F.struct(*order_by)
        return known.groupBy(key).agg(F.min_by(value, place).alias(first), F.max_by(value, place).alias(last))
    ends = known.groupBy(key).agg(F.min(packed.place).alias("__first"), F.max(packed.place).alias("__last"))
    return ends.select(key, packed.value_at("__first").alias(first), packed.value_at("__last").alias(last))


def status_history(
    df: DataFrame,
    key: str,
    period: str,
    status: str,
    closed: Any,
    counted: Sequence[Any],
    non_zero: Sequence[Any],
    tie_break: Sequence[str] = (),
    also: Sequence[Column] = (),
    statuses: Sequence[Any] | None = None,
) -> DataFrame:
    """Life of a loan from its periodic status, in one group-by.

    ``period`` is a negative offset, so the smallest value is the oldest row.
    Status counts are null for a status that never occurs. ``also`` adds further
    aggregates to the same group-by. With ``statuses``, all that can occur, the first and the last one are taken by hash
    from a packed number; rows of one period go by the order of that list, and ``tie_break`` must be left out.
    """
    if statuses is not None and tie_break:
        raise ValueError("rows of one period go either by tie_break or by the order of statuses")
    listed = [s for s in statuses or () if s is not None]
    if statuses is None:
        known = F.when(F.col(status).isNotNull(), F.struct(period, *tie_break))
        ends = [F.min_by(status, known).alias("First_status"), F.max_by(status, known).alias("Last_status")]
    else:
        packed = packed_period(period, status, listed, df.schema[status].dataType)
        ends = [packed.value_at(f(packed.place)).alias(n) for n, f in (("First_status", F.min), ("Last_status", F.max))]
    at_status = lambda s: F.coalesce(F.col(status) == F.lit(s), F.lit(False))
    facts = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            *ends,
            F.abs(F.min(period)).alias("Month"),
            F.abs(F.min(F.when(at_status(closed), F.col(period)))).alias("When_closed"),
            *[F.nullif(F.count_if(at_status(s)), F.lit(0)).alias(f"DPD_{s}_cnt") for s in counted],
            *also,
        )
    )
    late = sum((F.coalesce(F.col(f"DPD_{s}_cnt"), F.lit(0)) for s in non_zero), F.lit(0))
    return facts.withColumns(
        {
            "Month_closed_to_end": F.col("Month") - F.col("When_closed"),
            **{f"DPD_{s}_per_Month": F.try_divide(f"DPD_{s}_cnt", "Month") for s in counted},
            "Non_zero_DPD_cnt": late,
        }
    )


def column_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """min, max, mean, null count per column in long form, from one pass."""
    wide = df.agg(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
                F.avg(c).alias("mean"),
                F.count_if(F.col(c).isNull()).alias("nulls"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.select(F.inline(F.array(*[F.col(c) for c in columns])))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values per column, counted in long form."""
    pairs = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.inline(pairs))
        .groupBy("feature", "value")
        .agg(F.lit(1).alias("one"))
        .groupBy("feature")
        .agg(F.count("value").alias("n_distinct"))
    )


def share_of(df: DataFrame, key: str, column: str, values: Sequence[Any], prefix: str) -> DataFrame:
    return rollup(df, RollupSpec(key, prefix, {}, {column: values}))
