"""Category encoders, imputers and the rank-Gauss transform.

``fit`` runs one grouped job over all columns it needs; ``transform`` is a
projection or a join to the fitted table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.functions.special import erfinv
from featloom.operators.assemble import to_long
from featloom.operators.rank import exact_rank, quantiles_by
from featloom.operators.rollup import NULL_CATEGORY, category_columns, indicator
from featloom.workspace import SMALL_TABLE_ROWS, lookup_join, materialise, small_or_none

MAX_ONE_HOT_COLUMNS = 10_000
# A text column with more values than this has no column for each of them in a wide table.
WIDE_VALUES = 1_000


def _pairs(df: DataFrame, columns: Sequence[str], keep: Sequence[Any] = ()) -> DataFrame:
    """(column, value, keep..) with one row per category cell."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    )
    return df.select(F.inline(cells), *keep)


def observed_categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[Any]]:
    """Met values per column in sorted order, null last; one job for all columns."""
    found = small_or_none(_pairs(df, columns).distinct(), MAX_ONE_HOT_COLUMNS)
    if found is None:
        raise ValueError(
            f"more than {MAX_ONE_HOT_COLUMNS} categories in {list(columns)}: one column per value "
            "is not workable, use TargetMean, FirstSeenCodes or AlphabeticalCodes"
        )
    out: dict[str, list[Any]] = {c: [] for c in columns}
    for row in found.collect():
        out[row["column"]].append(row["value"])
    return {c: sorted(vs, key=lambda v: (v is None, v or "")) for c, vs in out.items()}


def narrow_text_columns(df: DataFrame, columns: Sequence[str], values: int = WIDE_VALUES) -> list[str]:
    """The columns with at most ``values`` values, narrowest first up to the bound on all one-hot columns.

    The others' shares come in long form (``category_shares``). One count for each column reaches the driver.
    """
    if not columns:
        return []
    counts = _pairs(df, columns).distinct().groupBy("column").agg(F.count("*").alias("n"))
    met = {r["column"]: r["n"] for r in counts.collect()}
    chosen, total = set(), 0
    for c in sorted(columns, key=lambda c: (met.get(c, 0), c)):
        total += met.get(c, 0)
        if met.get(c, 0) <= values and total <= MAX_ONE_HOT_COLUMNS:
            chosen.add(c)
    return [c for c in columns if c in chosen]


@dataclass(frozen=True)
class OneHot:
    """0/1 columns ``c_value``; the source columns are dropped."""

    categories: dict[str, list[Any]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str], null_column: str = "observed") -> "OneHot":
        """``null_column``: 'observed' adds it where nulls were met, 'always', or 'never'."""
        found = observed_categories(df, columns)
        for values in found.values():
            if null_column != "observed" and None in values:
                values.remove(None)
            if null_column == "always":
                values.append(None)
        return cls(found)

    def columns(self) -> dict[str, Column]:
        return {name: indicator(c, v) for name, (c, v) in category_columns(self.categories).items()}

    def transform(self, df: DataFrame) -> DataFrame:
        kept = [c for c in df.columns if c not in self.categories]
        return df.select(*kept, *[e.alias(n) for n, e in self.columns().items()])


def _replace(df: DataFrame, table: DataFrame, column: str, value: str, out: str) -> DataFrame:
    """``out`` = ``value`` of the (category, value) ``table`` row for this row's category."""
    lookup = table.select(F.col("value").alias("__category"), F.col(value).alias("__code"))
    keyed = df.withColumn("__category", F.col(column).cast("string"))
    joined = lookup_join(keyed, lookup, ["__category"]).drop("__category")
    return joined.withColumn(out, F.col("__code")).drop("__code")


@dataclass(frozen=True)
class TargetMean:
    """Mean label per category of the training rows; null and unseen categories give null.

    With ``fold`` a training row is encoded from the other folds only and a
    scoring row (null fold) from all of them.
    """

    columns: tuple[str, ...]
    table: DataFrame
    fold: str | None = None

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], label: str, fold: str | None = None) -> "TargetMean":
        by_fold = [F.col(fold).alias("__fold")] if fold else []
        cells = _pairs(train.where(F.col(label).isNotNull()), columns, [F.col(label).alias("y"), *by_fold])
        sums = (
            cells.where(F.col("value").isNotNull())
            .groupBy("column", "value", *(["__fold"] if fold else []))
            .agg(F.sum("y").cast("double").alias("s"), F.count("y").alias("n"))
        )
        if not fold:
            return cls(tuple(columns), sums.select("column", "value", (F.col("s") / F.col("n")).alias("mean")))
        parts = materialise(sums, "target-mean")
        whole = parts.groupBy("column", "value").agg(F.sum("s").alias("all_s"), F.sum("n").alias("all_n"))
        others = parts.join(whole, ["column", "value"]).select(
            "column",
            "value",
            "__fold",
            F.try_divide(F.col("all_s") - F.col("s"), F.col("all_n") - F.col("n")).alias("mean"),
        )
        scoring = whole.select(
            "column", "value", F.lit(None).cast("int").alias("__fold"), (F.col("all_s") / F.col("all_n")).alias("mean")
        )
        return cls(tuple(columns), others.unionByName(scoring), fold)

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        table = small_or_none(self.table)
        if table is None:
            table = materialise(self.table, "target-mean")
        for c in self.columns:
            part = table.where(F.col("column") == c)
            if not self.fold:
                df = _replace(df, part, c, "mean", f"{c}{suffix}")
                continue
            lookup = part.select(
                F.col("value").alias("__category"),
                F.coalesce(F.col("__fold").cast("int"), F.lit(-1)).alias("__slot"),
                F.col("mean").alias("__code"),
            )
            keyed = df.withColumn("__category", F.col(c).cast("string")).withColumn(
                "__slot", F.coalesce(F.col(self.fold).cast("int"), F.lit(-1))
            )
            joined = lookup_join(keyed, lookup, ["__category", "__slot"])
            df = joined.withColumn(f"{c}{suffix}", F.col("__code")).drop("__category", "__slot", "__code")
        return df


def _numbered_per_column(table: DataFrame, columns: Sequence[str], order_by: list[str]) -> dict[str, DataFrame] | None:
    """Numbered categories of several columns from one collected table, or None if it is too large to collect."""
    small = small_or_none(table)
    if small is None:
        return None
    ordered = Window.partitionBy("column").orderBy(*order_by)
    numbered = small_or_none(small.withColumn("code", (F.row_number().over(ordered) - 1).cast("long")))
    return {c: numbered.where(F.col("column") == c).select("value", "code") for c in columns}


def _numbered(table: DataFrame, order_by: list[str], max_rows: int) -> DataFrame:
    """``table`` with a zero-based ``code`` in the given order."""
    small = small_or_none(table, max_rows)
    if small is not None:
        ordered = Window.orderBy(*order_by)
        return small.withColumn("code", (F.row_number().over(ordered) - 1).cast("long"))
    return exact_rank(table, order_by, (), "code")


@dataclass(frozen=True)
class FirstSeenCodes:
    """0.. in order of the smallest row key of each category; null gives -1."""

    column: str
    table: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, column: str, key: str, max_small: int = SMALL_TABLE_ROWS) -> "FirstSeenCodes":
        firsts = (
            df.where(F.col(column).isNotNull())
            .groupBy(F.col(column).cast("string").alias("value"))
            .agg(F.min(key).alias("first"))
        )
        return cls(column, _numbered(firsts, ["first", "value"], max_small).select("value", "code"))

    @classmethod
    def fit_all(cls, df: DataFrame, columns: Sequence[str], key: str) -> "list[FirstSeenCodes]":
        """One scan for all columns; a set of columns with too many categories is fitted one by one."""
        cells = _pairs(df, columns, [F.col(key).alias("key")]).where(F.col("value").isNotNull())
        firsts = cells.groupBy("column", "value").agg(F.min("key").alias("first"))
        tables = _numbered_per_column(firsts, columns, ["first", "value"])
        return [cls(c, tables[c]) if tables else cls.fit(df, c, key) for c in columns]

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        out = out or self.column
        missing = F.when(F.col(self.column).isNull(), F.lit(-1).cast("long"))
        coded = df.withColumn("__missing", missing)
        coded = _replace(coded, self.table, self.column, "code", out)
        return coded.withColumn(out, F.coalesce("__missing", out)).drop("__missing")


@dataclass(frozen=True)
class AlphabeticalCodes:
    """1..k in alphabetical order; null stays null."""

    column: str
    table: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, column: str, max_small: int = SMALL_TABLE_ROWS) -> "AlphabeticalCodes":
        values = df.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("value")).distinct()
        return cls(column, _numbered(values, ["value"], max_small).select("value", (F.col("code") + 1).alias("code")))

    @classmethod
    def fit_all(cls, df: DataFrame, columns: Sequence[str]) -> "list[AlphabeticalCodes]":
        """One scan for all columns; a set of columns with too many categories is fitted one by one."""
        cells = _pairs(df, columns).where(F.col("value").isNotNull()).distinct()
        tables = _numbered_per_column(cells, columns, ["value"])
        if tables is None:
            return [cls.fit(df, c) for c in columns]
        return [cls(c, tables[c].select("value", (F.col("code") + 1).alias("code"))) for c in columns]

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        return _replace(df, self.table, self.column, "code", out or self.column)


def group_median_lookup(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Median of ``value`` in the row's group, on every row; a null group gives null."""
    medians = quantiles_by(df, value, {out: 0.5}, [group])
    return lookup_join(df, medians, [group])


def fill_with_literal(df: DataFrame, values: dict[str, Any]) -> DataFrame:
    return df.fillna(values)


def fill_null_category(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.fillna(NULL_CATEGORY, list(columns))


def column_means(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    row = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    return {c: float(m) for c, m in row.items() if m is not None}


def fill_with_mean(
    df: DataFrame,
    columns: Sequence[str],
    label: str | None = None,
    fit_on: str = "all",
    limit: float | None = None,
) -> DataFrame:
    """Nulls become the column mean of ``fit_on`` ('all', or 'train' = labelled rows), then clip."""
    source = df.where(F.col(label).isNotNull()) if fit_on == "train" else df
    means = column_means(source, columns)
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(means.get(c))) for c in columns}
    if limit is not None:
        filled = {c: F.greatest(F.least(e, F.lit(limit)), F.lit(-limit)) for c, e in filled.items()}
    return df.withColumns(filled)


def add_null_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_isnull": F.col(c).isNull().cast("int") for c in columns})


def fill_derived_with_mean(df: DataFrame, derived: str) -> DataFrame:
    """Nulls of a computed column become its own global mean."""
    mean = df.agg(F.avg(derived)).scalar()
    return df.withColumn(derived, F.coalesce(F.col(derived), mean))


def rank_gauss(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Each column replaced by the normal score of its rank over all rows.

    All columns share one range sort in long form. Positions are symmetric
    about the middle and ``erfinv`` is odd, so the scores already have mean 0.
    Ties are ordered by ``key``; a null stays null and is not ranked.
    """
    long = to_long(df, [key], columns).where(F.col("value").isNotNull())
    ranked = exact_rank(long, ["value", key], ["feature"])
    rows = ranked.groupBy("feature").agg((F.max("rank") + 1).alias("rows"))
    n = F.col("rows").cast("double")
    score = erfinv((2 * F.col("rank") - (n - 1)) / n)
    scored = lookup_join(ranked, rows, ["feature"]).select(key, "feature", score.alias("score"))
    wide = scored.groupBy(key).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("score"))).alias(c) for c in columns]
    )
    return df.drop(*columns).join(wide, key, "left").select(*df.columns)
