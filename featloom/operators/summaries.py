"""Every function of every numeric column per key: wide rows shuffled once by key, hot keys from a histogram of their values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEY, SLOT, REAL, WHOLE = "__key", "__slot", "__real", "__whole"
# Up to so many rows the long form serves all keys; a key with more cells than HOT_CELLS is spread over the tasks by its values.
LONG_FORM_ROWS, HOT_CELLS = 100_000, 1_000_000
KEY_BUCKETS, MOST_HOT_KEYS = 1 << 16, 10_000
WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
REAL_TYPES = (T.FloatType, T.DoubleType)

EITHER = f"coalesce({REAL}, CAST({WHOLE} AS DOUBLE))"
# Per function: its parts in the long form, and the SQL that takes a column's value from them.
PARTS: dict[str, dict[str, str]] = {
    "mean": {"mean": f"avg({EITHER})"},
    "var": {"var": f"var_samp({EITHER})"},
    "std": {"std": f"stddev_samp({EITHER})"},
    "count": {"count": f"count({EITHER})"},
    "nunique": {"nunique": f"count(DISTINCT CASE WHEN {EITHER} IS NOT NULL THEN struct({REAL}, {WHOLE}) END)"},
    "min": {"min_real": f"min({REAL})", "min_whole": f"min({WHOLE})"},
    "max": {"max_real": f"max({REAL})", "max_whole": f"max({WHOLE})"},
    "sum": {"sum_real": f"sum({REAL})", "sum_whole": f"sum({WHOLE})"},
}


def summarisable(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """The columns whose type the histogram holds."""
    return [c for c in columns if isinstance(df.schema[c].dataType, (*WHOLE_TYPES, *REAL_TYPES))]


def numeric_summaries(
    df: DataFrame,
    key: str,
    columns: Sequence[str],
    functions: Sequence[str],
    prefix: str = "",
    count_as: str | None = None,
    long_form_rows: int = LONG_FORM_ROWS,
    hot_cells: int = HOT_CELLS,
) -> DataFrame:
    """One row per non-null key with ``PREFIX_column_FUNC`` for every column and function.

    The rows of a key are shuffled once, as they are, and their functions taken where they meet; a distinct count holds the values of
    one key and column. A key of more than ``hot_cells`` cells would hold up one task: such keys, found by a count before, go through the long
    form, as do tables of at most ``long_form_rows`` rows. Whole numbers keep their 64 bits. A function of nothing is null, a sum or count of nothing 0.
    """
    strange = [c for c in columns if not isinstance(df.schema[c].dataType, (*WHOLE_TYPES, *REAL_TYPES))]
    if strange or not columns:
        raise ValueError(f"not numeric: {strange}" if strange else "no column to summarise")
    known = df.where(F.col(f"`{key}`").isNotNull())
    rows, hot = _measured_keys(known.select(F.col(f"`{key}`").alias(KEY)), max(hot_cells // len(columns), 1), long_form_rows)
    if rows <= long_form_rows:
        return _long_summaries(known, key, columns, functions, prefix, count_as)
    if not hot:
        return _wide_summaries(known, key, columns, functions, prefix, count_as)
    is_hot = F.col(f"`{key}`").isin(hot)
    wide = _wide_summaries(known.where(~is_hot), key, columns, functions, prefix, count_as)
    return wide.unionByName(_long_summaries(known.where(is_hot), key, columns, functions, prefix, count_as))


def _measured_keys(keys: DataFrame, most_rows: int, long_form_rows: int) -> tuple[int, list]:
    """Number of rows, and the keys with more than ``most_rows`` of them (the largest ``MOST_HOT_KEYS``) if rows are not few.

    Rows are counted by a hash of their key, so little is shuffled; keys are counted one by one in buckets that are large only.
    """
    bucket = F.pmod(F.xxhash64(KEY), F.lit(KEY_BUCKETS)).cast("int")
    sizes = keys.groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n")).collect()
    rows = sum(r["n"] for r in sizes)
    large = [r["bucket"] for r in sizes if r["n"] > most_rows]
    if rows <= long_form_rows or not large:
        return rows, []
    counted = keys.where(bucket.isin(large)).groupBy(KEY).agg(F.count("*").alias("n")).where(F.col("n") > most_rows)
    return rows, [r[KEY] for r in counted.orderBy(F.desc("n"), KEY).limit(MOST_HOT_KEYS).collect()]


def _wide_summaries(known: DataFrame, key: str, columns: Sequence[str], functions: Sequence[str], prefix: str, count_as: str | None) -> DataFrame:
    """One shuffle of the rows by key, one aggregate where they meet."""
    fields = {c: known.schema[c].dataType for c in columns}
    values = [F.col(f"`{c}`").cast("long" if isinstance(fields[c], WHOLE_TYPES) else "double").alias(f"v{i}") for i, c in enumerate(columns)]
    met = known.select(F.col(f"`{key}`").alias(KEY), *values).repartition(F.col(KEY))
    kinds = {"sum": "sum", "count": "count", "mean": "avg", "var": "var_samp", "std": "var_samp", "min": "min", "max": "max"}
    aggregates = {f"{sql}{i}": f"{sql}(v{i})" for i in range(len(columns)) for sql in dict.fromkeys(kinds[f] for f in functions if f in kinds)}
    if "nunique" in functions:
        # Adding 0 makes -0.0 and 0.0 one value.
        lists = {f"list{i}": f"collect_list(v{i}{'' if isinstance(fields[c], WHOLE_TYPES) else ' + 0D'})" for i, c in enumerate(columns)}
        aggregates |= lists
    stats = met.groupBy(KEY).agg(F.count("*").alias("rows"), *[F.expr(f"{sql} AS {name}") for name, sql in aggregates.items()])

    def value_of(i: int, c: str, f: str):
        if f == "nunique":
            return F.size(F.array_distinct(f"list{i}")).cast("long")
        value = F.col(f"{kinds[f]}{i}")
        if f == "sum":
            return F.coalesce(value, F.lit(0))
        return F.sqrt(value) if f == "std" else value.cast(fields[c]) if f in ("min", "max") else value

    out = [value_of(i, c, f).alias(f"{prefix}{c}_{f.upper()}") for i, c in enumerate(columns) for f in functions]
    if count_as:
        out.append(F.col("rows").alias(count_as))
    return stats.select(F.col(KEY).alias(key), *out)


def _long_summaries(known: DataFrame, key: str, columns: Sequence[str], functions: Sequence[str], prefix: str, count_as: str | None) -> DataFrame:
    """The same from one histogram of the values.

    The rows are turned into (key, column, value) and shuffled three times whatever the number of columns: by key, column and
    value, where equal values meet after a map-side sum, by key and column, and by key. A key held by a third of the
    rows is spread over the tasks by its values in the first shuffle and arrives as one partial row a task in the second. The list gathered
    for a key has one entry per column.
    """
    fields = {c: known.schema[c].dataType for c in columns}
    parts = {name: sql for f in functions for name, sql in PARTS[f].items()}
    if count_as:
        parts["rows"] = "count(*)"
    none = {REAL: F.lit(None).cast("double"), WHOLE: F.lit(None).cast("long")}
    cells = []
    for i, c in enumerate(columns):
        whole = isinstance(fields[c], WHOLE_TYPES)
        value = F.col(f"`{c}`").cast("long" if whole else "double")
        held = none | {WHOLE if whole else REAL: value}
        cells.append(F.struct(F.lit(i).alias(SLOT), *[v.alias(n) for n, v in held.items()]))
    long = known.select(F.col(f"`{key}`").alias(KEY), F.inline(F.array(*cells)))
    stats = long.groupBy(KEY, SLOT).agg(*[F.expr(f"{sql} AS {name}") for name, sql in parts.items()])
    # Every row has a cell for every column, so a key's sorted list holds column i at place i.
    gathered = stats.groupBy(KEY).agg(F.sort_array(F.collect_list(F.struct(SLOT, *parts))).alias("cells"))

    def value_of(i: int, c: str, f: str):
        cell = F.col("cells")[i]
        if f in ("mean", "var", "std", "count", "nunique"):
            return cell[f]
        whole = isinstance(fields[c], WHOLE_TYPES)
        value = cell[f"{f}_{'whole' if whole else 'real'}"]
        return F.coalesce(value, F.lit(0)) if f == "sum" else value.cast(fields[c])

    out = [value_of(i, c, f).alias(f"{prefix}{c}_{f.upper()}") for i, c in enumerate(columns) for f in functions]
    if count_as:
        out.append(F.col("cells")[0]["rows"].alias(count_as))
    return gathered.select(F.col(KEY).alias(key), *out)
