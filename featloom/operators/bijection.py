"""Keyed bijections on 0..n-1: random permutations without a sort.

A place is split into two digits of a base near the root of n. Rounds that add a keyed hash of one digit to the
other turn the grid of digits into itself (a small Feistel network); a place that lands beyond n is sent on until it comes back (cycle walking), which less than one place in
sqrt(n) needs. A permutation is then an expression of the row's place, for any number of seeds at once; only the places
themselves, the same for all seeds, cost a sort.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators.rank import exact_rank
from featloom.workspace import materialise

PLACE = "__slot"
ROUNDS = 6
MODULUS = (1 << 31) - 1
#: Most steps of a walk. A walk passes a place beyond n only once and there are fewer than sqrt(n), so small tables never
#: reach it; in a large one a walk of w steps has a chance of n ** (-w / 2).
STEPS = 24
#: Most classes that a label may have.
MOST_CLASSES = 1000


def round_keys(seed: int | str) -> list[tuple[int, int]]:
    """Factor and shift of each round's hash."""
    digest = lambda k: hashlib.md5(f"{seed}:{k}".encode()).hexdigest()
    return [(int(digest(k)[:8], 16) % (MODULUS - 1) + 1, int(digest(k)[8:16], 16) % MODULUS) for k in range(ROUNDS)]


def grid(n: int) -> tuple[int, int]:
    """The bases (a, b) of the digits: a * b is at least n, and less than n + a."""
    a = max(1, math.isqrt(n - 1) + 1) if n > 1 else 1
    return a, max(1, -(-n // a))


def keyed_bijections(place: Column, n: int, seeds: Sequence[int | str]) -> Column:
    """Where the row at ``place`` goes under each seed, as an array; every seed meets each of 0..n-1 once. The expression
    does not grow with the seeds, whose keys are one constant."""
    a, b, modulus, bound = (F.lit(x).cast("long") for x in (*grid(n), MODULUS, n))
    keys = F.from_json(F.lit(json.dumps([[x for pair in round_keys(s) for x in pair] for s in seeds])), "array<array<bigint>>")

    def step(v: Column, own: Column) -> Column:
        x, y = v % a, F.call_function("div", v, a)
        for k in range(ROUNDS):
            moved = lambda digit: (digit * own[2 * k] + own[2 * k + 1]) % modulus
            x, y = ((x + moved(y)) % a, y) if k % 2 == 0 else (x, (y + moved(x)) % b)
        return y * a + x

    def walk(own: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(STEPS)), place.cast("long"), lambda v, i: F.when((i == 0) | (v >= bound), step(v, own)).otherwise(v))

    lost = F.raise_error(F.lit("no place within the steps of a walk: take another seed")).cast("long")
    return F.transform(F.transform(keys, walk), lambda v: F.when(v.isNull() | (v < bound), v).otherwise(lost))


def keyed_bijection(place: Column, n: int, seed: int | str) -> Column:
    """Where the row at ``place`` goes; a null place stays null."""
    return keyed_bijections(place, n, [seed])[0]


def with_places(df: DataFrame, key: str, out: str = PLACE) -> tuple[DataFrame, int]:
    """``df`` with each row's place in key order, written once, and the number of rows."""
    placed = materialise(exact_rank(df, [key], (), out), "places")
    return placed, placed.count()


def permute(df: DataFrame, key: str, columns: Sequence[str], seeds: Sequence[int | str], seed_column: str = "seed") -> DataFrame:
    """``columns`` shuffled over the rows, once per seed: (seed, key, columns).

    The row at place r in key order takes the values of the row at the place that the seed's bijection gives for r, so every value is used
    exactly once. All seeds share one join on the place.
    """
    placed, n = with_places(df.select(key, *columns), key)
    names = F.array(*[F.lit(str(s)) for s in seeds])
    donors = F.arrays_zip(names.alias("seed"), keyed_bijections(F.col(PLACE), n, seeds).alias("donor"))
    takers = placed.select(key, F.explode(donors).alias("d")).select(key, F.col("d")["seed"].alias(seed_column), F.col("d")["donor"].alias(PLACE))
    return takers.join(placed.drop(key), PLACE).select(seed_column, key, *columns)


def permuted_classes(df: DataFrame, key: str, label: str, seeds: Sequence[int | str], out: str = "labels") -> DataFrame:
    """``df`` with an array of its labels shuffled over the rows, one entry per seed; nothing is joined.

    The labels in the order of their values are as good a list to draw from as any other, so a row's label under a seed is
    the class whose range of the cumulative class sizes holds the row's place under the bijection. Labels are not null.
    """
    sizes = df.groupBy(label).count().orderBy(label).limit(MOST_CLASSES + 1).collect()
    if len(sizes) > MOST_CLASSES:
        raise ValueError(f"{label} has more than {MOST_CLASSES} values; permute shuffles columns of any kind")
    placed, n = with_places(df, key)

    def class_at(place: Column) -> Column:
        value, end = F.lit(None).cast(df.schema[label].dataType), n
        for r in reversed(sizes):
            value, end = F.when(place < end, F.lit(r[label])).otherwise(value) if end < n else F.lit(r[label]), end - r["count"]
        return value

    return placed.withColumn(out, F.transform(keyed_bijections(F.col(PLACE), n, seeds), class_at)).drop(PLACE)


def permuted_rows(placed: DataFrame, n: int, columns: Sequence[str], seed: int | str, prefix: str = "shadow_") -> DataFrame:
    """``placed`` (rows with ``__slot``) with a shuffled copy of each column, every column by a bijection of its own.

    Each row sends itself to its own place and each of its values to the place that the column's bijection names; one
    shuffle by place brings them together.
    """
    kind = "double"
    sent = [F.struct(F.col(PLACE).alias("to"), F.lit(-1).alias("column"), F.lit(None).cast(kind).alias("value"), F.struct(*placed.columns).alias("row"))]
    row_type = placed.select(F.struct(*placed.columns).alias("r")).schema["r"].dataType
    for i, c in enumerate(columns):
        to = keyed_bijection(F.col(PLACE), n, f"{seed}:{c}")
        sent.append(F.struct(to.alias("to"), F.lit(i).alias("column"), F.col(c).cast(kind).alias("value"), F.lit(None).cast(row_type).alias("row")))
    cells = placed.select(F.inline(F.array(*sent)))
    pick = [F.max(F.when(F.col("column") == i, F.col("value"))).alias(f"{prefix}{c}") for i, c in enumerate(columns)]
    met = cells.groupBy("to").agg(F.max_by("row", F.when(F.col("column") == -1, 1)).alias("row"), *pick)
    return met.select("row.*", *[f"{prefix}{c}" for c in columns])
