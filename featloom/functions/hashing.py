"""Seeded key hashes, the only source of randomness for folds, splits and permutations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def hash_text(key: str | Column, seed: int | str | Column = 0) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    seed = seed if isinstance(seed, Column) else F.lit(str(seed))
    return F.md5(F.concat(key.cast("string"), F.lit(":"), seed.cast("string")))


def hash32(key: str | Column, seed: int | str | Column = 0) -> Column:
    """Uniform integer in ``[0, 2**32)`` from key and seed."""
    return F.conv(F.substring(hash_text(key, seed), 1, 8), 16, 10).cast("long")
