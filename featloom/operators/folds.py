"""Fold and holdout assignment from key hashes, and the stacked score tables built on folds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.functions.hashing import hash32, hash_text
from featloom.operators.rank import exact_rank
from featloom.workspace import lookup_join

TRAIN, VALID, TEST = "train", "valid", "test"


def kfold(df: DataFrame, key: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 from the key hash: no shuffle, same fold on every run."""
    return df.withColumn(out, F.pmod(hash32(key, seed), F.lit(k)).cast("int"))


def _hash_rank(df: DataFrame, key: str, label: str, seed: int) -> DataFrame:
    hashed = df.withColumn("__hash", hash_text(key, seed))
    return exact_rank(hashed, ["__hash", key], [label], "__rank").drop("__hash")


def stratified_kfold(df: DataFrame, key: str, label: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Fold = hash rank inside the class modulo k, so class counts per fold differ by one at most."""
    ranked = _hash_rank(df, key, label, seed)
    return ranked.withColumn(out, F.pmod("__rank", F.lit(k)).cast("int")).drop("__rank")


def stratified_holdout(
    df: DataFrame, key: str, label: str, share: float = 0.9, seed: int = 0, out: str = "in_train"
) -> DataFrame:
    """1 for the first ``ceil(share * class size)`` rows of each class in hash order; labels are not null."""
    ranked = _hash_rank(df, key, label, seed)
    sizes = df.groupBy(label).agg(F.count("*").alias("__size"))
    chosen = F.col("__rank") < F.ceil(F.col("__size") * share)
    return lookup_join(ranked, sizes, [label]).withColumn(out, chosen.cast("int")).drop("__rank", "__size")


def out_of_fold(stacked: DataFrame) -> DataFrame:
    """Each labelled row with the score of the model that did not see it."""
    return stacked.where(F.col("part") == VALID).drop("part")


def fold_mean_score(stacked: DataFrame, key: str, score: str = "score") -> DataFrame:
    """Scoring rows with the mean over the fold models."""
    return stacked.where(F.col("part") == TEST).groupBy(key).agg(F.avg(score).alias(score))


def in_sample_score(stacked: DataFrame, key: str, label: str, score: str = "score") -> DataFrame:
    """Score of the last fold model that trained on the row, as later folds overwrite earlier ones."""
    seen = stacked.where(F.col("part") == TRAIN)
    return seen.groupBy(key, label).agg(F.max_by(score, "fold").alias(score))


def mean_importance(importances: DataFrame, folds: int, value: str = "importance") -> DataFrame:
    """Mean over all folds; a fold in which a feature was not used counts as 0."""
    return importances.groupBy("feature").agg((F.sum(F.coalesce(value, F.lit(0.0))) / folds).alias("mean"))
