"""Exact ranking and threshold metrics over (label, score) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.operators.rank import running_totals


def roc_auc(df: DataFrame, label: str, score: str, by: Sequence[str] = (), out: str = "auc") -> DataFrame:
    """Area under the ROC curve with ties averaged; null when a class is absent."""
    by = list(by)
    y = F.col(label)
    counted = (
        df.where(y.isNotNull() & F.col(score).isNotNull())
        .groupBy(*by, score)
        .agg(F.count("*").alias("n"), F.count_if(y == 1).alias("n1"))
    )
    ordered = running_totals(counted, [score], ["n"], by)
    ranks = F.sum(F.col("n1") * (F.col("n_before") + (F.col("n") + 1) / 2))
    positives = F.sum("n1").cast("double")
    negatives = F.sum(F.col("n") - F.col("n1")).cast("double")
    area = F.try_divide(ranks - positives * (positives + 1) / 2, positives * negatives)
    return ordered.groupBy(*by).agg(area.alias(out))


def _class_metrics(y: Column, predicted: Column, k: int) -> tuple[Column, Column]:
    hits = F.count_if((y == k) & (predicted == k))
    return F.try_divide(hits, F.count_if(predicted == k)), F.try_divide(hits, F.count_if(y == k))


def precision_recall(df: DataFrame, label: str, score: str, by: Sequence[str] = (), threshold: float = 0.5) -> DataFrame:
    y = F.col(label)
    predicted = (F.col(score) >= threshold).cast("int")
    out = []
    for k in (0, 1):
        precision, recall = _class_metrics(y, predicted, k)
        out += [precision.alias(f"precision_{k}"), recall.alias(f"recall_{k}")]
    return df.where(y.isNotNull()).groupBy(*by).agg(*out)


def log_loss(df: DataFrame, label: str, score: str, by: Sequence[str] = (), floor: float = 1e-15) -> DataFrame:
    y = F.col(label)
    p = F.greatest(F.least(F.col(score), F.lit(1 - floor)), F.lit(floor))
    loss = -(y * F.log(p) + (1 - y) * F.log(1 - p))
    return df.where(y.isNotNull()).groupBy(*by).agg(F.avg(loss).alias("log_loss"))


def score_summary(in_sample: DataFrame, out_of_fold: DataFrame, label: str, score: str) -> DataFrame:
    """One row: AUC, precision and recall per class on both score sets, and the unset board slot."""
    columns = {}
    for side, df in {"train": in_sample, "test": out_of_fold}.items():
        columns[f"roc_auc_{side}"] = roc_auc(df, label, score).scalar()
        per_class = precision_recall(df, label, score)
        values = per_class.select(F.struct(*per_class.columns)).scalar()
        columns |= {c.replace("_", f"_{side}_"): values[c] for c in per_class.columns}
    order = ["roc_auc_train", "roc_auc_test"] + [
        f"{m}_{s}_{k}" for m in ("precision", "recall") for k in (0, 1) for s in ("train", "test")
    ]
    one_row = in_sample.sparkSession.range(1)
    return one_row.select(*[columns[c].alias(c) for c in order], F.lit(0).alias("board"))
