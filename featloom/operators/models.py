"""K-fold and holdout training on MLlib learners.

The feature vectors are assembled and written once; the driver loop over folds
only filters that table. Scores of all folds are stacked in one table
(key, label, fold, part, score) from which out-of-fold, averaged and in-sample
scores are plain group-bys.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.operators.folds import TEST, TRAIN, VALID, kfold, out_of_fold, stratified_holdout
from featloom.operators.metrics import roc_auc
from featloom.operators.staged import Ensemble, Stop, cut_at_best, staged_score
from featloom.workspace import materialise, scratch_path

FEATURES, LABEL, FOLD, WEIGHT, HELD_OUT = "features", "label", "fold", "weight", "held_out"

# Widths of the net's hidden layers.
NET_LAYERS = (400, 160, 64, 26, 12)

Learner = Callable[[dict[str, Any], int], Any]


def vector_table(df: DataFrame, key: str, features: Sequence[str], label: str) -> DataFrame:
    """(key, label, features) with nulls as 0 next to a missing-value indicator where one occurs."""
    nulls = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in features]).first()
    indicators = {f"{c}_isnull": F.col(c).isNull().cast("double") for c in features if nulls[c]}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features}
    wide = df.select(
        F.col(key),
        F.col(label).cast("double").alias(LABEL),
        *[e.alias(c) for c, e in {**filled, **indicators}.items()],
    )
    assembler = VectorAssembler(inputCols=[*filled, *indicators], outputCol=FEATURES)
    return materialise(assembler.transform(wide).select(key, LABEL, FEATURES), "vectors")


def vector_names(table: DataFrame) -> list[str]:
    """Feature names by vector slot, kept in the vector column's metadata."""
    attributes = table.schema[FEATURES].metadata["ml_attr"]["attrs"]
    slots = {a["idx"]: a["name"] for group in attributes.values() for a in group}
    return [slots[i] for i in sorted(slots)]


def boosted_trees(params: dict[str, Any], seed: int) -> GBTClassifier:
    return GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def forest(params: dict[str, Any], seed: int) -> RandomForestClassifier:
    return RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, seed=seed, **params)


def net(width: int, layers: Sequence[int] = NET_LAYERS) -> Learner:
    def make(params: dict[str, Any], seed: int) -> MultilayerPerceptronClassifier:
        return MultilayerPerceptronClassifier(
            featuresCol=FEATURES, labelCol=LABEL, layers=[width, *layers, 2], seed=seed, **params
        )

    return make


@dataclass(frozen=True)
class Recipe:
    """A learner with its parameters; ``positive_weight`` weights label 1 rows.

    ``early_stop`` ends training by the learner's own tolerance; with ``patience`` (boosted trees) the
    area on the held-out rows is taken after every round, and rows are scored by the rounds up to the best one.
    """

    learner: Learner
    params: dict[str, Any] = field(default_factory=dict)
    seed: int = 0
    positive_weight: float | None = None
    balanced: bool = False
    early_stop: bool = False
    patience: int | None = None

    def fit(self, train: DataFrame, held_out: DataFrame | None = None):
        params = dict(self.params)
        if self.early_stop and held_out is not None:
            marked = train.withColumn(HELD_OUT, F.lit(False))
            train = marked.unionByName(held_out.withColumn(HELD_OUT, F.lit(True)))
            params["validationIndicatorCol"] = HELD_OUT
        if self.positive_weight is not None:
            weight = F.when(F.col(LABEL) == 1, self.positive_weight).otherwise(1.0)
            train = train.withColumn(WEIGHT, weight)
            params["weightCol"] = WEIGHT
        elif self.balanced:
            sizes = {r[LABEL]: r["count"] for r in train.groupBy(LABEL).count().collect()}
            total = sum(sizes.values())
            share = {y: total / (len(sizes) * n) for y, n in sizes.items()}
            train = train.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, share.get(1.0, 1.0)).otherwise(share.get(0.0, 1.0)))
            params["weightCol"] = WEIGHT
        model = self.learner(params, self.seed).fit(train)
        # The training summary holds the session; a forest's scoring and writing tasks would carry it along, and fail.
        return model.copy() if getattr(model, "hasSummary", False) else model


def score(model, df: DataFrame, out: str = "score") -> DataFrame:
    """Probability of class 1."""
    return model.transform(df).withColumn(out, vector_to_array("probability")[1]).drop(
        FEATURES, "probability", "rawPrediction", "prediction"
    )


def fit_scorer(recipe: Recipe, train: DataFrame, held_out: DataFrame) -> tuple[Any, Callable[[DataFrame], DataFrame], Stop | None]:
    """(model, what scores rows with it, where its rounds were cut)."""
    model = recipe.fit(train, held_out)
    if recipe.patience is None:
        return model, lambda rows: score(model, rows), None
    trees, stop = cut_at_best(Ensemble.of(model, train.sparkSession), held_out, FEATURES, LABEL, recipe.patience)
    return model, lambda rows: staged_score(trees, rows, FEATURES), stop


@dataclass(frozen=True)
class FoldResult:
    """``stops`` has, for each fold of a recipe with patience, where its rounds were cut."""

    stacked: DataFrame
    importances: DataFrame | None
    stops: list[Stop | None] = field(default_factory=list)


def in_parallel(spark: SparkSession, task: Callable[[Any], Any], items: Sequence[Any], width: int) -> list[Any]:
    """Run independent driver-side fits at the same time, so that one fit's small stages do not idle the cluster."""
    if width <= 1 or len(items) <= 1:
        return [task(i) for i in items]
    with ThreadPool(min(width, len(items))) as pool:
        return pool.map(inheritable_thread_target(spark)(task), items)


def kfold_fit(
    vectors: DataFrame,
    key: str,
    recipe: Recipe,
    k: int = 5,
    seed: int = 0,
    with_importance: bool = True,
    folds: DataFrame | None = None,
    parallel: int = 4,
) -> FoldResult:
    """Fit on k-1 folds, score the held-out fold, the rows trained on and the unlabelled rows.

    ``folds`` may bring a (key, fold) assignment such as a stratified one.
    ``parallel`` folds are fitted at a time, each holding its own copy of the
    training rows in the learner's cache.
    """
    labelled = vectors.where(F.col(LABEL).isNotNull())
    if folds is not None:
        labelled = materialise(labelled.join(folds, key), "folds")
    else:
        labelled = kfold(labelled, key, k, seed, FOLD)
    unlabelled = vectors.where(F.col(LABEL).isNull())
    names = vector_names(vectors) if with_importance else []

    def fit_fold(fold: int) -> tuple[list[DataFrame], DataFrame | None, Stop | None]:
        train = labelled.where(F.col(FOLD) != fold).drop(FOLD)
        held_out = labelled.where(F.col(FOLD) == fold).drop(FOLD)
        model, scorer, stop = fit_scorer(recipe, train, held_out)
        scored = [
            scorer(rows).select(key, LABEL, F.lit(fold).alias(FOLD), F.lit(part).alias("part"), "score")
            for part, rows in ((TRAIN, train), (VALID, held_out), (TEST, unlabelled))
        ]
        if not with_importance:
            return scored, None, stop
        return scored, importance_table(model, names, vectors.sparkSession).withColumn(FOLD, F.lit(fold)), stop

    fitted = in_parallel(vectors.sparkSession, fit_fold, range(k), parallel)
    stacked = materialise(reduce(DataFrame.unionByName, [df for scored, *_ in fitted for df in scored]), "scores")
    importances = reduce(DataFrame.unionByName, [i for _, i, _ in fitted]) if with_importance else None
    return FoldResult(stacked, importances, [stop for *_, stop in fitted])


def holdout_fit(vectors: DataFrame, key: str, recipe: Recipe, share: float = 0.9, seed: int = 0) -> DataFrame:
    """One fit on a stratified share of the labelled rows; scores of all rows with their part."""
    split = materialise(stratified_holdout(vectors.where(F.col(LABEL).isNotNull()), key, LABEL, share, seed), "split")
    train = split.where(F.col("in_train") == 1).drop("in_train")
    held_out = split.where(F.col("in_train") == 0).drop("in_train")
    _, scorer, _ = fit_scorer(recipe, train, held_out)
    parts = {TRAIN: train, VALID: held_out, TEST: vectors.where(F.col(LABEL).isNull())}
    scored = [
        scorer(rows).select(key, LABEL, F.lit(part).alias("part"), "score")
        for part, rows in parts.items()
    ]
    return reduce(DataFrame.unionByName, scored)


def importance_table(model, names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, gain, split) from the trees' nodes; features never split on get 0.

    The saved model is a table of nodes, so both importances are one group-by.
    A node's gain is per row, so it is weighted with the rows that reach it.
    """
    path = scratch_path(spark, "model")
    model.write().save(path)
    return node_importance(spark.read.parquet(f"{path}/data").select("nodeData.*"), names, spark)


def node_importance(nodes: DataFrame, names: Sequence[str], spark: SparkSession, runs: DataFrame | None = None) -> DataFrame:
    """``importance_table`` from saved nodes; with ``runs`` (run, ..) for each of them, from nodes with the column ``run``."""
    by = ["slot"] if runs is None else ["run", "slot"]
    used = (
        nodes.where(F.col("split.featureIndex") >= 0)
        .withColumn("slot", F.col("split.featureIndex"))
        .groupBy(*by)
        .agg(F.sum(F.col("gain") * F.col("rawCount")).alias("gain"), F.count("*").alias("split"))
    )
    slots = spark.createDataFrame(list(enumerate(names)), "slot int, feature string")
    every = slots if runs is None else slots.crossJoin(F.broadcast(runs))
    return every.join(F.broadcast(used), by, "left").select(
        "feature",
        F.coalesce("gain", F.lit(0.0)).alias("gain"),
        F.coalesce("split", F.lit(0).cast("long")).alias("split"),
        *(runs.columns if runs is not None else ()),
    )


def search_parameters(
    vectors: DataFrame,
    key: str,
    learner: Learner,
    bounds: dict[str, tuple[float, float]],
    trials: int,
    k: int = 2,
    seed: int = 0,
    fixed: dict[str, Any] | None = None,
) -> list[tuple[dict[str, Any], float]]:
    """Seeded random search inside the bounds, best out-of-fold AUC first.

    A bound pair of integers is drawn as an integer.
    """
    draw = random.Random(seed)
    candidates = [
        {
            name: draw.randint(low, high) if isinstance(low, int) and isinstance(high, int) else draw.uniform(low, high)
            for name, (low, high) in bounds.items()
        }
        for _ in range(trials)
    ]
    results = []
    for params in candidates:
        recipe = Recipe(learner, {**(fixed or {}), **params}, seed)
        stacked = kfold_fit(vectors, key, recipe, k, seed, with_importance=False).stacked
        area = roc_auc(out_of_fold(stacked), LABEL, "score").first()["auc"]
        results.append((params, area))
    return sorted(results, key=lambda r: -(r[1] if r[1] is not None else -math.inf))
