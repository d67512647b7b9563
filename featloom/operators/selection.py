"""Model-based feature selection: importance thresholds, residual rounds, null runs, shadows, components."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.operators.bijection import PLACE, permuted_classes, permuted_rows, with_places
from featloom.operators.encode import fill_with_mean
from featloom.operators.metrics import roc_auc
from featloom.operators.models import (
    FEATURES,
    LABEL,
    Recipe,
    importance_table,
    in_parallel,
    node_importance,
    score,
    vector_names,
    vector_table,
)
from featloom.workspace import materialise, scratch_path


NULL_LABELS = "null_labels"


def _slots(vectors: DataFrame, indices: Sequence[int], key: str) -> DataFrame:
    slicer = VectorSlicer(inputCol="all_features", outputCol=FEATURES, indices=list(indices))
    return slicer.transform(vectors.withColumnRenamed(FEATURES, "all_features")).select(key, LABEL, FEATURES)


def important_features(vectors: DataFrame, recipe: Recipe, more_than: int = 1) -> DataFrame:
    """Features the fitted trees split on more than ``more_than`` times."""
    model = recipe.fit(vectors.where(F.col(LABEL).isNotNull()))
    return importance_table(model, vector_names(vectors), vectors.sparkSession).where(F.col("split") > more_than)


@dataclass(frozen=True)
class ResidualRound:
    features: list[str]
    auc: float


def residual_rounds(vectors: DataFrame, key: str, recipe: Recipe, stop_at: float = 0.75) -> list[ResidualRound]:
    """Refit without every feature used so far until the train AUC is at most ``stop_at``.

    The last entry holds the weak set that is to be dropped; it is empty when
    the features run out first.
    """
    labelled = vectors.where(F.col(LABEL).isNotNull())
    names = vector_names(vectors)
    left = list(range(len(names)))
    rounds: list[ResidualRound] = []
    while left:
        table = _slots(labelled, left, key)
        model = recipe.fit(table)
        area = roc_auc(score(model, table), LABEL, "score").first()["auc"]
        rounds.append(ResidualRound([names[i] for i in left], area))
        if area is None:
            raise ValueError("the labelled rows hold one class only, so there is no AUC to stop at")
        if area <= stop_at:
            return rounds
        # featureImportances is positive exactly for the features split on.
        used = {left[j] for j, v in enumerate(model.featureImportances.toArray()) if v > 0}
        if not used:
            return rounds
        left = [i for i in left if i not in used]
    return [*rounds, ResidualRound([], 0.5)]


def importance_runs(
    vectors: DataFrame, key: str, recipe: Recipe, seeds: Sequence[int | str], parallel: int = 4
) -> DataFrame:
    """One fit per seed on permuted labels: (run, feature, gain, split, train_auc).

    The labels of all runs stand beside the vectors as one array, written once; a run only picks its entry. A fitted
    model is saved and let go, so the driver holds ``parallel`` models at a time; the nodes of all runs are read in one scan.
    """
    labelled = vectors.where(F.col(LABEL).isNotNull())
    drawn = materialise(permuted_classes(labelled, key, LABEL, seeds, NULL_LABELS), "null-labels")
    # A reread column keeps no names of vector slots.
    named = drawn.withMetadata(FEATURES, vectors.schema[FEATURES].metadata)

    saved = scratch_path(vectors.sparkSession, "models")

    def one_run(place: int) -> tuple[int, float | None]:
        return place + 1, _saved_run(null_labelled(named, key, place), recipe, f"{saved}/{place + 1}")

    areas = in_parallel(vectors.sparkSession, one_run, range(len(seeds)), parallel)
    return _run_tables(saved, areas, vector_names(vectors), vectors.sparkSession)


def null_labelled(drawn: DataFrame, key: str, place: int) -> DataFrame:
    """The vectors with the permuted labels of one run: a projection."""
    return drawn.select(key, F.get(NULL_LABELS, F.lit(place)).alias(LABEL), FEATURES)


def actual_importance(vectors: DataFrame, recipe: Recipe) -> DataFrame:
    return _run_table(vectors.where(F.col(LABEL).isNotNull()), recipe, 0)


def _run_table(table: DataFrame, recipe: Recipe, run: int) -> DataFrame:
    saved = scratch_path(table.sparkSession, "models")
    area = _saved_run(table, recipe, f"{saved}/{run}")
    return _run_tables(saved, [(run, area)], vector_names(table), table.sparkSession)


def _saved_run(table: DataFrame, recipe: Recipe, path: str) -> float | None:
    """Area on the rows of a fit whose model is saved at ``path``."""
    model = recipe.fit(table)
    model.write().save(path)
    return roc_auc(score(model, table), LABEL, "score").first()["auc"]


def _run_tables(saved: str, areas: Sequence[tuple[int, float | None]], names: Sequence[str], spark: SparkSession) -> DataFrame:
    """(feature, gain, split, run, train_auc) of every run whose model is saved under ``saved`` by its number."""
    run = F.regexp_extract("_metadata.file_path", r"/(\d+)/data/[^/]*$", 1).cast("int")
    nodes = spark.read.parquet(f"{saved}/*/data").select(run.alias("run"), "nodeData.*")
    runs = spark.createDataFrame(list(areas), "run int, train_auc double")
    return node_importance(nodes, names, spark, runs).select("feature", "gain", "split", "run", "train_auc")


def null_importance_log_score(actual: DataFrame, null_runs: DataFrame, values: Sequence[str]) -> DataFrame:
    """``ln(1e-10 + actual / (1 + 75th percentile of the null runs))`` per feature.

    A feature has one row per run, so the percentile works on the number of runs.
    """
    nulls = null_runs.groupBy("feature").agg(*[F.percentile(v, 0.75).alias(f"null_{v}") for v in values])
    acts = actual.groupBy("feature").agg(*[F.avg(v).alias(v) for v in values])
    return acts.join(nulls, "feature").select(
        "feature", *[F.log(1e-10 + F.col(v) / (1 + F.col(f"null_{v}"))).alias(f"{v}_score") for v in values]
    )


def null_importance_percent_score(actual: DataFrame, null_runs: DataFrame, values: Sequence[str]) -> DataFrame:
    """Percent of null runs below the 25th percentile of the actual importance."""
    acts = actual.groupBy("feature").agg(*[F.percentile(v, 0.25).alias(f"act_{v}") for v in values])
    return (
        null_runs.join(acts, "feature")
        .groupBy("feature")
        .agg(
            *[
                (100.0 * F.count_if(F.col(v) < F.col(f"act_{v}")) / F.count("*")).alias(f"{v}_score")
                for v in values
            ]
        )
    )


def binomial_upper_tail(hits: int, trials: int) -> float:
    """P(X >= hits) for a fair coin."""
    return sum(math.comb(trials, i) for i in range(max(hits, 0), trials + 1)) / 2**trials


def step_up(p_values: dict[str, float], alpha: float) -> set[str]:
    """Benjamini-Hochberg rejections."""
    ordered = sorted(p_values, key=p_values.get)
    passing = [i for i, name in enumerate(ordered, 1) if p_values[name] <= alpha * i / len(ordered)]
    return set(ordered[: max(passing, default=0)])


@dataclass
class ShadowState:
    """Hits per feature after some rounds; one entry per column."""

    hits: dict[str, int]
    status: dict[str, str]
    rounds: int = 0

    @classmethod
    def start(cls, features: Sequence[str]) -> "ShadowState":
        return cls({f: 0 for f in features}, {f: "tentative" for f in features})

    def named(self, status: str) -> list[str]:
        return [f for f, s in self.status.items() if s == status]

    def update(self, importance: dict[str, float], threshold: float, alpha: float = 0.05) -> None:
        self.rounds += 1
        for f, value in importance.items():
            self.hits[f] += value > threshold
        undecided = self.named("tentative")
        if not undecided:
            return
        n, level = self.rounds, alpha / self.rounds
        above = {f: binomial_upper_tail(self.hits[f], n) for f in undecided}
        below = {f: binomial_upper_tail(n - self.hits[f], n) for f in undecided}
        for f in step_up(above, alpha):
            if above[f] <= level:
                self.status[f] = "confirmed"
        for f in step_up(below, alpha):
            if below[f] <= level:
                self.status[f] = "rejected"


def linear_percentile(values: Sequence[float], percent: float) -> float:
    ordered = sorted(values)
    place = (len(ordered) - 1) * percent / 100
    low = math.floor(place)
    high = math.ceil(place)
    return ordered[low] + (ordered[high] - ordered[low]) * (place - low)


def shadow_selection(
    df: DataFrame,
    key: str,
    features: Sequence[str],
    label: str,
    recipe: Recipe,
    rounds: int = 50,
    percent: float = 90,
    limit: float = 1e9,
    seed: int = 0,
    least_shadows: int = 5,
) -> ShadowState:
    """Features that beat shuffled copies of themselves in a balanced forest.

    Each round shuffles every remaining feature by itself, so that a shadow goes with no other column, in one exchange; it
    fits on both and counts a hit for each feature above the given percentile of the shadow importances. While fewer than
    ``least_shadows`` features remain, they are shuffled several times, so that the percentile has that many shadows at least.
    """
    labelled = df.where(F.col(label).isNotNull())
    clean = fill_with_mean(labelled.select(key, label, *features), features, limit=limit)
    placed, n = with_places(clean, key)
    state = ShadowState.start(features)
    for round_ in range(rounds):
        current = [f for f in features if state.status[f] != "rejected"]
        if not state.named("tentative"):
            break
        copies = -(-least_shadows // len(current))
        both, table = list(current), placed.select(PLACE, key, label, *current)
        for copy in range(copies):
            prefix = f"shadow{copy}_"
            both += [f"{prefix}{f}" for f in current]
            table = permuted_rows(table, n, current, f"{seed}:{round_}:{copy}", prefix)
        vectors = vector_table(table, key, both, label)
        model = recipe.fit(vectors)
        weights = model.featureImportances.toArray()
        threshold = linear_percentile([float(w) for w in weights[len(current):]], percent)
        state.update({f: float(w) for f, w in zip(current, weights)}, threshold)
    return state


def principal_components(
    df: DataFrame, key: str, features: Sequence[str], k: int = 10, prefix: str = "PCA_"
) -> tuple[DataFrame, list[float]]:
    """``df`` plus the first ``k`` component scores, and their variance shares.

    Columns holding any null are left out; columns are centred, not scaled.
    """
    nulls = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in features]).first()
    usable = [c for c in features if not nulls[c]]
    assembled = VectorAssembler(inputCols=usable, outputCol="__raw").transform(df)
    scores, shares = vector_components(assembled, "__raw", min(k, len(usable)), "__scores")
    array = vector_to_array("__scores")
    wide = scores.withColumns({f"{prefix}{i}": array[i] for i in range(min(k, len(usable)))})
    return wide.drop("__raw", "__scores"), shares


def vector_components(df: DataFrame, column: str, k: int, out: str) -> tuple[DataFrame, list[float]]:
    centring = StandardScaler(inputCol=column, outputCol="__centred", withMean=True, withStd=False).fit(df)
    centred = centring.transform(df)
    model = PCA(k=k, inputCol="__centred", outputCol=out).fit(centred)
    return model.transform(centred).drop("__centred"), [float(v) for v in model.explainedVariance.toArray()]
