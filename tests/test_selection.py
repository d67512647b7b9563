import random

import pytest
from pyspark.sql import functions as F

from featloom.operators.folds import stratified_holdout, stratified_kfold
from featloom.operators.models import Recipe, boosted_trees, forest, kfold_fit, net, search_parameters, vector_names, vector_table
from featloom.operators.selection import (
    ShadowState,
    actual_importance,
    binomial_upper_tail,
    important_features,
    importance_runs,
    null_importance_log_score,
    null_importance_percent_score,
    principal_components,
    residual_rounds,
    shadow_selection,
    step_up,
)
from featloom.operators.separation import (
    class_separation,
    constant_columns,
    drifting_features,
    train_test_drift,
    weak_features,
)
from featloom.plans import query_models


@pytest.fixture(scope="module")
def planted(spark):
    """One informative, one noise, one constant and one half-missing column."""
    draw = random.Random(9)
    data = []
    for i in range(600):
        y = None if i % 6 == 5 else int(draw.random() < 0.4)
        signal = draw.gauss(2.0 * (y or 0), 1.0)
        data.append((i, y, signal, draw.random(), 1.0, draw.random() if i % 2 else None))
    return spark.createDataFrame(data, "k bigint, y int, signal double, noise double, flat double, gaps double")


FEATURES = ["signal", "noise", "flat", "gaps"]


@pytest.fixture(scope="module")
def vectors(planted):
    return vector_table(planted, "k", FEATURES, "y")


TREES = Recipe(boosted_trees, {"maxIter": 3, "maxDepth": 3}, 1)
FOREST = Recipe(forest, {"numTrees": 10, "maxDepth": 4}, 1)


def brute_z(a, b):
    ranked = sorted(a + b)
    rank = {v: sum(i + 1 for i, r in enumerate(ranked) if r == v) / ranked.count(v) for v in set(ranked)}
    n, m = len(a), len(b)
    return (sum(rank[v] for v in a) - n * (n + m + 1) / 2) / (n * m * (n + m + 1) / 12) ** 0.5


def test_class_separation_against_brute_force(spark):
    draw = random.Random(2)
    data = [(i, i % 2 if i < 80 else None, float(draw.randrange(6)), draw.randrange(2)) for i in range(100)]
    df = spark.createDataFrame(data, "k int, y int, x double, flag int")
    got = {r["feature"]: r for r in class_separation(df, ["x", "flag"], "y").collect()}
    x0, x1 = ([r[2] for r in data if r[1] == c] for c in (0, 1))
    assert got["x"]["z"] == pytest.approx(brute_z(x0, x1))
    median = lambda v: (sorted(v)[19] + sorted(v)[20]) / 2
    assert got["x"]["diff"] == abs(median(x0) - median(x1))
    assert got["x"]["diff_norm"] == pytest.approx(got["x"]["diff"] / (sum(r[2] for r in data) / 100))
    f0, f1 = ([r[3] for r in data if r[1] == c] for c in (0, 1))
    assert got["flag"]["diff"] == pytest.approx(abs(sum(f0) / 40 - sum(f1) / 40))


def test_small_class_is_not_tested(spark):
    df = spark.createDataFrame([(float(i), int(i < 19)) for i in range(100)], "x double, y int")
    r = class_separation(df, ["x"], "y").first()
    assert (r["n1"], r["z"], r["p"]) == (19, None, 2.0)


def test_a_missing_value_makes_a_flag_compare_medians(spark):
    df = spark.createDataFrame([(None if i == 0 else i % 2, i // 50) for i in range(100)], "x int, y int")
    assert class_separation(df, ["x"], "y").first()["diff"] in (0.0, 0.5, 1.0)


def test_weak_and_constant_features(planted):
    statistics = class_separation(planted, FEATURES, "y")
    weak = {r["feature"] for r in weak_features(statistics).collect()}
    assert "signal" not in weak and {"noise", "flat"} <= weak
    assert "noise" not in {r["feature"] for r in weak_features(statistics, ["noise"]).collect()}
    assert constant_columns(planted, FEATURES) == ["flat"]


def test_drift_needs_a_flat_class_difference(planted):
    moved = planted.withColumn("moved", F.when(F.col("y").isNull(), 100.0).otherwise(1.0)).withColumn(
        "both", F.when(F.col("y").isNull(), 100.0).otherwise(F.col("signal"))
    )
    features = ["moved", "both", "noise"]
    found = drifting_features(class_separation(moved, features, "y"), train_test_drift(moved, features, "y"))
    assert [r["feature"] for r in found.collect()] == ["moved"]


def test_stratified_splits(spark):
    df = spark.range(103).selectExpr("id k", "CAST(id % 4 = 0 AS INT) y")
    counts = stratified_kfold(df, "k", "y", 5, 3).groupBy("y", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in counts if r["y"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1
    kept = {r["y"]: r["n"] for r in stratified_holdout(df, "k", "y", 0.9).groupBy("y").agg(F.sum("in_train").alias("n")).collect()}
    assert kept == {0: 70, 1: 24}


def test_vectors_mark_missing_values(vectors):
    assert vector_names(vectors) == ["signal", "noise", "flat", "gaps", "gaps_isnull"]


def test_fold_scores_cover_every_row_once(vectors):
    result = kfold_fit(vectors, "k", TREES, 3, 7)
    stacked = result.stacked
    valid = stacked.where("part = 'valid'")
    assert valid.count() == valid.select("k").distinct().count() == 500
    assert stacked.where("part = 'test'").groupBy("k").count().where("count <> 3").count() == 0
    assert stacked.where("NOT score BETWEEN 0 AND 1").count() == 0
    importance = {(r["fold"], r["feature"]): r for r in result.importances.collect()}
    assert len(importance) == 15 and all(r["gain"] >= 0 and r["split"] >= 0 for r in importance.values())
    assert all(importance[f, "signal"]["gain"] > importance[f, "noise"]["gain"] for f in range(3))
    again = kfold_fit(vectors, "k", TREES, 3, 7, with_importance=False).stacked
    assert again.exceptAll(stacked).count() == 0


def test_early_stop_weight_and_balance_are_accepted(vectors):
    for recipe in (
        Recipe(boosted_trees, {"maxIter": 3, "maxDepth": 2}, 1, positive_weight=2.5, early_stop=True),
        Recipe(forest, {"numTrees": 3, "maxDepth": 2}, 1, balanced=True),
        Recipe(net(5, (6, 4)), {"maxIter": 5}, 1),
    ):
        assert kfold_fit(vectors, "k", recipe, 2, with_importance=False).stacked.count() == 2 * 600


def test_importance_threshold_keeps_the_signal(vectors):
    kept = {r["feature"] for r in important_features(vectors, TREES, 1).collect()}
    assert "signal" in kept and "flat" not in kept


def test_residual_rounds_end_below_the_bound(vectors):
    rounds = residual_rounds(vectors, "k", TREES, 0.75)
    assert "signal" in rounds[0].features and rounds[0].auc > 0.75
    assert "signal" not in rounds[-1].features and rounds[-1].auc <= 0.75


def test_null_importance_separates_signal_from_noise(vectors):
    actual = actual_importance(vectors, FOREST)
    runs = importance_runs(vectors, "k", FOREST, [1, 2])
    assert runs.select("run").distinct().count() == 2
    log = {r["feature"]: r["gain_score"] for r in null_importance_log_score(actual, runs, ["gain", "split"]).collect()}
    assert log["signal"] > log["noise"]
    percent = {r["feature"]: r["gain_score"] for r in null_importance_percent_score(actual, runs, ["gain", "split"]).collect()}
    assert percent["signal"] == 100.0


def test_null_runs_are_read_in_one_scan(vectors):
    """However many runs, their nodes are one table: no plan branch, no broadcast and no model is kept per run."""
    runs = importance_runs(vectors, "k", FOREST, [1, 2, 3], parallel=2)
    assert "Union" not in runs._jdf.queryExecution().optimizedPlan().toString()
    found = [(r["run"], r["feature"]) for r in runs.collect()]
    assert sorted(found) == sorted((run, f) for run in (1, 2, 3) for f in vector_names(vectors))
    assert runs.where("train_auc IS NULL").count() == 0 and runs.agg(F.min("gain")).first()[0] >= 0


def test_the_null_importance_query_fits_whole_forests(spark, vectors, monkeypatch):
    """80 runs of 200 trees of depth 8, as in the work it stands for, and the same forest for the actual importance."""
    fitted = []
    monkeypatch.setattr(query_models, "document_vectors", lambda *_: vectors)
    monkeypatch.setattr(query_models, "importance_runs", lambda v, key, recipe, seeds, parallel: fitted.append((recipe, len(seeds))))
    monkeypatch.setattr(query_models, "actual_importance", lambda v, recipe: fitted.append((recipe, 1)))
    monkeypatch.setattr(query_models, "null_importance_log_score", lambda *_: None)
    query_models.null_importance_runs(spark, "")
    assert sorted(n for _, n in fitted) == [1, 80]
    for recipe, _ in fitted:
        assert recipe.params["numTrees"] == 200 and recipe.params["maxDepth"] == 8 and recipe.params["subsamplingRate"] == 0.623


def test_shadow_rounds_hit_the_signal(planted):
    recipe = Recipe(forest, {"numTrees": 10, "maxDepth": 4}, 3, balanced=True)
    state = shadow_selection(planted, "k", FEATURES, "y", recipe, rounds=2)
    assert state.hits["signal"] == 2 and state.hits["flat"] == 0


def test_shadow_decisions():
    state = ShadowState.start(["good", "bad", "even"])
    for i in range(30):
        state.update({"good": 1.0, "bad": 0.0, "even": float(i % 2)}, 0.5)
    assert state.status == {"good": "confirmed", "bad": "rejected", "even": "tentative"}
    assert binomial_upper_tail(3, 3) == 0.125 and binomial_upper_tail(0, 3) == 1.0
    assert step_up({"a": 0.01, "b": 0.04, "c": 0.9}, 0.05) == {"a"}


def test_components_are_centred_and_ordered(planted):
    scores, shares = principal_components(planted, "k", FEATURES, 3)
    means = scores.agg(*[F.avg(f"PCA_{i}") for i in range(3)]).first()
    assert all(abs(m) < 1e-9 for m in means)
    assert shares == sorted(shares, reverse=True) and sum(shares) <= 1 + 1e-9


def test_search_stays_in_bounds_and_repeats(vectors):
    bounds = {"stepSize": (0.05, 0.1), "maxDepth": (2, 3)}
    first = search_parameters(vectors, "k", boosted_trees, bounds, 2, fixed={"maxIter": 2})
    assert all(0.05 <= p["stepSize"] <= 0.1 and p["maxDepth"] in (2, 3) for p, _ in first)
    assert first[0][1] >= first[1][1]


def test_a_forest_scores_rows_and_gives_its_importances(vectors):
    """The forest's training summary must not ride along into the tasks that score and write."""
    assert not FOREST.fit(vectors.where("label IS NOT NULL")).hasSummary
    ranked = actual_importance(vectors, FOREST)
    assert ranked.where("run = 0 AND train_auc > 0.5").count() == len(vector_names(vectors))
