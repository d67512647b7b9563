import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from featloom.operators.metrics import log_loss, precision_recall, roc_auc
from featloom.operators.bijection import permute
from featloom.operators.rank import exact_rank, mid_ranks, quantiles_by, running_totals, value_counts


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value and one group."""
    draw = random.Random(5)
    data = []
    for i in range(3000):
        hot = i % 3 == 0
        data.append((i, "hot" if hot else f"g{draw.randrange(40)}", 7.5 if hot else draw.gauss(0, 10), i % 2))
    return spark.createDataFrame(data, "id bigint, g string, x double, y int")


def test_rank_is_exact_with_a_hot_value(skewed):
    ours = {r["id"]: r["rank"] for r in exact_rank(skewed, ["x", "id"]).collect()}
    expected = {r["id"]: i for i, r in enumerate(sorted(skewed.collect(), key=lambda r: (r["x"], r["id"])))}
    assert ours == expected


def test_rank_within_groups(skewed):
    ours = {r["id"]: r["rank"] for r in exact_rank(skewed, ["x", "id"], ["g"]).collect()}
    seen: dict[str, int] = {}
    for r in sorted(skewed.collect(), key=lambda r: (r["x"], r["id"])):
        assert ours[r["id"]] == seen.get(r["g"], 0)
        seen[r["g"]] = seen.get(r["g"], 0) + 1


def test_running_totals(skewed):
    counted = value_counts(skewed, "x", ["g"])
    for r in running_totals(counted, ["x"], ["n"], ["g"]).collect():
        members = [q["x"] for q in skewed.collect() if q["g"] == r["g"]] if r["g"] == "g1" else None
        if members is not None:
            assert r["n_before"] == sum(m < r["x"] for m in members) and r["n_total"] == len(members)


def test_quantiles_match_linear_interpolation(skewed):
    got = {r["g"]: r for r in quantiles_by(skewed, "x", {"m": 0.5, "q": 0.9}, ["g"]).collect()}
    groups: dict[str, list[float]] = {}
    for r in skewed.collect():
        groups.setdefault(r["g"], []).append(r["x"])
    assert set(got) == set(groups)
    for g, xs in groups.items():
        assert got[g]["m"] == pytest.approx(np.percentile(xs, 50)) and got[g]["q"] == pytest.approx(np.percentile(xs, 90))


def test_quantiles_skip_null_values_and_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("a", 4.0), (None, 9.0), ("b", None)], "g string, x double")
    assert [tuple(r) for r in quantiles_by(df, "x", {"m": 0.5}, ["g"]).collect()] == [("a", 2.5)]


def test_mid_ranks_average_ties(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (3.0,), (None,)], "x double")
    assert {r["x"]: r["mid_rank"] for r in mid_ranks(df, "x").collect()} == {1.0: 1.0, 2.0: 2.5, 3.0: 4.0}


def test_permutation_uses_every_value_once(skewed):
    out = permute(skewed, "id", ["x", "y"], [1, 2])
    values = sorted((r["x"], r["y"]) for r in skewed.collect())
    kept = {r["id"]: r["x"] for r in skewed.collect()}
    for seed in ("1", "2"):
        run = out.where(F.col("seed") == seed).collect()
        assert sorted((r["x"], r["y"]) for r in run) == values
        assert sum(kept[r["id"]] == r["x"] for r in run) < 2000
    again = {r["id"]: r["x"] for r in permute(skewed, "id", ["x"], [1]).collect()}
    assert again == {r["id"]: r["x"] for r in out.where("seed = '1'").collect()}


def brute_auc(pairs):
    wins = [(p > q) + 0.5 * (p == q) for y, p in pairs if y == 1 for z, q in pairs if z == 0]
    return sum(wins) / len(wins)


def test_auc_with_ties(spark):
    draw = random.Random(3)
    data = [(f, draw.randrange(2), round(draw.random(), 1)) for f in (0, 1) for _ in range(60)]
    df = spark.createDataFrame(data, "fold int, y int, p double")
    assert roc_auc(df, "y", "p").first()["auc"] == pytest.approx(brute_auc([(y, p) for _, y, p in data]))
    for r in roc_auc(df, "y", "p", ["fold"]).collect():
        assert r["auc"] == pytest.approx(brute_auc([(y, p) for f, y, p in data if f == r["fold"]]))


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.4), (1, 0.6)], "y int, p double")
    assert roc_auc(df, "y", "p").first()["auc"] is None


def test_threshold_metrics(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.6), (0, 0.1), (0, 0.3), (None, 0.5)], "y int, p double")
    r = precision_recall(df, "y", "p").first()
    assert (r["precision_1"], r["recall_1"]) == (0.5, 0.5)
    assert (r["precision_0"], r["recall_0"]) == (pytest.approx(2 / 3), pytest.approx(2 / 3))
    expected = -np.mean(np.log([0.9, 0.2, 0.4, 0.9, 0.7]))
    assert log_loss(df, "y", "p").first()["log_loss"] == pytest.approx(expected)
