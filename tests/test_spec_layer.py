"""Rules, names and groups that must not lose rows or columns."""

import pytest

from featloom.operators.clean import NullRule, apply_null_rules
from featloom.operators.encode import OneHot, narrow_text_columns
from featloom.operators.metrics import roc_auc
from featloom.operators.rank import exact_rank, mid_ranks, top_k
from featloom.operators.rollup import RollupSpec, category_columns, category_shares, rollup
from featloom.plans.credit import _shares, rollup_everything


def test_rules_of_one_column_add_up(spark):
    df = spark.createDataFrame([(1, 50.0), (2, -9.0), (3, 3.0), (4, None)], "k long, x double")
    got = apply_null_rules(df, [NullRule("x", above=10), NullRule("x", below=-5)])
    assert {r["k"]: r["x"] for r in got.collect()} == {1: None, 2: None, 3: 3.0, 4: None}
    with pytest.raises(ValueError):
        NullRule("x")


def test_colliding_categories_keep_a_column_each(spark):
    assert list(category_columns({"c": ["a-b", "a b", "NaN", None]})) == ["c_a_b", "c_a_b_2", "c_NaN_2", "c_NaN"]
    df = spark.createDataFrame([(1, "a-b"), (1, "a b"), (1, "NaN"), (1, None)], "k long, c string")
    row = rollup(df, RollupSpec("k", "", shares={"c": ["a-b", "a b", "NaN", None]})).first().asDict()
    assert row == {"k": 1, "c_a_b_MEAN": 0.25, "c_a_b_2_MEAN": 0.25, "c_NaN_2_MEAN": 0.25, "c_NaN_MEAN": 0.25}
    assert sorted(OneHot.fit(df, ["c"]).transform(df).columns) == ["c_NaN", "c_NaN_2", "c_a_b", "c_a_b_2", "k"]


def test_more_categories_than_columns(spark):
    df = spark.range(12_000).selectExpr("id % 10 AS k", "concat('name ', id) AS name", "CAST(id % 3 AS string) AS few")
    assert narrow_text_columns(df, ["name", "few"]) == ["few"] and list(_shares(df)) == ["few"]
    long = category_shares(df, "k", ["name", "few"])
    assert long.where("column = 'name'").count() == 12_000
    assert long.where("k = 0 AND column = 'few'").count() == 3


def test_wide_text_of_a_feature_set_is_never_lost(spark):
    df = spark.range(3_000).selectExpr("id % 10 AS SK_ID_CURR", "concat('name ', id) AS name", "CAST(id % 2 AS string) AS few", "CAST(id AS double) AS x")
    with pytest.raises(ValueError, match="name"):
        rollup_everything(df, "P_", "N")
    left = []
    got = rollup_everything(df, "P_", "N", left_out=left, subsets=("few", {"ONE_": "1"}))
    assert list(got.shares) == ["few"] and len(left) == 2
    assert left[0].columns == ["SK_ID_CURR", "column", "value", "share", "prefix"]
    assert [(d.count(), d.agg({"share": "sum"}).first()[0], d.first()["prefix"]) for d in left] == [(3_000, pytest.approx(10), "P_"), (1_500, pytest.approx(5), "ONE_")]


def test_null_groups_stay(spark):
    df = spark.createDataFrame([(None, 1, 0.1, 0), (None, 2, 0.4, 1), ("a", 3, 0.9, 0), ("a", 4, 0.2, 1)], "g string, k long, s double, y int")
    assert {r["g"]: r["auc"] for r in roc_auc(df, "y", "s", ["g"]).collect()} == {None: 1.0, "a": 0.0}
    assert {(r["g"], r["k"]): r["rank"] for r in exact_rank(df, ["k"], ["g"]).collect()} == {(None, 1): 0, (None, 2): 1, ("a", 3): 0, ("a", 4): 1}
    assert mid_ranks(df, "s", ["g"]).where("g IS NULL").count() == 2


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 2.0), ("d", None), ("e", 3.0)], "f string, v double")
    assert [r["f"] for r in top_k(df, "v", 3, "f").collect()] == ["e", "a", "b"]
