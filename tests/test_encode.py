import math

import pytest
from pyspark.sql import functions as F

import featloom.operators.encode as encode
from featloom.operators.encode import (
    AlphabeticalCodes,
    FirstSeenCodes,
    OneHot,
    TargetMean,
    fill_derived_with_mean,
    fill_with_mean,
    group_median_lookup,
    rank_gauss,
)
from featloom.workspace import lookup_join, small_or_none


@pytest.fixture(scope="module")
def cats(spark):
    data = [(1, "b", 1), (2, None, 0), (3, "a x", 1), (4, "b", 0), (5, "", 1), (6, "unseen", None)]
    return spark.createDataFrame(data, "k bigint, c string, y int")


def test_one_hot_forms(cats):
    observed = OneHot.fit(cats, ["c"])
    assert list(observed.columns()) == ["c_", "c_a_x", "c_b", "c_unseen", "c_NaN"]
    out = observed.transform(cats).orderBy("k").collect()
    assert [r["c_b"] for r in out] == [1, 0, 0, 1, 0, 0] and [r["c_NaN"] for r in out] == [0, 1, 0, 0, 0, 0]
    assert "c_NaN" not in OneHot.fit(cats, ["c"], "never").columns()
    full = cats.where("c IS NOT NULL")
    assert "c_NaN" in OneHot.fit(full, ["c"], "always").columns() and "c_NaN" not in OneHot.fit(full, ["c"]).columns()


def test_one_hot_names_stay_apart(spark):
    df = spark.createDataFrame([("a b",), ("a-b",)], "c string")
    assert list(OneHot.fit(df, ["c"]).columns()) == ["c_a_b", "c_a_b_2"]


def test_one_hot_refuses_unbounded_categories(spark, monkeypatch):
    monkeypatch.setattr(encode, "MAX_ONE_HOT_COLUMNS", 5)
    with pytest.raises(ValueError):
        OneHot.fit(spark.range(100).selectExpr("CAST(id AS STRING) c"), ["c"])


def test_target_mean(cats, in_order):
    out = TargetMean.fit(cats, ["c"], "y").transform(cats, "_m").select("k", "c_m")
    assert in_order(out, "k") == [(1, 0.5), (2, None), (3, 1.0), (4, 0.5), (5, 1.0), (6, None)]


def test_target_mean_out_of_fold_ignores_own_fold(spark, in_order):
    df = spark.createDataFrame([(1, "a", 1, 0), (2, "a", 0, 1), (3, "a", 0, 1), (4, "a", None, None)], "k int, c string, y int, fold int")
    out = TargetMean.fit(df, ["c"], "y", fold="fold").transform(df, "_m").select("k", "c_m")
    assert in_order(out, "k") == [(1, 0.0), (2, 1.0), (3, 1.0), (4, pytest.approx(1 / 3))]


@pytest.mark.parametrize("small", [0, 100])
def test_codes_agree_on_both_paths(cats, in_order, small):
    first = FirstSeenCodes.fit(cats, "c", "k", max_small=small).transform(cats, "f").select("k", "f")
    assert in_order(first, "k") == [(1, 0), (2, -1), (3, 1), (4, 0), (5, 2), (6, 3)]
    alpha = AlphabeticalCodes.fit(cats, "c", max_small=small).transform(cats, "f").select("k", "f")
    assert in_order(alpha, "k") == [(1, 3), (2, None), (3, 2), (4, 3), (5, 1), (6, 4)]


def test_group_median_lookup(spark, in_order):
    df = spark.createDataFrame([(1, "a", 1.0), (2, "a", 4.0), (3, "b", None), (4, None, 2.0)], "k int, g string, x double")
    assert in_order(group_median_lookup(df, "g", "x", "m").select("k", "m"), "k") == [(1, 2.5), (2, 2.5), (3, None), (4, None)]


def test_mean_fill_on_train_or_all(spark, in_order):
    df = spark.createDataFrame([(1, 1.0, 1), (2, 3.0, None), (3, None, 0)], "k int, x double, y int")
    assert in_order(fill_with_mean(df, ["x"]).select("k", "x"), "k")[2] == (3, 2.0)
    assert in_order(fill_with_mean(df, ["x"], "y", "train").select("k", "x"), "k")[2] == (3, 1.0)
    assert in_order(fill_with_mean(df, ["x"], limit=2.5).select("k", "x"), "k")[1] == (2, 2.5)


def test_derived_fill(spark, in_order):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, s double")
    assert in_order(fill_derived_with_mean(df, "s"), "k") == [(1, 1.0), (2, 2.0), (3, 3.0)]


def test_rank_gauss_inverts_to_the_rank(spark):
    n = 101
    df = spark.range(n).selectExpr("id k", "CAST((id * 37) % 101 AS DOUBLE) x", "CAST(id % 3 AS DOUBLE) y")
    out = rank_gauss(df, "k", ["x", "y"]).collect()
    assert abs(sum(r["x"] for r in out)) < 1e-9 and abs(sum(r["y"] for r in out)) < 1e-9
    for r in out:
        rank = (r["k"] * 37) % 101
        assert math.erf(r["x"]) == pytest.approx((2 * rank - (n - 1)) / n, abs=1e-7)


def test_lookup_join_with_and_without_broadcast(spark, in_order):
    df = spark.range(20).withColumn("c", F.col("id") % 4)
    lookup = spark.createDataFrame([(0, "x"), (1, "y")], "c bigint, v string")
    small, large = lookup_join(df, lookup, ["c"]), lookup_join(df, lookup, ["c"], max_rows=1)
    assert in_order(small, "id") == in_order(large, "id")
    assert small_or_none(lookup, 1) is None


def test_codes_of_several_columns_equal_single_fits(cats, in_order):
    df = cats.withColumn("d", F.when(F.col("k") > 2, F.lit("z")).otherwise(F.lit("y")))
    for single, many in (
        ([FirstSeenCodes.fit(df, c, "k") for c in ("c", "d")], FirstSeenCodes.fit_all(df, ["c", "d"], "k")),
        ([AlphabeticalCodes.fit(df, c) for c in ("c", "d")], AlphabeticalCodes.fit_all(df, ["c", "d"])),
    ):
        one, all_ = df, df
        for a, b in zip(single, many):
            one, all_ = a.transform(one), b.transform(all_)
        assert in_order(one.select("k", "c", "d"), "k") == in_order(all_.select("k", "c", "d"), "k")
