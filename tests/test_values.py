import math

import pytest
from pyspark.sql import functions as F

from featloom.functions import rowwise as rw
from featloom.functions import special
from featloom.functions import values as v
from featloom.operators.clean import (
    NullRule,
    apply_null_rules,
    columns_matching,
    exclude_values,
    exclude_where,
    nan_columns_to_null,
    narrow_types,
    non_finite_to_null,
)

NAN, INF = float("nan"), float("inf")


def column(df, expr):
    return [r[0] for r in df.orderBy("k").select(expr).collect()]


@pytest.fixture(scope="module")
def pay(spark):
    return spark.createDataFrame([(1, 10.0, 7.0), (2, 5.0, 9.0), (3, 4.0, 4.0), (4, None, 2.0)], "k bigint, due double, paid double")


def test_clamp_has_two_null_rules(pay):
    late = F.col("paid") - F.col("due")
    assert column(pay, v.clamp_zero(late, null_as_zero=True)) == [0.0, 4.0, 0.0, 0.0]
    assert column(pay, v.clamp_zero(late, null_as_zero=False)) == [0.0, 4.0, 0.0, None]


def test_ratio_by_zero_and_null(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, None, 2.0), (3, 3.0, 2.0)], "k int, a double, b double")
    assert column(df, v.ratio("a", "b")) == [None, None, 1.5]


def test_clip_keeps_null(pay):
    assert column(pay, v.clip("due", 4.5, 6.0)) == [6.0, 5.0, 4.5, None]


def test_flags_treat_unknown_as_no(spark):
    df = spark.createDataFrame([(1, -600), (2, 5), (3, None)], "k int, d int")
    assert column(df, v.flag(F.col("d") < -500)) == [1, 0, 0]
    assert column(df, v.member_flag("d", [5, 6])) == [0, 1, 0]


def test_filters_keep_unknown_rows(spark):
    df = spark.createDataFrame([(1, "XNA", 1, 2), (2, None, None, 2), (3, "", 3, 3), (4, "M", 4, 3)], "k int, c string, a int, b int")
    assert [r["k"] for r in exclude_values(df, {"c": "XNA"}).collect()] == [2, 3, 4]
    assert [r["k"] for r in exclude_where(df, F.col("a") < F.col("b")).collect()] == [2, 3, 4]


def test_null_rules(spark):
    df = spark.createDataFrame([(1, 365243), (2, 3), (3, -50000), (4, -20), (5, None)], "k int, d int")
    out = apply_null_rules(df, [NullRule("d", above=0, below=-40000)])
    assert column(out, "d") == [None, None, None, -20, None]
    assert column(apply_null_rules(df, [NullRule("d", equals=365243)]), "d") == [None, 3, -50000, -20, None]


def test_nan_and_infinity(spark):
    df = spark.createDataFrame([(1, NAN), (2, INF), (3, 1.0), (4, None)], "k int, x double")
    assert column(nan_columns_to_null(df), "x") == [None, INF, 1.0, None]
    assert column(non_finite_to_null(df), "x") == [None, None, 1.0, None]
    assert column(df, v.sqrt_or_null(-F.col("x"))) == [None, None, None, None]


def test_narrowing_has_strict_bounds(spark):
    df = spark.createDataFrame(
        [(126, 127, 32767, 2**31, None, 0.5), (0, 0, 0, 0, None, 1.5)],
        "a bigint, b bigint, c bigint, d bigint, e bigint, f double",
    )
    types = dict(narrow_types(df).dtypes)
    assert types == {"a": "tinyint", "b": "smallint", "c": "int", "d": "bigint", "e": "bigint", "f": "double"}
    assert dict(narrow_types(df, narrow_floats=True).dtypes)["f"] == "float"


def test_pattern_choice(spark):
    df = spark.range(1).selectExpr("1 FLAG_DOCUMENT_2", "1 FLAG_MOBIL", "1 N_FLAG_X", "1 OTHER")
    assert columns_matching(df, "FLAG_DOC") == ["FLAG_DOCUMENT_2"]
    assert columns_matching(df, "FLAG_", "FLAG_DOC|_FLAG_") == ["FLAG_MOBIL"]


@pytest.fixture(scope="module")
def wide(spark):
    data = [(1, 1.0, 2.0, 4.0, 9.0), (2, 1.0, None, 4.0, 7.0), (3, None, None, None, None), (4, 5.0, 5.0, 5.0, 5.0), (5, 2.0, None, None, None)]
    return spark.createDataFrame(data, "k int, a double, b double, c double, d double")


COLS = ["a", "b", "c", "d"]


def test_row_sums_and_means(wide):
    assert column(wide, rw.row_null_count(COLS)) == [0, 1, 4, 0, 3]
    assert column(wide, rw.row_sum(COLS)) == [16.0, 12.0, 0.0, 20.0, 2.0]
    assert column(wide, rw.row_sum(COLS, skip_nulls=False)) == [16.0, None, None, 20.0, None]
    assert column(wide, rw.row_mean(COLS)) == [4.0, 4.0, None, 5.0, 2.0]
    assert column(wide, rw.row_mean(COLS, skip_nulls=False)) == [4.0, None, None, 5.0, None]


def test_row_std(wide):
    std = column(rw.with_row_std(wide, COLS, "s"), "s")
    assert std[0] == pytest.approx(math.sqrt(38 / 3)) and std[1] == pytest.approx(3.0)
    assert std[2:] == [None, 0.0, None]
    assert column(rw.with_row_std(wide, COLS, "s", skip_nulls=False), "s")[1:] == [None, None, 0.0, None]


def test_two_kurtosis_definitions(wide):
    x = [1.0, 2.0, 4.0, 9.0]
    d = [i - 4.0 for i in x]
    m2, m4 = sum(i**2 for i in d), sum(i**4 for i in d)
    sample = column(rw.with_row_kurtosis_sample(wide, COLS, "q"), "q")
    assert sample[0] == pytest.approx(4 * 5 * 3 * m4 / (2 * 1 * m2**2) - 3 * 9 / 2)
    assert sample[1:] == [None, None, 0.0, None]
    moment = column(rw.with_row_kurtosis_moment(wide, COLS, "q"), "q")
    assert moment[0] == pytest.approx(4 * m4 / m2**2)
    assert moment[1:] == [None, None, None, None]


def test_normal_functions(spark):
    df = spark.range(1, 1000).selectExpr("id k", "id / 1000D p")
    for r in df.select("p", special.erfinv(2 * F.col("p") - 1).alias("e"), special.two_sided_p(special.probit(F.col("p"))).alias("t")).collect():
        assert math.erf(r["e"]) == pytest.approx(2 * r["p"] - 1, abs=1e-7)
        assert r["t"] == pytest.approx(2 * min(r["p"], 1 - r["p"]), abs=1e-6)


def test_missing_count_over_a_thousand_columns(spark):
    wide = spark.range(2).select("id", *[F.when(F.col("id") == 0, F.lit(i)).alias(f"c{i}") for i in range(1000)])
    counts = wide.select("id", rw.row_null_count([f"c{i}" for i in range(1000)]).alias("n"))
    assert {r["id"]: r["n"] for r in counts.collect()} == {0: 0, 1: 1000}
