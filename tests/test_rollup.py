import random

import pytest
from pyspark.sql import functions as F

from featloom.operators.assemble import stack_labelled, star_join
from featloom.operators.rollup import (
    RollupSpec,
    first_and_last,
    rollup,
    rollup_subsets_by_join,
    rollup_with_subsets,
    status_history,
    summarise_all,
)


def test_empty_and_single_row_groups(spark, in_order):
    data = [(1, None), (1, None), (2, 5.0), (3, 1.0), (3, 4.0), (None, 9.0)]
    df = spark.createDataFrame(data, "k bigint, x double")
    functions = ["sum", "mean", "var", "min", "max", "count", "nunique"]
    out = rollup(df, RollupSpec("k", "P_", {"x": functions}, {}, "P_COUNT"))
    assert in_order(out, "k") == [
        (1, 0.0, None, None, None, None, 0, 0, 2),
        (2, 5.0, 5.0, None, 5.0, 5.0, 1, 1, 1),
        (3, 5.0, 2.5, 4.5, 1.0, 4.0, 2, 2, 2),
    ]


@pytest.fixture(scope="module")
def loans(spark):
    draw = random.Random(1)
    data = []
    for i in range(2000):
        key = 0 if i % 3 == 0 else draw.randrange(60)
        data.append((key, draw.choice(["A", "C", "S", None]), 1e6 + draw.random(), draw.choice([None, draw.random()]), key))
    return spark.createDataFrame(data, "k bigint, s string, big double, gap double, fixed bigint")


def test_one_pass_subsets_equal_filtered_rollups(loans):
    functions = ["min", "max", "count", "sum", "mean", "var", "std"]
    spec = RollupSpec("k", "ALL_", {c: functions for c in ("big", "gap", "fixed")}, {"s": ["A", None]}, "COUNT")
    subsets = {"ACT_": "A", "CLO_": "C", "NONE_": "zzz"}
    ours = {r["k"]: r.asDict() for r in rollup_with_subsets(loans, spec, "s", subsets).collect()}
    theirs = {r["k"]: r.asDict() for r in rollup_subsets_by_join(loans, spec, "s", subsets).collect()}
    assert ours.keys() == theirs.keys()
    for k, expected in theirs.items():
        assert ours[k].keys() == expected.keys()
        for c, value in expected.items():
            assert ours[k][c] == (value if value is None else pytest.approx(value, rel=1e-9, abs=1e-12)), (k, c)
    assert all(r["ALL_fixed_VAR"] in (0.0, None) for r in ours.values())
    assert all(r["NONE_big_SUM"] is None for r in ours.values())


def test_distinct_counts_are_refused_in_one_pass(loans):
    with pytest.raises(ValueError):
        rollup_with_subsets(loans, RollupSpec("k", "P_", {"s": ["nunique"]}), "s", {"A_": "A"})


def test_many_columns_take_several_passes(loans, spark):
    wide = loans.select("k", *[(F.col("big") * i).alias(f"c{i}") for i in range(30)])
    spec = RollupSpec("k", "P_", {f"c{i}": ["min", "max", "sum"] for i in range(30)}, {}, "P_COUNT")
    out = rollup(wide, spec)
    assert len(out.columns) == 92
    one = wide.groupBy("k").agg(F.max("c29").alias("m"), F.count("*").alias("n"))
    pairs = out.join(one, "k").select(F.col("P_c29_MAX") == F.col("m"), F.col("P_COUNT") == F.col("n")).distinct().collect()
    assert [tuple(p) for p in pairs] == [(True, True)]


MONTHS = [
    (1, 0, "C"), (1, -1, "C"), (1, -2, "1"), (1, -3, "0"), (1, -4, None),
    (2, 0, "X"), (2, -1, "5"), (2, -2, "5"),
    (3, -7, None),
]


def test_status_history(spark, in_order):
    df = spark.createDataFrame(MONTHS, "loan bigint, month int, status string")
    out = status_history(df, "loan", "month", "status", "C", ["0", "1", "5"], ["1", "5"])
    columns = ["loan", "First_status", "Last_status", "Month", "When_closed", "Month_closed_to_end", "DPD_0_cnt", "DPD_1_cnt", "DPD_5_cnt", "DPD_1_per_Month", "Non_zero_DPD_cnt"]
    assert in_order(out.select(columns), "loan") == [
        (1, "0", "C", 4, 1, 3, 1, 1, None, 0.25, 1),
        (2, "5", "X", 2, None, None, None, None, 2, None, 2),
        (3, None, None, 7, None, None, None, None, None, None, 0),
    ]


def test_first_and_last_skip_nulls(spark, in_order):
    df = spark.createDataFrame(MONTHS, "loan bigint, month int, status string")
    out = first_and_last(df, "loan", "status", ["month"], "first", "last")
    assert in_order(out, "loan") == [(1, "0", "C"), (2, "5", "X")]


def test_star_join_keeps_base_rows(spark):
    base = spark.range(10).withColumnRenamed("id", "k")
    right = spark.range(5).select(F.col("id").alias("k"), F.lit(1).alias("x"))
    out = star_join(base, [right, right.withColumnRenamed("x", "y")], "k")
    assert out.count() == 10 and out.where("x IS NULL AND y IS NULL").count() == 5


def test_stacking_adds_a_null_label(spark, in_order):
    train = spark.createDataFrame([(1, 0)], "k int, TARGET int")
    test = spark.createDataFrame([(2,)], "k int")
    assert in_order(stack_labelled(train, test), "k") == [(1, 0), (2, None)]


def test_summarise_all(spark, in_order):
    df = spark.createDataFrame([(1, 2.0, 7), (1, 4.0, 7), (2, None, 7)], "k int, x double, ref int")
    out = summarise_all(df, "k", ["mean", "nunique"], "S_", ["ref"], "N")
    assert in_order(out, "k") == [(1, 3.0, 2, 2), (2, None, 0, 1)]
