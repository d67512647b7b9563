import datetime

import pytest
from pyspark.sql import functions as F

from featloom.operators.places import packed_place
from featloom.operators.rollup import first_and_last, status_history
from featloom.plans.catalog import REGISTRY

SF = "/root/testdata/sf0.001"
DATA = [
    (1, datetime.date(2020, 1, 5), 7, "b"), (1, None, 9, "c"), (1, datetime.date(1960, 1, 5), -3, "a"), (1, datetime.date(2020, 1, 5), 7, "a"),
    (2, datetime.date(2020, 1, 5), None, None), (2, datetime.date(2020, 1, 5), None, "d"), (None, None, None, "z"),
]


@pytest.mark.parametrize("shift, kind", [(1, "bigint"), (1 << 40, "decimal(38,0)")])
def test_packed_ends(spark, in_order, shift, kind):
    df = spark.createDataFrame(DATA, "k int, d date, n bigint, s string").withColumn("m", F.col("n") * shift)
    df = df.withColumn("p", F.col("m") * 3)
    known = df.where("s IS NOT NULL")
    packed = packed_place(known, ["d", "m", "p"], "s")
    assert known.select(packed.place).dtypes[0][1] == kind
    out = first_and_last(df, "k", "s", ["d", "m", "p"], "f", "l")
    assert in_order(out, "k") == [(1, "c", "b"), (2, "d", "d")]


def test_orders_that_do_not_fit_compare_columns(spark, in_order):
    df = spark.createDataFrame([(1, "x", 1, "b"), (1, "a", -(1 << 63), "c"), (1, "z", (1 << 63) - 1, "a")], "k int, t string, n bigint, s string")
    assert packed_place(df, ["t"], "s") is None and packed_place(df, ["n"], "s") is None
    assert in_order(first_and_last(df, "k", "s", ["t"], "f", "l"), "k") == [(1, "c", "a")]
    assert in_order(first_and_last(df, "k", "s", ["n"], "f", "l"), "k") == [(1, "c", "a")]


def test_times_without_zone_keep_microseconds(spark, in_order):
    df = spark.sql("""SELECT 1 AS k, TIMESTAMP_NTZ '2020-03-29 02:30:00.000002' AS t, 'b' AS s UNION ALL SELECT 1, TIMESTAMP_NTZ '2020-03-29 02:30:00.000001', 'c'
        UNION ALL SELECT 1, TIMESTAMP_NTZ '1969-12-31 23:59:59.999999', 'a' UNION ALL SELECT 2, TIMESTAMP_NTZ '1950-01-01 00:00:01', 'x'""")
    assert packed_place(df, ["t"], "s") is not None
    assert in_order(first_and_last(df, "k", "s", ["t"], "f", "l"), "k") == [(1, "a", "b"), (2, "x", "x")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "k int, n int, s string")
    assert first_and_last(df, "k", "s", ["n"], "f", "l").collect() == []
    assert status_history(df, "k", "n", "s", "C", ["0"], ["0"], statuses=[]).collect() == []


def test_history_with_listed_statuses(spark, in_order):
    data = [(1, 0, "C"), (1, -4, None), (1, -3, "5"), (1, -3, "0"), (2, -1, None), (3, None, "0"), (3, -2, "X"), (3, -2, "C")]
    df = spark.createDataFrame(data, "k int, m int, s string")
    ends = lambda **how: in_order(status_history(df, "k", "m", "s", "C", ["0", "5"], ["5"], **how).select("k", "First_status", "Last_status"), "k")
    assert ends(statuses=["0", "5", "C", "X", None]) == [(1, "0", "C"), (2, None, None), (3, "C", "X")]
    with pytest.raises(ValueError):
        ends(statuses=["0"], tie_break=["s"])


@pytest.mark.parametrize("name", ["status_first_last", "credit_bureau_balance"])
def test_no_sorted_aggregate(spark, name):
    text = REGISTRY[name].run(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and "HashAggregate" in text
