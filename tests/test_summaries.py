import random

import pytest
from pyspark.sql import functions as F

from featloom.operators.rollup import RollupSpec, rollup, summarise_all
from featloom.operators.summaries import KEY, PARTS, _measured_keys, numeric_summaries

ALL = list(PARTS)


@pytest.fixture(scope="module")
def values(spark):
    draw = random.Random(3)
    data = [
        (None if i % 50 == 0 else (0 if i % 3 == 0 else draw.randrange(40)), 1e6 + draw.randrange(5) / 4, draw.choice([None, draw.random()]),
         (1 << 53) + draw.randrange(3), draw.randrange(4), None)
        for i in range(1500)
    ]
    return spark.createDataFrame(data, "k bigint, far double, gap double, id bigint, code int, none double")


COLUMNS = ["far", "gap", "id", "code", "none"]


def test_equals_the_plain_rollup(values):
    ours = numeric_summaries(values, "k", COLUMNS, ALL, "P_", "N")
    plain = rollup(values, RollupSpec("k", "P_", {c: ALL for c in COLUMNS}, {}, "N"))
    assert ours.columns == plain.columns
    assert [f.dataType for f in ours.schema] == [f.dataType for f in plain.schema]
    expected = {r["k"]: r.asDict() for r in plain.collect()}
    found = {r["k"]: r.asDict() for r in ours.collect()}
    assert found.keys() == expected.keys() and None not in found
    for k, row in expected.items():
        for c, v in row.items():
            if c in ("P_id_VAR", "P_id_STD"):  # beyond the digits of a double in either form
                continue
            assert found[k][c] == (v if v is None or isinstance(v, int) else pytest.approx(v, rel=1e-9, abs=1e-9)), (k, c)


@pytest.mark.parametrize("hot_cells", [10**9, 500, 5])
def test_large_tables_give_the_same_by_one_shuffle(values, hot_cells):
    """Without the small tables' form: no key hot, the key of a third of the rows hot, and all keys hot."""
    wide = numeric_summaries(values, "k", COLUMNS, ALL, "P_", "N", long_form_rows=0, hot_cells=hot_cells)
    long = numeric_summaries(values, "k", COLUMNS, ALL, "P_", "N")
    assert wide.columns == long.columns and [f.dataType for f in wide.schema] == [f.dataType for f in long.schema]
    expected = {r["k"]: r.asDict() for r in long.collect()}
    found = wide.collect()
    assert len(found) == len(expected) and {r["k"] for r in found} == expected.keys()
    for r in found:
        for c, v in r.asDict().items():
            if c not in ("P_id_VAR", "P_id_STD"):  # beyond the digits of a double in either form
                assert v == (expected[r["k"]][c] if v is None or isinstance(v, int) else pytest.approx(expected[r["k"]][c], rel=1e-9, abs=1e-9)), (r["k"], c)


def test_large_tables_shuffle_rows_not_cells(values):
    wide = values.select("k", *[(F.col("far") * i).alias(f"c{i}") for i in range(30)])
    out = numeric_summaries(wide, "k", wide.columns[1:], ALL, long_form_rows=0, hot_cells=10**9)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and text.count("Scan ") == 1
    assert not any(word in text for word in ("Generate", "Expand", "Window", "Join"))


def test_only_keys_with_many_rows_are_hot(values):
    keys = values.where("k IS NOT NULL").select(F.col("k").alias(KEY))
    counts = {r[0]: r[1] for r in keys.groupBy(KEY).count().collect()}
    assert _measured_keys(keys, 100, 0) == (sum(counts.values()), [0])
    assert _measured_keys(keys, 100, 10**6) == (sum(counts.values()), [])
    assert sorted(_measured_keys(keys, 20, 0)[1]) == sorted(k for k, n in counts.items() if n > 20)


def test_odd_values_in_large_tables(spark, in_order):
    df = spark.createDataFrame([(1, 1.0, None), (1, -0.0, 2), (1, 0.0, 2), (2, float("nan"), None), (2, float("nan"), None), (None, 1.0, 1)], "k int, `x.y` double, n int")
    out = numeric_summaries(df, "k", ["x.y", "n"], ["nunique", "count", "max", "sum"], "S_", long_form_rows=0)
    (_, *one), (_, *two) = in_order(out, "k")
    assert one == [2, 3, 1.0, 1.0, 1, 2, 2, 4] and two[:2] == [1, 2] and two[4:] == [0, 0, None, 0]


def test_three_shuffles_for_any_number_of_columns(values):
    wide = values.select("k", *[(F.col("far") * i).alias(f"c{i}") for i in range(30)])
    text = summarise_all(wide, "k", ALL)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 3 and text.count("Scan ") == 1
    assert "Expand" not in text and "Window" not in text


def test_empty_odd_and_text_columns(spark, in_order):
    empty = spark.createDataFrame([], "k bigint, x double")
    assert summarise_all(empty, "k", ["mean", "nunique"], "S_", count_as="N").collect() == []
    df = spark.createDataFrame([(1, 1.0, "a"), (1, 1.0, "b"), (1, -0.0, "b"), (1, 0.0, None), (2, float("nan"), None)], "k int, `x.y` double, t string")
    out = summarise_all(df, "k", ["max", "nunique"], "S_")
    assert out.columns == ["k", "S_x.y_MAX", "S_x.y_NUNIQUE", "S_t_MAX", "S_t_NUNIQUE"]
    assert [r[2:] for r in in_order(out, "k")] == [(2, "b", 2), (1, None, 0)]
    with pytest.raises(ValueError):
        numeric_summaries(df, "k", ["t"], ["max"])
