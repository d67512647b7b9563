"""Keyed bijections: each place once, label arrays and shuffled columns without a sort per seed."""

import pytest
from pyspark.sql import functions as F

from featloom.operators.bijection import grid, keyed_bijection, permute, permuted_classes, permuted_rows, with_places
from featloom.operators.models import FEATURES
from featloom.operators.selection import NULL_LABELS, null_labelled
from featloom.workspace import materialise


@pytest.mark.parametrize("n", [1, 2, 3, 7, 10, 12, 13, 100, 101, 1024, 5000])
def test_every_place_is_met_once(spark, n):
    a, b = grid(n)
    assert n <= a * b < n + a + 1
    ids = spark.range(n).select("id", *[keyed_bijection(F.col("id"), n, s).alias(f"p{s}") for s in (1, 2)]).collect()
    for s in (1, 2):
        assert sorted(r[f"p{s}"] for r in ids) == list(range(n))
    if n >= 1000:
        assert sum(r["p1"] == r["id"] for r in ids) < 12 and sum(r["p1"] == r["p2"] for r in ids) < 12
        # Neighbours part: the mean distance is that of a random order.
        order = [r["p1"] for r in sorted(ids, key=lambda r: r["id"])]
        assert 0.25 < sum(abs(x - y) for x, y in zip(order, order[1:])) / n / n < 0.42


def test_null_place(spark):
    assert spark.range(1).select(keyed_bijection(F.lit(None).cast("long"), 5, 1)).first()[0] is None


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(1000).select((F.col("id") * 7 - 50).alias("key"), F.pmod("id", F.lit(3)).cast("double").alias("y"), (F.col("id") * 2).alias("x"), F.when(F.col("id") % 10 > 0, F.col("id")).alias("z")).repartition(5)


def test_permute_uses_every_row_once(rows):
    got = permute(rows, "key", ["x", "z"], [1, "b"]).collect()
    values = sorted((r["x"], r["z"] or -1) for r in rows.collect())
    for seed in ("1", "b"):
        run = [r for r in got if r["seed"] == seed]
        assert sorted((r["x"], r["z"] or -1) for r in run) == values and len({r["key"] for r in run}) == 1000


def test_label_arrays_keep_the_class_sizes_and_join_nothing(rows):
    out = permuted_classes(rows, "key", "y", range(20))
    got = out.collect()
    for s in range(20):
        drawn = [r["labels"][s] for r in got]
        assert [drawn.count(v) for v in (0.0, 1.0, 2.0)] == [334, 333, 333]
        assert 0.25 < sum(d == r["y"] for d, r in zip(drawn, got)) / 1000 < 0.42
    vectors = materialise(out.select("key", F.col("labels").alias(NULL_LABELS), F.col("x").alias(FEATURES)), "drawn")
    for df in (out, null_labelled(vectors, "key", 3)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Join" not in text
    with pytest.raises(ValueError, match="more than"):
        permuted_classes(rows, "key", "x", [1]) if rows.select("x").distinct().count() > 1000 else permuted_classes(rows.union(rows.withColumn("x", F.col("x") + 1)), "key", "x", [1])


def test_each_column_is_shuffled_by_itself_in_one_exchange(rows):
    placed, n = with_places(rows, "key")
    out = permuted_rows(placed, n, ["x", "z"], 5)
    got = out.collect()
    assert sorted((r["key"], r["x"], r["z"] or -1) for r in got) == sorted((r["key"], r["x"], r["z"] or -1) for r in rows.collect())
    for c in ("x", "z"):
        assert sorted(-1 if r[c] is None else r[c] for r in got) == sorted(-1 if r[f"shadow_{c}"] is None else r[f"shadow_{c}"] for r in got)
    assert sum(r["shadow_x"] == 2 * (r["shadow_z"] or -1) for r in got) < 20
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1 and "Join" not in text
