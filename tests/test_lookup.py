import pytest
from pyspark.sql import functions as F

from featloom.workspace import lookup_join


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has no key, a third the same key."""
    key = F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 7).otherwise(F.col("id") % 500)
    return spark.range(3000).select("id", key.cast("int").alias("k"), F.lit("x").alias("j"))


@pytest.fixture(scope="module")
def names(spark):
    return spark.range(300).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("j"), F.concat(F.lit("n"), F.col("id")).alias("name"))


def test_small_lookups_are_broadcast(facts, names):
    assert "BroadcastHashJoin" in plan(lookup_join(facts, names, ["k", "j"]))


@pytest.mark.parametrize("bound", [{"max_rows": 299}, {"max_bytes": 300 * 48}])
def test_both_ways_give_the_same_rows(facts, names, bound, in_order):
    shuffled = lookup_join(facts, names, ["k", "j"], **bound)
    text = plan(shuffled)
    assert "Broadcast" not in text and "__shard" in text
    near = lookup_join(facts, names, ["k", "j"])
    assert near.columns == shuffled.columns and in_order(near, "id") == in_order(shuffled, "id")
    assert shuffled.count() == 3000 and shuffled.where("name IS NULL AND k < 300").count() == 0


def test_wide_lookup_is_not_broadcast(spark, facts):
    """50,000 rows of 1 kB: fewer rows than the bound, more bytes, and next to nothing as a file."""
    wide = spark.range(50_000).select(F.col("id").cast("int").alias("k"), F.lit("w" * 1000).alias("note"))
    assert "Broadcast" not in plan(lookup_join(facts, wide, ["k"]))


def test_lookup_runs_once(spark, facts):
    """A lookup that draws at random would show two runs."""
    drawn = spark.range(300).select(F.col("id").cast("int").alias("k"), F.rand().alias("r"))
    joined = lookup_join(facts, drawn, ["k"], max_rows=10)
    assert joined.orderBy("id").collect() == joined.orderBy("id").collect()
    assert "Scan parquet" in plan(joined) and "rand(" not in plan(joined)


def test_null_keys_are_spread(spark, facts, names):
    joined = lookup_join(facts, names, ["k", "j"], max_rows=1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) > 1 and max(r["count"] for r in sizes) < 500


def test_empty_lookup(spark, facts):
    empty = spark.createDataFrame([], "k int, name string")
    assert lookup_join(facts, empty, ["k"]).where("name IS NULL").count() == 3000
