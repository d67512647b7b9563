"""Intermediate tables go to the folder the session names; checked in a session of its own."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from featloom.operators.rollup import category_shares
from featloom.plans import credit
from featloom.plans.credit_roles import credit_tables
from featloom.sources.tables import table
from featloom.workspace import discard, materialise, settle, shared_dir

SCRIPT = """
import glob, sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from featloom.operators.rank import exact_rank
from featloom.workspace import shared_dir
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", sys.argv[1]).config("spark.sql.shuffle.partitions", "4").getOrCreate())
df = spark.range(1000).withColumn("x", F.col("id") % 7)
assert shared_dir(spark) == sys.argv[1]
assert exact_rank(df, ["x", "id"]).agg(F.max("rank")).first()[0] == 999
assert glob.glob(sys.argv[1] + "/rank-*"), "no table in the named folder"
spark.stop()
"""


def test_named_checkpoint_folder_is_used(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "PYTHONPATH": root}
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]


def test_settled_tables_let_go_of_what_they_were_made_from(spark):
    detail = materialise(spark.range(10).withColumn("x", F.lit(1.0)), "detail")
    folder = detail.inputFiles()[0].removeprefix("file:").rsplit("/", 1)[0]
    out = settle(detail.groupBy((F.col("id") % 2).alias("k")).agg(F.sum("x").alias("x")), "rollup", detail)
    assert not os.path.exists(folder) and sorted(map(tuple, out.collect())) == [(0, 5.0), (1, 5.0)]


def test_only_written_tables_are_discarded(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/own")
    with pytest.raises(ValueError):
        discard(spark.read.parquet(f"{tmp_path}/own"))
    assert spark.read.parquet(f"{tmp_path}/own").count() == 3


def test_a_settled_rollup_keeps_what_it_left_out(spark):
    """The detail rows go with the rollup, so the long shares made from them are written first."""
    loans = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "SK_ID_CURR int, goods string")

    def rolled(df, left_out):
        detail = materialise(df, "detail")
        left_out.append(category_shares(detail, "SK_ID_CURR", ["goods"]))
        return detail.groupBy("SK_ID_CURR").agg(F.count("*").alias("n"))

    left_out = [spark.range(1)]
    out = credit.settled(rolled, loans, left_out=left_out)
    assert sorted(map(tuple, out.collect())) == [(1, 2), (2, 1)] and len(left_out) == 2
    assert sorted((r["SK_ID_CURR"], r["value"], r["share"]) for r in left_out[1].collect()) == [(1, "a", 0.5), (1, "b", 0.5), (2, "a", 1.0)]


@pytest.mark.parametrize("features", [credit.second_features, credit.canonical_features])
def test_feature_sets_settle_their_rollups(spark, features):
    top = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    wide = features(credit_tables(spark, "/root/testdata/sf0.001"))
    left = sorted(name.split("-")[0] for name in set(os.listdir(top)) - before)
    assert left.count("rollup") == 5 and not {"detail", "bureau", "parts"} & set(left)
    assert wide.where("SK_ID_CURR IS NOT NULL").count() > 0


def test_the_summary_set_keeps_no_detail_rows(spark):
    """The rollups are written one after another; neither their detail rows nor the joined wide rows stay on disk."""
    top = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    wide = credit.summary_features(credit_tables(spark, "/root/testdata/sf0.001"))
    left = sorted(name.split("-")[0] for name in set(os.listdir(top)) - before)
    assert left.count("rollup") == 5 and "detail" not in left and "summary" not in left
    assert wide.count() == table(spark, "/root/testdata/sf0.001", "customer").count()
    assert wide.columns.index("NEW_INC_BY_ORG") == wide.columns.index("LIVE_IND_SUM") + 1 and wide.columns[:2] == ["ORGANIZATION_TYPE", "SK_ID_CURR"]
