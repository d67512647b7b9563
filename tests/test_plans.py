"""Plan shapes that have to hold at any data size."""

import pytest
from pyspark.sql import functions as F

from featloom.operators.encode import rank_gauss
from featloom.operators.bijection import permute
from featloom.operators.rank import exact_rank, running_totals, value_counts
from featloom.operators.rollup import RollupSpec, rollup
from featloom.operators.separation import class_separation
from featloom.sources.tables import table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def logical(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    return table(spark, SF, "lineitem")


def test_one_shuffle_per_rollup(lines):
    text = plan(rollup(lines, RollupSpec("l_orderkey", "P_", {"l_quantity": ["min", "mean", "var", "sum"]}, {"l_returnflag": ["A"]}, "P_COUNT")))
    assert text.count("Exchange") == 1 and "hashpartitioning(l_orderkey" in text
    assert text.count("HashAggregate") == 2


def test_scan_reads_only_used_columns_and_pushes_filters(lines):
    text = plan(rollup(lines.where(F.col("l_linestatus") == "F"), RollupSpec("l_orderkey", "P_", {"l_tax": ["max"]})))
    assert "EqualTo(l_linestatus,F)" in text and "IsNotNull(l_orderkey)" in text
    schema = text.split("ReadSchema: ")[1]
    assert "l_tax" in schema and "l_extendedprice" not in schema


def test_grouped_ranks_and_totals_never_sort_everything_in_one_task(lines):
    ranked = exact_rank(lines.select("l_returnflag", "l_tax", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                        ["l_tax", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], ["l_returnflag"])
    totals = running_totals(value_counts(lines, "l_extendedprice", ["l_returnflag"]), ["l_extendedprice"], ["n"], ["l_returnflag"])
    for df in (ranked, totals):
        assert "SinglePartition" not in plan(df)


def test_ungrouped_rank_joins_only_partition_offsets(lines):
    """Rows meet a local table with one row per partition; nothing is sorted in one task."""
    text = plan(exact_rank(lines.select("l_tax", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
                           ["l_tax", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]))
    assert "BroadcastHashJoin" in text and "LocalTableScan [__part" in text
    assert "SinglePartition" not in text and "Window" not in text


def test_no_python_rows_in_numeric_operators(spark, lines):
    parts = table(spark, SF, "part").select("p_partkey", "p_size", "p_retailprice")
    docs = table(spark, SF, "documents").select("doc_id", "n_chars", (F.col("doc_id") % 2).alias("y"))
    for df in (
        rank_gauss(parts, "p_partkey", ["p_size", "p_retailprice"]),
        class_separation(docs, ["n_chars"], "y"),
        permute(docs, "doc_id", ["y"], [1, 2]),
    ):
        text = plan(df)
        assert "Python" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
