"""Intermediate tables and small lookup tables.

Lineage is cut by writing Parquet under the shared folder named by
``spark.checkpoint.dir``, so a lost executor costs a re-read and never a
recompute whose row placement could differ from the first run.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_TABLE_ROWS = 100_000
SMALL_TABLE_BYTES = 32 << 20
VALUE_BYTES = 16
FIXED_TYPES = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
SHARD, NULL_KEY_SHARDS = "__shard", 4096


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach; a local one is made only for local masters."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="featloom-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


_written: ContextVar[list[DataFrame] | None] = ContextVar("written", default=None)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and continue from the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    if (written := _written.get()) is not None:
        written.append(table)
    return table


@contextmanager
def tables_written() -> Iterator[list[DataFrame]]:
    """The tables that ``materialise`` writes in this thread within the block, for ``settle`` to let go."""
    written: list[DataFrame] = []
    token = _written.set(written)
    try:
        yield written
    finally:
        _written.reset(token)


def discard(table: DataFrame) -> None:
    """Remove the files of a table that ``materialise`` returned and nothing will read again."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().getName() != spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark)).getName():
            raise ValueError(f"{folder} is not a folder of {shared_dir(spark)}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settle(df: DataFrame, label: str, *used: DataFrame) -> DataFrame:
    """``materialise``, after which the written tables ``used`` and the shuffle files of ``df`` are let go.

    Spark removes shuffle files when the driver collects what refers to them, which may be never in a short job, so that is
    asked for here. Without it, the disk holds the shuffles of all steps at the same time.
    """
    written = materialise(df, label)
    for table in used:
        discard(table)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return written


def small_or_none(df: DataFrame, max_rows: int = SMALL_TABLE_ROWS) -> DataFrame | None:
    """``df`` as a driver-held table if it has at most ``max_rows`` rows, else None.

    The row count is checked on the collected rows themselves, so the caller
    may broadcast the result; None means the caller has to join by shuffle.
    """
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def _measured_bytes(df: DataFrame) -> Column:
    """Aggregate: bytes of the rows as values, not as files, where repeated text hardly counts."""
    long_values = [F.octet_length(F.col(f"`{f.name}`").cast("string")) for f in df.schema if not isinstance(f.dataType, FIXED_TYPES)]
    row = sum((F.coalesce(v, F.lit(0)).cast("long") for v in long_values), F.lit(VALUE_BYTES * len(df.columns)).cast("long"))
    return F.coalesce(F.sum(row), F.lit(0))


def lookup_join(
    df: DataFrame, lookup: DataFrame, on: list[str], max_rows: int = SMALL_TABLE_ROWS, max_bytes: int = SMALL_TABLE_BYTES
) -> DataFrame:
    """Left join to a table with unique ``on``: broadcast when it is proven small, in rows and in bytes.

    The lookup runs once, by all tasks: its rows and bytes are counted while it is written. A larger one is joined by shuffle, where
    adaptive execution splits the partitions of hot keys; rows with a null key, which match nothing, are dealt out by a hash of the row,
    so that they don't meet in one task.
    """
    size = Observation()
    # The shard is a written column, since a literal would be folded out of the keys the rows are dealt by.
    sharded = lookup.withColumn(SHARD, F.lit(0))
    written = materialise(sharded.observe(size, F.count(F.lit(1)).alias("rows"), _measured_bytes(lookup).alias("bytes")), "lookup")
    # An empty result may be written without running the observed step; nothing is small.
    measured = size.get
    if (measured.get("rows") or 0) <= max_rows and (measured.get("bytes") or 0) <= max_bytes:
        return df.join(F.broadcast(written.drop(SHARD)), on, "left")
    unmatched = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in on])
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(NULL_KEY_SHARDS)).cast("int") + 1
    keyed = df.withColumn(SHARD, F.when(unmatched, spread).otherwise(0))
    # The hint keeps the optimiser from broadcasting by the size of the files.
    return keyed.join(written.hint("merge"), [*on, SHARD], "left").drop(SHARD)
