"""Connected components of a link table, by contraction."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.workspace import materialise

#: Most links (each in both directions) that one task joins up.
FEW_LINKS = 1 << 14


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(``root``, ``to``): every end of the links of one task and the smallest end reachable from it."""
    up: dict[int, int] = {}

    def top(node: int) -> int:
        while (above := up.setdefault(node, node)) != node:
            up[node] = node = up.setdefault(above, above)
        return node

    for batch in batches:
        for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = top(x), top(y)
            up[max(x, y)] = min(x, y)
    ends = list(up)
    yield pa.RecordBatch.from_arrays([pa.array(ends, pa.int64()), pa.array([top(n) for n in ends], pa.int64())], names=["root", "to"])


def components(links: DataFrame, a: str = "a", b: str = "b", few: int = FEW_LINKS) -> DataFrame:
    """(``id``, ``component``): the smallest id reachable from each linked id.

    Every round sends each node to the neighbour of least hash (or keeps it) and
    links the remaining nodes anew; falling chains of hashes are short whatever the shape of the
    graph, so the link table shrinks fast. The last ``few`` links, for which rounds over all executors would
    take longer than the work, are joined up in one task. Each round is written, and only its row count reaches
    the driver. Null ends and links of a node to itself are left out.
    """
    ends = links.select(F.col(a).cast("long").alias("x"), F.col(b).cast("long").alias("y")).where("x is not null and y is not null and x <> y")
    edges = materialise(ends.union(ends.select("y", "x")).distinct(), "links")
    nodes = edges.select(F.col("x").alias("id")).distinct().withColumn("root", F.col("id"))
    salt = 0
    while edges.count() > few:
        order = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(salt)).alias("h"), F.col(c).alias("n"))
        to = edges.groupBy("x").agg(F.min(order("y")).alias("least")).select("x", F.least(F.col("least"), order("x"))["n"].alias("to"))
        to = materialise(to, "contract")
        nodes = nodes.join(to.withColumnRenamed("x", "root"), "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        nodes = materialise(nodes, "roots")
        left = edges.join(to, "x").select(F.col("to").alias("x"), "y")
        right = left.join(to.select(F.col("x").alias("y"), F.col("to").alias("ty")), "y").select("x", F.col("ty").alias("y"))
        edges = materialise(right.where("x <> y").distinct(), "links")
        salt += 1
    last = edges.coalesce(1).mapInArrow(_joined_up, "root long, to long")
    nodes = materialise(nodes.join(last, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "roots")
    least = materialise(nodes.groupBy("root").agg(F.min("id").alias("component")), "least")
    return nodes.join(least, "root").select("id", "component")
