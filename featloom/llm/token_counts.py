"""Token totals for every context limit from an exact histogram of document lengths.

Texts are encoded once; only their lengths leave the task, and equal lengths are
added up before the shuffle. Everything else is computed from the histogram,
which has one row for each length that occurs. Suffix sums are taken in two
levels (blocks of lengths, then lengths in a block), so no single task sorts the histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featloom.llm import blocks, tokens
from featloom.workspace import materialise

#: Lengths in a block of the two-level sums.
BLOCK = 1024


def length_histogram(docs: DataFrame, text_col: str = "text", vocabulary: str | None = None) -> DataFrame:
    """(``n_tokens``, ``n_docs``): how many documents have each encoded length; null counts as empty, length 0."""
    path = vocabulary or tokens.vocabulary_path()

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.encoder(path)
        for batch in batches:
            sizes = [len(coder.ids(c.text(r).decode())) for c in blocks.chunks(batch.column(0)) for r in range(c.rows)]
            n_tokens, n_docs = np.unique(np.array(sizes, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(n_tokens), pa.array(n_docs.astype(np.int64))], names=["n_tokens", "n_docs"])

    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(lengths, "n_tokens long, n_docs long")
    return counted.groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """For every occurring length L as a context limit, what a limit of L keeps.

    Columns: ``n_tokens`` (L), ``n_docs`` of that length, ``docs_over`` (longer documents), ``tokens_total`` (tokens
    of the documents of at most L tokens), ``tokens_truncated`` (all documents cut to L tokens), ``tokens_lost`` by the cut, ``share_docs``
    (documents of at most L tokens by all; L is the quantile of that rank). A limit between two occurring lengths l < L
    keeps ``tokens_truncated`` of l plus (limit - l) * ``docs_over`` of l. An empty table gives no rows.
    """
    cells = materialise(histogram.select("n_tokens", "n_docs"), "histogram").withColumn("block", F.floor(F.col("n_tokens") / BLOCK))
    sums = cells.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sum_of = lambda x, frame: F.coalesce(F.sum(x).over(frame), F.lit(0))
    later = sums.select(
        "block",
        *(sum_of(x, after).alias(f"{x}_later") for x in "dt"),
        *(sum_of(x, whole).alias(f"{x}_all") for x in "dt"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = lambda x, base: F.coalesce(F.sum(x).over(inside), F.lit(0)) + F.col(base)
    return (
        cells.join(F.broadcast(later), "block")  # one row for each 1024 lengths
        .select(
            "n_tokens",
            "n_docs",
            "d_all",
            "t_all",
            over(F.col("n_docs"), "d_later").alias("docs_over"),
            over(F.col("n_docs") * F.col("n_tokens"), "t_later").alias("t_over"),
        )
        .select(
            "n_tokens",
            "n_docs",
            "docs_over",
            (F.col("t_all") - F.col("t_over")).alias("tokens_total"),
            (F.col("t_all") - F.col("t_over") + F.col("docs_over") * F.col("n_tokens")).alias("tokens_truncated"),
            (F.col("t_over") - F.col("docs_over") * F.col("n_tokens")).alias("tokens_lost"),
            ((F.col("d_all") - F.col("docs_over")) / F.col("d_all")).alias("share_docs"),
        )
    )


def at_limits(limits: DataFrame, contexts: DataFrame, limit_col: str = "context") -> DataFrame:
    """What each of the stated contexts keeps: totals at the largest occurring length that is not above it.

    ``contexts`` is a short table of limits, answered in place among the lengths. A context below every length keeps
    (context * documents) tokens; a null or negative context is dropped.
    """
    # The stated limits become rows of the histogram without documents; a running total in
    # blocks of lengths, as above, then answers them in place.
    asked = contexts.where(F.col(limit_col) >= 0).select(F.col(limit_col).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("n_docs")).distinct()
    cells = limits.select("n_tokens", "n_docs").unionByName(asked).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    return context_limits(cells).join(asked.select("n_tokens"), "n_tokens", "left_semi").withColumnRenamed("n_tokens", limit_col)
