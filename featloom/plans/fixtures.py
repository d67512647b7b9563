"""Stand-ins for the applicant tables, derived from the given tables in Spark and in SQL.

The given tables hold no nulls, so missing values are made by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.sources.tables import table

TEXT_FEATURES = ["n_chars", "n_spaces", "n_lines", "n_stops", "space_share", "is_long"]


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with text measures; quality and toxic are null when unlabelled."""
    text = F.col("text")

    def count_of(mark: str):
        return (F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))).cast("bigint")

    docs = table(spark, folder, "documents").select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        count_of(" ").alias("n_spaces"),
        count_of("\n").alias("n_lines"),
        count_of(".").alias("n_stops"),
        F.try_divide(count_of(" ").cast("double"), F.length(text).cast("double")).alias("space_share"),
        (F.col("n_chars") > 1000).cast("int").alias("is_long"),
    )
    return docs.join(table(spark, folder, "labels"), "doc_id", "left")


DOCS_SQL = """docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars,
    length(text) - length(replace(text, ' ', '')) AS n_spaces,
    length(text) - length(replace(text, chr(10), '')) AS n_lines,
    length(text) - length(replace(text, '.', '')) AS n_stops,
    (length(text) - length(replace(text, ' ', '')))::DOUBLE / nullif(length(text), 0) AS space_share,
    CASE WHEN d.n_chars > 1000 THEN 1 ELSE 0 END AS is_long,
    l.quality, l.toxic
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""


LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def gapped_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with missing quantity, price, discount and tax on fixed rows."""
    lines = table(spark, folder, "lineitem")
    gap = lambda c, m, r: F.when(F.pmod(F.col("l_partkey"), F.lit(m)) != r, F.col(c)).alias(c)
    return lines.select(
        *LINE_ID,
        "l_shipdate",
        "l_returnflag",
        "l_linestatus",
        gap("l_quantity", 3, 0),
        gap("l_extendedprice", 5, 1),
        gap("l_discount", 2, 0),
        gap("l_tax", 7, 2),
    )


GAPPED_SQL = """gapped AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus,
    CASE WHEN l_partkey % 3 <> 0 THEN l_quantity END AS l_quantity,
    CASE WHEN l_partkey % 5 <> 1 THEN l_extendedprice END AS l_extendedprice,
    CASE WHEN l_partkey % 2 <> 0 THEN l_discount END AS l_discount,
    CASE WHEN l_partkey % 7 <> 2 THEN l_tax END AS l_tax
  FROM lineitem)"""


def fold_scores(spark: SparkSession, folder: str, folds: int = 5) -> DataFrame:
    """Stacked (doc_id, label, fold, part, score) table from a fixed score formula per fold."""
    from featloom.operators.folds import kfold

    docs = kfold(labelled_documents(spark, folder), "doc_id", folds, 7, "own_fold")
    per_fold = docs.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    part = (
        F.when(F.col("quality").isNull(), "test")
        .when(F.col("own_fold") == F.col("fold"), "valid")
        .otherwise("train")
    )
    score = F.col("n_chars") / (F.col("n_chars") + 1500.0 + 300.0 * F.col("fold"))
    return per_fold.select(
        "doc_id", F.col("quality").alias("label"), "fold", part.alias("part"), score.alias("score"), "own_fold"
    )


FOLD_SCORES_SQL = (
    DOCS_SQL
    + """, scores AS (
  SELECT doc_id, quality AS label, f.fold::INTEGER AS fold,
    CASE WHEN quality IS NULL THEN 'test'
         WHEN ('0x' || substr(md5(CAST(doc_id AS VARCHAR) || ':7'), 1, 8))::BIGINT % 5 = f.fold
         THEN 'valid' ELSE 'train' END AS part,
    n_chars / (n_chars + 1500.0::DOUBLE + 300.0::DOUBLE * f.fold) AS score
  FROM docs, range(5) AS f(fold))"""
)
