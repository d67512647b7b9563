"""Parquet and CSV readers, feature-table reload, score and importance sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featloom.operators.clean import nan_columns_to_null

# Spellings of a missing value in CSV input.
NA_SPELLINGS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Typed CSV with a header row; every missing spelling and NaN becomes null.

    The header is checked against the schema. Values that do not parse give null.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    typed = [
        F.when(~F.col(f.name).isin(NA_SPELLINGS), F.col(f.name)).try_cast(f.dataType).alias(f.name)
        for f in schema
    ]
    return nan_columns_to_null(raw.select(*typed))


def first_rows(df: DataFrame, order_by: list[str], n: int | None) -> DataFrame:
    """Debug sample: the first ``n`` rows in key order, or all rows when ``n`` is None."""
    return df if n is None else df.orderBy(*order_by).limit(n)


def save_features(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_out_of_fold(scores: DataFrame, path: str, key: str, label: str, score: str) -> None:
    """key, TARGET, Prediction for labelled rows."""
    write_csv(scores.select(key, F.col(label).alias("TARGET"), F.col(score).alias("Prediction")), path)


def write_test_scores(scores: DataFrame, path: str, key: str, score: str) -> None:
    """key, TARGET=score for scoring rows."""
    write_csv(scores.select(key, F.col(score).alias("TARGET")), path)


def write_train_with_prediction(train: DataFrame, scores: DataFrame, path: str, key: str, score: str) -> None:
    """Every training column beside its out-of-fold score."""
    predictions = scores.select(key, F.col(score).alias("Prediction"))
    train.join(predictions, key, "left").write.mode("overwrite").parquet(path)


def write_importances(df: DataFrame, path: str) -> None:
    write_csv(df, path)


def fill_template(template: DataFrame, scores: DataFrame, key: str, score: str, digits: int | None = None) -> DataFrame:
    """Template keys with the score looked up by key."""
    value = F.round(score, digits) if digits is not None else F.col(score)
    return template.select(key).join(scores.select(key, value.alias("TARGET")), key, "left")


def submission_path(folder: str, best_score: float) -> str:
    return f"{folder}/submission_{round(best_score, 5)}.csv"
