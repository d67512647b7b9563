"""The corpus pipeline: language ID, line dedup, n-gram join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` writes each stage's result as Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm.blocks import free_name
from featloom.llm.decontaminate import contaminated, decontaminate, without_spans
from featloom.llm.language_id import UNDETERMINED, language_id
from featloom.llm.line_dedup import LEAST_WORDS, line_dedup
from featloom.llm.ngram_join import keep_one, ngram_join
from featloom.llm.packing import pack
from featloom.workspace import materialise

#: Documents whose language is less certain than this are rejected.
LEAST_LANGUAGE_SCORE = 0.3


def _with_text(found: DataFrame, docs: DataFrame, text) -> DataFrame:
    """``found`` with a new text in the columns of ``docs``; ``n_chars`` follows it where the table has that column."""
    changed = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return changed.select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter (also null and empty texts) or with too uncertain a language go.

    Rows without an id and repeated rows are judged like others. An empty table, or one without labels, leaves nothing.
    """
    name = free_name(docs.columns, "__language")
    named = language_id(docs, result_col=name)
    sure = (F.col(f"{name}.lang_pred") != UNDETERMINED) & (F.col(f"{name}.score") >= LEAST_LANGUAGE_SCORE)
    return named.where(sure).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the runs of lines, and passages of 50 words in whole lines, that stood earlier; a document of which no word is left goes.

    Null texts, texts without words and rows without an id stay as they are; rows with the same id are cut alike. An empty table stays empty.
    """
    name = free_name(docs.columns, "__lines")
    cut = line_dedup(docs, result_col=name, least_words=LEAST_WORDS)
    kept = cut.where(F.col(name).isNull() | (F.col(f"{name}.n_lines") == 0) | (F.col(f"{name}.n_removed") < F.col(f"{name}.n_lines")))
    return _with_text(kept, docs, F.col("text"))


def ngram_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (that of the smallest id) of each class of copies and near copies; every row of that id stays.

    Null texts, texts without words and rows without an id stay. An empty table stays empty.
    """
    return keep_one(docs, ngram_join(docs)).select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, without the spans that still overlap with the benchmark.

    Null and empty texts are not contaminated and stay; repeated rows are judged alike. An empty table stays empty.
    """
    name = free_name(docs.columns, "__overlap")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), result_col=name)
    return _with_text(found.where(~contaminated(name)), docs, without_spans(F.col("text"), F.col(f"{name}.spans")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in training windows; a null or empty text is one end token, repeated rows are packed each."""
    pieces = pack(docs)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("ngram_join", ngram_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]
#: Trained language scores and token ids are beyond SQL; the tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return docs
