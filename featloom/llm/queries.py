"""The registered queries: each operator over its whole table, with the columns of its contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm import sql
from featloom.llm.alignment import align, link_scores, pair_counts
from featloom.llm.conversation_trie import prefix_trie, share_heads, turn_sequences, with_end_digests
from featloom.llm.decontaminate import contaminated, decontaminate
from featloom.llm.language_id import held_out, language_id
from featloom.llm.license_scan import license_scan
from featloom.llm.line_dedup import LEAST_WORDS, line_dedup
from featloom.llm.line_quality import line_quality
from featloom.llm.ngram_join import ngram_join
from featloom.llm.packing import pack
from featloom.llm.substring_dedup import substring_dedup
from featloom.llm.token_counts import context_limits, length_histogram
from featloom.llm.token_file import read_documents, write_token_file
from featloom.llm.url_filter import url_filter
from featloom.workspace import materialise, scratch_path

#: The rules of the query: host, path, verdict.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    judged = line_quality(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *(F.col(f"quality.{n}").alias(n) for n in names))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = language_id(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    return named.select("doc_id", held_out().alias("held_out"), "language.lang_pred", "language.score")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"), least_words=LEAST_WORDS)
    return cut.select("doc_id", "lines.n_lines", "lines.n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    ends = lambda f: f("base_places").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        F.size("base_places").cast("long").alias("n_base"),
        ends(F.array_min).alias("first_word"),
        ends(F.array_max).alias("last_word"),
        F.concat_ws(",", "base").alias("base_labels"),
        F.concat_ws(",", "labels").alias("labels"),
        "score",
    )


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_limits(length_histogram(_table(spark, sf_dir, "documents")))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_of", "n_copies", "n_links")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(_table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "benchmark"))
    items = F.concat_ws(",", F.array_sort(F.transform("overlap.items", lambda i: i.cast("string"))))
    return found.select("doc_id", "overlap.n_words", "overlap.n_hit", F.size("overlap.items").cast("long").alias("n_items"), F.sha2(items, 256).alias("items_sha256"), contaminated().alias("contaminated"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter(_table(spark, sf_dir, "pages"), rules)


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequences = materialise(turn_sequences(_table(spark, sf_dir, "conversations")), "turns")
    conv = F.col("conv_id")
    rebuilt = share_heads(sequences, conv - conv % 100, (F.crc32(conv.cast("string")) % 6).cast("int"), 5)
    nodes = with_end_digests(prefix_trie(rebuilt))
    numbers = ("depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return nodes.select("conv_id", *(F.col(c).cast("long").alias(c) for c in numbers), "ends_sha256")


def op12_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-file")
    write_token_file(_table(spark, sf_dir, "documents"), path)
    rows = read_documents(spark, path)
    return rows.select(F.col("key").cast("long").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    aligned = materialise(align(_table(spark, sf_dir, "documents")), "aligned")
    scored = link_scores(aligned, pair_counts(aligned))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_line_quality, op3_language_id, op4_line_dedup, op5_license_scan, op6_token_counts, op7_ngram_join, op8_packing, op9_decontaminate, op10_url_filter, op11_conversation_trie, op12_token_file, op13_alignment)}
ORACLE_SQL = {
    "op1_substring_dedup": sql.SUBSTRING_DEDUP,
    "op2_line_quality": sql.LINE_QUALITY,
    "op4_line_dedup": sql.LINE_DEDUP,
    "op7_ngram_join": sql.NGRAM_JOIN,
    "op9_decontaminate": sql.DECONTAMINATE,
    "op10_url_filter": sql.URL_FILTER,
    "op11_conversation_trie": sql.CONVERSATION_TRIE,
}
