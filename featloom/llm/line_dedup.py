"""Removal of repeated runs of lines by winnowing, with DataFrame functions only.

A window is ``run`` consecutive lines with words (the whole text if it has fewer),
or a single line of at least ``long_line`` characters; with ``least_words`` also each shorter run
of that many words. The smallest line hash of a
window is its fingerprint, so equal windows always have equal fingerprints, and neighbouring windows
mostly share one. Fingerprints that stand at two places are joined back to the
positions; round them the match is extended to both sides by hashing the full windows that hold them. Every window
that has stood earlier, in the order of ids and lines, is deleted, so a
longer repeated run goes whole.

Texts are read for their line hashes and for the result; all steps between move hashes. Counts are
taken before rows are joined back, so a hot line is one row for each task in the aggregates and
is split by adaptive execution in the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks
from featloom.workspace import materialise

RUN = 3
LONG_LINE = 200
#: Words from which a repeated passage of any number of lines goes in the query and the pipeline.
LEAST_WORDS = 50
_BLANKS = " \t\n\x0b\f\r"
_WORD = "[^\\x20\\x09-\\x0D]+"


def _lines(text):
    return F.split(text, "\n", -1)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, least_words: int | None = None) -> DataFrame:
    """(id, lines): for each line with words its number, two hashes and its length; with ``least_words`` its words too."""
    words = lambda line: [F.regexp_count(line, F.lit(_WORD)).alias("words")] if least_words else []
    numbered = F.transform(
        _lines(F.col(text_col)),
        lambda line, i: F.struct(
            i.alias("at"), F.xxhash64(line).alias("h"), F.xxhash64(F.lit(1), line).alias("g"), F.length(line).alias("size"), (F.length(F.btrim(line, F.lit(_BLANKS))) > 0).alias("some"), *words(line)
        ),
    )
    return docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.filter(numbered, lambda x: x["some"]).alias("lines"))


def windows(lines: DataFrame, run: int, long_line: int, least_words: int | None = None) -> DataFrame:
    """(id, at, lines, fingerprint, key_a, key_b): one row for each window.

    With ``least_words`` every run of fewer than ``run`` lines that has so many words is a window too. Longer runs need
    none: each of their lines stands in a window of ``run`` lines inside them.
    """

    def of(n: int):
        starts = F.sequence(F.lit(1), F.greatest(F.size("lines") - F.lit(n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.slice("lines", i, F.lit(n)))

    def wordy(n: int):
        return F.filter(of(n), lambda w: (F.size(w) == n) & (F.aggregate(w, F.lit(0), lambda total, x: total + x["words"]) >= least_words))

    long = lambda x: (x["size"] >= long_line) | (x["words"] >= least_words) if least_words else x["size"] >= long_line
    singles = F.transform(F.filter("lines", long), lambda x: F.array(x))
    short = [wordy(n) for n in range(2, run)] if least_words else []
    rows = lines.where(F.size("lines") > 0).select("id", F.explode(F.concat(of(run), singles, *short)).alias("w"))
    each = lambda field: F.transform("w", lambda x: x[field])
    return rows.select(
        "id",
        F.col("w")[0]["at"].alias("at"),
        each("at").alias("lines"),
        F.array_min(each("h")).alias("fingerprint"),
        F.xxhash64(each("h")).alias("key_a"),
        F.xxhash64(each("g")).alias("key_b"),
    )


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run: int = RUN, long_line: int = LONG_LINE, least_words: int | None = None) -> DataFrame:
    """(id, gone): for each text with repeated runs the numbers of the lines to delete."""
    found = materialise(windows(line_hashes(docs, id_col, text_col, least_words), run, long_line, least_words), "windows")
    ends = found.groupBy("fingerprint").agg(F.min("id").alias("i0"), F.max("id").alias("i1"), F.min("at").alias("a0"), F.max("at").alias("a1"))
    shared = materialise(ends.where("i0 < i1 or a0 < a1").select("fingerprint"), "fingerprints")
    near = materialise(found.join(shared, "fingerprint").drop("fingerprint"), "near")
    first_id = near.groupBy("key_a", "key_b").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("n")
    first_id = materialise(first_id, "first-id")
    joined = near.join(first_id, ["key_a", "key_b"])
    # Windows of the first document itself are later ones from their second place on.
    own = joined.where(F.col("id") == F.col("first_id"))
    first_at = own.groupBy("key_a", "key_b", "id").agg(F.min("at").alias("first_at"), F.max("at").alias("last_at")).where("first_at < last_at").drop("last_at")
    again = own.join(first_at, ["key_a", "key_b", "id"]).where(F.col("at") > F.col("first_at"))
    later = joined.where(F.col("id") > F.col("first_id")).select("id", "lines").union(again.select("id", "lines"))
    return later.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("lines"))).alias("gone"))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", result_col: str = "lines", run: int = RUN, long_line: int = LONG_LINE, least_words: int | None = None
) -> DataFrame:
    """``docs`` with repeated runs deleted from ``text_col`` and a struct ``result_col`` (``n_lines``, ``n_removed``).

    Of each run of ``run`` or more lines with words (or single line of ``long_line`` characters or more) the first occurrence stays, in the
    order of ids and lines. With ``least_words`` that holds for every run of lines of that many words in all, of any number of
    lines and any length; words are parted by ASCII blanks. A run repeated at once in one text shrinks to its first line. Lines are compared as they stand and judged on the input.
    Blank lines are neither compared nor deleted. Lines are parted by \\n; the kept ones are joined by it again.
    A null text stays null, with null counts; an empty one has no lines with words, so ``n_lines`` 0. Rows without an id are not compared.
    Rows with the same id are judged alike, never against each other at the same place. Other columns pass
    unchanged; a column named ``result_col`` is replaced. The counts are of lines with words.
    """
    own, lost = blocks.free_name(docs.columns, "__id"), blocks.free_name(docs.columns, "__gone")
    gone = repeated_lines(docs, id_col, text_col, run, long_line, least_words).withColumnsRenamed({"id": own, "gone": lost})
    joined = docs.join(gone, docs[id_col].cast("long") == F.col(own), "left").drop(own)
    lines = _lines(F.col(text_col))
    some = F.size(F.filter(lines, lambda x: F.length(F.btrim(x, F.lit(_BLANKS))) > 0))
    numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(lost))
    kept = F.array_join(F.transform(numbers, lambda i: F.get(lines, i)), "\n")
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(kept)
    counts = F.when(F.col(text_col).isNotNull(), F.struct(some.cast("long").alias("n_lines"), F.coalesce(F.size(lost), F.lit(0)).cast("long").alias("n_removed")))
    return joined.withColumns({result_col: counts, text_col: text}).drop(lost)
