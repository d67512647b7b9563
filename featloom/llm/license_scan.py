"""License notices by a positional index of rare words, with DataFrame functions only.

The index has, for each word of the license templates that is not a filler, its
places in the templates and its rank among the template's words by the number of documents that
hold it. A file in which a template's key phrases stand looks up the template's rarest words first: an
occurrence at place i in the file and p in the template opens an alignment i - p, and all words of the template
are intersected with the file by their places in the open alignments only.

An alignment without any of the ``rare`` rarest words agrees in at most all others, so a best open alignment of
that many words is the best of all. A template that is not settled that way (a
notice cut short or reworded) has all its words looked up, so no alignment is lost.

Texts are read once; what moves after that are the files with the key phrases of a template.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featloom.workspace import materialise

WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: A template with more index words than this is found by its share of so many.
ASKED_OF = 8
LEAST_SCORE = 0.5
#: Words of a template, by document frequency, that open alignments.
RARE = 3
_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Phrases whose places are counted, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    keys: tuple[str, ...]


#: Notices of common licenses, in lower case without punctuation.
TEMPLATES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license", "version 2 0")),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("in compliance with the license",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use",)),
    Template("gpl", "this work is licensed under the gnu general public license version 3", ("gnu general public license",)),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license",)),
    Template("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("lesser general public license",)),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ("creative commons attribution",)),
)
#: Words too common to be looked up.
FILLERS = frozenset("the and to of is in a any or at it you may not this that with for are as by be can use under".split())


def _postings() -> dict[str, list[tuple[int, int]]]:
    index: dict[str, list[tuple[int, int]]] = {}
    for t, template in enumerate(TEMPLATES):
        for place, word in enumerate(template.text.split()):
            if word not in FILLERS:
                index.setdefault(word, []).append((t, place))
    return index


def _vocabulary() -> list[str]:
    return sorted(set(_postings()) | {w for phrase in BASE for w in phrase.split() if w not in FILLERS})


def _stands(padded: Column, phrase: str) -> Column:
    return F.contains(padded, F.lit(f" {phrase} "))


def _scanned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, n_words, license words in it, their places, base places, keys found."""
    vocabulary = F.array(*(F.lit(w) for w in _vocabulary()))
    words = docs.select(F.col(id_col).alias("id"), F.coalesce(F.regexp_extract_all(F.translate(F.col(text_col), _CAPITALS, _SMALL), F.lit(WORD), F.lit(0)), F.array().cast("array<string>")).alias("words"))
    own = words.select("id", "words", F.size("words").cast("long").alias("n_words"), F.array_intersect("words", vocabulary).alias("hits"))
    padded = own.withColumn("padded", F.when(F.size("hits") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))))
    places = F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains("hits", x["w"]))

    def starts(phrase: str) -> Column:
        parts = phrase.split()
        numbers = F.sequence(F.lit(0), F.size("words") - len(parts))
        here = lambda i: _all([F.get("words", i + k) == w for k, w in enumerate(parts)])
        return F.when(_stands(F.col("padded"), phrase), F.filter(numbers, here)).otherwise(F.array().cast("array<int>"))

    keys = [F.when(_all([_stands(F.col("padded"), k) for k in t.keys]), F.lit(i)) for i, t in enumerate(TEMPLATES)]
    base = [F.when(_stands(F.col("padded"), phrase), F.lit(label)) for phrase, label in BASE.items()]
    some = F.size("hits") > 0
    return padded.select(
        "id",
        "n_words",
        "hits",
        F.when(some, places).alias("places"),
        F.when(some, F.concat(*(starts(p) for p in BASE))).alias("base_places"),
        F.when(some, F.array_compact(F.array(*keys))).alias("keys"),
        F.when(some, F.array_compact(F.array(*base))).alias("base"),
    )


def _all(tests: list[Column]) -> Column:
    whole = tests[0]
    for test in tests[1:]:
        whole = whole & test
    return whole


def _ranked_postings(scanned: DataFrame) -> DataFrame:
    """The index: word, template, place, and the word's rank in the template, the one in the fewest documents first (of equals by the word)."""
    index = _postings()
    postings = scanned.sparkSession.createDataFrame([(w, t, p) for w, at in index.items() for t, p in at], "w string, t int, p int")
    frequency = scanned.select(F.explode("hits").alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    by_idf = Window.partitionBy("t").orderBy(F.coalesce("df", F.lit(0)), "w")
    return postings.join(frequency, "w", "left").select("w", "t", "p", F.dense_rank().over(by_idf).alias("rank"))


def _votes(files: DataFrame, postings: DataFrame) -> DataFrame:
    """One row for each place of an index word in a file and in a template whose key phrases it holds: row, t, shift, w.

    ``postings`` has at most the words of the templates, a fixed number.
    """
    looked = files.select("row", "keys", F.explode("places").alias("x")).select("row", "keys", F.col("x.w").alias("w"), F.col("x.i").alias("i"))
    return looked.join(F.broadcast(postings), "w").where(F.array_contains("keys", F.col("t"))).select("row", "t", (F.col("i") - F.col("p")).alias("shift"), "w")


def _best(votes: DataFrame) -> DataFrame:
    """The most different words of a template that agree on one alignment: row, t, n."""
    return votes.groupBy("row", "t", "shift").agg(F.count_distinct("w").alias("n")).groupBy("row", "t").agg(F.max("n").alias("n"))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", asked_of: int = ASKED_OF, least_score: float = LEAST_SCORE, rare: int = RARE) -> DataFrame:
    """One row per document: id, ``n_words``, ``base_places``, ``base`` and ``labels`` (sorted arrays), ``score``.

    Words are ASCII letters, digits and characters beyond ASCII, ASCII letters in lower case. ``base_places`` are the word numbers
    at which a base phrase starts, in rising order. A template is found if at least ``least_score`` of its index words (of ``asked_of`` words if it has
    more) vote for one alignment and its key phrases stand in the text; ``labels`` has those templates' labels and the base ones, ``score`` the best
    found template's share of all its index words (0 without one). A null or empty text has no words and no labels. Repeated rows are judged one
    by one; null ids are kept. Other columns are not read. An empty table gives no rows. ``rare`` decides how the work is done, not the result.
    """
    scanned = materialise(_scanned(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "scanned")
    files = scanned.where(F.size("keys") > 0)
    postings = materialise(_ranked_postings(scanned), "postings")
    sizes = [len({w for w in t.text.split() if w not in FILLERS}) for t in TEMPLATES]
    of = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("t") + 1)
    least = least_score * of([min(asked_of, n) for n in sizes])

    opened = _votes(files, postings.where(F.col("rank") <= rare)).select("row", "t", "shift").distinct()
    by_rare = _best(_votes(files, postings).join(opened, ["row", "t", "shift"], "left_semi"))
    settled = materialise(by_rare.where(F.col("n") >= F.greatest(least, of([n - rare for n in sizes]))), "settled")
    # At most as many as there are templates to a row.
    done = settled.groupBy("row").agg(F.collect_set("t").alias("done"))
    left = F.array_except("keys", F.coalesce("done", F.array().cast("array<int>")))
    open_files = files.select("row", "keys", "places").join(done, "row", "left").select("row", left.alias("keys"), "places").where(F.size("keys") > 0)
    best = settled.unionByName(_best(_votes(open_files, postings)).where(F.col("n") >= least))
    labelled = best.select("row", of([t.label for t in TEMPLATES]).alias("label"), (F.col("n") / of(sizes)).alias("score"))
    found = labelled.groupBy("row").agg(F.collect_list(F.struct("label", "score")).alias("found"))
    result = scanned.join(found, "row", "left")
    strings = lambda c: F.coalesce(F.col(c), F.array().cast("array<string>"))
    labels = F.coalesce(F.transform("found", lambda x: x["label"]), F.array().cast("array<string>"))
    score = F.coalesce(F.array_max(F.transform("found", lambda x: x["score"])), F.lit(0.0))
    return result.select(
        F.col("id").alias(id_col),
        "n_words",
        F.array_sort(F.coalesce("base_places", F.array().cast("array<int>"))).alias("base_places"),
        F.array_sort(F.array_distinct(strings("base"))).alias("base"),
        F.array_sort(F.array_distinct(F.concat(strings("base"), labels))).alias("labels"),
        score.alias("score"),
    )
