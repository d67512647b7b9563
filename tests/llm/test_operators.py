"""Edge cases of every operator: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from featloom.llm.decontaminate import contaminated, decontaminate, without_spans
from featloom.llm.graph import components
from featloom.llm.language_id import Training, fit, language_id, predict
from featloom.llm.license_scan import BASE, FILLERS, TEMPLATES, license_scan
from featloom.llm.line_dedup import line_dedup
from featloom.llm.line_quality import line_quality
from featloom.llm.ngram_join import keep_one, ngram_join
from featloom.llm.packing import pack
from featloom.llm.substring_dedup import substring_dedup
from featloom.llm.token_counts import at_limits, context_limits, length_histogram
from featloom.llm.url_filter import url_filter

DOCS = "doc_id long, text string, lang string, part int, n_words long, id string, row long, class_id long, size long"


def _words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(100000)}" for _ in range(n)]


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, 2, "x", 3, 4, 5) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    base = _words(200, 1)
    near = base[:]
    near[150] = "changed"
    rows = [
        (1, " ".join(base), "en"),
        (2, " ".join(near), "en"),
        (3, " ".join(base), None),
        (3, " ".join(base), None),
        (4, None, "en"),
        (5, "", "de"),
        (6, " \n\t ", None),
        (None, " ".join(base), "en"),
        (None, None, None),
        (7, "word", "en"),
        (8, "x" * 200_000, "en"),
        (9, " ".join(_words(60_000, 2)), "de"),
        (10, "!!! ???", "en"),
    ]
    return _docs(spark, rows)


def _by_id(df, key="doc_id"):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, str(r)))


def test_substring_dedup_edges(spark, odd):
    rows = _by_id(substring_dedup(odd).drop("kept_text"))
    assert [r for r in rows if r[0] in (1, 3, 4, 5, 6, 7, 8, 9, 10)] == [
        (1, 200, 0), (3, 200, 200), (3, 200, 200), (4, 0, 0), (5, 0, 0), (6, 0, 0), (7, 1, 0), (8, 1, 0), (9, 60_000, 0), (10, 2, 0)
    ]
    assert (2, 200, 150) in rows and [r for r in rows if r[0] is None] == [(None, 0, 0), (None, 200, 0)]
    assert substring_dedup(odd.limit(0)).count() == 0


def test_substring_dedup_matches_brute_force(spark):
    rng = random.Random(5)
    passage = [_words(rng.randrange(45, 70), s) for s in range(6)]
    texts = []
    for i in range(60):
        words = _words(rng.randrange(0, 90), 100 + i)
        for _ in range(rng.randrange(0, 3)):
            at = rng.randrange(len(words) + 1)
            p = rng.choice(passage)
            words[at:at] = p[rng.randrange(0, 6) :]
        texts.append(words)
    first = {}
    for i, w in enumerate(texts):
        for k in range(len(w) - 49):
            first.setdefault(tuple(w[k : k + 50]), i)
    want = []
    for i, w in enumerate(texts):
        gone = {p for k in range(len(w) - 49) if first[tuple(w[k : k + 50])] < i for p in range(k, k + 50)}
        want.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    docs = _docs(spark, [(i, " \n".join(w), None) for i, w in enumerate(texts)]).repartition(5)
    assert _by_id(substring_dedup(docs)) == want and any(r[2] for r in want)
    assert _by_id(substring_dedup(docs, parts=3)) == want


def test_line_quality_edges(spark, odd):
    rows = {(r["doc_id"]): r["quality"] for r in line_quality(odd).collect() if r["doc_id"] is not None}
    assert rows[4]["n_words"] == 0 and rows[4]["base_failed"] and not rows[4]["kept"] and rows[4]["clean_text"] == ""
    assert rows[1]["kept"] and not rows[1]["base_failed"] and line_quality(odd.limit(0)).count() == 0
    assert "part" in line_quality(odd).columns


def test_line_quality_rules(spark):
    good = "This is a line of plain words that ends as it should.\n" * 1
    body = "".join(f"Line {i} holds the words {' '.join(_words(10, i))} and ends.\n" for i in range(10))
    text = body + "home | news | about\n" + "short end\n" + "SHOUTED WORDS IN THIS LINE.\n" + good + "a$$ b%% c&&.\nPlease accept our Cookie Policy now.\n\n" + good
    r = line_quality(_docs(spark, [(1, text, None), (2, "a | b\n" * 40 + "The end of it.", None)])).orderBy("doc_id").collect()
    q = r[0]["quality"]
    assert q["n_failed_lines"] == 5 and q["n_dup_lines"] == 1 and q["kept"] and q["clean_text"] == body + good + "\n" + good
    assert not r[1]["quality"]["kept"] and r[1]["quality"]["clean_text"] == "The end of it."


def test_line_quality_keeps_prose_of_other_scripts_and_about_software(spark):
    chinese = "\n".join("\u8fd9\u662f \u4e00\u884c \u666e\u901a\u7684\u6587\u5b57\u3002" + chr(0x4E00 + i) + "\u3002" for i in range(40))
    quoted = "\n".join(f"\u201cSaid {w} \u201d" if i % 2 else f"He said {w}\u2026" for i, w in enumerate(_words(40, 3)))
    software = "\n".join(f"The module number {i} was written in JavaScript by {' '.join(_words(25, i))} of the team." for i in range(20))
    headings = "\n".join(f"\u6587\u5b57\u6587\u5b57\u6587\u5b57\u6587\u5b57\u6587\u5b57{i}" for i in range(60))
    rows = [(1, chinese, None), (2, quoted, None), (3, software, None), (4, headings, None)]
    for r in line_quality(_docs(spark, rows)).collect():
        assert r["quality"]["kept"] and r["quality"]["n_failed_lines"] == 0, r["doc_id"]


@pytest.mark.parametrize(
    "line",
    [
        "Home \u00bb News \u203a Sport \u2022 Weather of the day.",
        "https://a.example/x www.b.example HTTP://c.example and more text.",
        "Please enable JavaScript to see all of the many pages that are shown here.",
        "You can log in now.",
        "See our privacy policy.",
        "\u6587\u5b57 short",
    ],
)
def test_line_quality_removes(spark, line):
    body = "".join(f"Line {i} holds the words {' '.join(_words(10, i))} and ends.\n" for i in range(10))
    q = line_quality(_docs(spark, [(1, f"{body}{line}\n{body}x", None), (2, f"{line}", None)])).orderBy("doc_id").collect()
    assert line not in q[0]["quality"]["clean_text"] and q[0]["quality"]["n_failed_lines"] == 2 and q[1]["quality"]["clean_text"] == ""


def test_line_quality_keeps_words_that_hold_a_phrase(spark):
    lines = "The blog in question.\nAssign in order, please.\nWe log in every morning and read what the others have written."
    assert line_quality(_docs(spark, [(1, lines, None)])).first()["quality"]["n_failed_lines"] == 0


def test_language_id_edges(spark, odd):
    rows = {r["doc_id"]: r["language"] for r in language_id(odd).collect() if r["doc_id"] is not None}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (4, 5, 6, 10))
    assert rows[9]["lang_pred"] in ("en", "de") and 0 <= rows[9]["score"] <= 1
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {r["language"]["lang_pred"] for r in language_id(unlabelled).collect()} == {"und"}
    assert language_id(odd.limit(0)).count() == 0


def test_language_training_draws_from_whole_texts(spark):
    # What tells the languages apart stands in the middle of long texts alone.
    filler = "0123 4567 " * 400
    rows = [(k, f"{filler}{w * 60}{filler}", lang) for k in range(60) for w, lang in (("the house and garden ", "en"), ("das haus und der garten ", "de"))]
    net = fit(_docs(spark, rows), settings=Training(rows=200, epochs=4))
    got = _docs(spark, [(1, "the garden and the house", None), (2, "der garten und das haus", None)]).select("doc_id", predict(net).alias("p")).collect()
    assert {r["doc_id"]: r["p"]["lang_pred"] for r in got} == {1: "en", 2: "de"}


def test_language_training_does_not_prefer_rows_without_an_id(spark):
    rows = [(None, f"the house and the garden {k}", "en") for k in range(300)] + [(k, f"das haus und der garten {k}", "de") for k in range(300)]
    net = fit(_docs(spark, rows), settings=Training(rows=100, epochs=1))
    assert list(net.labels) == ["de", "en"]


def test_line_dedup_edges(spark):
    run = "one line\nanother line\na third line"
    long = "a long line " * 30
    rows = [(1, f"start\n{run}\n\nend", None), (2, f"other\n{run}\nmore", None), (3, f"{long}\nx", None), (4, f"y\n{long}", None), (5, None, None), (6, "", None), (7, "\n \n", None), (8, "same\n" * 9, None), (9, "one line\nanother line", None), (10, "tiny", None), (11, "tiny", None), (None, run, None), (12, run, None), (12, run, None)]
    got = line_dedup(_docs(spark, rows))
    text = {r["doc_id"]: r["text"] for r in got.collect() if r["doc_id"] is not None}
    assert text[1] == f"start\n{run}\n\nend" and text[2] == "other\nmore" and text[3] == f"{long}\nx" and text[4] == "y"
    assert text[5] is None and text[6] == "" and text[7] == "\n \n" and text[8] == "same\n" and text[9] == "one line\nanother line"
    assert text[10] == "tiny" and text[11] == "" and text[12] == ""
    counts = {(r["doc_id"], r["lines"] and tuple(r["lines"])) for r in got.collect()}
    assert {(2, (5, 3)), (5, None), (6, (0, 0)), (7, (0, 0)), (None, (3, 0))} <= counts
    assert got.count() == len(rows) and line_dedup(_docs(spark, rows).limit(0)).count() == 0


def test_line_dedup_takes_short_runs_of_many_words(spark):
    few = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(20))
    less = " ".join(f"c{i}" for i in range(30)), " ".join(f"d{i}" for i in range(19))
    one = " ".join("ef"[i % 2] for i in range(60))
    assert max(map(len, (*few, *less, one))) < 200
    rows = [(k, "\n".join([f"start {k}", *few, f"next {k}", *less, f"then {k}", one, f"end {k}"]), None) for k in (1, 2)]
    rows += [(3, f"x\n{few[0]}\ny\n{few[1]}\nz", None), (4, one, None), (5, None, None), (6, "\n".join(few), None)]
    got = {r["doc_id"]: r for r in line_dedup(_docs(spark, rows), least_words=50).collect()}
    text = {k: r["text"] for k, r in got.items()}
    assert text[1] == rows[0][1] and text[3] == rows[2][1] and text[5] is None
    assert text[2] == "\n".join(["start 2", "next 2", *less, "then 2", "end 2"]) and tuple(got[2]["lines"]) == (9, 3)
    assert text[4] == "" and text[6] == ""


def test_license_scan_cases(spark, odd):
    rows = [
        (1, "Licensed under the Apache License, Version 2.0.", None),
        (2, "text CC-BY here; All rights reserved. cc by", None),
        (3, "This work is licensed under the GNU General Public License, version 3.", None),
        (4, "apache helicopters have a version of nothing", None),
        (5, "cc\u00e9 by ccby General Public Licenses", None),
        (6, None, None),
        (None, "Released under the MIT License.", None),
        (7, "Licensed under CC BY-NC 4.0.", None),
    ]
    got = {r["doc_id"]: r for r in license_scan(_docs(spark, rows)).collect()}
    assert got[1]["labels"] == ["apache-2.0"] and got[1]["base"] == [] and got[1]["score"] == 1.0
    assert got[2]["base"] == ["cc-by", "reserved"] and got[2]["base_places"] == [1, 4, 7] and got[2]["n_words"] == 9
    assert got[3]["labels"] == ["gpl"] and got[3]["base_places"] == [7]
    assert got[4]["labels"] == [] and got[5]["base_places"] == [] and got[6]["n_words"] == 0
    assert got[None]["labels"] == ["mit"] and got[7]["labels"] == ["cc-by", "cc-by-nc"]
    assert license_scan(odd).count() == odd.count() and license_scan(odd.limit(0)).count() == 0


def test_license_scan_finds_a_notice_among_rarer_words(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."
    prose = "granted charge person binary foundation compliance redistribution obtaining forms conditions"
    rows = [(1, f"{apache} {mit}", None), (2, f"{prose}. {apache}", None), (3, "Permission is hereby granted, free of charge.", None)]
    rows += [(10 + k, apache, None) for k in range(20)]  # so the words of the first notice are the common ones
    got = {r["doc_id"]: r for r in license_scan(_docs(spark, rows)).collect()}
    assert got[1]["labels"] == ["apache-2.0", "mit"] and got[1]["score"] == 1.0
    assert got[2]["labels"] == ["apache-2.0"] and got[2]["score"] == 1.0
    assert got[3]["labels"] == ["mit"] and got[3]["score"] == 5 / 12


def _best_templates(words):
    """Labels and score by trying every alignment of every template whose key phrases stand in the words."""
    padded, labels, score = f" {' '.join(words)} ", {label for phrase, label in BASE.items() if f" {phrase} " in f" {' '.join(words)} "}, 0.0
    for t in TEMPLATES:
        if not all(f" {k} " in padded for k in t.keys):
            continue
        own = t.text.split()
        index = {w for w in own if w not in FILLERS}
        most = max(len({w for p, w in enumerate(own) if w in index and 0 <= p + s < len(words) and words[p + s] == w}) for s in range(-len(own), len(words)))
        if most >= 0.5 * min(8, len(index)):
            labels.add(t.label)
            score = max(score, most / len(index))
    return sorted(labels), score


@pytest.mark.parametrize("rare", [1, 3, 50])
def test_license_labels_match_brute_force(spark, rare):
    rng, rows = random.Random(4), []
    for i in range(400):
        t = rng.choice(TEMPLATES).text.split()
        kind = i % 5
        if kind == 1:  # cut short
            low = rng.randrange(len(t))
            t = t[low : low + rng.randrange(2, len(t) + 1)]
        elif kind == 2:  # reworded
            t = [w if rng.random() < 0.7 else rng.choice(_words(3, i)) for w in t]
        elif kind == 3:  # two notices, and words of others between them
            t = t[: rng.randrange(3, len(t) + 1)] + rng.choice(TEMPLATES).text.split()[::-1] + rng.choice(TEMPLATES).text.split()
        rows.append((i, " ".join(_words(rng.randrange(20), i) + t + _words(5, i + 1)), None))
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(_docs(spark, rows), rare=rare).collect()}
    assert got == {i: _best_templates(text.split()) for i, text, _ in rows}


def test_license_labels_of_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(docs).collect()}
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        assert got[r["doc_id"]] == _best_templates(words)


def test_license_scan_lowers_ascii_only(spark):
    r = license_scan(_docs(spark, [(1, "\u212aEY \u00c9T\u00c9 CC by", None)])).first()
    assert r["n_words"] == 4 and r["base_places"] == [2]
    # The Kelvin sign lowers to k in Unicode, which would make the license's word of it.
    r = license_scan(_docs(spark, [(1, "licensed under gnu general public licen\u017fe", None)])).first()
    assert r["base_places"] == []


def test_license_base_places_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    phrases = [p.split() for p in ("cc by", "general public license", "all rights reserved")]
    got = {r["doc_id"]: (r["n_words"], list(r["base_places"])) for r in license_scan(docs).collect()}
    for r in docs.collect():
        words = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        want = sorted(i for p in phrases for i in range(len(words)) if words[i : i + len(p)] == p)
        assert got[r["doc_id"]] == (len(words), want)


def test_token_counts(spark, odd):
    histogram = length_histogram(odd)
    sizes = sorted(r["n_tokens"] for r in histogram.collect() for _ in range(r["n_docs"]))
    assert len(sizes) == odd.count() and sizes.count(0) == 3
    for r in context_limits(histogram).collect():
        n = r["n_tokens"]
        assert r["docs_over"] == sum(s > n for s in sizes) and r["tokens_total"] == sum(s for s in sizes if s <= n)
        assert r["tokens_truncated"] == sum(min(s, n) for s in sizes) and r["tokens_lost"] == sum(max(s - n, 0) for s in sizes)
        assert r["share_docs"] == sum(s <= n for s in sizes) / len(sizes)
    asked = spark.createDataFrame([(1,), (100,), (10**9,), (None,), (-1,)], "context long")
    answered = {r["context"]: r["tokens_truncated"] for r in at_limits(histogram, asked).collect()}
    assert answered == {c: sum(min(s, c) for s in sizes) for c in (1, 100, 10**9)}
    assert context_limits(length_histogram(odd.limit(0))).count() == 0


def test_ngram_join_edges(spark, odd):
    rows = {(r["doc_id"], r["class_id"], r["copy_of"], r["n_copies"], r["n_links"]) for r in ngram_join(odd).collect()}
    assert {(1, 1, 1, 3, 1), (2, 1, 2, 1, 1), (3, 1, 1, 3, 1), (4, 4, 4, 1, 0), (5, 5, 5, 1, 0), (6, 6, 6, 1, 0), (7, 7, 7, 1, 0), (None, None, None, 1, 0)} <= rows
    kept = keep_one(odd, ngram_join(odd))
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 4, 5, 6, 7, 8, 9, 10] and kept.columns == odd.columns
    assert ngram_join(odd.limit(0)).count() == 0


def test_ngram_join_loses_no_text_of_a_repeated_id(spark):
    x, y, z = (_words(80, seed) for seed in (31, 32, 33))
    near = y[:]
    near[40] = "changed"
    rows = [(1, x), (2, x), (2, y), (3, y), (4, z), (5, near), (2, z)]
    docs = _docs(spark, [(i, " ".join(w), None) for i, w in rows])
    got = sorted(tuple(r) for r in ngram_join(docs).select("doc_id", "class_id", "copy_of", "n_copies", "n_links").collect())
    assert got == [(1, 1, 1, 2, 0), (2, 1, 1, 2, 0), (2, 2, 2, 2, 0), (2, 2, 2, 2, 1), (3, 2, 2, 2, 1), (4, 2, 2, 2, 0), (5, 2, 5, 1, 1)]
    kept = keep_one(docs, ngram_join(docs))
    assert {" ".join(w) for w in (x, y, z)} <= {r["text"] for r in kept.collect()} and {r["doc_id"] for r in kept.collect()} == {1, 2}


def test_ngram_join_holds_a_large_group_together(spark):
    base = _words(300, 9)
    rows = []
    for i in range(400):
        own = base[:]
        own[(7 * i) % 300] = f"edit{i}"
        rows.append((i, " ".join(own), None))
    rows += [(1000 + i, " ".join(_words(300, 50 + i)), None) for i in range(40)]
    got = {r["doc_id"]: r for r in ngram_join(_docs(spark, rows)).collect()}
    assert {got[i]["class_id"] for i in range(400)} == {0} and all(got[i]["n_links"] == 399 for i in range(400))
    assert all(got[1000 + i]["class_id"] == 1000 + i for i in range(40))


def test_ngram_join_finds_pairs_among_many_that_are_only_akin(spark):
    base, rows = _words(300, 3), []
    for i in range(150):  # some two thirds of the n-grams in common with every other text
        own = base[:]
        for k in range(10):
            own[(29 * k + 11 * i) % 300] = f"own{i}x{k}"
        rows.append((i, " ".join(own), None))
        if i % 5 == 0:
            own[1:200:66] = [f"late{i}"] * len(own[1:200:66])
            rows.append((1000 + i, " ".join(own), None))
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t, _ in rows for w in [t.split()]}
    alike = {i: {j for j in sets if j != i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} for i in sets}
    got = {r["doc_id"]: r for r in ngram_join(_docs(spark, rows)).collect()}
    assert {i: got[i]["n_links"] for i in sets} == {i: len(alike[i]) for i in sets} and max(map(len, alike.values())) < 9
    for i in sets:
        reached, todo = {i}, [i]
        while todo:
            new = alike[todo.pop()] - reached
            reached |= new
            todo += new
        assert got[i]["class_id"] == min(reached)


@pytest.mark.parametrize("few", [0, 40, 1000])
def test_components_of_a_chain(spark, few):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (None, 5), (7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(links, few=few).collect()}
    assert got == {i: 0 for i in range(61)} | {100: 100, 101: 100}


def _check_packing(rows, texts, capacity=1024):
    from featloom.llm import tokens

    coder = tokens.encoder(tokens.vocabulary_path()).full
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert r["length"] == len(r["ids"]) // 4 > 0
    for doc, text in texts.items():
        ids = b"".join(bytes(r["ids"]) for r in sorted(by_doc[doc], key=lambda r: r["start"]))
        want = [*coder.encode(text or "", add_special_tokens=False).ids, 0]
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(want)
            at += r["length"]
    real = padded = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        real += at
        padded += at if at & (at - 1) == 0 else capacity
    return real / padded


def test_packing_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").union(spark.createDataFrame([(-1, None, None, None, 0), (-2, "", None, None, 0), (-3, "<|endoftext|>  é", None, None, 0)], "doc_id long, text string, lang string, source string, n_chars long"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert _check_packing(pack(docs.repartition(3)).collect(), texts) > 0.98


def test_packing_edges(spark, odd):
    assert pack(odd.limit(0)).count() == 0
    rows = pack(odd).collect()
    assert {r["doc_id"] for r in rows} == {r["doc_id"] for r in odd.collect()}
    assert sum(r["doc_tokens"] for r in rows if r["start"] == 0 and r["doc_id"] == 3) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 3)


def test_decontaminate_edges(spark, odd):
    item = " ".join(_words(20, 77))
    benchmark = spark.createDataFrame([(1, item.upper()), (2, "Short, item!"), (3, None), (None, "x"), (4, ""), (5, item)], "item_id long, text string")
    docs = odd.union(_docs(spark, [(20, f"some text {item[:-1]}x short; ITEM end", None), (21, "short item", None)]))
    got = {r["doc_id"]: r["overlap"] for r in decontaminate(docs, benchmark).collect() if r["doc_id"] is not None}
    assert (got[20]["n_words"], got[20]["n_hit"], list(got[20]["items"])) == (25, 21, [1, 2, 5])
    assert [tuple(s) for s in got[20]["spans"]] == [(2, 21), (22, 24)]
    assert list(got[21]["items"]) == [2] and got[4]["n_words"] == 0 and got[9]["n_hit"] == 0
    parted = {r["doc_id"]: r["overlap"] for r in decontaminate(docs, benchmark, max_bytes=1).collect() if r["doc_id"] is not None}
    assert parted == got
    assert decontaminate(docs, benchmark.limit(0)).where("overlap.n_hit > 0").count() == 0
    assert decontaminate(docs.limit(0), benchmark).count() == 0
    clean = decontaminate(docs, benchmark).select("doc_id", contaminated().alias("c"), without_spans(F.col("text"), F.col("overlap.spans")).alias("t"))
    rows = {r["doc_id"]: r for r in clean.collect() if r["doc_id"] is not None}
    assert rows[20]["c"] and rows[20]["t"].split() == ["some", "text", item.split()[-1][:-1] + "x", "end"] and rows[4]["t"] is None


def _judged(url, rules, default):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, default)))


def test_url_filter_matches_brute_force(spark):
    rng = random.Random(8)
    hosts = ["com", "a.com", "b.a.com", "x-y.com", "xa.com", "net", "c.net", "", "A.Com", "a.com.", "d.b.a.com"]
    paths = ["", "/", "/en", "/en/", "/en/x?q=1", "/fr/#t", "?a", "#b", "/en//"]
    urls = [None, "no scheme", "http://", "https://a.com/u://b", "://net/en/"] + [f"http://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(300)] + ["http://hot.a.com/en/1"] * 200
    rules = sorted({(rng.choice(hosts[:7]), rng.choice(["/", "/en/", "/en", "", "/fr/"]), rng.choice(["allow", "block"])) for _ in range(14)})
    rules = list({(h, p): (h, p, v) for h, p, v in rules}.values())
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, key string")
    table = spark.createDataFrame([*rules, (None, "/", "block"), ("com", None, "block")], "host string, path string, verdict string")
    for parts in (1, 7):
        got = _by_id(url_filter(pages, table, default="ask", parts=parts))
        assert got == [(i, *_judged(u, rules, "ask")) for i, u in enumerate(urls)]
    assert {r["verdict"] for r in url_filter(pages, table.limit(0)).collect()} == {"allow"}
    assert url_filter(pages.limit(0), table).count() == 0


def test_url_filter_takes_the_label_border_as_it_comes(spark):
    pages = spark.createDataFrame([(1, "http://a\x01x.com/p"), (2, "http://x.com.a/p"), (3, "http://b.a.com/p"), (4, "http://\x02ax.com/p"), (5, "http://c.a\x01x.com/p")], "page_id long, url string")
    rules = spark.createDataFrame([("a.com", "/", "block"), ("a\x01x.com", "/p", "block")], "host string, path string, verdict string")
    assert {r["page_id"]: r["rule"] for r in url_filter(pages, rules).collect()} == {1: "a\x01x.com/p", 2: None, 3: "a.com/", 4: None, 5: "a\x01x.com/p"}


def test_decontaminate_takes_text_ids(spark):
    words = _words(40, 9)
    items = spark.createDataFrame([("q-b", " ".join(words[:20])), ("q-a", " ".join(words[5:25])), (None, " ".join(words))], "item_id string, text string")
    for max_bytes in (64 << 20, 10):
        r = decontaminate(_docs(spark, [(1, " ".join(words), None)]), items, max_bytes=max_bytes).first()
        assert r["overlap"]["items"] == ["q-a", "q-b"] and r["overlap"]["n_hit"] == 25


def test_sha_of_kept_text_is_of_utf8(spark):
    row = substring_dedup(_docs(spark, [(1, "é  ü\nx", None)])).select(F.sha2("kept_text", 256).alias("s")).first()
    assert row["s"] == hashlib.sha256("é ü x".encode()).hexdigest()


def test_packing_deals_out_the_remainder_of_every_task(spark):
    rng = random.Random(4)
    docs = _docs(spark, [(i, " ".join(_words(rng.randrange(5, 120), i)), None) for i in range(640)]).repartition(16)
    rows = pack(docs).collect()
    by_window = {}
    for r in rows:
        by_window.setdefault(r["sequence_id"], []).append(r)
    for own in by_window.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(p["length"] for p in own[:k]) for k in range(len(own))]
    load = {w: sum(r["length"] for r in own) for w, own in by_window.items()}
    tokens_of, dealt = {}, {}
    for w, n in load.items():
        task = w >> 36
        tokens_of[task] = tokens_of.get(task, 0) + n
        if n & (n - 1) or n == 1024:
            dealt[task] = dealt.get(task, 0) + n
    # No task has a block of 64 windows, yet all but less than two windows of each are dealt out.
    assert len(tokens_of) == 16 and all(2048 < n < 64 * 1024 for n in tokens_of.values())
    assert all(tokens_of[t] - dealt.get(t, 0) < 2048 for t in tokens_of)
    padding = sum(1024 - n for n in load.values() if n & (n - 1))
    assert padding < 0.1 * sum(load.values()) and max(load.values()) <= 1024
    pieces = {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"], r["doc_tokens"]))
    for own in pieces.values():
        own.sort()
        assert [p[0] for p in own] == [sum(q[1] for q in own[:k]) for k in range(len(own))] and sum(p[1] for p in own) == own[0][2]
