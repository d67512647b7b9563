"""Alignment of two tokenizers: galloping search, groups and pair counts against brute force, edge cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from featloom.llm import tokens
from featloom.llm.alignment import SHIFT, align, coders, common_ends, gallop, link_scores, pair_counts, possible_pairs
from featloom.llm.queries import op13_alignment

TEXTS = [
    None, "", " ", "a", "plain words here", "  two  blanks\n\n\tand more ", "naïve — 日本語 👩‍👩‍👧 text", "a<|endoftext|>b </s> <0x41>", "▁ mark", "x" * 3000, "é" * 50, "\x00 nul \x1f", "word " * 5000, "plain words here", " a \t  b\n c  d\x1c e\u2003f g", "word. word, (word) wörd's \u00a0x"
]
PATHS = tokens.vocabulary_path(), tokens.vocabulary_path("piece_bpe_32k.model")


@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400)))
@settings(max_examples=200, deadline=None)
def test_gallop_and_common_ends(x, y):
    a, b = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    assert gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
    at_a, at_b = common_ends(a, b)
    assert a[at_a].tolist() == b[at_b].tolist() == sorted(x & y)


def test_gallop_far_from_the_guess():
    long = np.concatenate([np.arange(10_000), [10**9, 10**9 + 1]])
    assert gallop(np.array([5, 10**9 + 1]), long).tolist() == [5, 10_001]


def _brute(texts):
    """Rows from the libraries themselves, token by token."""
    import sentencepiece

    coder = Tokenizer.from_file(PATHS[0])
    coder.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    a_side, b_side = coders(*PATHS).a, coders(*PATHS).b
    docs, links = [], Counter()
    for text in texts:
        a = coder.encode(" " + text, add_special_tokens=False).ids if text else []
        b = model.encode(text) if text else []
        raw_a, raw_b = [a_side.bytes_of[i] for i in a], [b_side.bytes_of[i] for i in b]
        if not text or not b"".join(raw_a) == b"".join(raw_b) == b" " + text.encode():
            a, b, raw_a, raw_b = [], [], [], []
        groups, own, i, at_a, at_b, part = [], [], 0, 0, 0, ([], [])
        j = 0
        while i < len(a) or j < len(b):
            if at_a <= at_b:
                at_a, i = at_a + len(raw_a[i]), i + 1
                part[0].append(a[i - 1])
            else:
                at_b, j = at_b + len(raw_b[j]), j + 1
                part[1].append(b[j - 1])
            if at_a == at_b:
                groups.append("|".join(",".join(map(str, p)) for p in part))
                own.append((part[0][-1], part[1][-1]))
                part = ([], [])
        docs.append((len(a), len(b), groups, own))
        links.update(own)
    best = Counter()
    for (_, y), n in links.items():
        best[y] = max(best[y], n)
    digest = lambda g: hashlib.sha256(";".join(g).encode()).hexdigest() if g else ""
    return [(n_a, n_b, len(g), len(own), sum(links[p] == best[p[1]] for p in own), sum(links[p] for p in own), digest(g)) for n_a, n_b, g, own in docs]


def test_rows_match_brute_force(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(TEXTS)] + [(None, "no id here", 1, "x"), (3, "a", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a long, groups string").repartition(3)
    aligned = align(docs)
    scored = link_scores(aligned, pair_counts(aligned))
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    got = scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest).collect()
    want = [(r[0], *w) for r, w in zip(rows, _brute([r[1] for r in rows]))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert [w for w in want if w[0] == 8][0][1:] == (0, 0, 0, 0, 0, 0, "") and any(w[3] != w[1] for w in want)


def test_empty_table(spark):
    aligned = align(spark.createDataFrame([], "doc_id string, text string"))
    assert link_scores(aligned, pair_counts(aligned)).count() == 0


def test_pairs_are_bounded_by_the_vocabularies(spark):
    assert possible_pairs([b"a", b"ba", b"cba"], [b"a", b"a", b"cba", b"x"]) == 7 + 2
    a_side, b_side = coders(*PATHS).a, coders(*PATHS).b
    assert possible_pairs(a_side.bytes_of, b_side.bytes_of) < 1_000_000 and len(b_side.bytes_of) < SHIFT
    aligned = align(spark.createDataFrame([(1, "a b")], "doc_id long, text string"))
    wrong = spark.range(2_000_000).select(F.col("id").alias("a"), F.lit(0).alias("b"), F.lit(1).cast("long").alias("links"), F.lit(1).cast("long").alias("best"))
    with pytest.raises(ValueError, match="vocabularies"):
        link_scores(aligned, wrong)


def test_query_matches_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    want = [(d["doc_id"], *row) for d, row in zip(docs, _brute([d["text"] for d in docs]))]
    assert sorted(map(tuple, op13_alignment(spark, sf_dir).collect())) == want
