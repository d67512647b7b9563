"""Numpy helpers, the cover, differencing and the encoder."""

import numpy as np
import pyarrow as pa
import pytest

from featloom.llm import blocks, tokens
from featloom.llm.ngram_join import smallest_depth
from featloom.llm.packing import balanced, differencing
from featloom.llm.substring_dedup import difference_cover

TEXTS = ["", "a", " a  bé\tc ", None, "x" * 5000, "\n\n", "a b", "b a", "end"]


def _chunk(texts):
    return next(blocks.chunks(pa.array(texts, pa.string())))


def test_words_match_split():
    chunk = _chunk(TEXTS)
    found = blocks.words(chunk, blocks.BLANK_PARTED)
    for row, text in enumerate(TEXTS):
        own = range(found.first[row], found.first[row + 1])
        assert [chunk.data[found.starts[i] : found.ends[i]].tobytes() for i in own] == (text or "").encode().split()
        assert [found.place[i] for i in own] == list(range(len(own)))


def test_words_do_not_join_neighbouring_rows():
    found = blocks.words(_chunk(["ab", "cd", "", "ef"]), blocks.BLANK_PARTED)
    assert list(found.counts) == [1, 1, 0, 1]


def test_chunks_cover_every_row_of_a_sliced_array():
    column = pa.array(["x" * n for n in range(300)]).slice(7, 211)
    got = [c.text(r).decode() for c in blocks.chunks(column, limit=1000) for r in range(c.rows)]
    assert got == column.to_pylist()


def test_run_hashes_depend_on_order_and_not_on_place():
    chunk = _chunk(["p q r s", "z p q r s", "q p r s"])
    found = blocks.words(chunk, blocks.BLANK_PARTED)
    hashes = blocks.run_hashes(blocks.word_hashes(chunk, found), 4)
    assert hashes[0] == hashes[5] and hashes[0] != hashes[9]


def test_case_is_folded_for_ascii_only():
    chunk = _chunk(["License É", "lICENSE é"])
    found = blocks.words(chunk, blocks.ALPHANUMERIC)
    a, b, c, d = blocks.word_hashes(chunk, found, fold_case=True)
    assert a == c and b != d


@pytest.mark.parametrize("period", [1, 2, 5, 13, 31, 40])
def test_cover_reaches_every_difference(period):
    cover = difference_cover(period)
    assert {int(a - b) % period for a in cover for b in cover} == set(range(period))


def test_spread():
    assert list(blocks.spread(np.array([5, 9, 0]), np.array([2, 0, 3]))) == [5, 6, 0, 1, 2]


def test_smallest_depth_reaches_the_recall():
    d = smallest_depth(0.8, 14, 0.999)
    assert 1 - (1 - 0.8**d) ** 14 >= 0.999 > 1 - (1 - 0.8 ** (d + 1)) ** 14
    with pytest.raises(ValueError):
        smallest_depth(0.5, 2, 0.999)


def test_differencing_places_every_item_once_and_balances():
    sizes = np.random.default_rng(3).integers(1, 257, 300)
    dealt = differencing(sizes, 40)
    assert sorted(i for own in dealt for i in own) == list(range(300))
    loads = [sizes[own].sum() for own in dealt]
    assert max(loads) - min(loads) <= 20


def test_window_count_rises_until_all_fit():
    sizes = np.array([700, 700, 700])
    assert sorted(len(own) for own in balanced(sizes, 1024) if own) == [1, 1, 1]


def test_encoder_equals_tokenizers():
    coder = tokens.encoder(tokens.vocabulary_path())
    odd = ["", " ", "a  b", "x <|endoftext|> y", " lead", "tail ", "\n\na b\n c", "tab\t x", "don't I'll", "中文 字 a", "a　 b", "3a --- b's \u00a0 z", "é à", "a" * 3000]
    for text in odd:
        assert list(coder.ids(text)) == coder.full.encode(text, add_special_tokens=False).ids, text
