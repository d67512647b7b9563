"""Line-first quality rules: lines are judged one by one, documents by what they lose.

A line with words fails if it reads as navigation (separators between the words, or mostly
links), as symbol noise, as shouting, or as boilerplate (a phrase of page furniture; one that prose may use as well
counts in a short line only), or if it is a short line without closing punctuation in any of the usual scripts. A
pair of Chinese, Japanese or Korean characters counts as a word there. Failed lines are removed; a document that loses more than
``lost`` percent of its word characters that way is rejected, as is one that fails
the base rules (too few words, or too many repeated three-word windows).
One pass over the texts, without a shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks

#: The characters counted as symbols, those that may close a line, and those that part links.
SYMBOLS = "#*$%&|<>"
CLOSING = ".!?:;\"')]" + "\u2026\u201c\u201d\u2019\u00bb\u203a\u3002\uff01\uff1f\uff1a\uff1b\u300d\u300f\uff09\u0964\u061f"
SEPARATORS = "|\u00bb\u203a\u2022\u00b7\u2192"
#: Phrases of page furniture, looked for between word bounds with ASCII letters in lower case: in any line, and in short lines.
BOILERPLATE = ("lorem ipsum", "enable javascript", "javascript is disabled", "javascript is required", "this site uses cookies", "this website uses cookies")
SHORT_BOILERPLATE = ("cookie policy", "uses cookies", "use of cookies", "privacy policy", "terms of use", "javascript", "click here", "sign in", "log in")
#: Starts of words that are links.
LINK = rb"https?://|www\."


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules.

    navigation: separators per word from which a line is navigation; links: share of words that are links from which
    it is; furniture: lines below this many words fail by a phrase that prose may use; symbols: symbol characters per word from which
    a line is noise; shouting: share of capitals among ASCII letters, in a line of ``shout_words`` words or more;
    open_words: a line below this many words must end in closing punctuation; lost: largest share of word
    characters a kept document may lose; words: fewest words; repeated: largest share of words in repeated
    three-word windows. Shares are in percent, so that all tests are on integers.
    """

    navigation: int = 30
    links: int = 50
    furniture: int = 8
    symbols: int = 50
    shouting: int = 80
    shout_words: int = 4
    open_words: int = 5
    lost: int = 50
    words: int = 50
    repeated: int = 50


_FIELDS = [
    *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
    *((n, pa.bool_()) for n in ("base_failed", "kept")),
    *((n, pa.int64()) for n in ("n_lines", "n_failed_lines", "lost_chars")),
    ("clean_text", pa.string()),
]
_SCHEMA = "struct<n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, n_failed_lines long, lost_chars long, clean_text string>"


def _class(characters: str) -> np.ndarray:
    return np.isin(np.arange(256), np.frombuffer(characters.encode(), np.uint8))


_SYMBOL = _class(SYMBOLS)
_ALNUM = np.isin(np.arange(256), np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", np.uint8))
#: First bytes of U+3000 to U+D7FF.
_WIDE = (np.arange(256) >= 0xE3) & (np.arange(256) <= 0xED)
_LINK = re.compile(LINK)
_UPPER, _LOWER = (np.arange(256) >= 65) & (np.arange(256) <= 90), (np.arange(256) >= 97) & (np.arange(256) <= 122)


def _ends_of(data: np.ndarray, characters: str) -> np.ndarray:
    """Flags of the bytes that are the last of one of the characters."""
    flags = np.zeros(len(data), bool)
    for encoded in (c.encode() for c in characters):
        here = data == encoded[-1]
        for back, byte in enumerate(encoded[-2::-1], 1):
            here[back:] &= data[:-back] == byte
            here[:back] = False
        flags |= here
    return flags


def _phrase_lines(lower: bytes, phrase: str, begin: np.ndarray, stop: np.ndarray) -> list[int]:
    """Lines in which the phrase stands between word bounds."""
    lines = []
    where = lower.find(phrase.encode())
    while where >= 0:
        line, end = int(np.searchsorted(begin, where, side="right")) - 1, where + len(phrase)
        if line >= 0 and end <= stop[line] and (where == begin[line] or not _ALNUM[lower[where - 1]]) and (end == stop[line] or not _ALNUM[lower[end]]):
            lines.append(line)
        where = lower.find(phrase.encode(), where + 1)
    return lines


def _repeats(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes occur again in their row, and which of those are not the row's first."""
    order = np.lexsort((hashes, row))
    same = np.zeros(len(order), bool)
    same[1:] = (hashes[order][1:] == hashes[order][:-1]) & (row[order][1:] == row[order][:-1])
    again, later = np.zeros(len(order), bool), np.zeros(len(order), bool)
    later[order] = same  # lexsort is stable, so the first in the text comes first
    twice = same.copy()
    twice[:-1] |= same[1:]
    again[order] = twice
    return again, later


def _chunk(chunk: blocks.Chunk, limits: Limits) -> dict[str, list]:
    data, rows = chunk.data, chunk.rows
    found = blocks.words(chunk, blocks.BLANK_PARTED)
    hashes = blocks.word_hashes(chunk, found)
    total = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    chars = total(blocks.BLANK_PARTED[data] & ((data & 0xC0) != 0x80))
    symbols = total(_SYMBOL[data])
    per_row = lambda sums: sums[chunk.offsets[1:]] - sums[chunk.offsets[:-1]]

    at = blocks.whole_runs(found, 3)
    again, _ = _repeats(blocks.run_hashes(hashes, 3)[at], found.row[at])
    repeated = np.bincount(found.row[blocks.covered(len(found.row), at[again], 3)], minlength=rows)

    # Lines: each row's text up to \n or its end; their places follow the rows.
    breaks = np.flatnonzero(data == 10)
    begin = np.sort(np.concatenate([chunk.offsets[:-1], breaks + 1]), kind="stable")
    line_row = np.searchsorted(chunk.offsets[1:], begin, side="right")
    row_of_break = np.searchsorted(chunk.offsets, breaks, side="right") - 1
    lines_in = np.bincount(row_of_break, minlength=rows) + 1
    line_row = np.repeat(np.arange(rows), lines_in)
    stop = np.sort(np.concatenate([chunk.offsets[1:], breaks]), kind="stable")
    first_word, last_word = np.searchsorted(found.starts, begin), np.searchsorted(found.starts, stop)
    n = last_word - first_word
    some = n > 0
    begin, stop, line_row, n, last_word = begin[some], stop[some], line_row[some], n[some], last_word[some]
    _, later = _repeats(blocks.span_hashes(chunk, begin, stop), line_row)
    dup_lines = np.bincount(line_row[later], minlength=rows)

    within = lambda sums: sums[stop] - sums[begin]
    upper, letters = within(total(_UPPER[data])), within(total(_UPPER[data] | _LOWER[data]))
    closed = _ends_of(data, CLOSING)[found.ends[last_word - 1] - 1] if len(n) else np.zeros(0, bool)
    lower = data.tobytes().lower()
    links = np.array([m.start() for m in _LINK.finditer(lower)], np.int64)
    link_line = np.searchsorted(begin, links[np.isin(links, found.starts)], side="right") - 1
    failed = 100 * within(total(_ends_of(data, SEPARATORS))) >= limits.navigation * n
    failed |= 100 * np.bincount(link_line, minlength=len(n)) >= limits.links * n
    failed |= 100 * within(symbols) >= limits.symbols * n
    failed |= (n >= limits.shout_words) & (letters > 0) & (100 * upper >= limits.shouting * letters)
    failed |= ~closed & (2 * n + within(total(_WIDE[data])) < 2 * limits.open_words)
    short = n < limits.furniture
    for phrase in BOILERPLATE:
        failed[_phrase_lines(lower, phrase, begin, stop)] = True
    for phrase in SHORT_BOILERPLATE:
        failed[[line for line in _phrase_lines(lower, phrase, begin, stop) if short[line]]] = True
    line_chars = within(chars)
    lost = np.bincount(line_row[failed], weights=line_chars[failed], minlength=rows).astype(np.int64)

    word_chars, n_words = per_row(chars), found.counts
    base_failed = (n_words < limits.words) | (100 * repeated > limits.repeated * n_words)
    clean, cut = [], np.bincount(line_row[failed], minlength=rows)
    edge = np.searchsorted(line_row, np.arange(rows + 1))
    for r in range(rows):
        text = chunk.text(r)
        if cut[r]:
            base = chunk.offsets[r]
            own, spans = range(edge[r], edge[r + 1]), []
            last = 0
            for i in own:
                if failed[i]:
                    spans.append(text[last : begin[i] - base])
                    last = min(stop[i] - base + 1, len(text))
            text = b"".join([*spans, text[last:]])
        clean.append(text)
    return {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": per_row(symbols), "n_dup_lines": dup_lines, "n_repeat_words": repeated,
        "base_failed": base_failed, "kept": ~base_failed & (100 * lost <= limits.lost * word_chars),
        "n_lines": np.bincount(line_row, minlength=rows), "n_failed_lines": cut, "lost_chars": lost, "clean_text": clean,
    }


def line_quality(docs: DataFrame, text_col: str = "text", result_col: str = "quality", limits: Limits = Limits()) -> DataFrame:
    """``docs`` with a struct column ``result_col``: counts, ``base_failed``, ``kept`` and ``clean_text``.

    Counts: words (parted by ASCII blanks), code points in words, symbol characters, lines that repeat an
    earlier line with words, words in three-word windows that occur twice or more in the text, lines with words,
    failed lines and the word characters lost with them. A null or empty text has no words, fails the base rules
    and has an empty ``clean_text``. Blank lines never fail. Repeated rows are judged alike. All other columns
    pass unchanged; a column named ``result_col`` is replaced.
    """

    @F.arrow_udf(_SCHEMA)
    def judge(text: pa.Array) -> pa.Array:
        parts = [_chunk(c, limits) for c in blocks.chunks(text)]
        arrays = []
        for name, kind in _FIELDS:
            if name == "clean_text":
                arrays.append(pa.array([t for p in parts for t in p[name]], pa.binary()).cast(pa.string()))
            else:
                arrays.append(pa.array(np.concatenate([p[name] for p in parts]) if parts else [], kind))
        return pa.StructArray.from_arrays(arrays, names=[n for n, _ in _FIELDS])

    return docs.withColumn(result_col, judge.asNondeterministic()(F.col(text_col)))
