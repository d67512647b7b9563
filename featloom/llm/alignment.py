"""Alignment of two tokenizers' tokens by galloping intersection of their end offsets.

Each task encodes its texts twice and holds, for a chunk of documents at a time, the sorted byte offsets at which
the tokens of either side end. The shorter of the two lists drives: each of its ends is looked up in the longer one by
steps that double from a guessed place and a binary search in the last step, all ends of the chunk at once. The common
ends cut both token sequences into groups; differences of the ranks of neighbouring common ends give
the range of tokens on either side of a group.

Two tokens are linked if they end at the same byte, so one of them is a suffix of the other. The id pairs that can ever be linked
are therefore those of the two vocabularies (some hundred thousand, ``possible_pairs``), whatever the corpus: the table of their counts
has a bound that does not grow with the data and may be sent to every worker.
"""

from __future__ import annotations

import re
from array import array
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks, tokens
from featloom.workspace import materialise

#: How the piece model writes a blank.
BLANK = "\u2581"
_BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
#: Ids of side B are below this; a pair is packed as ``a * SHIFT + b``.
SHIFT = 1 << 20


#: Values of the driving list between two that are searched first, to guess the places of the rest.
STRIDE = 64


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each value of ``short`` the number of values of ``long`` below it; both rise strictly.

    Every ``STRIDE``-th value is searched first; the search for a value between two of them starts at its share of the way between
    their places (for a short list: at its share of ``long``), doubles its steps up or down until it has passed the value, and halves the last step.
    """
    n, m = len(short), len(long)
    if not n or not m:
        return np.zeros(n, np.int64)
    if n <= STRIDE:
        guess = np.arange(n, dtype=np.int64) * m // n
    else:
        some = np.append(np.arange(0, n - 1, STRIDE), n - 1)
        guess = np.minimum(np.interp(short, short[some], gallop(short[some], long)).astype(np.int64), m - 1)
    up = long[guess] < short
    # The answer lies in [low, high]: everything before low is below the value, nothing from high on.
    low, high = np.where(up, guess + 1, 0), np.where(up, m, guess)
    active, step = np.arange(n), 1
    while len(active):
        rising = up[active]
        at = np.where(rising, guess[active] + step, guess[active] - step)
        inside = (at >= 0) & (at < m)
        active, at, rising = active[inside], at[inside], rising[inside]
        below = long[at] < short[active]
        low[active[below]] = at[below] + 1
        high[active[~below]] = at[~below]
        active = active[below == rising]
        step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        mid = (low[open_] + high[open_]) >> 1
        below = long[mid] < short[open_]
        low[open_[below]] = mid[below] + 1
        high[open_[~below]] = mid[~below]
        open_ = open_[low[open_] < high[open_]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the values that both hold; the shorter list drives the search."""
    if len(a) > len(b):
        there, here = common_ends(b, a)
        return here, there
    place = gallop(a, b)
    found = np.flatnonzero(place < len(b))
    found = found[b[place[found]] == a[found]]
    return found, place[found]


class ByteSide:
    """Side A: a blank and the text, byte-level; special tokens' strings are plain text."""

    def __init__(self, path: str):
        self.coder = tokens.encoder(path)
        table = tokens._ranks(self.coder.full.get_vocab(with_added_tokens=False), set())
        self.bytes_of = [b""] * (max(table.values()) + 1)
        for raw, i in table.items():
            self.bytes_of[i] = raw

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [self.coder.runs.encode_ordinary(" " + t) for t in texts]


class PieceSide:
    """Side B: the text; the model puts a blank before it."""

    def __init__(self, path: str):
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        self.bytes_of = []
        for piece in pieces:
            byte = _BYTE_PIECE.fullmatch(piece)
            self.bytes_of.append(bytes([int(byte[1], 16)]) if byte else piece.replace(BLANK, " ").encode())
        #: Pieces begin with their blanks, so no piece reaches over the blank between two words.
        self.by_word = not any(re.search(f"[^{BLANK}]{BLANK}", p) for p in pieces)

    def ids(self, texts: list[str]) -> list[list[int]]:
        return self.coder.encode(texts, num_threads=1)


class Coders:
    """Both sides together. Neither side's tokens reach over a single blank between two characters that are no white space, so
    the stretches between such blanks are encoded each by itself, and short ones once (about ``STRETCHES`` are remembered)."""

    STRETCHES = 400_000
    SHORT = 32
    CUT = re.compile(r"(?<=\S) (?=\S)")

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteSide(byte_path), PieceSide(piece_path)
        self.width = 2 if max(len(self.a.bytes_of), len(self.b.bytes_of)) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.sizes = [np.array([len(x) for x in side.bytes_of], np.int64) for side in (self.a, self.b)]
        self.known = tokens.Remembered(self.STRETCHES)

    def _cut(self, text: str) -> list[str]:
        if not self.b.by_word:
            return [text]
        plain = not (text[0].isspace() or text[-1].isspace() or tokens._NEIGHBOURS.search(text))
        return text.split(" ") if plain else self.CUT.split(text)

    def _learn(self, missing: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        out, of_a, of_b = {}, self.a.bytes_of, self.b.bytes_of
        for t, a, b in zip(missing, self.a.ids(missing), self.b.ids(missing)):
            same = b"".join([of_a[i] for i in a]) == b" " + t.encode() == b"".join([of_b[i] for i in b])
            out[t] = (array(self.kind.char, a).tobytes(), array(self.kind.char, b).tobytes()) if same else None
        return out

    def ids(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(A ids, B ids) of each text; none where a side's tokens don't give back a blank and the text."""
        cut = [self._cut(t) if t else [] for t in texts]
        self.known.tidy()
        known = self.known.new
        here = self._learn(self.known.recall({s for stretches in cut for s in stretches if s not in known}))
        apart = {s: v for s, v in here.items() if v is None or len(s) > self.SHORT}
        known.update((s, v) for s, v in here.items() if s not in apart)
        out = []
        for stretches in cut:
            both = [apart[s] if s in apart else known[s] for s in stretches] if apart else [known[s] for s in stretches]
            if None in both:
                both = []
            out.append(tuple(np.frombuffer(b"".join([x[k] for x in both]), self.kind) for k in (0, 1)))
        return out


@lru_cache(maxsize=2)
def coders(byte_path: str, piece_path: str) -> Coders:
    return Coders(byte_path, piece_path)


def possible_pairs(a: list[bytes], b: list[bytes]) -> int:
    """How many id pairs of the two vocabularies have a token that is a suffix of the other."""
    of_a, of_b = defaultdict(int), defaultdict(int)
    for table, many in ((a, of_a), (b, of_b)):
        for raw in table:
            many[raw] += 1
    suffixes = lambda x: (x[i:] for i in range(1, len(x)))
    longer = lambda x, y: sum(n * y.get(s, 0) for raw, n in x.items() for s in suffixes(raw))
    return longer(of_a, of_b) + longer(of_b, of_a) + sum(n * of_b.get(raw, 0) for raw, n in of_a.items())


_ALIGNED = "id {kind}, n_a long, n_b long, a_ids binary, b_ids binary, a_cut binary, b_cut binary"


def _align_chunk(texts: list[str], both: Coders) -> list[tuple[np.ndarray, ...]]:
    """For each text (ids of A, ids of B, which A tokens end a group, which B tokens do)."""
    pairs = both.ids(texts)
    all_ids = [np.concatenate([np.zeros(0, both.kind), *(p[k] for p in pairs)]) for k in (0, 1)]
    # Offsets run on over the documents of the chunk, so one search serves all of them.
    found = common_ends(*(np.cumsum(size[ids]) for size, ids in zip(both.sizes, all_ids)))
    marks = [np.zeros(len(ids), bool) for ids in all_ids]
    for mark, at in zip(marks, found):
        mark[at] = True
    a_from, b_from = (np.cumsum([0, *(len(p[k]) for p in pairs)]) for k in (0, 1))
    return [(a, b, marks[0][a_from[i] : a_from[i + 1]], marks[1][b_from[i] : b_from[i + 1]]) for i, (a, b) in enumerate(pairs)]


def align(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", byte_vocabulary: str | None = None, piece_model: str | None = None) -> DataFrame:
    """Token ids of both sides and the common ends of every document.

    Columns: ``id_col``, ``n_a``, ``n_b``, the ids ``a_ids``, ``b_ids`` (binary, little-endian unsigned, 16 bit if both vocabularies fit, else 32) and
    ``a_cut``, ``b_cut``, a bit for each token, the lowest first, set where a group ends. A null or empty
    text, and one whose tokens on either side don't give back a blank and the text, has no tokens. Every row is aligned by itself, so repeated
    rows and rows without an id are kept; other columns are not read. An empty table gives no rows.
    """
    paths = byte_vocabulary or tokens.vocabulary_path(), piece_model or tokens.vocabulary_path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = coders(*paths)
        for batch in batches:
            for chunk in blocks.chunks(batch.column(1)):
                rows = _align_chunk([chunk.text(r).decode() for r in range(chunk.rows)], both)
                counts = [pa.array([len(r[k]) for r in rows], pa.int64()) for k in (0, 1)]
                ids = [pa.array([r[k].tobytes() for r in rows], pa.binary()) for k in (0, 1)]
                cuts = [pa.array([np.packbits(r[k], bitorder="little").tobytes() for r in rows], pa.binary()) for k in (2, 3)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.low, chunk.rows), *counts, *ids, *cuts], names=["id", "n_a", "n_b", "a_ids", "b_ids", "a_cut", "b_cut"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(run, _ALIGNED.format(kind=kind)).withColumnRenamed("id", id_col)


class _Aligned(NamedTuple):
    """A row of ``align``: the ids, which tokens end a group, and for each group the tokens up to its end."""

    a: np.ndarray
    b: np.ndarray
    a_cut: np.ndarray
    b_cut: np.ndarray
    a_to: np.ndarray
    b_to: np.ndarray

    @property
    def links(self) -> np.ndarray:
        """The linked id pairs, packed."""
        return self.a[self.a_to - 1] * SHIFT + self.b[self.b_to - 1]

    def codes(self, many: int) -> np.ndarray:
        """The ids of both sides group by group, A before B; raised by ``many`` where A's part of a group ends, by twice that where B's ends."""
        out = np.empty(len(self.a) + len(self.b), np.int64)
        if len(self.a_to):
            before = np.concatenate([[0], self.b_to[:-1]])
            group_a, group_b = (np.cumsum(cut) - cut for cut in (self.a_cut, self.b_cut))
            out[np.arange(len(self.a)) + before[group_a]] = self.a + many * self.a_cut
            out[np.arange(len(self.b)) + self.a_to[group_b]] = self.b + 2 * many * self.b_cut
        return out


def _rows(batch: pa.RecordBatch) -> Iterator[_Aligned]:
    """The rows of a batch whose first columns are those of ``align`` after the id."""
    for n_a, n_b, a, b, a_cut, b_cut in zip(*(batch.column(k) for k in range(6))):
        n = n_a.as_py(), n_b.as_py()
        ids = [np.frombuffer(x.as_buffer(), f"<u{len(x.as_buffer()) // k if k else 2}").astype(np.int64) for x, k in zip((a, b), n)]
        cuts = [np.unpackbits(np.frombuffer(x.as_buffer(), np.uint8), count=k, bitorder="little").astype(np.int64) for x, k in zip((a_cut, b_cut), n)]
        yield _Aligned(*ids, *cuts, *(np.flatnonzero(c) + 1 for c in cuts))


_ROW = ("n_a", "n_b", "a_ids", "b_ids", "a_cut", "b_cut")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``links``, ``best``): how many links of the corpus hold each id pair, and the highest such number of its B id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, many = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            fresh, n = np.unique(np.concatenate([np.zeros(0, np.int64), *(r.links for r in _rows(batch))]), return_counts=True)
            both, where = np.unique(np.concatenate([seen, fresh]), return_inverse=True)
            seen, many = both, np.bincount(where, np.concatenate([many, n]), len(both)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seen // SHIFT), pa.array(seen % SHIFT), pa.array(many)], names=["a", "b", "links"])

    parts = aligned.select(*_ROW).mapInArrow(run, "a long, b long, links long")
    counted = materialise(parts.groupBy("a", "b").agg(F.sum("links").alias("links")), "pairs")
    best = counted.groupBy("b").agg(F.max("links").alias("best"))
    return counted.join(best, "b").select("a", "b", "links", "best")


def link_scores(aligned: DataFrame, counts: DataFrame, id_col: str = "doc_id", byte_vocabulary: str | None = None, piece_model: str | None = None) -> DataFrame:
    """``aligned`` without its lists: ``n_groups``, ``n_links``, ``n_best`` (links whose pair is linked as often as any of its B id),
    ``count_sum`` (their pairs' counts) and ``groups`` (text, ``a1,a2|b1;a3|b2,b3``).

    ``counts`` is taken to the driver and sent out: it has at most ``possible_pairs`` rows, which is checked.
    """
    both = coders(byte_vocabulary or tokens.vocabulary_path(), piece_model or tokens.vocabulary_path("piece_bpe_32k.model"))
    bound = possible_pairs(both.a.bytes_of, both.b.bytes_of)
    table = counts.select((F.col("a") * SHIFT + F.col("b")).alias("pair"), "links", "best").limit(bound + 1).toArrow()
    if table.num_rows > bound:
        raise ValueError(f"{table.num_rows} pairs, but the vocabularies allow {bound}; are the counts of other vocabularies?")
    pairs, links, best = (table.column(c).combine_chunks().to_numpy() for c in ("pair", "links", "best"))
    order, many = np.argsort(pairs), max(len(both.a.bytes_of), len(both.b.bytes_of))
    sent = aligned.sparkSession.sparkContext.broadcast((pairs[order], links[order], best[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, links, best = sent.value
        shown = [f"{i}{mark}" for mark in ",|;" for i in range(many)]

        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = list(_rows(part.select(part.schema.names[1:])))
                own = [np.searchsorted(pairs, r.links) for r in rows]
                groups = ["".join(map(shown.__getitem__, r.codes(many).tolist()))[:-1] for r in rows]
                size = pa.array([len(x) for x in own], pa.int64())
                n_best = pa.array([int((links[x] == best[x]).sum()) for x in own], pa.int64())
                total = pa.array([int(links[x].sum()) for x in own], pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in range(3)), size, size, n_best, total, pa.array(groups, pa.string())], names=["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    kind = aligned.schema[id_col].dataType.simpleString()
    source = aligned.select(F.col(id_col).alias("id"), *_ROW)
    scored = source.mapInArrow(run, f"id {kind}, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")
    return scored.withColumnRenamed("id", id_col)
