"""Benchmark decontamination with a broadcast set of test n-grams.

The items' windows are hashed once; each document's windows are looked up while
its text is scanned, first in a bit table, then in the sorted hashes, and every
hit is verified word by word. No shuffle of the documents. The set goes to the executors
only while its size is below ``max_bytes``; a larger benchmark is taken in as many
passes of at most that size as it needs, each of them a narrow scan that adds its hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from featloom.llm import blocks

WINDOW = 13
MAX_BYTES = 64 << 20
_BITS = 22
_FOLD = bytes(b + 32 if 65 <= b <= 90 else (b if blocks.ALPHANUMERIC[b] else 32) for b in range(256))


def _result_type(text_ids: bool) -> tuple[str, pa.DataType]:
    """The result column's type for Spark and for Arrow; item ids are long, or text where the benchmark's are no whole numbers."""
    name, kind = ("string", pa.string()) if text_ids else ("long", pa.int64())
    spans = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    schema = f"struct<n_words long, n_hit long, items array<{name}>, spans array<struct<start long, stop long>>>"
    return schema, pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(kind)), ("spans", spans)])


def fold(text: bytes) -> bytes:
    """ASCII letters in lower case, every other ASCII character but digits a blank."""
    return text.translate(_FOLD)


class WindowSet:
    """Windows of test items: hash, and for each the words and the item."""

    def __init__(self, items: list[tuple[int | str, str]], window: int):
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.known: dict[tuple[int, int], dict[bytes, set[int | str]]] = {}
        texts = pa.array([t for _, t in items], pa.string())
        hashes: dict[int, list[int]] = {}
        for chunk in blocks.chunks(texts):
            found = blocks.words(chunk, blocks.ALPHANUMERIC)
            plain = blocks.word_hashes(chunk, found, fold_case=True)
            for row in range(chunk.rows):
                low, high = found.first[row], found.first[row + 1]
                if low == high:
                    continue
                length = min(window, high - low)
                runs = blocks.run_hashes(plain[low:high], length)
                own = fold(chunk.text(row)).split()
                for i, h in enumerate(runs.tolist()):
                    self.known.setdefault((length, h), {}).setdefault(b" ".join(own[i : i + length]), set()).add(items[chunk.low + row][0])
                    hashes.setdefault(length, []).append(h)
        for length, found_hashes in hashes.items():
            keys = np.unique(np.array(found_hashes, np.uint64))
            table = np.zeros(1 << _BITS, bool)
            table[keys >> np.uint64(64 - _BITS)] = True
            self.by_length[length] = (keys, table)


def _scan(chunk: blocks.Chunk, windows: WindowSet) -> list[dict]:
    found = blocks.words(chunk, blocks.ALPHANUMERIC)
    hashes = blocks.word_hashes(chunk, found, fold_case=True)
    hit = np.zeros(len(found.row), bool)
    items: dict[int, set[int | str]] = {}
    for length, (keys, table) in windows.by_length.items():
        at = blocks.whole_runs(found, length)
        runs = blocks.run_hashes(hashes, length)[at]
        maybe = np.flatnonzero(table[runs >> np.uint64(64 - _BITS)])
        maybe = maybe[keys[np.minimum(np.searchsorted(keys, runs[maybe]), len(keys) - 1)] == runs[maybe]]
        true = []
        for i in maybe:
            begin, row = int(at[i]), int(found.row[at[i]])
            text = fold(chunk.data[found.starts[begin] : found.ends[begin + length - 1]].tobytes())
            whose = windows.known[(length, int(runs[i]))].get(b" ".join(text.split()))
            if whose:
                true.append(begin)
                items.setdefault(row, set()).update(whose)
        hit |= blocks.covered(len(hit), np.array(true, np.int64), length)
    n_hit = np.bincount(found.row[hit], minlength=chunk.rows)
    out = []
    for row in range(chunk.rows):
        spans = []
        if n_hit[row]:
            own = np.flatnonzero(np.diff(hit[found.first[row] : found.first[row + 1]].astype(np.int8), prepend=0, append=0))
            spans = [{"start": int(a), "stop": int(b)} for a, b in zip(own[::2], own[1::2])]
        out.append({"n_words": int(found.counts[row]), "n_hit": int(n_hit[row]), "items": sorted(items.get(row, ())), "spans": spans})
    return out


def _scanner(shared: Broadcast, text_ids: bool):
    schema, kind = _result_type(text_ids)

    @F.arrow_udf(schema)
    def scan(text: pa.Array) -> pa.Array:
        return pa.array([r for c in blocks.chunks(text) for r in _scan(c, shared.value)], kind)

    return scan.asNondeterministic()


def _merge(spans: list[dict]) -> list[dict]:
    merged: list[dict] = []
    for s in sorted(spans, key=lambda s: (s["start"], s["stop"])):
        if merged and s["start"] <= merged[-1]["stop"]:
            merged[-1]["stop"] = max(merged[-1]["stop"], s["stop"])
        else:
            merged.append(dict(s))
    return merged


def _parts(benchmark: DataFrame, item_col: str, text_col: str, text_ids: bool, max_bytes: int) -> Iterator[list[tuple[int | str, str]]]:
    """The items in parts of at most ``max_bytes`` of text (one item at least), streamed to the driver."""
    part, size = [], 0
    items = benchmark.select(F.col(item_col).cast("string" if text_ids else "long"), F.col(text_col)).where(F.col(item_col).isNotNull() & F.col(text_col).isNotNull())
    for item, text in items.toLocalIterator():
        if part and size + len(text) > max_bytes:
            yield part
            part, size = [], 0
        part.append((item, text))
        size += len(text)
    if part:
        yield part


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", result_col: str = "overlap", window: int = WINDOW, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """``docs`` with a struct column ``result_col``: ``n_words``, ``n_hit``, ``items`` and hit ``spans`` (word numbers).

    Words are runs of ASCII letters, digits and characters beyond ASCII, ASCII letters in lower case. A window is
    ``window`` consecutive words of an item; an item with fewer words, but some, is one window. A document word inside any occurrence of
    a window is hit. Items without words, null items and null ids match nothing; equal windows of
    several items name all of them. Item ids that are no whole numbers come as text. A null or empty text has no words. An empty benchmark hits nothing. Other columns pass
    unchanged; a column named ``result_col`` is replaced.
    """
    text_ids = not isinstance(benchmark.schema[item_col].dataType, IntegralType)
    out, found = docs, []
    for k, part in enumerate(_parts(benchmark, item_col, item_text_col, text_ids, max_bytes)):
        shared = docs.sparkSession.sparkContext.broadcast(WindowSet(part, window))
        found.append(blocks.free_name(out.columns, f"__{result_col}_{k}"))
        out = out.withColumn(found[-1], _scanner(shared, text_ids)(F.col(text_col)))
    if len(found) < 2:
        shared = shared if found else docs.sparkSession.sparkContext.broadcast(WindowSet([], window))
        return docs.withColumn(result_col, _scanner(shared, text_ids)(F.col(text_col)))

    schema, kind = _result_type(text_ids)

    @F.arrow_udf(schema)
    def joined(*results: pa.Array) -> pa.Array:
        rows = []
        for each in zip(*(r.to_pylist() for r in results)):
            spans = _merge([s for r in each for s in r["spans"]])
            rows.append({"n_words": each[0]["n_words"], "n_hit": sum(s["stop"] - s["start"] for s in spans), "items": sorted({i for r in each for i in r["items"]}), "spans": spans})
        return pa.array(rows, kind)

    return out.withColumn(result_col, joined(*(F.col(c) for c in found))).drop(*found)


def contaminated(result: str = "overlap", share: int = 20) -> F.Column:
    """Hit words exist and make at least one in ``share`` of all words."""
    r = F.col(result)
    return (r["n_hit"] > 0) & (F.lit(share) * r["n_hit"] >= r["n_words"])


def without_spans(text: F.Column, spans: F.Column) -> F.Column:
    """The text without the words of the hit spans and what stands between them; the rest stays as it is."""

    @F.arrow_udf("string")
    def remove(texts: pa.Array, cuts: pa.Array) -> pa.Array:
        out = []
        cuts = cuts.to_pylist()
        valid = texts.is_valid().to_pylist()
        for chunk in blocks.chunks(texts):
            found = None
            for row in range(chunk.rows):
                at = chunk.low + row
                body = chunk.text(row)
                if cuts[at]:
                    found = found or blocks.words(chunk, blocks.ALPHANUMERIC)
                    base, first, kept, last = chunk.offsets[row], found.first[row], [], 0
                    for s in cuts[at]:
                        kept.append(body[last : found.starts[first + s["start"]] - base])
                        last = found.ends[first + s["stop"] - 1] - base
                    body = b"".join([*kept, body[last:]])
                out.append(body if valid[at] else None)
        return pa.array(out, pa.binary()).cast(pa.string())

    return remove(text, spans)
