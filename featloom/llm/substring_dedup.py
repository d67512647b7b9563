"""Removal of long passages that an earlier document has, by difference-cover anchors.

A set D of residues modulo ``period`` is a difference cover if every difference
of two places is a difference of two members. So two equal windows of
``window`` words, wherever they stand in their documents, share an anchor of
``window - period + 1`` words whose place is in D in both. Only anchors are
gathered from the whole corpus (6 of 31 places); windows are hashed in full
only round an anchor that two documents share, which extends the anchor to
both sides word by word.

Steps, each a shuffle of packed numpy columns: anchors by hash; shared anchors
back to their documents; windows round them by hash; marked windows back to the
documents. A batch settles what it can by itself before anything moves, so a
passage in a third of all documents sends one entry for each batch. The
documents are shuffled once (the second use reads the same exchange).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks

WINDOW = 50
PERIOD = 31
#: Perfect difference cover modulo 31: fixed values, every difference occurs exactly once.
COVER_31 = (0, 1, 3, 8, 12, 18)

_PACKED = "bucket int, settled boolean, payload binary"
_BACK = "part int, payload binary"


def difference_cover(period: int) -> np.ndarray:
    """Residues whose differences reach every residue modulo ``period``."""
    if period == 31:
        return np.array(COVER_31)
    step = int(np.ceil(np.sqrt(period)))
    return np.unique(np.concatenate([np.arange(min(step, period)), np.arange(0, period, step)]))


def _pack(key: np.ndarray, check: np.ndarray, doc: np.ndarray, place: np.ndarray) -> bytes:
    """Columns in document order; ids and places as differences, which compress well."""
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order].astype(np.int64)
    rest = np.concatenate([np.diff(doc, prepend=0), np.diff(place, prepend=0)]).tobytes() + check[order].astype(np.uint32).tobytes()
    return len(key).to_bytes(8, "little") + key[order].tobytes() + pa.compress(rest, codec="zstd", asbytes=True)


def _unpack(payload: bytes, with_key: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(payload[:8], "little")
    key = np.frombuffer(payload, np.uint64, n, 8) if with_key else np.zeros(n, np.uint64)
    rest = pa.decompress(payload[8 + 8 * n * with_key :], decompressed_size=20 * n, codec="zstd", asbytes=True)
    doc, place = np.cumsum(np.frombuffer(rest, np.int64, n)), np.cumsum(np.frombuffer(rest, np.int64, n, 8 * n))
    return key, np.frombuffer(rest, np.uint32, n, 16 * n), doc, place


def _pack_places(doc: np.ndarray, place: np.ndarray) -> bytes:
    order = np.lexsort((place, doc))
    doc, place = doc[order], place[order].astype(np.int64)
    rest = np.concatenate([np.diff(doc, prepend=0), np.diff(place, prepend=0)]).tobytes() + bytes(4 * len(doc))
    return len(doc).to_bytes(8, "little") + pa.compress(rest, codec="zstd", asbytes=True)


def _groups(key: np.ndarray, check: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorting order, group of each sorted entry, smallest and largest document of each group."""
    order = np.lexsort((check, key)) if check.any() else np.argsort(key, kind="stable")
    k, c, d = key[order], check[order], doc[order]
    new = np.ones(len(k), bool)
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    begin = np.flatnonzero(new)
    return order, np.cumsum(new) - 1, np.minimum.reduceat(d, begin), np.maximum.reduceat(d, begin)


def _send(key, check, doc, place, parts: int, firsts: bool) -> Iterator[pa.RecordBatch]:
    """What one batch knows: settled entries, and the rest for the bucket of its hash.

    Anchors (``firsts`` false): a hash seen in two documents of the batch is settled, and one
    entry with place -1 tells its bucket. Windows: an entry of a document after the batch's first
    one is settled; only the first one's are sent on.
    """
    if not len(key):
        return
    order, group, low, high = _groups(key, check, doc)
    key, check, doc, place = key[order], check[order], doc[order], place[order]
    if firsts:
        done = doc > low[group]
        out = (key[~done], check[~done], doc[~done], place[~done])
    else:
        done = (low < high)[group]
        begin = np.flatnonzero(np.diff(group, prepend=-1))
        tell = begin[(low < high)]
        out = tuple(np.concatenate([a[~done], b]) for a, b in ((key, key[tell]), (check, check[tell]), (doc, doc[tell]), (place, np.full(len(tell), -1))))
    rows: list[tuple[int, bool, bytes]] = []
    if done.any():
        rows.append((int(doc[0] % parts), True, _pack_places(doc[done], place[done])))
    bucket = (out[0] % np.uint64(parts)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by], np.arange(parts + 1))
    for b in np.flatnonzero(np.diff(cuts)):
        own = by[cuts[b] : cuts[b + 1]]
        rows.append((int(b), False, _pack(*(x[own] for x in out))))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.bool_()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "settled", "payload"],
    )


def _settle(parts: int, firsts: bool) -> Callable[[pa.Table], pa.Table]:
    """All entries of one hash bucket: which of them are shared (anchors) or not the first (windows)."""

    def settle(table: pa.Table) -> pa.Table:
        done, sent = [], []
        for settled, payload in zip(table["settled"].to_pylist(), table["payload"].to_pylist()):
            if settled:
                done.append(_unpack(payload, with_key=False)[2:])
            else:
                sent.append(_unpack(payload))
        if sent:
            key, check, doc, place = (np.concatenate(x) for x in zip(*sent))
            order, group, low, high = _groups(key, check, doc)
            doc, place = doc[order], place[order]
            if firsts:
                hit = doc > low[group]
            else:
                known = np.zeros(len(low), bool)
                known[group[place < 0]] = True
                hit = ((low < high) | known)[group] & (place >= 0)
            done.append((doc[hit], place[hit]))
        doc, place = (np.concatenate(x) for x in zip(*done))
        part = doc % parts
        by = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by], np.arange(parts + 1))
        full = np.flatnonzero(np.diff(cuts))
        return pa.table(
            {
                "part": pa.array(full, pa.int32()),
                "payload": pa.array([_pack_places(doc[by[cuts[p] : cuts[p + 1]]], place[by[cuts[p] : cuts[p + 1]]]) for p in full], pa.binary()),
            }
        )

    return settle


class _Places:
    """Places by document, to be laid over the rows of a chunk."""

    def __init__(self, table: pa.Table):
        got = [_unpack(x, with_key=False)[2:] for x in table["payload"].to_pylist()]
        doc, place = (np.concatenate(x) for x in zip(*got)) if got else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        order = np.argsort(doc, kind="stable")
        self.doc, self.place = doc[order], place[order]

    def over(self, ids: np.ndarray, known: np.ndarray, found: blocks.Words) -> np.ndarray:
        """Word numbers in the chunk of all places of its rows; ``known`` is false for rows without an id."""
        low, high = np.searchsorted(self.doc, ids), np.searchsorted(self.doc, ids, side="right")
        count = np.where(known, high - low, 0)
        place = self.place[blocks.spread(low, count)]
        row = np.repeat(np.arange(len(ids)), count)
        keep = place < found.counts[row]
        return found.first[row[keep]] + place[keep]


def _ids(column) -> tuple[np.ndarray, np.ndarray]:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.fill_null(0).to_numpy(zero_copy_only=False), column.is_valid().to_numpy(zero_copy_only=False)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, period: int = PERIOD, parts: int | None = None) -> DataFrame:
    """Remove each word covered by a window of ``window`` words that also starts in a document with a smaller id.

    Returns (id, ``n_words``, ``n_removed``, ``kept_text``): one row for each input row, kept words
    joined by one space. Words are parted by ASCII blanks. Windows are judged on the input, not on
    what is left. A null or empty text has no words. Rows with the same id are judged alike and
    never against each other; a row without an id keeps its text and removes nothing. Texts shorter
    than a window are kept. Other columns of ``docs`` are not read. ``parts`` is the number of hash
    buckets (a prime from the session's shuffle partitions on); one bucket at a time is in memory, and a task
    sends at most one packed row to each.
    """
    if not 0 < period <= window:
        raise ValueError("period must be between 1 and window")
    spark = docs.sparkSession
    parts = blocks.prime_from(parts or int(spark.conf.get("spark.sql.shuffle.partitions")))
    anchor = window - period + 1
    at_cover = np.zeros(period, bool)
    at_cover[difference_cover(period)] = True

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, known = _ids(batch.column(0))
            got = []
            for chunk in blocks.chunks(batch.column(1)):
                found = blocks.words(chunk, blocks.BLANK_PARTED)
                at = blocks.whole_runs(found, anchor)
                row = found.row[at]
                at = at[at_cover[found.place[at] % period] & (found.counts[row] >= window) & known[chunk.low + row]]
                key = blocks.run_hashes(blocks.word_hashes(chunk, found), anchor)[at]
                got.append((key, ids[chunk.low + found.row[at]], found.place[at]))
            if got:
                key, doc, place = (np.concatenate(x) for x in zip(*got))
                yield from _send(key, np.zeros(len(key), np.uint32), doc, place, parts, firsts=False)

    def windows(left: pa.Table, right: pa.Table) -> pa.Table:
        shared, (ids, known), got = _Places(right), _ids(left["id"]), []
        if left.num_rows and len(shared.doc):
            for chunk in blocks.chunks(left["text"]):
                found = blocks.words(chunk, blocks.BLANK_PARTED)
                at = shared.over(ids[chunk.low : chunk.high], known[chunk.low : chunk.high], found)
                if not len(at):
                    continue
                from_ = np.maximum(at - (period - 1), found.first[found.row[at]])
                near = blocks.covered(len(found.row), from_, at + 1 - from_)
                at = blocks.whole_runs(found, window)
                at = at[near[at]]
                hashes = blocks.word_hashes(chunk, found)
                key = blocks.run_hashes(hashes, window)[at]
                check = (blocks.run_hashes(hashes, window, 1)[at] >> np.uint64(32)).astype(np.uint32)
                got.append((key, check, ids[chunk.low + found.row[at]], found.place[at]))
        batches = list(_send(*(np.concatenate(x) for x in zip(*got)), parts, firsts=True)) if got else []
        return pa.Table.from_batches(batches, pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), ("payload", pa.binary())]))

    def cut(left: pa.Table, right: pa.Table) -> pa.Table:
        marked, (ids, known) = _Places(right), _ids(left["id"])
        n_words, n_removed, kept = [], [], []
        if left.num_rows:
            for chunk in blocks.chunks(left["text"]):
                found = blocks.words(chunk, blocks.BLANK_PARTED)
                gone = blocks.covered(len(found.row), marked.over(ids[chunk.low : chunk.high], known[chunk.low : chunk.high], found), window)
                lost = np.bincount(found.row[gone], minlength=chunk.rows)
                n_words.append(found.counts)
                n_removed.append(lost)
                for row in range(chunk.rows):
                    own = chunk.text(row).split()
                    if lost[row]:
                        own = compress(own, ~gone[found.first[row] : found.first[row + 1]])
                    kept.append(b" ".join(own))
        numbers = lambda x: pa.array(np.concatenate(x) if x else np.zeros(0), pa.int64())
        return pa.table({"id": left["id"], "n_words": numbers(n_words), "n_removed": numbers(n_removed), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    laid = source.withColumn("part", F.coalesce(F.pmod("id", F.lit(parts)), F.pmod(F.xxhash64("text"), F.lit(parts))).cast("int")).groupBy("part")
    shared = source.mapInArrow(anchors, _PACKED).groupBy("bucket").applyInArrow(_settle(parts, False), _BACK)
    found = laid.cogroup(shared.groupBy("part")).applyInArrow(windows, _PACKED)
    marked = found.groupBy("bucket").applyInArrow(_settle(parts, True), _BACK)
    result = laid.cogroup(marked.groupBy("part")).applyInArrow(cut, "id long, n_words long, n_removed long, kept_text string")
    return result.withColumnRenamed("id", id_col)
