"""Similarity join on word n-grams with a MinHash LSH forest.

Every text becomes the set of its n-grams (hashed words, five at a time). Texts
with equal sets form one class of copies, represented by the smallest id. The
representatives' signatures make ``trees`` sorted prefix tries: at depth d, two texts meet in a trie if the
first d values of its signature agree, which happens with probability s**d at
similarity s. The search starts with deep prefixes, which only near-equal texts share,
links what it verifies, and shortens the prefix until the smallest depth
whose recall ``1 - (1 - s**d)**trees`` at the threshold reaches the target; groups that are linked already
count as one node there, so a group of near copies costs a link for each member, not for each pair. Every
link is verified on the exact n-gram sets.

A node's members are compared all with all if they are few; in a larger node every member is first compared with
``PIVOTS`` members picked by hash, other ones in every tree, which links most of what belongs together. Nodes that still
hold texts of several classes are then compared whole, block by block, on the exact sets, so no pair that meets in
a trie goes unseen. The links of each class are counted over the same kind of blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featloom.llm import blocks
from featloom.llm.graph import components
from featloom.workspace import materialise

NGRAM = 5
THRESHOLD = 0.8
TARGET_RECALL = 0.999
TREES = 14
DEEP = 7
PIVOTS = 4
FEW = 8
#: Most texts and about the most bytes of text in a block; two blocks at a time are in memory.
BLOCK = 128
BLOCK_BYTES = 4 << 20
#: Columns of the incidence matrix that are multiplied at once.
_COLUMNS = 1 << 13


def smallest_depth(threshold: float, trees: int, recall: float) -> int:
    """The longest prefix that still reaches the recall for pairs at the threshold."""
    depth = 1
    while 1 - (1 - threshold ** (depth + 1)) ** trees >= recall:
        depth += 1
    if 1 - (1 - threshold**depth) ** trees < recall:
        raise ValueError(f"{trees} trees can't reach a recall of {recall} at similarity {threshold}")
    return depth


def ngrams(chunk: blocks.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram hashes of a chunk's rows, in the order of rows and hashes; a text of fewer words is one n-gram."""
    found = blocks.words(chunk, blocks.BLANK_PARTED)
    hashes = blocks.word_hashes(chunk, found)
    at = blocks.whole_runs(found, n)
    keys, rows = [blocks.run_hashes(hashes, n)[at]], [found.row[at]]
    for row in np.flatnonzero((found.counts < n) & (found.counts > 0)):
        keys.append(blocks.run_hashes(hashes[found.first[row] : found.first[row + 1]], int(found.counts[row])))
        rows.append(np.array([row]))
    key, row = np.concatenate(keys), np.concatenate(rows)
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    return key[new], row[new]


def _sets(texts: list[bytes], n: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for chunk in blocks.chunks(pa.array(texts, pa.binary()).cast(pa.string())):
        key, row = ngrams(chunk, n)
        out += np.split(key, np.searchsorted(row, np.arange(1, chunk.rows)))
    return out


def _similarity(a: np.ndarray, b: np.ndarray) -> float:
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small):
        return 0.0
    at = np.minimum(np.searchsorted(large, small), len(large) - 1)
    both = int((large[at] == small).sum())
    return both / (len(a) + len(b) - both)


def _signatures(docs: DataFrame, n: int, trees: int, depths: list[int]) -> DataFrame:
    """(id, hash of the text, set hash in two parts, for each depth the prefix hash in each tree); texts without words are left out."""
    deepest = max(depths)
    rng = np.random.Generator(np.random.PCG64(11))
    shift = rng.integers(0, 1 << 63, trees * deepest, dtype=np.uint64)
    factor = rng.integers(0, 1 << 63, trees * deepest, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for chunk in blocks.chunks(batch.column(1)):
                key, row = ngrams(chunk, n)
                begin = np.flatnonzero(np.diff(row, prepend=-1))
                own = row[begin]
                if not len(own):
                    continue
                high = np.add.reduceat(blocks.mix(key ^ np.uint64(0x5851F42D4C957F2D)), begin)
                low = np.add.reduceat(blocks.mix(key + np.uint64(0x14057B7EF767814F)), begin)
                values = np.empty((len(own), trees * deepest), np.uint64)
                for k in range(trees * deepest):
                    values[:, k] = np.minimum.reduceat((key ^ shift[k]) * factor[k], begin)
                values = values.reshape(len(own), trees, deepest)
                state = np.broadcast_to(np.arange(trees, dtype=np.uint64), (len(own), trees))
                levels = {}
                for d in range(deepest):
                    state = blocks.mix(state * np.uint64(0x2127599BF4325C37) + values[:, :, d])
                    levels[d + 1] = state
                at = pa.array(chunk.low + own)
                columns = [ids.take(at), batch.column(2).take(at), pa.array(high.view(np.int64)), pa.array(low.view(np.int64))]
                for d in depths:
                    flat = pa.array(levels[d].view(np.int64).ravel())
                    columns.append(pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * trees), flat))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "text_hash", "set_a", "set_b", *(f"d{d}" for d in depths)])

    return docs.mapInArrow(run, "id long, text_hash long, set_a long, set_b long, " + ", ".join(f"d{d} array<long>" for d in depths))


def _compressed(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, body = [], []
            for chunk in blocks.chunks(batch.column(1)):
                for r in range(chunk.rows):
                    plain = b" ".join(chunk.text(r).split())
                    size.append(len(plain))
                    body.append(pa.compress(plain, codec="zstd", asbytes=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(size, pa.int64()), pa.array(body, pa.binary())], names=["id", "text_hash", "bytes", "body"])

    return docs.mapInArrow(run, "id long, text_hash long, bytes long, body binary")


def _plain(body: bytes, size: int) -> bytes:
    return pa.decompress(body, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _verified(pairs: DataFrame, bodies: DataFrame, n: int, threshold: float) -> DataFrame:
    """The pairs (a, b) whose n-gram sets are similar enough; the text of b meets that of a once for each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512).to_pydict()
                texts: dict[int, bytes] = {}
                for side in "ab":
                    for i, size, body in zip(part[side], part[f"{side}_bytes"], part[f"{side}_body"]):
                        if i not in texts:
                            texts[i] = _plain(body, size)
                sets = dict(zip(texts, _sets(list(texts.values()), n)))
                like = [_similarity(sets[a], sets[b]) for a, b in zip(part["a"], part["b"])]
                keep = [i for i, s in enumerate(like) if s >= threshold]
                yield pa.RecordBatch.from_arrays([pa.array([part["a"][i] for i in keep], pa.int64()), pa.array([part["b"][i] for i in keep], pa.int64()), pa.array([like[i] for i in keep], pa.float64())], names=["a", "b", "similarity"])

    side = lambda s: bodies.select(F.col("id").alias(s), F.col("bytes").alias(f"{s}_bytes"), F.col("body").alias(f"{s}_body"))
    return pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "a_bytes", "a_body", "b_bytes", "b_body").mapInArrow(run, "a long, b long, similarity double")


def _pairs(cells: DataFrame) -> DataFrame:
    """Pairs (a < b) to verify from the members (key, id, label) of the tries' nodes; members of one label are one node."""
    cells = materialise(cells.groupBy("key", "label").agg(F.min("id").alias("id")), "cells")
    pick = [F.min(F.struct(F.xxhash64("key", "label", F.lit(p)).alias("h"), "label", "id")).alias(f"p{p}") for p in range(1, PIVOTS)]
    least = F.min(F.struct(F.lit(0).cast("long").alias("h"), "label", "id")).alias("p0")
    nodes = cells.groupBy("key").agg(F.count("*").alias("n"), least, *pick).where("n > 1")
    nodes = materialise(nodes, "nodes")
    joined = cells.join(nodes, "key")
    few = joined.where(F.col("n") <= FEW).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    every = few.select(F.explode(F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, i + 2, size(ids)), y -> struct(x as a, y as b))))")).alias("p")).select("p.a", "p.b")
    some = joined.where(F.col("n") > FEW).select("id", "label", F.explode(F.array(*(f"p{p}" for p in range(PIVOTS)))).alias("p")).where(F.col("p.label") != F.col("label"))
    return every.union(some.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b"))).distinct()


def _in_blocks(members: DataFrame, bodies: DataFrame) -> DataFrame:
    """Members (key, id, label) with their texts in units (key, low, high) of one or two blocks; every two blocks of a key are one unit."""
    sizes = members.join(bodies.select("id", "bytes"), "id").groupBy("key").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("bytes") / BLOCK_BYTES), F.lit(1)).cast("long").alias("n_blocks"))
    laid = members.join(sizes, "key").withColumn("block", F.pmod(F.xxhash64("id", "key"), F.col("n_blocks")))
    units = laid.select("key", "id", "label", "block", F.explode(F.expr("sequence(0L, n_blocks - 1)")).alias("other"))
    return units.select("key", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "id", "label", "block").join(bodies, "id")


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """Number of common n-grams of every two sets, by products of slices of their incidence matrix."""
    grams, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    common = times > 1
    keep = common[column]
    row, column = row[keep], (np.cumsum(common) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    shared = np.zeros((len(sets), len(sets)))
    n_columns = int(common.sum())
    for low in range(0, n_columns, _COLUMNS):
        begin, stop = np.searchsorted(column, [low, low + _COLUMNS])
        part = np.zeros((len(sets), min(_COLUMNS, n_columns - low)), np.float32)
        part[row[begin:stop], column[begin:stop] - low] = 1
        shared += part @ part.T
    return shared


def _unit_links(table: pa.Table, n: int, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids and labels of a unit in the order of ids, and its linked pairs (places in that order) that no other unit of the key has."""
    order = np.argsort(table["id"].to_numpy(), kind="stable")
    ids, label, block = (table[c].to_numpy()[order] for c in ("id", "label", "block"))
    size, body = table["bytes"].to_numpy(), table["body"]
    sets = _sets([_plain(body[int(i)].as_py(), int(size[i])) for i in order], n)
    shared, size = _shared(sets), np.array([len(x) for x in sets])
    alike = shared >= 1
    alike[alike] = (shared / np.maximum(size[:, None] + size[None] - shared, 1))[alike] >= threshold
    if table["low"][0].as_py() != table["high"][0].as_py():
        alike &= block[:, None] != block[None]
    return ids, label, *np.nonzero(np.triu(alike, 1))


def _class_links(nodes: DataFrame, bodies: DataFrame, n: int, threshold: float) -> DataFrame:
    """Links (a, b) of classes that share a node (key, id, label): in each unit just enough to connect them."""

    def connect(table: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if len(set(table["label"].to_pylist())) > 1:
            _, label, i, j = _unit_links(table, n, threshold)
            root: dict[int, int] = {}

            def top(x: int) -> int:
                while (up := root.get(x, x)) != x:
                    x = up
                return x

            for x, y in zip(label[i].tolist(), label[j].tolist()):
                x, y = top(x), top(y)
                if x != y:
                    root[max(x, y)] = min(x, y)
                    found.append((x, y))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return _in_blocks(nodes, bodies).groupBy("key", "low", "high").applyInArrow(connect, "a long, b long")


def _number_of_links(classes: DataFrame, bodies: DataFrame, n: int, threshold: float) -> DataFrame:
    """(id, n_links) over all pairs of each class (key, id, label); texts without a link are left out."""

    def count(table: pa.Table) -> pa.Table:
        ids, _, i, j = _unit_links(table, n, threshold)
        links = np.bincount(np.concatenate([i, j]), minlength=len(ids))
        return pa.table({"id": pa.array(ids[links > 0], pa.int64()), "n_links": pa.array(links[links > 0], pa.int64())})

    by_unit = _in_blocks(classes, bodies).groupBy("key", "low", "high").applyInArrow(count, "id long, n_links long")
    return by_unit.groupBy("id").agg(F.sum("n_links").alias("n_links"))


def _of_classes(links: DataFrame, classes: DataFrame) -> DataFrame:
    """The links (a, b) of texts as links of their classes (id, label)."""
    side = lambda s: classes.select(F.col("id").alias(s), F.col("label").alias(f"{s}_label"))
    return links.join(side("a"), "a").join(side("b"), "b").select(F.col("a_label").alias("a"), F.col("b_label").alias("b"))


def _merged(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes (id, label) after links (a, b) of labels; a class keeps its smallest label."""
    merged = components(links).withColumnsRenamed({"id": "label", "component": "merged"})
    return materialise(classes.join(merged, "label", "left").select("id", F.coalesce("merged", "label").alias("label")), "classes")


def _mixed_nodes(cells: DataFrame) -> DataFrame:
    """The members (key, id, label) of nodes that hold several classes and were not compared all with all; equal nodes of several trees once."""
    parts = cells.groupBy("key", "label").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("id")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "id")).alias("y"))
    nodes = parts.groupBy("key").agg(F.count("*").alias("labels"), F.sum("n").alias("n"), F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    mixed = nodes.where((F.col("labels") > 1) & ((F.col("n") > F.col("labels")) | (F.col("labels") > FEW)))
    return cells.join(mixed.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"), "key")


def _numbered(sets: DataFrame) -> DataFrame:
    """Sets with ``copy_of`` and a number ``id``: the smallest id of their rows, and where several sets have that id, a hash of the set for all but one."""
    sets = materialise(sets.withColumn("copy_of", F.col("first.id")), "sets")
    of_one_id = sets.groupBy("copy_of").agg(F.count("*").alias("n"), F.min(F.struct("set_a", "set_b")).alias("keeps")).where("n > 1").select("copy_of", "keeps")
    own = F.col("keeps").isNull() | (F.struct("set_a", "set_b") == F.col("keeps"))
    return sets.join(of_one_id, "copy_of", "left").withColumn("id", F.when(own, F.col("copy_of")).otherwise(F.xxhash64("set_a", "set_b"))).drop("keeps")


def ngram_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = NGRAM, threshold: float = THRESHOLD, recall: float = TARGET_RECALL, trees: int = TREES, deep: int = DEEP
) -> DataFrame:
    """One row per document: id, ``class_id``, ``copy_of``, ``n_copies``, ``n_links``.

    Two texts are linked if the Jaccard similarity of their sets of ``n`` consecutive words is ``threshold`` or more.
    ``copy_of`` is the smallest id with an equal set, ``n_copies`` the number of such rows; ``class_id`` is the smallest
    id reachable over links and copies; ``n_links`` the number of different texts (sets) of its class linked with this one. A text of fewer than ``n`` words, but some, is one n-gram.
    A null or empty text, or one without words, is a class of its own without links. A null id gets null columns and joins nothing. Equal rows
    are copies. Rows of one id with different texts are judged each by its own text, so classes that have nothing else in common may
    bear the same id. Other columns are not read.
    """
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    known = source.where("id is not null and text is not null").withColumn("text_hash", F.xxhash64("text"))
    least = smallest_depth(threshold, trees, recall)
    depths = [max(deep, least), least] if deep > least else [least]
    signed = materialise(_signatures(known, n, trees, depths), "signed")
    sets = materialise(_numbered(signed.groupBy("set_a", "set_b").agg(F.min(F.struct("id", "text_hash")).alias("first"), F.count("*").alias("n_copies"))), "sets")
    members = materialise(signed.select(F.col("id").alias("own"), "set_a", "set_b").join(sets, ["set_a", "set_b"]).select("own", "id", "copy_of", "n_copies"), "members")
    # From here on ``id`` is the number of a set; its text is that of the row ``copy_of`` with the hash ``text_hash``.
    ours = sets.select("id", F.col("copy_of").alias("row_id"), F.col("first.text_hash").alias("text_hash"), "set_a", "set_b")
    prefixes = signed.select(F.col("id").alias("row_id"), "text_hash", "set_a", "set_b", *(f"d{d}" for d in depths))
    first = ours.join(prefixes, ["row_id", "text_hash", "set_a", "set_b"]).dropDuplicates(["id"])
    first = materialise(first.select("id", "row_id", "text_hash", *(f"d{d}" for d in depths)), "first")

    shared = first.select("id", F.explode(f"d{least}").alias("key"))
    often = shared.groupBy("key").count().where("count > 1").select("key")
    candidates = shared.join(often, "key", "left_semi").select("id").distinct()
    candidates = materialise(candidates, "candidates")
    wanted = materialise(first.select("id", "row_id", "text_hash").join(candidates, "id", "left_semi"), "wanted")
    # Row ids alone are a smaller table than the wanted rows; where Spark finds it small enough, the other texts are not shuffled.
    row_ids = materialise(wanted.select("row_id").distinct(), "row_ids")
    texts = _compressed(known).withColumnRenamed("id", "row_id").join(row_ids, "row_id", "left_semi").join(wanted, ["row_id", "text_hash"])
    once = texts.select("id", "bytes", "body").dropDuplicates(["id"])
    bodies = materialise(once, "bodies")

    known_class = candidates.select("id", F.col("id").alias("label"))
    for d in depths:
        cells = first.join(known_class, "id").select("id", "label", F.explode(f"d{d}").alias("key"))
        found = materialise(_verified(_pairs(cells), bodies, n, threshold), "verified")
        known_class = _merged(known_class, _of_classes(found, known_class))

    cells = materialise(first.select("id", F.explode(f"d{least}").alias("key")).join(known_class, "id"), "cells")
    joined = materialise(_class_links(materialise(_mixed_nodes(cells), "mixed"), bodies, n, threshold), "joined")
    classes = _merged(known_class, joined).withColumnRenamed("label", "key")
    several = classes.groupBy("key").count().where("count > 1").select("key")
    n_links = _number_of_links(classes.join(several, "key").withColumn("label", F.col("key")), bodies, n, threshold)
    # A class is named by the smallest id of its rows.
    named = classes.join(sets.select("id", "copy_of"), "id").groupBy("key").agg(F.min("copy_of").alias("class"))
    by_text = classes.join(n_links, "id", "left").join(named, "key").select("id", "class", "n_links")
    found = members.join(materialise(by_text, "by_text"), "id", "left").select(F.col("own").alias("id"), F.coalesce("class", "copy_of").alias("class_id"), "copy_of", "n_copies", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    rest = source.where("id is null or text is null or not text rlike '[^ \\\\t-\\\\r]'").select("id", F.col("id").alias("class_id"), F.col("id").alias("copy_of"), F.lit(1).cast("long").alias("n_copies"), F.lit(0).cast("long").alias("n_links"))
    return found.union(rest).withColumnRenamed("id", id_col)


def keep_one(docs: DataFrame, joined: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the documents of a class other than its smallest id; rows without an id stay. Columns pass unchanged.

    Rows of one id go or stay together: they stay if one of them is the kept one of its class.
    """
    lost = blocks.free_name(docs.columns, "__gone")
    gone = joined.groupBy(F.col(id_col).alias(lost)).agg(F.min(F.col("class_id") != F.col(id_col)).alias("all_gone")).where("all_gone").select(lost)
    return docs.join(gone, docs[id_col] == F.col(lost), "left_anti")
