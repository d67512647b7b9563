"""Prefix trie of conversations from sorted matrices of turn ids.

A turn is the 64-bit hash of its role and text, a conversation the row of its turns' ids. Spark sorts the rows over range
partitions, by ids and then by conversation, so that a prefix or a whole conversation that a third of all rows share is dealt over
many tasks. A task takes its rows in blocks of bounded padded size. In a block the ids form a padded matrix; ``numpy``'s
lexsort orders it, the columns' changes against the row above, OR-ed from left to right, mark where the nodes of each depth
start, and ``reduceat`` over those starts gives members, children, leaves and saved tokens of every node of a depth at once.

Nodes on the path of a block's first or last row may go on in the neighbouring blocks. Only these boundary nodes are recombined:
two paths a block, sorted as the blocks are, form a small matrix of the same kind, in which the blocks' partial values are added up. A node inside
a block whose parent lies on the boundary learns its parent's name by an equality join on block and depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featloom.workspace import materialise

PAD = -(1 << 63)
#: Most cells of a block's padded matrix (a single longer row is a block of its own).
BLOCK_CELLS = 1 << 20
_FAR = (1 << 63) - 1


def turn_sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(``conv_id``, ``ids``, ``chars``): each conversation's turn ids and text lengths in code points, in the order of ``turn_col``.

    A null turn comes first; a null role or text counts as empty. Turns of the same number go by length and id, so
    repeated rows stay and their order does not matter. Rows without a conversation are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    one = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv_id"),
        F.struct(F.col(turn_col).alias("turn"), F.length(text).alias("chars"), F.greatest(F.xxhash64(role, text), F.lit(PAD + 1)).alias("id")).alias("t"),
    )
    listed = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return listed.select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))


def share_heads(sequences: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """Each sequence with its first ``head`` turns replaced by those of the conversation ``base`` (none if that is absent); ``head`` is at most ``most``."""
    heads = sequences.select(F.col("conv_id").alias("base"), *(F.slice(c, 1, most).alias(f"base_{c}") for c in ("ids", "chars")))
    named = sequences.withColumns({"base": base, "head": head})
    # A base is one of few conversations: the others drop out before the join.
    heads = heads.join(named.select("base").distinct(), "base", "left_semi")
    joined = named.join(heads, "base", "left")
    none = {"ids": F.array().cast("array<long>"), "chars": F.array().cast("array<int>")}

    def both(c: str) -> Column:
        first = F.slice(F.coalesce(F.col(f"base_{c}"), none[c]), F.lit(1), F.col("head"))
        own = F.when(F.size(c) > F.col("head"), F.slice(c, F.col("head") + 1, F.greatest(F.size(c) - F.col("head"), F.lit(0)))).otherwise(none[c])
        return F.concat(first, own).alias(c)

    return joined.select("conv_id", both("ids"), both("chars"))


class _Rows(NamedTuple):
    """Sorted rows of a padded matrix and what follows from them."""

    ids: np.ndarray
    length: np.ndarray
    starts: list[np.ndarray]  # by depth: the rows at which the first ``depth`` columns change

    def valid(self, depth: int) -> np.ndarray:
        """The starts of nodes; a change to a shorter row starts none."""
        begin = self.starts[depth]
        return begin[self.length[begin] >= depth]


def _padded(lists: list[np.ndarray], fill: int) -> np.ndarray:
    width = max(map(len, lists), default=0)
    out = np.full((len(lists), width), fill, np.int64)
    for row, own in zip(out, lists):
        row[: len(own)] = own
    return out


def _rows(ids: np.ndarray, length: np.ndarray) -> _Rows:
    change = np.zeros(ids.shape, bool)
    change[1:] = np.logical_or.accumulate(ids[1:] != ids[:-1], axis=1)
    change[:1] = True
    return _Rows(ids, length, [np.zeros(1, np.int64), *(np.flatnonzero(change[:, d]) for d in range(ids.shape[1]))])


def _common(ids: np.ndarray, length: np.ndarray, row: int) -> np.ndarray:
    """How many first turns each row shares with ``row``."""
    same = np.logical_and.accumulate(ids == ids[row], axis=1).sum(axis=1) if ids.shape[1] else np.zeros(len(ids), np.int64)
    return np.minimum(same, np.minimum(length, length[row]))


def _lasting(begin: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(begin, n))


def block_nodes(conv: np.ndarray, lists: list[np.ndarray], chars: list[np.ndarray]) -> tuple[dict, list[dict]]:
    """The nodes of one block: columns of those inside it, and the paths of its first and last row.

    Inside nodes are final but for the parent where it lies on a path: ``parent_side`` is then 0 or 1, else -1. A path has
    one entry for each depth (on the second, only below the common part): the rows of the block under the node, its smallest conversation, its inside
    children, leaves and saved tokens of the inside nodes right under it (not of those under a deeper path node), and the conversations that end there.
    """
    ids, length = _padded(lists, PAD), np.array([len(x) for x in lists], np.int64)
    order = np.lexsort((conv, *ids.T[::-1])) if ids.shape[1] else np.argsort(conv, kind="stable")
    conv, ids, length, size = conv[order], ids[order], length[order], _padded(chars, 0)[order]
    m, deepest = len(conv), ids.shape[1]
    rows = _rows(ids, length)
    first, last = _common(ids, length, 0), _common(ids, length, m - 1)
    edge, side = np.maximum(first, last), (last > first).astype(np.int64)
    leaves, saved = np.zeros(m, np.int64), np.zeros(m, np.int64)
    paths = [{k: np.zeros(deepest + 1, np.int64) for k in ("n", "conv", "children", "leaves", "saved", "chars")} | {"ends": [None] * (deepest + 1)} for _ in range(2)]
    names = ("depth", "conv_id", "parent", "parent_side", "n_convs", "n_children", "n_leaves", "saved_tokens")
    found: dict[str, list] = {k: [] for k in (*names, "ends")}
    for d in range(deepest, -1, -1):
        begin = rows.starts[d]
        real = length[begin] >= d
        n, least = _lasting(begin, m), np.minimum.reduceat(conv, begin)
        below = np.zeros(m, np.int64)
        if d < deepest:
            below[rows.valid(d + 1)] = 1
        children = np.add.reduceat(below, begin)
        ending = np.add.reduceat((length == d).astype(np.int64), begin)
        inside = real & (edge[begin] < d)
        at = begin[inside]
        own = (n[inside] - 1) * (size[at, d - 1] if d else 0)
        leaves[at] += children[inside] == 0
        saved[at] += own
        # What lies right under a path node is handed to it, too.
        for s in (0, 1):
            mine = inside & (side[begin] == s)
            here = begin[mine]
            for name, value in (("leaves", (children[mine] == 0).astype(np.int64)), ("saved", own[side[at] == s])):
                np.add.at(paths[s][name], edge[here], value)
            np.add.at(paths[s]["children"], edge[here][edge[here] == d - 1], 1)
        if len(at):
            above = np.repeat(np.minimum.reduceat(conv, rows.starts[d - 1]), _lasting(rows.starts[d - 1], m))[at]
            on_path = edge[at] == d - 1
            values = (np.full(len(at), d), least[inside], above, np.where(on_path, side[at], -1), n[inside], children[inside], np.add.reduceat(leaves, begin)[inside], np.add.reduceat(saved, begin)[inside])
            for k, v in zip(names, values):
                found[k].append(v)
            found["ends"] += [conv[x : x + k] for x, k in zip(at, ending[inside])]
        for s, row in ((0, 0), (1, m - 1)):
            if length[row] >= d and (s == 0 or d > first[m - 1]):
                k = np.searchsorted(begin, row, side="right") - 1
                x = begin[k]
                paths[s]["n"][d], paths[s]["conv"][d], paths[s]["chars"][d] = n[k], least[k], size[x, d - 1] if d else 0
                paths[s]["ends"][d] = conv[x : x + ending[k]]
    inner = {k: np.concatenate(found[k]) if found[k] else np.zeros(0, np.int64) for k in names} | {"ends": found["ends"]}
    out = []
    for s, row in ((0, 0), (1, m - 1)):
        low, high = (0, length[0]) if s == 0 else (first[m - 1] + 1, length[row])
        if low <= high:
            out.append({k: v[low : high + 1] for k, v in paths[s].items()} | {"side": s, "low": int(low), "ids": ids[row, : length[row]]})
    return inner, out


def recombine(paths: list[dict]) -> dict[str, np.ndarray]:
    """The boundary nodes of all blocks from their paths, which stand in the order of the blocks.

    One entry for each path and depth it reports: ``path`` (its place in the list), ``depth``, ``conv_id`` of the whole node, and,
    where ``starts`` is set (once for each node), the node's final values.
    """
    length = np.array([len(p["ids"]) for p in paths], np.int64)
    low = np.array([p["low"] for p in paths], np.int64)
    rows = _rows(_padded([p["ids"] for p in paths], PAD), length)
    m, deepest = len(paths), rows.ids.shape[1]

    def column(name: str, d: int, missing: int = 0) -> np.ndarray:
        return np.array([p[name][d - lo] if lo <= d <= n else missing for p, lo, n in zip(paths, low, length)], np.int64)

    leaves, saved = np.zeros(m, np.int64), np.zeros(m, np.int64)
    out: dict[str, list] = {k: [] for k in ("path", "depth", "conv_id", "starts", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens")}
    smallest = [np.minimum.reduceat(column("conv", d, _FAR), rows.starts[d]) for d in range(deepest + 1)]
    for d in range(deepest, -1, -1):
        begin = rows.starts[d]
        real = length[begin] >= d
        n = np.add.reduceat(column("n", d), begin)
        below = np.zeros(m, np.int64)
        if d < deepest:
            below[rows.valid(d + 1)] = 1
        children = np.add.reduceat(below + column("children", d), begin)
        leaves += column("leaves", d)
        saved += column("saved", d)
        leaves[begin[real & (children == 0)]] += 1
        # Every path of a node knows the length of its last text; the first one that reports the node has it.
        chars = np.maximum.reduceat(column("chars", d), begin)
        saved[begin[real]] += ((n - 1) * chars)[real]
        all_leaves, all_saved = np.add.reduceat(leaves, begin), np.add.reduceat(saved, begin)
        node = np.repeat(np.arange(len(begin)), _lasting(begin, m))
        told = np.flatnonzero((low <= d) & (length >= d))
        mine = node[told]
        if d:
            up = np.repeat(smallest[d - 1], _lasting(rows.starts[d - 1], m))
        values = {"path": told, "depth": np.full(len(told), d), "conv_id": smallest[d][mine], "starts": told == begin[mine], "parent": up[told] if d else np.full(len(told), -1)}
        values |= {"n_convs": n[mine], "n_children": children[mine], "n_leaves": all_leaves[mine], "saved_tokens": all_saved[mine]}
        for k, v in values.items():
            out[k].append(v)
    return {k: np.concatenate(v) for k, v in out.items()}


_PATH = ("n", "conv", "children", "leaves", "saved", "chars")
_PATH_TYPE = f"struct<low:int, ids:array<long>, {', '.join(f'{k}:array<long>' for k in _PATH)}>"
_SHARD = f"shard long, side int, depth int, conv_id long, parent long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends array<long>, path {_PATH_TYPE}, path_ends array<array<long>>"
_LONGS = pa.list_(pa.int64())
_PATH_ARROW = pa.struct([("low", pa.int32()), ("ids", _LONGS), *((k, _LONGS) for k in _PATH)])
_SHARD_ARROW = pa.schema(
    [("shard", pa.int64()), ("side", pa.int32()), ("depth", pa.int32()), *((k, pa.int64()) for k in ("conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends", _LONGS), ("path", _PATH_ARROW), ("path_ends", pa.list_(_LONGS))]
)


def _blocks(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[tuple[np.ndarray, list, list]]:
    """The sorted rows of a task, cut so that rows times the longest row stays within ``cells``."""
    conv, ids, chars, longest = [], [], [], 1

    def numbers(column: pa.Array) -> list[np.ndarray]:
        flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:])]

    for batch in batches:
        for c, i, n in zip(batch.column(0).to_pylist(), numbers(batch.column(1)), numbers(batch.column(2))):
            if conv and (len(conv) + 1) * max(longest, len(i)) > cells:
                yield np.array(conv, np.int64), ids, chars
                conv, ids, chars, longest = [], [], [], 1
            conv.append(c)
            ids.append(i)
            chars.append(n)
            longest = max(longest, len(i))
    if conv:
        yield np.array(conv, np.int64), ids, chars


def _shard_stage(cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        for conv, ids, chars in _blocks(batches, cells):
            inner, paths = block_nodes(conv, ids, chars)
            n = len(inner["depth"])
            values = [np.full(n, number), inner["parent_side"], *(inner[k] for k in ("depth", "conv_id", "parent", "n_convs", "n_children", "n_leaves", "saved_tokens"))]
            for low in range(0, n, 1 << 14):
                part = slice(low, low + (1 << 14))
                rows = len(values[0][part])
                columns = [pa.array(v[part], f.type) for v, f in zip(values, _SHARD_ARROW)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(inner["ends"][part], _LONGS), pa.nulls(rows, _PATH_ARROW), pa.nulls(rows, pa.list_(_LONGS))], schema=_SHARD_ARROW)
            rows = [{"shard": number, "side": p["side"], "path": {k: p[k] for k in ("low", "ids", *_PATH)}, "path_ends": p["ends"]} for p in paths]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_SHARD_ARROW)
            number += 1

    return run


_NODE = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def _recombine_stage(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, paths = [], []
    for batch in batches:
        for shard, side, path in zip(*(batch.column(k).to_pylist() for k in range(3))):
            keys.append((shard, side))
            paths.append({k: np.array(v, np.int64) if k != "low" else v for k, v in path.items()})
    if paths:
        out = recombine(paths)
        shard, side = (np.array([k[i] for k in keys], np.int64)[out["path"]] for i in (0, 1))
        parent = pa.array(out["parent"], pa.int64(), mask=out["depth"] == 0)
        columns = [pa.array(shard), pa.array(side, pa.int32()), pa.array(out["depth"], pa.int32()), pa.array(out["conv_id"]), pa.array(out["starts"]), parent, *(pa.array(out[k]) for k in _NODE)]
        yield pa.RecordBatch.from_arrays(columns, names=["shard", "side", "depth", "conv_id", "starts", "parent_conv_id", *_NODE])


class Trie(NamedTuple):
    """``nodes``: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends``, the
    conversations of just ``depth`` turns in rising order; null if they are dealt over several blocks: ``parts`` then has
    them as (``conv_id``, ``depth``, ``part``, ``ends``), no rows if there are none."""

    nodes: DataFrame
    parts: DataFrame


def prefix_trie(sequences: DataFrame, cells: int = BLOCK_CELLS) -> Trie:
    """All nodes of the trie of ``sequences`` (``conv_id`` unique and not null, ``ids``, ``chars``).

    A node is a distinct sequence of first turns, from the root of depth 0; its members are the conversations that start with it, also
    those without turns. ``saved_tokens`` adds up, over the nodes of the subtree, (members - 1) times the code points of the node's
    last text. Equal ids count as equal turns. A conversation's ids stand in one row (12 bytes a turn). An empty table gives no nodes.
    """
    ordered = materialise(sequences.select("conv_id", "ids", "chars"), "sequences").repartitionByRange("ids", "conv_id").sortWithinPartitions("ids", "conv_id")
    found = materialise(ordered.mapInArrow(_shard_stage(cells), _SHARD), "trie")
    paths = found.where("path is not null").select("shard", "side", "path").repartition(1).sortWithinPartitions("shard", "side")
    edges = materialise(paths.mapInArrow(_recombine_stage, "shard long, side int, depth int, conv_id long, starts boolean, parent_conv_id long, " + ", ".join(f"{k} long" for k in _NODE)), "edges")
    inner = found.where("path is null")
    above = edges.select("shard", "side", (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above"))
    near = inner.where("side >= 0").join(above, ["shard", "side", "depth"]).withColumn("parent", F.col("above"))
    tidy = lambda df: df.select("conv_id", "depth", F.col("parent").alias("parent_conv_id"), *_NODE, "ends")
    whole = edges.where("starts").select("conv_id", "depth", "parent_conv_id", *_NODE, F.lit(None).cast("array<long>").alias("ends"))
    ends = found.where("path is not null").select("shard", "side", F.col("path.low").alias("low"), F.posexplode("path_ends").alias("k", "ends")).where("size(ends) > 0")
    ends = ends.select("shard", "side", (F.col("low") + F.col("k")).alias("depth"), "ends").join(edges.select("shard", "side", "depth", "conv_id"), ["shard", "side", "depth"])
    parts = ends.select("conv_id", "depth", (F.col("shard") * 2 + F.col("side")).alias("part"), "ends")
    return Trie(tidy(inner.where("side < 0")).unionByName(tidy(near)).unionByName(whole), parts)


def _joined_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, digest, out = None, None, []
    for batch in batches:
        for conv, depth, ends in zip(*(batch.column(k) for k in range(3))):
            text = ",".join(map(str, ends.as_py())).encode()
            if (conv.as_py(), depth.as_py()) == key:
                digest.update(b"," + text)
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = (conv.as_py(), depth.as_py()), hashlib.sha256(text)
        if len(out) > 1024:
            yield _digest_rows(out)
            out = []
    if key is not None:
        out.append((*key, digest.hexdigest()))
    if out:
        yield _digest_rows(out)


def _digest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.string()))]
    return pa.RecordBatch.from_arrays(columns, names=["conv_id", "depth", "digest"])


def with_end_digests(trie: Trie) -> DataFrame:
    """The nodes with ``ends_sha256``: lowercase SHA-256 of ``ends``, in decimal and comma-joined, in place of the list.

    The parts of a split list are hashed one after the other as a sorted stream, so none is ever put together.
    """
    inside = trie.nodes.where("ends is not null").withColumn("ends_sha256", F.sha2(F.array_join(F.col("ends").cast("array<string>"), ","), 256)).drop("ends")
    streamed = trie.parts.repartition("conv_id", "depth").sortWithinPartitions("conv_id", "depth", "part").select("conv_id", "depth", "ends")
    digests = streamed.mapInArrow(_joined_digests, "conv_id long, depth int, digest string")
    split = trie.nodes.where("ends is null").drop("ends").join(digests, ["conv_id", "depth"], "left")
    split = split.withColumn("ends_sha256", F.coalesce("digest", F.sha2(F.lit(""), 256))).drop("digest")
    return inside.unionByName(split)
