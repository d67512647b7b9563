"""Prefix trie: node values against brute force over blocks of any size, split nodes, edge cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from featloom.llm.conversation_trie import prefix_trie, share_heads, turn_sequences, with_end_digests
from featloom.llm.queries import op11_conversation_trie

TURNS = "conv_id long, turn long, role string, text string, ids string, depth int"


def _brute(convs):
    """(conv_id, depth, parent, members, children, leaves, saved, ends) of every node of {conv: [(role, text)]}."""
    members = defaultdict(list)
    for conv, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, own in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += (len(own) - 1) * len(path[-1][1]) if path else 0
    ends = {p: ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(p)) for p, own in members.items()}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return sorted((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children[p], leaves[p], saved[p], digest(ends[p])) for p, own in members.items())


def _nodes(trie):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, with_end_digests(trie).select(*names).collect()))


def _table(spark, convs, parts=4):
    rows = [(c, k, *turn, "x", 1) for c, turns in convs.items() for k, turn in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, TURNS).repartition(parts)


@pytest.fixture(scope="module")
def convs():
    rng = random.Random(3)
    turn = lambda: (rng.choice(["user", "assistant"]), rng.choice(["", "a", "ü€", "long " * 5]))
    made = {c: [turn() for _ in range(rng.randrange(1, 6))] for c in range(60)}
    hot = [("user", "same"), ("assistant", "again")]
    made |= {c: hot[:] for c in range(100, 150)} | {c: hot + [("user", str(c % 3))] for c in range(150, 170)}
    return made | {200: [("user", "deep")] * 300, -5: hot[:1]}


@pytest.mark.parametrize("cells", [1, 7, 100, 1 << 20])
def test_blocks_of_any_size_give_the_same_nodes(spark, convs, cells):
    trie = prefix_trie(turn_sequences(_table(spark, convs)), cells)
    assert _nodes(trie) == _brute(convs)
    if cells < 100:  # the conversations of a hot sequence are dealt over blocks
        assert trie.parts.groupBy("conv_id", "depth").count().where("count > 3").count() > 0


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, None, "first", "x", 1), (1, 0, "user", None, "x", 1), (2, 5, "", "first", "x", 1), (2, 9, "user", "", "x", 1), (None, 0, "user", "no conversation", "x", 1),
        (3, 1, "user", "twice", "x", 1), (3, 1, "user", "twice", "x", 1), (4, 1, "b", "tie", "x", 1), (4, 1, "a", "tie", "x", 1), (5, 1, "a", "tie", "x", 1), (5, 1, "b", "tie", "x", 1), (6, 1, "u", "y" * 200_000, "x", 1),
    ]
    table = spark.createDataFrame(rows, TURNS)
    nodes = {(r[0], r[1]): r[2:] for r in _nodes(prefix_trie(turn_sequences(table)))}
    assert nodes[1, 0][:3] == (None, 6, 4) and nodes[1, 2][:2] == (1, 2) and nodes[3, 2][1] == 1 and nodes[4, 2][1] == 2
    assert _nodes(prefix_trie(turn_sequences(table.limit(0)))) == []


def test_conversations_without_turns_are_members_of_the_root(spark):
    schema = "conv_id long, ids array<long>, chars array<int>"
    rows = spark.createDataFrame([(3, [], []), (2, [], []), (9, [7], [4])], schema)
    assert [r[:7] for r in _nodes(prefix_trie(rows))] == [(2, 0, None, 3, 1, 1, 0), (9, 1, 2, 1, 0, 1, 0)]
    only = _nodes(prefix_trie(rows.where("conv_id < 9")))
    assert [r[:7] for r in only] == [(2, 0, None, 2, 0, 1, 0)] and only[0][7] == hashlib.sha256(b"2,3").hexdigest()


def test_shared_heads(spark):
    rng = random.Random(8)
    convs = {c: [("user", f"{c} {k}") for k in range(rng.randrange(1, 8))] for c in [*range(0, 40), *range(100, 120), 205, 330, -3, -120]} | {c: [("user", "alone")] for c in range(501, 511)}
    conv = F.col("conv_id")
    sequences = share_heads(turn_sequences(_table(spark, convs)), conv - conv % 100, (F.crc32(conv.cast("string")) % 6).cast("int"), 5)
    rebuilt = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = convs.get(base, [])[:h] + turns[h:]
    assert _nodes(prefix_trie(sequences, 50)) == _brute(rebuilt) and any(not t for t in rebuilt.values())


def test_query_has_a_row_for_each_node(spark):
    rows = op11_conversation_trie(spark, "/root/testdata/sf0.001").collect()
    assert len({(r["conv_id"], r["depth"]) for r in rows}) == len(rows) and sum(r["parent_conv_id"] is None for r in rows) == 1
