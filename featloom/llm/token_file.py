"""Token-id files with a minimal perfect hash index for keyed access.

The documents are sorted by key over range partitions; each task encodes the texts of its partition
and cuts them into shards of about ``shard_bytes``. A shard is one file:

    256 bytes   JSON header, padded with blanks
    ids         raw payload, unsigned little-endian, 16 bit if the vocabulary fits, else 32
    ends        u64 for each document: ids up to its end
    key ends    u64 for each document: bytes of key text up to its end; then the key texts
    no key      u8 for each document: 1 if it has no key
    pilots      i32 for each bucket of the hash function
    prints      u32 for each key: its fingerprint, at its slot
    first       u32 for each key: its first document in the shard
    count       u32 for each key: how many documents of the shard have it, one after the other

The hash function maps the n distinct keys of a shard to the slots 0..n-1 without gaps: a key's bucket has a pilot, and
key and pilot give the slot. Buckets are placed from the largest to the smallest, each with the first pilot whose slots are
free; a bucket of one key takes a free slot directly (negative pilot). An access
hashes the key, reads one pilot, one fingerprint and one place, whatever the size of the shard.

Files are written by Spark's text writer (one record a file, so there is one line feed after the last
section) and read as binary files: tasks that are run again leave no second copy, and any store that Spark reaches will do.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featloom.llm import blocks, tokens
from featloom.operators.rank import running_totals
from featloom.workspace import materialise

HEADER = 256
SHARD_BYTES = 8 << 20
END = 1
_U = np.uint64


def key_hashes(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each key."""
    both = [xxhash.xxh3_128_intdigest(k) for k in keys]
    low = np.array([h & 0xFFFFFFFFFFFFFFFF for h in both], np.uint64)
    return low, np.array([h >> 64 for h in both], np.uint64)


def _buckets(a: np.ndarray, n: int) -> np.ndarray:
    return ((a >> _U(32)) * _U(n) >> _U(32)).astype(np.int64)


def _slots(a: np.ndarray, b: np.ndarray, pilot, n: int) -> np.ndarray:
    return (blocks.mix(a ^ blocks.mix(b + pilot)) % _U(n)).astype(np.int64)


def _prints(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (blocks.mix(b + (a << _U(1))) & _U(0xFFFFFFFF)).astype(np.uint32)


def perfect_hash(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(pilot of each bucket, slot of each key) for keys with distinct hash pairs; about two keys a bucket."""
    n = len(a)
    pilots = np.zeros(max(1, n // 2), np.int32)
    slots = np.zeros(n, np.int64)
    if not n:
        return pilots, slots
    bucket = _buckets(a, len(pilots))
    by_bucket = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=len(pilots))
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    taken = np.zeros(n, bool)
    owner = np.full(n, n, np.int64)
    for s in range(int(size.max()), 1, -1):
        todo = np.flatnonzero(size == s)
        base = 0
        while len(todo):
            members = by_bucket[begin[todo][:, None] + np.arange(s)]
            width = max(1, 4096 // members.size)
            tried = np.arange(base, base + width, dtype=np.uint64)[None, :, None]
            place = _slots(a[members][:, None, :], b[members][:, None, :], tried, n)
            inside = np.sort(place, axis=2)
            good = ~taken[place].any(axis=2) & (inside[:, :, 1:] != inside[:, :, :-1]).all(axis=2)
            some = np.flatnonzero(good.any(axis=1))
            pick = good[some].argmax(axis=1)
            mine = place[some, pick]
            # Two buckets may want one slot: the first of them has it, the other tries again.
            np.minimum.at(owner, mine.ravel(), np.repeat(np.arange(len(some)), s))
            won = (owner[mine] == np.arange(len(some))[:, None]).all(axis=1)
            owner[mine.ravel()] = n
            taken[mine[won].ravel()] = True
            slots[members[some[won]]] = mine[won]
            pilots[todo[some[won]]] = base + pick[won]
            lost = np.setdiff1d(np.arange(len(todo)), some[won])
            # A bucket that lost its slot to another one starts after this block of pilots as well.
            todo, base = todo[lost], base + width
    single = np.flatnonzero(size == 1)
    free = np.flatnonzero(~taken)[: len(single)]
    pilots[single] = -free - 1
    slots[by_bucket[begin[single]]] = free
    return pilots, slots


class Shard:
    """A shard file's bytes, opened for access by key."""

    def __init__(self, body: bytes):
        self.head = json.loads(body[:HEADER])
        h, at = self.head, HEADER
        self.body = body

        def part(kind, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(body, kind, n, at)
            at += found.nbytes
            return found

        self.ids = part(f"<u{h['width']}", h["n_ids"])
        self.ends = part("<u8", h["n_docs"])
        self.key_ends = part("<u8", h["n_docs"])
        self.key_bytes = part("u1", h["key_bytes"]).tobytes()
        self.no_key = part("u1", h["n_docs"])
        self.pilots = part("<i4", h["n_buckets"])
        self.prints = part("<u4", h["n_keys"])
        self.first = part("<u4", h["n_keys"])
        self.count = part("<u4", h["n_keys"])

    def key(self, doc: int) -> bytes:
        return self.key_bytes[int(self.key_ends[doc - 1]) if doc else 0 : int(self.key_ends[doc])]

    def start(self, doc: int) -> int:
        return int(self.ends[doc - 1]) if doc else 0

    def tokens(self, doc: int) -> np.ndarray:
        return self.ids[self.start(doc) : int(self.ends[doc])]

    def find(self, keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(first document, number of documents) of each key; (0, 0) for a key that the shard doesn't have."""
        a, b = key_hashes(keys)
        if not len(keys) or not self.head["n_keys"]:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        pilot = self.pilots[_buckets(a, len(self.pilots))]
        slot = np.where(pilot < 0, -pilot.astype(np.int64) - 1, _slots(a, b, pilot.astype(np.uint64), len(self.prints)))
        first = self.first[slot].astype(np.int64)
        # A fingerprint of another key can agree (1 in 2**32), so its text is compared too.
        sure = self.prints[slot] == _prints(a, b)
        sure[sure] = [self.key(f) == k for f, k in zip(first[sure].tolist(), (k for k, ok in zip(keys, sure) if ok))]
        return np.where(sure, first, 0), np.where(sure, self.count[slot].astype(np.int64), 0)


def shard_bytes_of(keys: list[bytes | None], payloads: list[bytes], width: int, number: int) -> bytes:
    """The file of one shard; equal keys stand one after the other."""
    n = len(keys)
    own = [k or b"" for k in keys]
    changed = np.array([i for i in range(n) if keys[i] is not None and (i == 0 or keys[i] != keys[i - 1])], np.int64)
    last = np.array([i for i in range(n) if keys[i] is not None and (i == n - 1 or keys[i] != keys[i + 1])], np.int64)
    a, b = key_hashes([own[i] for i in changed])
    pilots, slots = perfect_hash(a, b)
    prints, first, count = (np.zeros(len(changed), np.uint32) for _ in range(3))
    prints[slots], first[slots], count[slots] = _prints(a, b), changed, last - changed + 1
    ends = np.cumsum([len(p) // width for p in payloads], dtype=np.uint64)
    key_ends = np.cumsum([len(k) for k in own], dtype=np.uint64)
    head = {"format": "token ids 1", "shard": number, "width": width, "n_docs": n, "n_ids": int(ends[-1]), "n_keys": len(changed), "n_buckets": len(pilots), "key_bytes": int(key_ends[-1])}
    no_key = np.array([k is None for k in keys], np.uint8)
    sections = [json.dumps(head).encode().ljust(HEADER), *payloads, ends.astype("<u8"), key_ends.astype("<u8"), *own, no_key, pilots.astype("<i4"), prints.astype("<u4"), first.astype("<u4"), count.astype("<u4")]
    return b"".join(s if isinstance(s, bytes) else s.tobytes() for s in sections)


def write_token_file(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, end: int | None = END, shard_bytes: int = SHARD_BYTES) -> None:
    """Encode ``text_col`` and write it to shards under ``path``, in ascending order of ``id_col``.

    A null text counts as empty; ``end`` is appended to each document (None: nothing). Rows without a key come first and
    can be read in order, but not by key. Repeated keys stay, in the order of their texts' hashes, and may run
    over several shards, so a key of a third of all rows is written by many tasks. Other columns are not read.
    An empty table writes no shard. A document longer than ``shard_bytes`` has a shard of its own.
    """
    file = vocabulary or tokens.vocabulary_path("word_bpe_49k.json")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.word_encoder(file)
        close = np.array([] if end is None else [end], coder.kind).tobytes()
        task = TaskContext.get()
        number = (task.partitionId() if task else 0) << 32
        keys, payloads, size = [], [], 0

        def shard() -> pa.RecordBatch:
            body = shard_bytes_of(keys, payloads, coder.width, number)
            return pa.RecordBatch.from_arrays([pa.array([body], pa.binary())], names=["body"])

        for batch in batches:
            names = batch.column(0).cast(pa.binary()).to_pylist()
            for chunk in blocks.chunks(batch.column(1)):
                for row, ids in enumerate(coder.ids([chunk.text(r) for r in range(chunk.rows)])):
                    if payloads and size + len(ids) > shard_bytes:
                        yield shard()
                        keys, payloads, size, number = [], [], 0, number + 1
                    keys.append(names[chunk.low + row])
                    payloads.append(ids + close)
                    size += len(payloads[-1])
        if payloads:
            yield shard()

    key, text = F.col(id_col), F.col(text_col)
    ordered = docs.select(key.alias("id"), text.alias("text"), F.xxhash64(text).alias("tie")).repartitionByRange("id", "tie").sortWithinPartitions("id", "tie")
    shards = ordered.select(F.col("id").cast("string").alias("key"), "text").mapInArrow(build, "body binary")
    shards.select(F.col("body").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """The shard files. A task of the writer without documents may leave an empty file."""
    return spark.read.format("binaryFile").load(path).where("length > 0")


def shard_table(spark: SparkSession, path: str) -> DataFrame:
    """(``shard``, ``n_docs``, ``n_ids``, ``ids_before``): one row for each shard, from the headers."""
    head = F.col("content").substr(1, HEADER).cast("string")
    field = lambda name: F.get_json_object(head, f"$.{name}").cast("long").alias(name)
    found = materialise(_files(spark, path).select(field("shard"), field("n_docs"), field("n_ids")), "shards")
    return running_totals(found, ["shard"], ["n_ids"]).select("shard", "n_docs", "n_ids", F.col("n_ids_before").alias("ids_before"))


_ROWS = "key string, shard long, place long, start long, n_tokens long, ids binary"
_SCHEMA = pa.schema([("key", pa.string()), ("shard", pa.int64()), ("place", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])


def _rows(found: Shard, docs: np.ndarray) -> pa.RecordBatch:
    """The stated documents of a shard; ids as little-endian unsigned 32-bit integers."""
    listed = docs.tolist()
    ids = [found.tokens(d).astype("<u4").tobytes() for d in listed]
    keys = [None if found.no_key[d] else found.key(d).decode() for d in listed]
    starts = [found.start(d) for d in listed]
    shard = [found.head["shard"]] * len(listed)
    columns = [pa.array(keys, pa.string()), *(pa.array(x, pa.int64()) for x in (shard, listed, starts, [len(i) // 4 for i in ids])), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)


def _with_start(rows: DataFrame, shards: DataFrame) -> DataFrame:
    before = shards.select("shard", "ids_before")
    return rows.join(before, "shard").select("key", "shard", "place", (F.col("start") + F.col("ids_before")).alias("start"), "n_tokens", "ids")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """All documents of the files: ``key``, ``shard``, ``place`` in it, ``start`` (ids of all documents before), ``n_tokens``, ``ids`` (binary, 32 bit).

    Every document with a key is fetched through the index of its shard. The table of shards (24 bytes each) is joined by
    Spark, which broadcasts it as long as its size in bytes allows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for body in batch.column(0):
                found = Shard(body.as_py())
                keyed = np.flatnonzero(found.no_key == 0)
                distinct = list(dict.fromkeys(found.key(d) for d in keyed.tolist()))
                first, count = found.find(distinct)
                docs = np.concatenate([np.flatnonzero(found.no_key), blocks.spread(first, count)]).astype(np.int64)
                for low in range(0, len(docs), 1024):
                    yield _rows(found, docs[low : low + 1024])

    return _with_start(_files(spark, path).select("content").mapInArrow(run, _ROWS), shard_table(spark, path))


def lookup(spark: SparkSession, path: str, keys: DataFrame, key_col: str = "key") -> DataFrame:
    """The documents with one of the stated keys, as ``read_documents`` gives them; repeated and null keys count once and not at all.

    Shards are found by the keys' order: a running count of the shards' first keys puts each key
    beside the last shard that can hold it, and shards that end in the key are joined by it. Only those shards' contents are moved to the keys; a task holds one
    shard and the keys asked in its range.
    """
    kind = keys.schema[key_col].dataType
    ends = _files(spark, path).select("content").mapInArrow(_ends, "shard long, first_key string, last_key string")
    spans = materialise(ends.select("shard", F.col("first_key").cast(kind).alias("k"), F.col("last_key").cast(kind).alias("last")).where("k is not null"), "spans")
    asked = keys.select(F.col(key_col).alias("k")).where("k is not null").distinct()
    # Shards that begin with one key: the last of them stands for all, the others end in that key.
    marks = spans.groupBy("k").agg(F.max("shard").alias("shard")).withColumn("mark", F.lit(1).cast("long"))
    line = asked.join(marks, "k", "full_outer").withColumns({"mark": F.coalesce("mark", F.lit(0).cast("long"))})
    placed = running_totals(line, ["k"], ["mark"]).withColumn("rank", F.col("mark_before") + F.col("mark"))
    placed = materialise(placed.select("k", "shard", "mark", "rank"), "placed")
    holder = placed.where("mark = 1").select("rank", F.col("shard").alias("holder"))
    near = placed.join(holder, "rank").join(asked, "k", "left_semi").select("holder", "k")
    ended = spans.join(asked, spans["last"] == asked["k"]).select(F.col("shard").alias("holder"), asked["k"])
    pairs = near.union(ended).distinct().select(F.col("holder").alias("shard"), F.col("k").cast("string").alias("key"))
    head = F.get_json_object(F.col("content").substr(1, HEADER).cast("string"), "$.shard").cast("long").alias("shard")
    wanted = materialise(pairs, "wanted")
    bodies = _files(spark, path).select(head, "content").join(wanted.select("shard").distinct(), "shard", "left_semi")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _SCHEMA.empty_table()
        found = Shard(right.column("content")[0].as_py())
        docs = blocks.spread(*found.find([k.encode() for k in left.column("key").to_pylist()]))
        return pa.Table.from_batches([_rows(found, docs)])

    rows = wanted.groupBy("shard").cogroup(bodies.groupBy("shard")).applyInArrow(run, _ROWS)
    return _with_start(rows, shard_table(spark, path))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [Shard(body.as_py()) for body in batch.column(0)]
        keyed = [(s, np.flatnonzero(s.no_key == 0)) for s in found]
        first = [s.key(int(k[0])).decode() if len(k) else None for s, k in keyed]
        last = [s.key(int(k[-1])).decode() if len(k) else None for s, k in keyed]
        yield pa.RecordBatch.from_arrays([pa.array([s.head["shard"] for s in found], pa.int64()), pa.array(first, pa.string()), pa.array(last, pa.string())], names=["shard", "first_key", "last_key"])
