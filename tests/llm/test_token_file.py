"""Token files: perfect hash, round trip through the index, keyed access, edge cases."""

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from featloom.llm import tokens
from featloom.llm.queries import op12_token_file
from featloom.llm.token_file import END, Shard, lookup, perfect_hash, read_documents, shard_bytes_of, write_token_file
from featloom.workspace import scratch_path

TEXTS = {
    None: "no key", 1: None, 2: "", 3: " \n\t ", 4: "It's 12 O'CLOCK <|endoftext|>x y", 5: "word " * 30_000, 6: "x" * 100_000, 7: "ΑΣ ́e İ ẞ 日本語　テスト \x85a\x1cb", -3: "minus"
}


def _plain(text):
    coder = Tokenizer.from_file(tokens.vocabulary_path("word_bpe_49k.json"))
    return [*coder.encode(text or "", add_special_tokens=False).ids, END]


def _ids(binary):
    return np.frombuffer(binary, "<u4").tolist()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 50, 3000])
def test_perfect_hash_fills_every_slot_once(n):
    rng = np.random.default_rng(n)
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    pilots, slots = perfect_hash(a, b)
    assert sorted(slots.tolist()) == list(range(n)) and len(pilots) <= max(1, n)


def test_shard_finds_its_keys_and_no_others():
    keys = [None, None, b"a", b"b", b"b", b"b", b"c"]
    payloads = [np.full(i, i, "<u2").tobytes() for i in range(len(keys))]
    shard = Shard(shard_bytes_of(keys, payloads, 2, 5) + b"\n")
    first, count = shard.find([b"a", b"b", b"c", b"", b"zz"])
    assert first.tolist() == [2, 3, 6, 0, 0] and count.tolist() == [1, 3, 1, 0, 0]
    assert shard.tokens(5).tolist() == [5] * 5 and shard.head["shard"] == 5
    empty = Shard(shard_bytes_of([None], [b""], 4, 0))
    assert empty.find([b"a"])[1].tolist() == [0]


@pytest.mark.parametrize("shard_bytes", [1, 1 << 20])
def test_round_trip_of_odd_texts(spark, shard_bytes):
    rows = [(k, t, 1, "x") for k, t in TEXTS.items()] + [(4, "again", 1, "x"), (4, "again", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int, ids string")
    path = scratch_path(spark, "files")
    write_token_file(docs, path, shard_bytes=shard_bytes)
    got = sorted(read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert sorted((r["key"] or "", _ids(r["ids"])) for r in got) == sorted(("" if k is None else str(k), _plain(t)) for k, t, *_ in rows)
    keys = [r["key"] for r in got]
    assert keys == [None, "-3", "1", "2", "3", "4", "4", "4", "5", "6", "7"]
    assert [r["start"] for r in got] == np.cumsum([0, *(r["n_tokens"] for r in got[:-1])]).tolist()
    asked = spark.createDataFrame([(4,), (4,), (7,), (-9,), (99,), (0,), (None,), (-3,)], "key long")
    found = lookup(spark, path, asked).collect()
    assert sorted((r["key"], r["start"], r["ids"]) for r in found) == sorted((r["key"], r["start"], r["ids"]) for r in got if r["key"] in ("4", "7", "-3"))


def test_pieces_are_encoded_as_in_the_whole_text():
    coder = tokens.WordEncoder(tokens.vocabulary_path("word_bpe_49k.json"))
    coder.known.most = 40
    odd = "Word, WORD. word's don't ... a.b, x!? É é e\u0301 \u0130I ẞ ſt ŉ ŀ ÷ ×x <|startoftext|>, <|STARTOFTEXT|> ½. 12th 3,5 naïve; ñandú: \x00 ﬁn ἈΣ." + "ab" * 40 + ","
    texts = [odd, odd.upper(), odd.lower(), *(" ".join(odd.split()[k:]) + "." for k in range(20)), ""] * 2
    want = [np.array(e.ids, "<u2").tobytes() for e in coder.full.encode_batch(texts, add_special_tokens=False)]
    assert [coder.ids([t.encode()])[0] for t in texts] == want


def test_text_keys_and_empty_table(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "z"), ("", "q"), ("ü", None)], "name string, body string")
    path = scratch_path(spark, "files")
    write_token_file(docs, path, "name", "body", end=None)
    got = sorted(read_documents(spark, path).collect(), key=lambda r: (r["start"], r["key"]))
    assert [r["key"] for r in got] == ["", "a", "b", "ü"] and got[3]["n_tokens"] == 0
    assert lookup(spark, path, spark.createDataFrame([("a",), ("zz",)], "key string")).count() == 1
    path = scratch_path(spark, "files")
    write_token_file(docs.limit(0), path, "name", "body")
    assert read_documents(spark, path).count() == 0 and lookup(spark, path, docs, "name").count() == 0


def test_query_matches_plain_encoding(spark):
    sf_dir = "/root/testdata/sf0.001"
    want, start = [], 0
    for row in spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect():
        ids = _plain(row["text"])
        want.append((row["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, op12_token_file(spark, sf_dir).collect())) == want


def test_the_word_encoder_starts_no_threads_of_its_own():
    """Spark gives each task a core: encoding in a worker leaves its thread count as it was."""
    import os
    import subprocess
    import sys

    script = (
        "import os\n"
        "from featloom.llm import tokens\n"
        "coder = tokens.word_encoder(tokens.vocabulary_path('word_bpe_49k.json'))\n"
        "before = len(os.listdir('/proc/self/task'))\n"
        "coder.ids([f'word{i} other{i % 7}, Mixed{i}! x{i}y'.encode() for i in range(5000)])\n"
        "print(before, len(os.listdir('/proc/self/task')))\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "TOKENIZERS_PARALLELISM"}
    done = subprocess.run([sys.executable, "-c", script], env=env, capture_output=True, text=True, check=True, timeout=300)
    before, after = map(int, done.stdout.split())
    assert after == before
