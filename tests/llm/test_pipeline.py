"""The registered text queries and the pipeline."""

import zlib

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from featloom.llm import sql

SF = "/root/testdata/sf0.001"


def test_language_is_right_on_held_out_rows(spark):
    rows = queries()["op3_language_id"](spark, "/root/testdata/sf0.01").collect()
    langs = {r["doc_id"]: r["lang"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in langs if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_all_are_registered():
    names = list(queries())
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)) and "pipeline" in names
    assert "op1_substring_dedup" in oracle_sql() and "pipeline" not in oracle_sql()


@pytest.fixture(scope="module")
def stages(spark):
    from featloom.workspace import materialise

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def _rows(df):
    return {r["doc_id"]: r.asDict() for r in df.collect()}


def _on(table, text):
    con = duckdb.connect()
    con.register("documents", table.toPandas())
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF}/benchmark.parquet'")
    result = con.execute(text)
    names = [d[0] for d in result.description]
    return {r[names.index("doc_id")]: dict(zip(names, r)) for r in result.fetchall()}


def test_stages_keep_columns(stages):
    assert all(df.columns == stages[0].columns and df.dtypes == stages[0].dtypes for df in stages[1:-1])


def test_language_stage_keeps_documents_in_known_languages(stages):
    assert _rows(stages[1]) == _rows(stages[0])  # all of them have letters and a language


def test_line_stage_matches_sql(stages):
    want = {d: r for d, r in _on(stages[1], sql.LINE_DEDUP).items() if r["n_lines"] == 0 or r["n_removed"] < r["n_lines"]}
    import hashlib

    got = _rows(stages[2])
    assert {d: hashlib.sha256(r["text"].encode()).hexdigest() for d, r in got.items()} == {d: r["kept_sha256"] for d, r in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES[:-1]])
def test_stages_on_odd_tables(spark, stage):
    schema = "doc_id long, text string, lang string, __gone string, __id long, __lines int, __overlap int, __language int"
    words = " ".join(f"word{i} the" for i in range(40))
    rows = [(1, words, "en"), (1, words, "en"), (2, None, "en"), (3, "", None), (None, "some other text of its own", "de"), (None, None, None), (4, " \n ", None), (5, "x" * 100_000 + " end", "de")]
    docs = spark.createDataFrame([(*r, "g", 7, 1, 2, 3) for r in rows], schema)
    got = stage(spark, docs, SF)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    if stage is corpus_pipeline.language_stage:
        assert [k[0] for k in kept if k[1] is None or not k[1].strip()] == [] and kept.count((1, words)) == 2
    else:
        assert kept == sorted(((r[0], r[1]) for r in rows), key=str)
    assert stage(spark, docs.limit(0), SF).count() == 0


def test_line_stage_takes_two_lines_of_fifty_words(spark):
    passage = "\n".join(" ".join(f"{c}{i}" for i in range(25)) for c in "ab")
    docs = spark.createDataFrame([(k, f"start {k}\n{passage}\nend {k}", 0) for k in (1, 2)], "doc_id long, text string, n_chars long")
    got = _rows(corpus_pipeline.line_stage(spark, docs, SF))
    assert passage in got[1]["text"] and got[2]["text"] == "start 2\nend 2" and got[2]["n_chars"] == 13


def test_ngram_stage_matches_sql(stages):
    want = {d for d, r in _on(stages[2], sql.NGRAM_JOIN).items() if r["class_id"] == d}
    assert set(_rows(stages[3])) == want


def test_benchmark_stage_matches_sql(stages):
    judged = _on(stages[3], sql.DECONTAMINATE)
    got, before = _rows(stages[4]), _rows(stages[3])
    assert set(got) == {d for d, r in judged.items() if not r["contaminated"]}
    assert all(got[d]["text"] == before[d]["text"] for d in got if not judged[d]["n_hit"])
    assert all(len(got[d]["text"]) < len(before[d]["text"]) for d in got if judged[d]["n_hit"])


def test_packing_stage_has_every_token(stages):
    from featloom.llm import tokens

    coder = tokens.encoder(tokens.vocabulary_path())
    got = {}
    for r in stages[5].collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == {d: len(coder.ids(r["text"])) + 1 for d, r in _rows(stages[4]).items()}


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect())) == sorted(map(tuple, stages[5].drop("sequence_id", "offset").collect()))
