"""The pipeline on a small table, stage by stage, against plain Python."""

import hashlib

import corpus_pipeline
from test_duplicates import brute_components, brute_removal
from test_tokens import tiktoken_ids
from tideline.llm.contract import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_the_ones_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "repeats", "decontamination", "byte_bpe"]
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(-1, None, "en", "s", 0), (-2, "123 456", "en", "s", 7), (-3, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    rows = {r["doc_id"]: r for r in docs.collect()}

    first = corpus_pipeline.language_id(spark, docs, FOLDER)
    assert first.columns == docs.columns
    assert {r["doc_id"] for r in first.collect()} == set(rows) - {-1, -2, -3}

    second = corpus_pipeline.near_duplicates(spark, first, FOLDER)
    pairs = [(k, r["text"]) for k, r in rows.items() if k >= 0]
    kept = {k for k, _, c in brute_components(pairs) if k == c}
    assert {r["doc_id"] for r in second.collect()} == kept

    third = corpus_pipeline.repeats(spark, second, FOLDER)
    assert third.columns == docs.columns
    wanted = {k: (n, gone) for k, n, gone, *_ in brute_removal([(k, rows[k]["text"]) for k in kept])}
    got = {r["doc_id"]: r for r in third.collect()}
    assert set(got) == kept
    for k, (n, gone) in wanted.items():
        assert n - gone - 6 <= len(got[k]["text"].encode()) <= n - gone and got[k]["n_chars"] == len(got[k]["text"])

    fourth = corpus_pipeline.decontamination(spark, third, FOLDER)
    items = [r["text"] for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = {k for k, r in got.items() if not any(i in r["text"] for i in items)}
    assert {r["doc_id"] for r in fourth.collect()} <= clean and fourth.count() >= 0.95 * len(clean)

    last = corpus_pipeline.tokens(spark, fourth, FOLDER).collect()
    for row, ids in zip(last, tiktoken_ids([got[r["doc_id"]]["text"] for r in last])):
        assert row["n_tokens"] == len(ids)
        assert row["decoded_sha256"] == hashlib.sha256(got[row["doc_id"]]["text"].encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, FOLDER)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 100
