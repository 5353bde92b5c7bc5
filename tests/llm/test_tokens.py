"""Token counts, byte-level BPE and the token store against the public libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
import tiktoken
from tideline.llm import byte_bpe, token_counts, token_store
from tideline.llm.common import new_folder, parts
from tokenizers import Tokenizer

LETTERS = "abcdeéß \n\t'sΣ<|>1２ñ́‍!日😀\x1c"
DRAW = random.Random(3)
TEXTS = [
    "", " ", "  \n ", "a", "ΑΣ ΟΔΟΣ Σ", "<|endoftext|> foo<|startoftext|>bar", "<|ENDOFTEXT|>", "a\x1cb c",
    "aaaaaaaaaaaaaaaa" * 60, "İstanbul  \n\n\t x", "é ́a 'S it's I'LL ll'", "日本語 123 ½ ²", "x y z  w　",
    "word " * 3000, "a\0b c", " lead and trail ",
    *("".join(DRAW.choice(LETTERS) for _ in range(DRAW.randrange(1, 200))) for _ in range(150)),
]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, t, i, "x") for i, t in enumerate(TEXTS)]
    data += [(len(TEXTS), None, 7, None), (None, "no key", 1, "y"), (3, "a", 3, "x"), (3, "a", 3, "x")]
    return spark.createDataFrame(data, "doc_id long, text string, n_tokens long, ids string")


def tiktoken_ids(text):
    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [library.encode_ordinary(t or "") for t in text]


def word_ids(texts):
    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_counts_equal_the_library(rows):
    got = token_counts.count_tokens(rows).collect()
    assert len(got) == rows.count()
    for row, ids in zip(got, word_ids([r["text"] for r in got])):
        assert (row["n_tokens"], row["n_bytes"]) == (len(ids), len((row["text"] or "").encode()))
        assert row["over_limit"] == (len(ids) > 2048)


def test_overlapping_merges_and_long_words():
    bpe = token_counts.word_bpe(public.path("word_bpe_49k.json"))
    texts = ["a" * n for n in (1, 2, 3, 4, 7, 64, 1000)] + ["ab" * 300, "ha" * 333 + "h"]
    assert bpe.count(texts) == [len(i) for i in word_ids(texts)]


def test_parts_join_to_the_text():
    text = "ab cd\n\n" * 50 + "x" * 90
    assert "".join(parts(text, 16)) == text
    bpe = token_counts.word_bpe(public.path("word_bpe_49k.json"))
    old, token_counts.RUN_CHARS = token_counts.RUN_CHARS, 16
    try:
        assert bpe.count([text, "", "one two"]) == [len(i) for i in word_ids([text, "", "one two"])]
    finally:
        token_counts.RUN_CHARS = old


def test_byte_bpe_equals_the_library_and_decodes(rows):
    got = byte_bpe.round_trip(rows).collect()
    assert len(got) == rows.count()
    for row, ids in zip(got, tiktoken_ids([r["text"] for r in got])):
        raw = np.array(ids, "<u4").tobytes()
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(raw).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((row["text"] or "").encode()).hexdigest()


def test_encode_then_decode(rows):
    got = byte_bpe.decode(byte_bpe.encode(rows)).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in got)


def test_byte_bpe_in_small_parts(monkeypatch):
    monkeypatch.setattr(byte_bpe, "PART_CHARS", 20)
    bpe = byte_bpe.ByteBpe(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)
    bpe.memo.most = bpe.chunks.most = 5
    texts = ["one  two \n three four five's  six\t seven eight", "a " * 60, ""]
    got = [np.frombuffer(i, "<u4").tolist() for i in bpe.encode(texts)]
    assert got == tiktoken_ids(texts)


def test_store_reads_back_what_was_written(spark, rows):
    got = {(r["doc_id"], r["start"]): r for r in token_store.store(rows).collect()}
    data = sorted(((r["doc_id"], r["text"] or "") for r in rows.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    start = 0
    for (key, _), ids in zip(data, word_ids([t for _, t in data])):
        row = got.pop((key, start))
        assert row["n_tokens"] == len(ids) + 1
        assert row["ids_crc32"] == zlib.crc32(np.array([*ids, 2], "<u4").tobytes())
        start += len(ids) + 1
    assert not got


def test_store_of_an_empty_table(spark, rows):
    assert token_store.store(rows.limit(0)).count() == 0


def test_index_finds_keys_and_rejects_others(spark, rows):
    folder = new_folder(spark, "ids")
    placed = token_store.write(rows.where("doc_id >= 0"), folder).collect()
    files, base = token_store._opened(folder)
    for number in {r["shard"] for r in placed}:
        shard = token_store.Shard(files, f"{base}/shard-{number:06d}")
        keys = np.array([r["doc_id"] for r in placed if r["shard"] == number])
        first, times = shard.find(keys)
        assert (times > 0).all() and len(set(first.tolist())) == len(set(keys.tolist()))
        assert (shard.find(np.arange(10**6, 10**6 + 500))[1] == 0).all()


@pytest.mark.parametrize("n", [0, 1, 2, 63, 64, 5000])
def test_perfect_hash_is_minimal(n):
    keys = np.random.default_rng(n).integers(-(2**63), 2**63 - 1, n)
    table = token_store.PerfectHash.build(keys)
    assert sorted(table.find(keys).tolist()) == list(range(n))


def test_empty_tables(rows):
    none = rows.limit(0)
    assert token_counts.count_tokens(none).count() == 0
    assert byte_bpe.round_trip(none).count() == 0
