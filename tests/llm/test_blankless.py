"""Texts without blanks: words as long as the text, and scripts that set none."""

import random
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers as public
import pytest
from test_tokens import tiktoken_ids, word_ids
from tideline.llm import byte_bpe, language, suffix_dedup, token_counts, token_store
from tideline.llm.common import Memo
from tideline.llm.word_sums import WordSums

DRAW = random.Random(11)
SYLLABLES = ["ka", "to", "mi", "the", "ing", "日本", "語", "и", "ст", "é", "7", "aa"]


def blankless(n):
    return "".join(DRAW.choice(SYLLABLES) for _ in range(n))


@pytest.fixture(scope="module")
def bpe():
    return byte_bpe.ByteBpe(public.path("byte_bpe_multi_50k.tiktoken"), public.PATTERN)


@pytest.mark.parametrize("letters", ["a", "ab", "aab", "etaoinshr", "日本語中文字", "éèaeßt"])
def test_long_pieces_merge_as_short_ones_do(bpe, letters):
    pieces = ["".join(DRAW.choice(letters) for _ in range(DRAW.randrange(2, 200))).encode() for _ in range(60)]
    pieces = [p for p in pieces if len(p) > 1]
    for piece in pieces:
        (one,) = bpe.merge([piece], max(8, 1 << (len(piece) - 1).bit_length()))
        assert bpe.merge_long(piece) == one


def test_a_text_without_blanks_is_encoded_as_by_the_library(bpe):
    texts = ["".join(DRAW.choice("abcdefghijklmnop") for _ in range(90_000)), blankless(60_000), "x" * 50_000]
    assert [np.frombuffer(i, "<u4").tolist() for i in bpe.encode(texts)] == tiktoken_ids(texts)


def test_five_megabytes_without_a_blank(spark, bpe):
    text = "".join(DRAW.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(5_000)) * 1_000
    rows = spark.createDataFrame([(1, text), (2, "a b")], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["decoded"]) for r in byte_bpe.decode(byte_bpe.encode(rows)).collect()}
    assert got == {1: text.encode(), 2: b"a b"}


def test_counts_and_store_of_texts_without_blanks(spark):
    texts = [blankless(20_000), blankless(7_000) + " " + blankless(9_000)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wanted = word_ids(texts)
    counts = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(rows).collect()}
    assert counts == {i: len(w) for i, w in enumerate(wanted)}
    stored = {r["doc_id"]: r["ids_crc32"] for r in token_store.store(rows).collect()}
    assert stored == {i: zlib.crc32(np.array([*w, 2], "<u4").tobytes()) for i, w in enumerate(wanted)}


def test_languages_of_texts_without_blanks(spark):
    learned = [(f"東京都の天気は晴れです{'一二三四五'[i]}", "ja") for i in range(5)]
    learned += [(f"сегодня хорошая погода {'абвгд'[i]}", "ru") for i in range(5)]
    model = language.fit(spark.createDataFrame(learned, "text string, lang string"))
    assert model.predict(["東京都の天気" * 5_000, "погодасегодня" * 5_000])[0] == ["ja", "ru"]


def test_memory_of_words_is_bounded_by_their_length():
    memo = Memo(lambda words: [len(w) for w in words], chars=1_000)
    for k in range(50):
        memo.need({f"{k:03d}" * 100, "short"})
        assert memo[f"{k:03d}" * 100] == 300 and memo["short"] == 5
        assert sum(map(len, memo)) <= 1_000
    memo.need({"y" * 5_000, "z"})
    assert memo["y" * 5_000] == 5_000 and memo["z"] == 1


def test_sums_after_the_table_was_emptied(monkeypatch):
    monkeypatch.setattr("tideline.llm.word_sums.MEMO_CHARS", 20)
    sums = WordSums(lambda words: np.array([[len(w)] for w in words], float), 1)
    for text in ["one three", "a" * 50, "one " + "b" * 40 + " one", "three"]:
        assert sums.sums([text]).tolist() == [[len(text.replace(" ", ""))]]


def test_shards_hold_a_hot_key_and_null_keys(spark):
    data = [(None, f"null {i}") for i in range(300)] + [(7, f"seven {i}") for i in range(300)] + [(8, None)]
    rows = spark.createDataFrame(data, "doc_id long, text string")
    got = token_store.store(rows).collect()
    ids = word_ids([t for _, t in data])
    assert sorted(((r["doc_id"] or 0, r["n_tokens"], r["ids_crc32"]) for r in got)) == sorted(
        (k or 0, len(i) + 1, zlib.crc32(np.array([*i, 2], "<u4").tobytes())) for (k, _), i in zip(data, ids)
    )
    starts = sorted((r["start"], r["n_tokens"], -1 if r["doc_id"] is None else r["doc_id"]) for r in got)
    assert [s for s, *_ in starts] == np.cumsum([0, *(n for _, n, _ in starts)])[:-1].tolist()
    assert [k for *_, k in starts] == sorted(k for *_, k in starts)


def test_only_cut_characters_go_from_a_text(spark):
    passage = "".join(chr(0x4E00 + (i * 37) % 800) for i in range(60))
    head = "a�b é"
    # The second passage begins with another character, whose last two bytes are those of the first one's.
    other = chr(0x5E00) + passage[1:]
    assert other.encode()[1:] == passage.encode()[1:] != passage.encode()
    data = [(1, "x" + passage, "en", "s", 0), (2, head + other + "ü�", "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(data, schema)
    got = {r["doc_id"]: r for r in corpus_pipeline.repeats(spark, docs, "").collect()}
    assert got[1]["text"] == data[0][1]
    assert got[2]["text"] == head + "ü�" and got[2]["n_chars"] == 7
    plain = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs).collect()}
    assert plain[2]["n_removed"] == 179 and plain[2]["n_spans"] == 1
