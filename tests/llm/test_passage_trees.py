"""Repeated passages against plain Python."""

import random

import numpy as np
import pytest
from tideline.llm import passage_trees
from tideline.llm.passage_trees import remove_passages, tree_levels


def brute(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    keys = [k if k is not None else 2**63 - 1 for k, _ in rows]
    first = {}
    for k, w in zip(keys, words):
        for i in range(len(w) - window + 1):
            at = tuple(w[i : i + window])
            first[at] = min(first.get(at, k), k)
    out = []
    for (key, _), k, w in zip(rows, keys, words):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < k:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        edges = [i for i in range(len(w) + 1) if (gone[i] if i < len(w) else False) != (gone[i - 1] if i else False)]
        spans = [list(e) for e in zip(edges[::2], edges[1::2])]
        out.append((key, len(w), sum(gone), spans, kept))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    vocabulary = ["".join(draw.choice("abcdé") for _ in range(draw.randrange(1, 6))) for _ in range(400)]

    def prose(n):
        return [draw.choice(vocabulary) for _ in range(n)]

    passages = [prose(n) for n in (12, 14, 20, 45)]
    texts = []
    for _ in range(120):
        words = prose(draw.randrange(0, 60))
        for _ in range(draw.randrange(0, 3)):
            at = draw.randrange(0, len(words) + 1)
            words[at:at] = draw.choice(passages)
        texts.append(" ".join(words))
    family = prose(60)
    for _ in range(80):  # near copies
        words = list(family)
        words[draw.randrange(60)] = draw.choice(vocabulary)
        texts.append(draw.choice([" ", "\n", "\t "]).join(words))
    texts += [texts[3]] * 30 + [None, "", " \x0b ", "one", "a " * 70, "a " * 50, "a b " * 40, "x" * 500, "A " + texts[3]]
    data = [(int(k), t) for k, t in zip(draw.sample(range(10_000), len(texts)), texts)]
    return [*data, (None, texts[3]), (None, texts[130]), data[4], data[4], (data[5][0], texts[6])]


@pytest.mark.parametrize("group", [10_000, 12, 2])
def test_removal_equals_brute_force(spark, rows, group):
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, low int, kept string")
    got = remove_passages(df, window=12, prefix=4, group=group)
    assert got.columns == ["doc_id", "n_words", "n_removed", "spans", "kept"]
    want = brute(rows, 12)
    assert sum(r[2] for r in want) > 1000
    assert sorted(((*r[:3], [list(s) for s in r[3]], r[4]) for r in got.collect()), key=str) == want


def test_long_texts_in_blocks(spark, monkeypatch):
    draw = random.Random(1)
    words = [f"w{draw.randrange(5000)}" for _ in range(700_000)]
    again = ["other"] + words[3:600_000] + ["more"] + words[100:149] + ["end"]
    rows = [(1, " ".join(words)), (2, " ".join(again)), (3, "z" * 3_000_000)]
    found = {r["doc_id"]: r for r in remove_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1]["n_removed"] == 0 and found[3]["n_words"] == 1
    assert found[2]["n_removed"] == 599_997 and found[2]["spans"] == [[1, 599_998]]


def test_empty_table(spark):
    assert remove_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_tree_nodes_are_shared_prefixes():
    draw = random.Random(5)
    rows = [[draw.choice([b"a", b"b"]) for _ in range(draw.randrange(0, 7))] for _ in range(200)]
    group = np.array([draw.randrange(3) for _ in rows])
    levels = tree_levels(rows, group, 6)
    for d in range(7):
        prefix = [(g, tuple(r[:d])) if len(r) >= d else None for g, r in zip(group.tolist(), rows)]
        for i in range(0, 200, 3):
            shared = prefix[i] is not None and prefix.count(prefix[i]) > 1
            assert (levels[d, i] >= 0) == shared
            if shared:
                assert [levels[d, j] == levels[d, i] for j in range(200)] == [p == prefix[i] for p in prefix]
