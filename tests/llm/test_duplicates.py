"""SimHash components and suffix-array removal against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash
from tideline.llm import simhash, suffix_dedup
from tideline.llm.components import components
from tideline.llm.suffix_array import common_prefixes, suffix_array

DRAW = random.Random(9)
WORDS = ["".join(DRAW.choice("abcdefghij") for _ in range(DRAW.randrange(2, 9))) for _ in range(300)]


def prose(n):
    return " ".join(DRAW.choice(WORDS) for _ in range(n))


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in low.encode().split()]
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    out = []
    for i, (key, _) in enumerate(rows):
        keys = [rows[j][0] for j in range(len(rows)) if label[j] == label[i] and rows[j][0] is not None]
        out.append((key, f"{fps[i]:016x}", min(keys, default=None)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def documents():
    base = [prose(n) for n in (2, 5, 40, 150, 150, 400)]
    rows = [*base, None, "", " \n\t ", "Word", "word", "ONE TWO", "one\ttwo", "été ÉTÉ été", base[3]]
    for _ in range(60):
        words = DRAW.choice(base[2:]).split()
        for _ in range(DRAW.randrange(0, 3)):
            words[DRAW.randrange(len(words))] = DRAW.choice(WORDS)
        rows.append(" ".join(words))
    data = [(100 - i, t) for i, t in enumerate(rows)]
    return [*data, (None, base[3]), (None, "nobody else"), data[3], data[3]]


def test_components_equal_brute_force(spark, documents):
    df = spark.createDataFrame([(*d, "x", 1) for d in documents], "doc_id long, text string, fp string, root int")
    got = sorted(((r[0], r[1], r[2]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == brute_components(documents)


def test_large_groups_meet_in_tiles(spark, documents):
    rows = spark.createDataFrame([(i,) for i in np.random.default_rng(1).integers(0, 2**14, 1500).tolist()], "fp long")
    fps = rows.distinct()
    whole = components(simhash.links(fps)).collect()
    cut = components(simhash.links(fps, group=16)).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, cut)) and whole


def test_tiles_are_skipped_only_beyond_the_radius(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    values = np.random.default_rng(2).integers(0, 2**9, 60).astype(np.uint64)
    label = simhash.tile_labels(values, values, 2)
    for i in range(60):
        for j in range(60):
            if bin(int(values[i] ^ values[j])).count("1") <= 2:
                assert label[i] == label[j]


def test_near_duplicates_of_nothing(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chains_have_one_root(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (None, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


@pytest.mark.parametrize("text", [b"", b"a", b"banana" * 30, b"aaaa" * 60, bytes(range(256)) * 3, b"abcab" * 50 + b"x"])
def test_suffix_array_and_prefixes(text):
    flat = np.frombuffer(text, np.uint8)
    order = suffix_array(flat)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:])
    expected = [0] * len(text)
    for k in range(1, len(text)):
        a, b = text[order[k - 1] :], text[order[k] :]
        while expected[k] < min(len(a), len(b), 100) and a[expected[k]] == b[expected[k]]:
            expected[k] += 1
    assert common_prefixes(flat, order, 100).tolist() == expected


def brute_removal(rows, length=100):
    """Windows' earliest (key, start) first; then what is covered by later ones."""
    least = -(2**63)
    first = {}
    for key, text in rows:
        b, k = (text or "").encode(), least if key is None else key
        for s in range(len(b) - length + 1):
            w = b[s : s + length]
            first[w] = min(first.get(w, (k, s)), (k, s))
    out = []
    for key, text in rows:
        b, k = (text or "").encode(), least if key is None else key
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (k, s):
                gone[s : s + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((key, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeated():
    common, line = prose(60), "the very same line that ends up in a third of all the documents, " * 2
    rows = []
    for i in range(150):
        text = prose(DRAW.randrange(0, 80))
        if i % 3 == 0:
            text += DRAW.choice(["x", " ", prose(1)]) + line + prose(DRAW.randrange(0, 9))
        if i % 7 == 0:
            a = DRAW.randrange(len(common) // 2)
            text += common[a : a + DRAW.randrange(50, 200)] + prose(3)
        rows.append((1000 - i if i % 2 else i, text))
    rows += [(2000, "é" * 300), (2001, "é" * 120 + "a"), (2002, "ab" * 400), (2003, ""), (2004, None), (2005, "short")]
    rows += [(2006, rows[3][1]), (None, rows[4][1]), rows[9], rows[9], (2007, "q" * 99), (2008, "q" * 100), (2009, "q" * 101)]
    return rows


def removal(spark, rows, **options):
    df = spark.createDataFrame([(k, t, i, t) for i, (k, t) in enumerate(rows)], "doc_id long, text string, n_bytes int, _b string")
    got = suffix_dedup.remove_repeats(df, **options).collect()
    return sorted(
        ((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in got),
        key=str,
    )


def test_removal_equals_brute_force(spark):
    rows = repeated()
    assert removal(spark, rows) == brute_removal(rows)


def test_removal_with_all_anchors_hot(spark, monkeypatch):
    """Every anchor is spread over shards, and the shards' windows are merged."""
    monkeypatch.setattr(suffix_dedup, "hot_anchors", lambda docs, share, length, parts: every_anchor(docs, length))
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    rows = repeated()
    assert removal(spark, rows) == brute_removal(rows)


def every_anchor(docs, length):
    found = docs.toPandas()
    got = suffix_dedup.occurrences(found["key"].to_numpy(), found["tag"].to_numpy(), [t.encode() for t in found["text"]], length)
    return np.unique(got["anchor"])


def test_removal_in_small_blocks(monkeypatch):
    text = (prose(200) + "z" * 300) * 2
    key, tag = np.array([1]), np.array([2], np.int32)
    whole = suffix_dedup.occurrences(key, tag, [text.encode()], 100)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 150)
    cut = suffix_dedup.occurrences(key, tag, [text.encode()], 100)

    def windows(rows):
        return [(s, a) for lo, n, a in zip(rows["lo"], rows["n"], rows["anchor"]) for s in range(lo, lo + n)]

    assert windows(whole) == windows(cut) and len(windows(whole)) == len(text) - 99


def test_removal_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(df).count() == 0
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(df, length=30)
