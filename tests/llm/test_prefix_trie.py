"""The conversation trie and tree contraction against plain Python."""

import hashlib
import random
import zlib

import pytest
from tideline.llm.prefix_trie import prefix_trie, subtree_totals


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    nodes = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}
    total = {}
    for p in sorted(nodes, key=len, reverse=True):
        mine = (len(nodes[p]) - 1) * (len(p[-1][1].encode()) if p else 0)
        below = [total[q] for q in kids[p]]
        total[p] = (sum(n for n, _ in below) or 1, mine + sum(s for _, s in below))
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(built[c]) == len(p))
        sha = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]), *total[p], sha))
    return sorted(out, key=str)


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    got = prefix_trie(df)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


@pytest.mark.parametrize("hot", [None, "20"])
def test_trie_equals_brute_force(spark, hot):
    draw = random.Random(4)
    words = ["", "hi", "é", "so", "no", None]
    rows = []
    for c in range(0, 90):
        if c % 11 == 5:
            continue  # some bases are missing
        for n in range(draw.randrange(1, 14)):
            rows.append((c, n if n else None, draw.choice(["user", "user", None]), draw.choice(words)))
    rows += [(500 + c, n, "user", "same") for c in range(0, 60) for n in range(12)]  # copies
    rows += [(1000, n, "user", f"t{n % 2}") for n in range(90)]  # one long chain
    rows += [rows[7], rows[7], (None, 1, "user", "nobody"), (3, 2, "a", "tie"), (3, 2, "a", "tie"), (3, 2, "b", "tie")]
    if hot:
        spark.conf.set("tideline.scan.hotRows", hot)
    try:
        check(spark, rows)
    finally:
        spark.conf.unset("tideline.scan.hotRows")


def test_empty_and_single(spark):
    check(spark, [(5, 0, "user", "x")])
    check(spark, [(7, 0, "user", "x")])  # a conversation that may lose all its turns is the root's
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie(df).count() == 0


def test_contraction_of_chains_and_forests(spark):
    draw = random.Random(2)
    parent = {0: None, 1: None, 2: 1}
    for n in range(3, 400):
        parent[n] = n - 1 if n < 250 else draw.randrange(0, n)
    rows = [(n, p, n * 7 % 13) for n, p in parent.items()] + [(900, 12345, 5)]  # a parent that is not there
    total = {n: v for n, _, v in rows}
    for n in sorted(parent, reverse=True):
        if parent[n] is not None:
            total[parent[n]] += total[n]
    got = subtree_totals(spark.createDataFrame(rows, "node long, parent long, v long"), ["v"])
    assert dict(map(tuple, got.collect())) == total
    with pytest.raises(ValueError):
        subtree_totals(spark.createDataFrame([(1, 2, 1), (2, 1, 1)], "node long, parent long, v long"), ["v"])
