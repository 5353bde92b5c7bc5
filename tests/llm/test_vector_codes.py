"""Vector codes against plain Python."""

import hashlib
import math

import numpy as np
from tideline.llm import vector_codes


def brute(rows, parts, entries, rounds=2, scale=256):
    kept = [(k, l, [math.floor(scale * x) for x in v]) for k, v, l in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][2]) // parts
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * size : (p + 1) * size] for r in order] for p in range(parts)]

    def nearest(book, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            mine = [r[2][p * size : (p + 1) * size] for r in kept]
            at = [nearest(books[p], x)[1] for x in mine]
            for i in set(at):
                some = [x for x, j in zip(mine, at) if j == i]
                books[p][i] = [sum(c) // len(some) for c in zip(*some)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = []
    for k, l, v in kept:
        found = [nearest(books[p], v[p * size : (p + 1) * size]) for p in range(parts)]
        out.append((k, l, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    total = {}
    for _, l, _, e in out:
        total[l] = total.get(l, 0) + e
    return sorted(((k, c, e, total[l], sha) for k, l, c, e in out), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, code string")


def test_codes_equal_brute_force(spark):
    draw = np.random.default_rng(3)
    rows = [(int(i), draw.normal(0, 0.2, 12).tolist(), int(i) % 3) for i in draw.permutation(300)]
    rows += [(1000 + i, [0.1] * 12, 7) for i in range(150)]  # a third are copies
    rows += [(2000, None, 1), (2001, [None] * 12, 1), (2002, [math.nan] * 12, 1), (2003, [-math.inf] + [0.0] * 11, 1)]
    rows += [(2004, [0.0] * 12, None), (2005, [-50.0] * 12, None), (None, [0.3] * 12, 2), rows[3], (rows[5][0], [0.25] * 12, 0)]
    for entries in (64, 5):
        got = vector_codes.encode(table(spark, rows), parts=4, entries=entries)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert sorted(map(tuple, got.collect()), key=str) == brute(rows, 4, entries)


def test_few_none_and_odd_rows(spark):
    few = [(2, [0.5, 1.0], 1), (1, [0.5, -1.0], 1)]
    got = vector_codes.encode(table(spark, few), parts=2)
    assert sorted(map(tuple, got.collect()), key=str) == brute(few, 2, 64)
    assert vector_codes.encode(table(spark, few).limit(0), parts=2).count() == 0
    odd = [*few, (3, [1.0], 1), (4, [1.0] * 4, 1), (5, [1e9, 0.0], 1), (6, [], 1)]
    found = {r["vec_id"]: r for r in vector_codes.encode(table(spark, odd), parts=2).collect()}
    assert [found[k]["error"] for k in (1, 2, 3, 4, 5, 6)] == [0, 0, None, None, None, None]
    assert found[3]["label_error"] == 0 and found[3]["code"] is None
    alone = vector_codes.encode(table(spark, odd[2:3]), parts=2).collect()
    assert [(r["vec_id"], r["code"]) for r in alone] == [(3, None)]


def test_ties_take_the_lowest_entry_and_boxes_lose_none():
    draw = np.random.default_rng(8)
    for spread in (1, 3, 200, 2**24):
        entries = draw.integers(-spread, spread, (64, 3))
        entries[9] = entries[4]
        rows = draw.integers(-2 * spread, 2 * spread, (500, 3))
        index, error = vector_codes.Slices(entries).nearest(rows)
        away = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        assert (index == away.argmin(axis=1)).all() and (error == away.min(axis=1)).all()
