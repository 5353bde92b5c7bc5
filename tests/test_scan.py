"""Sliced scans give what a plain window gives, whatever the skew."""

import random

import pytest

from tideline.operators.scan import Count, Lag, Last, Max, OrderedScan, Recent, Sum


def _rows(seed, n=600, hot=0.6):
    rng = random.Random(seed)
    rows = []
    for seq in range(n):
        key = "hot" if rng.random() < hot else rng.choice(["a", "b", "c", None])
        position = rng.randrange(40)  # many ties, broken by seq
        value = None if rng.random() < 0.2 else rng.randrange(100)
        rows.append((key, position, seq, value))
    rng.shuffle(rows)
    return rows


def _expected(rows, keyed, descending):
    groups = {}
    for row in rows:
        groups.setdefault(row[0] if keyed else 0, []).append(row)
    out = {}
    for group in groups.values():
        group.sort(key=lambda r: (r[1], r[2]), reverse=descending)
        seen = []
        for _, _, seq, value in group:
            before = [v for v in seen if v is not None]
            seen.append(value)
            known = [v for v in seen if v is not None]
            out[seq] = (
                len(seen),
                sum(known) if known else None,
                max(known) if known else None,
                max(before) if before else None,
                known[-1] if known else None,
                seen[-2] if len(seen) > 1 else None,
                seen[-4] if len(seen) > 3 else None,
                seen[-3:],
            )
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 150, 25, 1])
@pytest.mark.parametrize("keyed", [True, False])
@pytest.mark.parametrize("descending", [False, True])
def test_scan_matches_brute_force(spark, hot_rows, keyed, descending):
    rows = _rows(hot_rows)
    df = spark.createDataFrame(rows, "key string, pos int, seq long, value int")
    scan = OrderedScan(
        df,
        ["key"] if keyed else [],
        ["pos", "seq"],
        descending=descending,
        hot_rows=hot_rows,
    ).add(
        n=Count(),
        total=Sum("value"),
        top=Max("value"),
        top_before=Max("value", before=True),
        last=Last("value"),
        prev=Lag("value"),
        third=Lag("value", 3),
        recent=Recent("value", 3),
    )
    assert scan.sliced == (hot_rows < len(rows) * 0.55)
    got = {
        r.seq: (r.n, r.total, r.top, r.top_before, r.last, r.prev, r.third, r.recent)
        for r in scan.result().collect()
    }
    assert got == _expected(rows, keyed, descending)


def test_chained_scans_share_the_slices(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "key string, pos int, seq long, value int")
    plain = OrderedScan(df, ["key"], ["seq"]).add(n=Count()).add(s=Sum("n")).result()
    cut = OrderedScan(df, ["key"], ["seq"], hot_rows=20).add(n=Count()).add(s=Sum("n")).result()
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
