"""Memory and bounds of the shards whose suffix arrays tell equal windows."""

import tracemalloc

import numpy as np
import pandas as pd
from test_duplicates import brute_removal, removal, repeated
from tideline.llm import suffix_dedup


def one_shard(texts):
    """Each text's snippets and their bytes, as one shard gets them."""
    rows = suffix_dedup.occurrences(np.arange(len(texts)), np.arange(len(texts), dtype=np.int32), texts, 100)
    parts = [texts[k][a : a + n + 99] for k, a, n in zip(rows["key"].tolist(), rows["lo"].tolist(), rows["n"].tolist())]
    return pd.DataFrame({"shard": [0], "blob": [suffix_dedup.pack(rows, np.arange(len(parts)))], "bytes": [b"".join(parts)]})


def sorted_once(frame):
    """Covered intervals, and the peak of memory in MB."""
    tracemalloc.start()
    found = list(suffix_dedup.sorted_shards(100, 1, 1)(iter([frame])))
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    got = suffix_dedup.unpack([b for f in found for b in f["blob"][f["kind"] == suffix_dedup.COVERED]], suffix_dedup.INTERVAL)
    return sorted(zip(*(got[c].tolist() for c in suffix_dedup.INTERVAL))), peak


def lines(n):
    draw = np.random.default_rng(5)
    shared = [bytes(draw.integers(97, 123, 130).astype(np.uint8)) for _ in range(40)]
    return [bytes(draw.integers(97, 123, 1500).astype(np.uint8)) + shared[i % 40] + b"%d" % i for i in range(n)]


def test_shard_of_two_megabytes_is_sorted_in_little_memory():
    frame = one_shard(lines(330))
    assert 1.9e6 < len(frame["bytes"][0]) < 2.8e6
    found, peak = sorted_once(frame)
    assert len(found) >= 290 and peak < 40


def test_pieces_give_what_the_whole_gives(monkeypatch):
    frame = one_shard(lines(120))
    monkeypatch.setattr(suffix_dedup, "PIECE", 1 << 30)
    whole, _ = sorted_once(frame)
    monkeypatch.setattr(suffix_dedup, "PIECE", 1)
    assert sorted_once(frame)[0] == whole and len(whole) >= 80


def test_anchor_larger_than_a_shard_is_spread(spark, monkeypatch):
    """The sample finds no anchor frequent; those with more than a shard's bytes go over several shards all the same."""
    sizes = spark.sparkContext.accumulator(0)
    plain = suffix_dedup.merged_windows

    def counted(length, buckets):
        work = plain(length, buckets)

        def inner(key, rows):
            sizes.add(len(rows))
            return work(key, rows)

        return inner

    monkeypatch.setattr(suffix_dedup, "hot_anchors", lambda *_: np.zeros(0, np.uint64))
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    monkeypatch.setattr(suffix_dedup, "merged_windows", counted)
    rows = repeated()
    assert removal(spark, rows) == brute_removal(rows)
    assert sizes.value > 0
