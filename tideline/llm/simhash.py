"""Near-duplicates by SimHash fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import islice

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import parts, written
from tideline.llm.components import components

SHINGLE = 3
SEED = 42
RADIUS = 2
#: Fingerprints of a group that one task compares; larger groups are cut into tiles that meet pairwise.
GROUP = 4096
TILE = 512
SMALL = 8


def fingerprint(text: str, width: int = SHINGLE) -> int:
    """The unsigned 64-bit SimHash of a whole text's word shingles, repeats included.

    A to Z count as lower case, words are what stands between ASCII white space. A text of fewer words than
    ``width`` is one shingle, one without words (empty or null too) has fingerprint 0. A bit is set if it is set in
    more than half of the shingles' hashes.
    """
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for part in parts(text):
        words = tail + part.encode().lower().split()
        shingles = map(b" ".join, zip(*(islice(words, k, None) for k in range(width))))
        while hashes := list(map(digest, islice(shingles, 1 << 16))):
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(width - 1) :] if width > 1 else []
    if not total:
        return digest(b" ".join(tail)) if tail else 0
    return sum(1 << int(k) for k in np.flatnonzero(2 * ones > total))


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fp", width: int = SHINGLE) -> DataFrame:
    """Adds the fingerprint as a long with the same 64 bits. No shuffle, other columns stay."""

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64))

    return df.withColumn(out, signed(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def tile_labels(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """For each of ``left + right`` the least index that it reaches over links between the two sides.

    Both sides are sorted by population count and cut into tiles. A pair of tiles is skipped if the counts differ
    by more than the radius, since then no pair inside can be linked; the others are compared by exclusive or.
    """
    same = right is left
    every = left if same else np.concatenate([left, right])
    label = np.arange(len(every))

    def tiles(values: np.ndarray, base: int) -> list:
        ones = np.bitwise_count(values)
        order = np.argsort(ones, kind="stable")
        cuts = [order[k : k + TILE] for k in range(0, len(order), TILE)]
        return [(base + c, values[c], int(ones[c[0]]), int(ones[c[-1]])) for c in cuts]

    first = tiles(left, 0)
    second = first if same else tiles(right, len(left))
    near = [
        (p, q)
        for k, p in enumerate(first)
        for q in (second[k:] if same else second)
        if q[2] - p[3] <= radius and p[2] - q[3] <= radius
    ]
    changed = True
    while changed:
        old = label.copy()
        for (i, x, *_), (j, y, *_) in near:
            linked = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
            a = np.where(linked, label[j][None, :], len(every)).min(axis=1)
            b = np.where(linked, label[i][:, None], len(every)).min(axis=0)
            np.minimum.at(label, label[i], a.clip(max=label[i]))
            np.minimum.at(label, label[j], b.clip(max=label[j]))
            label[i] = np.minimum(label[i], a)
            label[j] = np.minimum(label[j], b)
        label = label[label]
        changed = not np.array_equal(label, old)
    return label


def _group_links(batches: Iterator[pd.DataFrame], radius: int) -> Iterator[pd.DataFrame]:
    """Links of one partition's groups, each between a fingerprint and another one that reaches it in the group."""
    frames = [f for f in batches if len(f)]
    if not frames:
        return
    group, fp, side = (np.concatenate([f[c].to_numpy() for f in frames]) for c in ("g", "fp", "side"))
    order = np.lexsort((fp, group))
    group, fp, side = group[order], fp[order].view(np.uint64), side[order]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    left, right = [], []
    small = np.repeat(size <= SMALL, size)
    at = np.flatnonzero(small)
    for k in range(1, SMALL):
        i = at[at + k < len(group)]
        i = i[group[i] == group[i + k]]
        i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= radius]
        left.append(fp[i])
        right.append(fp[i + k])
    for k in np.flatnonzero(size > SMALL):
        rows = slice(start[k], start[k] + size[k])
        some, sides = fp[rows], side[rows]
        if (sides == 0).all():
            x = y = some
            every = some
        else:
            x, y = some[sides == 1], some[sides == 2]
            every = np.concatenate([x, y])
        label = tile_labels(x, y, radius)
        moved = np.flatnonzero(label != np.arange(len(label)))
        left.append(every[moved])
        right.append(every[label[moved]])
    a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
    yield pd.DataFrame({"a": a, "b": b})


def links(fps: DataFrame, radius: int = RADIUS, group: int = GROUP) -> DataFrame:
    """Links ``a``, ``b`` that connect exactly those distinct fingerprints (column ``fp``) which chains of links do.

    With two differing bits at least two of four 16-bit blocks agree, so all links lie inside the six groupings by
    two blocks (``radius`` 2 at most). A grouping key with more than ``group`` fingerprints is dealt out by the
    population count of the fingerprint, and by salt beyond that: rows meet in pairs of tiles, only where the counts
    differ by no more than the radius.
    """
    if radius > 2:
        raise ValueError("the groupings by two of four blocks find links of at most two bits")
    block = [F.shiftrightunsigned("fp", 16 * k).bitwiseAND(0xFFFF) for k in range(4)]
    picks = [(i, j) for i in range(4) for j in range(i)]
    keys = F.array(*(F.xxhash64(F.lit(n), block[i], block[j]) for n, (i, j) in enumerate(picks)))
    keyed = fps.select("fp", F.explode(keys).alias("k"))
    large = keyed.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > group)
    keyed = keyed.join(large, "k", "left")
    ones = F.bit_count("fp")
    salts = F.ceil(F.col("n") / (4 * group)).cast("int")
    salt = F.pmod(F.xxhash64("fp"), salts)
    every = F.sequence(F.lit(0), salts - 1)

    def met(p, r, q, t, side):
        return F.struct(F.xxhash64("k", p, r, q, t).alias("g"), F.lit(side).alias("side"))

    def as_first(d):
        return F.transform(every, lambda t: met(ones, salt, ones + d, t.cast("bigint"), 1))

    def as_second(d):
        return F.transform(every, lambda t: met(ones - d, t.cast("bigint"), ones, salt, 2))

    apart = range(radius + 1)
    tiled = F.concat(*map(as_first, apart), *map(as_second, apart))
    alone = F.array(F.struct(F.col("k").alias("g"), F.lit(0).alias("side")))
    dealt = keyed.select("fp", F.explode(F.when(F.col("n").isNull(), alone).otherwise(tiled)).alias("x"))
    dealt = dealt.select("fp", "x.g", "x.side").repartition("g")
    return dealt.mapInPandas(lambda b: _group_links(b, radius), "a long, b long").distinct()


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS, width: int = SHINGLE
) -> DataFrame:
    """``key``, ``fingerprint`` (16 lowercase hex digits) and ``component_id`` for every row.

    Fingerprints that differ in at most ``radius`` bits are linked; the component is the least key reachable. Texts
    without words share fingerprint 0 and are linked like others. Equal texts share a fingerprint, so copies meet as
    one row. Null keys are kept and never are a component's id unless all its keys are null. Repeated rows repeat in
    the result. An empty table gives an empty result. Columns besides the two named are not read.
    """
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    rows = written(with_fingerprint(rows).select("key", "fp"), "fingerprints")
    fps = written(rows.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), radius))
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    fps = fps.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    least = fps.groupBy("root").agg(F.min("first").alias("component_id"))
    found = rows.join(fps.join(least, "root").select("fp", "component_id"), "fp")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select(F.col("key").alias(key), digits.alias("fingerprint"), "component_id")
