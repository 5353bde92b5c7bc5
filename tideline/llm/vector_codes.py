"""Short codes of vectors: each part is named by its nearest codebook entry, found by slicing and intersecting bitmasks.

For every dimension of a part the entries' coordinates are sorted, and a prefix mask
says which entries are among the first k of them. A range of coordinates is then the
difference of two masks, and the intersection over the dimensions (an AND of 64-bit
words) holds every entry inside a box around the vector's part. The box's half side is
the distance to some entry, so no entry outside of it can be nearer: the candidates in
it are compared exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import written

PARTS = 16
ENTRIES = 64
SCALE = 256
ROUNDS = 2
#: Components beyond this (after scaling) have no code, since squared distances would not fit in 64 bits.
LARGEST = 2**24
#: Parts that are compared at once.
BLOCK = 8192


class Slices:
    """One part position's codebook, prepared for exact nearest-entry search."""

    def __init__(self, entries: np.ndarray):
        if len(entries) > 64:
            raise ValueError("a mask has 64 bits, one for each entry")
        self.entries = entries
        self.order = np.argsort(entries, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(entries.T, self.order, axis=1)
        bits = np.uint64(1) << self.order.astype(np.uint64)
        none = np.zeros((len(bits), 1), np.uint64)
        self.first = np.concatenate([none, np.bitwise_or.accumulate(bits, axis=1)], axis=1)

    def nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of and squared distance to each row's nearest entry; of equally near ones the lowest index."""
        index, error = np.empty(len(rows), np.int64), np.empty(len(rows), np.int64)
        for k in range(0, len(rows), BLOCK):
            index[k : k + BLOCK], error[k : k + BLOCK] = self._nearest(rows[k : k + BLOCK])
        return index, error

    def _radius(self, rows: np.ndarray) -> np.ndarray:
        """A distance within which each row has an entry: that to the best of the entries nearest in one dimension."""
        best = np.full(len(rows), np.iinfo(np.int64).max)
        for d, line in enumerate(self.sorted):
            at = np.searchsorted(line, rows[:, d])
            low, high = np.maximum(at - 1, 0), np.minimum(at, len(line) - 1)
            place = np.where(rows[:, d] - line[low] <= line[high] - rows[:, d], low, high)
            best = np.minimum(best, ((rows - self.entries[self.order[d][place]]) ** 2).sum(axis=1))
        # One more than the rounded root never cuts off an entry at exactly that distance.
        return np.sqrt(best.astype(np.float64)).astype(np.int64) + 1

    def _nearest(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        radius = self._radius(rows)
        inside = np.full(len(rows), 2**64 - 1, np.uint64)
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, rows[:, d] - radius, side="left")
            high = np.searchsorted(line, rows[:, d] + radius, side="right")
            inside &= self.first[d][high] ^ self.first[d][low]
        bits = np.unpackbits(inside.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, entry = np.nonzero(bits)
        away = ((rows[row] - self.entries[entry]) ** 2).sum(axis=1)
        start = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(away, start)
        at = np.flatnonzero(away == least[row])
        hit, first = np.unique(row[at], return_index=True)
        assert len(hit) == len(rows)
        return entry[at[first]], least


def _columns(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        flat = batch.column(batch.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False)
        yield batch, flat.astype(np.int64).reshape(len(batch), width)


def _sums(books: np.ndarray):
    """A task's rows, summed by part and nearest entry: at most one row for each entry of each part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, size = books.shape
        slices = [Slices(b) for b in books]
        total, count = np.zeros_like(books), np.zeros((parts, entries), np.int64)
        for _, rows in _columns(batches, parts * size):
            for p in range(parts):
                some = rows[:, p * size : (p + 1) * size]
                index, _ = slices[p].nearest(some)
                np.add.at(total[p], index, some)
                count[p] += np.bincount(index, minlength=entries)
        p, e = np.nonzero(count)
        place = np.repeat(p * entries + e, size)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(place, pa.int32()),
                pa.array(np.tile(np.arange(size), len(p)), pa.int32()),
                pa.array(total[p, e].reshape(-1), pa.int64()),
                pa.array(np.repeat(count[p, e], size), pa.int64()),
            ],
            names=["place", "position", "total", "n"],
        )

    return run


def _codes(books: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, _, size = books.shape
        slices = [Slices(b) for b in books]
        for batch, rows in _columns(batches, parts * size):
            found = [slices[p].nearest(rows[:, p * size : (p + 1) * size]) for p in range(parts)]
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            error = np.sum([e for _, e in found], axis=0)
            code = [row.tobytes().hex() for row in index]
            keep = [batch.column(k) for k in range(2)]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(code, pa.string()), pa.array(error, pa.int64())], names=["key", "label", "code", "error"]
            )

    return run


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, position) of whole-number vectors ``key``, ``v``; nothing if there are none.

    Entries start as the vectors of the smallest keys (fewer than ``entries`` if there are fewer vectors). Only they
    and, for each round, one row of sums per entry reach the driver; the sums are made in the tasks first.
    """
    first = vectors.orderBy(F.col("key").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not first:
        return None
    books = np.array([r["v"] for r in first], np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2).copy()
    for _ in range(rounds):
        sums = vectors.select("v").mapInArrow(_sums(books), "place int, position int, total long, n long")
        total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
        rows = sums.groupBy("place", "position").agg(total, F.sum("n").alias("n")).collect()
        for r in rows:
            books[r["place"] // books.shape[1], r["place"] % books.shape[1], r["position"]] = int(r["total"]) // r["n"]
    return books


def digest(books: np.ndarray) -> str:
    """The SHA-256 of all entries' components in decimal, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def whole_numbers(df: DataFrame, key: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """``key``, ``label`` and ``v``, the vector's components as floor(scale * x), of the rows that can have one.

    Left out are null vectors and those with a null or non-finite component. ``v`` is null if the length is not a
    multiple of ``parts`` or a component is too large.
    """
    x = F.col("x").cast("array<double>")
    rows = df.select(F.col(key).alias("key"), F.col(label).alias("label"), F.col(vector).alias("x"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    rows = rows.where(F.col("x").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    fits = F.forall(x, lambda c: F.abs(c * scale) < LARGEST) & (F.size("x") > 0) & (F.size("x") % parts == 0)
    # Without decimals: floor() of a double is a long already.
    return rows.select("key", "label", F.when(fits, F.transform(x, lambda c: F.floor(c * scale))).alias("v"))


def encode(
    df: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """``key``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every vector.

    Components become floor(scale * x); vectors are cut into ``parts`` equal parts with a codebook each, trained in
    ``rounds`` rounds from the vectors of the smallest keys (:func:`train`). The code names each part's nearest entry
    (two hex digits; of equally near ones the lowest), the error sums the squared distances, the label's error sums
    the errors of all its rows, null labels together.

    Null vectors and those with a null or non-finite component are dropped. All vectors must have one length: those of
    another length than the smallest key's vector, of a length that is no multiple of ``parts`` or with a component of
    2^16 or more (at a scale of 256) keep their row, but have no code and no error and take no part in training.
    Repeated keys are rows of their own (their order at the start is that of the vectors), null keys come last.
    Fewer vectors than ``entries`` give shorter codebooks, an empty table an empty result. Other columns are not read.
    """
    rows = written(whole_numbers(df, key, vector, label, parts, scale), "whole-numbers")
    usable = rows.where("v IS NOT NULL")
    least = usable.orderBy(F.col("key").asc_nulls_last(), "v").limit(1).select(F.size("v").alias("n")).collect()
    usable = usable.where(F.size("v") == least[0]["n"]) if least else usable
    books = train(usable, parts, entries, rounds)
    names = df.select(F.col(key).alias("key"), F.col(label).alias("label")).schema
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names)
    if books is None:
        coded = rows.select("key", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        sha = hashlib.sha256(b"").hexdigest()
    else:
        schema = f"{types}, code string, error long"
        coded = usable.select("key", "label", "v").mapInArrow(_codes(books), schema)
        other = rows.where(F.col("v").isNull() | (F.size("v") != least[0]["n"]))
        coded = coded.unionByName(other.select("key", "label"), allowMissingColumns=True)
        sha = digest(books)
    coded = written(coded, "codes")
    # One row for each label after partial sums; the join's larger side is cut where one label dominates.
    sums = coded.groupBy(F.col("label").alias("l")).agg(F.sum("error").alias("label_error"))
    found = coded.join(sums, F.col("label").eqNullSafe(F.col("l")))
    return found.select(F.col("key").alias(key), "code", "error", "label_error", F.lit(sha).alias("codebooks_sha256"))
