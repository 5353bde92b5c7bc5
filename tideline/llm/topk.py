"""Exact top-k search by inner product: MaxScore over postings of quantised vectors."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import written

K = 10
SCALE = 1024
#: Candidates of a shard and queries of a block that meet in one task.
SHARD = 8192
BLOCK = 2048
#: Non-essential terms that are probed before the candidates are looked at again.
STEP = 8


class Postings:
    """A shard's components by term (dimension), with the least and largest weight of each term.

    All vectors are of one length here; a missing component is a weight of 0, as for a document without the term.
    """

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray], width: int, dtype):
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.weights = np.zeros((width, len(ids)), dtype)
        for column, row in enumerate(order):
            v = vectors[row][:width]
            self.weights[: len(v), column] = v
        self.least, self.most = self.weights.min(axis=1), self.weights.max(axis=1)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the query's k best candidates besides itself, ties to the smaller id.

        A term adds between ``low`` and ``high`` to a score. The terms of the widest ranges, which make up half of
        the sum of all ranges, are essential: their postings are traversed for all candidates. The best so far give
        the score to beat. The other terms are probed, widest range first, only for candidates that may still reach
        it if every term left adds its most.
        """
        a, b = query * self.least, query * self.most
        low, high = np.minimum(a, b), np.maximum(a, b)
        terms = np.argsort(-(high - low), kind="stable")
        spread = np.cumsum((high - low)[terms])
        essential = int(np.searchsorted(spread, spread[-1] / 2)) + 1 if len(terms) else 0
        first = terms[:essential]
        score = query[first] @ self.weights[first] if essential else np.zeros(len(self.ids), self.weights.dtype)
        alive = np.flatnonzero(self.ids != own)
        score = score[alive]
        at = essential
        while at < len(terms) and len(alive) > k:
            rest = terms[at:]
            best = np.argpartition(-score, k - 1)[:k]
            full = score[best] + query[rest] @ self.weights[np.ix_(rest, alive[best])]
            keep = score + high[rest].sum() >= full.min()
            alive, score = alive[keep], score[keep]
            probed = rest[:STEP]
            score = score + query[probed] @ self.weights[np.ix_(probed, alive)]
            at += STEP
        if at < len(terms):
            rest = terms[at:]
            score = score + query[rest] @ self.weights[np.ix_(rest, alive)]
        order = np.lexsort((self.ids[alive], -score))[:k]
        return self.ids[alive][order], score[order]


def _number_type(left: list[np.ndarray], right: list[np.ndarray], width: int):
    """Floats if all sums of products are exact in them, else Python's integers."""
    largest = [max((int(np.abs(v.astype(object)).max()) for v in side if len(v)), default=0) for side in (left, right)]
    return np.float64 if largest[0] * largest[1] * max(width, 1) < 2**52 else object


def quantised(df: DataFrame, key: str, vector: str, scale: int, repeats: bool = False) -> DataFrame:
    """``id``, ``v``, ``n``: every component x of the usable vectors as floor(scale * x), and the number of such rows.

    Vectors that are null or hold a null or a value that isn't finite are left out, as are null keys. Of rows that
    share a key the least vector counts, once; with ``repeats`` all of them do.
    """
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & usable)
    rows = rows.select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))).alias("v"),
    )
    if repeats:
        return rows.groupBy("id", "v").agg(F.count("*").alias("n"))
    return rows.groupBy("id").agg(F.min("v").alias("v")).withColumn("n", F.lit(1).cast("long"))


def search(
    df: DataFrame,
    queries: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    repeats: bool = False,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: each query's k best rows of ``df``, all if fewer.

    Scores are inner products of the quantised components, exact; of vectors of different length the common
    components count. Ties go to the smaller key; rows with the query's own key are no candidates for it. Every
    shard of candidates meets every block of queries in a task of bounded size; each pair sends k rows on.

    ``repeats``: rows that share a key are candidates and queries of their own; the ranks of a key's queries are common.
    Of equal rows k at most are looked at, since no more can be among the best.
    """
    vectors = written(quantised(df, key, vector, scale, repeats), "vectors")
    asked = written(quantised(queries, key, vector, scale, repeats), "query-vectors")
    shards = max(1, -(-vectors.count() // SHARD))
    blocks = max(1, -(-asked.count() // BLOCK))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("id", "v", "n", F.pmod(F.xxhash64("id", "v"), F.lit(shards)).cast("int").alias("shard"))
    left = left.withColumn("block", every(blocks))
    right = asked.select("id", "v", "n", F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).cast("int").alias("block"))
    right = right.withColumn("shard", every(shards))

    def meet(shard: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        names = ["query_id", "vec_id", "score"]
        if not len(shard) or not len(block):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
        shard = shard.loc[shard.index.repeat(shard["n"].clip(upper=k))]
        mine, theirs = list(shard["v"]), list(block["v"])
        width = max(map(len, theirs))
        dtype = _number_type(mine, theirs, width)
        postings = Postings(shard["id"].to_numpy(), mine, width, dtype)
        out = []
        for own, v, n in zip(block["id"], theirs, block["n"]):
            query = np.zeros(width, dtype)
            query[: len(v)] = v
            ids, score = (np.repeat(x, min(n, k))[:k] for x in postings.search(own, query, k))
            out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": [_long(s) for s in score]}))
        return pd.concat(out)

    found = (
        left.groupBy("shard", "block")
        .cogroup(right.groupBy("shard", "block"))
        .applyInPandas(meet, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _long(score) -> int:
    """A score as a long; what doesn't fit is the nearest one that does."""
    return max(-(2**63), min(2**63 - 1, int(score)))
