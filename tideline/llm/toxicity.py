"""Toxicity: subword embeddings averaged over a text into a linear softmax, trained jointly."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.llm.word_sums import WordSums

BUCKETS = 1 << 16
SHORTEST, LONGEST = 3, 6
WIDTH = 8
EPOCHS = 15
THRESHOLD = 0.7
#: The bound of what is learned from: about so many labelled documents of each class.
SAMPLE_DOCS = 2000
LEAST_KEPT = 20
MIX = np.uint64(0x9E3779B97F4A7C15)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all byte n-grams (3 to 6, with marked word ends) and of the words themselves, with their words."""
    raw = [b"<" + w.lower().encode() + b">" for w in words]
    length = np.fromiter(map(len, raw), np.int64, len(raw))
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    start = np.cumsum(length) - length
    owner = np.repeat(np.arange(len(raw)), length)
    room = np.repeat(start + length, length) - np.arange(len(flat))
    buckets, owners = [], []
    with np.errstate(over="ignore"):
        hashed = np.zeros(len(flat), np.uint64)
        for n in range(1, LONGEST + 1):
            # hashed[i] covers the n bytes from i on.
            hashed[: len(flat) - n + 1] = hashed[: len(flat) - n + 1] * MIX + flat[n - 1 :] + np.uint64(n)
            hashed[: len(flat) - n + 1] ^= hashed[: len(flat) - n + 1] >> np.uint64(29)
            if n >= SHORTEST:
                at = np.flatnonzero(room >= n)
                buckets.append(hashed[at] * MIX >> np.uint64(48))
                owners.append(owner[at])
        power = np.cumprod(np.r_[np.uint64(1), np.full(max(1, length.max(initial=1)) - 1, MIX, np.uint64)])
        whole = np.add.reduceat((flat + np.uint64(977)) * power[np.arange(len(flat)) - np.repeat(start, length)], start)
        whole ^= whole >> np.uint64(31)
        buckets.append(whole * MIX >> np.uint64(48))
        owners.append(np.arange(len(raw)))
    return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


class ToxicityModel:
    """A bag of subword embeddings, averaged, and a softmax over two classes.

    Since the softmax is linear in the average, scoring needs of every bucket only what its embedding adds to the
    difference of the two logits.
    """

    def __init__(self, weight: np.ndarray, bias: float):
        self.weight, self.bias, self.words = weight, bias, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"words": None}

    def word_numbers(self, words: list[str]) -> np.ndarray:
        buckets, owner = subwords(words)
        total = np.bincount(owner, self.weight[buckets], minlength=len(words))
        return np.stack([total, np.bincount(owner, minlength=len(words))], axis=1)

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of class 1 for each whole text; a text without words gets that of the bias."""
        if self.words is None:
            self.words = WordSums(self.word_numbers, 2)
        sums = self.words.sums(texts)
        return 1 / (1 + np.exp(-np.clip(sums[:, 0] / np.maximum(sums[:, 1], 1) + self.bias, -60, 60)))


def train(bags: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray, prior: float) -> ToxicityModel:
    """bags: buckets and their shares of each text; label: 0 or 1; prior: share of class 1 outside the sample.

    Embeddings and softmax are trained together by Adam. The classes weigh alike in training; the bias is then moved
    to the true prior. A fifth of the texts is kept back, and on them the logit is rescaled, since it is far too
    steep on what the embeddings were fitted to; with fewer than ``LEAST_KEPT`` of a class that is left out.
    """
    draw = np.random.default_rng(5)
    shuffled = draw.permutation(len(bags))
    kept = shuffled[: len(bags) // 5]
    if min((label[kept] == c).sum() for c in (0, 1)) < LEAST_KEPT:
        kept = shuffled[:0]
    used = shuffled[len(kept) :]
    kept_bags, kept_label = [bags[i] for i in kept], label[kept]
    bags, label = [bags[i] for i in used], label[used]
    emb = draw.normal(0, 0.1, (BUCKETS, WIDTH)).astype(np.float32)
    top = draw.normal(0, 0.5, (WIDTH, 2)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in (emb, top, bias)]
    share = np.array([(label == c).mean() for c in (0, 1)])
    weight = (0.5 / share[label]).astype(np.float32)
    t = 0
    for epoch in range(EPOCHS):
        order = draw.permutation(len(bags))
        for begin in range(0, len(order), 64):
            some = order[begin : begin + 64]
            size = [len(bags[i][0]) for i in some]
            ids = np.concatenate([bags[i][0] for i in some]).astype(np.int64)
            part = np.concatenate([bags[i][1] for i in some])
            owner = np.repeat(np.arange(len(some)), size)
            rows = emb[ids] * part[:, None]
            first = np.cumsum(size) - size
            mean = np.add.reduceat(rows, first, axis=0)
            logits = mean @ top + bias
            e = np.exp(logits - logits.max(axis=1, keepdims=True))
            error = e / e.sum(axis=1, keepdims=True)
            error[np.arange(len(some)), label[some]] -= 1
            error *= weight[some][:, None] / len(some)
            down = (error @ top.T)[owner] * part[:, None]
            grad = np.stack([np.bincount(ids, down[:, k], minlength=BUCKETS) for k in range(WIDTH)], axis=1)
            t += 1
            rate = 0.03 * (1 - epoch / EPOCHS) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for p, g, (m, v) in zip((emb, top, bias), (grad, mean.T @ error, error.sum(axis=0)), moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= (rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)
    odds = np.log(prior / (1 - prior))
    model = ToxicityModel((emb @ (top[:, 1] - top[:, 0])).astype(np.float64), float(bias[1] - bias[0] + odds))
    if kept_bags:
        logit = np.array([model.weight[ids] @ part for ids, part in kept_bags]) + model.bias
        slope, offset = rescaled(logit, kept_label, prior)
        model.weight *= slope
        model.bias = model.bias * slope + offset
    return model


def rescaled(logit: np.ndarray, label: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset of the logistic fit of labels to logits, at the true prior, by Newton's method."""
    middle, spread = logit.mean(), logit.std() + 1e-9
    x = np.stack([(logit - middle) / spread, np.ones(len(logit))], axis=1)
    share = (label == 1).mean()
    weight = np.where(label == 1, prior / share, (1 - prior) / (1 - share))
    fit = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-x @ fit))
        curve = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag([1e-3, 1e-6])
        fit -= np.linalg.solve(curve, x.T @ (weight * (p - label)))
    return float(fit[0] / spread), float(fit[1] - fit[0] * middle / spread)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A whole text's buckets and their shares."""
    words = text.split()
    if not words:
        return np.zeros(1, np.int64), np.zeros(1, np.float32)
    counts = np.zeros(BUCKETS, np.int64)
    for k in range(0, len(words), 50_000):
        counts += np.bincount(subwords(words[k : k + 50_000])[0], minlength=BUCKETS)
    ids = np.flatnonzero(counts)
    return ids, (counts[ids] / counts.sum()).astype(np.float32)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicityModel:
    """Learns from documents with a label of 0 or 1 in ``labels``; others are left out.

    The sample is bounded: about ``SAMPLE_DOCS`` labels of each class, chosen by a hash of the key before their
    documents are looked up, so that these few keys are broadcast and no text is shuffled. The driver gets bags of the
    whole texts, of at most ``BUCKETS`` numbers each. Without both classes the model scores every text alike: the
    share of class 1, or 0 if nothing is labelled.
    """
    rows = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    rows = rows.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    prior = sizes.get(1, 0) / max(total, 1)
    if len(sizes) < 2:
        return ToxicityModel(np.zeros(BUCKETS), 60.0 if prior else -60.0)
    limit = F.when(F.col("label") == 1, SAMPLE_DOCS / sizes[1]).otherwise(SAMPLE_DOCS / sizes[0])
    some = rows.where(F.pmod(F.xxhash64("key"), F.lit(1_000_000)) < limit * 1_000_000)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(some), "key")

    def bags(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            found = [bag(t or "") for t in some["text"]]
            blobs = [struct.pack("<I", len(i)) + i.astype("<u2").tobytes() + w.tobytes() for i, w in found]
            yield pd.DataFrame({"key": some["key"], "label": some["label"], "bag": blobs})

    got = rows.mapInPandas(bags, "key long, label int, bag binary").toPandas()
    got = got.sort_values(["key", "label"], kind="stable")
    parsed = []
    for blob in got["bag"]:
        (n,) = struct.unpack_from("<I", blob)
        parsed.append((np.frombuffer(blob, "<u2", n, 4), np.frombuffer(blob, "<f4", n, 4 + 2 * n)))
    return train(parsed, got["label"].to_numpy(), prior) if got["label"].nunique() > 1 else ToxicityModel(
        np.zeros(BUCKETS), float(np.log(prior / (1 - prior)))
    )


def with_score(
    df: DataFrame, model: ToxicityModel, text: str = "text", score: str = "score", predicted: str = "predicted"
) -> DataFrame:
    """Adds the probability of class 1 of each whole text and whether it is ``THRESHOLD`` or more (1, else 0).

    A null text counts as empty; an empty one gets the score of the bias alone. Rows stay as they are; columns that
    already have the two names are replaced. Only the text is read by the score. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(shared.value.score(texts.tolist()))

    out = df.withColumn(score, scores(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    return out.withColumn(predicted, (F.col(score) >= THRESHOLD).cast("int"))


def held_out(key: str = "doc_id") -> Column:
    """Every third document by the checksum of its key is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 3 == 1, F.lit(False))
