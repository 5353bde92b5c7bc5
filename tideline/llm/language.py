"""Language identification: a bidirectional gated recurrent network over the bytes of words."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import written
from tideline.llm.word_sums import WordSums

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: The bounds of what is learned from: so many different whole texts, and so many different words, for each language.
SAMPLE_DOCS = 1500
SAMPLE_WORDS = 6000
#: Sampled hashes that are broadcast at most.
SENT = 1 << 20
#: A word's bytes are read in sequences of at most this length, with a blank at either end.
SEQUENCE = 24
HIDDEN = 16
EPOCHS = 5


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


class ByteNetwork:
    """Two gated recurrent layers, one for each direction, and a softmax over the languages at every byte."""

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        draw, h = np.random.default_rng(seed), hidden
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p["x" + d] = draw.normal(0, 0.3, (256, 3 * h))
            self.p["h" + d] = draw.normal(0, 1 / np.sqrt(h), (h, 3 * h))
            self.p["c" + d] = np.zeros(h)
        self.p["o"] = draw.normal(0, 1 / np.sqrt(2 * h), (2 * h, classes))
        self.p["b"] = np.zeros(classes)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def run(self, codes: np.ndarray, d: str) -> list:
        """States along one direction, with what the backward pass needs. codes: sequences of one length."""
        n, (x, w, c) = self.hidden, (self.p[k + d] for k in "xhc")
        state, out = np.zeros((len(codes), n), np.float32), []
        for code in codes.T:
            from_x, from_h = x[code], state @ w
            gates = _sigmoid(from_x[:, : 2 * n] + from_h[:, : 2 * n])
            z, r = gates[:, :n], gates[:, n:]
            inner = from_h[:, 2 * n :] + c
            new = np.tanh(from_x[:, 2 * n :] + r * inner)
            out.append((code, state, z, r, inner, new))
            state = new + z * (state - new)
            out[-1] += (state,)
        return out

    def states(self, codes: np.ndarray, d: str) -> np.ndarray:
        """The states of ``run`` alone: position, sequence, unit."""
        n, (x, w, c) = self.hidden, (self.p[k + d] for k in "xhc")
        out = np.zeros((codes.shape[1] + 1, len(codes), n), np.float32)
        for t, code in enumerate(codes.T):
            from_x, from_h = x[code], out[t] @ w
            gates = from_x[:, : 2 * n]
            gates += from_h[:, : 2 * n]
            np.exp(np.negative(gates, out=gates), out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            inner = from_h[:, 2 * n :]
            inner += c
            inner *= gates[:, n:]
            inner += from_x[:, 2 * n :]
            np.tanh(inner, out=inner)
            state = out[t + 1]
            np.subtract(out[t], inner, out=state)
            state *= gates[:, :n]
            state += inner
        return out[1:]

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """For sequences of one length: sequence, position, language."""
        ahead = self.states(codes, "f")
        back = self.states(codes[:, ::-1], "b")[::-1]
        logits = ahead @ self.p["o"][: self.hidden] + back @ self.p["o"][self.hidden :] + self.p["b"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits.transpose(1, 0, 2)

    def gradients(self, codes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> dict:
        """Of the weighted cross entropy over all positions, by backpropagation through time."""
        n = self.hidden
        steps = {"f": self.run(codes, "f"), "b": self.run(codes[:, ::-1], "b")}
        ahead = np.stack([s[-1] for s in steps["f"]], axis=1)
        back = np.stack([s[-1] for s in steps["b"]], axis=1)[:, ::-1]
        both = np.concatenate([ahead, back], axis=2)
        logits = both @ self.p["o"] + self.p["b"]
        e = np.exp(logits - logits.max(axis=2, keepdims=True))
        error = e / e.sum(axis=2, keepdims=True)
        error[np.arange(len(codes)), :, label] -= 1
        error *= (weight / weight.sum() / codes.shape[1])[:, None, None]
        out = {
            "o": both.reshape(-1, 2 * n).T @ error.reshape(-1, error.shape[2]),
            "b": error.sum(axis=(0, 1)),
        }
        down = error @ self.p["o"].T
        for d, part in (("f", down[:, :, :n]), ("b", down[:, ::-1, n:])):
            w = self.p["h" + d]
            gx, gh, gc = np.zeros_like(self.p["x" + d]), np.zeros_like(w), np.zeros(n, np.float32)
            carry = np.zeros((len(codes), n), np.float32)
            for t in range(codes.shape[1] - 1, -1, -1):
                code, state, z, r, inner, new, _ = steps[d][t]
                g = part[:, t] + carry
                g_new = g * (1 - z) * (1 - new * new)
                g_z = g * (state - new) * z * (1 - z)
                g_inner = g_new * r
                g_r = g_new * inner * r * (1 - r)
                from_h = np.concatenate([g_z, g_r, g_inner], axis=1)
                np.add.at(gx, code, np.concatenate([g_z, g_r, g_new], axis=1))
                gh += state.T @ from_h
                gc += g_inner.sum(axis=0)
                carry = g * z + from_h @ w.T
            out |= {"x" + d: gx, "h" + d: gh, "c" + d: gc}
        return out

    def train(self, groups: list[tuple], epochs: int = EPOCHS, rate: float = 0.01, batch: int = 256) -> None:
        """Adam over batches of sequences of one length; groups: codes, labels, weights."""
        draw = np.random.default_rng(11)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(x) for k, x in self.p.items()}
        batches = [(g, k) for g, (codes, *_) in enumerate(groups) for k in range(0, len(codes), batch)]
        t = 0
        for epoch in range(epochs):
            orders = [draw.permutation(len(codes)) for codes, *_ in groups]
            for b in draw.permutation(len(batches)):
                g, k = batches[b]
                rows = orders[g][k : k + batch]
                grads = self.gradients(*(x[rows] for x in groups[g]))
                t += 1
                step = rate * (1 - epoch / epochs) * np.sqrt(1 - 0.999**t) / (1 - 0.9**t)
                for name, grad in grads.items():
                    m[name] += 0.1 * (grad - m[name])
                    v[name] += 0.001 * (grad * grad - v[name])
                    self.p[name] -= (step * m[name] / (np.sqrt(v[name]) + 1e-8)).astype(np.float32)


def sequences(word: str) -> list[bytes]:
    """A word's bytes, cut into sequences with a blank at either end."""
    raw = word.encode()
    return [b" " + raw[k : k + SEQUENCE] + b" " for k in range(0, len(raw), SEQUENCE)]


class LanguageModel:
    """The trained network with its languages. Pickled to the workers; its word tables stay where they are used."""

    def __init__(self, languages: list[str], network: ByteNetwork):
        self.languages, self.network, self.chunks, self.words = languages, network, None, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"chunks": None, "words": None}

    def forget(self) -> None:
        """Frees the word tables. A worker that waits for its next task would hold them beside those that work."""
        self.chunks = self.words = None

    def word_numbers(self, words: list[str]) -> np.ndarray:
        """For each word of letters: the languages' probabilities, summed over its byte positions, and their number."""
        lists = [sequences(w) for w in words]
        flat = [s for some in lists for s in some]
        owner = np.repeat(np.arange(len(words)), [len(some) for some in lists])
        found = np.zeros((len(flat), len(self.languages) + 1))
        length = np.fromiter(map(len, flat), np.int64, len(flat))
        for n in np.unique(length):
            at = np.flatnonzero(length == n)
            for k in range(0, len(at), 1024):
                some = at[k : k + 1024]
                codes = np.frombuffer(b"".join([flat[i] for i in some]), np.uint8).reshape(-1, n)
                found[some, :-1] = self.network.probabilities(codes).sum(axis=1)
                found[some, -1] = n
        return np.add.reduceat(found, np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]]), axis=0)

    def chunk_numbers(self, chunks: list[str]) -> np.ndarray:
        """The same for stretches between white space, of which few are a plain word."""
        return self.words.of([LETTERS.findall(chunk.lower()) for chunk in chunks])

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each whole text and its probability, pooled over all byte positions."""
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        if self.words is None:
            self.words = WordSums(self.word_numbers, len(self.languages) + 1)
            self.chunks = WordSums(self.chunk_numbers, len(self.languages) + 1)
        sums = self.chunks.sums(texts)
        best = sums[:, :-1].argmax(axis=1)
        total = sums[:, -1]
        score = np.where(total > 0, sums[np.arange(len(texts)), best] / np.maximum(total, 1), 0).clip(0, 1)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, total)], score


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learns from rows with a non-null language.

    The sample is bounded: ``SAMPLE_DOCS`` different whole texts of each language, all if there are fewer, those of the
    least hashes; copies of a text count once. Of their different words ``SAMPLE_WORDS``, weighted by how often they occur, are all the driver
    gets. Without any labelled word the model knows no language.
    """
    docs = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    )
    # Only hashes are ranked; the rank limit is applied before the shuffle too. A sampled hash is looked up in the texts.
    hashes = docs.select("lang", F.xxhash64("text").alias("h")).distinct()
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    chosen = written(hashes.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_DOCS).select("lang", "h"), "sampled-texts")
    # Up to a million hashes (hundreds of languages) are sent to the texts, so that no text moves but the sampled ones.
    if chosen.count() <= SENT:
        chosen = F.broadcast(chosen)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            found = Counter((la, w) for t, la in zip(rows["text"], rows["lang"]) for w in LETTERS.findall(t.lower()))
            yield pd.DataFrame([(*k, n) for k, n in found.items()], columns=["lang", "word", "n"])

    words = docs.withColumn("h", F.xxhash64("text")).join(chosen, ["lang", "h"], "left_semi")
    words = words.dropDuplicates(["lang", "h"]).select("text", "lang")
    words = words.mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("word"), "word"))
    rows = words.withColumn("place", place).where(F.col("place") <= SAMPLE_WORDS).drop("place").toPandas()
    rows = rows.sort_values(["lang", "word"])
    languages = sorted(rows["lang"].unique())
    examples: dict[int, list] = {}
    for la, word, n in zip(rows["lang"], rows["word"], rows["n"]):
        for s in sequences(word):
            examples.setdefault(len(s), []).append((s, languages.index(la), 1 + np.log(n)))
    groups = [
        (
            np.frombuffer(b"".join(s for s, _, _ in some), np.uint8).reshape(len(some), -1),
            np.array([la for _, la, _ in some]),
            np.array([w for *_, w in some], np.float32),
        )
        for _, some in sorted(examples.items())
    ]
    network = ByteNetwork(len(languages))
    if len(languages) > 1:
        network.train(groups)
    return LanguageModel(languages, network)


def predictions(model: LanguageModel, batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Language and probability of each text of a task, whose word tables go with it."""
    try:
        for texts in batches:
            found, p = model.predict(texts.tolist())
            yield pd.DataFrame({"lang": found, "score": p})
    finally:
        model.forget()


def with_language(
    df: DataFrame, model: LanguageModel, text: str = "text", lang: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """Adds the predicted language of each whole text and the probability, 0 to 1.

    A text that is null or has no letter gets ``und`` with score 0. Rows stay as they are; columns that already have
    the two names are replaced. Only the text is read by the prediction. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from predictions(shared.value, batches)

    kept = [F.col(f"`{c}`") for c in df.columns if c not in (lang, score)]
    found = predict(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("_language")
    out = df.select(*kept, found)
    return out.select(*kept, F.col("_language.lang").alias(lang), F.col("_language.score").alias(score))


def held_out(key: str = "doc_id") -> Column:
    """Every fifth document by the checksum of its key is never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))
