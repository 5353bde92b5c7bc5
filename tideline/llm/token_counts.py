"""Token counts of a word-end BPE vocabulary, by merging ragged arrays rank by rank."""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Memo, parts, runs_by_size

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Characters whose words are looked up together.
RUN_CHARS = 1 << 21
NONE = np.int64(1 << 40)
#: White space of Unicode; ``str.split`` would also split at the four separators U+001C to U+001F.
SPACES = re.compile("[\t-\r \x85\xa0  -     　]+")
SEPARATORS = "\x1c\x1d\x1e\x1f"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def split_words(text: str) -> list[str]:
    """The words between white space."""
    if any(c in text for c in SEPARATORS):
        return [w for w in SPACES.split(text) if w]
    return text.split()


def lower_each(text: str) -> str:
    """Lower case character by character, so without the special form of a final sigma."""
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


class WordBpe:
    """Counts tokens as the vocabulary file's library does: NFC, lower case, split, merge."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.special = [t["content"] for t in spec["added_tokens"] if t["special"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        self.memo = Memo(self.counts)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def merged_lengths(self, sequences: list[bytes]) -> np.ndarray:
        """Symbols that are left of each sequence (none empty) after all merges.

        All sequences lie in one flat array. A round finds each sequence's lowest rank and merges every
        occurrence of that pair, from the left where they overlap. A pair that a merge creates holds a symbol
        that is younger than the merge, so it never ranks lower and one round per rank equals one merge at a time.
        """
        total = np.zeros(len(sequences), np.int64)
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        flat = np.frombuffer(b"".join(sequences), np.uint8)
        symbol = self.inner[flat]
        ends = np.cumsum(lengths) - 1
        symbol[ends] = self.last[flat[ends]]
        owner = np.repeat(np.arange(len(sequences)), lengths)
        rank = np.full(len(symbol), NONE)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inside] = self.rank(symbol[inside], symbol[inside + 1])
        while len(owner):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[starts, len(owner)])
            best = np.minimum.reduceat(rank, starts)
            over = best == NONE
            total[owner[starts[over]]] = sizes[over]
            hit = rank == np.repeat(np.where(over, -1, best), sizes)
            at = np.flatnonzero(hit)
            run = np.flatnonzero(np.r_[True, np.diff(at) != 1]) if len(at) else at
            place = np.arange(len(at)) - np.repeat(run, np.diff(np.r_[run, len(at)]))
            at = at[place % 2 == 0]
            symbol[at] = self.made[rank[at]]
            keep = np.repeat(~over, sizes)
            keep[at + 1] = False
            new = np.zeros(len(symbol), bool)
            new[at] = True
            symbol, owner, rank, new = symbol[keep], owner[keep], rank[keep], new[keep]
            # Only pairs with a new symbol on either side have changed.
            stale = np.flatnonzero(new | np.r_[new[1:], False]) if len(new) else at[:0]
            rank[stale] = NONE
            stale = stale[stale + 1 < len(owner)]
            stale = stale[owner[stale] == owner[stale + 1]]
            rank[stale] = self.rank(symbol[stale], symbol[stale + 1])
        return total

    def counts(self, words: list[str]) -> list[int]:
        """Tokens of each word; a word has no white space."""
        pieces, owner = [], []
        for i, word in enumerate(words):
            found = self.pieces(lower_each(unicodedata.normalize("NFC", word)))
            pieces += found
            owner += [i] * len(found)
        out = np.zeros(len(words), np.int64)
        if pieces:
            np.add.at(out, owner, self.merged_lengths([p.encode() for p in pieces]))
        return out.tolist()

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each whole text. A special token's string counts as that one token."""
        out = []
        for run in runs_by_size(texts, len, RUN_CHARS):
            totals, lists, owner = [0] * len(run), [], []
            for i, text in enumerate(run):
                if "<|" in text:
                    for token in self.special:
                        totals[i] += text.count(token)
                        text = text.replace(token, " ")
                for part in parts(text, RUN_CHARS):
                    lists.append(split_words(part))
                    owner.append(i)
                    if len(part) >= RUN_CHARS:  # of a long text, one part's words at a time
                        self.add(lists, owner, totals)
            self.add(lists, owner, totals)
            out += totals
        return out

    def add(self, lists: list[list[str]], owner: list[int], totals: list[int]) -> None:
        """Adds the tokens of lists of words to their owners' totals and empties the lists."""
        self.memo.need(set().union(*lists))
        for i, words in zip(owner, lists):
            totals[i] += sum(map(self.memo.__getitem__, words))
        lists.clear()
        owner.clear()


@functools.lru_cache(2)
def word_bpe(path: str) -> WordBpe:
    """One per worker, so that its memo serves all tasks there."""
    return WordBpe(path)


def count_tokens(
    df: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT, prefix: str = ""
) -> DataFrame:
    """Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens) of the whole text.

    A null text counts as empty: no bytes, no tokens. Rows are kept as they are, repeated ones too; of columns
    with these names only the new ones stay, unless ``prefix`` renames them. No shuffle, one pass.
    """
    place = path or public_tokenizers.path(VOCABULARY)

    @F.pandas_udf("long")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = word_bpe(place)
        for texts in batches:
            yield pd.Series(bpe.count(texts.tolist()), dtype="int64")

    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = df.withColumns(
        {f"{prefix}n_bytes": F.octet_length(whole).cast("long"), f"{prefix}n_tokens": tokens(whole)}
    )
    return out.withColumn(f"{prefix}over_limit", F.col(f"{prefix}n_tokens") > limit)
