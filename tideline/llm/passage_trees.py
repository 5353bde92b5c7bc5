"""Passages that repeat across documents, found in suffix trees that are split by variable-length prefixes.

Suffixes start at anchors: of the places in a window of ``WINDOW`` words where ``PREFIX``
words fit, the one whose words have the least hash. Equal windows have their anchor at the
same place, so only anchored suffixes need a tree; there is about one for 22 words.
Consecutive windows with one anchor make a snippet, and its suffix reaches from the anchor
to the last window's end.

The suffixes are split by their first words: ``PREFIX`` words at first, more for those
prefixes that too many different suffixes share, so that every group fits in memory. Each
group builds the tree of its suffixes, top down, and a second tree of the words that
precede the anchors, read backwards. A node of the one at depth d and a node of the other
at depth ``WINDOW`` - d that two snippets share are a repeated passage; the longest ones are
the maximal repeats. A prefix that stays frequent over a whole window is such a node by
itself and needs no tree, only the least document that has it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pandas as pd
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Rows, parts, written

WINDOW = 50
PREFIX = 8
#: Different suffixes of one prefix that one task takes into a tree; longer prefixes split larger groups.
GROUP = 10_000
#: A document without an id counts as the last one.
LAST = 2**63 - 1
#: Hashed words that a worker remembers, by the bytes of their text.
REMEMBERED = 32 << 20

#: ``place`` packs a snippet's first window and how many words behind it the anchor and the last window lie.
SNIPPET = "doc long, row long, key long, place long, content binary"
LARGEST_WINDOW = 255
#: Bytes of the digest that tells the snippets of one prefix apart.
DIGEST = 12


class _WordHashes:
    """64-bit numbers of words; forgets all when the words take too much memory."""

    def __init__(self) -> None:
        self.known, self.size = {}, 0

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if self.size > REMEMBERED:
            self.known, self.size = {}, 0
        known = self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_intdigest(w)
            self.size += len(w) + 100
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def word_blocks(text: str | None, window: int = WINDOW) -> Iterator[tuple[int, list[bytes]]]:
    """A text's words in blocks, each with the number of its first word; every window lies in exactly one block.

    Words are what stands between ASCII white space. A block's last ``window`` - 1 words open the next one too.
    """
    words, first = [], 0
    for part in parts(text or ""):
        words += part.encode().split()
        if len(words) >= window:
            yield first, words
            first += len(words) - window + 1
            words = words[len(words) - window + 1 :]


def snippets(words: list[bytes], hashes: np.ndarray, window: int, prefix: int) -> Iterator[tuple[int, int, int, int]]:
    """(key, anchor, low, high) of every run of windows with one anchor: the windows start at words low to high."""
    if len(words) < window:
        return
    factor = np.uint64(0x9E3779B97F4A7C15)
    rolled = np.zeros(len(words) - prefix + 1, np.uint64)
    for k in range(prefix):
        rolled = rolled * factor + hashes[k : k + len(rolled)]
    keys = _mixed(rolled)
    places = window - prefix + 1
    at = np.empty(len(words) - window + 1, np.int64)
    for k in range(0, len(at), 1 << 16):
        some = sliding_window_view(keys[k : k + (1 << 16) + places - 1], places)[: len(at) - k]
        at[k : k + len(some)] = some.argmin(axis=1) + np.arange(k, k + len(some))
    cut = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    low, high = cut, np.r_[cut[1:] - 1, len(at) - 1]
    signed = keys.view(np.int64)
    yield from zip(signed[at[cut]].tolist(), at[cut].tolist(), low.tolist(), high.tolist())


def _digest(*words: bytes | list[bytes]) -> bytes:
    return blake2b(b"\n".join(w if isinstance(w, bytes) else b" ".join(w) for w in words), digest_size=16).digest()


def _snippet_rows(batches: Iterator[pd.DataFrame], window: int, prefix: int) -> Iterator[pd.DataFrame]:
    hashed = _WordHashes()
    names = [c.split()[0] for c in SNIPPET.split(", ")]
    for batch in batches:
        out = []
        for doc, row, text in zip(batch["doc"], batch["row"], batch["text"]):
            for first, words in word_blocks(text, window):
                whole = b" ".join(words)
                end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
                start = np.r_[0, end[:-1] + 1]
                for key, at, low, high in snippets(words, hashed(words), window, prefix):
                    content = blake2b(whole[start[low] : end[high + window - 1]], digest_size=DIGEST, salt=str(at - low).encode())
                    out.append((doc, row, key, (first + low) << 16 | (at - low) << 8 | (high - low), content.digest()))
                if len(out) > 50_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        yield pd.DataFrame(out, columns=names)


def _cut(batches: Iterator[pd.DataFrame], window: int, prefix: int) -> Iterator[pd.DataFrame]:
    """The words of the wanted snippets (``wanted`` lists them in their documents' order), before and from the anchor on."""
    names = ["key", "content", "first", "low", "high", "before", "after", "right", "left"]
    half = (window - prefix) // 2
    for batch in batches:
        out = []
        for doc, text, wanted in zip(batch["doc"], batch["text"], batch["wanted"]):
            wanted = sorted((w["place"], w["key"], w["content"]) for w in wanted)
            k = 0
            for begin, words in word_blocks(text, window):
                while k < len(wanted):
                    place, key, content = wanted[k]
                    low = (place >> 16) - begin
                    at, high = low + (place >> 8 & 255), low + (place & 255)
                    if high + window > len(words):
                        break
                    before, after = words[low:at][::-1], words[at : high + window]
                    # Longer prefixes for groups that turn out large: to the right for windows that start near the
                    # anchor, to the left for the others.
                    right = xxhash.xxh64_intdigest(b" ".join(after[: window - half]))
                    left = xxhash.xxh64_intdigest(b" ".join(before[: half + 1] + after[:prefix]), seed=1)
                    right, left = (x - 2**64 if x >= 2**63 else x for x in (right, left))
                    out.append((key, content, doc, at - high, at - low, b" ".join(before), b" ".join(after), right, left))
                    k += 1
        yield pd.DataFrame(out, columns=names)


CUT = "key long, content binary, first long, low int, high int, before binary, after binary, right long, left long"


def tree_levels(rows: list[list[bytes]], group: np.ndarray, depth: int) -> np.ndarray:
    """The suffix tree of ``rows`` in levels: its node at depth d for every row, by (d, row); -1 for none that rows share.

    Built top down and lazily: only nodes with two rows or more are taken a word deeper. The root of each ``group``
    is a node of its own, so many groups grow side by side.
    """
    number = Rows()
    levels = np.full((depth + 1, len(rows)), -1, np.int64)
    alive, node = np.arange(len(rows)), group
    for d in range(depth + 1):
        _, node, n = np.unique(node, return_inverse=True, return_counts=True)
        shared = n[node] > 1
        alive, node = alive[shared], node[shared]
        levels[d, alive] = node
        if d == depth or not len(alive):
            break
        longer = np.fromiter((len(rows[r]) > d for r in alive.tolist()), bool, len(alive))
        alive, node = alive[longer], node[longer]
        word = np.fromiter((number[rows[r][d]] for r in alive.tolist()), np.int64, len(alive))
        number.new.clear()
        node = node * (len(number) + 1) + word
    return levels


def repeated(
    before: list[list[bytes]], after: list[list[bytes]], group: np.ndarray, low: np.ndarray, high: np.ndarray, doc: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """(row, offset) of the windows, ``offset`` words before a row's anchor, that a row of a smaller document has too."""
    suffixes = tree_levels(after, group, window)
    contexts = tree_levels(before, group, int(high.max(initial=0)))
    found = []
    for o in range(int(low.min(initial=0)), int(high.max(initial=-1)) + 1):
        some = np.flatnonzero((low <= o) & (o <= high) & (suffixes[window - o] >= 0) & (contexts[o] >= 0))
        if not len(some):
            continue
        order = some[np.lexsort((doc[some], contexts[o, some], suffixes[window - o, some]))]
        right, left = suffixes[window - o, order], contexts[o, order]
        start = np.flatnonzero(np.r_[True, (right[1:] != right[:-1]) | (left[1:] != left[:-1])])
        least = np.repeat(doc[order[start]], np.diff(np.r_[start, len(order)]))
        rows = order[doc[order] > least]
        found.append(np.stack([rows, np.full(len(rows), o)]))
    row, offset = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    order = np.lexsort((offset, row))
    return row[order], offset[order]


def _group_repeats(batches: Iterator[pd.DataFrame], window: int, rows: int) -> Iterator[pd.DataFrame]:
    """Repeated windows of a partition that is ordered by group, whole groups of about ``rows`` rows at a time."""
    held: list[pd.DataFrame] = []

    def judged(frame: pd.DataFrame) -> pd.DataFrame:
        group = np.unique(frame["g"].to_numpy(), return_inverse=True)[1]
        before, after = ([x.split() for x in frame[c]] for c in ("before", "after"))
        row, offset = repeated(before, after, group, *(frame[c].to_numpy(np.int64) for c in ("low", "high", "first")), window)
        return pd.DataFrame({"content": frame["content"].to_numpy()[row], "key": frame["key"].to_numpy()[row], "o": offset})

    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) > rows:
            # Repeated rows of the table bring a snippet more than once.
            frame = pd.concat(held, ignore_index=True).drop_duplicates(["g", "key", "content"])
            whole = frame["g"] != frame["g"].iloc[-1]
            held = [frame[~whole]]
            if whole.any():
                yield judged(frame[whole].reset_index(drop=True))
    if sum(map(len, held)):
        yield judged(pd.concat(held, ignore_index=True).drop_duplicates(["g", "key", "content"]).reset_index(drop=True))


def _single_windows(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    """Every window of the snippets as a prefix of full length: its digest."""
    for batch in batches:
        out = []
        for key, content, first, low, high, before, after in batch[["key", "content", "first", "low", "high", "before", "after"]].itertuples(index=False):
            before, after = before.split(), after.split()
            out += [(key, content, first, o, _digest(before[:o], after[: window - o])) for o in range(low, high + 1)]
        yield pd.DataFrame(out, columns=["key", "content", "first", "o", "node"])


def _kept(batches: Iterator[pd.DataFrame], window: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for text, runs in zip(batch["_text"], batch["_runs"]):
            words = (text or "").encode().split()
            gone = np.zeros(len(words) + 1, np.int64)
            for run in runs if runs is not None else ():
                gone[run["low"]] += 1
                gone[min(len(words), run["high"] + window)] -= 1
            gone = np.cumsum(gone)[:-1] > 0
            edge = np.flatnonzero(np.diff(np.r_[0, gone.astype(np.int8), 0])).reshape(-1, 2)
            kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g]) if len(edge) else b" ".join(words)
            out.append((len(words), int(gone.sum()), edge.tolist(), kept.decode()))
        batch[["_n_words", "_n_removed", "_spans", "_kept"]] = pd.DataFrame(out, columns=list("abcd"), index=batch.index)
        yield batch.drop(columns=["_text", "_runs"])


def removed_windows(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """``doc``, ``row``, ``low``, ``high``: runs of windows of ``docs`` (``doc``, ``row``, ``text``) that a smaller ``doc`` has.

    Windows are numbered by their first word. Runs may touch or overlap.
    """
    if not prefix < window <= LARGEST_WINDOW:
        raise ValueError(f"a window has more words than a prefix and {LARGEST_WINDOW} at most")
    found = docs.mapInPandas(partial(_snippet_rows, window=window, prefix=prefix), SNIPPET)
    found = written(found, "snippets", "zstd")
    # Equal snippets are one node already: all but the least document's are repeats.
    place = F.min(F.struct("doc", "row", "place")).alias("at")
    kinds = found.groupBy("key", "content").agg(place, F.max("doc").alias("last"))
    kinds = written(kinds, "different-snippets", "zstd")
    several = kinds.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    wanted = kinds.join(several, "key").groupBy("at.doc", "at.row")
    wanted = wanted.agg(F.collect_list(F.struct("key", "content", "at.place")).alias("wanted"))
    texts = docs.join(wanted, ["doc", "row"]).select("doc", "text", "wanted")
    cut = written(texts.mapInPandas(partial(_cut, window=window, prefix=prefix), CUT), "cut-snippets", "zstd")
    cut = cut.join(several, "key")

    split = (window - prefix) // 2  # windows this far before the anchor or less lie in the right groups
    plain = cut.where(F.col("n") <= group).withColumn("g", F.col("key"))
    large = cut.where(F.col("n") > group)
    near = large.where(F.col("low") <= split).withColumns({"g": F.col("right"), "high": F.least("high", F.lit(split))})
    far = large.where(F.col("high") > split).withColumns({"g": F.col("left"), "low": F.greatest("low", F.lit(split + 1))})
    longer = written(near.unionByName(far), "longer-prefixes", "zstd")
    sizes = longer.groupBy("g").agg(F.count("*").alias("m"))
    longer = longer.join(sizes, "g")
    names = ["g", "key", "content", "first", "low", "high", "before", "after"]
    grouped = plain.select(names).unionByName(longer.where(F.col("m") <= group).select(names))
    grouped = grouped.repartition("g").sortWithinPartitions("g")
    repeats = grouped.mapInPandas(partial(_group_repeats, window=window, rows=group), "content binary, key long, o int")
    single = longer.where(F.col("m") > group).select(names)
    single = single.mapInPandas(partial(_single_windows, window=window), "key long, content binary, first long, o int, node binary")
    least = single.groupBy("node").agg(F.min("first").alias("least"))
    single = single.join(least, "node").where("first > least").select("content", "key", "o")
    marks = repeats.unionByName(single).groupBy("key", "content").agg(F.collect_set("o").alias("offsets"))

    # All snippets of later documents go, those of the least document where its kind was marked.
    judged = kinds.join(marks, ["key", "content"], "left").where("last > at.doc OR offsets IS NOT NULL")
    # Written, so that the join below has nothing but its own exchanges and a very common snippet's rows can be split.
    judged = written(judged.select("key", "content", F.col("at.doc").alias("least"), "offsets"), "judged-snippets", "zstd")
    low, at = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255)
    whole = F.array(F.struct(low.alias("low"), (low + F.col("place").bitwiseAND(255)).alias("high")))
    single = F.transform("offsets", lambda o: F.struct((low + at - o).alias("low"), (low + at - o).alias("high")))
    runs = F.when(F.col("doc") > F.col("least"), whole).otherwise(single)
    return found.join(judged, ["key", "content"]).select("doc", "row", F.inline(runs))


def remove_passages(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP
) -> DataFrame:
    """``key``, ``n_words``, ``n_removed``, ``spans`` and ``kept`` for every row.

    A word goes if it lies in a window of ``window`` words that also starts in a document with a smaller key; windows
    are judged on the input and never cross documents. Words are what stands between ASCII white space and stay as
    they are. ``spans`` lists the runs of removed words as first and last + 1, ``kept`` joins the others by a space.

    The key is an integer. A null key counts as the largest; rows that share a key don't repeat each other, whatever
    their texts. Null and empty texts have no words. Repeated rows repeat in the result, an empty table gives an
    empty result. Texts of any length are read in blocks. Columns besides the two named are not read.
    """
    doc = F.coalesce(F.col(key).cast("long"), F.lit(LAST))
    docs = df.select(F.col(key).alias("_key"), doc.alias("doc"), F.xxhash64(F.col(text).cast("string")).alias("row"), F.col(text).cast("string").alias("text"))
    runs = removed_windows(docs.select("doc", "row", "text"), window, prefix, group)
    runs = runs.groupBy("doc", "row").agg(F.collect_list(F.struct("low", "high")).alias("_runs"))
    both = docs.withColumnRenamed("text", "_text").join(runs, ["doc", "row"], "left").select("_key", "_text", "_runs")
    kind = df.schema[key].dataType.simpleString()
    schema = f"_key {kind}, _n_words long, _n_removed long, _spans array<array<long>>, _kept string"
    found = both.mapInPandas(partial(_kept, window=window), schema)
    names = {"_key": key, "_n_words": "n_words", "_n_removed": "n_removed", "_spans": "spans", "_kept": "kept"}
    return found.select(*[F.col(a).alias(b) for a, b in names.items()])
