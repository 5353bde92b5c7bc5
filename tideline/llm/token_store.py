"""Token ids in binary shards with a minimal perfect hash index for keyed access."""

from __future__ import annotations

import functools
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.llm.common import MEMO_CHARS, Rows, new_folder, runs_by_size, written
from tideline.llm.token_counts import SEPARATORS, lower_each, split_words

VOCABULARY = "word_bpe_49k.json"
END = 2
RUN_CHARS = 1 << 21
#: Bytes of text for a shard.
SHARD = 64 << 20
MAGIC = b"TKIDS002"
#: Slots of a level of the hash for each key that is left.
ROOM = 2


class Ragged:
    """Rows of ids of different length, side by side."""

    def __init__(self) -> None:
        self.flat = np.zeros(1 << 16, "<u4")
        self.start = np.zeros(1, np.int64)

    def add(self, flat: np.ndarray, count: np.ndarray) -> None:
        used = int(self.start[-1])
        if used + len(flat) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(used + len(flat), "<u4")])
        self.flat[used : used + len(flat)] = flat
        self.start = np.concatenate([self.start, used + np.cumsum(count)])

    def get(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the given rows, side by side, and their numbers."""
        count = self.start[rows + 1] - self.start[rows]
        ends = np.cumsum(count)
        return self.flat[np.repeat(self.start[rows] - (ends - count), count) + np.arange(count.sum())], count


class WordEncoder:
    """The tokenizers library on pieces of words, each encoded once, since they never depend on their neighbours.

    All is forgotten when there are more than ``most`` words or ``MEMO_CHARS`` characters of words.
    """

    def __init__(self, path: str, most: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.most = Tokenizer.from_file(path), most
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        vocab = self.library.get_vocab()
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        self.closes[[i for t, i in vocab.items() if t.endswith(spec["model"]["end_of_word_suffix"])]] = True
        self.clear()

    def clear(self) -> None:
        self.words, self.known, self.chars = Rows(), Rows(), 0
        self.word_ids, self.piece_ids = Ragged(), Ragged()

    def learn(self) -> None:
        """Encodes the words that have been numbered but not encoded yet.

        New pieces go to the library side by side, with blanks between; a piece ends with its only closing token.
        """
        lists = [self.pieces(lower_each(unicodedata.normalize("NFC", w))) for w in self.words.new]
        size = np.fromiter(map(len, lists), np.int64, len(lists))
        row = np.fromiter(map(self.known.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
        texts = [" ".join(self.known.new[k : k + 256]) for k in range(0, len(self.known.new), 256)]
        found = [np.array(e.ids, "<u4") for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        if found:
            flat = np.concatenate(found)
            self.piece_ids.add(flat, np.diff(np.flatnonzero(self.closes[flat]), prepend=-1))
        self.chars += sum(map(len, self.words.new))
        self.words.new.clear()
        self.known.new.clear()
        flat, count = self.piece_ids.get(row)
        before = np.r_[0, np.cumsum(count)][np.r_[0, np.cumsum(size)]]
        self.word_ids.add(flat, np.diff(before))

    def ids(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each whole text."""
        for run in runs_by_size(texts, len, RUN_CHARS):
            if len(self.words) > self.most or self.chars > MEMO_CHARS:
                self.clear()
            # A special token or an odd separator may join words: such texts go to the library whole.
            odd = ["<|" in t or any(c in t for c in SEPARATORS) for t in run]
            lists = [[] if o else split_words(t) for t, o in zip(run, odd)]
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            row = np.fromiter(map(self.words.__getitem__, chain.from_iterable(lists)), np.int64, int(size.sum()))
            if self.words.new:
                self.learn()
            flat, count = self.word_ids.get(row)
            cut = np.r_[0, np.cumsum(count)][np.r_[0, np.cumsum(size)]].tolist()
            for text, o, a, b in zip(run, odd, cut, cut[1:]):
                if o:
                    (found,) = self.library.encode_batch_fast([text], add_special_tokens=False)
                    yield np.array(found.ids, "<u4")
                else:
                    yield flat[a:b]


@functools.lru_cache(2)
def word_encoder(path: str) -> WordEncoder:
    """One per worker, so that its memo serves all tasks there."""
    return WordEncoder(path)


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """Keys (int64) hashed to unsigned 64-bit integers."""
    with np.errstate(over="ignore"):
        x = keys.view(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
        x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
        return x ^ x >> np.uint64(31)


class PerfectHash:
    """Numbers n different keys from 0 to n - 1 without storing them.

    At each level the keys that are left hash into ``ROOM`` slots each. Who is alone in a slot keeps it; the others
    go to the next level, with another seed. A key's number is the rank of its slot's bit over all levels.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, base = [], 0
        for bits in levels:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.ranks.append(base + np.cumsum(ones) - ones)
            base += int(ones.sum())
        self.size = base

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            slots = 64 * -(-ROOM * len(keys) // 64)
            slot = (mixed(keys, len(levels)) % np.uint64(slots)).astype(np.int64)
            alone = np.bincount(slot, minlength=slots) == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            keys = keys[~alone[slot]]
        return cls(levels)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The keys' numbers; some number or -1 for keys that were not there at the build."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            slot = (mixed(keys[left], level) % np.uint64(64 * len(bits))).astype(np.int64)
            word, bit = slot >> 6, (slot & 63).astype(np.uint64)
            got = (bits[word] >> bit & np.uint64(1)) == 1
            w, b = word[got], bit[got]
            below = bits[w] & ((np.uint64(1) << b) - np.uint64(1))
            out[left[got]] = ranks[w] + np.bitwise_count(below)
            left = left[~got]
        return out


def index_bytes(keys: np.ndarray, count: np.ndarray, width: int) -> bytes:
    """A shard's index: keys ascending, one for each document (equal keys follow each other), and counts of ids.

    Little endian: magic; numbers of documents, keys, levels, ids and bytes an id; each level's length in 64-bit words and its
    bits; then, by a key's number, its fingerprint (32 bits), first document and number of documents; then every
    document's place in the payload, and its end.
    """
    different, first, times = np.unique(keys, return_index=True, return_counts=True)
    table = PerfectHash.build(different)
    number = table.find(different)
    by_number = np.argsort(number)
    place = np.cumsum(np.r_[0, count]).astype("<u8")
    out = [MAGIC, np.array([len(keys), len(different), len(table.levels), place[-1], width], "<u8").tobytes()]
    for bits in table.levels:
        out += [np.array([len(bits)], "<u8").tobytes(), bits.tobytes()]
    fingerprint = (mixed(different, 1 << 20) >> np.uint64(32)).astype("<u4")
    out += [x[by_number].tobytes() for x in (fingerprint, first.astype("<u8"), times.astype("<u8"))]
    return b"".join([*out, place.tobytes()])


class Shard:
    """Reads documents of a shard by key, in constant time each."""

    def __init__(self, files: fs.FileSystem, path: str):
        raw = files.open_input_stream(f"{path}.index").read()
        if raw[:8] != MAGIC:
            raise ValueError(f"{path}.index is no token index")
        self.documents, n, levels, self.total, self.width = np.frombuffer(raw, "<u8", 5, 8).astype(np.int64).tolist()
        at, bits = 48, []
        for _ in range(levels):
            (size,) = np.frombuffer(raw, "<u8", 1, at).tolist()
            bits.append(np.frombuffer(raw, "<u8", size, at + 8))
            at += 8 + 8 * size
        self.table = PerfectHash(bits)
        self.fingerprint = np.frombuffer(raw, "<u4", n, at)
        self.first = np.frombuffer(raw, "<u8", n, at + 4 * n).astype(np.int64)
        self.times = np.frombuffer(raw, "<u8", n, at + 12 * n).astype(np.int64)
        self.place = np.frombuffer(raw, "<u8", self.documents + 1, at + 20 * n).astype(np.int64)
        self.payload = files.open_input_file(f"{path}.ids")

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each key its first document and the number of its documents, 0 for a key that is not there."""
        number = self.table.find(keys)
        if not len(self.fingerprint):
            return number, np.zeros(len(keys), np.int64)
        there = (number >= 0) & (self.fingerprint[number] == (mixed(keys, 1 << 20) >> np.uint64(32)).astype("<u4"))
        return np.where(there, self.first[number], -1), np.where(there, self.times[number], 0)

    def read(self, document: int) -> bytes:
        """A document's ids as little-endian unsigned 32-bit integers."""
        begin, end = self.place[document : document + 2].tolist()
        self.payload.seek(self.width * begin)
        raw = self.payload.read(self.width * (end - begin))
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4").tobytes()


def _opened(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def write(
    df: DataFrame, folder: str, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = END
) -> DataFrame:
    """Writes shards ``shard-NNNNNN.ids`` and ``.index`` into ``folder``; gives ``key``, ``shard``, ``nth`` of every row.

    Documents lie in ascending order of the key (a long; null first), each followed by the id ``end``. A null text
    counts as empty and leaves that id alone. Equal keys lie side by side, in order of a hash of their texts, and may
    go on in the next shard; ``nth`` counts them in each shard from 0. Null keys are stored under the least long. There is a
    shard for each ``SHARD`` bytes of text, and at least one for each core. Every task writes a shard, under a name of
    its own first, and moves it into place when it is whole, so a repeated task leaves the same shard.
    """
    place = path or public_tokenizers.path(VOCABULARY)
    least = -(2**63)
    rows = df.select(
        F.coalesce(F.col(key).cast("long"), F.lit(least)).alias("k"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    _opened(folder)[0].create_dir(_opened(folder)[1], recursive=True)
    # Two bytes an id where the vocabulary allows it.
    width = 2 if max(end, word_encoder(place).library.get_vocab_size()) < 1 << 16 else 4
    closing = np.array([end], f"<u{width}").tobytes()

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _opened(folder)
        task = TaskContext.get()
        number, encoder = task.partitionId(), word_encoder(place)
        name = f"{base}/shard-{number:06d}"
        mine = f"{name}.{task.taskAttemptId()}"
        keys, counts, last, nth = [], [], None, 0
        with files.open_output_stream(f"{mine}.ids") as payload:
            for some in batches:
                for ids in encoder.ids(some["text"].tolist()):
                    payload.write(ids.astype(f"<u{width}").tobytes() + closing)
                    counts.append(len(ids) + 1)
                these = some["k"].to_numpy()
                keys.append(these)
                order = []
                for k in these.tolist():
                    nth = nth + 1 if k == last else 0
                    last = k
                    order.append(nth)
                yield pd.DataFrame({"k": these, "shard": number, "nth": order})
        with files.open_output_stream(f"{mine}.index") as index:
            every = np.concatenate(keys) if keys else np.zeros(0, np.int64)
            index.write(index_bytes(every, np.array(counts, np.int64), width))
        for kind in ("ids", "index"):
            files.move(f"{mine}.{kind}", f"{name}.{kind}")

    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // SHARD))
    # Equal keys, the null ones above all, are spread by a hash of their texts.
    order = ["k", F.xxhash64("text")]
    placed = rows.repartitionByRange(shards, *order).sortWithinPartitions(*order, "text")
    placed = written(placed.mapInPandas(shard, "k long, shard int, nth int"), "token-places")
    return placed.select(F.when(F.col("k") != least, F.col("k")).alias(key), "shard", "nth")


def read(spark: SparkSession, folder: str, keys: DataFrame, key: str = "doc_id") -> DataFrame:
    """What the files hold under the given rows of ``key``, ``shard``, ``nth``: ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` is the number of ids of all documents before it, ``ids_crc32`` the unsigned checksum of the ids as
    little-endian unsigned 32-bit integers. A key that the shard does not hold is an error. Only the shards' sizes, a
    row each, are summed in one task.
    """

    def sizes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _opened(folder)
        for some in batches:
            total = [Shard(files, f"{base}/shard-{n:06d}").total for n in some["shard"]]
            yield pd.DataFrame({"shard": some["shard"], "total": total})

    def look_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, base = _opened(folder)
        number, shard = None, None
        for some in batches:
            for n, rows in some.groupby("shard", sort=True):
                if n != number:
                    number, shard = n, Shard(files, f"{base}/shard-{n:06d}")
                first, times = shard.find(rows["k"].to_numpy())
                document = first + rows["nth"].to_numpy()
                if (rows["nth"].to_numpy() >= times).any():
                    raise KeyError(f"shard {n} lacks a key")
                sums = [zlib.crc32(shard.read(d)) for d in document]
                yield pd.DataFrame(
                    {
                        "k": rows["k"],
                        "shard": n,
                        "inside": shard.place[document],
                        "n_tokens": shard.place[document + 1] - shard.place[document],
                        "ids_crc32": sums,
                    }
                )

    least = F.lit(-(2**63))
    rows = keys.select(F.coalesce(F.col(key).cast("long"), least).alias("k"), "shard", "nth")
    totals = written(rows.select("shard").distinct().mapInPandas(sizes, "shard int, total long"), "token-shards")
    before = F.coalesce(
        F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    bases = totals.select("shard", before.alias("base"))
    # With a given number of ranges the small rows are not drawn together: each task reads about one shard.
    found = rows.repartitionByRange(max(1, totals.count()), "shard").sortWithinPartitions("shard", "k").mapInPandas(
        look_up, "k long, shard int, inside long, n_tokens long, ids_crc32 long"
    )
    return found.join(F.broadcast(bases), "shard").select(
        F.when(F.col("k") != least, F.col("k")).alias(key),
        (F.col("base") + F.col("inside")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def store(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the ids into a new folder of the shared one and reads them back by key."""
    folder = new_folder(df.sparkSession, "token-ids")
    return read(df.sparkSession, folder, write(df, folder, key, text), key)
