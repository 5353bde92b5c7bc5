"""Byte-level BPE from a rank file: a segment tree finds each merge; ids decode to the same bytes."""

from __future__ import annotations

import base64
import functools
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import PART_CHARS, Memo, runs_by_size

RANKS = "byte_bpe_multi_50k.tiktoken"
NEVER = 1 << 62
#: Pieces of more bytes have a tree of their own, in which a round takes all pairs of the lowest rank.
LONG = 2048
#: A single blank between two other characters: no match of the pattern goes across its left side.
CUT = regex.compile(r"(?<=\S)(?= \S)")
#: A blank beside other white space, which can be matched together with it.
WIDE = regex.compile(r"\s | \s")


def cuts(text: str) -> Iterator[str]:
    """The text in long parts that encode independently."""
    begin = 0
    while len(text) - begin > PART_CHARS and (found := CUT.search(text, begin + PART_CHARS)):
        yield text[begin : found.start()]
        begin = found.start()
    yield text[begin:]


def chunks_of(text: str) -> list[str]:
    """The text cut before each single blank; few different chunks make up a corpus."""
    if "\0" in text or text[:1] == " " or text[-1:] == " " or WIDE.search(text):
        return CUT.split(text)
    return text.replace(" ", "\0 ").split("\0")


class ByteBpe:
    """Encodes by merge ranks and decodes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            self.tokens[i] = token
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        # The rank of every pair of tokens whose joined bytes are a token.
        pairs = sorted(
            (a << 20 | b, i)
            for token, i in self.ranks.items()
            for k in range(1, len(token))
            if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None
        )
        self.keys, self.made = (np.array(x, np.int64) for x in zip(*pairs))
        self.pieces = regex.compile(pattern).findall
        self.memo = Memo(self.encode_pieces, 300_000)
        self.chunks = Memo(self.encode_chunks, 300_000)

    def pair(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, shift: int) -> np.ndarray:
        """Leaf values of pairs that begin at byte ``at``: the rank, with the position in the low bits."""
        wanted = left << 20 | right
        found = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[found] == wanted, self.made[found] << shift | at, NEVER)

    def merge(self, pieces: list[bytes], size: int) -> list[bytes]:
        """Ids of pieces of at most ``size`` bytes, a power of two.

        In each piece the leftmost pair of the lowest rank merges until no pair has a rank. Every piece has a segment
        tree, a row of ``tree``: the leaf of a byte position holds the pair that begins there, a node the lesser of
        its two children, so node 1 is the leftmost minimum. A merge changes three leaves (the pair that begins at
        the merged symbol, the one before it, the swallowed one) and the nodes above them. All rows take one merge
        a round.
        """
        n, shift = len(pieces), size.bit_length()
        low = (1 << shift) - 1
        length = np.fromiter(map(len, pieces), np.int64, n)
        inside = np.arange(size) < length[:, None]
        symbol = np.zeros((n, size + 1), np.int64)
        symbol[:, :size][inside] = self.bytes[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.tile(np.arange(1, size + 2), (n, 1))
        before = np.tile(np.arange(-1, size), (n, 1))
        tree = np.full((n, 2 * size), NEVER, np.int64)
        row, at = np.nonzero(inside[:, 1:])
        tree[row, size + at] = self.pair(symbol[row, at], symbol[row, at + 1], at, shift)
        half = size
        while half > 1:
            half >>= 1
            tree[:, half : 2 * half] = np.minimum(tree[:, 2 * half : 4 * half : 2], tree[:, 2 * half + 1 : 4 * half : 2])
        alive = inside.copy()
        row = np.flatnonzero(tree[:, 1] != NEVER)
        while len(row):
            best = tree[row, 1]
            i = best & low
            j = after[row, i]
            end = after[row, j]
            made = best >> shift
            symbol[row, i] = made
            after[row, i] = end
            alive[row, j] = False
            before[row, np.minimum(end, size)] = i
            more = end < length[row]
            value = self.pair(made, symbol[row, np.minimum(end, size)], i, shift)
            tree[row, size + i] = np.where(more, value, NEVER)
            tree[row, size + j] = NEVER
            left = before[row, i]
            has = np.flatnonzero(left >= 0)
            r, le = row[has], left[has]
            tree[r, size + le] = self.pair(symbol[r, le], made[has], le, shift)
            for r, node in ((row, size + j), (row, size + i), (r, size + le)):
                while len(node) and node[0] > 1:
                    node = node >> 1
                    tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])
            row = row[tree[row, 1] != NEVER]
        ids = symbol[:, :size][alive].astype("<u4").tobytes()
        ends = (4 * np.cumsum(alive.sum(axis=1))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def merge_long(self, piece: bytes) -> bytes:
        """As ``merge``, for one long piece, whose rounds are about as many as the ranks that occur in it.

        The tree is searched from the root for all leaves of the lowest rank. From the left they are merged at once, up
        to and with the first whose merge gives a pair of a still lower rank, since that pair would be next.
        """
        n = len(piece)
        size = 1 << (n - 1).bit_length()
        shift = size.bit_length()
        symbol = np.append(self.bytes[np.frombuffer(piece, np.uint8)], 0)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        tree = np.full(2 * size, NEVER, np.int64)
        tree[size : size + n - 1] = self.pair(symbol[: n - 1], symbol[1:n], np.arange(n - 1), shift)
        half = size
        while half > 1:
            half >>= 1
            tree[half : 2 * half] = np.minimum(tree[2 * half : 4 * half : 2], tree[2 * half + 1 : 4 * half : 2])
        alive = np.ones(n, bool)
        while tree[1] != NEVER:
            made = int(tree[1] >> shift)
            node = np.ones(1, np.int64)
            while node[0] < size:
                node = (node[:, None] * 2 + np.arange(2)).ravel()
                node = node[tree[node] >> shift == made]
            i = node - size
            j = after[i]
            if len(i) > 1 and (linked := i[1:] == j[:-1]).any():
                # A merge swallows the pair that begins at its right symbol: of linked pairs every second one merges.
                place = np.arange(len(i))
                first = np.maximum.accumulate(np.where(np.r_[False, linked], 0, place))
                i, j = i[(place - first) % 2 == 0], j[(place - first) % 2 == 0]
            end = after[j]
            # New pairs as they are when all merges to the left are done and none to the right.
            joined = np.r_[False, end[:-1] == i[1:]]
            left = np.where(joined, np.r_[-1, i[:-1]], before[i])
            near = np.where(joined, made, symbol[left])
            new = np.minimum(
                np.where(left >= 0, self.pair(near, np.int64(made), i, shift), NEVER),
                np.where(end < n, self.pair(np.int64(made), symbol[end], i, shift), NEVER),
            )
            lower = np.flatnonzero(new >> shift < made)
            if len(lower):
                i, j, end, left = (x[: lower[0] + 1] for x in (i, j, end, left))
            symbol[i] = made
            after[i] = end
            before[end] = i
            alive[j] = False
            left = left[left >= 0]
            tree[size + i] = np.where(end < n, self.pair(symbol[i], symbol[end], i, shift), NEVER)
            tree[size + j] = NEVER
            tree[size + left] = self.pair(symbol[left], symbol[after[left]], left, shift)
            node = np.sort(np.concatenate([i, j, left])) + size
            while node[0] > 1:
                node = node >> 1
                if len(node) > 8:
                    node = node[np.flatnonzero(np.diff(node, prepend=0))]
                tree[node] = np.minimum(tree[2 * node], tree[2 * node + 1])
        return symbol[:n][alive].astype("<u4").tobytes()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Each piece's ids as little-endian unsigned 32-bit integers; a piece that is a token is that token."""
        out: list[bytes] = [b""] * len(pieces)
        by_size: dict[int, list[tuple[int, bytes]]] = {}
        for k, piece in enumerate(pieces):
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                out[k] = struct.pack("<I", rank)
            elif len(raw) > LONG:
                out[k] = self.merge_long(raw)
            else:
                by_size.setdefault(max(8, 1 << (len(raw) - 1).bit_length()), []).append((k, raw))
        for size, group in by_size.items():
            for begin in range(0, len(group), step := max(1, (1 << 16) // size)):
                some = group[begin : begin + step]
                for (k, _), ids in zip(some, self.merge([raw for _, raw in some], size)):
                    out[k] = ids
        return out

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        """Ids of stretches of text that encode independently."""
        lists = [self.pieces(c) for c in chunks]
        self.memo.need(set().union(*lists))
        return [b"".join(map(self.memo.__getitem__, pieces)) for pieces in lists]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """All ids of each text as little-endian unsigned 32-bit integers."""
        for run in runs_by_size(texts, len, PART_CHARS):
            if len(run) == 1:
                yield b"".join(self.join([chunks_of(p)])[0] for p in cuts(run[0]))
            else:
                yield from self.join([chunks_of(text) for text in run])

    def join(self, lists: list[list[str]]) -> list[bytes]:
        """Ids of lists of chunks, whose new chunks are encoded together."""
        self.chunks.need(set().union(*lists))
        return [b"".join(map(self.chunks.__getitem__, chunks)) for chunks in lists]

    def decode(self, ids: bytes) -> bytes:
        """The bytes that the ids stand for."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.lru_cache(2)
def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """One per worker, so that its memo serves all tasks there."""
    return ByteBpe(path, pattern)


def _places(path: str | None, pattern: str | None) -> tuple[str, str]:
    return path or public_tokenizers.path(RANKS), pattern or public_tokenizers.PATTERN


def encode(
    df: DataFrame, text: str = "text", out: str = "ids", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Adds the ids of each whole text, as bytes of little-endian unsigned 32-bit integers.

    A null text counts as empty and has no ids. Rows and other columns stay as they are. No shuffle.
    """
    places = _places(path, pattern)

    @F.pandas_udf("binary")
    def ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = byte_bpe(*places)
        for texts in batches:
            yield pd.Series(list(bpe.encode(texts.tolist())), dtype=object)

    return df.withColumn(out, ids(F.coalesce(F.col(text).cast("string"), F.lit(""))))


def decode(
    df: DataFrame, ids: str = "ids", out: str = "decoded", path: str | None = None, pattern: str | None = None
) -> DataFrame:
    """Adds the bytes that ids stand for; null ids decode to no bytes."""
    places = _places(path, pattern)

    @F.pandas_udf("binary")
    def tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = byte_bpe(*places)
        for rows in batches:
            yield pd.Series([bpe.decode(r) for r in rows], dtype=object)

    return df.withColumn(out, tokens(F.coalesce(F.col(ids), F.lit(b""))))


def round_trip(df: DataFrame, text: str = "text", path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each whole text (null: empty).

    Encodes and decodes in one pass and keeps digests only, so that ids and bytes of long texts needn't travel.
    """
    places = _places(path, pattern)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = byte_bpe(*places)
        for texts in batches:
            rows = []
            for ids in bpe.encode(texts.tolist()):
                rows.append((len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    found = digests(F.coalesce(F.col(text).cast("string"), F.lit("")))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*kept, found.alias("_round_trip")).select(*kept, "_round_trip.*")
