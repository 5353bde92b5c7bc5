"""Removes byte strings that occurred earlier in the corpus, by suffix arrays of shards.

Every window of ``length`` bytes has an anchor, the 32-byte string with the least hash in it. Equal windows have equal
anchors at equal places, so occurrences of a repeated string always meet under its anchor. The stretch of consecutive
windows that share an anchor is a snippet. Equal snippets are settled by their fingerprint; only where an anchor has
different snippets, their bytes are fetched and dealt to shards, whose suffix arrays tell which windows are equal.
An anchor that is too frequent for one task is dealt to many shards; the sorted windows that such shards leave are
merged by binary search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from tideline.llm.common import written
from tideline.llm.suffix_array import common_prefixes, suffix_array, words_at

LENGTH = 100
GRAM = 32
#: Bytes of text that are anchored at once, that a bucket or partition stands for, that a shard has, and that it sorts at once.
BLOCK = 1 << 18
BATCH = 1 << 23
BUCKET = 1 << 23
SHARD = 1 << 21
PIECE = 1 << 18
#: Documents whose anchors are counted to find the frequent ones; that decides on the way only, not on the result.
SAMPLE = 2000
MIX = np.uint64(0x9E3779B97F4A7C15)
PLACE = np.uint64((1 << 24) - 1)
COVERED, CONTESTED, WINDOWS = 0, 1, 2
ROWS = "kind int, part long, size long, blob binary"
#: Columns of blobs. A document is known by its key and a tag of its key and text.
OCCURRENCE = {"anchor": "<u8", "snip": "<u8", "key": "<i8", "tag": "<i4", "lo": "<u4", "off": "u1", "n": "u1", "hot": "u1"}
INTERVAL = {"key": "<i8", "tag": "<i4", "lo": "<u4", "end": "<u4"}
WINDOW = {"d1": "<u8", "d2": "<u8", "key": "<i8", "tag": "<i4", "lo": "<u4"}


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ x >> np.uint64(31)) * MIX
        return x ^ x >> np.uint64(29)


def pack(columns: dict, rows) -> bytes:
    """The chosen rows of columns, column by column, compressed."""
    size = len(next(iter(columns.values()))[rows])
    raw = b"".join(np.ascontiguousarray(c[rows]).tobytes() for c in columns.values())
    return np.array([size, len(raw)], "<u8").tobytes() + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(blobs: list[bytes], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """The rows of all blobs, by column."""
    parts: dict[str, list] = {name: [] for name in kinds}
    for blob in blobs:
        size, raw_size = np.frombuffer(blob, "<u8", 2).tolist()
        raw = pa.decompress(blob[16:], raw_size, codec="zstd", asbytes=True)
        at = 0
        for name, kind in kinds.items():
            parts[name].append(np.frombuffer(raw, kind, size, at))
            at += size * np.dtype(kind).itemsize
    return {name: np.concatenate(p) if p else np.zeros(0, kinds[name]) for name, p in parts.items()}


def dealt(columns: dict, part: np.ndarray, kind: int, sizes: np.ndarray | None = None) -> pd.DataFrame:
    """A row of ``ROWS`` for each part, with a blob of its rows."""
    order = np.argsort(part, kind="stable")
    sorted_part = part[order]
    first = np.flatnonzero(np.r_[True, sorted_part[1:] != sorted_part[:-1]]) if len(part) else order
    ends = np.r_[first[1:], len(part)]
    return pd.DataFrame(
        {
            "kind": kind,
            "part": sorted_part[first].astype(np.int64),
            "size": [int(sizes[order[a:b]].sum()) if sizes is not None else int(b - a) for a, b in zip(first, ends)],
            "blob": [pack(columns, order[a:b]) for a, b in zip(first, ends)],
        }
    )


def snippets(text: np.ndarray, begin: np.ndarray, size: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """The snippets of documents that lie side by side in ``text``: document, first window, anchor, and fingerprint."""
    width = length - GRAM + 1
    with np.errstate(over="ignore"):
        word = words_at(text)
        count = len(text) - GRAM + 1
        h = word[:count] * np.uint64(0xD6E8FEB86659FD93)
        for k, m in ((8, 0xA0761D6478BD642F), (16, 0xE7037ED1A0B428DB), (24, 0x8EBC6AF09C88C6E3)):
            h ^= h >> np.uint64(32)
            h += word[k : k + count] * np.uint64(m)
        h = mixed(h)
        least = (h & ~PLACE) | np.arange(count, dtype=np.uint64)
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        enough = size >= length
        first, windows = begin[enough], size[enough] - length + 1
        document = np.repeat(np.flatnonzero(enough), windows)
        start = np.repeat(first - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
        anchor_at = (least[start] & PLACE).astype(np.int64)
        new = np.r_[True, (anchor_at[1:] != anchor_at[:-1]) | (document[1:] != document[:-1])][: len(start)]
        run = np.flatnonzero(new)
        lo, at, doc = start[run], anchor_at[run], document[run]
        n = np.diff(np.r_[run, len(start)])
        # A fingerprint of all bytes from the first window's begin to the last one's end.
        power = np.cumprod(np.r_[np.uint64(1), np.full(len(text), MIX)])
        inverse = np.cumprod(np.r_[np.uint64(1), np.full(len(text), np.uint64(pow(int(MIX), -1, 2**64)))])
        total = np.r_[np.uint64(0), np.cumsum(mixed(word + np.uint64(1)) * power[:-1])]
        print_of = (total[lo + n + length - 8] - total[lo]) * inverse[lo]
        anchor = h[at]
        snip = mixed(mixed(print_of) + anchor + ((at - lo) * 256 + n).astype(np.uint64))
    return {"doc": doc, "lo": lo - begin[doc], "off": at - lo, "n": n, "anchor": anchor, "snip": snip}


def occurrences(keys: np.ndarray, tags: np.ndarray, texts: list[bytes], length: int) -> dict[str, np.ndarray]:
    """All snippets of whole texts. Long texts are read in blocks that share no window."""
    found: list[dict] = []
    batch: list[tuple[int, int, bytes]] = []

    def flush() -> None:
        if not batch:
            return
        size = np.array([len(b) for _, _, b in batch])
        begin = np.cumsum(size) - size
        got = snippets(np.frombuffer(b"".join(b for _, _, b in batch), np.uint8), begin, size, length)
        which, base = np.array([i for i, _, _ in batch]), np.array([b for _, b, _ in batch])
        got["lo"] = got["lo"] + base[got["doc"]]
        got["doc"] = which[got["doc"]]
        found.append(got)
        batch.clear()

    held = 0
    for i, text in enumerate(texts):
        for base in range(0, max(1, len(text) - length + 1), BLOCK):
            piece = text[base : base + BLOCK + length - 1]
            if len(piece) < length:
                continue
            batch.append((i, base, piece))
            held += len(piece)
            if held >= BLOCK:
                flush()
                held = 0
    flush()
    names = ("doc", "lo", "off", "n", "anchor", "snip")
    got = {c: np.concatenate([f[c] for f in found]) if found else np.zeros(0, np.uint64) for c in names}
    doc = got.pop("doc").astype(np.int64)
    got |= {"key": keys[doc], "tag": tags[doc], "hot": np.zeros(len(doc), np.uint8)}
    return {name: got[name].astype(kind) for name, kind in OCCURRENCE.items()}


def settle(rows: dict, length: int) -> tuple[dict, np.ndarray]:
    """Of equal snippets all but the earliest are covered. Gives the covered intervals and the rows that stay.

    Occurrences with the same key and start (rows that share a key) are equally early: none of them is covered.
    """
    order = np.lexsort((rows["lo"], rows["key"], rows["snip"]))
    snip, key, lo = (rows[c][order] for c in ("snip", "key", "lo"))
    new = np.r_[True, snip[1:] != snip[:-1]] if len(order) else np.zeros(0, bool)
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(order)])
    later = (key != np.repeat(key[first], size)) | (lo != np.repeat(lo[first], size))
    gone = order[later]
    covered = {c: rows[c][gone] for c in ("key", "tag", "lo")}
    covered["end"] = (covered["lo"] + rows["n"][gone] + np.uint32(length - 1)).astype(np.uint32)
    return covered, order[~later]


def anchored(length: int, parts: int, buckets: int, hot: np.ndarray):
    """Snippets of texts, settled within the batch and dealt by anchor; covered intervals travel along."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            keys, tags = some["key"].to_numpy(), some["tag"].to_numpy()
            size = np.cumsum([len(t) for t in some["text"]])
            cut = np.searchsorted(size, np.arange(0, size[-1] + BATCH, BATCH)) if len(size) else []
            for a, b in zip(cut[:-1], [*cut[1:-1], len(some)]):
                if a == b:
                    continue
                rows = occurrences(keys[a:b], tags[a:b], [t.encode() for t in some["text"].iloc[a:b]], length)
                covered, stay = settle(rows, length)
                rows = {c: v[stay] for c, v in rows.items()}
                rows["hot"] = np.isin(rows["anchor"], hot).astype(np.uint8)
                spread = mixed(rows["anchor"]) + np.where(rows["hot"] == 1, mixed(rows["snip"]), 0)
                yield dealt(rows, (spread % np.uint64(parts)).astype(np.int64), CONTESTED)
                yield dealt(covered, covered["tag"].astype(np.int64) % buckets % parts, COVERED)

    return work


def compared(length: int, buckets: int, most: int):
    """Settles the snippets of a partition's anchors; anchors with different snippets, and hot ones, are contested.

    An anchor with more than ``most`` contested bytes becomes hot, however rare the sample found it.
    """

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blobs, covered_blobs = [], []
        for some in batches:
            blobs += some["blob"][some["kind"] == CONTESTED].tolist()
            covered_blobs += some["blob"][some["kind"] == COVERED].tolist()
        rows = unpack(blobs, OCCURRENCE)
        covered, stay = settle(rows, length)
        anchor, snip = rows["anchor"][stay], rows["snip"][stay]
        order = np.lexsort((snip, anchor))
        anchor, snip = anchor[order], snip[order]
        new = np.r_[True, anchor[1:] != anchor[:-1]] if len(order) else np.zeros(0, bool)
        other = np.r_[True, snip[1:] != snip[:-1]] if len(order) else new
        first = np.flatnonzero(new)
        kinds = np.add.reduceat(other | new, first) if len(first) else first
        many = np.repeat(kinds > 1, np.diff(np.r_[first, len(order)])) | (rows["hot"][stay][order] == 1)
        kept = {c: v[stay][order][many] for c, v in rows.items()}
        early = unpack(covered_blobs, INTERVAL)
        covered = {c: np.concatenate([early[c], covered[c].astype(k)]) for c, k in INTERVAL.items()}
        yield dealt(covered, covered["tag"].astype(np.int64) % buckets, COVERED)
        size = kept["n"].astype(np.int64) + length - 1
        first = np.flatnonzero(new[many] if len(order) else new)
        if len(first):
            large = np.add.reduceat(size, first) > most
            kept["hot"] |= np.repeat(large, np.diff(np.r_[first, len(size)])).astype(np.uint8)
        yield dealt(kept, kept["tag"].astype(np.int64) % buckets, CONTESTED, size)

    return work


def document_rows(docs: pa.Table, key: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """The row of a bucket's documents that each key and tag belongs to."""
    have = np.rec.fromarrays([docs["_key"].to_numpy(), docs["_tag"].to_numpy()], names="k,t")
    want = np.rec.fromarrays([key.astype(np.int64), tag.astype(np.int32)], names="k,t")
    both, inverse = np.unique(np.concatenate([have, want]), return_inverse=True)
    row = np.full(len(both), -1, np.int64)
    row[inverse[: len(have)][::-1]] = np.arange(len(have))[::-1]
    return row[inverse[len(have) :]]


def fetched(length: int, shards: int):
    """The bytes of contested snippets, out of a bucket's documents, dealt to shards."""
    schema = pa.schema([("shard", pa.int64()), ("blob", pa.binary()), ("bytes", pa.binary())])

    def work(docs: pa.Table, rows: pa.Table) -> pa.Table:
        got = unpack(rows["blob"].to_pylist(), OCCURRENCE)
        if not len(got["key"]):
            return schema.empty_table()
        row = document_rows(docs, got["key"], got["tag"])
        by_row = np.argsort(row, kind="stable")
        texts = docs["_text"]
        spread = np.where(got["hot"] == 1, mixed(got["snip"]), mixed(got["anchor"])) >> np.uint64(20)
        shard = (spread % np.uint64(shards)).astype(np.int64)
        piece: list[bytes] = [b""] * len(row)
        last, text = -1, b""
        for i in by_row.tolist():
            if row[i] != last:
                last, text = row[i], texts[int(row[i])].as_buffer().to_pybytes()
            lo = int(got["lo"][i])
            piece[i] = text[lo : lo + int(got["n"][i]) + length - 1]
        order = np.argsort(shard, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(shard[order]) != 0])
        ends = np.r_[first[1:], len(order)]
        return pa.table(
            [
                shard[order][first],
                [pack(got, order[a:b]) for a, b in zip(first, ends)],
                [b"".join(piece[i] for i in order[a:b]) for a, b in zip(first, ends)],
            ],
            schema=schema,
        )

    return work


def sorted_shards(length: int, buckets: int, ranges: int):
    """Covered intervals of each shard by its suffix array; hot anchors' windows go on to be merged."""

    def piece(rows: dict, text: np.ndarray) -> tuple[dict, dict]:
        n = rows["n"].astype(np.int64)
        size = n + length - 1
        begin = np.cumsum(size) - size
        order = suffix_array(text)
        apart = common_prefixes(text, order, length) < length
        group = np.empty(len(text), order.dtype)
        group[order] = np.cumsum(apart, dtype=order.dtype)
        del order, apart
        # The windows, one at each place where all of its bytes are in the snippet.
        owner = np.repeat(np.arange(len(n)), n)
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = begin[owner] + inside
        key, lo, tag = rows["key"][owner], rows["lo"][owner].astype(np.int64) + inside, rows["tag"][owner]
        by = np.lexsort((lo, key, group[at]))
        g = group[at][by]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        times = np.diff(np.r_[first, len(g)])
        later = np.zeros(len(g), bool)
        later[by] = (key[by] != np.repeat(key[by][first], times)) | (lo[by] != np.repeat(lo[by][first], times))
        # Consecutive covered windows of a snippet make one interval.
        run = np.flatnonzero(later & ~np.r_[False, later[:-1] & (owner[1:] == owner[:-1])])
        stop = np.flatnonzero(later & ~np.r_[later[1:] & (owner[1:] == owner[:-1]), False])
        covered = {"key": key[run], "tag": tag[run], "lo": lo[run].astype("<u4"), "end": (lo[stop] + length).astype("<u4")}
        open_ = np.flatnonzero((rows["hot"][owner] == 1) & ~later)
        digests = [np.zeros(len(open_), np.uint64) for _ in range(2)]
        if len(open_):
            word = np.concatenate([words_at(text), np.zeros(length, np.uint64)])
            with np.errstate(over="ignore"):
                for d, salt in zip(digests, (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)):
                    for k in [*range(0, length - 8, 8), length - 8]:
                        d[:] = mixed(d + word[at[open_] + k] * np.uint64(salt))
        return covered, {"d1": digests[0], "d2": digests[1], "key": key[open_], "tag": tag[open_], "lo": lo[open_].astype("<u4")}

    def shard(blobs: list[bytes], texts: list[bytes]) -> Iterator[pd.DataFrame]:
        rows = unpack(blobs, OCCURRENCE)
        text = b"".join(texts)
        size = rows["n"].astype(np.int64) + length - 1
        begin = np.cumsum(size) - size
        # Equal windows have equal anchors, so a piece of whole anchors is sorted at a time.
        by = np.argsort(rows["anchor"], kind="stable")
        anchor = rows["anchor"][by]
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        nth = (np.cumsum(size[by]) - size[by])[first] // PIECE
        cut = first[np.r_[True, nth[1:] != nth[:-1]]]
        covered, windows = [], []
        for a, b in zip(cut, [*cut[1:], len(by)]):
            some = by[a:b]
            part = b"".join(text[x:y] for x, y in zip(begin[some].tolist(), (begin[some] + size[some]).tolist()))
            got = piece({c: v[some] for c, v in rows.items()}, np.frombuffer(part, np.uint8))
            covered.append(got[0])
            windows.append(got[1])
        covered, windows = ({c: np.concatenate([x[c] for x in found]) for c in found[0]} for found in (covered, windows))
        yield dealt(covered, covered["tag"].astype(np.int64) % buckets, COVERED)
        if len(windows["d1"]):
            windows = {c: v[np.lexsort((windows["d2"], windows["d1"]))] for c, v in windows.items()}
            yield dealt(windows, (windows["d1"] % np.uint64(ranges)).astype(np.int64), WINDOWS)

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # The rows come sorted by shard.
        last, blobs, texts = None, [], []
        for some in batches:
            for number, blob, text in zip(some["shard"], some["blob"], some["bytes"]):
                if number != last and blobs:
                    yield from shard(blobs, texts)
                    blobs, texts = [], []
                last = number
                blobs.append(blob)
                texts.append(text)
        if blobs:
            yield from shard(blobs, texts)

    return work


def merged_windows(length: int, buckets: int):
    """Merges the shards' sorted windows of a range, two lists at a time, by binary search."""

    def merge(a: dict, b: dict, covered: list[dict]) -> dict:
        if len(a["digest"]) < len(b["digest"]):
            a, b = b, a
        at = np.searchsorted(a["digest"], b["digest"])
        met = np.flatnonzero(a["digest"][np.minimum(at, len(a["digest"]) - 1)] == b["digest"]) if len(at) else at
        mine = at[met]
        later = (b["key"][met] > a["key"][mine]) | ((b["key"][met] == a["key"][mine]) & (b["lo"][met] > a["lo"][mine]))
        tie = (b["key"][met] == a["key"][mine]) & (b["lo"][met] == a["lo"][mine])
        covered.append({c: b[c][met[later]] for c in ("key", "tag", "lo")})
        gone = ~later & ~tie
        covered.append({c: a[c][mine[gone]] for c in ("key", "tag", "lo")})
        for c in ("key", "tag", "lo"):
            a[c] = a[c].copy()
            a[c][mine[gone]] = b[c][met[gone]]
        rest = np.ones(len(at), bool)
        rest[met] = False
        return {c: np.insert(a[c], at[rest], b[c][rest]) for c in a}

    def work(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        runs, covered = [], []
        for blob in rows["blob"]:
            run = unpack([blob], WINDOW)
            # As big-endian bytes, whose order is that of the numbers.
            digest = np.stack([run.pop("d1"), run.pop("d2")], axis=1).astype(">u8")
            run["digest"] = digest.view("S16").ravel()
            # A list may repeat a window of rows that share a key; one of them stands for all.
            keep = np.r_[True, run["digest"][1:] != run["digest"][:-1]]
            runs.append({c: v[keep] for c, v in run.items()})
        while len(runs) > 1:
            runs = [merge(*pair, covered) if len(pair) == 2 else pair[0] for pair in (runs[k : k + 2] for k in range(0, len(runs), 2))]
        got = {c: np.concatenate([x[c] for x in covered]) if covered else np.zeros(0, INTERVAL[c]) for c in ("key", "tag", "lo")}
        got["end"] = (got["lo"] + np.uint32(length)).astype("<u4")
        return dealt(got, got["tag"].astype(np.int64) % buckets, COVERED)

    return work


def removed(schema: pa.Schema, names: list[str], characters: bool):
    """A bucket's documents with what is left of their bytes, or of their characters."""

    def work(docs: pa.Table, rows: pa.Table) -> pa.Table:
        got = unpack(rows["blob"].to_pylist(), INTERVAL)
        row = document_rows(docs, got["key"], got["tag"]) if docs.num_rows else np.zeros(0, np.int64)
        order = np.lexsort((got["end"], got["lo"], row))
        row, lo, end = row[order], got["lo"][order].tolist(), got["end"][order].tolist()
        edge = np.searchsorted(row, np.arange(docs.num_rows + 1))
        # Rows that repeat key and text are one document; the first has its intervals.
        same = document_rows(docs, docs["_key"].to_numpy(), docs["_tag"].to_numpy()) if docs.num_rows else row
        sizes, gone, spans, kept = [], [], [], []
        for i in range(docs.num_rows):
            text = docs["_text"][i].as_buffer().to_pybytes()
            out, at, count, cut, j = [], 0, 0, 0, int(edge[same[i]])
            stop = int(edge[same[i] + 1])
            while j < stop:
                begin, last = lo[j], end[j]
                j += 1
                while j < stop and lo[j] <= last:
                    last = max(last, end[j])
                    j += 1
                count, cut = count + 1, cut + last - begin
                while characters and begin < len(text) and text[begin] & 0xC0 == 0x80:
                    begin -= 1
                while characters and last < len(text) and text[last] & 0xC0 == 0x80:
                    last += 1
                out.append(text[at:begin])
                at = last
            out.append(text[at:])
            sizes.append(len(text))
            gone.append(cut)
            spans.append(count)
            kept.append(b"".join(out))
        return pa.table([*(docs[c] for c in names), sizes, gone, spans, kept], schema=schema)

    return work


def hot_anchors(docs: DataFrame, share: float, length: int, parts: int) -> np.ndarray:
    """Anchors with more than 1 / (4 * parts) of a sample's snippets: fewer than 4 * parts of them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            rows = occurrences(some["key"].to_numpy(), some["tag"].to_numpy(), [t.encode() for t in some["text"]], length)
            _, stay = settle(rows, length)
            anchor, n = np.unique(rows["anchor"][stay], return_counts=True)
            yield pd.DataFrame({"anchor": anchor.view(np.int64), "n": n})

    sample = docs.where(F.pmod(F.xxhash64("tag"), F.lit(1_000_000)) < F.lit(share * 1_000_000))
    counts = written(sample.mapInPandas(count, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n")), "anchors")
    total = counts.agg(F.sum("n")).first()[0] or 0
    least = max(20, total / (4 * parts))
    return counts.where(F.col("n") >= least).toPandas()["anchor"].to_numpy(np.int64).view(np.uint64)


def remove_repeats(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    keep: bool = False,
    characters: bool = False,
) -> DataFrame:
    """Removes each byte covered by a ``length``-byte string that also starts earlier.

    Earlier means under a smaller key, or at a smaller start under the same key; strings are judged on the input,
    overlaps count, and matches never cross texts. Gives all columns but the text (with ``keep`` the text too) with
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept`` (the bytes left); such columns of the
    input are replaced. With ``characters``, a character of which a byte is removed is missing from ``kept`` as a whole. Null texts count as empty; texts under ``length`` bytes lose nothing. A null key comes before
    all others. Of rows that share a key, equal starts are equally early, and rows that share key and text are one
    document, repeated in the result. An empty table gives an empty result. ``length`` is 64 to 200.
    """
    if not 64 <= length <= 200:
        raise ValueError("a length of 64 to 200 bytes is needed")
    new = {"n_bytes": LongType(), "n_removed": LongType(), "n_spans": LongType(), "kept": BinaryType()}
    names = [c for c in df.columns if c not in new and (keep or c != text)]
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    key_of = F.coalesce(F.col(key).cast("long"), F.lit(-(2**63)))
    total = df.agg(F.sum(F.octet_length(whole)), F.count("*")).first()
    parts = max(32, -(-(total[0] or 0) // BUCKET))
    buckets = parts
    tag = F.hash(key_of, whole)
    docs = df.select(key_of.alias("key"), tag.alias("tag"), whole.alias("text"))
    hot = hot_anchors(docs, min(1.0, SAMPLE / max(1, total[1])), length, parts)
    rows = docs.mapInPandas(anchored(length, parts, buckets, hot), ROWS)
    rows = written(rows.repartition(parts, "part").mapInPandas(compared(length, buckets, SHARD), ROWS), "snippets")
    contested = rows.where(F.col("kind") == CONTESTED)
    shards = max(1, -(-(contested.agg(F.sum("size")).first()[0] or 0) // SHARD))

    plain = [F.col(f"`{c}`") for c in names]
    left = df.select(*plain, key_of.alias("_key"), tag.alias("_tag"), whole.alias("_text"))
    left = left.withColumn("_bucket", F.pmod(F.col("_tag").cast("long"), F.lit(buckets)))
    few = left.select("_key", "_tag", "_text", "_bucket").groupBy("_bucket")
    bytes_of = few.cogroup(contested.select(F.col("part").alias("_bucket"), "blob").groupBy("_bucket")).applyInArrow(
        fetched(length, shards), "shard long, blob binary, bytes binary"
    )
    found = bytes_of.repartition(min(shards, 100_000), "shard").sortWithinPartitions("shard")
    found = written(found.mapInPandas(sorted_shards(length, buckets, shards), ROWS), "windows")
    merged = found.where(F.col("kind") == WINDOWS).groupBy("part").applyInPandas(merged_windows(length, buckets), ROWS)
    covered = rows.unionByName(found).where(F.col("kind") == COVERED).unionByName(merged)
    result = StructType(df.select(*plain).schema.fields + [StructField(c, t) for c, t in new.items()])
    right = covered.select(F.col("part").alias("_bucket"), "blob")
    finish = removed(to_arrow_schema(result), names, characters)
    return left.groupBy("_bucket").cogroup(right.groupBy("_bucket")).applyInArrow(finish, result)
