"""Benchmark decontamination by templates, which also catches questions with other numbers, names or units."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.llm.common import Rows, runs_by_size, written

#: Tokens of a template window, how many of them must be plain words, and the share of an item's windows that counts.
WINDOW = 5
PLAIN = 3
COVERAGE = 0.5
#: Tokens in a row with the item's own values that count whatever share of the item they are.
RUN = 13
RUN_CHARS = 1 << 21
TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+|[%$€£¥°]")
#: Fixed list: what counts as a unit after a number.
UNITS = frozenset(
    "% $ € £ ¥ ° mm cm dm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg t gram grams kilogram "
    "kilograms ton tons lb lbs pound pounds oz ounce ounces ml cl dl l liter liters litre litres gallon gallons s sec "
    "second seconds min minute minutes h hr hour hours day days week weeks month months year years hz khz mhz ghz w kw "
    "v a j kj cal kcal pa kpa bar b kb mb gb tb k c f degree degrees percent dollar dollars cent cents euro euros "
    "mph kph kmh".split()
)
WORD, CAPITAL, NUMBER = 0, 1, 2
HOLES = {"num": 1, "name": 2, "unit": 3}
#: What a window's placeholders are: numbers, units and names; numbers and units; nothing (all tokens literal).
TEMPLATE, NAMED, EXACT = 0, 1, 2
SEPARATOR = "\x1f"
TOKEN_OR_END = re.compile(TOKEN.pattern + r"|\n")


class Kinds(dict):
    """What a token is by its first character."""

    def __missing__(self, c: str) -> int:
        self[c] = kind = NUMBER if c.isdigit() else CAPITAL if c.isupper() else WORD
        return kind


KINDS = Kinds()


def appended(arrays: tuple, at: int, more: tuple) -> tuple:
    """The arrays with ``more`` written from ``at`` on, twice as long if there is no room."""
    size = at + len(more[0])
    if size > len(arrays[0]):
        arrays = tuple(np.concatenate([a, np.zeros(size, a.dtype)]) for a in arrays)
    for a, m in zip(arrays, more):
        a[at:size] = m
    return arrays


class Templates:
    """Turns texts into template tokens. What it knows of a stretch between white space is kept for the next time.

    A number is a placeholder; so is a known unit after a number; so is a capitalised word, unless it is the first
    of the text or follows the end of a sentence. Other words stand for themselves, in lower case.
    """

    def __init__(self, most: int = 300_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.row, self.token = Rows(), []
        self.of_chunks = tuple(np.zeros(1024, t) for t in (np.int64, np.int64))  # first token, number of tokens
        self.of_tokens = tuple(np.zeros(1024, t) for t in (np.int8, bool, np.uint64, bool))  # kind, unit, hash, end

    def rows(self, lists: list[list[str]]) -> np.ndarray:
        """The numbers of all stretches one after another. New ones are learned, all at once."""
        if len(self.row) > self.most:
            self.clear()
        chunk = np.fromiter(map(self.row.__getitem__, chain.from_iterable(lists)), np.int64, sum(map(len, lists)))
        if self.row.new:
            self.learn(self.row.new)
            self.row.new.clear()
        return chunk

    def learn(self, new: list[str]) -> None:
        # No stretch holds a line feed, so all of them are matched as one string.
        found = TOKEN_OR_END.findall("\n".join(new) + "\n")
        ends = np.flatnonzero(np.fromiter(map("\n".__eq__, found), bool, len(found)))
        count = np.diff(ends, prepend=-1) - 1
        known, first = len(self.token), len(self.row) - len(new)
        tokens = [t for t in found if t != "\n"]
        n = len(tokens)
        self.token += tokens
        self.of_chunks = appended(self.of_chunks, first, (known + np.cumsum(count) - count, count))
        low = list(map(str.lower, tokens))
        kind = np.fromiter(map(KINDS.__getitem__, map(itemgetter(0), tokens)), np.int8, n)
        unit = np.fromiter(map(UNITS.__contains__, low), bool, n)
        value = np.fromiter(map(xxhash.xxh64_intdigest, low), np.uint64, n) | np.uint64(7)  # the least values stand for placeholders
        end = np.zeros(n, bool)
        some = np.flatnonzero(count)
        closed = np.fromiter((c.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", "…", ":") for c in new), bool, len(new))
        end[(np.cumsum(count) - 1)[some]] = closed[some]
        self.of_tokens = appended(self.of_tokens, known, (kind, unit, value, end))

    def windows(self, texts: list[str], size: int, short: tuple = (), every: bool = False) -> tuple:
        """Each window's text, place, hash, first token, length and form; then what ``slots`` needs of all tokens.

        A text with fewer tokens than ``size`` is one window. Lengths in ``short`` give windows of their own at every
        place. A window's form is the first that leaves ``PLAIN`` words in it (all, if it is shorter); with ``every``
        it is given in the other forms that do so too.
        """
        lists = [t.split() for t in texts]
        chunk = self.rows(lists)
        (first, count), (kinds, units, hashes, ends) = self.of_chunks, self.of_tokens
        size_of = np.fromiter(map(len, lists), np.int64, len(lists))
        n = count[chunk]
        text_of = np.repeat(np.repeat(np.arange(len(lists)), size_of), n)
        token = np.repeat(first[chunk] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        kind, unit, value, end = kinds[token], units[token], hashes[token], ends[token]
        start = np.r_[True, text_of[1:] != text_of[:-1]] if len(token) else np.zeros(0, bool)
        before = np.r_[False, kind[:-1] == NUMBER][: len(token)] & ~start
        fresh = start | np.r_[False, end[:-1]][: len(token)]
        hole = np.where(
            kind == NUMBER,
            HOLES["num"],
            np.where(before & unit, HOLES["unit"], np.where((kind == CAPITAL) & ~fresh, HOLES["name"], 0)),
        )
        value = np.where(hole > 0, hole.astype(np.uint64), value)
        begin = np.flatnonzero(start)
        tokens = np.diff(np.r_[begin, len(token)])
        place = np.arange(len(token)) - np.repeat(begin, tokens)
        left = np.repeat(tokens, tokens) - place
        at = np.flatnonzero((left >= size) | (place == 0))
        reach = np.minimum(left[at], size)
        for n in short:
            more = np.flatnonzero(left >= n)
            at, reach = np.r_[at, more], np.r_[reach, np.full(len(more), n)]
        literal = np.where(hole == HOLES["name"], hashes[token], value)

        def plain(open_: np.ndarray) -> np.ndarray:
            many = np.r_[0, np.cumsum(open_)]
            return many[at + reach] - many[at] >= np.minimum(PLAIN, reach)

        def mixed(values: np.ndarray, of: np.ndarray, start: int) -> np.ndarray:
            some, length = at[of], reach[of]
            out = np.full(len(some), start, np.uint64)
            whole = (length == size).all()
            with np.errstate(over="ignore"):
                for k in range(size):
                    if whole:
                        out = out ^ values[some + k]
                    else:
                        out = out ^ np.where(k < length, values[np.minimum(some + k, len(token) - 1)], 0)
                    out *= np.uint64(0x9E3779B97F4A7C15)
                    out ^= out >> np.uint64(32)
            return out

        forms = [plain(hole == 0), plain((hole == 0) | (hole == HOLES["name"]))]
        if every:
            has_name = np.r_[0, np.cumsum(hole == HOLES["name"])]
            named = forms[1] & ~(forms[0] & (has_name[at + reach] == has_name[at]))  # else the two forms are the same
        else:
            named = forms[1] & ~forms[0]
        picks = [np.flatnonzero(forms[0]), np.flatnonzero(named), np.flatnonzero(~forms[1])]
        values = (value, literal, hashes[token])
        # A window in named form has the hash of a template without names: a copy in lower case has that one.
        h = np.concatenate([mixed(v, of, int(form == EXACT)) for form, (v, of) in enumerate(zip(values, picks))])
        of = np.concatenate(picks)
        form = np.repeat(np.arange(3, dtype=np.int8), [len(p) for p in picks])
        at, reach = at[of], reach[of]
        return text_of[at], place[at], h, at, reach, form, (token, hole, begin, tokens)

    def slots(self, at: int, reach: int, form: int, run: tuple) -> str:
        """What fills the placeholders of a window, with their places in it and kinds."""
        token, hole, _, _ = run
        if form == EXACT:
            return ""
        left = (0, HOLES["name"]) if form == NAMED else (0,)
        return SEPARATOR.join(f"{i - at}:{hole[i]}{self.token[token[i]].lower()}" for i in range(at, at + reach) if hole[i] not in left)


SCHEMA = "h long, key long, place int, slots string, windows int, reach int"


def _windows(size: int, bits: np.ndarray | None, short: tuple = ()):
    """A function for ``mapInPandas`` over ``key``, ``text``: the rows of ``SCHEMA`` for windows whose bit is set."""

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        templates = Templates()
        for some in batches:
            done = 0
            for texts in runs_by_size(some["text"].tolist(), len, RUN_CHARS):
                owner, place, h, at, reach, form, run = templates.windows(texts, size, short, bits is None)
                keys = some["key"].iloc[done : done + len(texts)]
                done += len(texts)
                total = run[3][np.searchsorted(run[2], at, "right") - 1] if bits is None else np.zeros(len(at), np.int64)
                if bits is not None:
                    shift = np.uint64(64 - (len(bits) * 64).bit_length() + 1)
                    bit = h >> shift
                    hit = bits[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63)) & np.uint64(1) == 1
                    owner, place, h, at, total = owner[hit], place[hit], h[hit], at[hit], total[hit]
                    reach, form = reach[hit], form[hit]
                yield pd.DataFrame(
                    {
                        "h": h.view(np.int64),
                        "key": keys.to_numpy()[owner],
                        "place": place.astype(np.int32),
                        "slots": pd.Series([templates.slots(*x, run) for x in zip(at.tolist(), reach.tolist(), form.tolist())], dtype=object),
                        "windows": np.maximum(1, total - size + 1).astype(np.int32),
                        "reach": reach.astype(np.int32),
                    }
                )

    return windows


def _bitmap(windows: DataFrame) -> np.ndarray:
    """A bit for each window hash's leading bits, in 64-bit words: 16 bits a hash, 16 MB at most.

    It only spares rows that could not be joined; more hashes than fit make it less sharp, never wrong.
    """
    n = windows.count()
    exponent = min(27, max(16, (16 * n).bit_length()))
    word = F.shiftrightunsigned("h", 64 - exponent + 6)
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - exponent}) & 63 as int))")
    rows = windows.groupBy(word.cast("int").alias("w")).agg(F.bit_or(bit).alias("b")).toPandas()
    bits = np.zeros(1 << (exponent - 6), np.int64)
    bits[rows["w"].to_numpy(np.int64)] = rows["b"].to_numpy(np.int64)
    return bits.view(np.uint64)


def judge(nths: list, theirs: list, slots: list, size: int, strict: bool) -> tuple[list, int, bool]:
    """Of one occurrence: the places of the windows that count, tokens of the longest own run, whether all are own.

    ``theirs``: the item's slots of each window, ``slots``: the document's. Windows with the item's own values always
    count. Every value of the item is replaced by the value that stands for it at most places, or by itself if none is
    ahead; windows with another replacement are left out. ``strict``: if two other values are level, nothing counts.
    """
    own = [a == b for a, b in zip(theirs, slots)]
    counts, level = list(own), False
    if not all(own):
        places: dict[str, dict[str, set]] = {}
        pairs = []
        for nth, a, b in zip(nths, theirs, slots):
            split = [(int((x := p.split(":", 1))[0]), x[1], q.split(":", 1)[1]) for p, q in zip(a.split(SEPARATOR), b.split(SEPARATOR))] if a else []
            pairs.append([(x, y) for _, x, y in split])
            for off, x, y in split:
                places.setdefault(x, {}).setdefault(y, set()).add(nth + off)
        best = {}
        for x, others in places.items():
            most = max(map(len, others.values()))
            first = [y for y, at in others.items() if len(at) == most]
            best[x] = x if x in first else min(first, key=lambda y: min(others[y]))
            level = level or (len(first) > 1 and x not in others)
        if strict and level:
            return [], 0, False
        counts = [o or all(best[x] == y for x, y in some) for o, some in zip(own, pairs)]
    places_own = sorted({n for n, o in zip(nths, own) if o})
    longest = run = 0
    for k, n in enumerate(places_own):
        run = run + 1 if k and places_own[k - 1] == n - 1 else 1
        longest = max(longest, run)
    return sorted({n for n, c in zip(nths, counts) if c}), longest + size - 1 if longest else 0, all(own)


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: float = COVERAGE,
    run: int = RUN,
    strict: bool = True,
) -> DataFrame:
    """``doc_id``, ``item_id``, ``coverage``, ``same_slots``: documents that hold a benchmark item, re-parameterised or not.

    Windows of template tokens are joined on their hash; those with too few plain words have their names, or all their
    tokens, as they are. Windows that are shifted alike form an occurrence, of which those count that ``judge`` names.
    A document holds an item if its occurrences' windows cover at least ``coverage`` of the item's windows, or if one
    has ``run`` tokens in a row with the item's own values. ``same_slots`` tells whether some occurrence among them has
    the item's own values throughout.

    ``strict``: an item of fewer tokens than a window must be the whole document, and an occurrence where one value
    became two others equally often counts nothing. Otherwise such items are looked for at every place of a document.

    Null texts and texts without tokens hold nothing, and as items are never found. Rows that share a key count as
    one document; null keys are reported as a null key. Repeated items repeat nothing. Clean documents give no row.
    """
    spark = docs.sparkSession
    no_key = F.lit(-(2**63))  # stands for a null key

    def plain(df: DataFrame, k: str, t: str) -> DataFrame:
        some = df.where(F.col(t).isNotNull())
        return some.select(F.coalesce(F.col(k).cast("long"), no_key).alias("key"), F.col(t).cast("string").alias("text"))

    items = written(plain(benchmark, item, item_text).distinct().mapInPandas(_windows(window, None), SCHEMA), "item-windows")
    bits = spark.sparkContext.broadcast(_bitmap(items))
    short = () if strict else tuple(sorted(r[0] for r in items.where(F.col("reach") < window).select("reach").distinct().collect()))

    def filtered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _windows(window, bits.value, short)(batches)

    found = plain(docs, key, text).mapInPandas(filtered, SCHEMA).select("h", "key", "place", "slots")
    theirs = items.select(
        "h", F.col("key").alias("item"), F.col("place").alias("nth"), F.col("slots").alias("theirs"), "windows"
    )
    met = found.join(theirs, "h").withColumn("shift", F.col("place") - F.col("nth"))
    # An occurrence has no more windows and slots than its item, so these sets are as small as the item.
    one = met.groupBy("key", "item", "shift").agg(
        F.array_sort(F.collect_set(F.struct("nth", "theirs", "slots"))).alias("m"), F.max("windows").alias("windows")
    )

    def judged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            found = [judge(n.tolist(), a, b, window, strict) for n, a, b in zip(some["nth"], some["theirs"], some["slots"])]
            yield some[["key", "item", "windows"]].assign(
                nths=[f[0] for f in found], run=[f[1] for f in found], same=[f[2] for f in found]
            )

    one = one.select("key", "item", "windows", "m.nth", "m.theirs", "m.slots")
    one = one.mapInPandas(judged, "key long, item long, windows int, nths array<int>, run int, same boolean")
    every = one.select("key", "item", "windows", "run", "same", F.explode("nths").alias("nth"))
    out = every.groupBy("key", "item").agg(
        (F.count_distinct("nth") / F.max("windows")).alias("coverage"),
        F.max("same").alias("same_slots"),
        F.max("run").alias("run"),
    )
    return out.where((F.col("coverage") >= coverage) | (F.col("run") >= run)).select(
        F.when(F.col("key") != no_key, F.col("key")).alias(key),
        F.when(F.col("item") != no_key, F.col("item")).alias(item),
        "coverage",
        "same_slots",
    )


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows whose text holds no benchmark item, with all their columns. Keys, null or repeated, don't matter."""
    digest = F.xxhash64(F.col(text).cast("string"))
    leaks = find(docs.select(digest.alias("_row"), text), benchmark, "_row", text, strict=False).select("_row").distinct()
    return docs.withColumn("_row", digest).join(leaks, "_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
