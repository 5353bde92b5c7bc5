"""Joins of streams and tables: window, temporal, rule and threshold joins."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.operators.scan import Lag, Last, OrderedScan

MAX_INLINE_RULES = 500  # beyond this many rules the gram index is used
GRAM = 8
SAMPLE_OF = 64  # one in so many texts tells which grams are frequent; that decides on the way only
WORDS = 1 << 14  # 64-bit words of the gram bitmap


def window_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: str
) -> DataFrame:
    """Pairs of rows with the same key in the same tumbling window.

    A plain equi-join, so adaptive execution can split a hot key and window.
    Works on streams when both sides carry a watermark.
    """
    a = left.withColumn("window", F.window(left_ts, size))
    b = right.withColumn("window", F.window(right_ts, size))
    return a.join(b, [key, "window"])


def lookup_join(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Facts with the row of a single-version dimension; unmatched facts are dropped.

    Spark broadcasts the dimension when its size allows and sorts both sides otherwise.
    """
    return facts.join(dimension, facts[fact_key] == dimension[dim_key]).drop(dimension[dim_key])


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    keys: list[str],
    fact_order: str,
    version_order: str,
    payload: list[str],
    tiebreak: str,
    strict: bool = False,
    keep_unmatched: bool = False,
) -> DataFrame:
    """Each fact with the latest version of its key that is not newer.

    Both sides are stacked and scanned once in order, so the cost does not grow
    with the versions per key. ``strict`` leaves out versions of equal time,
    ``tiebreak`` is a column of both sides that orders rows of equal time.
    """
    carried = [c for c in facts.columns if c not in keys]
    a = facts.select(
        *keys,
        F.col(fact_order).alias("_at"),
        F.lit(0 if strict else 1).alias("_side"),
        F.col(tiebreak).alias("_tie"),
        F.struct(*carried).alias("_fact"),
    )
    b = versions.select(
        *keys,
        F.col(version_order).alias("_at"),
        F.lit(1 if strict else 0).alias("_side"),
        F.col(tiebreak).alias("_tie"),
        F.struct(*payload).alias("_version"),
    )
    stacked = a.unionByName(b, allowMissingColumns=True)
    scan = OrderedScan(stacked, keys, ["_at", "_side", "_tie"]).add(_current=Last("_version"))
    out = scan.result().where(F.col("_fact").isNotNull())
    if not keep_unmatched:
        out = out.where(F.col("_current").isNotNull())
    return out.select(
        *keys,
        *[F.col(f"_fact.{c}").alias(c) for c in carried],
        *[F.col(f"_current.{c}").alias(c) for c in payload],
    )


def threshold_alerts(
    events: DataFrame, configs: DataFrame, key: str, seq: str, value: str, threshold: str
) -> DataFrame:
    """Events above the latest threshold of their key that arrived before them."""
    matched = asof_join(events, configs, [key], seq, seq, [threshold], seq, strict=True)
    return matched.where(F.col(value) > F.col(threshold))


def alert_message(key: str, value: str, threshold: str) -> Column:
    """``ALERT: k value v exceeds threshold t``."""
    return F.concat(
        F.lit("ALERT: "),
        F.col(key).cast("string"),
        F.lit(" value "),
        F.col(value).cast("string"),
        F.lit(" exceeds threshold "),
        F.col(threshold).cast("string"),
    )


def latest_rules(rules: DataFrame, rule_id: str = "rule_id", seq: str = "seq") -> DataFrame:
    """The last update of every rule: ``rule_id, pattern``."""
    return rules.groupBy(rule_id).agg(F.max_by("pattern", seq).alias("pattern"))


def match_rules_as_of(
    messages: DataFrame,
    updates: DataFrame,
    text: str,
    seq: str = "seq",
    max_inline: int = MAX_INLINE_RULES,
) -> DataFrame:
    """Like :func:`match_rules`, each message against the rules that were current when it arrived.

    ``updates`` has ``rule_id``, ``pattern`` and ``seq``, in one sequence with the
    messages. Every update is matched as a rule of its own and holds until the next
    one of the same rule arrives.
    """
    versions = (
        OrderedScan(updates.select("rule_id", "pattern", F.col(seq).alias("_from")), ["rule_id"], ["_from"], descending=True)
        .add(_until=Lag("_from"))
        .result()
    )
    versions = versions.where(F.col("pattern").isNotNull()).distinct()
    few = versions.limit(max_inline + 1).collect()
    if len(few) <= max_inline:
        return _match_inline(
            messages, versions.schema, few, text, lambda r: _live(F.col(seq), r["_from"], r["_until"])
        )
    tagged = versions.select(F.struct("rule_id", "_from", "_until").alias("rule_id"), "pattern")
    hits = _match_by_gram(messages, tagged, text)
    live = _live(F.col(seq), F.col("rule_id._from"), F.col("rule_id._until"))
    return hits.where(live).select(*messages.columns, F.col("rule_id.rule_id").alias("rule_id"), "pattern")


def _live(at: Column, since: Column, until: Column) -> Column:
    return (at > since) & (until.isNull() | (at < until))


def rule_message(user: str, text: str) -> Column:
    """``User u matched rule r (p): text``, for a row of :func:`match_rules`."""
    return F.format_string(
        "User %s matched rule %s (%s): %s", F.col(user).cast("string"), F.col("rule_id").cast("string"), "pattern", text
    )


def update_messages(updates: DataFrame, kind: str, key: str, value: str) -> DataFrame:
    """What a rule or configuration stream reports of its own updates; ``kind`` is ``rule`` or ``config``."""
    form = {"rule": "Rule updated: %s -> %s", "config": "Config updated: %s threshold=%s"}[kind]
    return updates.select(
        "*", F.format_string(form, F.col(key).cast("string"), F.col(value).cast("string")).alias("message")
    )


def match_rules(
    messages: DataFrame,
    rules: DataFrame,
    text: str,
    max_inline: int = MAX_INLINE_RULES,
) -> DataFrame:
    """One row per message row and different rule whose pattern occurs in the lower-cased text.

    A small rule set, counted first, becomes a literal list that every task
    checks. A larger one is joined through character grams: a text meets only the
    rules whose rarest gram it contains, and the full pattern is then checked. Both
    give the same rows: messages need no id, repeated ones are matched each, null
    texts never.
    """
    known = rules.select("rule_id", "pattern").where(F.col("pattern").isNotNull()).distinct()
    few = known.limit(max_inline + 1).collect()
    if len(few) <= max_inline:
        return _match_inline(messages, known.schema, few, text)
    return _match_by_gram(messages, known, text)


def _match_inline(
    messages: DataFrame,
    schema: T.StructType,
    rules: list[Row],
    text: str,
    also: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Checks a literal list of rules; ``also`` is a cheaper condition that is checked first."""
    # One folded literal, however many rules there are.
    listed = json.dumps([r.asDict() for r in rules], default=str)
    known = F.from_json(F.lit(listed), T.ArrayType(schema))

    def found(lowered: Column) -> Column:
        hit = lambda r: F.contains(lowered, r["pattern"])
        return F.filter(known, lambda r: also(r) & hit(r) if also else hit(r))

    # Bound to a variable, the lower-cased text is computed once per message and not per rule.
    hits = F.flatten(F.transform(F.array(F.lower(text)), found))
    shown = F.transform(hits, lambda r: F.struct(r["rule_id"].alias("rule_id"), r["pattern"].alias("pattern")))
    return messages.select("*", F.inline(shown))


def _match_by_gram(messages: DataFrame, rules: DataFrame, text: str) -> DataFrame:
    """Rules meet texts under one gram each: of the pattern's grams the one that a sample of texts has least.

    A bitmap of the rules' grams, of a fixed size, drops almost all other grams before
    the shuffle. What is shuffled of a text is its digest with the grams that are
    left; the messages are joined once, by digest.
    """
    lowered = messages.withColumn("_lower", F.lower(text)).withColumn("_text", F.md5("_lower"))
    size = F.least(F.length("pattern"), F.lit(GRAM))
    short = rules.where(size < GRAM).select("rule_id", "pattern", F.col("pattern").alias("_gram"))
    every = F.array_distinct(_grams_of("pattern", GRAM))
    split = rules.where(size == GRAM).select("rule_id", "pattern", F.explode(every).alias("_gram"))
    sample = lowered.where(F.pmod(F.xxhash64("_lower"), F.lit(SAMPLE_OF)) == 0)
    seen = sample.select(F.explode(F.array_distinct(_grams_of("_lower", GRAM))).alias("_gram"))
    often = seen.join(split.select("_gram").distinct(), "_gram", "left_semi").groupBy("_gram").agg(F.count("*").alias("_n"))
    shared = split.groupBy("_gram").agg(F.count("*").alias("_rules"))
    cost = F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "_rules", "_gram")
    rated = split.join(shared, "_gram").join(often, "_gram", "left")
    rarest = rated.groupBy("rule_id", "pattern").agg(F.min(cost)["_gram"].alias("_gram"))
    keyed = rarest.unionByName(short)

    lengths = [r[0] for r in keyed.select(F.length("_gram")).distinct().collect()]  # at most GRAM + 1
    grams = [_grams_of("_lower", n) for n in lengths if n > 0]
    if 0 in lengths:
        grams.append(F.array(F.lit("")))
    bits = F.from_json(F.lit(json.dumps(_bitmap(keyed))), T.ArrayType(T.LongType()))
    here = F.pmod(F.xxhash64("_gram"), F.lit(64 * WORDS))
    hit = F.get(bits, F.shiftright(here, 6).cast("int")).bitwiseAND(F.expr("shiftleft(1L, cast(pmod(xxhash64(_gram), 64) as int))"))
    cut = lowered.select("_text", F.explode(F.array_distinct(F.flatten(F.array(*grams)))).alias("_gram")).where(hit != 0)
    candidates = cut.distinct().join(keyed, "_gram").select("_text", "rule_id", "pattern").distinct()
    hits = lowered.join(candidates, "_text").where(F.contains("_lower", "pattern"))
    return hits.select(*messages.columns, "rule_id", "pattern")


def _bitmap(keyed: DataFrame) -> list[int]:
    """A bit for each gram, in ``WORDS`` longs; at most that many rows reach the driver."""
    bit = F.expr("shiftleft(1L, cast(pmod(xxhash64(_gram), 64) as int))")
    word = F.shiftright(F.pmod(F.xxhash64("_gram"), F.lit(64 * WORDS)), 6)
    out = [0] * WORDS
    for r in keyed.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).collect():
        out[r["w"]] = r["b"]
    return out


def _grams_of(column: str, size: int) -> Column:
    """All overlapping character grams of one size."""
    return F.regexp_extract_all(column, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))
