"""Many patterns in one pass over each text: an Aho-Corasick automaton that every task scans with.

The rules are counted first. As many as fit in memory make one automaton, built once and
sent to each executor once; a larger set is split into several, and each scans the texts
in a pass of its own. Texts stay where they are: what moves is the rules.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Characters of the patterns of one automaton; a character takes about a hundred bytes.
MOST_CHARS = 2_000_000


def scan_rules(messages: DataFrame, rules: DataFrame, text: str, most_chars: int = MOST_CHARS) -> DataFrame:
    """One row per message row and different rule whose pattern occurs in the lower-cased text.

    The same rows as :func:`tideline.operators.joins.match_rules`: ``rule_id`` and ``pattern`` are added, null texts
    and patterns never match, an empty pattern matches every text, repeated messages are matched each.
    """
    rules = rules.select("rule_id", "pattern").where(F.col("pattern").isNotNull()).distinct()
    patterns = rules.where("pattern <> ''").select("pattern").distinct()
    total = patterns.agg(F.sum(F.length("pattern"))).first()[0] or 0
    parts = -(-total // most_chars)
    found = messages.join(rules.where("pattern = ''"), F.col(text).isNotNull())
    for n in range(parts):
        mine = patterns.where(F.pmod(F.xxhash64("pattern"), F.lit(parts)) == n)
        listed = [r["pattern"] for r in mine.collect()]  # about most_chars characters
        if not listed:
            continue
        hits = messages.withColumn("_pattern", F.explode(_found_in(messages, listed)(F.lower(text))))
        # A pattern is looked up by its text, so no order of the collected list matters.
        hits = hits.join(rules, F.col("_pattern") == F.col("pattern")).drop("_pattern")
        found = found.unionByName(hits)
    return found.select(*messages.columns, "rule_id", "pattern")


def _found_in(df: DataFrame, patterns: list[str]):
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for p in patterns:
        automaton.add_word(p, p)
    automaton.make_automaton()
    sent = df.sparkSession.sparkContext.broadcast(pickle.dumps(automaton))

    @F.pandas_udf("array<string>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = pickle.loads(sent.value)
        for texts in batches:
            yield pd.Series([sorted({p for _, p in automaton.iter(t)}) if t else [] for t in texts], dtype=object)

    return found
