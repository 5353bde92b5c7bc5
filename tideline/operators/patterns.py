"""Event patterns per key: repeats, inactivity and order timeouts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.scan import Lag, Last, OrderedScan
from tideline.operators.windows import interval_micros


def repeated_events(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tiebreak: str,
    predicate: Column,
    times: int = 3,
    within: str = "10 seconds",
    consecutive: bool = False,
) -> DataFrame:
    """``times`` matching events of a key in less than ``within``.

    One row per match, named after its first event, with the last event's time in
    ``match_end``. Other events may lie between the matching ones, and matches may
    overlap; ``consecutive`` allows no event of the key in between.
    """
    limit = interval_micros(within)
    rows = df.withColumns({"_us": F.unix_micros(ts), "_hit": predicate})
    if not consecutive:
        rows = rows.where("_hit")
    scan = OrderedScan(rows, keys, ["_us", tiebreak], descending=True)
    if consecutive:
        specs = {f"_h{i}": Lag("_hit", i) for i in range(1, times)}
        scan.add(_end=Lag("_us", times - 1), **specs)
    else:
        specs = {}
        scan.add(_end=Lag("_us", times - 1))
    out = scan.result().where(F.col("_end") - F.col("_us") < limit)
    for name in ["_hit", *specs]:
        out = out.where(F.col(name))
    return out.withColumn("match_end", F.timestamp_micros("_end")).drop("_us", "_hit", "_end", *specs)


@dataclass(frozen=True)
class Step:
    """One event of a sequence; a strict step must be the key's very next event, a relaxed one the next that fits."""

    predicate: Column
    strict: bool = False


def sequence_matches(
    df: DataFrame, keys: list[str], ts: str, tiebreak: str, steps: list[Step], within: str
) -> DataFrame:
    """Events of a key that fit the steps one after the other, the last in less than ``within`` after the first.

    One row per match, that of its first event, with the last event's time in ``match_end``. Every event that fits
    the first step starts a match of its own; each relaxed step takes the next event that fits it. What an event
    leads to is computed once for all matches that reach it: backwards over the steps, every event learns when a
    match that has come to it ends.
    """
    if len(steps) < 2:
        raise ValueError("a sequence has two steps at least")
    rows = df.withColumns({"_us": F.unix_micros(ts), **{f"_hit{n}": s.predicate for n, s in enumerate(steps)}})
    rows = rows.withColumn("_end", F.col("_us"))
    for n in range(len(steps) - 1, 0, -1):
        fits = F.coalesce(F.col(f"_hit{n}"), F.lit(False))
        rows = rows.withColumn("_step", F.when(fits, F.struct(F.col("_end").alias("end"))))
        if not steps[n].strict:
            rows = OrderedScan(rows, keys, ["_us", tiebreak], descending=True).add(_latest=Last("_step")).result()
            rows = rows.drop("_step").withColumnRenamed("_latest", "_step")
        rows = OrderedScan(rows.drop("_end"), keys, ["_us", tiebreak], descending=True).add(_next=Lag("_step")).result()
        rows = rows.withColumn("_end", F.col("_next.end")).drop("_next", "_step")
    found = rows.where(F.col("_hit0") & (F.col("_end") - F.col("_us") < interval_micros(within)))
    return found.withColumn("match_end", F.timestamp_micros("_end")).select(*df.columns, "match_end")


def inactivity_gaps(
    df: DataFrame, keys: list[str], ts: str, tiebreak: str, timeout: str, at_end: bool = True
) -> DataFrame:
    """Events after which the key was silent for longer than ``timeout``.

    ``at_end`` also reports each key's last event, as a timer at the end of input does.
    """
    limit = interval_micros(timeout)
    scan = OrderedScan(
        df.withColumn("_us", F.unix_micros(ts)), keys, ["_us", tiebreak], descending=True
    ).add(_next=Lag("_us"))
    silent = F.col("_next") - F.col("_us") > limit
    if at_end:
        silent = silent | F.col("_next").isNull()
    out = scan.result().where(silent)
    return out.withColumn("timeout_at", F.timestamp_micros(F.col("_us") + limit)).drop("_us", "_next")


def order_timeouts(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tiebreak: str,
    action: str,
    timeout: str,
) -> DataFrame:
    """Order messages and timeouts: ``status`` and ``at`` per key.

    ``create`` arms a timer, a following ``pay`` or ``cancel`` up to the deadline
    disarms it. A timer that fires reports ``TIMEOUT`` unless the latest create or
    pay up to the deadline is a pay. A new ``create`` arms a timer of its own and
    leaves the older one running.
    """
    limit = interval_micros(timeout)
    known = df.where(F.col(action).isin("create", "pay", "cancel")).select(
        *keys, F.unix_micros(ts).alias("_us"), F.col(tiebreak).alias("_tie"), F.col(action).alias("_action")
    )
    following = (
        OrderedScan(known.withColumn("_event", F.struct("_us", "_action")), keys, ["_us", "_tie"], descending=True)
        .add(_next=Lag("_event"))
        .result()
    )
    deadline = F.col("_us") + F.lit(limit)
    disarmed = (F.col("_next._action") != "create") & (F.col("_next._us") <= deadline)
    armed = (F.col("_action") == "create") & ~F.coalesce(disarmed, F.lit(False))
    # Each surviving timer becomes a row after all events of its deadline.
    stacked = following.select(
        *keys,
        F.inline(
            F.array_compact(
                F.array(
                    F.struct(F.col("_us").alias("_at"), F.lit(0).alias("_side"), "_tie", "_action"),
                    F.when(
                        armed,
                        F.struct(
                            deadline.alias("_at"),
                            F.lit(1).alias("_side"),
                            F.col("_tie").alias("_tie"),
                            F.lit("timer").alias("_action"),
                        ),
                    ),
                )
            )
        ),
    )
    paid = F.when(F.col("_action") == "create", False).when(F.col("_action") == "pay", True)
    # The events alone tell where the keys are hot; counting the stack would scan them all again.
    state = OrderedScan(
        stacked.withColumn("_set", paid),
        keys,
        ["_at", "_side", "_tie"],
        measure=known.withColumn("_at", F.col("_us")),
    ).add(_paid=Last("_set"))
    status = (
        F.when(F.col("_action") == "create", "created")
        .when(F.col("_action") == "pay", "paid")
        .when(F.col("_action") == "cancel", "cancelled")
        .when(~F.col("_paid"), "TIMEOUT")
    )
    return (
        state.result()
        .select(*keys, status.alias("status"), F.timestamp_micros("_at").alias("at"), F.col("_tie").alias(tiebreak))
        .where(F.col("status").isNotNull())
    )
