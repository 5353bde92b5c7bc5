"""Structured Streaming forms of the operators.

Everything that a built-in streaming aggregate or join can say uses one: its
partial aggregation reduces hot keys before the shuffle. Only results that need
one output per input, timers or expiring state use a keyed state machine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators import joins, patterns, windows
from tideline.operators.windows import interval_micros
from tideline.streaming import processors as p

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def _kind(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _groups(stream: DataFrame) -> int:
    """Groups for work that any task can do."""
    return 4 * int(stream.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def window_agg(
    stream: DataFrame,
    ts: str,
    size: str,
    aggregates: dict[str, Column],
    keys: list[str] | None = None,
    slide: str | None = None,
    out_of_orderness: str = "0 seconds",
    lateness: str = "0 seconds",
) -> DataFrame:
    """Window results that are updated by late rows within ``lateness``.

    Run it in update mode to see every refinement, in append mode for final results.
    """
    delay = interval_micros(out_of_orderness) + interval_micros(lateness)
    marked = stream.withWatermark(ts, f"{delay} microseconds")
    return windows.window_agg(marked, ts, size, aggregates, keys, slide)


def session_agg(stream: DataFrame, ts: str, gap: str, value: str, keys: list[str], delay: str) -> DataFrame:
    """Count and sum per session of a key."""
    grouped = stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("s"), *keys)
    return grouped.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(
        *keys, F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), "n", "total"
    )


def window_join(
    left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, size: str, delay: str
) -> DataFrame:
    """Pairs with the same key and window; state is dropped once both watermarks pass it."""
    return joins.window_join(
        left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay), key, left_ts, right_ts, size
    )


def count_by(stream: DataFrame, keys: list[str], output: str = "n") -> DataFrame:
    """Current counts per key, for update mode."""
    return stream.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))


def latest_per_key(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The latest row per key, for update mode."""
    rest = [c for c in stream.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return stream.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def lookup_join(stream: DataFrame, dimension: DataFrame, stream_key: str, dim_key: str) -> DataFrame:
    """Stream rows with a dimension table that is read again for every micro-batch."""
    return joins.lookup_join(stream, dimension, stream_key, dim_key)


def match_rules(
    stream: DataFrame,
    read_rules: Callable[[], DataFrame],
    text: str,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None = None,
):
    """Matches a stream against rule updates that are read again for every micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        write(joins.match_rules(batch, joins.latest_rules(read_rules()), text), batch_id)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def running_stats(stream: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """Count, sum and average so far, one row per input."""
    rows = stream.select(F.col(key).alias("key"), F.col(seq).alias("seq"), F.col(value).cast("double").alias("value"))
    out = f"key {_kind(stream, key)}, seq {_kind(stream, seq)}, count long, sum double, avg double"
    return rows.groupBy("key").transformWithStateInPandas(p.RunningStats(), out, "Append", "None")


def recent_values(stream: DataFrame, key: str, seq: str, value: str, n: int = 5) -> DataFrame:
    """The last ``n`` values of the key, one row per input."""
    rows = stream.select(F.col(key).alias("key"), F.col(seq).alias("seq"), F.col(value).cast("double").alias("value"))
    out = f"key {_kind(stream, key)}, seq {_kind(stream, seq)}, recent array<double>"
    return rows.groupBy("key").transformWithStateInPandas(p.RecentValues(n), out, "Append", "None")


def threshold_alerts(
    events: DataFrame, configs: DataFrame, key: str, seq: str, value: str, threshold: str
) -> DataFrame:
    """Alerts and configuration updates of two streams that share ``key`` and ``seq``."""

    def side(df: DataFrame, number: str, config: bool) -> DataFrame:
        return df.select(
            F.col(key).alias("key"),
            F.col(seq).alias("seq"),
            F.col(number).cast("double").alias("value"),
            F.lit(config).alias("is_config"),
        )

    both = side(events, value, False).unionByName(side(configs, threshold, True))
    out = f"key {_kind(events, key)}, seq {_kind(events, seq)}, value double, threshold double, kind string"
    return both.groupBy("key").transformWithStateInPandas(p.ThresholdAlerts(), out, "Append", "None")


def repeated_events(
    stream: DataFrame, key: str, ts: str, seq: str, predicate: Column, times: int = 3, within: str = "10 seconds"
) -> DataFrame:
    """Matches of ``times`` events of a key in less than ``within``."""
    rows = stream.where(predicate).select(
        F.col(key).alias("key"), F.col(seq).cast("long").alias("seq"), F.unix_micros(ts).alias("us")
    )
    out = f"key {_kind(stream, key)}, seq long, start_us long, end_us long"
    machine = p.RepeatedEvents(times, interval_micros(within))
    return rows.groupBy("key").transformWithStateInPandas(machine, out, "Append", "None")


def inactivity(stream: DataFrame, key: str, timeout: str) -> DataFrame:
    """Keys without a row for ``timeout`` of processing time."""
    rows = stream.select(F.col(key).alias("key"))
    machine = p.Inactivity(interval_micros(timeout) // 1000)
    out = f"key {_kind(stream, key)}, timeout_at_ms long"
    return rows.groupBy("key").transformWithStateInPandas(machine, out, "Append", "ProcessingTime")


def order_timeouts(
    stream: DataFrame, key: str, ts: str, seq: str, action: str, timeout: str, delay: str = "0 seconds"
) -> DataFrame:
    """Order messages and timeouts in event time."""
    rows = stream.withWatermark(ts, delay).select(
        F.col(key).alias("key"),
        F.col(seq).cast("long").alias("seq"),
        F.col(ts).alias("ts"),
        F.unix_micros(ts).alias("us"),
        F.col(action).alias("action"),
    )
    machine = p.OrderTimeouts(interval_micros(timeout))
    out = f"key {_kind(stream, key)}, seq long, us long, status string"
    return rows.groupBy("key").transformWithStateInPandas(machine, out, "Append", "EventTime")


def ttl_session_count(stream: DataFrame, key: str, seq: str, ttl: str) -> DataFrame:
    """Running count per key that is forgotten after ``ttl`` of processing time."""
    rows = stream.select(F.col(key).alias("key"), F.col(seq).alias("seq"))
    machine = p.TtlCounter(interval_micros(ttl) // 1000)
    out = f"key {_kind(stream, key)}, seq {_kind(stream, seq)}, session_count long"
    return rows.groupBy("key").transformWithStateInPandas(machine, out, "Append", "ProcessingTime")


def mark_late(
    stream: DataFrame,
    ts: str,
    seq: str,
    value: str,
    size: str,
    out_of_orderness: str,
    lateness: str,
    spread: int | None = None,
) -> DataFrame:
    """All rows with ``is_late``, judged by the watermark of their micro-batch.

    The check needs no state, so rows are spread over ``spread`` groups by a hash
    of their sequence instead of a key (four for each shuffle partition, if not given). Built-in aggregates drop late rows; this
    form keeps them for a side output.
    """
    delay = interval_micros(out_of_orderness) + interval_micros(lateness)
    rows = stream.withWatermark(ts, f"{delay} microseconds").select(
        F.pmod(F.xxhash64(seq), F.lit(spread or _groups(stream))).alias("key"),
        F.col(ts).alias("ts"),
        F.col(seq).alias("seq"),
        F.unix_micros(ts).alias("us"),
        F.col(value).cast("double").alias("value"),
        F.unix_micros(F.window(ts, size)["end"]).alias("end_us"),
    )
    out = f"seq {_kind(stream, seq)}, us long, value double, is_late boolean"
    return rows.groupBy("key").transformWithStateInPandas(p.LateMarker(), out, "Append", "ProcessingTime")


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    fact_ts: str,
    version_ts: str,
    payload: list[str],
    tiebreak: str,
    delay: str,
    strict: bool = False,
) -> DataFrame:
    """Each fact with the latest version of its key that is not newer, in event time; unmatched facts are dropped.

    A fact waits until the watermark (``delay`` behind the later of both streams) has passed it, so the order in
    which facts and versions arrive does not matter. Versions are dropped once a newer one is older than the
    watermark. ``tiebreak`` is a whole number that orders versions of equal time.
    """
    carried = [c for c in facts.columns if c != key]

    def side(df: DataFrame, ts: str, columns: list[str], is_fact: bool) -> DataFrame:
        marked = df.withWatermark(ts, delay)
        body = F.to_json(F.struct(*columns), {"ignoreNullFields": "false", "timestampFormat": MICROS})
        return marked.select(
            F.col(key).alias("key"),
            F.col(ts).alias("ts"),
            F.unix_micros(ts).alias("us"),
            F.col(tiebreak).cast("long").alias("tie"),
            body.alias("body"),
            F.lit(is_fact).alias("is_fact"),
        )

    both = side(facts, fact_ts, carried, True).unionByName(side(versions, version_ts, payload, False))
    out = f"key {_kind(facts, key)}, fact string, version string"
    found = both.groupBy("key").transformWithStateInPandas(p.AsOfJoin(strict), out, "Append", "EventTime")

    def opened(column: str, df: DataFrame, columns: list[str]) -> list[Column]:
        schema = ", ".join(f"`{c}` {_kind(df, c)}" for c in columns)
        read = F.from_json(column, schema, {"timestampFormat": MICROS})
        return [read[c].alias(c) for c in columns]

    return found.select(F.col("key").alias(key), *opened("fact", facts, carried), *opened("version", versions, payload))


def group_count(changes: DataFrame, key: str, group: list[str], seq: str = "seq", kind: str = "kind") -> DataFrame:
    """Rows per group of the table that a change stream describes: ``group`` and ``n`` whenever a count changes.

    Two operators in a row: the first keeps each key's last image and gives what leaves its group and what comes,
    net of a micro-batch; the second keeps signed counts. ``n`` 0 says that a group is empty now.
    """
    image = F.to_json(F.struct(*group), {"ignoreNullFields": "false"})
    rows = changes.select(
        F.col(key).alias("key"),
        F.col(seq).cast("long").alias("seq"),
        F.when(F.col(kind) != "delete", image).alias("image"),
    )
    net = rows.groupBy("key").transformWithStateInPandas(p.LastImage(), "image string, sign int", "Append", "None")
    counted = net.groupBy("image").transformWithStateInPandas(p.SignedCount(), "image string, n long", "Append", "None")
    schema = ", ".join(f"`{c}` {_kind(changes, c)}" for c in group)
    read = F.from_json("image", schema)
    return counted.select(*[read[c].alias(c) for c in group], "n")


def top_n_per_window(
    stream: DataFrame, ts: str, size: str, key: str, value: str, n: int = 3, spread: int | None = None
) -> DataFrame:
    """The ``n`` keys with the largest sums of each window: ``window_start, version, rank, key, total``.

    Keys are spread over ``spread`` parts with a local list each; lists that change go to their window, whose list
    is given anew (with the next ``version``) when it changes, also when a sum falls. Ties go to the smaller key, by its text.
    """
    rows = stream.select(
        F.unix_micros(F.window(ts, size)["start"]).alias("window_us"),
        F.pmod(F.xxhash64(key), F.lit(spread or _groups(stream))).alias("salt"),
        F.col(key).cast("string").alias("key"),
        F.col(value).cast("double").alias("value"),
    )
    lists = rows.groupBy("window_us", "salt").transformWithStateInPandas(
        p.SaltTop(n), "window_us long, salt long, top string", "Append", "None"
    )
    out = "window_us long, version long, rank int, key string, total double"
    top = lists.groupBy("window_us").transformWithStateInPandas(p.WindowTop(n), out, "Append", "None")
    return top.select(F.timestamp_micros("window_us").alias("window_start"), "version", "rank", F.col("key").alias(key), "total")


def sequence_matches(
    stream: DataFrame, key: str, ts: str, seq: str, steps: list[patterns.Step], within: str
) -> DataFrame:
    """Matches of :func:`tideline.operators.patterns.sequence_matches`: ``key, seq, start_us, end_us``.

    The rows of a key must come in order of time from one micro-batch to the next.
    """
    hits = [F.when(s.predicate, F.lit(1 << n)).otherwise(F.lit(0)) for n, s in enumerate(steps)]
    rows = stream.select(
        F.col(key).alias("key"),
        F.col(seq).cast("long").alias("seq"),
        F.unix_micros(ts).alias("us"),
        sum(hits[1:], hits[0]).alias("hits"),
    )
    machine = p.SequenceMatches([s.strict for s in steps], interval_micros(within))
    out = f"key {_kind(stream, key)}, seq long, start_us long, end_us long"
    return rows.groupBy("key").transformWithStateInPandas(machine, out, "Append", "None")


def global_sessions(stream: DataFrame, ts: str, gap: str, value: str, delay: str) -> DataFrame:
    """Count and sum per session over all keys: ``session_start, session_end, n, total``.

    Rows of one cell of the gap's length belong to one session, so they are aggregated in their tasks first. Only a
    row for each cell meets the others in one place.
    """
    cell = F.window(ts, gap)
    us = F.unix_micros(ts)
    cells = stream.withWatermark(ts, delay).groupBy(cell.alias("cell")).agg(
        F.min(us).alias("first"), F.max(us).alias("last"), F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("total")
    )
    rows = cells.select(F.lit(0).alias("all"), F.window_time("cell").alias("at"), "first", "last", "n", "total")
    out = "start_us long, end_us long, n long, total double"
    machine = p.GlobalSessions(interval_micros(gap))
    found = rows.groupBy("all").transformWithStateInPandas(machine, out, "Append", "EventTime")
    times = {"session_start": "start_us", "session_end": "end_us"}
    return found.select(*[F.timestamp_micros(c).alias(n) for n, c in times.items()], "n", "total")


def exactly_once_files(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Writes a stream so that a restart repeats and loses nothing.

    Every micro-batch owns one folder, named by its number, and overwrites it when
    it is replayed.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
