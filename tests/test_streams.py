"""Streaming forms give the results of the batch forms."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tideline.operators import joins, patterns, running, windows
from tideline.streaming import streams

ROWS = "key string, seq long, ms long, value double, action string"


class Feed:
    """A folder of JSON files as a stream, one micro-batch per file."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.files = spark, folder, 0
        (folder / "in").mkdir()

    def put(self, *rows):
        self.files += 1
        names = ["key", "seq", "ms", "value", "action"]
        text = "\n".join(json.dumps(dict(zip(names, r))) for r in rows)
        path = self.folder / "in" / f"{self.files:04d}.json"
        path.write_text(text)
        stamp = 1_700_000_000 + self.files


        os.utime(path, (stamp, stamp))

    def stream(self):
        reader = self.spark.readStream.schema(ROWS).option("maxFilesPerTrigger", 1)
        return _timed(reader.json(str(self.folder / "in")))

    def batch(self):
        return _timed(self.spark.read.schema(ROWS).json(str(self.folder / "in")))

    def run(self, df, mode="append", expect=None):
        """Runs to the end of the input; the rows of all micro-batches, in order.

        A query in processing time never ends by itself: it is stopped once it has
        given ``expect`` rows.
        """
        got = []
        query = (
            df.writeStream.outputMode(mode)
            .foreachBatch(lambda b, _: got.extend(b.collect()))
            .option("checkpointLocation", str(self.folder / "checkpoint"))
            .trigger(**({"availableNow": True} if expect is None else {"processingTime": "0 seconds"}))
            .start()
        )
        if expect is None:
            query.awaitTermination(120)
        else:
            end = time.time() + 60
            while len(got) < expect and time.time() < end and query.isActive:
                time.sleep(0.2)
        query.stop()
        return got


def _timed(df):
    # Event time starts above the initial watermark, the epoch.
    return df.withColumn("ts", F.timestamp_millis(F.col("ms") + 1_700_000_000_000))


@pytest.fixture
def feed(spark, tmp_path):
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # a Python worker per partition and micro-batch
    yield Feed(spark, tmp_path)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def _fill(feed, n=60, files=4):
    rows = [
        ("abc"[i * 7 % 3], i, i * 1700 % 60_000 + i * 500, float(i * 13 % 29), ("create", "pay", "cancel")[i * 5 % 7 % 3])
        for i in range(n)
    ]
    size = n // files
    for i in range(0, n, size):
        feed.put(*reversed(rows[i : i + size]))  # disorder inside a micro-batch


def _set(rows):
    return sorted(tuple(r) for r in rows)


def test_running_stats(feed):
    _fill(feed)
    got = feed.run(streams.running_stats(feed.stream(), "key", "seq", "value"))
    want = running.running_stats(feed.batch(), ["key"], ["seq"], "value").select("key", "seq", "count", "sum", "avg")
    assert _set(got) == _set(want.collect())


def test_recent_values(feed):
    _fill(feed)
    got = feed.run(streams.recent_values(feed.stream(), "key", "seq", "value", 5))
    want = running.recent_values(feed.batch(), ["key"], ["seq"], "value", 5).select("key", "seq", "recent")
    assert _set(got) == _set(want.collect())


def test_latest_and_counts(feed):
    _fill(feed)
    updates = feed.run(streams.latest_per_key(feed.stream().select("key", "seq", "value"), ["key"], ["seq"]), "update")
    final = {r["key"]: tuple(r) for r in updates}
    want = running.latest_per_key(feed.batch().select("key", "seq", "value"), ["key"], ["seq"])
    assert _set(final.values()) == _set(want.collect())


def test_threshold_alerts(feed):
    _fill(feed)
    config = F.col("action") == "create"
    stream, batch = feed.stream(), feed.batch()
    got = feed.run(
        streams.threshold_alerts(
            stream.where(~config), stream.where(config).withColumnRenamed("value", "limit"), "key", "seq", "value", "limit"
        )
    )
    alerts = [(r["key"], r["seq"], r["value"], r["threshold"]) for r in got if r["kind"] == "alert"]
    want = joins.threshold_alerts(
        batch.where(~config).select("key", "seq", "value"),
        batch.where(config).select("key", "seq", F.col("value").alias("limit")),
        "key", "seq", "value", "limit",
    ).select("key", "seq", "value", "limit")
    assert alerts and sorted(alerts) == _set(want.collect())


def _in_time_order(feed, n=60, files=4):
    rows = [("abc"[i * 7 % 3], i, i * 2500, float(i), ("create", "pay", "cancel", "other")[i * 5 % 11 % 4]) for i in range(n)]
    for i in range(0, n, n // files):
        feed.put(*reversed(rows[i : i + n // files]))


def test_repeated_events(feed):
    _in_time_order(feed)
    hit = F.col("action") == "create"
    got = feed.run(streams.repeated_events(feed.stream(), "key", "ts", "seq", hit, 3, "60 seconds"))
    want = patterns.repeated_events(feed.batch(), ["key"], "ts", "seq", hit, 3, "60 seconds").select(
        "key", "seq", F.unix_micros("ts"), F.unix_micros("match_end")
    )
    assert got and _set(got) == _set(want.collect())


@pytest.mark.parametrize("timeout", ["10 seconds", "30 seconds"])
def test_order_timeouts(feed, timeout):
    _in_time_order(feed)
    feed.put(("z", 1000, 10_000_000, 0.0, "other"))
    feed.put(("z", 1001, 10_000_001, 0.0, "other"))
    got = feed.run(streams.order_timeouts(feed.stream(), "key", "ts", "seq", "action", timeout))
    want = patterns.order_timeouts(feed.batch(), ["key"], "ts", "seq", "action", timeout).select(
        "key", "seq", F.unix_micros("at"), "status"
    )
    assert any(r["status"] == "TIMEOUT" for r in got)
    assert _set(got) == _set(want.collect())


def test_window_aggregates_and_sessions(feed):
    _in_time_order(feed)
    feed.put(("z", 1000, 10_000_000, 0.0, "other"))
    aggregates = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    got = feed.run(streams.window_agg(feed.stream(), "ts", "20 seconds", aggregates, ["key"], slide="10 seconds"))
    want = windows.window_agg(feed.batch().where("key <> 'z'"), "ts", "20 seconds", aggregates, ["key"], "10 seconds")
    assert _set(got) == _set(want.collect())


def test_session_aggregates(feed):
    _in_time_order(feed)
    feed.put(("z", 1000, 10_000_000, 0.0, "other"))
    got = feed.run(streams.session_agg(feed.stream(), "ts", "8 seconds", "value", ["key"], "0 seconds"))
    want = windows.session_agg(feed.batch().where("key <> 'z'"), "ts", "8 seconds", "value", ["key"])
    columns = ["key", "session_start", "session_end", "n", "total"]
    assert _set(got) == _set(want.select(*columns).collect())


def test_window_join(feed):
    _in_time_order(feed)

    def sides(df):
        left = df.where("action = 'create'").select("key", "ts", F.col("seq").alias("a"))
        right = df.where("action = 'pay'").select("key", F.col("ts").alias("ts2"), F.col("seq").alias("b"))
        return left, right

    got = feed.run(streams.window_join(*sides(feed.stream()), "key", "ts", "ts2", "40 seconds", "0 seconds").select("key", "a", "b"))
    want = joins.window_join(*sides(feed.batch()), "key", "ts", "ts2", "40 seconds").select("key", "a", "b")
    assert got and _set(got) == _set(want.collect())


def test_late_rows_one_row_per_batch(feed):
    """With one row per micro-batch the stream's rule is the batch rule."""
    times = [1000, 2000, 3000, 8000, 9000, 1500, 26_000, 2500, 500, 19_000, 31_000, 9_999]
    for seq, ms in enumerate(times):
        feed.put(("k", seq, ms, 1.0, None))
    marked = streams.mark_late(feed.stream(), "ts", "seq", "value", "10 seconds", "5 seconds", "5 seconds")
    got = feed.run(marked, expect=len(times))
    want = windows.mark_late(feed.batch(), "ts", "seq", "10 seconds", "5 seconds", "5 seconds")
    assert sorted((r["seq"], r["is_late"]) for r in got) == _set(want.select("seq", "is_late").collect())
    assert [r["seq"] for r in want.where("is_late").orderBy("seq").collect()] == [7, 8, 11]


def test_state_expires(feed):
    feed.put(("a", 1, 0, 0.0, None), ("a", 2, 0, 0.0, None), ("b", 3, 0, 0.0, None))
    counts = lambda: streams.ttl_session_count(feed.stream(), "key", "seq", "4 seconds")
    first = feed.run(counts(), expect=3)
    assert sorted((r["key"], r["session_count"]) for r in first) == [("a", 1), ("a", 2), ("b", 1)]
    time.sleep(5)
    feed.put(("a", 4, 0, 0.0, None))
    assert [r["session_count"] for r in feed.run(counts(), expect=1)] == [1]


def test_inactivity_timer(feed):
    feed.put(("a", 1, 0, 0.0, None))
    assert [r["key"] for r in feed.run(streams.inactivity(feed.stream(), "key", "1 second"), expect=1)] == ["a"]


def test_restart_writes_each_row_once(spark, feed, tmp_path):
    _fill(feed, 20, 2)
    for extra in [(), (("a", 99, 0, 0.0, None),), ()]:
        if extra:
            feed.put(*extra)
        streams.exactly_once_files(
            feed.stream(), str(tmp_path / "out"), str(tmp_path / "once")
        ).awaitTermination(60)
    assert sorted(r["seq"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [*range(20), 99]


def test_rules_are_read_again_per_batch(spark, feed, tmp_path):
    rules = tmp_path / "rules"
    rules.mkdir()
    got = []

    def run():
        schema = "seq int, rule_id string, pattern string"
        streams.match_rules(
            feed.stream().select("seq", "action"), lambda: spark.read.schema(schema).json(str(rules)), "action",
            lambda b, _: got.extend(b.collect()), str(tmp_path / "rule-checkpoint"),
        ).awaitTermination(60)

    (rules / "1.json").write_text('{"seq": 1, "rule_id": "r", "pattern": "pay"}')
    feed.put(("a", 1, 0, 0.0, "PAYMENT"), ("a", 2, 0, 0.0, "cancel"))
    run()
    (rules / "2.json").write_text('{"seq": 2, "rule_id": "r", "pattern": "cancel"}')
    feed.put(("a", 3, 0, 0.0, "pay"), ("a", 4, 0, 0.0, "cancelled"))
    run()
    assert sorted((r["seq"], r["pattern"]) for r in got) == [(1, "pay"), (4, "cancel")]
