"""Streaming joins, counts, top lists, sequences and sessions give what the batch forms give."""

import random

import pytest
from pyspark.sql import functions as F

from tideline.operators import changelog, joins, patterns, windows
from tideline.streaming import streams
from test_streams import _set, feed  # noqa: F401


@pytest.mark.parametrize("seed", [1, 2])
def test_asof_join_under_shuffled_arrival(feed, seed):  # noqa: F811
    rng = random.Random(seed)
    rows = [("abc"[rng.randrange(3)], i, rng.randrange(40_000), float(i), rng.choice(["fact", "fact", "version"])) for i in range(90)]
    rows.sort(key=lambda r: r[2] + rng.randrange(8_000))  # disorder within the delay
    for k in range(0, 90, 18):
        feed.put(*rows[k : k + 18])
    feed.put(("z", 1000, 90_000, 0.0, "fact"), ("y", 1001, 90_000, 0.0, "version"))  # both streams go on
    fact = F.col("action") == "fact"
    names = {"value": "price"}

    def sides(df):
        return df.where(fact).select("key", "seq", "ts", "value"), df.where(~fact).select("key", "seq", "ts", F.col("value").alias("price"))

    got = feed.run(streams.asof_join(*sides(feed.stream()), "key", "ts", "ts", ["price"], "seq", "10 seconds"))
    want = joins.asof_join(*sides(feed.batch()), ["key"], "ts", "ts", list(names.values()), "seq")
    cols = ["key", "seq", "ts", "value", "price"]
    assert len(got) > 30 and _set([[r[c] for c in cols] for r in got]) == _set(want.select(*cols).collect())


def test_group_count_after_every_batch(feed, spark):  # noqa: F811
    rng = random.Random(3)
    log, files = [], []
    for seq in range(80):
        kind = rng.choice(["insert", "update", "update", "delete"])
        log.append((f"k{rng.randrange(12)}", seq, rng.randrange(3) * 1000, 0.0, kind))
    for k in range(0, 80, 16):
        files.append(log[k : k + 16])
        feed.put(*reversed(log[k : k + 16]))
    changes = feed.stream().select("key", "seq", F.col("ms").alias("grp"), F.col("action").alias("kind"))
    counted = streams.group_count(changes, "key", ["grp"])
    batches = []
    query = (
        counted.writeStream.foreachBatch(lambda b, n: batches.append((n, b.collect())))
        .option("checkpointLocation", str(feed.folder / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    now, seen = {}, []
    for n, (_, rows) in enumerate(sorted(batches)):
        now.update({r["grp"]: r["n"] for r in rows})
        seen += files[n] if n < len(files) else []
        state = {}
        for key, _, grp, _, kind in seen:
            state.pop(key, None)
            if kind != "delete":
                state[key] = grp
        want = {g: list(state.values()).count(g) for g in set(state.values())}
        assert {g: c for g, c in now.items() if c} == want
    images = changelog.with_before_images(
        feed.batch().select("key", "seq", F.col("ms").alias("grp"), F.col("action").alias("kind")), ["key"], ["grp"])
    assert {r["grp"]: r["n"] for r in changelog.group_count(images, ["grp"]).collect()} == {g: c for g, c in now.items() if c}


@pytest.mark.parametrize("files", [1, 4])
def test_top_n_under_any_batching(feed, files):  # noqa: F811
    rng = random.Random(5)
    rows = [(f"k{rng.randrange(15)}", i, rng.randrange(3) * 20_000 + rng.randrange(9000), float(rng.randrange(-9, 12)), "x") for i in range(120)]
    for k in range(0, 120, 120 // files):
        feed.put(*rows[k : k + 120 // files])
    got = feed.run(streams.top_n_per_window(feed.stream(), "ts", "20 seconds", "key", "value", 3, spread=4))
    last = {}
    for r in got:
        last[r["window_start"]] = max(last.get(r["window_start"], 0), r["version"])
    final = [(r["window_start"], r["rank"], r["key"], r["total"]) for r in got if r["version"] == last[r["window_start"]]]
    sums = windows.window_agg(feed.batch(), "ts", "20 seconds", {"total": F.sum("value")}, ["key"])
    want = windows.top_n_per_window(sums, 3, "key", "total").select("window_start", "rank", "key", "total")
    assert _set(final) == _set(want.collect())


def brute_sequences(rows, steps, within):
    out = []
    for key in {r[0] for r in rows}:
        mine = sorted((r[2], r[1], r[4]) for r in rows if r[0] == key)
        for i, (ms, seq, action) in enumerate(mine):
            at, ok = i, action == steps[0][0]
            for name, strict in steps[1:]:
                fits = [j for j in range(at + 1, len(mine)) if mine[j][2] == name]
                ok = ok and bool(fits) and (not strict or fits[0] == at + 1)
                at = fits[0] if ok else at
            if ok and mine[at][0] - ms < within:
                out.append((key, seq, mine[at][0]))
    return sorted(out)


@pytest.mark.parametrize("strict", [(False, False), (True, False), (False, True), (True, True)])
def test_sequences_in_batch_and_stream(feed, strict):  # noqa: F811
    rng = random.Random(7)
    rows = [("ab"[rng.randrange(2)], i, i * 1000, 0.0, rng.choice("ABCD")) for i in range(160)]
    for k in range(0, 160, 40):
        feed.put(*reversed(rows[k : k + 40]))
    is_a = lambda x: F.col("action") == x
    steps = [patterns.Step(is_a("A")), patterns.Step(is_a("B"), strict[0]), patterns.Step(is_a("C"), strict[1])]
    want = brute_sequences(rows, [("A", False), ("B", strict[0]), ("C", strict[1])], 9_000)
    batch = patterns.sequence_matches(feed.batch(), ["key"], "ts", "seq", steps, "9 seconds")
    ms = (F.unix_millis("match_end") - 1_700_000_000_000).alias("end")
    assert want and _set(batch.select("key", "seq", ms).collect()) == want
    got = feed.run(streams.sequence_matches(feed.stream(), "key", "ts", "seq", steps, "9 seconds"))
    assert sorted((r["key"], r["seq"], r["end_us"] // 1000 - 1_700_000_000_000) for r in got) == want


def test_global_sessions(feed):  # noqa: F811
    rng = random.Random(9)
    times = sorted(rng.randrange(200) * 1000 for _ in range(70))
    rows = [("same", i, t, float(i), "x") for i, t in enumerate(times)]
    for k in range(0, 70, 14):
        part = rows[k : k + 14]
        rng.shuffle(part)
        feed.put(*part)
    feed.put(("same", 99, 400_000, 1.0, "x"))
    feed.put(("same", 100, 800_000, 1.0, "x"))
    got = feed.run(streams.global_sessions(feed.stream(), "ts", "5 seconds", "value", "30 seconds"))
    session = F.session_window("ts", "5 seconds")
    want = feed.batch().where("ms < 800000").groupBy(session.alias("s")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    cols = want.select("s.start", "s.end", "n", "total").collect()
    assert _set([tuple(r) for r in got if r["session_start"] is not None]) == _set(cols)


def test_parted_scans_of_rules(spark):
    """Several automata, nulls, empty and overlapping patterns, repeated messages."""
    from tideline.operators.automaton import scan_rules

    messages = spark.createDataFrame([(1, "He said HERS"), (2, None), (3, ""), (1, "He said HERS"), (4, "ushers é")], "id int, text string")
    rules = spark.createDataFrame([(1, "he"), (2, "hers"), (3, "é"), (4, ""), (5, None), (6, "he"), (7, "zz"), (1, "he")], "rule_id int, pattern string")
    for most in (2_000_000, 3):
        got = scan_rules(messages, rules, "text", most_chars=most)
        assert _set(got.collect()) == _set(joins.match_rules(messages, rules, "text").collect())


def test_digest_trees_read_unequal_leaves_only(spark):
    from tideline.operators import reconcile

    source = spark.range(1000).selectExpr("id", "if(id % 3 = 0, null, cast(id as string)) AS v")
    target = source.where("id <> 5").withColumn("v", F.when(F.col("id") == 7, "x").otherwise(F.col("v")))
    trees = [reconcile.digest_tree(df, ["id"], (4, 16)) for df in (source, target)]
    found = reconcile.unequal_buckets(*trees).collect()
    assert {r["level"] for r in found} == {0, 1, 2} and sum(r["level"] == 2 for r in found) <= 2
    assert _set(reconcile.reconcile_tree(source, target, ["id"]).collect()) == [(5, "missing"), (7, "different")]
    assert reconcile.reconcile_tree(source, source, ["id"]).count() == 0
