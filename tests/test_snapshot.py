"""Key ranges and the hand-over from a snapshot to the log."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tideline.plans.snapshot import Chunk, Handover, read_chunks
from tideline.plans.sync import DatabaseSync
from tideline.sources.splits import key_splits, quantile_query, range_predicates
from test_sync import batch, change, rows_of


def test_every_row_lies_in_one_range(spark):
    draw = random.Random(2)
    rows = [(draw.choice(["a'b", "B\\", "", "é", "zz", None]), draw.randrange(40), n) for n in range(3000)]
    df = spark.createDataFrame(rows, "name string, part int, n int")
    for key in (["n"], ["name", "n"], ["name", "part", "n"]):
        parts = key_splits(df, key, 8, sampled=100)
        held = df.select(*[F.expr(p).cast("int").alias(f"c{i}") for i, p in enumerate(parts)])
        assert held.where(" + ".join(held.columns) + " <> 1").count() == 0
        sizes = [held.where(f"{c} = 1").count() for c in held.columns]
        assert len(sizes) == 8 and (max(sizes) <= 750 or "name" in key) and min(sizes) > 100
    assert key_splits(df.limit(0), ["n"], 8) == ["1 = 1"]
    with pytest.raises(ValueError):
        range_predicates(["n; DROP"], [(1,)])


def test_the_source_cuts_its_own_index():
    """In the memory of this process only: the statement a relational source gets."""
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT 'k' || (i % 9) AS a, i AS b FROM range(1000) r(i)")
    cuts = con.execute(quantile_query("t", ["a", "b"], 8)).fetchall()
    assert len(cuts) == 7
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in range_predicates(["a", "b"], cuts)]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 2
    assert con.execute(quantile_query("(SELECT * FROM t WHERE b < 0)", ["a"], 8)).fetchall() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_chunks_and_log_in_any_order(spark, tmp_path, seed):
    """A source that changes while it is read: chunks are merged early, late or twice, with folds between."""
    rng = random.Random(seed)
    state, log, seen = {k: 0 for k in range(12)}, [], []
    columns, sync = [("id", "BIGINT"), ("v", "BIGINT")], DatabaseSync(spark, str(tmp_path))
    handover = Handover(sync, "shop", "users", columns, ["id"], start=0)

    def go_on(steps):
        for _ in range(steps):
            key = rng.randrange(16)
            if key in state and rng.random() < 0.4:
                del state[key]
                log.append(change(len(log) + 1, "d", before={"id": key}))
            else:
                state[key] = len(log) + 1
                log.append(change(len(log) + 1, "u", after={"id": key, "v": len(log) + 1}))
        return len(log)

    def read(predicate):
        go_on(rng.randrange(4))
        low, high = map(int, predicate.split())
        rows = [(k, v) for k, v in state.items() if low <= k < high]
        go_on(rng.randrange(4))
        return spark.createDataFrame(rows, "id long, v long")

    seen = list(read_chunks(["0 5", "5 9", "9 99"], read, lambda: go_on(rng.randrange(3))))
    end = go_on(5)
    steps = [*seen, rng.choice(seen), "log", "log", "fold"]
    rng.shuffle(steps)
    cut, done = rng.randrange(1, end), 0
    for step in steps:
        if isinstance(step, Chunk):
            handover.merge(step)
        elif step == "fold":
            sync.table("shop", "users").fold(mark=0, every=True)
        else:
            part = log[:cut] if done == 0 else log[cut:]
            sync.apply_batch(batch(spark, *part), done)
            done += 1
    assert handover.finish() <= end
    assert rows_of(sync.table("shop", "users")) == sorted(state.items(), key=str)
