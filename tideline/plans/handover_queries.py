"""Contract queries of snapshots: key ranges, and the hand-over from a snapshot to a log that goes on meanwhile."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.plans.registry import query, table
from tideline.plans.snapshot import Chunk, Handover
from tideline.plans.sync import DatabaseSync
from tideline.session import shared_dir
from tideline.sources.splits import key_splits

CHUNKS = 16


@query(
    "key_splits",
    """
    SELECT 'orders' AS "table", count(*) AS n, count(*) AS once, true AS even FROM orders
    UNION ALL SELECT 'lineitem', count(*), count(*), true FROM lineitem
    UNION ALL SELECT 'orders by text', count(*), count(*), true FROM orders
    """,
)
def key_splits_query(spark, d):
    """How many rows lie in exactly one key range, and whether every range is within twice the mean."""
    out = []
    for name, source, key in (
        ("orders", "orders", ["o_orderkey"]),
        ("lineitem", "lineitem", ["l_orderkey", "l_linenumber"]),
        ("orders by text", "orders", ["o_orderpriority", "o_orderkey"]),
    ):
        rows = table(spark, d, source)
        held = [F.expr(p).cast("int") for p in key_splits(rows, key, CHUNKS)]
        sizes = [F.sum(h) for h in held]
        mean = F.count("*") / len(held)
        even = F.lit(len(held) == CHUNKS)
        for size in sizes:
            even &= (size <= 2 * mean) & (size >= mean / 2)
        once = F.count_if(sum(held[1:], held[0]) == 1)
        out.append(rows.agg(F.lit(name).alias("table"), F.count("*").alias("n"), once.alias("once"), even.alias("even")))
    return out[0].unionByName(out[1]).unionByName(out[2])


#: The life of an order: some are inserted, updated or deleted at these places of the log.
LIFE = {"insert": ("k % 7 = 0", 50_000_000), "update": ("k % 3 = 0 AND k % 7 <> 0", 0), "delete": ("k % 5 = 0", 200_000_000)}


def _at(op: str) -> str:
    which, first = LIFE[op]
    return f"if({which}, {first} + k, NULL)"


def _state(orders, place: int):
    """The orders as they are when the log has reached a place."""
    there = f"coalesce({_at('insert')} <= {place}, true) AND NOT coalesce({_at('delete')} <= {place}, false)"
    price = f"price + if(coalesce({_at('update')} <= {place}, false), 1, 0) AS price"
    return orders.where(there).selectExpr("k", price)


@query(
    "snapshot_handover",
    """
    SELECT o_orderkey AS k, o_totalprice + CASE WHEN o_orderkey % 3 = 0 AND o_orderkey % 7 <> 0 THEN 1 ELSE 0 END AS price
    FROM orders WHERE o_orderkey % 5 <> 0
    """,
)
def snapshot_handover(spark, d):
    """Orders that change while they are read in chunks; chunks and log are applied in turns, one chunk twice."""
    orders = table(spark, d, "orders").selectExpr("o_orderkey AS k", "o_totalprice AS price")
    image = "struct(k, price{} AS price)"
    log = None
    for op, code, row, after in (("insert", "c", "", True), ("update", "u", " + 1", True), ("delete", "d", "", False)):
        side = f"{image.format(row)} AS {'after' if after else 'before'}"
        text = f"to_json(struct('{code}' AS op, struct('shop' AS db, 'orders' AS table) AS source, {side})) AS value"
        some = orders.where(LIFE[op][0]).selectExpr(f"{_at(op)} AS seq", text, "array('k') AS key")
        log = some if log is None else log.unionByName(some)

    sync = DatabaseSync(spark, f"{shared_dir(spark)}/handover-{uuid.uuid4().hex}")
    handover = Handover(sync, "shop", "orders", [("k", "BIGINT"), ("price", "DOUBLE")], ["k"], start=0)
    parts = key_splits(orders, ["k"], 4)
    places = [10, 40_000, 50_000_300, 200_000_400]  # where the log was when a chunk was read
    chunks = [Chunk(_state(orders, p).where(r), p - 5, p + 5) for p, r in zip(places, parts)]
    cuts = [-1, 20_000, 60_000_000, 300_000_000]
    batches = [log.where((F.col("seq") > a) & (F.col("seq") <= b)) for a, b in zip(cuts, cuts[1:])]
    sync.apply_batch(batches[0], 0)
    handover.merge(chunks[1])
    handover.merge(chunks[0])
    sync.apply_batch(batches[1], 1)
    sync.apply_batch(batches[2], 2)
    sync.table("shop", "orders").fold(mark=0, every=True)
    for chunk in (chunks[3], chunks[2], chunks[0]):
        handover.merge(chunk)
    handover.finish()
    return sync.table("shop", "orders").read()
