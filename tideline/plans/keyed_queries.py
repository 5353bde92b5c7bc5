"""Contract queries over written keyed tables: schema evolution on orders.

Each writes the orders as a table, changes its schema, merges a derived change
set and reads the table back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.operators.changelog import compact_changes
from tideline.plans.keyed_table import KeyedTable
from tideline.plans.registry import cents, query, table
from tideline.session import shared_dir

COLUMNS = [
    ("o_orderkey", "BIGINT"),
    ("o_custkey", "BIGINT"),
    ("o_orderstatus", "VARCHAR(1)"),
    ("o_totalprice", "DOUBLE"),
]
CHANGED = "o_orderkey % 7 = 0"
DELETED = "o_orderkey % 21 = 0"


def _orders_table(spark, d):
    path = f"{shared_dir(spark)}/orders-{uuid.uuid4().hex}"
    keyed = KeyedTable.create(spark, path, COLUMNS, ["o_orderkey"])
    orders = table(spark, d, "orders").select(*[name for name, _ in COLUMNS])
    keyed.load_snapshot(orders)
    kind = F.when(F.expr(DELETED), "delete").otherwise("update")
    changes = orders.where(CHANGED).withColumns({"seq": F.col("o_orderkey") + 1, "kind": kind})
    return keyed, changes


@query(
    "evolve_add",
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN {CHANGED} THEN 'note ' || o_custkey END AS note FROM orders WHERE NOT {DELETED}
    """,
)
def evolve_add(spark, d):
    keyed, changes = _orders_table(spark, d)
    keyed.evolve(lambda s: s.add("note", "VARCHAR(100)"))
    keyed.merge(changes.withColumn("note", F.concat(F.lit("note "), F.col("o_custkey").cast("string"))), 0)
    return keyed.read()


@query(
    "evolve_drop",
    f"""
    SELECT o_orderkey, o_custkey, CASE WHEN {CHANGED} THEN 'again' END AS o_orderstatus
    FROM orders WHERE NOT {DELETED}
    """,
)
def evolve_drop(spark, d):
    """Drops two columns and adds one of them again: its old values stay gone."""
    keyed, changes = _orders_table(spark, d)
    keyed.evolve(lambda s: (s.drop("o_totalprice"), s.drop("o_orderstatus"), s.add("o_orderstatus", "VARCHAR(9)")))
    keyed.merge(changes.withColumn("o_orderstatus", F.lit("again")), 0)
    return keyed.read()


@query(
    "evolve_type",
    f"""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
           CAST(CASE WHEN {CHANGED} THEN 1 ELSE round(o_totalprice, 2) END AS DECIMAL(18,2)) AS o_totalprice
    FROM orders WHERE NOT {DELETED}
    """,
)
def evolve_type(spark, d):
    keyed, changes = _orders_table(spark, d)
    keyed.evolve(lambda s: (s.retype("o_totalprice", "DECIMAL(18,2)"), s.retype("o_custkey", "VARCHAR(20)")))
    keyed.merge(changes.withColumn("o_totalprice", F.lit(1)), 0)
    return keyed.read()


@query(
    "evolve_rename",
    f"""
    SELECT o_orderkey, o_custkey AS customer, o_orderstatus,
           CASE WHEN {CHANGED} THEN 0 ELSE o_totalprice END AS price FROM orders WHERE NOT {DELETED}
    """,
)
def evolve_rename(spark, d):
    keyed, changes = _orders_table(spark, d)
    keyed.evolve(lambda s: (s.rename("o_custkey", "customer"), s.rename("o_totalprice", "price")))
    renamed = changes.withColumnsRenamed({"o_custkey": "customer", "o_totalprice": "price"})
    keyed.merge(renamed.withColumn("price", F.lit(0.0)), 0)
    return keyed.read()


@query(
    "keyed_merge",
    f"""
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderkey % 14 = 0 THEN -1 WHEN {CHANGED} THEN 5 ELSE o_totalprice END AS o_totalprice
    FROM orders WHERE NOT {DELETED}
    """,
)
def keyed_merge(spark, d):
    """Two change sets, one of them replayed, with a fold in between."""
    keyed, changes = _orders_table(spark, d)
    first = changes.withColumn("o_totalprice", F.lit(5.0))
    keyed.merge(first, 0)
    keyed.fold()
    keyed.merge(first.withColumn("o_totalprice", F.lit(99.0)), 0)
    second = changes.where("o_orderkey % 14 = 0").withColumn("o_totalprice", F.lit(-1.0))
    keyed.merge(second.withColumn("seq", F.col("seq") + 1_000_000_000), 1)
    return keyed.read()


@query(
    "late_merge",
    """
    SELECT user_id, event_type, value, event_id AS seq FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND event_type <> 'error'
    """,
)
def late_merge(spark, d):
    """The events as change sets in an order of their own, folded now and then: the highest sequence counts."""
    columns = [("user_id", "BIGINT"), ("event_type", "STRING"), ("value", "DOUBLE")]
    keyed = KeyedTable.create(spark, f"{shared_dir(spark)}/late-{uuid.uuid4().hex}", columns, ["user_id"])
    kind = F.when(F.col("event_type") == "error", "delete").otherwise("update").alias("kind")
    log = table(spark, d, "events").select(F.col("event_id").alias("seq"), "user_id", "event_type", "value", kind)
    for n, part in enumerate((3, 0, 2, 4, 1)):
        keyed.merge(compact_changes(log.where(F.pmod(F.xxhash64("seq"), F.lit(5)) == part), ["user_id"]), n)
        if n in (1, 3):
            keyed.fold(every=n == 3)
    return keyed.read(with_seq=True).withColumnRenamed("_seq", "seq")


@query(
    "lake_upsert",
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, coalesce(total, o_totalprice) AS o_totalprice
    FROM orders LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY l_orderkey)
      ON o_orderkey = l_orderkey
    """,
)
def lake_upsert(spark, d):
    """Orders as a written table, then a price update per order from the sum of its items."""
    keyed = KeyedTable.create(spark, f"{shared_dir(spark)}/lake-{uuid.uuid4().hex}", COLUMNS, ["o_orderkey"])
    base = table(spark, d, "orders").select(*[name for name, _ in COLUMNS])
    keyed.load_snapshot(base)
    sums = table(spark, d, "lineitem").groupBy("l_orderkey").agg(cents(F.sum("l_extendedprice")).alias("o_totalprice"))
    updates = base.drop("o_totalprice").join(sums, F.col("o_orderkey") == F.col("l_orderkey")).drop("l_orderkey")
    keyed.merge(updates.withColumns({"seq": F.lit(1).cast("long"), "kind": F.lit("update")}), 0)
    return keyed.read()
