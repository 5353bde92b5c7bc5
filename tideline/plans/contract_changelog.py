"""Contract queries over a change log derived from ``events``.

Every event is one change of its user's row: signups create, views are snapshot
reads, clicks and purchases update, errors delete. ``event_id`` is the sequence.
Users are spread over three tables, so a key lives in one table only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.operators import changelog, reconcile
from tideline.plans import handover_queries, keyed_queries, sync_queries  # noqa: F401  (they register their queries)
from tideline.plans.keyed_table import KeyedTable
from tideline.plans.registry import cents, query, table
from tideline.session import shared_dir

OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"
TABLE = "CASE user_id % 3 WHEN 0 THEN 'accounts' WHEN 1 THEN 'carts' ELSE 'visits' END"
_CL = f"(SELECT *, {OP} AS op, {TABLE} AS tbl FROM events)"


def change_log(spark, d, where=None):
    """Typed changes with their row images as columns."""
    return table(spark, d, "events", where).select(
        F.col("event_id").alias("seq"),
        F.lit("shop").alias("db"),
        F.expr(TABLE).alias("table"),
        F.expr(OP).alias("op"),
        changelog.kind_of(F.expr(OP)).alias("kind"),
        "user_id",
        "event_type",
        "value",
        F.unix_millis("ts").alias("changed_at"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def envelopes(spark, d):
    """The same log as envelope text, as a message topic carries it."""
    log = change_log(spark, d)
    image = F.struct("user_id", "event_type", "value", "k")
    deleted = F.col("op") == "d"
    envelope = F.struct(
        "op",
        F.struct("db", "table").alias("source"),
        F.when(deleted, image).alias("before"),
        F.when(~deleted, image).alias("after"),
    )
    return log.select("seq", F.to_json(envelope).alias("value"))


@query(
    "cdc_decode",
    f"""
    SELECT 'shop' AS db, tbl AS "table", CASE op WHEN 'c' THEN 'insert' WHEN 'r' THEN 'insert' WHEN 'u' THEN 'update'
           ELSE 'delete' END AS kind, count(*) AS n FROM {_CL} GROUP BY ALL
    """,
)
def cdc_decode(spark, d):
    decoded = changelog.usable(changelog.decode_changes(envelopes(spark, d)))
    return decoded.groupBy("db", "table", "kind").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cdc_compact",
    f"""
    SELECT tbl AS "table", user_id, event_id AS seq, op, event_type, value FROM {_CL}
    QUALIFY row_number() OVER (PARTITION BY tbl, user_id ORDER BY event_id DESC) = 1
    """,
)
def cdc_compact(spark, d):
    log = change_log(spark, d).select("table", "user_id", "seq", "op", "event_type", "value")
    return changelog.compact_changes(log, ["table", "user_id"])


@query(
    "cdc_apply",
    f"""
    SELECT user_id, event_type, value, event_id AS seq FROM {_CL}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND op <> 'd'
    """,
)
def cdc_apply(spark, d):
    """The first half of the month builds the table, the second half is applied to it."""
    wanted = ["user_id", "event_type", "value", "seq", "kind"]
    middle = "TIMESTAMP_NTZ'2024-01-15 00:00:00'"
    before, since = (change_log(spark, d, f"ts {op} {middle}").select(*wanted) for op in ("<", ">="))
    target = changelog.compact_changes(before, ["user_id"]).where(F.col("kind") != "delete").drop("kind")
    net = changelog.compact_changes(since, ["user_id"])
    return changelog.apply_changes(target, net, ["user_id"])


@query(
    "cdc_apply_composite",
    f"""
    SELECT user_id, k, event_type, value FROM (
      SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM {_CL})
    QUALIFY row_number() OVER (PARTITION BY user_id, k ORDER BY event_id DESC) = 1 AND op <> 'd'
    """,
)
def cdc_apply_composite(spark, d):
    """Both halves of the month merged into a written table with a key of two columns."""
    columns = [("user_id", "BIGINT"), ("k", "INT"), ("event_type", "STRING"), ("value", "DOUBLE")]
    target = _written_target(spark, columns, ["user_id", "k"])
    for n, part in enumerate(_halves(spark, d)):
        log = part.select("user_id", "k", "seq", "kind", "event_type", "value")
        target.merge(changelog.compact_changes(log, ["user_id", "k"]), n)
    return target.read()


@query("cdc_apply_nokey", f"SELECT user_id, event_type, value FROM {_CL} WHERE op <> 'd'")
def cdc_apply_nokey(spark, d):
    """The same into a table without a key, which only appends."""
    target = _written_target(spark, [("user_id", "BIGINT"), ("event_type", "STRING"), ("value", "DOUBLE")], [])
    for n, part in enumerate(_halves(spark, d)):
        target.merge(changelog.append_changes(part).select("user_id", "event_type", "value", "seq", "kind"), n)
    return target.read()


def _written_target(spark, columns, key):
    return KeyedTable.create(spark, f"{shared_dir(spark)}/target-{uuid.uuid4().hex}", columns, key)


def _halves(spark, d):
    middle = "TIMESTAMP_NTZ'2024-01-15 00:00:00'"
    return [change_log(spark, d, f"ts {op} {middle}") for op in ("<", ">=")]


@query(
    "cdc_group_count",
    f"""
    SELECT event_type, count(*) AS n FROM (
      SELECT * FROM {_CL} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1 AND op <> 'd')
    GROUP BY event_type
    """,
)
def cdc_group_count(spark, d):
    log = change_log(spark, d).select("user_id", "seq", "kind", "event_type")
    images = changelog.with_before_images(log, ["user_id"], ["event_type"])
    return changelog.group_count(images, ["event_type"])


@query(
    "cdc_split_ops",
    f"""
    SELECT tbl AS "table", CASE WHEN op = 'd' THEN 'delete' ELSE 'upsert' END AS side, count(*) AS n,
           round(sum(value), 2) AS total FROM {_CL} GROUP BY ALL
    """,
)
def cdc_split_ops(spark, d):
    split = changelog.split_by_operation(change_log(spark, d))
    return split.groupBy("table", "side").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("value")).alias("total"))


@query(
    "cdc_filter_tables",
    f"""SELECT event_id AS seq, tbl AS "table", user_id, op FROM {_CL} WHERE tbl IN ('accounts', 'carts')""",
)
def cdc_filter_tables(spark, d):
    kept = changelog.filter_tables(change_log(spark, d), database="shop", table="acc.*|carts")
    return kept.select("seq", "table", "user_id", "op")


@query(
    "cdc_quarantine",
    f"""
    SELECT event_id AS seq, CASE event_id % 11 WHEN 1 THEN 'no value' WHEN 2 THEN 'no source' WHEN 3 THEN 'unknown op'
           WHEN 4 THEN CASE WHEN op = 'd' THEN 'delete without before' ELSE 'no after' END
           ELSE 'no schema' END AS reason
    FROM {_CL} WHERE event_id % 11 IN (1, 2, 3, 4) OR tbl = 'visits'
    """,
)
def cdc_quarantine(spark, d):
    """Some envelopes are made unusable, and one table is missing from the registry."""
    log = envelopes(spark, d)
    fault = F.col("seq") % 11
    bad = (
        F.when(fault == 1, F.lit(None))
        .when(fault == 2, F.regexp_replace("value", '"source":', '"origin":'))
        .when(fault == 3, F.regexp_replace("value", '"op":"[a-z]"', '"op":"x"'))
        .when(fault == 4, F.regexp_replace("value", '"(before|after)":', '"image":'))
        .otherwise(F.col("value"))
    )
    decoded = changelog.decode_changes(log.withColumn("value", bad))
    known = change_log(spark, d).select("db", "table").distinct().where(F.col("table") != "visits")
    return changelog.quarantine(decoded, known).select("seq", "reason")


@query(
    "cdc_to_json",
    f"""
    SELECT event_id AS seq, op <> 'd' AS is_upsert,
           '{{"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || ',"k":'
           || json_extract_string(props, '$.k') || '}}' AS json FROM {_CL}
    """,
)
def cdc_to_json(spark, d):
    decoded = changelog.usable(changelog.decode_changes(envelopes(spark, d)))
    return changelog.changes_as_json(decoded).select("seq", "is_upsert", "json")


@query(
    "cdc_schema_registry",
    f"""
    WITH first AS (SELECT * FROM {_CL} QUALIFY row_number() OVER (PARTITION BY tbl ORDER BY event_id) = 1)
    SELECT 'shop' AS db, tbl AS "table", c.name AS "column", c.ordinal, c.type, c.ordinal = 1 AS is_key,
           event_id AS valid_from_seq
    FROM first, (VALUES ('user_id', 1, 'BIGINT'), ('event_type', 2, 'STRING'), ('value', 3, 'DECIMAL(38,10)'),
                        ('k', 4, 'BIGINT')) AS c(name, ordinal, type)
    """,
)
def cdc_schema_registry(spark, d):
    decoded = changelog.usable(changelog.decode_changes(envelopes(spark, d)))
    keyed = decoded.withColumn("key", F.array(F.lit("user_id")))
    return changelog.infer_table_schemas(keyed, "key")


@query(
    "cdc_schema_diff",
    f"""
    WITH versions AS (SELECT tbl, epoch_us(ts) // 600000000 AS seq, list_sort(list(DISTINCT event_type)) AS cols
                      FROM {_CL} GROUP BY ALL),
         pairs AS (SELECT *, lag(cols) OVER (PARTITION BY tbl ORDER BY seq) AS prev FROM versions),
         diffs AS (SELECT tbl, seq, array_to_string(list_sort(list_filter(prev, lambda c: NOT list_contains(cols, c))), ',') AS dropped,
                          array_to_string(list_sort(list_filter(cols, lambda c: NOT list_contains(prev, c))), ',') AS added
                   FROM pairs WHERE prev IS NOT NULL)
    SELECT tbl AS "table", seq, coalesce(dropped, '') AS dropped, coalesce(added, '') AS added FROM diffs
    WHERE coalesce(dropped, '') <> '' OR coalesce(added, '') <> ''
    """,
)
def cdc_schema_diff(spark, d):
    """Schema records derived from the event types each table saw per ten minutes."""
    rows = table(spark, d, "events")
    names = F.array_sort(F.collect_set("event_type"))
    lists = (
        rows.groupBy(F.expr(TABLE).alias("table"), F.floor(F.unix_micros("ts") / 600_000_000).alias("seq"))
        .agg(names.alias("names"))
        .withColumn("db", F.lit("shop"))
    )
    columns = F.transform("names", lambda n: F.struct(n.alias("name")))
    change = F.struct(F.lit("ALTER").alias("type"), F.struct(columns.alias("columns")).alias("table"))
    records = lists.withColumn("ddl", F.to_json(F.struct(F.array(change).alias("tableChanges"))))
    versions = records.withColumn("columns", changelog.history_columns(F.col("ddl")))
    diff = changelog.detect_schema_changes(versions.select("db", "table", "seq", "columns"))
    return diff.select(
        "table",
        "seq",
        F.array_join(F.array_sort("dropped"), ",").alias("dropped"),
        F.array_join(F.array_sort("added"), ",").alias("added"),
    )


def _replica(spark, d):
    """Orders with derived losses, edits and surplus rows."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    kept = orders.where("o_orderkey % 97 <> 0")
    edited = kept.withColumn("o_totalprice", F.expr("if(o_orderkey % 89 = 0, o_totalprice + 1, o_totalprice)"))
    surplus = orders.where("o_orderkey % 101 = 0").withColumn("o_orderkey", -F.col("o_orderkey") - 1)
    return orders, edited.unionByName(surplus)


@query(
    "reconcile_counts",
    """
    SELECT 'customer' AS "table", count(*) AS source_rows, count(*) AS target_rows, true AS equal FROM customer
    UNION ALL
    SELECT 'orders', n, m, n = m FROM (
      SELECT count(*) AS n, count(*) FILTER (o_orderkey % 97 <> 0) + count(*) FILTER (o_orderkey % 101 = 0) AS m FROM orders)
    """,
)
def reconcile_counts(spark, d):
    customers = table(spark, d, "customer")
    return reconcile.reconcile_counts({"orders": _replica(spark, d), "customer": (customers, customers)})


@query(
    "reconcile_diff",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'missing' ELSE 'different' END AS status
    FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0
    UNION ALL SELECT -o_orderkey - 1, 'extra' FROM orders WHERE o_orderkey % 101 = 0
    """,
)
def reconcile_diff(spark, d):
    source, target = _replica(spark, d)
    return reconcile.reconcile_diff(source, target, ["o_orderkey"])


@query(
    "reconcile_tree",
    """
    SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN 'missing' ELSE 'different' END AS status
    FROM orders WHERE o_orderkey % 97 = 0 OR o_orderkey % 89 = 0
    UNION ALL SELECT -o_orderkey - 1, 'extra' FROM orders WHERE o_orderkey % 101 = 0
    """,
)
def reconcile_tree(spark, d):
    source, target = _replica(spark, d)
    return reconcile.reconcile_tree(source, target, ["o_orderkey"])
