"""Contract queries that run envelopes through the whole-database synchronisation and read its tables back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tideline.functions.documents import read_document_changes
from tideline.plans.document_sync import Collection, DocumentSync
from tideline.plans.keyed_table import KeyedTable
from tideline.plans.registry import query, table
from tideline.plans.sync import DatabaseSync
from tideline.sinks.jdbc import map_column_types
from tideline.session import shared_dir


def _sync(spark, **options) -> DatabaseSync:
    return DatabaseSync(spark, f"{shared_dir(spark)}/sync-{uuid.uuid4().hex}", **options)


def _envelope(name, op, image, fields=None):
    """A change as text; with ``fields`` (name, type, semantic name, parameters) wrapped in its own schema."""
    payload = F.struct(op.alias("op"), F.struct(F.lit("shop").alias("db"), name.alias("table")).alias("source"), image.alias("after"))
    if fields is None:
        return F.to_json(payload)
    listed = [
        F.struct(
            F.lit(f).alias("field"),
            F.lit(t).alias("type"),
            F.lit(n).cast("string").alias("name"),
            F.create_map(*[F.lit(x) for kv in (p or {"version": "1"}).items() for x in kv]).alias("parameters"),
        )
        for f, t, n, p in fields
    ]
    schema = F.struct(F.array(F.struct(F.lit("after").alias("field"), F.array(*listed).alias("fields"))).alias("fields"))
    return F.to_json(F.struct(schema.alias("schema"), payload.alias("payload")))


@query(
    "cdc_typed_decode",
    """
    WITH o AS (SELECT *, CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS d FROM orders)
    SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS price,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, (d * 86400000 + o_orderkey % 1000) * 1000 AS ms,
           d * 86400000000 + o_orderkey AS us, d * 86400000000 + o_orderkey AS ns, d * 86400000000 AS zoned,
           o_orderkey % 2 = 0 AS even, '-' || o_orderkey || '.07' AS exact
    FROM o
    """,
)
def cdc_typed_decode(spark, d):
    """Orders as wrapped records whose schema declares dates, times and decimals in their encoded forms."""
    days = F.datediff(F.col("o_orderdate").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    # The unscaled number -(key * 100 + 7) as eight bytes in base64.
    unscaled = F.base64(F.unhex(F.lpad(F.hex(-(F.col("o_orderkey") * 100 + 7)), 16, "0")))
    image = F.struct(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(15,2)").cast("string").alias("price"),
        days.alias("day"),
        (days * 86_400_000 + F.col("o_orderkey") % 1000).alias("ms"),
        (days * 86_400_000_000 + F.col("o_orderkey")).alias("us"),
        ((days * 86_400_000_000 + F.col("o_orderkey")) * 1000).alias("ns"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'").alias("zoned"),
        (F.col("o_orderkey") % 2 == 0).alias("even"),
        unscaled.alias("exact"),
    )
    decimal = "org.apache.kafka.connect.data.Decimal"
    fields = [
        ("o_orderkey", "int64", None, None),
        ("o_custkey", "int64", None, None),
        ("o_orderstatus", "string", None, None),
        ("price", "bytes", decimal, {"scale": "2", "connect.decimal.precision": "15"}),
        ("day", "int32", "io.debezium.time.Date", None),
        ("ms", "int64", "io.debezium.time.Timestamp", None),
        ("us", "int64", "io.debezium.time.MicroTimestamp", None),
        ("ns", "int64", "io.debezium.time.NanoTimestamp", None),
        ("zoned", "string", "io.debezium.time.ZonedTimestamp", None),
        ("even", "boolean", None, None),
        ("exact", "bytes", decimal, {"scale": "2", "connect.decimal.precision": "20"}),
    ]
    log = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("seq"),
        _envelope(F.lit("orders"), F.lit("c"), image, fields).alias("value"),
        F.array(F.lit("o_orderkey")).alias("key"),
    )
    sync = _sync(spark)
    sync.apply_batch(log, 0)
    got = sync.table("shop", "orders").read()
    text = {c: F.col(c).cast("string") for c in ("price", "day", "exact")}
    return got.withColumns(text | {c: F.unix_micros(c) for c in ("ms", "us", "ns", "zoned")})


@query(
    "cdc_type_widening",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(user_id AS DECIMAL(38,10)) ELSE CAST(value AS DECIMAL(38,10)) END AS amount,
           CASE WHEN event_id % 5 = 0 THEN CAST(user_id AS VARCHAR) ELSE event_type END AS mixed
    FROM events
    """,
)
def cdc_type_widening(spark, d):
    """Whole numbers first and decimals later, numbers and words in one field: nothing is lost or rounded."""
    events = table(spark, d, "events")
    number = F.when(F.col("event_id") % 3 == 0, F.to_json(F.struct(F.col("user_id").alias("v"))))
    number = F.regexp_extract(F.coalesce(number, F.to_json(F.struct(F.col("value").alias("v")))), r":(.*)\}", 1)
    mixed = F.when(F.col("event_id") % 5 == 0, F.col("user_id").cast("string")).otherwise(
        F.concat(F.lit('"'), "event_type", F.lit('"'))
    )
    value = F.concat(
        F.lit('{"op":"c","source":{"db":"shop","table":"wide"},"after":{"event_id":'), F.col("event_id").cast("string"),
        F.lit(',"amount":'), number, F.lit(',"mixed":'), mixed, F.lit("}}"),
    )
    log = events.select(F.col("event_id").alias("seq"), value.alias("value"), F.array(F.lit("event_id")).alias("key"))
    sync = _sync(spark)
    sync.apply_batch(log, 0)
    return sync.table("shop", "wide").read()


@query(
    "cdc_sync_quarantine",
    """
    WITH e AS (SELECT event_id % 20 AS k FROM events)
    SELECT outcome, n FROM (
        SELECT CASE k WHEN 0 THEN 'no key' WHEN 1 THEN 'invalid name' WHEN 2 THEN 'does not fit: amount' WHEN 3 THEN 'no source'
                      WHEN 4 THEN 'unknown op' WHEN 5 THEN 'no schema' ELSE 'applied' END AS outcome, count(*) AS n
        FROM e GROUP BY ALL
        UNION ALL SELECT 'superseded', count(*) FROM e WHERE k > 5
        UNION ALL SELECT 'input', count(*) + count(*) FILTER (k > 5) FROM e)
    """,
)
def cdc_sync_quarantine(spark, d):
    """Every record of a batch is applied, superseded by a later one of its key, or set aside with its reason."""
    events = table(spark, d, "events").withColumn("k", F.col("event_id") % 20)
    name = F.when(F.col("k") == 1, "odd-name").when(F.col("k") == 5, "gone").otherwise("t")
    amount = F.when(F.col("k") == 2, F.lit("not a number")).otherwise(F.col("user_id").cast("string"))
    image = F.struct(F.when(F.col("k") != 0, F.col("event_id")).alias("id"), amount.alias("amount"))
    fields = [("id", "int64", None, None), ("amount", "int64", None, None)]
    whole = _envelope(name, F.when(F.col("k") == 4, "x").otherwise("c"), image, fields)
    first = events.select(
        (F.col("event_id") * 2 + 10).alias("seq"),
        F.when(F.col("k") == 3, F.lit("{cut off")).otherwise(whole).alias("value"),
        F.array(F.lit("id")).alias("key"),
    )
    again = events.where("k > 5").select(
        (F.col("event_id") * 2 + 11).alias("seq"),
        _envelope(F.lit("t"), F.lit("u"), image, fields).alias("value"),
        F.array(F.lit("id")).alias("key"),
    )
    # The table `gone` is dropped before its rows come, and never created again.
    drop = spark.sql(
        """SELECT 1L AS seq, '{"source":{"db":"shop","table":"gone"},"tableChanges":[{"type":"DROP"}]}' AS value,
                  CAST(NULL AS ARRAY<STRING>) AS key"""
    )
    log = first.unionByName(again)
    sync = _sync(spark)
    sync.apply_batch(log.unionByName(drop), 0)
    counts = spark.read.parquet(f"{sync.root}/_quarantine").groupBy(F.col("reason").alias("outcome")).agg(F.count("*").alias("n"))
    total = F.count("*").alias("n")
    applied = sync.table("shop", "t").read().select(F.lit("applied").alias("outcome")).groupBy("outcome").agg(total)
    came = log.select(F.lit("input").alias("outcome")).groupBy("outcome").agg(total)
    known = counts.unionByName(applied)
    signed = came.select("n").unionByName(known.select((-F.col("n")).alias("n")))
    rest = signed.agg(F.sum("n").alias("n")).select(F.lit("superseded").alias("outcome"), "n")
    return known.unionByName(came).unionByName(rest)


def _wrapped(rows, image, fields):
    return rows.select(
        F.col("o_orderkey").alias("seq"), _envelope(F.lit("drift"), F.lit("c"), image, fields).alias("value"), F.array(F.lit("id")).alias("key")
    )


@query(
    "cdc_drift",
    """
    SELECT o_orderkey AS id, CASE o_orderkey % 3 WHEN 1 THEN 10000000000 + o_custkey ELSE o_custkey END AS cust,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus END AS status, CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice END AS price,
           CASE WHEN o_orderkey % 3 = 2 THEN 'n' || o_orderkey END AS note, 'stored' AS outcome
    FROM orders WHERE o_orderkey % 3 < 2 OR (o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0)
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, NULL, CASE WHEN o_orderkey % 7 = 0 THEN 'does not fit: cust' END
           || CASE WHEN o_orderkey % 11 = 0 THEN '; unknown field: odd name' ELSE '' END
    FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey % 7 = 0
    UNION ALL
    SELECT o_orderkey, NULL, NULL, NULL, NULL, 'unknown field: odd name'
    FROM orders WHERE o_orderkey % 3 = 2 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0
    """,
)
def cdc_drift(spark, d):
    """A table whose records change without schema records: fields come and go, a type widens; nothing is lost."""
    orders = table(spark, d, "orders")
    parts = [orders.where(F.col("o_orderkey") % 3 == n) for n in range(3)]
    key, cust = F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("cust")
    number = ("id", "int64", None, None)
    first = F.struct(key, cust, F.col("o_orderstatus").alias("status"))
    first = _wrapped(parts[0], first, [number, ("cust", "int32", None, None), ("status", "string", None, None)])
    second = F.struct(key, (F.col("o_custkey") + 10_000_000_000).alias("cust"), F.col("o_totalprice").alias("price"))
    second = _wrapped(parts[1], second, [number, ("cust", "int64", None, None), ("price", "float64", None, None)])
    bare = F.struct(
        key,
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("many")).otherwise(F.col("o_custkey").cast("string")).alias("cust"),
        F.concat(F.lit("n"), F.col("o_orderkey").cast("string")).alias("note"),
        F.when(F.col("o_orderkey") % 11 == 0, F.lit("?")).alias("odd name"),
    )
    sync = _sync(spark)
    for n, log in enumerate((first, second, _wrapped(parts[2], bare, None))):
        sync.apply_batch(log, n)
    stored = sync.table("shop", "drift").read().withColumn("outcome", F.lit("stored"))
    bad = spark.read.parquet(f"{sync.root}/_quarantine").select(F.col("seq").alias("id"), F.col("reason").alias("outcome"))
    return stored.unionByName(bad, allowMissingColumns=True)


@query(
    "doc_sync",
    """
    WITH o AS (SELECT o_orderkey % 20 AS k FROM orders)
    SELECT outcome, n FROM (
        SELECT CASE k WHEN 0 THEN 'no JSON object' WHEN 1 THEN 'no key' WHEN 2 THEN 'does not fit: n' WHEN 3 THEN 'unknown op'
                      WHEN 4 THEN 'no document' WHEN 5 THEN 'no op' ELSE 'applied' END AS outcome, count(*) AS n FROM o WHERE k <> 7 GROUP BY ALL
        UNION ALL SELECT 'superseded', count(*) FILTER (k > 6) FROM o
        UNION ALL SELECT 'deleted', count(*) FILTER (k = 7) FROM o
        UNION ALL SELECT 'input', count(*) + count(*) FILTER (k > 6) FROM o)
    """,
)
def doc_sync(spark, d):
    """Every document record is applied, superseded, a delete, or set aside with its reason."""
    k = F.col("o_orderkey") % 20
    number = F.when(k == 2, F.lit("2.5")).otherwise(F.col("o_custkey").cast("string"))
    identity = F.when(k == 1, F.lit("")).otherwise(F.concat(F.lit('"_id":"'), F.col("o_orderkey").cast("string"), F.lit('",')))
    document = F.concat(F.lit("{"), identity, F.lit('"n":'), number, F.lit(',"at":{"s":"'), F.col("o_orderstatus"), F.lit('"}}'))
    document = F.when(k == 0, F.substring(document, 1, 12)).when(k != 4, document)
    op = F.when(k == 3, F.lit("x")).when(k != 5, F.lit("c")).alias("op")
    orders = table(spark, d, "orders")
    topic = F.lit("s.app.orders").alias("topic")

    def record(op, before, after):
        return F.to_json(F.struct(op, before.alias("before"), after.alias("after"))).alias("value")

    none = F.lit(None).cast("string")
    first = orders.select((F.col("o_orderkey") * 2).alias("seq"), topic, record(op, none, document))
    again = orders.where(k > 6).select(
        (F.col("o_orderkey") * 2 + 1).alias("seq"),
        topic,
        record(F.when(k == 7, "d").otherwise("u").alias("op"), F.when(k == 7, document), F.when(k != 7, document)),
    )
    log = first.unionByName(again)
    fields = (("_id", "STRING"), ("n", "BIGINT"), ("at.s", "STRING"))
    sync = DocumentSync(spark, f"{shared_dir(spark)}/docs-{uuid.uuid4().hex}", [Collection("orders", fields)], apply_deletes=True)
    sync.apply_batch(read_document_changes(log), 0)
    total = F.count("*").alias("n")
    bad = spark.read.parquet(f"{sync.root}/_quarantine").groupBy(F.col("reason").alias("outcome")).agg(total)
    applied = KeyedTable.load(spark, sync.path("orders")).read().agg(total).select(F.lit("applied").alias("outcome"), "n")
    deleted = again.where(F.get_json_object("value", "$.op") == "d").agg(total).select(F.lit("deleted").alias("outcome"), "n")
    came = log.agg(total).select(F.lit("input").alias("outcome"), "n")
    known = bad.unionByName(applied).unionByName(deleted)
    rest = came.select("n").unionByName(known.select((-F.col("n")).alias("n"))).agg(F.sum("n").alias("n"))
    return known.unionByName(came).unionByName(rest.select(F.lit("superseded").alias("outcome"), "n"))


@query(
    "create_target",
    """
    SELECT * FROM (VALUES ('accounts'), ('carts'), ('visits')) t("table"), (VALUES
        ('user_id', 1, 'BIGINT', true), ('event_type', 2, 'VARCHAR(1024)', false), ('value', 3, 'DOUBLE', false), ('k', 4, 'INT', false)
    ) c("column", ordinal, target_type, is_key)
    WHERE "table" IN (SELECT CASE user_id % 3 WHEN 0 THEN 'accounts' WHEN 1 THEN 'carts' ELSE 'visits' END FROM events)
    """,
)
def create_target(spark, d):
    """The tables that the first records of the event log create, as the catalog of a relational target would list them."""
    events = table(spark, d, "events")
    name = F.expr("CASE user_id % 3 WHEN 0 THEN 'accounts' WHEN 1 THEN 'carts' ELSE 'visits' END")
    image = F.struct("user_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    fields = [("user_id", "int64", None, None), ("event_type", "string", None, None), ("value", "float64", None, None), ("k", "int32", None, None)]
    log = events.select(F.col("event_id").alias("seq"), _envelope(name, F.lit("c"), image, fields).alias("value"), F.array(F.lit("user_id")).alias("key"))
    sync = _sync(spark)
    sync.apply_batch(log, 0)
    rows = []
    for t in ("accounts", "carts", "visits"):
        made = sync.table("shop", t)
        for n, (column, kind) in enumerate(map_column_types(spark, made.column_types) if made else []):
            rows.append((t, column, n + 1, kind, column in made.key))
    return spark.createDataFrame(rows, "table string, column string, ordinal int, target_type string, is_key boolean")
