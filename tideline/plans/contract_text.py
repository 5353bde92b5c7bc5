"""Contract queries over texts, records, routes and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from tideline.functions import documents, text, types
from tideline.operators import automaton, joins, routing, running
from tideline.plans.registry import query, table


@query("map_increment", "SELECT event_id, user_id, user_id + 1 AS next_id FROM events")
def map_increment(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", text.increment("user_id").alias("next_id"))


@query("map_prefix", "SELECT o_orderkey, 'processed:' || o_orderpriority AS message FROM orders")
def map_prefix(spark, d):
    return table(spark, d, "orders").select("o_orderkey", text.prefix_values("o_orderpriority").alias("message"))


def _documents(spark, d):
    return table(spark, d, "documents").select("doc_id", "text")


_WORDS = "SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents"


@query("tokenize", f"SELECT doc_id, word FROM ({_WORDS}) WHERE word <> ''")
def tokenize(spark, d):
    return text.tokenize(_documents(spark, d), "text", " ")


@query("word_count", f"SELECT word, count(*) AS n FROM ({_WORDS}) WHERE word <> '' GROUP BY word")
def word_count(spark, d):
    words = text.tokenize(_documents(spark, d), "text", " ")
    return running.count_by(words, ["word"])


@query(
    "lateral_split",
    """SELECT p_partkey, p_name, word
       FROM (SELECT p_partkey, p_name, unnest(string_split(p_name, ' ')) AS word FROM part)""",
)
def lateral_split(spark, d):
    text.register_split_table(spark)
    part = table(spark, d, "part")
    return spark.sql("SELECT p_partkey, p_name, word FROM {part}, LATERAL split_table(p_name, ' ')", part=part)


@query(
    "record_to_json",
    """
    SELECT event_id, '{"topic":"events","key":"' || user_id || '","value":"' || event_type || '","timestamp":'
           || epoch_us(ts) // 1000 || '}' AS json FROM events
    """,
)
def record_to_json(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        F.lit("events").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        F.col("event_type").alias("value"),
        F.unix_millis("ts").alias("timestamp"),
    )
    shown = rows.where(F.col("value").isNotNull())
    return shown.select("event_id", text.record_to_json("topic", "key", "value", "timestamp").alias("json"))


@query(
    "index_requests",
    "SELECT event_id, 'Index: events, ID: null, Source: ' || props AS request FROM events",
)
def index_requests(spark, d):
    rows = table(spark, d, "events").select("event_id", "props")
    return text.build_index_requests(rows, "props", "events").select("event_id", "request")


@query(
    "label_message",
    "SELECT o_orderkey, 'order ' || o_orderkey || ' (' || o_orderstatus || ')' AS message FROM orders",
)
def label_message(spark, d):
    message = text.label_message("order %d (%s)", "o_orderkey", "o_orderstatus")
    return table(spark, d, "orders").select("o_orderkey", message.alias("message"))


@query("project_const", "SELECT c_custkey, c_name, c_mktsegment, 'c' AS op FROM customer")
def project_const(spark, d):
    return text.project_constant(table(spark, d, "customer"), ["c_custkey", "c_name", "c_mktsegment"])


def _routed(spark, d):
    rows = table(spark, d, "events").select("event_id", "event_type", "value")
    return routing.route(rows, {"errors": F.col("event_type") == "error", "large": F.col("value") > 100})


@query(
    "route_side",
    """
    SELECT event_id, event_type, value, CASE WHEN event_type = 'error' THEN 'errors' ELSE 'large' END AS tag
    FROM events WHERE event_type = 'error' OR value > 100
    """,
)
def route_side(spark, d):
    return _routed(spark, d).where(F.col("tag") != routing.MAIN)


@query(
    "route_main",
    """SELECT event_id, event_type, value, 'main' AS tag FROM events
       WHERE event_type <> 'error' AND NOT coalesce(value > 100, false)""",
)
def route_main(spark, d):
    return _routed(spark, d).where(F.col("tag") == routing.MAIN)


# Every customer as a CSV line; some lines are made bad in ways the validation must tell apart.
_LINES = """
    SELECT c_custkey, CASE c_custkey % 10
        WHEN 1 THEN c_name
        WHEN 2 THEN 'x' || c_custkey || ',' || c_name || ',' || c_mktsegment
        WHEN 3 THEN c_custkey || ',,' || c_mktsegment
        WHEN 4 THEN c_custkey || ',' || c_name || ',' || c_mktsegment || ',,'
        WHEN 5 THEN (3000000000 + c_custkey) || ',' || c_name || ',' || c_mktsegment
        WHEN 6 THEN ' ' || c_custkey || ',' || c_name || ',' || c_mktsegment
        WHEN 7 THEN ',,'
        ELSE c_custkey || ',' || c_name || ',' || c_mktsegment END AS line FROM {customer}
"""


def _validated(spark, d):
    return routing.validate_csv(spark.sql(_LINES, customer=table(spark, d, "customer")), "line")


@query(
    "dlq_valid",
    f"""SELECT c_custkey, 'VALID: ' || line AS message FROM ({_LINES.format(customer='customer')})
        WHERE c_custkey % 10 IN (0, 4, 8, 9)""",
)
def dlq_valid(spark, d):
    return _validated(spark, d).where("is_valid").select("c_custkey", "message")


@query(
    "dlq_dead",
    f"""
    SELECT c_custkey, 'DLQ: ' || line || ' [ERROR: ' || CASE c_custkey % 10
        WHEN 1 THEN 'Invalid format' WHEN 3 THEN 'Empty fields' WHEN 7 THEN 'Invalid format'
        ELSE 'For input string: "' || string_split(line, ',')[1] || '"' END || ']' AS message
    FROM ({_LINES.format(customer='customer')}) WHERE c_custkey % 10 NOT IN (0, 4, 8, 9)
    """,
)
def dlq_dead(spark, d):
    return _validated(spark, d).where(~F.col("is_valid")).select("c_custkey", "message")


@query(
    "region_partition",
    """
    WITH regions AS (
      SELECT c_custkey, CASE c_nationkey % 6 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east'
                        WHEN 3 THEN 'west' ELSE c_mktsegment END AS region FROM customer),
         hashed AS (
      SELECT c_custkey, region,
             list_reduce(list_transform(string_split(region, ''), lambda c: ascii(c)::BIGINT),
                         lambda h, u: (h * 31 + u) % 4294967296, 0::BIGINT) AS h FROM regions)
    SELECT c_custkey, region, CASE region WHEN 'north' THEN 0 WHEN 'south' THEN 1 WHEN 'east' THEN 2 WHEN 'west' THEN 3
           ELSE abs((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 4) END AS partition FROM hashed
    """,
)
def region_partition(spark, d):
    side = F.create_map(*[F.lit(x) for x in (0, "north", 1, "south", 2, "east", 3, "west")])
    region = F.coalesce(F.element_at(side, F.col("c_nationkey") % 6), F.col("c_mktsegment"))
    return table(spark, d, "customer").select(
        "c_custkey",
        region.alias("region"),
        routing.region_partition(region, 4).cast("long").alias("partition"),
    )


_RULE_UPDATES = [
    (1, "rule_1", "license"),
    (2, "rule_2", "gnu"),
    (3, "rule_3", "the"),
    (4, "rule_1", "mit license"),
    (5, "rule_4", "@"),
]


@query(
    "rule_match",
    """
    WITH updates(seq, rule_id, pattern) AS (VALUES (1, 'rule_1', 'license'), (2, 'rule_2', 'gnu'),
           (3, 'rule_3', 'the'), (4, 'rule_1', 'mit license'), (5, 'rule_4', '@')),
         rules AS (SELECT rule_id, arg_max(pattern, seq) AS pattern FROM updates GROUP BY rule_id)
    SELECT doc_id, rule_id, pattern FROM documents JOIN rules ON contains(lower(text), pattern)
    """,
)
def rule_match(spark, d):
    updates = spark.createDataFrame(_RULE_UPDATES, "seq int, rule_id string, pattern string")
    docs = _documents(spark, d)
    return joins.match_rules(docs, joins.latest_rules(updates), "text").drop("text")


@query(
    "rule_match_large",
    """
    SELECT doc_id, item_id AS rule_id, lower(b.text) AS pattern
    FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))
    """,
)
def rule_match_large(spark, d):
    rules = table(spark, d, "benchmark").select(
        F.col("item_id").alias("rule_id"), F.lower("text").alias("pattern")
    )
    docs = _documents(spark, d)
    return joins.match_rules(docs, rules, "text", max_inline=0).drop("text")


@query(
    "rule_scan",
    """
    SELECT doc_id, item_id AS rule_id, lower(b.text) AS pattern
    FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))
    """,
)
def rule_scan(spark, d):
    rules = table(spark, d, "benchmark").select(F.col("item_id").alias("rule_id"), F.lower("text").alias("pattern"))
    return automaton.scan_rules(_documents(spark, d), rules, "text").drop("text")


@query(
    "rule_match_as_of",
    """
    WITH updates AS (SELECT item_id AS seq, 'rule_' || item_id % 37 AS rule_id, lower(text) AS pattern FROM benchmark),
         versions AS (SELECT *, lead(seq) OVER (PARTITION BY rule_id ORDER BY seq) AS until FROM updates)
    SELECT doc_id, rule_id, pattern FROM documents
    JOIN versions ON contains(lower(text), pattern) AND doc_id > seq AND (until IS NULL OR doc_id < until)
    """,
)
def rule_match_as_of(spark, d):
    """Rules from the benchmark texts, updated while the documents arrive."""
    updates = table(spark, d, "benchmark").select(
        F.col("item_id").alias("seq"),
        F.concat(F.lit("rule_"), (F.col("item_id") % 37).cast("string")).alias("rule_id"),
        F.lower("text").alias("pattern"),
    )
    docs = _documents(spark, d).withColumn("seq", F.col("doc_id"))
    return joins.match_rules_as_of(docs, updates, "text").select("doc_id", "rule_id", "pattern")


@query(
    "rule_updates",
    """SELECT item_id, 'Rule updated: ' || item_id || ' -> ' || lower(text) AS message FROM benchmark""",
)
def rule_updates(spark, d):
    rules = table(spark, d, "benchmark").select("item_id", F.lower("text").alias("pattern"))
    return joins.update_messages(rules, "rule", "item_id", "pattern").select("item_id", "message")


@query(
    "normalize_time",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN epoch_us(date_trunc('second', ts)) // 1000 END AS ts,
           CASE WHEN event_id % 3 = 1 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                WHEN event_id % 3 = 2 THEN 'Tick ' || event_type END AS raw
    FROM events
    """,
)
def normalize_time(spark, d):
    shown = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.date_format(_utc("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(F.col("event_id") % 3 == 1, F.date_format(_utc("ts"), "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.concat(F.lit("Tick "), F.col("event_type")))
    )
    out = table(spark, d, "events").select("event_id", types.normalize_time(shown).alias("t"))
    return out.select("event_id", F.unix_millis("t.ts").alias("ts"), F.col("t.raw").alias("raw"))


def _utc(column):
    """The instant as the session zone's wall clock would show it in UTC."""
    return F.to_utc_timestamp(column, F.current_timezone())


# Type names as a source catalog spells them, taken from the part table's columns.
_TYPE_NAMES = """
    SELECT p_partkey, CASE p_size % 10
        WHEN 0 THEN 'varchar' WHEN 1 THEN 'VARCHAR(' || p_size || ')' WHEN 2 THEN 'decimal'
        WHEN 3 THEN 'DECIMAL(18,' || p_size % 7 || ')' WHEN 4 THEN 'smallint' WHEN 5 THEN 'timestamp(3)'
        WHEN 6 THEN 'json' WHEN 7 THEN 'mediumblob' WHEN 8 THEN 'bool' ELSE 'double precision' END AS type
    FROM {part}
"""


@query(
    "type_map",
    f"""
    SELECT p_partkey, type, CASE
        WHEN type = 'varchar' THEN 'varchar(255)' WHEN type = 'decimal' THEN 'DECIMAL(10,2)'
        WHEN type LIKE 'VARCHAR(%' OR type LIKE 'DECIMAL(%' THEN type WHEN type = 'smallint' THEN 'INT'
        WHEN type = 'timestamp(3)' THEN 'TIMESTAMP(6)' WHEN type = 'json' THEN 'VARCHAR(1024)'
        WHEN type = 'mediumblob' THEN 'BLOB' WHEN type = 'bool' THEN 'TINYINT(1)' ELSE 'DOUBLE' END AS mapped_type
    FROM ({_TYPE_NAMES.format(part='part')})
    """,
)
def type_map(spark, d):
    return types.map_types(spark.sql(_TYPE_NAMES, part=table(spark, d, "part")))


@query(
    "flatten_docs",
    """
    SELECT event_id, event_type AS kind, json_extract_string(props, '$.k') AS nested_k, props_text AS nested,
           CAST(user_id AS VARCHAR) AS user_id_text, NULL::VARCHAR AS nested_missing,
           event_type AS deep_a_b_c_d, CAST(user_id AS VARCHAR) AS deep_a_n_x_y
    FROM (SELECT *, '{"k":' || json_extract_string(props, '$.k') || '}' AS props_text FROM events WHERE event_id % 10 <> 0)
    UNION ALL SELECT event_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL FROM events WHERE event_id % 10 = 0
    """,
)
def flatten_docs(spark, d):
    rows = table(spark, d, "events").select(
        "event_id",
        F.concat(
            F.lit('{"kind":"'), "event_type", F.lit('","user_id_text":'), F.col("user_id").cast("string"),
            F.lit(',"nested":'), "props", F.lit(',"deep":{"a":{"b":{"c":{"d":"'), "event_type", F.lit('"}},"n":'),
            F.col("user_id").cast("string"), F.lit("}}}"),
        ).alias("document"),
    )
    # Every tenth document is cut off.
    cut = F.when(F.col("event_id") % 10 == 0, F.expr("left(document, length(document) - 1)")).otherwise(F.col("document"))
    wanted = ["kind", "nested.k", "nested", "user_id_text", "nested.missing", "deep.a.b.c.d", "deep.a.n.x.y"]
    return documents.flatten_documents(rows.withColumn("document", cut), "document", wanted, depth=5).drop("document")


@query("flatten_docs_bad", "SELECT event_id FROM events WHERE event_id % 10 = 0")
def flatten_docs_bad(spark, d):
    """The documents that are no JSON, as a sync sets them aside."""
    rows = table(spark, d, "events").select("event_id", F.concat(F.lit('{"a":'), "props", F.lit("}")).alias("document"))
    cut = F.when(F.col("event_id") % 10 == 0, F.expr("left(document, length(document) - 1)")).otherwise(F.col("document"))
    return documents.malformed_documents(rows.withColumn("document", cut), "document").select("event_id")


@query(
    "doc_changes",
    """
    SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'accounts' ELSE 'carts' END AS _collection,
           CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' ELSE 'u' END AS _op,
           CASE WHEN event_type = 'click' THEN '{"_id":' || user_id || ',"at":{"ms":' || epoch_us(ts) // 1000 || '}}'
                ELSE '{"_id":' || user_id || ',"kind":"' || event_type || '","at":{"ms":' || epoch_us(ts) // 1000 || '}}' END
           AS document
    FROM events WHERE event_type <> 'error'
    """,
)
def doc_changes(spark, d):
    rows = table(spark, d, "events")
    collection = F.when(F.col("user_id") % 2 == 0, F.lit("shop.app.accounts")).otherwise(F.lit("shop.app.carts"))
    op = (
        F.when(F.col("event_type") == "signup", "c")
        .when(F.col("event_type") == "view", "r")
        .when(F.col("event_type") == "error", "d")
        .otherwise("u")
    )
    # Clicks have a null field, which a document leaves out.
    image = F.struct(
        F.col("user_id").alias("_id"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"),
        F.struct(F.unix_millis("ts").alias("ms")).alias("at"),
    )
    document = documents.struct_to_document(image)
    changes = rows.select(
        "event_id",
        collection.alias("topic"),
        op.alias("op"),
        F.when(op == "d", document).alias("before"),
        F.when(op != "d", document).alias("after"),
    )
    return documents.decode_document_changes(changes)

