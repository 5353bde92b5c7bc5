"""Stream and record sources.

``format`` is any Spark source. ``kafka`` needs its connector on the class path;
file sources such as ``json`` take the same options without the topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHANGE_FILE = "seq long, value string, key array<string>"


def kafka_options(servers: str, topic: str, starting: str = "earliest", group: str | None = None, **more) -> dict:
    """Reader options of a topic; ``starting`` is ``earliest``, ``latest`` or offsets as JSON."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **more}
    if group:
        options["kafka.group.id"] = group
    return options


def read_kafka_values(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", group: str | None = None, **more
) -> DataFrame:
    """A topic's values as text."""
    options = kafka_options(servers, topic, starting, group, **more)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"))


def key_columns(key: Column) -> Column:
    """The key column names in a record key's JSON text, plain or with its schema."""
    payload = F.coalesce(F.get_json_object(key, "$.payload"), key)
    return F.json_object_keys(payload)


def read_changelog(
    spark: SparkSession,
    source: str | dict,
    *,
    stream: bool = True,
    seq: str | None = None,
    max_files: int = 100,
) -> DataFrame:
    """Change records of a whole database as ``seq, value, key``.

    ``source`` is a folder of JSON lines with these columns, or a dictionary of
    topic options. Records are ordered by the position in the source's own log that
    their envelopes state. ``seq`` is another expression over the topic's columns;
    offsets order the records of one partition only, so with ``offset`` a record of
    any other partition is an error.
    """
    reader = spark.readStream if stream else spark.read
    if isinstance(source, str):
        if stream:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.schema(CHANGE_FILE).json(source)
    return ordered_records(reader.format("kafka").options(**source).load(), seq)


def ordered_records(raw: DataFrame, seq: str | None = None) -> DataFrame:
    """A topic's ``key``, ``value``, ``partition`` and ``offset`` as ``seq, value, key``."""
    value = F.col("value").cast("string")
    if seq is None:
        order = source_position(value)
    elif "offset" in seq:
        several = F.raise_error(F.lit("offsets do not order the records of several partitions"))
        order = F.when(F.col("partition") == 0, F.expr(seq)).otherwise(several.cast("long"))
    else:
        order = F.expr(seq)
    return raw.select(
        order.cast("long").alias("seq"), value.alias("value"), key_columns(F.col("key").cast("string")).alias("key")
    )


def source_position(value: Column) -> Column:
    """The place of a change in its source's log as one number: log file, position and row, or a log sequence number.

    File numbers have 20 bits, positions 32 and rows of one event 11. A record without a place, or with one beyond
    that, has none here either: it cannot be put in order, and the synchronisation sets it aside.
    """
    place = "struct<file: string, pos: long, row: long, lsn: long>"
    read = F.from_json(value, f"source {place}, payload struct<source: {place}>")
    at = F.coalesce(read["source"], read["payload"]["source"])
    number = F.regexp_extract(at["file"], r"(\d+)$", 1).try_cast("long")
    row = F.coalesce(at["row"], F.lit(0))
    fits = (number < 1 << 20) & at["pos"].between(0, (1 << 32) - 1) & row.between(0, (1 << 11) - 1)
    return F.coalesce(F.when(fits, F.shiftleft(number, 43) + F.shiftleft(at["pos"], 11) + row), at["lsn"])


def rate_orders(spark: SparkSession, rows_per_second: int = 10, seed: int = 1) -> DataFrame:
    """Generated orders: an id of eight characters, an amount in [10, 1000] and the event time."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    return orders_of(ticks, seed)


def orders_of(ticks: DataFrame, seed: int = 1) -> DataFrame:
    """The order of each tick (``value``, ``timestamp``)."""
    drawn = F.xxhash64("value", F.lit(seed))
    return ticks.select(
        F.substring(F.sha2(drawn.cast("string"), 256), 1, 8).alias("order_id"),
        (F.pmod(drawn, F.lit(99_001)) / 100 + 10).cast("decimal(10,2)").alias("amount"),
        F.col("timestamp").alias("event_time"),
    )


def from_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A bounded table from literal rows, for samples and small dimensions."""
    return spark.createDataFrame(rows, schema)
