"""Message, index and console sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keyed_json(df: DataFrame, key: list[str], op: str | None = "c") -> DataFrame:
    """Rows as ``key`` and ``value`` JSON, the value with a constant ``op`` when given."""
    value = F.struct("*", F.lit(op).alias("op")) if op else F.struct("*")
    return df.select(F.to_json(F.struct(*key)).alias("key"), F.to_json(value).alias("value"))


def write_stream(stream: DataFrame, checkpoint: str, target: str | dict, mode: str = "append"):
    """Writes ``value`` (and ``key``) to a topic (options with servers and topic) or a folder of JSON lines."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if isinstance(target, dict):
        return writer.format("kafka").options(**target).start()
    return writer.format("json").option("path", target).trigger(availableNow=True).start()


def bulk_lines(df: DataFrame, index: str, json: str, id_column: str | None = None) -> DataFrame:
    """Bulk index lines: an action line and the document, one text of two lines per row."""
    header = {"_index": F.lit(index)}
    if id_column:
        header["_id"] = F.col(id_column).cast("string")
    action = F.to_json(F.struct(F.struct(*[c.alias(n) for n, c in header.items()]).alias("index")))
    return df.select(F.concat(action, F.lit("\n"), F.col(json)).alias("value"))


def write_bulk(df: DataFrame, path: str, index: str, json: str, id_column: str | None = None) -> None:
    """Bulk files, one per task, ready to be posted as they are."""
    bulk_lines(df, index, json, id_column).write.mode("overwrite").text(path)


def print_stream(stream: DataFrame, mode: str = "append"):
    """Shows every micro-batch on the console."""
    return stream.writeStream.outputMode(mode).format("console").option("truncate", "false").start()
