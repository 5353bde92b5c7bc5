"""Routing, validation and explicit partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.text import split_trimmed, string_hash

MAIN = "main"

# Partition per region name.
REGION_PARTITIONS = {"north": 0, "south": 1, "east": 2, "west": 3}


def route(df: DataFrame, routes: dict[str, Column], output: str = "tag") -> DataFrame:
    """Tags each row with the first matching route, else ``main``.

    One pass over the data; write the result partitioned by the tag to get one
    output per route.
    """
    tag = F.lit(MAIN)
    for name, predicate in reversed(routes.items()):
        tag = F.when(predicate, F.lit(name)).otherwise(tag)
    return df.withColumn(output, tag)


def validate_csv(df: DataFrame, line: str) -> DataFrame:
    """Adds ``is_valid`` and ``message``.

    A valid line has three comma parts: a 32-bit integer and two non-empty texts.
    Other lines carry the reason of the first failed check.
    """
    whole = F.get("_parts", F.lit(0))
    number = _int32(whole)
    error = (
        F.when(F.size("_parts") != 3, F.lit("Invalid format"))
        .when(number.isNull(), F.concat(F.lit('For input string: "'), whole, F.lit('"')))
        .when(F.array_contains("_parts", ""), F.lit("Empty fields"))
    )
    checked = df.withColumn("_parts", split_trimmed(F.col(line), ",")).withColumn("_error", error)
    message = F.when(F.col("_error").isNull(), F.concat(F.lit("VALID: "), F.col(line))).otherwise(
        F.concat(F.lit("DLQ: "), F.col(line), F.lit(" [ERROR: "), F.col("_error"), F.lit("]"))
    )
    return checked.withColumns({"is_valid": F.col("_error").isNull(), "message": message}).drop("_parts", "_error")


def _int32(text: Column) -> Column:
    """A 32-bit integer written as an optional sign and digits, else null."""
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("int"))


def region_partition(region: Column, partitions: int) -> Column:
    """The partition id of a region: fixed for known names, by text hash for others."""
    pairs = [F.lit(x) for item in REGION_PARTITIONS.items() for x in item]
    # The remainder keeps the sign of the hash, as in truncating division.
    hashed = F.abs(string_hash(region) % F.lit(partitions))
    return F.coalesce(F.element_at(F.create_map(*pairs), region), hashed)


def partition_by_region(df: DataFrame, region: str, partitions: int, spread: int = 1) -> DataFrame:
    """Moves each region's rows to its partition.

    ``spread`` splits every partition into that many, by a hash of the whole row,
    for regions too large for one task.
    """
    target = F.pmod(region_partition(F.col(region), partitions), F.lit(partitions))
    if spread > 1:
        target = target * F.lit(spread) + F.pmod(F.xxhash64(*df.columns), F.lit(spread)).cast("int")
    return df.repartitionById(partitions * spread, target)
