"""Registry of the contract queries: a Spark form and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.scan import epoch_micros

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; without ``sql`` it is checked for rows only."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str, where: str | None = None) -> DataFrame:
    """A driver table; wall-clock timestamps are read as UTC in any session zone.

    ``where`` filters the stored columns, so it reaches the Parquet reader.
    """
    df = spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    if where:
        df = df.where(where)
    utc = spark.conf.get("spark.sql.session.timeZone") in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")
    clocks = {
        f.name: F.col(f.name).cast("timestamp") if utc else F.timestamp_micros(epoch_micros(f.name, f.dataType))
        for f in df.schema
        if f.dataType.typeName() == "timestamp_ntz"
    }
    return df.withColumns(clocks) if clocks else df


def ms(column: str) -> Column:
    """Epoch milliseconds, the form in which the queries return times."""
    return F.unix_millis(column).alias(column)


def cents(column: str | Column) -> Column:
    """Sums of two-decimal amounts, free of summation-order noise."""
    return F.round(column, 2)
