"""Counts, running state per key and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.operators.scan import Count, OrderedScan, Recent, Sum


def count_by(df: DataFrame, keys: list[str], output: str = "n") -> DataFrame:
    """Rows per key, reduced before the shuffle."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(output))


def running_count(df: DataFrame, keys: list[str], order: list[str], output: str = "n") -> DataFrame:
    """How often each row's key has occurred so far."""
    return OrderedScan(df, keys, order).add(**{output: Count()}).result()


def running_sum(df: DataFrame, keys: list[str], order: list[str], value: str, output: str = "total") -> DataFrame:
    """The sum of the key's values so far."""
    return OrderedScan(df, keys, order).add(**{output: Sum(value)}).result()


def running_stats(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Count, sum and average of the key's rows so far."""
    out = OrderedScan(df, keys, order).add(count=Count(), sum=Sum(value)).result()
    return out.withColumn("avg", F.col("sum") / F.col("count"))


def recent_values(
    df: DataFrame, keys: list[str], order: list[str], value: str, n: int = 5, output: str = "recent"
) -> DataFrame:
    """The key's last ``n`` values at every row, oldest first."""
    return OrderedScan(df, keys, order).add(**{output: Recent(value, n)}).result()


def latest_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order``, which should end with a unique column."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
