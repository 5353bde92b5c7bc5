"""Event-time windows: tumbling, hopping, session, late data and top-N."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.scan import Count, Lag, Max, OrderedScan, Sum


def interval_micros(text: str) -> int:
    """Microseconds of a fixed-length interval such as ``'10 seconds'``."""
    units = {"microsecond": 1, "millisecond": 10**3, "second": 10**6, "minute": 6 * 10**7}
    units |= {"hour": 36 * 10**8, "day": 864 * 10**8, "week": 7 * 864 * 10**8}
    number, unit = text.split()
    return int(number) * units[unit.rstrip("s")]


def window_agg(
    df: DataFrame,
    ts: str,
    size: str,
    aggregates: dict[str, Column],
    keys: list[str] | None = None,
    slide: str | None = None,
) -> DataFrame:
    """Aggregates per window (and key): tumbling, or hopping with ``slide``.

    Windows are ``[start, end)`` and aligned to the epoch. Works on streams too.
    """
    window = F.window(ts, size, slide) if slide else F.window(ts, size)
    grouped = df.groupBy(window.alias("window"), *(keys or []))
    return grouped.agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(keys or []),
        *aggregates,
    )


def session_agg(
    df: DataFrame,
    ts: str,
    gap: str,
    value: str,
    keys: list[str] | None = None,
) -> DataFrame:
    """Count and sum per session; a session ends when nothing follows within ``gap``.

    Rows in one time cell of length ``gap`` always share a session, so cells are
    aggregated first. Only the cells, at most one per gap of covered time and key,
    are put in order, hot keys and the keyless form included.
    """
    keys = keys or []
    width = interval_micros(gap)
    celled = df.withColumn("_us", F.unix_micros(ts)).withColumn("_cell", F.floor(F.col("_us") / F.lit(width)))
    cells = (
        celled.groupBy(*keys, "_cell")
        .agg(
            F.min("_us").alias("_first"),
            F.max("_us").alias("_last"),
            F.count(F.lit(1)).alias("n"),
            F.sum(value).alias("total"),
        )
    )
    scan = OrderedScan(cells, keys, ["_cell"], measure=celled).add(_before=Lag("_last"))
    fresh = F.col("_before").isNull() | (F.col("_first") - F.col("_before") > width)
    numbered = scan.derive(_fresh=fresh.cast("int")).add(_session=Sum("_fresh")).result()
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.timestamp_micros(F.min("_first")).alias("session_start"),
            F.timestamp_micros(F.max("_last") + width).alias("session_end"),
            F.sum("n").alias("n"),
            F.sum("total").alias("total"),
        )
        .drop("_session")
    )


def mark_late(
    df: DataFrame,
    ts: str,
    arrival: str,
    size: str,
    out_of_orderness: str,
    lateness: str,
) -> DataFrame:
    """Adds the row's window and ``is_late``.

    A row is late when its window, lateness included, was over before the row
    arrived: ``end + lateness + out_of_orderness <= max(ts of earlier arrivals)``.
    """
    slack = interval_micros(lateness) + interval_micros(out_of_orderness)
    timed = df.withColumns({"_us": F.unix_micros(ts), "window": F.window(ts, size)})
    scan = OrderedScan(timed, [], [arrival]).add(_seen=Max("_us", before=True))
    over = F.unix_micros("window.end") + F.lit(slack) <= F.col("_seen")
    return scan.result().withColumn("is_late", F.coalesce(over, F.lit(False))).drop("_us", "_seen")


def late_window_agg(marked: DataFrame, aggregates: dict[str, Column], keys: list[str] | None = None) -> DataFrame:
    """Final window results over the rows that are not late."""
    grouped = marked.where(~F.col("is_late")).groupBy("window", *(keys or []))
    return grouped.agg(*[c.alias(n) for n, c in aggregates.items()]).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *(keys or []),
        *aggregates,
    )


def late_rows(marked: DataFrame) -> DataFrame:
    """The side output: rows that came after their window was dropped."""
    return marked.where("is_late").drop("is_late", "window")


def rank_text(rank: str, key: str, total: str) -> Column:
    """``#1 key: 0.00``."""
    return F.format_string("#%d %s: %.2f", F.col(rank), F.col(key).cast("string"), F.col(total))


def top_n_per_window(sums: DataFrame, n: int, key: str, total: str, window: str = "window_start") -> DataFrame:
    """The ``n`` largest keys of every window, ties broken by key.

    ``sums`` holds one row per window and key. Spark applies the rank limit
    before the shuffle, so a crowded window is cut down on every task.
    """
    order = Window.partitionBy(window).orderBy(F.col(total).desc(), F.col(key).asc())
    return sums.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def top_n_latest(sums: DataFrame, n: int, key: str, total: str, window: str = "window_start") -> DataFrame:
    """The ``n`` largest keys by each key's most recent window sum."""
    latest = sums.groupBy(key).agg(F.max_by(total, window).alias(total))
    top = latest.orderBy(F.col(total).desc(), F.col(key).asc()).limit(n)
    # Only n rows are left to number.
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.col(total).desc(), F.col(key).asc())))


def ttl_session_count(df: DataFrame, keys: list[str], ts: str, order: list[str], ttl: str) -> DataFrame:
    """Running count per key that starts again when ``ttl`` has passed since the row before."""
    limit = interval_micros(ttl)
    timed = df.withColumn("_us", F.unix_micros(ts))
    scan = OrderedScan(timed, keys, order).add(_before=Lag("_us"), _n=Count())
    fresh = F.col("_before").isNull() | (F.col("_us") - F.col("_before") >= limit)
    scan.derive(_start=F.when(fresh, F.col("_n"))).add(_since=Max("_start"))
    out = scan.result().withColumn("session_count", F.col("_n") - F.col("_since") + 1)
    return out.drop("_us", "_before", "_n", "_start", "_since")
