"""Comparison of a source table with its replica."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How often a digest tree splits, level by level: 65,536 leaves.
LEVELS = (256, 256)


def reconcile_counts(pairs: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Row counts per table on both sides: ``table, source_rows, target_rows, equal``."""
    parts = [
        side.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("table"), F.lit(label).alias("side"), "n"
        )
        for name, (source, target) in pairs.items()
        for label, side in (("source", source), ("target", target))
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return (
        rows.groupBy("table")
        .agg(
            F.sum(F.when(F.col("side") == "source", F.col("n"))).alias("source_rows"),
            F.sum(F.when(F.col("side") == "target", F.col("n"))).alias("target_rows"),
        )
        .withColumn("equal", F.col("source_rows") == F.col("target_rows"))
    )


def reconcile_diff(source: DataFrame, target: DataFrame, key: list[str]) -> DataFrame:
    """Keys that are ``missing`` in the target, ``extra`` there or ``different``.

    Only the keys and a 64-bit digest of the other columns are shuffled.
    """
    compared = [c for c in source.columns if c not in key]

    def digest(df: DataFrame, name: str) -> DataFrame:
        return df.select(*key, _digest(compared).alias(name))

    joined = digest(source, "_source").join(digest(target, "_target"), key, "full_outer")
    status = (
        F.when(F.col("_target").isNull(), F.lit("missing"))
        .when(F.col("_source").isNull(), F.lit("extra"))
        .when(F.col("_source") != F.col("_target"), F.lit("different"))
    )
    return joined.select(*key, status.alias("status")).where(F.col("status").isNotNull())


def _digest(columns: list[str], seed: int = 0) -> Column:
    # Null and empty values must differ, so each column adds its null flag.
    return F.xxhash64(F.lit(seed), *[p for c in columns for p in (F.col(c), F.col(c).isNull())])


def digest_tree(rows: DataFrame, key: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """``level``, ``bucket``, ``n``, ``s0``, ``s1``: order-free digests of the rows by bucket of the key.

    Level 0 is the whole table; each further one splits every bucket by a factor of ``levels``. The rows are read
    once, into the last level's buckets; the other levels are sums of those.
    """
    leaves = 1
    for factor in levels:
        leaves *= factor
    columns = sorted(rows.columns)
    sums = [F.sum(_digest(columns, n).cast("decimal(38,0)")).alias(f"s{n}") for n in range(2)]
    leaf = F.pmod(F.xxhash64(*key), F.lit(leaves)).alias("leaf")
    summed = rows.groupBy(leaf).agg(F.count("*").alias("n"), *sums)
    at, width = [], leaves
    for level, factor in enumerate((1, *levels)):
        width //= factor
        at.append(F.struct(F.lit(level).alias("level"), F.floor(F.col("leaf") / width).alias("bucket")))
    spread = summed.select(F.explode(F.array(*at)).alias("at"), "n", "s0", "s1")
    total = [F.sum(c).alias(c) for c in ("n", "s0", "s1")]
    return spread.groupBy("at.level", "at.bucket").agg(*total)


def unequal_buckets(source: DataFrame, target: DataFrame) -> DataFrame:
    """``level`` and ``bucket`` where two digest trees differ, a bucket that one side lacks included."""
    a, b = (df.select("level", "bucket", F.struct("n", "s0", "s1").alias(c)) for df, c in ((source, "a"), (target, "b")))
    return a.join(b, ["level", "bucket"], "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select("level", "bucket")


def reconcile_tree(source: DataFrame, target: DataFrame, key: list[str], levels: tuple[int, ...] = LEVELS) -> DataFrame:
    """The rows of :func:`reconcile_diff`, found by comparing digest trees first.

    Of tables that hardly differ only a few leaves are unequal, and only their rows are read again and joined. The
    leaves' list is bounded by the tree, so it is broadcast.
    """
    found = unequal_buckets(digest_tree(source, key, levels), digest_tree(target, key, levels))
    leaves = 1
    for factor in levels:
        leaves *= factor
    wanted = F.broadcast(found.where(F.col("level") == len(levels)).select(F.col("bucket").alias("_leaf")))

    def rows(df: DataFrame) -> DataFrame:
        leaf = F.pmod(F.xxhash64(*key), F.lit(leaves))
        return df.withColumn("_leaf", leaf).join(wanted, "_leaf", "left_semi").drop("_leaf")

    return reconcile_diff(rows(source), rows(target), key)
