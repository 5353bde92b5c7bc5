"""Relational sinks: table creation, schema changes and set-based upserts.

A change set goes to a staging table in parallel and is merged into its target
by one statement inside the database, so no row passes the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.types import target_type
from tideline.plans.keyed_table import check_identifier

TIMESTAMP_DEFAULT = " DEFAULT '1970-01-01 09:00:00'"
MAX_NAME = 64


def _quoted(name: str) -> str:
    return f"`{check_identifier(name)}`"


def map_column_types(spark: SparkSession, columns: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Change-log types to target types, in column order."""
    rows = spark.createDataFrame([(i, n, t) for i, (n, t) in enumerate(columns)], "i int, name string, type string")
    mapped = rows.select("i", "name", target_type(F.col("type")).alias("type")).orderBy("i").collect()
    return [(r["name"], r["type"]) for r in mapped]


def create_table_sql(table: str, columns: list[tuple[str, str]], key: list[str] | None = None) -> str:
    """``CREATE TABLE IF NOT EXISTS`` with a composite key; timestamps get a default."""
    if len(table) > MAX_NAME or not columns:
        raise ValueError(f"invalid table: {table!r}")
    lines = [
        f"{_quoted(n)} {t}{TIMESTAMP_DEFAULT if t.upper().startswith('TIMESTAMP') else ''}" for n, t in columns
    ]
    if key:
        lines.append(f"PRIMARY KEY ({', '.join(_quoted(k) for k in key)})")
    return f"CREATE TABLE IF NOT EXISTS {_quoted(table)} ({', '.join(lines)})"


def alter_table_sql(table: str, change: str, column: str, detail: str | None = None) -> str:
    """One schema change: ``add`` or ``modify`` with a type, ``rename`` with a name, ``drop``."""
    forms = {
        "add": f"ADD COLUMN {_quoted(column)} {detail}",
        "modify": f"MODIFY COLUMN {_quoted(column)} {detail}",
        "drop": f"DROP COLUMN {_quoted(column)}",
    }
    if change == "rename":
        return f"ALTER TABLE {_quoted(table)} RENAME COLUMN {_quoted(column)} TO {_quoted(detail or '')}"
    return f"ALTER TABLE {_quoted(table)} {forms[change]}"


def upsert_sql(table: str, staging: str, columns: list[str], key: list[str]) -> str:
    """Moves the staged upserts into the target; without a key they are inserted."""
    names = ", ".join(_quoted(c) for c in columns)
    select = f"SELECT {names} FROM {_quoted(staging)} WHERE `_deleted` = 0"
    insert = f"INSERT INTO {_quoted(table)} ({names}) {select}"
    if not key:
        return insert
    updates = ", ".join(f"{_quoted(c)} = VALUES({_quoted(c)})" for c in columns if c not in key)
    fallback = f"{_quoted(key[0])} = VALUES({_quoted(key[0])})"
    return f"{insert} ON DUPLICATE KEY UPDATE {updates or fallback}"


def delete_sql(table: str, staging: str, key: list[str]) -> str:
    """Deletes the staged keys from the target."""
    match = " AND ".join(f"t.{_quoted(k)} = s.{_quoted(k)}" for k in key)
    return f"DELETE t FROM {_quoted(table)} t JOIN {_quoted(staging)} s ON {match} WHERE s.`_deleted` = 1"


def apply_change_set(
    net: DataFrame, url: str, table: str, key: list[str], batch_size: int = 1000, writers: int = 16, **options
) -> None:
    """Applies a compacted change set (``kind`` plus the table's columns) in one transaction.

    ``writers`` bounds the connections. Deletes and upserts commit together, so a
    retried batch ends in the same table.
    """
    spark = net.sparkSession
    columns = [c for c in net.columns if c not in ("kind", "seq")]
    staging = f"{table}_staging"
    rows = net.select(*columns, (F.col("kind") == "delete").cast("int").alias("_deleted"))
    # A delete carries the key only.
    rows.coalesce(writers).write.format("jdbc").mode("overwrite").options(
        url=url, dbtable=staging, batchsize=batch_size, **options
    ).save()
    statements = [delete_sql(table, staging, key)] if key else []
    statements.append(upsert_sql(table, staging, columns, key))
    run_in_transaction(spark, url, statements, **options)


def run_in_transaction(spark: SparkSession, url: str, statements: list[str], **options) -> None:
    """Runs statements through the session's driver and commits them together."""
    properties = spark._jvm.java.util.Properties()
    for name, value in options.items():
        properties.setProperty(name, str(value))
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def upsert_stream(stream: DataFrame, url: str, table: str, key: list[str], checkpoint: str, **options):
    """Keeps a relational table current from a stream of change rows (``seq``, ``kind``, columns)."""
    from tideline.operators.changelog import compact_changes

    def write(batch: DataFrame, batch_id: int) -> None:
        net = compact_changes(batch, key) if key else batch
        apply_change_set(net, url, table, key, **options)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
