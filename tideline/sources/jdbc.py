"""Relational sources over JDBC: catalog discovery and partitioned reads."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tideline.plans.keyed_table import check_identifier
from tideline.sources.splits import quantile_query, range_predicates


@dataclass(frozen=True)
class TableInfo:
    """One table of the source catalog."""

    db: str
    name: str
    columns: tuple[tuple[str, str], ...]
    key: tuple[str, ...]


def catalog_query(db: str, include: list[str] | None = None) -> str:
    """Columns, types and key positions of a database's base tables."""
    check_identifier(db)
    wanted = ""
    if include:
        names = ", ".join(f"'{check_identifier(t.strip())}'" for t in include)
        wanted = f" AND c.table_name IN ({names})"
    return (
        "SELECT c.table_name AS table_name, c.column_name AS column_name, c.column_type AS column_type, "
        "c.ordinal_position AS ordinal_position, k.ordinal_position AS key_position "
        "FROM information_schema.columns c "
        "JOIN information_schema.tables t ON t.table_schema = c.table_schema AND t.table_name = c.table_name "
        "LEFT JOIN information_schema.key_column_usage k ON k.table_schema = c.table_schema "
        "AND k.table_name = c.table_name AND k.column_name = c.column_name AND k.constraint_name = 'PRIMARY' "
        f"WHERE c.table_schema = '{db}' AND t.table_type = 'BASE TABLE'{wanted}"
    )


def tables_of(rows: list, db: str) -> list[TableInfo]:
    """Catalog rows as tables; the key may have several columns."""
    found: dict[str, list] = {}
    for row in rows:
        found.setdefault(row["table_name"], []).append(row)
    out = []
    for name, columns in sorted(found.items()):
        columns.sort(key=lambda r: r["ordinal_position"])
        keyed = sorted((r for r in columns if r["key_position"] is not None), key=lambda r: r["key_position"])
        out.append(
            TableInfo(
                db,
                name,
                tuple((r["column_name"], r["column_type"]) for r in columns),
                tuple(r["column_name"] for r in keyed),
            )
        )
    return out


def discover_tables(
    spark: SparkSession, url: str, db: str, include: list[str] | None = None, **options
) -> list[TableInfo]:
    """The tables of a database; only catalog rows reach the driver."""
    catalog = spark.read.format("jdbc").options(url=url, query=catalog_query(db, include), **options).load()
    return tables_of(catalog.collect(), db)


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: list[str] | tuple[str, ...] = (),
    partitions: int = 64,
    fetch_size: int = 10_000,
    **options,
) -> DataFrame:
    """A table read by many tasks, each over its own range of the ordered key, whatever its types.

    The source itself cuts its key index (:func:`quantile_query`); without a key one task reads the table. Spark
    pushes column selection and filters into the source.
    """
    source = {"url": url, **options}
    if not key:
        return spark.read.format("jdbc").options(dbtable=table, fetchsize=fetch_size, **source).load()
    cuts = spark.read.format("jdbc").options(query=quantile_query(table, list(key), partitions), **source).load()
    predicates = range_predicates(list(key), [tuple(r) for r in cuts.collect()])
    properties = {k: str(v) for k, v in {"fetchsize": fetch_size, **options}.items()}
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties)


def snapshot_database(spark: SparkSession, sync, url: str, db: str, include: list[str] | None = None, **options):
    """Loads every table of a database into the tables of ``sync``; returns what was found."""
    tables = discover_tables(spark, url, db, include, **options)
    for info in tables:
        rows = read_jdbc_table(spark, url, f"{db}.{info.name}", info.key, **options)
        sync.load_snapshot(db, info.name, rows, list(info.columns), list(info.key))
    return tables
