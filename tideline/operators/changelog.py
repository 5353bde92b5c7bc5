"""Changelog processing: decode, check, compact, apply and derive schemas.

A decoded change has ``seq`` (total order), ``db``, ``table``, ``op``, ``kind``
and the row images ``before`` and ``after`` as JSON text. Nothing here needs a
global order: changes are ordered per key only, by ``seq``.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.operators.scan import Lag, OrderedScan

# Envelope operation codes.
KINDS = {"c": "insert", "r": "insert", "u": "update", "d": "delete", "t": "truncate"}

NAME = "^[a-zA-Z0-9_]+$"  # what databases, tables and columns may be called
ENVELOPE = (
    "op string, ts_ms long, source struct<db: string, table: string>, "
    "before string, after string, historyRecord string, "
    "schemaChanges array<struct<type: string, columns: array<struct<name: string>>>>, "
    "tableChanges array<struct<type: string, table: struct<columns: array<struct<name: string>>>>>"
)
HISTORY = (
    "tableChanges array<struct<type: string, table: struct<"
    "primaryKeyColumnNames: array<string>, "
    "columns: array<struct<name: string, typeName: string, typeExpression: string, length: int, scale: int>>>>>, "
    "renames map<string, string>"
)


def kind_of(op: Column) -> Column:
    """Operation code to change kind; unknown codes give null."""
    return F.element_at(F.create_map(*[F.lit(x) for item in KINDS.items() for x in item]), op)


def decode_changes(
    raw: DataFrame, value: str = "value", carried: tuple[str, ...] = ("seq",), declared: bool = False
) -> DataFrame:
    """Envelope text to change rows; ``reason`` says why a row cannot be used.

    Records may be wrapped in ``schema`` and ``payload``. Schema records (no ``op``) get
    the kind ``schema`` and keep their text in ``ddl``. With ``declared`` the text of the
    record's own schema comes as ``declared``; :func:`declared_fields` reads it.
    """
    # As a generator the parse happens once; a plain expression would be repeated for
    # every field and again in each filter that Spark pushes below it.
    wrapped = F.col(value).rlike(r'^\s*\{\s*"(schema|payload)"\s*:')
    outer = F.inline(F.array(F.from_json(F.when(wrapped, F.col(value)), "schema string, payload string")))
    opened = raw.select(*carried, F.col(value).alias("_value"), outer)
    extra = [F.col("schema").alias("declared")] if declared else []
    opened = opened.select(*carried, *extra, F.coalesce("payload", "_value").alias("_raw"))
    parsed = opened.select("*", F.inline(F.array(F.from_json("_raw", ENVELOPE))))
    ddl = F.coalesce(
        F.col("historyRecord"),
        F.when(
            F.col("op").isNull(),
            F.to_json(F.struct(F.coalesce(_nested_changes(), F.col("tableChanges")).alias("tableChanges"))),
        ),
    )
    is_schema = F.col("op").isNull() & (
        F.col("historyRecord").isNotNull()
        | F.col("schemaChanges").isNotNull()
        | F.col("tableChanges").isNotNull()
    )
    rows = parsed.select(
        *carried,
        F.col("source.db").alias("db"),
        F.col("source.table").alias("table"),
        "op",
        F.when(is_schema, F.lit("schema")).otherwise(kind_of(F.col("op"))).alias("kind"),
        "ts_ms",
        "before",
        "after",
        F.when(is_schema, ddl).alias("ddl"),
        *(["declared"] if declared else []),
        "_raw",
    )
    reason = unusable_reason()
    if "seq" in carried:
        reason = reason.when(F.col("seq").isNull(), F.lit("no position"))
    return rows.withColumn("reason", reason).drop("_raw")


def declared_fields(declared: str) -> list[dict]:
    """The fields of the row images (``field``, ``type``, ``name``, ``parameters``) that a record's own schema declares."""
    sides = {f.get("field"): f.get("fields") for f in json.loads(declared).get("fields") or []}
    return sides.get("after") or sides.get("before") or []


def _nested_changes() -> Column:
    return F.transform(
        "schemaChanges",
        lambda c: F.struct(c["type"].alias("type"), F.struct(c["columns"].alias("columns")).alias("table")),
    )


def unusable_reason() -> Column:
    """The first reason why a decoded row is skipped, else null."""
    return (
        F.when(F.col("_raw").isNull(), F.lit("no value"))
        .when(F.col("db").isNull() | F.col("table").isNull(), F.lit("no source"))
        .when(~(F.col("db").rlike(NAME) & F.col("table").rlike(NAME)), F.lit("invalid name"))
        .when(F.col("kind").isNull(), F.lit("unknown op"))
        .when((F.col("kind") == "delete") & F.col("before").isNull(), F.lit("delete without before"))
        .when(F.col("kind").isin("insert", "update") & F.col("after").isNull(), F.lit("no after"))
    )


def usable(changes: DataFrame) -> DataFrame:
    """Changes that can be applied."""
    return changes.where(F.col("reason").isNull()).drop("reason")


def quarantine(changes: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Changes that cannot be applied, with their reason.

    With a ``registry`` (``db``, ``table``) also those of unknown tables.
    """
    if registry is None:
        return changes.where(F.col("reason").isNotNull())
    known = registry.select("db", "table").distinct().withColumn("_known", F.lit(True))
    joined = changes.join(known, ["db", "table"], "left")
    unknown = F.col("_known").isNull() & (F.col("kind") != "schema")
    return (
        joined.withColumn("reason", F.coalesce("reason", F.when(unknown, F.lit("no schema"))))
        .drop("_known")
        .where(F.col("reason").isNotNull())
    )


def filter_tables(
    changes: DataFrame,
    database: str | None = None,
    table: str | None = None,
    include: list[str] | None = None,
) -> DataFrame:
    """Keeps databases and tables that match fully (regular expressions) or are listed."""
    out = changes
    if database is not None:
        out = out.where(F.col("db").rlike(f"^(?:{database})$"))
    if table is not None:
        out = out.where(F.col("table").rlike(f"^(?:{table})$"))
    if include is not None:
        out = out.where(F.col("table").isin(include))
    return out


def changes_as_json(changes: DataFrame) -> DataFrame:
    """``is_upsert`` and the row image as JSON: the old row for deletes, else the new one."""
    upsert = F.col("op") != "d"
    image = F.when(upsert, F.col("after")).otherwise(F.col("before"))
    return changes.withColumns({"is_upsert": upsert, "json": image}).where(F.col("json").isNotNull())


def split_by_operation(changes: DataFrame) -> DataFrame:
    """Marks each data change as ``upsert`` or ``delete``; other kinds are dropped."""
    side = F.when(F.col("kind") == "delete", F.lit("delete")).otherwise(F.lit("upsert"))
    return changes.where(F.col("kind").isin("insert", "update", "delete")).withColumn("side", side)


def compact_changes(changes: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """The net effect per key: its change with the highest ``seq``.

    An associative aggregate, so a hot key is reduced before the shuffle.
    """
    rest = [c for c in changes.columns if c not in key]
    newest = F.max_by(F.struct(*rest), seq).alias("_row")
    return changes.groupBy(*key).agg(newest).select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def apply_changes(target: DataFrame, net: DataFrame, key: list[str], kind: str = "kind") -> DataFrame:
    """The table after a compacted change set.

    Untouched rows pass an anti join that needs only the changed keys, so a small
    change set never makes a large target shuffle.
    """
    untouched = target.join(net.select(*key), key, "left_anti").select(*target.columns)
    upserts = net.where(F.col(kind) != "delete").select(*target.columns)
    return untouched.unionByName(upserts)


def append_changes(changes: DataFrame) -> DataFrame:
    """A table without a key: inserts and updates are appended, deletes ignored."""
    return changes.where(F.col("kind").isin("insert", "update"))


def with_before_images(changes: DataFrame, key: list[str], image: list[str], seq: str = "seq") -> DataFrame:
    """Adds ``before_image`` and ``after_image`` structs, derived from each key's earlier change."""
    after = F.when(F.col("kind") != "delete", F.struct(*image))
    scan = OrderedScan(changes.withColumn("after_image", after), key, [seq])
    return scan.add(before_image=Lag("after_image")).result()


def group_count(changes: DataFrame, group: list[str]) -> DataFrame:
    """Rows per group of the table that an updating changelog describes.

    Every change retracts its before image and adds its after image.
    """
    signed = changes.select(
        F.inline(
            F.array(
                F.struct(F.col("before_image").alias("image"), F.lit(-1).alias("sign")),
                F.struct(F.col("after_image").alias("image"), F.lit(1).alias("sign")),
            )
        )
    ).where(F.col("image").isNotNull())
    counted = signed.groupBy(*[F.col(f"image.{c}").alias(c) for c in group]).agg(F.sum("sign").alias("n"))
    return counted.where(F.col("n") != 0)


def infer_table_schemas(changes: DataFrame, key: str | None = None, seq: str = "seq") -> DataFrame:
    """The column registry: ``db, table, column, ordinal, type, is_key, valid_from_seq``.

    A column's type is the narrowest that holds its values in all changes; decimals stay
    exact, nested and mixed values are text. Columns are numbered in the order in which
    the changes bring them. ``key`` names a column with the key column names as an array.
    """
    image = F.coalesce("after", "before")
    keys = F.col(key) if key else F.lit(None).cast("array<string>")
    images = changes.where(image.isNotNull()).select(
        "db", "table", F.col(seq).alias("seq"), keys.alias("key"), image.alias("image")
    )
    fields = images.sparkSession.sql(
        """
        SELECT i.db, i.table, e.key AS column, schema_of_variant_agg(e.value) AS found,
               coalesce(bool_or(array_contains(i.key, e.key)), false) AS is_key,
               min(struct(i.seq, array_position(json_object_keys(i.image), e.key) AS place)) AS first
        FROM {images} i, LATERAL variant_explode(try_parse_json(i.image)) e
        GROUP BY i.db, i.table, e.key
        """,
        images=images,
    )
    digits = [F.regexp_extract("found", r"^DECIMAL\((\d+),(\d+)\)$", n).try_cast("int") for n in (1, 2)]
    exact = F.when((digits[1] <= 10) & (digits[0] - digits[1] <= 28), F.lit("DECIMAL(38,10)")).otherwise(
        F.concat(F.lit("DECIMAL(38,"), digits[1], F.lit(")"))
    )
    known = F.col("found").rlike(r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|BOOLEAN|BINARY)$")
    kind = (
        F.when(known, F.col("found"))
        .when(F.col("found").startswith("DECIMAL"), exact)
        .otherwise(F.lit("STRING"))
    )
    order = Window.partitionBy("db", "table").orderBy("first", "column")  # a table's columns
    return fields.select(
        "db",
        "table",
        "column",
        F.row_number().over(order).alias("ordinal"),
        kind.alias("type"),
        "is_key",
        F.col("first.seq").alias("valid_from_seq"),
    )


def history_columns(ddl: Column) -> Column:
    """Column names in a schema record: those of its first table change."""
    return F.transform(
        F.get(F.from_json(ddl, HISTORY)["tableChanges"], F.lit(0))["table"]["columns"], lambda c: c["name"]
    )


def detect_schema_changes(versions: DataFrame, columns: str = "columns", seq: str = "seq") -> DataFrame:
    """Dropped and added columns of each schema version against the version before it.

    ``versions`` has ``db``, ``table``, ``seq`` and the column name list. A list
    that is empty or missing changes nothing; first versions have no difference.
    """
    listed = versions.where(F.size(columns) > 0)
    scan = OrderedScan(listed, ["db", "table"], [seq]).add(_previous=Lag(columns))
    return (
        scan.result()
        .where(F.col("_previous").isNotNull())
        .withColumns(
            {
                "dropped": F.array_except("_previous", columns),
                "added": F.array_except(columns, "_previous"),
            }
        )
        .where((F.size("dropped") > 0) | (F.size("added") > 0))
        .drop("_previous")
    )
