"""Nested documents: conversion of rows and flattening into columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def struct_to_document(row: str | Column) -> Column:
    """A row as JSON text; null fields are left out at every level."""
    return F.to_json(row)


def _variant_text(value: Column, lists: str) -> Column:
    """The text of a variant: scalars bare, nested documents as JSON."""
    kind = F.schema_of_variant(value)
    json = F.to_json(value)
    text = F.when(kind.startswith("OBJECT"), json)
    if lists == "text":
        # A list prints as its elements between brackets, separated by comma and space.
        items = F.try_variant_get(value, "$", "array<variant>")
        shown = F.transform(
            items,
            lambda v: F.coalesce(
                F.when(F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)"), F.to_json(v)),
                F.try_variant_get(v, "$", "string"),
                F.lit("null"),
            ),
        )
        as_list = F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))
    else:
        as_list = json
    text = text.when(kind.startswith("ARRAY"), as_list)
    return text.otherwise(F.try_variant_get(value, "$", "string"))


def flatten_documents(
    df: DataFrame,
    document: str,
    columns: list[str],
    depth: int = 1,
    lists: str = "json",
) -> DataFrame:
    """Extracts columns from JSON documents as text.

    ``depth`` 0 reads top-level fields by their literal name. From 1 on a dotted
    name walks into nested documents for at most ``depth`` levels; what remains
    below is returned as JSON. A scalar met on the way is returned as it is, a
    missing field is null. ``lists`` prints lists as ``json`` or as ``text``. A text
    that is no JSON gives nulls; :func:`malformed_documents` returns such rows.
    """
    # As generators parse and lookups happen once; plain expressions would be repeated for everything that names them.
    parsed = df.select("*", F.inline(F.array(F.struct(F.try_parse_json(document).alias("_doc")))))
    values = []
    for i, column in enumerate(columns):
        names = [column] if depth <= 0 else column.split(".")[: depth + 1]
        # One lookup per path prefix, and the deepest that is reached through documents only.
        paths = ["$" + "".join("['" + n.replace("'", "\\'") + "']" for n in names[:k]) for k in range(len(names) + 1)]
        steps = [F.col("_doc"), *[F.try_variant_get("_doc", p, "variant") for p in paths[1:]]]
        value = steps[-1]
        for before in reversed(steps[:-1] if depth > 0 else []):
            value = F.when(F.schema_of_variant(before).startswith("OBJECT"), value).otherwise(before)
        values.append(value.alias(f"_value{i}"))
    found = parsed.select(*df.columns, F.inline(F.array(F.struct(*values))))
    shown = [_variant_text(F.col(f"_value{i}"), lists).alias(c.replace(".", "_")) for i, c in enumerate(columns)]
    return found.select(*df.columns, *shown)


def malformed_documents(df: DataFrame, document: str) -> DataFrame:
    """The rows whose document is text but no JSON."""
    return df.where(F.col(document).isNotNull() & F.try_parse_json(document).isNull())


def read_document_changes(records: DataFrame, value: str = "value") -> DataFrame:
    """``op``, ``before`` and ``after`` of envelope texts; the other columns stay.

    Images may be JSON objects or texts that hold one. Records may be wrapped in ``schema`` and ``payload``. What is
    no JSON gives nulls, a record's text stays as its image then, so that it can be set aside as it came.
    """
    others = [c for c in records.columns if c != value]
    opened = records.select(*records.columns, F.inline(F.array(F.from_json(value, "payload string"))))
    envelope = F.from_json(F.coalesce("payload", value), "op string, before string, after string")
    read = opened.select(*records.columns, F.inline(F.array(envelope)))
    after = F.coalesce("after", F.when(F.col("op").isNull(), F.col(value))).alias("after")
    return read.select(*others, "op", "before", after)


def decode_document_changes(changes: DataFrame, apply_deletes: bool = False, keep: bool = False) -> DataFrame:
    """Document changes as ``(collection, op, document)``.

    ``changes`` has ``topic``, ``op``, ``before`` and ``after`` (JSON text). The
    collection is the last dotted part of the topic. Records without an after
    image, deletes among them, are dropped unless ``apply_deletes`` keeps them
    with their before image; ``keep`` keeps all, and the topic as ``_topic``.
    """
    collection = F.coalesce(F.element_at(F.split("topic", r"\."), -1), F.lit("unknown"))
    image = F.coalesce(F.col("after"), F.when(F.col("op") == "d", F.col("before"))) if apply_deletes else F.col("after")
    decoded = changes.withColumns({"document": image, "_collection": collection, "_op": F.col("op")})
    if keep:
        return decoded.withColumnRenamed("topic", "_topic").drop("op", "before", "after")
    return decoded.where(F.col("document").isNotNull()).drop("topic", "op", "before", "after")
