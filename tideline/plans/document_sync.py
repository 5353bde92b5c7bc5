"""Document collections into keyed tables with flattened columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.documents import decode_document_changes, flatten_documents
from tideline.functions.types import spark_type
from tideline.operators.changelog import KINDS, compact_changes
from tideline.plans import storage
from tideline.plans.keyed_table import KeyedTable

QUARANTINED = ["seq", "topic", "op", "document", "reason"]


@dataclass(frozen=True)
class Collection:
    """How one collection becomes a table: dotted field, column type, and the key field."""

    name: str
    fields: tuple[tuple[str, str], ...]
    key: str = "_id"
    depth: int = 1
    lists: str = "json"

    @property
    def columns(self) -> list[tuple[str, str]]:
        return [(field.replace(".", "_"), kind) for field, kind in self.fields]


class DocumentSync:
    """Keeps one keyed table per collection current from document changes.

    Deletes are skipped unless ``apply_deletes`` is set, and so are collections that are
    not listed. Every other record is applied, is superseded by a later one of its key, or
    goes to ``<root>/_quarantine`` with a reason: it has no operation or an unknown one, no
    document, one that is no JSON object, no key, or values that do not fit their column.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        collections: list[Collection],
        apply_deletes: bool = False,
        source: str = "documents",
    ):
        self.spark, self.root, self.source = spark, root.rstrip("/"), source
        self.collections, self.apply_deletes = collections, apply_deletes

    def path(self, collection: str) -> str:
        return f"{self.root}/{collection}"

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Applies ``seq``, ``topic``, ``op``, ``before`` and ``after`` records."""
        staging, quarantine = f"{self.root}/_staging/batch={batch_id}", f"{self.root}/_quarantine/batch={batch_id}"
        decoded = decode_document_changes(batch, self.apply_deletes, keep=True)
        if not self.apply_deletes:
            decoded = decoded.where(F.coalesce(F.col("_op") != "d", F.lit(True)))
        listed = F.col("_collection").isin([c.name for c in self.collections])
        checked = decoded.where(listed).withColumn("reason", _unusable(F.col("_op"), F.col("document")))
        try:
            checked.write.mode("overwrite").parquet(staging)
            records = self.spark.read.schema(checked.schema).parquet(staging)
            renamed = {"_topic": "topic", "_op": "op"}
            bad = records.where("reason IS NOT NULL").withColumnsRenamed(renamed).select(*QUARANTINED)
            bad.write.mode("overwrite").parquet(f"{quarantine}/part=records")
            for c in self.collections:
                rows = records.where((F.col("_collection") == c.name) & F.col("reason").isNull()).drop("reason")
                self._apply(c, rows, f"{quarantine}/part={c.name}", batch_id)
        finally:
            storage.delete_folder(self.spark, staging)

    def _apply(self, c: Collection, rows: DataFrame, quarantine: str, batch_id: int) -> None:
        table = KeyedTable.create(self.spark, self.path(c.name), c.columns, [c.key])
        rows = rows.withColumn("kind", F.when(F.col("_op") == "d", "delete").otherwise("update"))
        flat = flatten_documents(rows, "document", [f for f, _ in c.fields], c.depth, c.lists)
        shown = F.inline(F.array(F.struct(*[n for n, _ in c.columns])))
        flat = flat.select(*rows.columns, shown)
        typed = {n: F.col(n).try_cast(spark_type(kind)) for n, kind in c.columns}
        lost = [F.when(_lost(F.col(n), typed[n], spark_type(kind)) & ((F.col("kind") != "delete") | F.lit(n == c.key)), F.lit(n)) for n, kind in c.columns]
        misfit = F.concat_ws(", ", *lost)
        reason = F.when(F.col(c.key).isNull(), "no key").when(misfit != "", F.concat(F.lit("does not fit: "), misfit))
        staged = flat.withColumn("reason", reason)
        bad = staged.where("reason IS NOT NULL").withColumnsRenamed({"_topic": "topic", "_op": "op"}).select(*QUARANTINED)
        bad.write.mode("overwrite").parquet(quarantine)
        good = staged.where("reason IS NULL").select("seq", "kind", *[v.alias(n) for n, v in typed.items()])
        first = rows.agg(F.min("seq")).first()[0]
        table.merge(compact_changes(good, [c.key]), batch_id, self.source)
        table.maintain(first)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        writer = stream.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()


def _unusable(op: Column, document: Column) -> Column:
    parsed = F.try_parse_json(document)
    return (
        F.when(op.isNull(), F.lit("no op"))
        .when(~op.isin([o for o in KINDS if o != "t"]), F.lit("unknown op"))
        .when(document.isNull(), F.lit("no document"))
        .when(parsed.isNull() | ~F.schema_of_variant(parsed).startswith("OBJECT"), F.lit("no JSON object"))
    )


def _lost(text: Column, typed: Column, kind: T.DataType) -> Column:
    """Whether a value is there but not in its column's type, be it only rounded."""
    lost = typed.isNull()
    if isinstance(kind, T.DecimalType):
        lost |= typed.cast("double") != text.try_cast("double")
    return text.isNotNull() & lost
