"""Whole-database synchronisation: a change stream into keyed tables.

Every micro-batch is decoded once, schema records and data are taken in order
together, and each key is reduced to its net effect in one shuffle over all
tables. The result is staged per table; the tables then append their delta
layers side by side. A replayed batch changes nothing.
"""

from __future__ import annotations

import json
import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.functions.types import declared_column, decoded_text, is_wider, normalize_time, spark_type
from tideline.operators import changelog
from tideline.plans import storage
from tideline.plans.keyed_table import IDENTIFIER, KeyedTable, Schema, check_identifier

PREFIX = "sink_"
QUARANTINED = ["seq", "db", "table", "kind", "before", "after", "reason"]
#: Types whose values are equal only if their text is.
EXACT_TEXT = (T.StringType, T.IntegralType, T.BooleanType, T.DateType)
RENAME = re.compile(
    r"(?:RENAME\s+COLUMN\s+`?(\w+)`?\s+TO\s+`?(\w+)`?)|(?:CHANGE\s+(?:COLUMN\s+)?`?(\w+)`?\s+`?(\w+)`?)",
    re.IGNORECASE,
)


@dataclass
class _TableBatch:
    """What one micro-batch means for one table, before its rows are touched."""

    db: str
    name: str
    path: str
    table: KeyedTable | None
    schema: Schema | None
    floor_seq: int = -1
    first_seq: int = -1
    truncate: bool = False
    dropped: bool = False
    strict: bool = False  # rows may have fields that are no columns
    problem: str | None = None


class DatabaseSync:
    """Keeps ``<root>/<db>/<prefix><table>`` equal to the source tables.

    ``include`` lists the tables, ``database`` and ``tables`` are patterns that must
    match in full; ``truncate`` is ``apply`` or ``ignore``. Rows that cannot be applied
    (no source, key or schema, invalid names, values that do not fit their column) go
    to ``<root>/_quarantine`` with a reason; all others go on. Keys come from the change records (``key`` column with the column names) or
    from ``keys``, a map from table to key columns.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        *,
        include: list[str] | None = None,
        database: str | None = None,
        tables: str | None = None,
        keys: dict[str, list[str]] | None = None,
        prefix: str = PREFIX,
        truncate: str = "apply",
        source: str = "changes",
        parallel_tables: int = 8,
    ):
        self.spark, self.root, self.prefix = spark, root.rstrip("/"), prefix
        self.include, self.keys, self.truncate = include, keys or {}, truncate
        self.database, self.tables = database, tables
        self.source, self.parallel_tables = source, parallel_tables
        self.holds: dict[str, int] = {}

    def path(self, db: str, name: str) -> str:
        return f"{self.root}/{check_identifier(db)}/{self.prefix}{check_identifier(name)}"

    def table(self, db: str, name: str) -> KeyedTable | None:
        return KeyedTable.load(self.spark, self.path(db, name))

    def create(self, db: str, name: str, columns: list[tuple[str, str]], key: list[str]) -> KeyedTable:
        """Creates a table from its catalog entry, if it is missing."""
        return KeyedTable.create(self.spark, self.path(db, name), columns, key)

    def hold(self, db: str, name: str, seq: int | None) -> None:
        """Deleted rows of a table stay known from ``seq`` on, until this is taken back with nothing."""
        self.holds.pop(self.path(db, name), None)
        if seq is not None:
            self.holds[self.path(db, name)] = seq

    def load_snapshot(
        self, db: str, name: str, rows: DataFrame, columns: list[tuple[str, str]], key: list[str]
    ) -> KeyedTable:
        """Creates a table from its catalog entry and loads its rows once."""
        table = KeyedTable.create(self.spark, self.path(db, name), columns, key)
        if table.is_new:
            table.load_snapshot(rows.select(*[c for c, _ in columns]))
        return table

    def apply_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Applies one micro-batch of ``seq``, ``value`` (envelope) and optional ``key``."""
        carried = ("seq", "key") if "key" in batch.columns else ("seq",)
        decoded = changelog.decode_changes(batch, "value", carried, declared=True)
        sourceless = F.col("db").isNull() | F.col("table").isNull()
        for column, pattern in (("db", self.database), ("table", self.tables)):
            if pattern is not None:
                decoded = decoded.where(F.col(column).rlike(f"^(?:{pattern})$") | sourceless)
        if self.include is not None:
            decoded = decoded.where(F.col("table").isin(self.include) | sourceless)
        staging = f"{self.root}/_staging/batch={batch_id}"
        quarantine = f"{self.root}/_quarantine/batch={batch_id}"
        try:
            decoded.write.mode("overwrite").parquet(f"{staging}/decoded")
            changes = self.spark.read.schema(decoded.schema).parquet(f"{staging}/decoded")
            good = changelog.usable(changes)
            plans = self._plan_tables(good, batch_id)
            staged = [p for p in plans if p.schema is not None or p.dropped]
            unfit = self._stage_net_changes(good, plans, f"{staging}/net") if plans else None
            bad = changelog.quarantine(changes).select(*QUARANTINED)
            bad = bad.unionByName(unfit) if unfit is not None else bad
            bad.withColumn("part", F.lit("rows")).write.mode("overwrite").partitionBy("part").parquet(quarantine)
            with ThreadPoolExecutor(self.parallel_tables) as pool:
                list(pool.map(lambda p: self._apply_table(p, f"{staging}/net", quarantine, batch_id), staged))
        finally:
            storage.delete_folder(self.spark, staging)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Runs :meth:`apply_batch` on a stream of change records."""
        writer = stream.writeStream.foreachBatch(self.apply_batch).option("checkpointLocation", checkpoint)
        return writer.trigger(**(trigger or {"availableNow": True})).start()

    # Planning: what reaches the driver is one row for each table, schema record and different schema of its records.

    def _plan_tables(self, good: DataFrame, batch_id: int) -> list[_TableBatch]:
        key = F.col("key") if "key" in good.columns else F.lit(None).cast("array<string>")
        data = F.col("kind").isin("insert", "update", "delete")
        shapes = good.groupBy("db", "table", "declared", "ddl").agg(
            F.min("seq").alias("low"),
            F.max("seq").alias("high"),
            F.max(F.when(F.col("kind") == "truncate", F.col("seq"))).alias("truncated"),
            F.collect_set(F.when(F.col("kind") == "schema", F.col("seq"))).alias("seqs"),
            F.min_by(key, F.when(F.size(key) > 0, F.col("seq"))).alias("key"),
            F.bool_or(data).alias("data"),
        )
        by_table: dict[tuple[str, str], list] = {}
        for r in shapes.collect():
            by_table.setdefault((r["db"], r["table"]), []).append(r)
        tables = KeyedTable.load_all(self.spark, [self.path(*at) for at in by_table])
        plans, bare = [], []
        for (db, name), rows in by_table.items():
            path = self.path(db, name)
            table = tables.get(path)
            if table and batch_id <= table.state["applied"].get(self.source, -1):
                continue
            plan = _TableBatch(db, name, path, table, table.schema if table else None)
            plan.first_seq = min(r["low"] for r in rows)
            keyed = [r for r in rows if r["key"]]
            key = min(keyed, key=lambda r: r["low"])["key"] if keyed else self.keys.get(name, [])
            steps = [(seq, 0, r) for r in rows for seq in r["seqs"]]
            steps += [(r["low"], 1, r) for r in rows if r["declared"] is not None and r["data"]]
            for seq, kind, r in sorted(steps, key=lambda x: x[:2]):
                try:
                    if kind == 0:
                        _follow_schema_record(plan, seq, json.loads(r["ddl"]))
                    else:
                        _follow_shape(plan, r["low"], r["high"], changelog.declared_fields(r["declared"]), key)
                except ValueError as error:  # this table's rows are set aside, the others go on
                    plan.problem = f"schema record {seq}: {error}" if kind == 0 else str(error)
            truncated = max((r["truncated"] for r in rows if r["truncated"] is not None), default=None)
            if truncated is not None and self.truncate == "apply":
                plan.truncate = True
                plan.floor_seq = max(plan.floor_seq, truncated)
            plans.append(plan)
            if any(r["declared"] is None and r["data"] for r in rows) and not plan.dropped and not plan.problem:
                bare.append((plan, key))
        if bare:
            self._learn_bare(good.where(F.col("declared").isNull() & data), bare)
        for plan in plans:
            if plan.problem:
                plan.schema, plan.dropped = None, False
        return plans

    def _learn_bare(self, rows: DataFrame, plans: list[tuple[_TableBatch, list[str]]]) -> None:
        """Columns for fields that records without a schema of their own bring, typed from all their values."""
        known = [(p.db, p.name, [c["name"] for c in p.schema.columns] if p.schema else [], p.schema.ended() if p.schema else {}) for p, _ in plans]
        known = self.spark.createDataFrame(known, "db string, table string, names array<string>, ended map<string, long>")
        fields = F.json_object_keys(F.coalesce("after", "before"))
        rows = rows.join(F.broadcast(known), ["db", "table"]).where(F.size(_unknown(fields, F.col("names"), F.col("ended"))) > 0)  # one row per table
        found: dict[tuple[str, str], list] = {}
        for r in changelog.infer_table_schemas(rows).collect():
            found.setdefault((r["db"], r["table"]), []).append(r)
        for plan, key in plans:
            columns = sorted(found.get((plan.db, plan.name), []), key=lambda r: r["ordinal"])
            plan.strict = True
            if not columns:
                continue
            names = [c["column"] for c in columns]
            try:
                if plan.schema is None:
                    plan.schema = Schema.of([(c["column"], c["type"]) for c in columns], [k for k in key or [] if k in names])
                    continue
            except ValueError as error:
                plan.problem = str(error)
                continue
            plan.schema = plan.schema.copy()
            for c in columns:
                if IDENTIFIER.fullmatch(c["column"]) and plan.schema.find(c["column"]) is None:
                    plan.schema.add(c["column"], c["type"], plan.schema.ended().get(c["column"], 0))

    def _stage_net_changes(self, good: DataFrame, plans: list[_TableBatch], folder: str) -> DataFrame:
        """Writes the net effect per table and key, partitioned by table; returns the rows that have no table or key."""
        # Key values may be under an older column name in rows that precede a rename.
        info = self.spark.createDataFrame(
            [
                (
                    p.db,
                    p.name,
                    p.floor_seq,
                    [
                        [k, *[a["name"] for a in p.schema.find(k)["aliases"]]]
                        for k in (p.schema.key if p.schema else [])
                    ],
                    p.problem or (None if p.schema is not None else "no schema"),
                )
                for p in plans
            ],
            "db string, table string, floor_seq long, key_names array<array<string>>, problem string",
        )
        data = good.where(F.col("kind").isin("insert", "update", "delete"))
        joined = data.join(F.broadcast(info), ["db", "table"]).where(F.col("seq") > F.col("floor_seq"))
        image = F.coalesce(F.when(F.col("kind") == "delete", F.col("before")), F.col("after"))
        fields = F.from_json("image", "map<string,string>")
        values = F.transform("key_names", lambda names: F.get(F.array_compact(F.transform(names, _field)), F.lit(0)))
        keyed = joined.withColumn("image", image).withColumn("fields", fields).withColumn("values", values).withColumn(
            "key_text", F.when(F.size("key_names") > 0, F.to_json("values")).otherwise(F.col("seq").cast("string"))
        )
        keyless = F.when(F.exists("values", lambda v: v.isNull()), F.lit("no key"))
        keyed = keyed.withColumn("reason", F.coalesce("problem", keyless))
        unfit = keyed.where(F.col("reason").isNotNull()).select(*QUARANTINED)
        net = changelog.compact_changes(
            keyed.where(F.col("reason").isNull()).select("db", "table", "key_text", "seq", "kind", "image"),
            ["db", "table", "key_text"],
        )
        # Rebalancing by table keeps files few and still splits a table that dominates the batch.
        staged = net.drop("key_text").hint("rebalance", "db", "table")
        staged.write.mode("overwrite").partitionBy("db", "table").parquet(folder)
        return unfit

    def _apply_table(self, plan: _TableBatch, folder: str, quarantine: str, batch_id: int) -> None:
        if plan.schema is None:
            if plan.table is not None:
                plan.table.drop()
            return
        table = plan.table
        if table is None or plan.dropped:
            if table is not None:
                table.drop()
            columns = [(c["name"], c["type"]) for c in plan.schema.columns]
            table = KeyedTable.create(self.spark, plan.path, columns, plan.schema.key)
        mine = f"{folder}/db={plan.db}/table={plan.name}"
        if storage.list_names(self.spark, mine):
            rows = self.spark.read.schema("seq long, kind string, image string").parquet(mine)
        else:
            rows = self.spark.createDataFrame([], "seq long, kind string, image string")
        # Written, since what fits and what does not are both taken from it.
        typed = parse_images(rows, plan.schema, plan.strict)
        typed = typed.withColumn("_image", F.when(F.col("_unfit") != "", F.col("_image")))
        aside = f"{folder}-typed/{plan.db}/{plan.name}"
        typed.write.mode("overwrite").parquet(aside)
        typed = self.spark.read.schema(typed.schema).parquet(aside)
        unfit = typed.where(F.col("_unfit") != "").select(
            "seq",
            F.lit(plan.db).alias("db"),
            F.lit(plan.name).alias("table"),
            "kind",
            F.when(F.col("kind") == "delete", F.col("_image")).alias("before"),
            F.when(F.col("kind") != "delete", F.col("_image")).alias("after"),
            F.col("_unfit").alias("reason"),
        )
        unfit.write.mode("overwrite").parquet(f"{quarantine}/part=table-{plan.db}-{plan.name}")
        fitting = typed.where(F.col("_unfit") == "").drop("_unfit", "_image")
        # Equal keys may be written differently: what counts is the typed key.
        if any(not isinstance(spark_type(plan.schema.find(k)["type"]), EXACT_TEXT) for k in plan.schema.key):
            fitting = changelog.compact_changes(fitting, plan.schema.key)
        table.merge(fitting, batch_id, self.source, schema=plan.schema, truncate=plan.floor_seq if plan.floor_seq >= 0 else None)
        table.maintain(min(plan.first_seq, self.holds.get(plan.path, plan.first_seq)))


def _field(name: Column) -> Column:
    return F.element_at("fields", name)


def _unknown(fields: Column, names: Column, ended: Column) -> Column:
    """The fields that are none of ``names`` and had not been one when the row (``seq``) was written."""
    before = lambda f: F.coalesce(F.col("seq") < F.element_at(ended, f), F.lit(False))
    return F.filter(fields, lambda f: ~F.array_contains(names, f) & ~before(f))


def parse_images(rows: DataFrame, schema: Schema, strict: bool = False) -> DataFrame:
    """Rows with ``seq``, ``kind`` and a JSON ``image`` in the columns of ``schema``.

    ``_unfit`` names the columns whose value cannot be told in their type (with ``strict``
    also fields that are no columns), ``_image`` is the image. Fields are read by name. Rows
    older than a column's start give null, rows older than a rename are read under the
    former name, rows older than a change of encoding in the former encoding.
    """
    names = sorted({n for c in schema.columns for n in (c["name"], *[a["name"] for a in c["aliases"]])})
    text = T.StructType([T.StructField(f"f{i}", T.StringType()) for i in range(len(names))])
    field_of = {n: F.col(f"f{i}") for i, n in enumerate(names)}
    wanted = T.StructType([T.StructField(n, T.StringType()) for n in names])
    # The generator keeps Spark from parsing the image once per column.
    image = F.inline(F.array(F.from_json("image", wanted).cast(text)))
    fields = rows.select("seq", "kind", "image", image)
    texts, typed, unfit = [], [], []
    for i, c in enumerate(schema.columns):
        value = field_of[c["name"]]
        for alias in reversed(c["aliases"]):
            value = F.when(F.col("seq") < alias["until_seq"], field_of[alias["name"]]).otherwise(value)
        if c["from_seq"]:
            value = F.when(F.col("seq") >= c["from_seq"], value)
        texts.append(value.alias(f"_text{i}"))
        kind, encoding = spark_type(c["type"]), c.get("encoding", "text")
        text, got = F.col(f"_text{i}"), F.col(f"`{c['name']}`")
        decoded = decoded_text(text, encoding, spark_type(c.get("encoded_as", c["type"])))
        for was in reversed(c.get("encodings", [])):
            decoded = F.when(F.col("seq") < was["until_seq"], decoded_text(text, was["encoding"], spark_type(was["type"]))).otherwise(decoded)
        typed.append(_typed(decoded, kind).alias(c["name"]))
        lost = got.isNull()
        if isinstance(kind, T.DecimalType) and encoding == "text" and not c.get("encodings"):
            lost |= got.cast("double") != text.try_cast("double")  # it was rounded
        if not isinstance(kind, T.StringType):
            unfit.append(F.when(text.isNotNull() & lost, F.lit(c["name"])))
    names = [c["name"] for c in schema.columns]
    # Here too a generator keeps Spark from computing a column again for everything that names it.
    staged = fields.select("seq", "kind", F.col("image").alias("_image"), *texts)
    staged = staged.select("*", F.inline(F.array(F.struct(*typed)))) if typed else staged
    misfit = F.concat(F.lit("does not fit: "), F.concat_ws(", ", *unfit))
    reasons = [F.when(F.concat_ws(", ", *unfit) != "", misfit)]
    if strict:
        pairs = [F.lit(x) for item in schema.ended().items() for x in item]
        ended = (F.create_map(*pairs) if pairs else F.lit(None)).cast("map<string, long>")
        extra = _unknown(F.json_object_keys("_image"), F.array(*[F.lit(n) for n in names]).cast("array<string>"), ended)
        reasons.append(F.when(F.size(extra) > 0, F.concat(F.lit("unknown field: "), F.array_join(extra, ", "))))
    return staged.select("seq", "kind", "_image", F.concat_ws("; ", *reasons).alias("_unfit"), *[f"`{n}`" for n in names])


def _typed(text: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        # TINYINT(1) arrives as a number: 0 is false, every other number true.
        return F.coalesce(text.try_cast(kind), text.try_cast("long") != 0)
    if isinstance(kind, T.TimestampType):
        millis = F.timestamp_millis(F.when(text.rlike(r"^-?\d{1,18}$"), text).cast("long"))
        return F.coalesce(normalize_time(text)["ts"], millis, F.try_to_timestamp(text))
    if isinstance(kind, T.BinaryType):
        return F.unbase64(text)
    return text.try_cast(kind)


def _follow_schema_record(plan: _TableBatch, seq: int, record: dict) -> None:
    """Moves the planned schema to the column list of one schema record."""
    changes = record.get("tableChanges") or []
    if not changes:
        return
    change = changes[0]
    if change.get("type") == "DROP":
        plan.schema, plan.dropped, plan.floor_seq = None, True, max(plan.floor_seq, seq)
        return
    listed = (change.get("table") or {}).get("columns") or []
    columns = [(c["name"], _declared(c)) for c in listed if c.get("name")]
    if not columns:
        return
    if plan.schema is None:
        key = (change.get("table") or {}).get("primaryKeyColumnNames") or []
        plan.schema = Schema.of([(n, t or "STRING") for n, t in columns], key)
        return
    schema = plan.schema.copy()
    for old, new, old2, new2 in RENAME.findall(record.get("ddl") or ""):
        if (old or old2) != (new or new2):
            schema.rename(old or old2, new or new2, seq)
    names = [n for n, _ in columns]
    for column in [c["name"] for c in schema.columns]:
        if column not in names:
            schema.drop(column, seq)
    previous = None
    for name, kind in columns:
        if schema.find(name) is None:
            schema.add(name, kind or "STRING", seq, after=previous)
        elif kind:
            schema.retype(name, kind)
        previous = name
    plan.schema = schema


def _follow_shape(plan: _TableBatch, low: int, high: int, fields: list[dict], key: list[str]) -> None:
    """Moves the planned schema to the fields that records from ``low`` to ``high`` declare.

    New fields become columns, types are widened, never narrowed; a field that is missing leaves its column empty in
    those rows. A field that cannot be a column sets aside the rows that have it.
    """
    typed = [(f["field"], *declared_column(f.get("type"), f.get("name"), f.get("parameters"))) for f in fields]
    if plan.dropped or not typed:
        return
    if plan.schema is None:
        names = [n for n, *_ in typed]
        plan.schema = Schema.of([(n, t) for n, t, _ in typed], [k for k in key or [] if k in names])
    schema = plan.schema.copy()
    for name, kind, encoding in typed:
        column, ended = schema.find(name), schema.ended().get(name)
        if column is None:
            if ended is not None and high < ended:
                continue  # rows from before the column was dropped
            if not IDENTIFIER.fullmatch(name):
                plan.strict = True
                continue
            schema.add(name, kind, ended or 0)
            column = schema.find(name)
        was = column.get("encoding", "text"), column.get("encoded_as", column["type"])
        if is_wider(spark_type(kind), spark_type(column["type"])):
            schema.retype(name, kind)
        now = (encoding, kind if encoding != "text" else column["type"])
        if was[0] != "text" and was != now:
            column.setdefault("encodings", []).append({"until_seq": low, "encoding": was[0], "type": was[1]})
        if encoding != "text" or was[0] != "text":
            column["encoding"], column["encoded_as"] = now
    plan.schema = schema


def _declared(column: dict) -> str | None:
    """The declared type of a listed column, with length and scale."""
    name = column.get("typeExpression") or column.get("typeName")
    if not name or "(" in name or column.get("length") is None:
        return name
    scale = f",{column['scale']}" if column.get("scale") is not None else ""
    return f"{name}({column['length']}{scale})"
