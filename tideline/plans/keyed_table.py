"""Keyed tables as bucketed Parquet tables that hold every row by its sequence.

All change sets go into one table, partitioned by change set and bucketed by the key.
The current row of a key is the one with the highest sequence, wherever it lies, so
neither the order in which change sets arrive nor the moments at which they are folded
change the result. Rows of a key lie in buckets of the same number, so a read needs no
exchange. A deleted row stays as a tombstone until a fold is told that no older change
can come any more.

:meth:`KeyedTable.fold` joins the change sets to one, or everything to a new generation
when they have grown to a good part of the rest. ``registry`` has a small file for each
step: the columns, what has been applied, and the change sets that count. What a
failed step has written is overwritten by its next attempt.

Files store columns by id, never by name. Renaming, dropping, adding and
retyping columns is a projection by the registry's last file, and a column that was
dropped and added again starts empty.
"""

from __future__ import annotations

import copy
import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.types import spark_type
from tideline.operators.changelog import compact_changes
from tideline.plans import storage

SEQ = "_seq"
DELETED = "_deleted"
BATCH = "_batch"
BUCKETS = 16  # of a new table; a large one should have one for some hundred MB
FOLD_AFTER = 8  # change sets before they are folded
FOLD_SHARE = 4  # the changes are folded with all other rows once they are more than one of so many bytes
IDENTIFIER = re.compile(r"[a-zA-Z0-9_]+")


def check_identifier(name: str) -> str:
    """Names may hold letters, digits and underscores only."""
    if not name or not IDENTIFIER.fullmatch(name):
        raise ValueError(f"invalid name: {name!r}")
    return name


class Schema:
    """The columns and key of one table version; changes are idempotent."""

    def __init__(self, columns: list[dict], key: list[str], next_id: int = 1, dropped: dict[str, int] | None = None):
        self.columns, self.key, self.next_id, self.dropped = columns, key, next_id, dropped or {}

    @classmethod
    def of(cls, columns: list[tuple[str, str]], key: list[str]) -> "Schema":
        names = [name for name, _ in columns]
        for name in [*names, *key]:
            check_identifier(name)
        if len(set(names)) != len(names) or not set(key) <= set(names):
            raise ValueError("column names must be unique and include the key")
        schema = cls([], list(key))
        for name, kind in columns:
            schema.add(name, kind)
        return schema

    def find(self, name: str) -> dict | None:
        return next((c for c in self.columns if c["name"] == name), None)

    def _new_id(self) -> str:
        self.next_id += 1
        return f"c{self.next_id - 1}"

    def add(self, name: str, kind: str, seq: int = 0, after: str | None = None) -> None:
        """Adds an empty column, valid for changes from ``seq`` on."""
        if self.find(check_identifier(name)):
            return
        column = {"id": self._new_id(), "name": name, "type": kind, "older": [], "from_seq": seq, "aliases": []}
        names = [c["name"] for c in self.columns]
        place = names.index(after) + 1 if after in names else len(names)
        self.columns.insert(place, column)

    def drop(self, name: str, seq: int | None = None) -> None:
        """Drops a column; changes before ``seq`` may still carry it."""
        if name in self.key:
            raise ValueError(f"{name} is part of the key")
        if seq is not None and self.find(name):
            self.dropped[name] = seq
        self.columns = [c for c in self.columns if c["name"] != name]

    def retype(self, name: str, kind: str) -> None:
        """Changes a type; stored values are cast when read, null where they do not fit."""
        column = self.find(name)
        if column is None or spark_type(column["type"]) == spark_type(kind):
            return
        column["older"] = [column["id"], *column["older"]]
        column["id"], column["type"] = self._new_id(), kind

    def rename(self, old: str, new: str, seq: int = 0) -> None:
        """Renames a column; changes before ``seq`` still carry the old name."""
        column = self.find(old)
        if column is None or self.find(check_identifier(new)):
            return
        column["name"] = new
        column["aliases"].append({"name": old, "until_seq": seq})
        self.key = [new if k == old else k for k in self.key]

    def ended(self) -> dict[str, int]:
        """Names that columns have had, with the sequence from which they mean nothing any more."""
        renamed = {a["name"]: a["until_seq"] for c in self.columns for a in c["aliases"]}
        return {n: max(renamed.get(n, 0), self.dropped.get(n, 0)) for n in {*renamed, *self.dropped}}

    def as_dict(self) -> dict:
        return {"columns": self.columns, "key": self.key, "next_id": self.next_id, "dropped": self.dropped}

    @classmethod
    def from_dict(cls, d: dict) -> "Schema":
        return cls(copy.deepcopy(d["columns"]), list(d["key"]), d["next_id"], dict(d["dropped"]))

    def copy(self) -> "Schema":
        return Schema.from_dict(self.as_dict())


class KeyedTable:
    """One keyed table; a table without a key only appends."""

    def __init__(self, spark: SparkSession, path: str, state: dict):
        self.spark, self.path, self.state = spark, path.rstrip("/"), state

    # Life cycle

    @classmethod
    def create(
        cls, spark: SparkSession, path: str, columns: list[tuple[str, str]], key: list[str], buckets: int = BUCKETS
    ) -> "KeyedTable":
        """Creates the table if it is missing, else loads it."""
        last = cls._last(spark, path)
        if last is not None and not last["dropped"]:
            return cls(spark, path, last)
        batch = last["batch"] if last else -1
        # A dropped table's ids are not used again, nor is its generation.
        schema = Schema.of(columns, key)
        table = cls(spark, path, {"batch": batch, "types": {}, "applied": {}, "buckets": buckets})
        table._register(schema, dropped=False, generation=batch + 1, live=[], floor=None)
        return table

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "KeyedTable | None":
        """The current table, or nothing when it is missing or dropped."""
        last = cls._last(spark, path)
        return None if last is None or last["dropped"] else cls(spark, path, last)

    @classmethod
    def load_all(cls, spark: SparkSession, paths: list[str]) -> dict[str, "KeyedTable"]:
        """The current tables among ``paths``; what is known of each is a small file, so no job is needed."""
        states = cls._states(spark, paths)
        return {p: cls(spark, p, s) for p, s in states.items() if not s["dropped"]}

    @classmethod
    def _last(cls, spark: SparkSession, path: str) -> dict | None:
        return cls._states(spark, [path]).get(path)

    @staticmethod
    def _states(spark: SparkSession, paths: list[str]) -> dict[str, dict]:
        found = {}
        for path in paths:
            folder = f"{path.rstrip('/')}/registry"
            rows = [n for n in storage.list_names(spark, folder) if n.endswith(".json")]
            if rows:
                found[path] = json.loads(storage.read_text(spark, f"{folder}/{rows[-1]}"))
        return found

    def _register(self, schema: Schema | None = None, **changes) -> None:
        """Adds the registry's next entry, which makes what was written for it count."""
        state = {**self.state, **changes, "batch": self.state["batch"] + 1}
        if schema is not None:
            state["schema"] = schema.as_dict()
            state["types"] = {**state["types"], **{c["id"]: c["type"] for c in schema.columns}}
        storage.write_text(self.spark, f"{self.path}/registry/{_folder(state['batch'])}.json", json.dumps(state))
        self.state = state

    @property
    def schema(self) -> Schema:
        return Schema.from_dict(self.state["schema"])

    @property
    def key(self) -> list[str]:
        return list(self.state["schema"]["key"])

    @property
    def column_types(self) -> list[tuple[str, str]]:
        return [(c["name"], c["type"]) for c in self.state["schema"]["columns"]]

    @property
    def is_new(self) -> bool:
        """Nothing has been loaded or merged yet."""
        return not self.state["applied"] and not self.state["live"]

    # Reading

    def _table(self, schema: Schema, generation: int) -> str:
        """The catalog's name for a generation's files; the session learns of those it does not know yet."""
        types = {**self.state["types"], **{c["id"]: c["type"] for c in schema.columns}}
        listed = ", ".join(f"{i} {spark_type(t).simpleString()}" for i, t in types.items())
        place = self._rows(generation)
        name = f"tideline_{hashlib.md5(f'{place} {listed}'.encode()).hexdigest()}"
        keys = ", ".join(schema.find(k)["id"] for k in schema.key)
        layout = f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.state['buckets']} BUCKETS" if keys else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({listed}, {SEQ} BIGINT, {DELETED} BOOLEAN, {BATCH} INT) "
            f"USING parquet PARTITIONED BY ({BATCH}) {layout} LOCATION '{place}'"
        )
        return name

    def _rows(self, generation: int) -> str:
        return f"{self.path}/rows/{_folder(generation)}"

    def _stored(self, batches: list[int], schema: Schema) -> DataFrame:
        """Rows of some change sets under the current column names."""
        name = self._table(schema, self.state["generation"])
        if batches:
            parts = " ".join(f"PARTITION ({BATCH}={b})" for b in batches)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {parts}")
        raw = self.spark.table(name).where(F.col(BATCH).isin(batches))
        if self.state["floor"] is not None:
            raw = raw.where(F.col(SEQ) > self.state["floor"])
        shown = []
        for c in schema.columns:
            # A row is stored under exactly one of the ids a column has had.
            kind = spark_type(c["type"])
            parts = [F.col(c["id"]), *[F.col(i).try_cast(kind) for i in c["older"]]]
            shown.append(F.coalesce(*parts).alias(c["name"]) if len(parts) > 1 else parts[0].alias(c["name"]))
        return raw.select(*shown, SEQ, DELETED, BATCH)

    def _newest(self, batches: list[int], schema: Schema) -> DataFrame:
        """The last row of each key, deleted ones too; of equal sequences the later change set's."""
        rows = self._stored(batches, schema)
        if len(batches) > 1 and schema.key:
            rows = compact_changes(rows.withColumn("_at", F.struct(SEQ, BATCH)), schema.key, "_at").drop("_at")
        return rows

    def read(self, with_seq: bool = False) -> DataFrame:
        """The current rows."""
        schema = self.schema
        kept = [c["name"] for c in schema.columns] + ([SEQ] if with_seq else [])
        return self._newest(self.state["live"], schema).where(~F.col(DELETED)).select(*kept)

    # Writing

    def _write(self, rows: DataFrame, schema: Schema, generation: int) -> int:
        """Writes rows as the next change set, over what a failed attempt may have left, and returns its number."""
        batch = self.state["batch"] + 1
        name = self._table(schema, generation)
        stored = {c["id"]: F.col(c["name"]).cast(spark_type(c["type"])).alias(c["id"]) for c in schema.columns}
        ids = [i for i in self.spark.table(name).columns if i not in (SEQ, DELETED, BATCH)]
        rows = rows.select(*[stored.get(i, F.lit(None).alias(i)) for i in ids], SEQ, DELETED)
        if schema.key:  # one file for each bucket
            rows = rows.repartition(self.state["buckets"], *[schema.find(k)["id"] for k in schema.key])
        # A streaming batch has a session of its own, which knows the same tables.
        storage.delete_folder(self.spark, f"{self._rows(generation)}/{BATCH}={batch}")
        rows.sparkSession.sql(f"INSERT INTO {name} PARTITION ({BATCH}={batch}) SELECT * FROM {{rows}}", rows=rows)
        return batch

    def load_snapshot(self, rows: DataFrame, seq: int = 0) -> None:
        """Replaces the content with an initial load."""
        full = rows.withColumns({SEQ: F.lit(seq).cast("long"), DELETED: F.lit(False)})
        generation = self.state["batch"] + 1
        self._register(generation=generation, live=[self._write(full, self.schema, generation)], floor=None)

    def merge(
        self,
        net: DataFrame,
        batch_id: int | None = None,
        source: str = "default",
        schema: Schema | None = None,
        truncate: int | None = None,
    ) -> bool:
        """Adds a compacted change set; false when it was applied before.

        ``net`` has the table's columns plus ``seq`` and ``kind``. Batches of one
        ``source`` must come in order; one that is not newer than the last is
        skipped, so a replay changes nothing. A new ``schema`` takes effect before
        the rows. ``truncate`` is the sequence of a truncation: rows up to it don't
        count any more, be they in the table, in ``net`` or still to come.
        """
        if batch_id is not None and batch_id <= self.state["applied"].get(source, -1):
            return False
        schema = schema or self.schema
        if {c["id"] for c in schema.columns if c["name"] in schema.key} != self._key_ids():
            self.fold(every=True, schema=schema)  # a retyped key belongs to other buckets
        rows = net.withColumns({SEQ: F.col("seq").cast("long"), DELETED: F.col("kind") == "delete"})
        rows = rows if schema.key else rows.where(~F.col(DELETED))
        batch = self._write(rows, schema, self.state["generation"])
        applied = dict(self.state["applied"])
        if batch_id is not None:
            applied[source] = batch_id
        floors = [f for f in (self.state["floor"], truncate) if f is not None]
        self._register(schema, applied=applied, live=[*self.state["live"], batch], floor=max(floors, default=None))
        return True

    def evolve(self, change) -> None:
        """Applies ``change(schema)`` as one new registry row; no change, no row."""
        schema = self.schema
        change(schema)
        if schema.as_dict() != self.state["schema"]:
            if {c["id"] for c in schema.columns if c["name"] in schema.key} != self._key_ids():
                self.fold(every=True, schema=schema)
            else:
                self._register(schema)

    def _key_ids(self) -> set[str]:
        return {c["id"] for c in self.state["schema"]["columns"] if c["name"] in self.key}

    def truncate(self) -> None:
        self._register(generation=self.state["batch"] + 1, live=[])

    def drop(self) -> None:
        self._register(dropped=True)

    # Maintenance

    def maintain(self, mark: int | None = None) -> None:
        """Keeps reads cheap after merges."""
        if len(self.state["live"]) > FOLD_AFTER:
            self.fold(mark)

    def fold(self, mark: int | None = None, every: bool = False, schema: Schema | None = None) -> None:
        """Joins the change sets to one, or with all other rows to a new generation (always if ``every``).

        Changes before ``mark`` have all come: a new generation leaves out rows that were deleted before it.
        Reads that are under way go on, since what a fold replaces is deleted by the next one only.
        """
        live = self.state["live"]
        if len(live) < 2 and not every:
            return
        self._clean()
        size = {b: storage.size(self.spark, f"{self._rows(self.state['generation'])}/{BATCH}={b}") for b in live}
        every = every or sum(size[b] for b in live[1:]) * FOLD_SHARE > size[live[0]]
        new = schema or self.schema
        if not every:
            batch = self._write(self._newest(live[1:], new), new, self.state["generation"])
            self._register(new, live=[live[0], batch])
            return
        generation = self.state["batch"] + 1
        rows = self._newest(live, new)
        if mark is not None:
            rows = rows.where(~F.col(DELETED) | (F.col(SEQ) >= mark))
        batch = self._write(rows, new, generation)
        self._register(new, generation=generation, live=[batch])

    def _clean(self) -> None:
        """Deletes generations, change sets and registry rows that don't count since the last fold or before."""
        rows = self._rows(self.state["generation"])
        dead = [f"{self.path}/rows/{n}" for n in storage.list_names(self.spark, f"{self.path}/rows")]
        dead = [f for f in dead if f != rows]
        for n in storage.list_names(self.spark, rows):
            if n.startswith(f"{BATCH}=") and int(n.split("=")[1]) not in self.state["live"]:
                dead.append(f"{rows}/{n}")
        registry = f"{self.path}/registry"
        names = storage.list_names(self.spark, registry)
        dead += [f"{registry}/{n}" for n in names if n < _folder(self.state["batch"])]
        for folder in dead:
            storage.delete_folder(self.spark, folder)


def _folder(batch: int) -> str:
    return f"batch={batch:010d}"
