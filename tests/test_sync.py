"""Whole-database synchronisation, end to end over envelope files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tideline.plans.document_sync import Collection, DocumentSync
from tideline.plans.keyed_table import KeyedTable, Schema
from tideline.plans.sync import DatabaseSync
from tideline.sources import streams


def change(seq, op, table="users", before=None, after=None, key=("id",), db="shop"):
    value = {"op": op, "source": {"db": db, "table": table}, "before": before, "after": after}
    return seq, json.dumps(value), list(key)


def ddl(seq, columns, table="users", text="", kind="ALTER", key=("id",), db="shop"):
    listed = [{"name": n, "typeName": t} for n, t in columns]
    history = {"ddl": text, "tableChanges": [
        {"type": kind, "table": {"primaryKeyColumnNames": list(key), "columns": listed}}]}
    return seq, json.dumps({"source": {"db": db, "table": table}, "historyRecord": json.dumps(history)}), None


def batch(spark, *rows):
    return spark.createDataFrame(list(rows), "seq long, value string, key array<string>")


def rows_of(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


@pytest.fixture
def sync(spark, tmp_path):
    return DatabaseSync(spark, str(tmp_path))


def test_insert_update_delete_and_routing(spark, sync):
    sync.apply_batch(batch(
        spark,
        change(1, "r", after={"id": 1, "name": "Alice", "age": 25}),
        change(2, "c", after={"id": 2, "name": "Bob", "age": 30}),
        change(3, "c", "orders", after={"id": 7, "user_id": 1, "amount": 9.5}),
        change(4, "x", after={"id": 9}),
        (5, None, None),
    ), 0)
    assert rows_of(sync.table("shop", "users")) == [(1, "Alice", 25), (2, "Bob", 30)]
    assert rows_of(sync.table("shop", "orders")) == [(7, 1, 9.5)]
    update = batch(
        spark,
        change(6, "u", before={"id": 1}, after={"id": 1, "name": "Alice", "age": 26}),
        change(7, "d", before={"id": 2, "name": "Bob", "age": 30}),
        change(8, "c", after={"id": 2, "name": "Bob again", "age": 31}),
        change(9, "d", "orders", before={"id": 7}),
    )
    for _ in range(2):  # the second run is a replay
        sync.apply_batch(update, 1)
    assert rows_of(sync.table("shop", "users")) == [(1, "Alice", 26), (2, "Bob again", 31)]
    assert rows_of(sync.table("shop", "orders")) == []
    bad = spark.read.parquet(f"{sync.root}/_quarantine")
    assert sorted(r["reason"] for r in bad.collect()) == ["no value", "unknown op"]


def test_composite_key_and_no_key(spark, sync):
    sync.apply_batch(batch(
        spark,
        change(1, "c", "card", after={"no": 1, "level": "a", "v": "x"}, key=("no", "level")),
        change(2, "c", "card", after={"no": 1, "level": "b", "v": "y"}, key=("no", "level")),
        change(3, "d", "card", before={"no": 1, "level": "a", "v": "x"}, key=("no", "level")),
        change(4, "c", "log", after={"m": "one"}, key=()),
        change(5, "u", "log", before={"m": "one"}, after={"m": "two"}, key=()),
        change(6, "d", "log", before={"m": "one"}, key=()),
    ), 0)
    assert rows_of(sync.table("shop", "card")) == [(1, "b", "y")]
    assert rows_of(sync.table("shop", "log")) == [("one",), ("two",)]


BASE = [("id", "BIGINT"), ("product", "VARCHAR(255)"), ("amount", "DECIMAL(10,2)")]


def test_schema_changes_in_order_with_the_data(spark, sync):
    sync.apply_batch(batch(
        spark,
        ddl(1, BASE, "t", kind="CREATE"),
        change(2, "c", "t", after={"id": 1, "product": "a", "amount": "1.50"}),
        change(3, "c", "t", after={"id": 2, "product": "b", "amount": "2.50"}),
        # A column added in the middle binds by name.
        ddl(4, [BASE[0], ("discount", "DOUBLE"), *BASE[1:]], "t"),
        change(5, "c", "t", after={"id": 3, "product": "c", "amount": "3.50", "discount": 0.1}),
    ), 0)
    got = {r["id"]: r.asDict() for r in sync.table("shop", "t").read().collect()}
    assert list(got[1]) == ["id", "discount", "product", "amount"]
    assert (got[1]["discount"], got[3]["discount"], str(got[3]["amount"])) == (None, 0.1, "3.50")

    sync.apply_batch(batch(
        spark,
        ddl(6, [BASE[0], BASE[1], ("amount", "DOUBLE")], "t", "ALTER TABLE t DROP discount, MODIFY amount DOUBLE"),
        change(7, "u", "t", before={"id": 1}, after={"id": 1, "product": "a", "amount": 1.75}),
        ddl(8, BASE[:2], "t"),
        change(9, "u", "t", before={"id": 2}, after={"id": 2, "product": "bb"}),
        ddl(10, [*BASE[:2], ("amount", "DOUBLE")], "t"),
        change(11, "c", "t", after={"id": 4, "product": "d", "amount": 4.0}),
    ), 1)
    assert rows_of(sync.table("shop", "t")) == [(1, "a", None), (2, "bb", None), (3, "c", None), (4, "d", 4.0)]


def test_rename_truncate_and_drop_table(spark, sync):
    sync.apply_batch(batch(
        spark,
        ddl(1, BASE, "t", kind="CREATE"),
        change(2, "c", "t", after={"id": 1, "product": "a", "amount": "1.50"}),
    ), 0)
    sync.apply_batch(batch(
        spark,
        change(3, "c", "t", after={"id": 2, "product": "old name", "amount": "2.00"}),
        ddl(4, [BASE[0], ("title", "VARCHAR(255)"), BASE[2]], "t", "ALTER TABLE t RENAME COLUMN product TO title"),
        change(5, "c", "t", after={"id": 3, "title": "new name", "amount": "3.00"}),
    ), 1)
    assert [(r["id"], r["title"]) for r in sync.table("shop", "t").read().orderBy("id").collect()] == [
        (1, "a"), (2, "old name"), (3, "new name")]
    sync.apply_batch(batch(
        spark,
        change(6, "c", "t", after={"id": 8, "title": "gone", "amount": "1.00"}),
        change(7, "t", "t"),
        change(8, "c", "t", after={"id": 9, "title": "kept", "amount": "1.00"}),
    ), 2)
    assert [r["id"] for r in sync.table("shop", "t").read().collect()] == [9]
    sync.apply_batch(batch(spark, ddl(9, [], "t", kind="DROP")), 3)
    assert sync.table("shop", "t") is None
    sync.apply_batch(batch(
        spark, ddl(10, BASE[:2], "t", kind="CREATE"), change(11, "c", "t", after={"id": 1, "product": "z"})), 4)
    assert rows_of(sync.table("shop", "t")) == [(1, "z")]


def test_snapshot_then_stream_with_restart(spark, sync, tmp_path):
    """Snapshot rows first, then two runs of the same stream over a growing folder."""
    snapshot = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, name string")
    sync.load_snapshot("shop", "users", snapshot, [("id", "BIGINT"), ("name", "VARCHAR(100)")], ["id"])
    inbox = tmp_path / "inbox"
    inbox.mkdir()

    def put(name, *rows):
        lines = [json.dumps({"seq": s, "value": v, "key": k}) for s, v, k in rows]
        (inbox / name).write_text("\n".join(lines))

    def run():
        stream = spark.readStream.schema("seq long, value string, key array<string>").json(str(inbox))
        sync.start(stream, str(tmp_path / "checkpoint")).awaitTermination()

    put("1.json", change(10, "u", before={"id": 1}, after={"id": 1, "name": "A"}), change(11, "d", before={"id": 2}))
    run()
    assert rows_of(sync.table("shop", "users")) == [(1, "A"), (3, "c")]
    put("2.json", change(12, "c", after={"id": 4, "name": "d"}), change(13, "c", "carts", after={"id": 1, "n": 2}))
    run()
    run()
    assert rows_of(sync.table("shop", "users")) == [(1, "A"), (3, "c"), (4, "d")]
    assert rows_of(sync.table("shop", "carts")) == [(1, 2)]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_split_of_a_log_gives_the_same_table(spark, tmp_path, seed):
    rng = random.Random(seed)
    log, state = [], {}
    for seq in range(1, 80):
        key = 0 if rng.random() < 0.4 else rng.randrange(1, 9)
        op = rng.choice("cud")
        state.pop(key, None)
        if op == "d":
            log.append(change(seq, op, before={"id": key, "v": 0}))
        else:
            state[key] = seq
            log.append(change(seq, op, before={"id": key}, after={"id": key, "v": seq}))
    log.insert(0, change(0, "c", after={"id": 99, "v": 0}))
    expected = sorted([*state.items(), (99, 0)], key=str)
    cuts = sorted(rng.sample(range(1, len(log)), 3))
    sync = DatabaseSync(spark, str(tmp_path))
    for number, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(log)])):
        part = log[a:b]
        rng.shuffle(part)
        sync.apply_batch(batch(spark, *part), number)
        sync.apply_batch(batch(spark, *part), number)
    assert rows_of(sync.table("shop", "users")) == expected
    table = sync.table("shop", "users")
    table.fold()
    assert rows_of(table) == expected and len(table.state["live"]) <= 2
    assert rows_of(KeyedTable.load(spark, table.path)) == expected


def test_empty_change_set_and_truncate(spark, tmp_path):
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "INT"), ("v", "INT")], ["id"])
    empty = spark.createDataFrame([], "id int, v int, seq long, kind string")
    assert table.merge(empty, 0) and not table.merge(empty, 0)
    assert table.read().count() == 0
    table.load_snapshot(spark.range(9).selectExpr("cast(id as int) AS id", "0 AS v"))
    table.truncate()
    assert KeyedTable.load(spark, table.path).read().count() == 0
    table.drop()
    assert KeyedTable.load(spark, table.path) is None
    again = KeyedTable.create(spark, table.path, [("id", "INT"), ("v", "INT")], ["id"])
    assert again.read().count() == 0


@pytest.mark.parametrize("key", [["id"], []])
def test_folding_keeps_the_rows(spark, tmp_path, key):
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "INT"), ("v", "INT")], key, buckets=8)
    table.load_snapshot(spark.range(20_000).selectExpr("cast(id as int) AS id", "0 AS v"))
    files = lambda: {p: p.stat().st_mtime_ns for p in (tmp_path / "t/rows").rglob("*.parquet")}
    for n in range(3):
        rows = [(n, n, n + 1, "update"), (50, n, n + 1, "update"), (90 + n, 0, n + 1, "delete")]
        table.merge(spark.createDataFrame(rows, "id int, v int, seq long, kind string").coalesce(1), n)
    before, old = rows_of(table), files()
    if key:
        assert len(before) == 19_997 and (50, 2) in before and (2, 2) in before
    else:
        assert len(before) == 20_006
    table.fold()  # small changes become one change set, the large rest is not rewritten
    assert len(table.state["live"]) == 2 and all(files().get(p) == t for p, t in old.items())
    assert rows_of(table) == before and rows_of(KeyedTable.load(spark, table.path)) == before
    # An attempt that failed before its registry row is overwritten by the next one.
    junk = spark.createDataFrame([(7, 7, 99, "update")], "id int, v int, seq long, kind string")
    table._write(junk.withColumns({"_seq": F.col("seq"), "_deleted": F.lit(False)}), table.schema, table.state["generation"])
    assert rows_of(KeyedTable.load(spark, table.path)) == before
    table.fold(every=True)
    assert len(table.state["live"]) == 1 and rows_of(KeyedTable.load(spark, table.path)) == before
    table.fold(every=True)
    assert len(list((tmp_path / "t/rows").iterdir())) == 2 and rows_of(table) == before


CHANGES = [(100, 1, 7, "update"), (100, 2, 0, "delete"), (50, 1, 3, "update"), (50, 2, 3, "update"), (70, 3, 1, "insert"),
           (20, 3, 0, "delete"), (120, 4, 4, "insert"), (90, 4, 2, "insert"), (110, 4, 0, "delete")]


@pytest.mark.parametrize("seed", range(4))
def test_neither_order_nor_folds_change_the_result(spark, tmp_path, seed):
    """The highest sequence of each key counts: late changes lose to the base and to tombstones."""
    rng = random.Random(seed)
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "INT"), ("v", "INT")], ["id"], buckets=2)
    table.load_snapshot(spark.createDataFrame([(1, 0), (2, 0), (9, 9)], "id int, v int"))
    for n, (seq, key, v, kind) in enumerate(rng.sample(CHANGES, len(CHANGES))):
        table.merge(spark.createDataFrame([(key, v, seq, kind)], "id int, v int, seq long, kind string"), n)
        if rng.random() < 0.5:
            table.fold(mark=20, every=rng.random() < 0.5)
    assert rows_of(table) == [(1, 7), (3, 1), (4, 4), (9, 9)]
    table.fold(mark=101, every=True)  # nothing before 101 comes any more: the tombstone at 100 goes
    stored = table._stored(table.state["live"], table.schema)
    assert stored.where("_deleted").count() == 0 and rows_of(table) == [(1, 7), (3, 1), (4, 4), (9, 9)]


def test_rows_before_a_truncation_stay_away(spark, tmp_path):
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "INT"), ("v", "INT")], ["id"], buckets=2)
    row = lambda *r: spark.createDataFrame([r], "id int, v int, seq long, kind string")
    table.merge(row(1, 1, 10, "insert"), 0)
    table.merge(row(2, 2, 30, "insert"), 1, truncate=20)
    table.merge(row(3, 3, 15, "insert"), 2)
    assert rows_of(table) == [(2, 2)]
    table.fold(every=True)
    table.merge(row(4, 4, 19, "insert"), 3)
    assert rows_of(table) == [(2, 2)]


def test_a_read_joins_its_buckets_without_an_exchange(spark, tmp_path):
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "INT"), ("v", "INT")], ["id"], buckets=4)
    for n in range(3):
        rows = spark.range(50).selectExpr("cast(id as int) AS id", "1 AS v", f"{n}L AS seq", "'update' AS kind")
        table.merge(rows, n)
    plan = KeyedTable.load(spark, table.path).read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan


def test_a_retyped_key_keeps_its_rows(spark, tmp_path):
    table = KeyedTable.create(spark, f"{tmp_path}/t", [("id", "DECIMAL(8,1)"), ("v", "INT")], ["id"])
    table.load_snapshot(spark.range(20).selectExpr("cast(id as decimal(8,1)) AS id", "0 AS v"))
    table.evolve(lambda s: s.retype("id", "DECIMAL(10,3)"))
    change = spark.createDataFrame([(5, 1, 9, "update"), (6, 1, 9, "delete")], "id int, v int, seq long, kind string")
    table.merge(change, 0)
    assert [(int(i), v) for i, v in sorted(rows_of(table))] == [(i, int(i == 5)) for i in range(20) if i != 6]


def test_schema_rules():
    schema = Schema.of([("id", "INT"), ("a", "INT")], ["id"])
    before = schema.copy().as_dict()
    schema.add("a", "INT"), schema.drop("missing"), schema.retype("a", "INTEGER"), schema.rename("x", "y")
    assert schema.as_dict() == before
    for bad in ["a b", "", "a;drop", "a`b"]:
        with pytest.raises(ValueError):
            Schema.of([("id", "INT"), (bad, "INT")], ["id"])
    with pytest.raises(ValueError):
        Schema.of([("id", "INT")], ["other"])
    with pytest.raises(ValueError):
        schema.drop("id")
    schema.rename("id", "key")
    assert schema.key == ["key"]


@pytest.mark.parametrize("apply_deletes", [False, True])
def test_documents_become_a_flat_table(spark, tmp_path, apply_deletes):
    fields = (("_id", "STRING"), ("name", "STRING"), ("address.city", "STRING"), ("age", "BIGINT"), ("tags", "STRING"))
    sync = DocumentSync(spark, str(tmp_path), [Collection("users", fields)], apply_deletes)
    records = [
        (1, "s.app.users", "c", None, '{"_id":"a","name":"Ann","address":{"city":"Rome"},"age":3,"tags":["x","y"]}'),
        (2, "s.app.users", "c", None, '{"_id":"b","name":"Bob"}'),
        (3, "s.app.users", "u", None, '{"_id":"b","name":"Bobby","age":4}'),
        (4, "s.app.other", "c", None, '{"_id":"z"}'),
        (5, "s.app.users", "d", '{"_id":"a"}', None),
    ]
    batch_ = spark.createDataFrame(records, "seq long, topic string, op string, before string, after string")
    for _ in range(2):
        sync.apply_batch(batch_, 0)
    ann = [("a", "Ann", "Rome", 3, '["x","y"]')]
    assert rows_of(KeyedTable.load(spark, sync.path("users"))) == ([] if apply_deletes else ann) + [
        ("b", "Bobby", None, 4, None)]


def quarantined(spark, sync):
    rows = spark.read.parquet(f"{sync.root}/_quarantine").collect()
    return sorted(((r["seq"], r["reason"]) for r in rows), key=str)


def test_nothing_is_lost_silently(spark, sync):
    """The types of all rows count; rows without key, table, schema or fitting values are set aside."""
    sync.apply_batch(batch(
        spark,
        change(1, "c", "pay", after={"id": 1, "amount": 5}),
        change(2, "c", "pay", after={"id": 2, "amount": 5.5}),
        change(3, "c", "pay", after={"amount": 7}),
        change(4, "c", "pay", after={"amount": 8}),
        change(5, "c", "odd-name", after={"id": 1}),
        ddl(6, [], "gone", kind="DROP"),
        change(7, "c", "gone", after={"id": 1}),
    ), 0)
    assert [(i, float(a)) for i, a in rows_of(sync.table("shop", "pay"))] == [(1, 5.0), (2, 5.5)]
    assert quarantined(spark, sync) == [(3, "no key"), (4, "no key"), (5, "invalid name"), (7, "no schema")]
    sync.apply_batch(batch(spark, change(8, "u", "pay", after={"id": 1, "amount": "many"})), 1)
    assert (8, "does not fit: amount") in quarantined(spark, sync)
    assert [(i, float(a)) for i, a in rows_of(sync.table("shop", "pay"))] == [(1, 5.0), (2, 5.5)]


def test_equal_keys_in_other_spelling_are_one_row(spark, sync):
    sync.apply_batch(batch(
        spark,
        ddl(1, [("id", "DECIMAL(10,4)"), ("v", "INT")], "d", kind="CREATE"),
        change(2, "c", "d", after={"id": "1.0", "v": 1}),
        change(3, "u", "d", after={"id": "1.0000", "v": 2}),
    ), 0)
    assert [r["v"] for r in sync.table("shop", "d").read().collect()] == [2]


def test_a_bad_schema_record_stops_its_own_table_only(spark, sync, tmp_path):
    sync.apply_batch(batch(spark, ddl(1, BASE, "t", kind="CREATE"), change(2, "c", "t", after={"id": 1, "product": "a"})), 0)
    sync.apply_batch(batch(
        spark,
        ddl(3, BASE[1:], "t"),  # without the key
        change(4, "c", "t", after={"id": 2, "product": "b"}),
        change(5, "c", "u", after={"id": 1}),
    ), 1)
    assert [r["id"] for r in sync.table("shop", "t").read().collect()] == [1]
    assert rows_of(sync.table("shop", "u")) == [(1,)]
    assert [s for s, _ in quarantined(spark, sync)] == [4]
    assert not any((tmp_path / "_staging").iterdir())


def test_patterns_choose_tables(spark, tmp_path):
    sync = DatabaseSync(spark, str(tmp_path), database="sh.*", tables="user.*|orders")
    sync.apply_batch(batch(
        spark,
        change(1, "c", "users2", after={"id": 1}), change(2, "c", "my_orders", after={"id": 1}),
        change(3, "c", "orders", after={"id": 1}), change(4, "c", "orders", after={"id": 1}, db="other"),
    ), 0)
    found = sorted(p.name for db in ("shop", "other") for p in (tmp_path / db).glob("*"))
    assert found == ["sink_orders", "sink_users2"]


def test_order_of_several_partitions(spark):
    """The source's own position orders records; offsets of more than one partition are refused."""
    def record(op, pos, wrap=False):
        value = {"op": op, "source": {"db": "shop", "table": "t", "file": "bin.000002", "pos": pos, "row": 0}}
        return json.dumps({"schema": {}, "payload": value} if wrap else value)

    raw = spark.createDataFrame(
        [('{"id":1}', record("c", 50), 0, 90), ('{"id":2}', record("t", 40, True), 1, 95), ('{"id":3}', record("c", 60), 1, 10)],
        "key string, value string, partition int, offset long",
    )
    got = streams.ordered_records(raw).orderBy("seq").collect()
    assert [r["key"] for r in got] == [["id"]] * 3 and [json.loads(r["value"]).get("op") for r in got] == [None, "c", "c"]
    with pytest.raises(Exception, match="several partitions"):
        streams.ordered_records(raw, "offset").collect()
    assert streams.ordered_records(raw.where("partition = 0"), "offset").first()["seq"] == 90


def test_records_without_a_place_are_set_aside(spark, sync):
    def record(n, **place):
        return json.dumps({"id": n}), json.dumps({"op": "c", "source": {"db": "shop", "table": "t", "ts_ms": 1, **place}, "after": {"id": n}})

    places = [{"file": "bin.000002", "pos": 4}, {"file": "bin.040000", "pos": 4, "row": 2}, {}, {"file": "bin.1", "pos": 2**40}, {"file": "x", "pos": 1}]
    raw = spark.createDataFrame([(*record(n, **p), 0, n) for n, p in enumerate(places)], "key string, value string, partition int, offset long")
    log = streams.ordered_records(raw)
    assert [r["seq"] for r in log.orderBy("value").collect() if r["seq"] is not None] == [2 << 43 | 4 << 11, 40_000 << 43 | 4 << 11 | 2]
    sync.apply_batch(log, 0)
    assert rows_of(sync.table("shop", "t")) == [(0,), (1,)]
    assert quarantined(spark, sync) == [(None, "no position")] * 3


def test_fields_that_appear_later_are_kept(spark, sync):
    """Bare and declared records bring new fields in a later batch; what can be no column is set aside by row."""
    sync.apply_batch(batch(spark, change(1, "c", "t", after={"id": 1, "a": 1})), 0)
    sync.apply_batch(batch(
        spark,
        change(2, "c", "t", after={"id": 2, "a": 2, "note": "kept"}),
        change(3, "c", "t", after={"id": 3, "odd name": 1}),
    ), 1)
    assert rows_of(sync.table("shop", "t")) == [(1, 1, None), (2, 2, "kept")]
    assert quarantined(spark, sync) == [(3, "unknown field: odd name")]
    fields = [{"field": n, "type": t} for n, t in (("id", "int64"), ("a", "int64"), ("more", "float64"))]
    value = {"schema": {"fields": [{"field": "after", "fields": fields}]},
             "payload": {"op": "u", "source": {"db": "shop", "table": "t"}, "after": {"id": 2, "a": 9, "more": 0.5}}}
    sync.apply_batch(batch(spark, (4, json.dumps(value), ["id"])), 2)
    assert rows_of(sync.table("shop", "t")) == [(1, 1, None, None), (2, 9, None, 0.5)]


def test_a_dropped_or_renamed_field_that_comes_again_is_a_new_column(spark, sync):
    sync.apply_batch(batch(
        spark, ddl(1, BASE, "t", kind="CREATE"), change(2, "c", "t", after={"id": 1, "product": "a", "amount": "1.00"})), 0)
    sync.apply_batch(batch(
        spark,
        change(3, "u", "t", after={"id": 1, "product": "b", "amount": "2.00"}),
        ddl(4, [BASE[0], ("title", "VARCHAR(255)")], "t", "ALTER TABLE t RENAME COLUMN product TO title, DROP amount"),
        change(5, "c", "t", after={"id": 2, "title": "c"}),
    ), 1)
    assert rows_of(sync.table("shop", "t")) == [(1, "b"), (2, "c")] and quarantined(spark, sync) == []
    sync.apply_batch(batch(spark, change(6, "c", "t", after={"id": 3, "title": "d", "amount": 7, "product": "p"})), 2)
    got = {r["id"]: (r["title"], r["amount"], r["product"]) for r in sync.table("shop", "t").read().collect()}
    assert got == {1: ("b", None, None), 2: ("c", None, None), 3: ("d", 7, "p")}


def test_changed_encodings_are_read_as_they_were_written(spark, sync):
    def record(seq, day, kind, name):
        fields = [{"field": "id", "type": "int64"}, {"field": "at", "type": kind, "name": name}]
        payload = {"op": "c", "source": {"db": "shop", "table": "e"}, "after": {"id": seq, "at": day}}
        return seq, json.dumps({"schema": {"fields": [{"field": "after", "fields": fields}]}, "payload": payload}), ["id"]

    millis, micros = "io.debezium.time.Timestamp", "io.debezium.time.MicroTimestamp"
    sync.apply_batch(batch(spark, record(1, 1000, "int64", millis), record(2, 2_000_000, "int64", micros)), 0)
    sync.apply_batch(batch(spark, record(3, 3_000_000, "int64", micros)), 1)
    got = sync.table("shop", "e").read().select("id", F.unix_micros("at")).collect()
    assert sorted(map(tuple, got)) == [(n, n * 1_000_000) for n in (1, 2, 3)]


def test_documents_that_cannot_be_applied_are_set_aside(spark, tmp_path):
    sync = DocumentSync(spark, str(tmp_path), [Collection("c", (("_id", "STRING"), ("n", "BIGINT")))])
    records = [(1, "t.c", "c", None, '{"_id":"a","n":2.5}'), (2, "t.c", "c", None, '{"_id":"b","n":'), (3, "t.c", "c", None, '{"n":1}'),
               (4, "t.c", "c", None, '{"_id":"d","n":4}'), (5, "t.c", "c", None, "[1]"), (6, "t.c", None, None, '{"_id":"x"}')]
    sync.apply_batch(spark.createDataFrame(records, "seq long, topic string, op string, before string, after string"), 0)
    assert rows_of(KeyedTable.load(spark, sync.path("c"))) == [("d", 4)]
    bad = spark.read.parquet(f"{sync.root}/_quarantine").collect()
    assert {r["seq"]: r["reason"] for r in bad} == {1: "does not fit: n", 2: "no JSON object", 3: "no key", 5: "no JSON object", 6: "no op"}
