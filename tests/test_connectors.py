"""Statements, options and generated records of sources and sinks."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.plans.keyed_table import check_identifier
from tideline.sinks import jdbc as jdbc_sink
from tideline.sinks import messages
from tideline.sources import jdbc, streams


def test_catalog_rows_become_tables():
    rows = [
        {"table_name": "card", "column_name": c, "column_type": t, "ordinal_position": i, "key_position": k}
        for i, (c, t, k) in enumerate([("level", "varchar(10)", 2), ("no", "bigint", 1), ("note", "text", None)])
    ]
    rows.append({"table_name": "log", "column_name": "m", "column_type": "text", "ordinal_position": 1, "key_position": None})
    card, log = jdbc.tables_of(rows, "shop")
    assert card.key == ("no", "level") and [c for c, _ in card.columns] == ["level", "no", "note"]
    assert log.key == ()
    assert "IN ('users', 'orders')" in jdbc.catalog_query("shop", ["users", " orders"])
    with pytest.raises(ValueError):
        jdbc.catalog_query("shop' OR 1=1")


def test_statements(spark):
    columns = jdbc_sink.map_column_types(spark, [("id", "bigint"), ("name", "varchar"), ("at", "TIMESTAMP(3)")])
    assert columns == [("id", "BIGINT"), ("name", "varchar(255)"), ("at", "TIMESTAMP(6)")]
    assert jdbc_sink.create_table_sql("sink_t", columns, ["id", "name"]) == (
        "CREATE TABLE IF NOT EXISTS `sink_t` (`id` BIGINT, `name` varchar(255), "
        "`at` TIMESTAMP(6) DEFAULT '1970-01-01 09:00:00', PRIMARY KEY (`id`, `name`))"
    )
    assert jdbc_sink.create_table_sql("t", [("a", "INT")]) == "CREATE TABLE IF NOT EXISTS `t` (`a` INT)"
    for bad in ["t`; DROP", "", "x" * 65]:
        with pytest.raises(ValueError):
            jdbc_sink.create_table_sql(bad, columns)
    assert jdbc_sink.upsert_sql("t", "s", ["id", "v"], ["id"]) == (
        "INSERT INTO `t` (`id`, `v`) SELECT `id`, `v` FROM `s` WHERE `_deleted` = 0 ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)"
    )
    assert "DUPLICATE" not in jdbc_sink.upsert_sql("t", "s", ["id", "v"], [])
    assert jdbc_sink.delete_sql("t", "s", ["a", "b"]).endswith("ON t.`a` = s.`a` AND t.`b` = s.`b` WHERE s.`_deleted` = 1")
    assert jdbc_sink.alter_table_sql("t", "rename", "a", "b") == "ALTER TABLE `t` RENAME COLUMN `a` TO `b`"
    assert jdbc_sink.alter_table_sql("t", "add", "a", "INT") == "ALTER TABLE `t` ADD COLUMN `a` INT"
    assert check_identifier("a_1") == "a_1"


def test_message_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "Ann", None)], "id int, name string, email string")
    row = messages.keyed_json(df, ["id"]).first()
    assert (row["key"], row["value"]) == ('{"id":1}', '{"id":1,"name":"Ann","op":"c"}')
    docs = spark.createDataFrame([(7, '{"a":1}'), (8, '{"a":2}')], "id int, j string")
    messages.write_bulk(docs.coalesce(1), str(tmp_path / "bulk"), "idx", "j", "id")
    lines = [r["value"] for r in spark.read.text(str(tmp_path / "bulk")).collect()]
    assert [json.loads(x) for x in lines] == [
        {"index": {"_index": "idx", "_id": "7"}}, {"a": 1}, {"index": {"_index": "idx", "_id": "8"}}, {"a": 2}]


def test_json_stream_sink_and_changelog_source(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text(json.dumps({"seq": 1, "value": "{}", "key": ["id"]}))
    stream = streams.read_changelog(spark, str(tmp_path / "in"))
    messages.write_stream(stream.select("value"), str(tmp_path / "cp"), str(tmp_path / "out")).awaitTermination(60)
    assert spark.read.json(str(tmp_path / "out")).count() == 1
    assert streams.read_changelog(spark, str(tmp_path / "in"), stream=False).first()["key"] == ["id"]


def test_kafka_options_and_keys(spark):
    options = streams.kafka_options("h:1", "t", "latest", "g")
    assert options == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "latest", "kafka.group.id": "g"}
    keys = spark.createDataFrame([('{"id":1,"b":2}',), ('{"schema":{},"payload":{"id":1}}',), (None,)], "k string")
    assert [r[0] for r in keys.select(streams.key_columns(F.col("k"))).collect()] == [["id", "b"], ["id"], None]


def test_generated_orders(spark):
    ticks = spark.range(1000).select(F.col("id").alias("value"), F.current_timestamp().alias("timestamp"))
    row = streams.orders_of(ticks).agg(
        F.min("amount"), F.max("amount"), F.min(F.length("order_id")), F.max(F.length("order_id"))).first()
    assert 10 <= row[0] and row[1] <= 1000 and (row[2], row[3]) == (8, 8)
    assert streams.rate_orders(spark).isStreaming
