"""Small samples with results worked out by hand."""

import pytest
from pyspark.sql import functions as F

from tideline.functions import documents, text, types
from tideline.operators import changelog, enrich, joins, patterns, routing, running, windows


def values(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def at(df, column="ms"):
    return df.withColumn("ts", F.timestamp_millis(column))


LINE = "hello,nihao,nihao,world,bigdata,hadoop,hive,hive,hello,big"


def test_word_count_and_running_form(spark):
    words = text.tokenize(spark.createDataFrame([(1, LINE)], "id int, line string"), "line")
    assert dict(values(running.count_by(words, ["word"]))) == {
        "hello": 2, "nihao": 2, "hive": 2, "world": 1, "bigdata": 1, "hadoop": 1, "big": 1}
    numbered = words.withColumn("seq", F.monotonically_increasing_id())
    out = values(running.running_count(numbered, ["word"], ["seq"]), "word", "n")
    assert len(out) == 10 and ("hive", 1) in out and ("hive", 2) in out


def test_side_output(spark):
    words = text.tokenize(spark.createDataFrame([(LINE + ",null,null",)], "line string"), "line")
    routed = routing.route(words, {"hello": F.col("word") == "hello"})
    assert values(routed.groupBy("tag").count().orderBy("tag")) == [("hello", 2), ("main", 10)]


def test_split_table(spark):
    df = spark.createDataFrame([(1, "8z!8k1!80"), (2, None), (3, "a!!"), (4, "!!"), (5, "")], "id int, s string")
    want = [(1, "8z"), (1, "8k1"), (1, "80"), (2, ""), (3, "a"), (5, "")]
    assert values(text.split_table(df, "s", "!"), "id", "word") == want
    text.register_split_table(spark)
    df.createOrReplaceTempView("split_input")
    assert values(spark.sql("SELECT id, word FROM split_input, LATERAL split_table(s, '!')")) == want


def test_dead_letters(spark):
    lines = ["100,Alice,alice@test.com", "invalid_data", "200,Bob,bob@test.com", ",,",
             "300,Charlie,charlie@test.com", "abc,def,ghi"]
    out = routing.validate_csv(spark.createDataFrame([(x,) for x in lines], "line string"), "line")
    assert [m for ok, m in values(out, "is_valid", "message") if ok] == [
        f"VALID: {x}" for x in (lines[0], lines[2], lines[4])]
    assert [m for ok, m in values(out, "is_valid", "message") if not ok] == [
        "DLQ: invalid_data [ERROR: Invalid format]", "DLQ: ,, [ERROR: Invalid format]",
        'DLQ: abc,def,ghi [ERROR: For input string: "abc"]']


def test_deduplication(spark):
    rows = [("user_1", "login", 1, 0), ("user_1", "click", 2, 1), ("user_1", "login", 3, 2), ("user_2", "click", 4, 3),
            ("user_2", "login", 5, 4), ("user_1", "logout", 6, 5)]
    df = spark.createDataFrame(rows, "user string, kind string, id int, t int")
    assert sorted(values(running.latest_per_key(df, ["user"], ["t", "id"]))) == [
        ("user_1", "logout", 6, 5), ("user_2", "login", 5, 4)]


def test_lookup_and_versions(spark):
    orders = spark.createDataFrame([("o1", "p1", 2, 10), ("o2", "p2", 1, 20), ("o3", "p1", 3, 30)],
                                   "order_id string, product string, amount int, t int")
    prices = spark.createDataFrame([("p1", "999.00"), ("p2", "2999.00"), ("p3", "299.00")], "id string, price string")
    out = joins.lookup_join(orders, prices, "product", "id")
    total = (F.col("amount") * F.col("price").cast("decimal(10,2)")).cast("string")
    assert sorted(values(out, "order_id", total)) == [("o1", "1998.00"), ("o2", "2999.00"), ("o3", "2997.00")]
    versions = spark.createDataFrame([("p1", 0, 1), ("p1", 30, 2), ("p2", 21, 3)], "product string, from int, v int")
    asof = joins.asof_join(orders.withColumn("tie", F.lit(0)), versions.withColumn("tie", F.lit(0)),
                           ["product"], "t", "from", ["v"], "tie", keep_unmatched=True)
    assert sorted(values(asof, "order_id", "v"), key=str) == [("o1", 1), ("o2", None), ("o3", 2)]
    strict = joins.asof_join(orders.withColumn("tie", F.lit(0)), versions.withColumn("tie", F.lit(0)),
                             ["product"], "t", "from", ["v"], "tie", strict=True)
    assert sorted(values(strict, "order_id", "v")) == [("o1", 1), ("o3", 1)]


def test_window_join(spark):
    orders = at(spark.createDataFrame(
        [("user_1", "order_1", 1000), ("user_2", "order_2", 2000), ("user_1", "order_3", 3000), ("user_3", "order_4", 4000)],
        "user string, order string, ms long"))
    pays = spark.createDataFrame(
        [("user_1", "pay_1", 1500), ("user_2", "pay_2", 2500), ("user_1", "pay_3", 3500)],
        "user string, pay string, ms long").withColumn("paid", F.timestamp_millis("ms")).drop("ms")
    out = joins.window_join(orders, pays, "user", "ts", "paid", "5 seconds")
    assert sorted(values(out, "order", "pay")) == [
        ("order_1", "pay_1"), ("order_1", "pay_3"), ("order_2", "pay_2"), ("order_3", "pay_1"), ("order_3", "pay_3")]


@pytest.mark.parametrize("max_inline", [500, 0])
def test_rules(spark, max_inline):
    updates = spark.createDataFrame([(1, "rule_1", "error"), (2, "rule_2", "warning"), (3, "rule_1", "critical")],
                                    "seq int, rule_id string, pattern string")
    messages = spark.createDataFrame(
        [(1, "user_1", "error: connection failed"), (2, "user_2", "info: login success"),
         (3, "user_3", "WARNING: disk low"), (4, "user_1", "critical: system crash")], "id int, user string, m string")
    out = joins.match_rules(messages, joins.latest_rules(updates), "m", max_inline=max_inline)
    assert sorted(values(out, "user", "rule_id")) == [("user_1", "rule_1"), ("user_3", "rule_2")]


@pytest.mark.parametrize("max_inline", [500, 0])
def test_rules_of_all_lengths(spark, max_inline):
    patterns_ = ["", "a", "ab", "abcdefgh", "abcdefghi", "😀x", "zz", ".*", "b\nc"]
    rules = spark.createDataFrame(list(enumerate(patterns_)), "rule_id int, pattern string")
    texts = ["", "a", "xab", "ABCDEFGHI", "abcdefgh", "y😀x", "zzz", "a.*b", "ab\ncd"]
    messages = spark.createDataFrame(list(enumerate(texts)), "id int, m string")
    out = joins.match_rules(messages, rules, "m", max_inline=max_inline)
    want = [(i, r) for i, t in enumerate(texts) for r, p in enumerate(patterns_) if p in t.lower()]
    assert sorted(values(out, "id", "rule_id")) == want


def test_threshold_alerts(spark):
    data = spark.createDataFrame([("user_1", 3, 100.0), ("user_2", 4, 200.0), ("user_1", 5, 150.0)], "k string, seq int, v double")
    conf = spark.createDataFrame([("user_1", 1, 120.0), ("user_2", 2, 250.0)], "k string, seq int, t double")
    out = joins.threshold_alerts(data, conf, "k", "seq", "v", "t")
    assert values(out.select(joins.alert_message("k", "v", "t"))) == [
        ("ALERT: user_1 value 150.0 exceeds threshold 120.0",)]


def test_repeated_logins(spark):
    rows = [("user_1", "fail", 1000), ("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "ok", 4000),
            ("user_3", "fail", 5000), ("user_3", "fail", 6000)]
    df = at(spark.createDataFrame(rows, "user string, action string, ms long"))
    out = patterns.repeated_events(df, ["user"], "ts", "ms", F.col("action") == "fail", 3, "10 seconds")
    assert values(out, "user", "ms") == [("user_1", 1000)]
    wide = at(spark.createDataFrame([("u", "fail", t) for t in (0, 5000, 10_000)], "user string, action string, ms long"))
    assert values(patterns.repeated_events(wide, ["user"], "ts", "ms", F.col("action") == "fail", 3, "10 seconds")) == []


def test_late_data(spark):
    rows = [(1, 100, 1000), (2, 200, 2000), (3, 150, 3000), (4, 300, 8000), (5, 250, 9000), (6, 50, 1500), (7, 60, 2500), (8, 70, 500)]
    df = at(spark.createDataFrame(rows, "seq int, amount int, ms long"))
    marked = windows.mark_late(df, "ts", "seq", "10 seconds", "5 seconds", "5 seconds")
    assert windows.late_rows(marked).count() == 0
    out = windows.late_window_agg(marked, {"n": F.count(F.lit(1)), "total": F.sum("amount")})
    assert values(out, F.unix_millis("window_start"), F.unix_millis("window_end"), "n", "total") == [(0, 10_000, 8, 1180)]


def test_order_timeout(spark):
    rows = [("order_1", "create", 1000), ("order_2", "create", 2000), ("order_1", "pay", 5000), ("order_3", "create", 3000),
            ("order_2", "pay", 8000), ("order_4", "create", 4000), ("order_4", "cancel", 6000)]
    df = at(spark.createDataFrame(rows, "o string, action string, ms long"))
    out = patterns.order_timeouts(df, ["o"], "ts", "ms", "action", "10 seconds")
    assert values(out.where("status = 'TIMEOUT'"), "o", F.unix_millis("at")) == [("order_3", 13_000)]
    assert out.count() == 8


SENSORS = [("sensor_1", 10), ("sensor_1", 20), ("sensor_2", 30), ("sensor_1", 15), ("sensor_2", 25), ("sensor_1", 5),
           ("sensor_2", 40), ("sensor_1", 12), ("sensor_2", 35), ("sensor_1", 8)]


def test_running_state(spark):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(SENSORS)], "seq int, k string, v long")
    last = lambda d: {r["k"]: r for r in running.latest_per_key(d, ["k"], ["seq"]).collect()}
    stats = last(running.running_stats(df.where("seq < 7"), ["k"], ["seq"], "v"))
    assert (stats["sensor_1"]["count"], stats["sensor_1"]["sum"], stats["sensor_1"]["avg"]) == (4, 50, 12.5)
    assert (stats["sensor_2"]["count"], stats["sensor_2"]["sum"], round(stats["sensor_2"]["avg"], 2)) == (3, 95, 31.67)
    recent = last(running.recent_values(df, ["k"], ["seq"], "v", 5))
    assert recent["sensor_1"]["recent"] == [20, 15, 5, 12, 8] and recent["sensor_2"]["recent"] == [30, 25, 40, 35]
    assert {k: r["n"] for k, r in last(running.running_count(df, ["k"], ["seq"])).items()} == {"sensor_1": 6, "sensor_2": 4}
    assert {k: r["total"] for k, r in last(running.running_sum(df, ["k"], ["seq"], "v")).items()} == {"sensor_1": 70, "sensor_2": 130}


def test_top_n(spark):
    rows = [("sensor_1", 10.0), ("sensor_2", 20.0), ("sensor_1", 15.0), ("sensor_3", 30.0), ("sensor_2", 25.0),
            ("sensor_1", 12.0), ("sensor_3", 35.0), ("sensor_2", 22.0), ("sensor_1", 18.0), ("sensor_3", 28.0)]
    df = spark.createDataFrame(rows, "k string, v double").withColumn("ts", F.timestamp_millis(F.lit(1000)))
    sums = windows.window_agg(df, "ts", "10 seconds", {"total": F.sum("v")}, ["k"])
    lines = [("#1 sensor_3: 93.00",), ("#2 sensor_2: 67.00",), ("#3 sensor_1: 55.00",)]
    for top in (windows.top_n_latest(sums, 3, "k", "total"), windows.top_n_per_window(sums, 3, "k", "total")):
        assert values(top.orderBy("rank").select(windows.rank_text("rank", "k", "total"))) == lines


def test_sessions_touch_at_the_gap(spark):
    df = at(spark.createDataFrame([(0, 1.0), (5000, 2.0), (10_001, 4.0)], "ms long, v double"))
    out = windows.session_agg(df, "ts", "5 seconds", "v")
    got = sorted(values(out, F.unix_millis("session_start"), F.unix_millis("session_end"), "n", "total"))
    assert got == [(0, 10_000, 2, 3.0), (10_001, 15_001, 1, 4.0)]


def test_regions(spark):
    df = spark.createDataFrame([("north",), ("south",), ("east",), ("west",)], "r string")
    assert values(df.select(routing.region_partition(F.col("r"), 4))) == [(0,), (1,), (2,), (3,)]
    assert values(df.limit(1).select(text.string_hash(F.lit("north")))) == [(105007365,)]
    placed = routing.partition_by_region(df, "r", 4).select("r", F.spark_partition_id())
    assert sorted(values(placed)) == [("east", 2), ("north", 0), ("south", 1), ("west", 3)]


def test_async_calls(spark):
    df = spark.createDataFrame([(f"user_{i}",) for i in (1, 2, 3, 4, 5, 1)] + [(None,)], "u string")
    out = enrich.async_enrich(df, "u", lambda v: f"enriched:{v}")
    assert sorted(values(out, "u", "result"), key=str) == sorted(
        [(f"user_{i}", f"enriched:user_{i}") for i in (1, 1, 2, 3, 4, 5)] + [(None, None)], key=str)

    def slow(value):
        import time

        time.sleep(3 if value == "user_2" else 0)
        return value

    out = enrich.async_enrich(df.where("u in ('user_1', 'user_2')"), "u", slow, timeout=1.0)
    assert set(values(out, "u", "result")) == {("user_1", "user_1"), ("user_2", "timeout:user_2")}


def test_stuck_calls_hold_up_nobody_else():
    import time

    stuck = {f"v{i}" for i in range(0, 600, 60)}
    calls = enrich.Calls(lambda v: time.sleep(30 if v in stuck else 0.001) or v.upper(), 10, 0.5)
    values_in = [f"v{i}" for i in range(600)]
    assert calls.results(values_in) == [f"timeout:{v}" if v in stuck else v.upper() for v in values_in]
    with pytest.raises(ZeroDivisionError):
        enrich.Calls(lambda v: 1 // 0, 2, 1.0).results(["a"])


def test_type_names(spark):
    pairs = {"bigint": "BIGINT", "INTEGER": "INT", "TINYINT": "INT", "VARCHAR(255)": "VARCHAR(255)", "CHAR(10)": "CHAR(10)",
             "varchar": "varchar(255)", "TEXT": "VARCHAR(1024)", "DECIMAL": "DECIMAL(10,2)", "NUMERIC": "DECIMAL(10,2)",
             "DECIMAL(8,4)": "DECIMAL(8,4)", "TIMESTAMP(3)": "TIMESTAMP(6)", "DATETIME": "DATETIME(6)",
             "DOUBLE PRECISION": "DOUBLE", "BOOL": "TINYINT(1)", "BINARY(16)": "BLOB", "ENUM": "VARCHAR(1024)"}
    df = spark.createDataFrame([(k,) for k in pairs], "type string")
    assert dict(values(types.map_types(df))) == pairs
    docs = spark.createDataFrame([("OBJECT_ID",), ("DATE_TIME",), ("DECIMAL128",), ("REGEX",)], "type string")
    assert [m for _, m in values(types.map_types(docs, target="document"))] == ["STRING", "TIMESTAMP(3)", "DECIMAL(38,18)", "STRING"]
    assert types.spark_type("BIGINT UNSIGNED").simpleString() == "decimal(20,0)"
    assert types.spark_type("DECIMAL(65,1)").simpleString() == "string"


def test_documents(spark):
    rows = ['{"name":"Alice","age":30}', '{"name":"Bob","address":{"city":"Beijing","zip":100000}}',
            '{"name":"Dave","tags":["java","scala","python"],"gone":null}']
    df = spark.createDataFrame([(r,) for r in rows], "doc string")
    flat = documents.flatten_documents(df, "doc", ["name", "age", "tags", "gone"], 0, lists="text")
    assert values(flat.drop("doc")) == [
        ("Alice", "30", None, None), ("Bob", None, None, None), ("Dave", None, "[java, scala, python]", None)]
    deep = documents.flatten_documents(df, "doc", ["name", "address.city", "address.zip", "name.first"], 1)
    assert values(deep.drop("doc"))[1] == ("Bob", "Beijing", "100000", "Bob")
    changes = spark.createDataFrame(
        [("a.b.users", "c", None, '{"x":1}'), ("a.b.users", "d", '{"x":1}', None), (None, "u", None, "{}")],
        "topic string, op string, before string, after string")
    assert values(documents.decode_document_changes(changes), "_collection", "_op") == [("users", "c"), ("unknown", "u")]
    assert documents.decode_document_changes(changes, apply_deletes=True).count() == 3


def test_increment_wraps(spark):
    df = spark.createDataFrame([(1,), (2,), (9223372036854775807,)], "v long")
    assert values(df.select(text.increment("v"))) == [(2,), (3,), (-9223372036854775808,)]


def test_index_requests_fail_on_bad_json(spark):
    good = spark.createDataFrame([('{"sensor":"s1"}',)], "j string")
    assert values(text.build_index_requests(good, "j", "i"), "request") == [('Index: i, ID: null, Source: {"sensor":"s1"}',)]
    with pytest.raises(Exception):
        text.build_index_requests(spark.createDataFrame([("{x",)], "j string"), "j", "i").collect()


def test_group_counts_follow_retractions(spark):
    rows = [(1, "insert", 1, "a"), (2, "insert", 2, "a"), (3, "update", 1, "b"), (4, "delete", 2, "a"), (5, "insert", 3, "b")]
    df = spark.createDataFrame(rows, "seq int, kind string, id int, name string")
    images = changelog.with_before_images(df, ["id"], ["name"])
    assert values(changelog.group_count(images, ["name"])) == [("b", 2)]


@pytest.mark.parametrize("max_inline", [500, 0])
def test_rules_as_of_arrival(spark, max_inline):
    updates = spark.createDataFrame([(1, "rule_1", "error"), (2, "rule_2", "warning"), (5, "rule_1", "critical")],
                                    "seq int, rule_id string, pattern string")
    messages = spark.createDataFrame(
        [(0, "u0", "error: too early"), (3, "u1", "error: failed"), (4, "u1", "critical: crash"),
         (6, "u1", "critical: crash"), (7, "u3", "Warning: error")], "seq int, user string, m string")
    out = joins.match_rules_as_of(messages, updates, "m", max_inline=max_inline)
    assert sorted(values(out, "seq", "rule_id")) == [(3, "rule_1"), (6, "rule_1"), (7, "rule_2")]
    assert values(out.where("seq = 3").select(joins.rule_message("user", "m"))) == [
        ("User u1 matched rule rule_1 (error): error: failed",)]
    assert values(joins.update_messages(updates.limit(1), "rule", "rule_id", "pattern"), "message") == [
        ("Rule updated: rule_1 -> error",)]


@pytest.mark.parametrize("max_inline", [0, 100])
def test_matches_do_not_depend_on_ids_or_on_the_way(spark, max_inline):
    """Repeated and null ids, repeated rules, rules that share their beginning, short and empty ones."""
    lead = "https://example.org/"
    rules = [(i, lead + f"page{i}") for i in range(40)] + [(1, lead + "page1"), (90, "ab"), (91, ""), (92, None), (93, "é")]
    texts = [lead.upper() + "page7 and more", lead + "page1", lead, "xaby", "", None, "x" * 30, "ÉTÉ ab", "         "]
    rows = [(n % 3 if n % 4 else None, t) for n, t in enumerate(texts * 2)]
    messages = spark.createDataFrame(rows, "id int, m string")
    out = joins.match_rules(messages, spark.createDataFrame(rules, "rule_id int, pattern string"), "m", max_inline=max_inline)
    wanted = [(i, t, r, p) for i, t in rows for r, p in set(rules) if t is not None and p is not None and p in t.lower()]
    assert sorted(values(out, "id", "m", "rule_id", "pattern"), key=str) == sorted(wanted, key=str)
