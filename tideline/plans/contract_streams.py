"""Contract queries over event streams: windows, running state, joins and patterns."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from tideline.operators import joins, patterns, running, windows
from tideline.operators.enrich import async_enrich
from tideline.plans.registry import cents, ms, query, table


def _aggregates():
    return {"n": F.count(F.lit(1)), "total": cents(F.sum("value"))}


@query(
    "tumble_agg",
    """
    SELECT w * 21600000 AS window_start, (w + 1) * 21600000 AS window_end,
           count(*) AS n, round(sum(value), 2) AS total
    FROM (SELECT epoch_us(ts) // 21600000000 AS w, value FROM events) GROUP BY w
    """,
)
def tumble_agg(spark, d):
    out = windows.window_agg(table(spark, d, "events"), "ts", "6 hours", _aggregates())
    return out.select(ms("window_start"), ms("window_end"), "n", "total")


@query(
    "hop_agg",
    """
    SELECT w * 21600000 AS window_start, w * 21600000 + 43200000 AS window_end,
           count(*) AS n, round(sum(value), 2) AS total
    FROM (SELECT epoch_us(ts) // 21600000000 - shift AS w, value
          FROM events, (VALUES (0), (1)) AS s(shift)) GROUP BY w
    """,
)
def hop_agg(spark, d):
    out = windows.window_agg(table(spark, d, "events"), "ts", "12 hours", _aggregates(), slide="6 hours")
    return out.select(ms("window_start"), ms("window_end"), "n", "total")


_SESSIONS = """
    WITH gaps AS (SELECT {key} epoch_us(ts) AS us, value,
                         lag(epoch_us(ts)) OVER ({part} ORDER BY ts, event_id) AS prev, ts, event_id FROM events),
         numbered AS (SELECT *, sum(CASE WHEN prev IS NULL OR us - prev > {gap} THEN 1 ELSE 0 END)
                                OVER ({part} ORDER BY ts, event_id) AS s FROM gaps)
    SELECT {key} min(us) // 1000 AS session_start, (max(us) + {gap}) // 1000 AS session_end,
           count(*) AS n, round(sum(value), 2) AS total
    FROM numbered GROUP BY {key} s
"""


@query("session_agg", _SESSIONS.format(key="", part="", gap=300_000_000))
def session_agg(spark, d):
    out = windows.session_agg(table(spark, d, "events"), "ts", "5 minutes", "value")
    return out.select(ms("session_start"), ms("session_end"), "n", cents("total").alias("total"))


@query(
    "session_agg_keyed",
    _SESSIONS.format(key="user_id,", part="PARTITION BY user_id", gap=14_400_000_000),
)
def session_agg_keyed(spark, d):
    out = windows.session_agg(table(spark, d, "events"), "ts", "4 hours", "value", ["user_id"])
    return out.select("user_id", ms("session_start"), ms("session_end"), "n", cents("total").alias("total"))


def _user_window_sums(spark, d):
    return windows.window_agg(
        table(spark, d, "events"), "ts", "6 hours", {"total": cents(F.sum("value"))}, ["user_id"]
    )


_USER_SUMS = """
    SELECT user_id, (epoch_us(ts) // 21600000000) * 21600000 AS window_start, round(sum(value), 2) AS total
    FROM events GROUP BY ALL
"""


@query("keyed_window_sum", _USER_SUMS)
def keyed_window_sum(spark, d):
    return _user_window_sums(spark, d).select("user_id", ms("window_start"), "total")


@query(
    "topn_window",
    f"""
    SELECT window_start, user_id, total, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY total DESC, user_id) AS rank
      FROM ({_USER_SUMS})) WHERE rank <= 3
    """,
)
def topn_window(spark, d):
    top = windows.top_n_per_window(_user_window_sums(spark, d), 3, "user_id", "total")
    return top.select(ms("window_start"), "user_id", "total", F.col("rank").cast("long").alias("rank"))


@query(
    "topn_latest",
    f"""
    WITH latest AS (SELECT user_id, arg_max(total, window_start) AS total FROM ({_USER_SUMS}) GROUP BY user_id),
         ranked AS (SELECT *, row_number() OVER (ORDER BY total DESC, user_id) AS rank FROM latest)
    SELECT user_id, total, printf('#%d %d: %.2f', rank, user_id, total) AS line FROM ranked WHERE rank <= 3
    """,
)
def topn_latest(spark, d):
    top = windows.top_n_latest(_user_window_sums(spark, d), 3, "user_id", "total")
    return top.select("user_id", "total", windows.rank_text("rank", "user_id", "total").alias("line"))


# Arrival order with derived disorder; it has no ties because event_id breaks them.
_ARRIVAL = "(event_id + (event_id * 7919) % 97) * 1000000 + event_id"
_LATE = f"""
    WITH seen AS (SELECT *, epoch_us(ts) AS us,
                    max(epoch_us(ts)) OVER (ORDER BY {_ARRIVAL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
                  FROM events),
         marked AS (SELECT *, us // 1800000000 AS w,
                    coalesce((us // 1800000000 + 1) * 1800000000 + 1200000000 <= top, false) AS is_late FROM seen)
"""


def _marked(spark, d):
    rows = table(spark, d, "events").withColumn("arrival", F.expr(_ARRIVAL))
    return windows.mark_late(rows, "ts", "arrival", "30 minutes", "10 minutes", "10 minutes")


@query(
    "late_window_agg",
    _LATE + """
    SELECT w * 1800000 AS window_start, count(*) AS n, round(sum(value), 2) AS total
    FROM marked WHERE NOT is_late GROUP BY w
    """,
)
def late_window_agg(spark, d):
    return windows.late_window_agg(_marked(spark, d), _aggregates()).select(ms("window_start"), "n", "total")


@query("late_rows", _LATE + "SELECT event_id, user_id, value FROM marked WHERE is_late")
def late_rows(spark, d):
    return windows.late_rows(_marked(spark, d)).select("event_id", "user_id", "value")


@query(
    "dedup_latest",
    """
    SELECT user_id, event_type, event_id, epoch_us(ts) // 1000 AS ts FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def dedup_latest(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_type", "event_id", "ts")
    return running.latest_per_key(rows, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_type", "event_id", ms("ts")
    )


@query(
    "running_count",
    "SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events",
)
def running_count(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id")
    return running.running_count(rows, ["user_id"], ["event_id"])


@query(
    "running_sum",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 2) AS total
       FROM events""",
)
def running_sum(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    out = running.running_sum(rows, ["user_id"], ["event_id"], "value")
    return out.select("event_id", "user_id", cents("total").alias("total"))


@query(
    "running_stats",
    """
    SELECT event_id, user_id, n AS count, total AS sum, total / n AS avg FROM (
      SELECT event_id, user_id, count(*) OVER w AS n, round(sum(value) OVER w, 2) AS total
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    """,
)
def running_stats(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    out = running.running_stats(rows, ["user_id"], ["event_id"], "value")
    total = cents("sum")
    return out.select("event_id", "user_id", "count", total.alias("sum"), (total / F.col("count")).alias("avg"))


@query(
    "recent_n",
    """
    SELECT event_id, user_id, array_to_string(list(value) OVER (PARTITION BY user_id ORDER BY event_id
           ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS recent FROM events
    """,
)
def recent_n(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "value")
    out = running.recent_values(rows, ["user_id"], ["event_id"], "value", 5)
    return out.select("event_id", "user_id", F.array_join("recent", ",").alias("recent"))


@query(
    "word_count_running",
    "SELECT event_id, event_type AS word, count(*) OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events",
)
def word_count_running(spark, d):
    rows = table(spark, d, "events").select("event_id", F.col("event_type").alias("word"))
    return running.running_count(rows, ["word"], ["event_id"])


@query(
    "window_join",
    """
    SELECT c.user_id, c.w * 21600000 AS window_start, c.event_id AS click_id, p.event_id AS purchase_id, p.value AS amount
    FROM (SELECT *, epoch_us(ts) // 21600000000 AS w FROM events WHERE event_type = 'click') c
    JOIN (SELECT *, epoch_us(ts) // 21600000000 AS w FROM events WHERE event_type = 'purchase') p
      ON c.user_id = p.user_id AND c.w = p.w
    """,
)
def window_join(spark, d):
    rows = table(spark, d, "events")
    clicks = rows.where(F.col("event_type") == "click").select("user_id", "ts", F.col("event_id").alias("click_id"))
    buys = rows.where(F.col("event_type") == "purchase").select(
        "user_id", F.col("ts").alias("paid_at"), F.col("event_id").alias("purchase_id"), F.col("value").alias("amount")
    )
    out = joins.window_join(clicks, buys, "user_id", "ts", "paid_at", "6 hours")
    return out.select(
        "user_id", F.unix_millis("window.start").alias("window_start"), "click_id", "purchase_id", "amount"
    )


@query(
    "lookup_join",
    """
    SELECT l_orderkey, l_partkey, l_quantity AS amount, p_name AS product_name, p_retailprice AS price,
           round(l_quantity * p_retailprice, 2) AS total_price
    FROM lineitem JOIN part ON l_partkey = p_partkey
    """,
)
def lookup_join(spark, d):
    facts = table(spark, d, "lineitem").select("l_orderkey", "l_partkey", F.col("l_quantity").alias("amount"))
    parts = table(spark, d, "part").select(
        "p_partkey", F.col("p_name").alias("product_name"), F.col("p_retailprice").alias("price")
    )
    out = joins.lookup_join(facts, parts, "l_partkey", "p_partkey")
    return out.withColumn("total_price", cents(F.col("amount") * F.col("price")))


@query(
    "asof_join",
    """
    SELECT p.event_id, p.user_id, p.value AS amount, v.event_id AS view_id, v.value AS view_value
    FROM (SELECT * FROM events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM events WHERE event_type = 'view') v
      ON p.user_id = v.user_id AND p.ts >= v.ts
    """,
)
def asof_join(spark, d):
    rows = table(spark, d, "events")
    buys = rows.where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", "ts", F.col("value").alias("amount")
    )
    views = rows.where(F.col("event_type") == "view").select(
        "event_id", "user_id", "ts", F.col("event_id").alias("view_id"), F.col("value").alias("view_value")
    )
    out = joins.asof_join(buys, views, ["user_id"], "ts", "ts", ["view_id", "view_value"], "event_id")
    return out.drop("ts")


@query(
    "coprocess_alert",
    """
    SELECT event_id, user_id, value, threshold FROM (
      SELECT event_id, user_id, event_type, value,
             last_value(CASE WHEN event_type = 'signup' THEN value END IGNORE NULLS)
               OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS threshold
      FROM events)
    WHERE event_type <> 'signup' AND value > threshold
    """,
)
def coprocess_alert(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    config = rows.where(F.col("event_type") == "signup").withColumnRenamed("value", "threshold")
    data = rows.where(F.col("event_type") != "signup").drop("event_type")
    out = joins.threshold_alerts(data, config, "user_id", "event_id", "value", "threshold")
    return out.select("event_id", "user_id", "value", "threshold")


@query(
    "cep_times",
    """
    SELECT user_id, event_id, match_end FROM (
      SELECT user_id, event_id, epoch_us(ts) AS us,
             lead(epoch_us(ts), 2) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS us_end, us_end // 1000 AS match_end
      FROM events WHERE event_type = 'error')
    WHERE us_end - us < 86400000000
    """,
)
def cep_times(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    out = patterns.repeated_events(
        rows, ["user_id"], "ts", "event_id", F.col("event_type") == "error", 3, "24 hours"
    )
    return out.select("user_id", "event_id", ms("match_end"))


@query(
    "cep_consecutive",
    """
    SELECT user_id, event_id, match_end FROM (
      SELECT user_id, event_id, event_type, epoch_us(ts) AS us, lead(event_type, 1) OVER w AS second,
             lead(event_type, 2) OVER w AS third, lead(epoch_us(ts), 2) OVER w AS us_end, us_end // 1000 AS match_end
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'error' AND second = 'error' AND third = 'error' AND us_end - us < 86400000000
    """,
)
def cep_consecutive(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    out = patterns.repeated_events(
        rows, ["user_id"], "ts", "event_id", F.col("event_type") == "error", 3, "24 hours", consecutive=True
    )
    return out.select("user_id", "event_id", ms("match_end"))


@query(
    "inactivity_gaps",
    """
    SELECT user_id, event_id, (us + 43200000000) // 1000 AS timeout_at FROM (
      SELECT user_id, event_id, epoch_us(ts) AS us,
             lead(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nxt FROM events)
    WHERE nxt IS NULL OR nxt - us > 43200000000
    """,
)
def inactivity_gaps(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts")
    out = patterns.inactivity_gaps(rows, ["user_id"], "ts", "event_id", "12 hours")
    return out.select("user_id", "event_id", ms("timeout_at"))


@query(
    "ttl_session_count",
    """
    WITH flagged AS (SELECT event_id, user_id, ts,
           CASE WHEN lag(epoch_us(ts)) OVER w IS NULL OR epoch_us(ts) - lag(epoch_us(ts)) OVER w >= 21600000000
                THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
         numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM flagged)
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, s ORDER BY ts, event_id) AS session_count
    FROM numbered
    """,
)
def ttl_session_count(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", "ts")
    return windows.ttl_session_count(rows, ["user_id"], "ts", ["ts", "event_id"], "6 hours").drop("ts")


@query(
    "order_timeout",
    """
    WITH acts AS (SELECT user_id, event_id, epoch_us(ts) AS us,
                    CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'pay' ELSE 'cancel' END AS action
                  FROM events WHERE event_type IN ('signup', 'purchase', 'error')),
         nexts AS (SELECT *, lead(us) OVER w AS next_us, lead(action) OVER w AS next_action
                   FROM acts WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)),
         timers AS (SELECT user_id, event_id, us + 43200000000 AS due FROM nexts
                    WHERE action = 'create'
                      AND NOT coalesce(next_action <> 'create' AND next_us <= us + 43200000000, false)),
         fired AS (SELECT t.user_id, t.event_id, t.due
                   FROM timers t ASOF JOIN (SELECT * FROM acts WHERE action <> 'cancel') a
                     ON t.user_id = a.user_id AND t.due >= a.us
                   WHERE a.action = 'create')
    SELECT user_id, event_id, us // 1000 AS at,
           CASE action WHEN 'create' THEN 'created' WHEN 'pay' THEN 'paid' ELSE 'cancelled' END AS status FROM acts
    UNION ALL SELECT user_id, event_id, due // 1000, 'TIMEOUT' FROM fired
    """,
)
def order_timeout(spark, d):
    action = (
        F.when(F.col("event_type") == "signup", "create")
        .when(F.col("event_type") == "purchase", "pay")
        .when(F.col("event_type") == "error", "cancel")
    )
    rows = table(spark, d, "events").withColumn("action", action)
    out = patterns.order_timeouts(rows, ["user_id"], "ts", "event_id", "action", "12 hours")
    return out.select("user_id", "event_id", ms("at"), "status")


@query(
    "async_enrich",
    """
    SELECT c_custkey, c_mktsegment, 'enriched:' || c_mktsegment AS result FROM customer
    """,
)
def async_enrich_query(spark, d):
    rows = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return async_enrich(rows, "c_mktsegment", lambda value: f"enriched:{value}")


def _slow_call(value):
    """Every hundredth customer's answer takes far longer than anybody waits."""
    if int(value) % 100 == 0:
        time.sleep(20)
    return f"answer:{value}"


@query(
    "async_enrich_slow",
    """
    SELECT o_custkey, (CASE WHEN o_custkey % 100 = 0 THEN 'timeout:' ELSE 'answer:' END) || o_custkey AS result
    FROM (SELECT DISTINCT o_custkey FROM orders)
    """,
)
def async_enrich_slow(spark, d):
    keys = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("o_custkey")).distinct()
    found = async_enrich(keys, "o_custkey", _slow_call, timeout=1.0, threads=64)
    return found.select(F.col("o_custkey").cast("long").alias("o_custkey"), "result")


@query(
    "cep_sequence",
    """
    SELECT user_id, event_id, us_end // 1000 AS match_end FROM (
      SELECT *, lead(us_bought) OVER w AS us_end, lead(event_type) OVER w AS follower FROM (
        SELECT user_id, event_id, event_type, ts, epoch_us(ts) AS us,
               min(CASE WHEN event_type = 'purchase' THEN epoch_us(ts) END) OVER (
                   PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS us_bought
        FROM events)
      WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
    WHERE event_type = 'view' AND follower = 'click' AND us_end - us < 172800000000
    """,
)
def cep_sequence(spark, d):
    """A view, a click as the very next event, and a purchase after it, in less than two days."""
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", "event_type")
    is_a = lambda kind: F.col("event_type") == kind
    steps = [patterns.Step(is_a("view")), patterns.Step(is_a("click"), strict=True), patterns.Step(is_a("purchase"))]
    out = patterns.sequence_matches(rows, ["user_id"], "ts", "event_id", steps, "48 hours")
    return out.select("user_id", "event_id", ms("match_end"))
