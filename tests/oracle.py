"""Compares registered queries with their SQL oracles; also runnable from the command line."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        path = os.path.join(folder, f"{name}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return str(value)


def compare(con, df, sql: str):
    """The differences between a Spark result and the oracle, as text; empty when equal."""
    reference = con.execute(sql)
    names = [c[0] for c in reference.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    want = sorted(tuple(_plain(r[names.index(c)]) for c in order) for r in reference.fetchall())
    got = sorted(tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in order]).collect())
    if got == want:
        return "" if got else "no rows"
    a, b = set(got) - set(want), set(want) - set(got)
    return f"{len(got)} vs {len(want)} rows; only here {sorted(a)[:3]}; only oracle {sorted(b)[:3]}"


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from tideline.session import build_session

    scale = os.environ.get("SF", "0.01")
    conf = {k: v for k, v in (a.split("=") for a in sys.argv[1:] if "=" in a)}
    chosen = [a for a in sys.argv[1:] if "=" not in a]
    spark = build_session("oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                          spark_driver_memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    for key, value in conf.items():
        spark.conf.set(key, value)
    folder = f"/root/testdata/sf{scale}"
    con = connect(folder)
    failed = 0
    for name, fn in queries().items():
        if chosen and name not in chosen:
            continue
        begun = time.time()
        try:
            df = fn(spark, folder)
            sql = oracle_sql().get(name)
            outcome = compare(con, df, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(outcome) and not outcome.startswith("rows only")
        print(f"{name:24s} {time.time() - begun:6.2f}s  {outcome or 'ok'}", flush=True)
    print("failed:", failed)
