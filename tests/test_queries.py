"""Every registered query against its SQL oracle."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare, connect
from tideline.operators.scan import CONF_HOT_ROWS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCANS = """session_agg session_agg_keyed late_window_agg late_rows running_count running_sum running_stats recent_n
word_count_running asof_join coprocess_alert cep_times cep_consecutive inactivity_gaps ttl_session_count order_timeout
cdc_group_count cdc_schema_diff""".split()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, con, name):
    df = queries()[name](spark, FOLDER)
    sql = oracle_sql().get(name)
    if sql is None:
        assert df.limit(1).count() == 1
    else:
        assert compare(con, df, sql) == ""


@pytest.mark.parametrize("name", SCANS)
def test_query_with_hot_keys_cut(spark, con, name):
    """A third of the rows and more lie on keys that are scanned in slices."""
    spark.conf.set(CONF_HOT_ROWS, "60")
    try:
        assert compare(con, queries()[name](spark, FOLDER), oracle_sql()[name]) == ""
    finally:
        spark.conf.unset(CONF_HOT_ROWS)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
