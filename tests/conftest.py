import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from tideline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_driver_memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
