"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "tideline", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for.

    ``conf`` keys use ``_`` for ``.``; pass them to override a default.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    }
    settings.update({k.replace("_", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, for checkpoints and written tables.

    A cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    (tests, a single machine) a local temporary folder is used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tideline-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
