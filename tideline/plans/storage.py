"""Folders on the shared file system, through Spark's own file system client."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder in order; a missing folder has none."""
    path, fs = _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def delete_folder(spark: SparkSession, path: str) -> None:
    target, fs = _path(spark, path)
    fs.delete(target, True)


def size(spark: SparkSession, folder: str) -> int:
    """Bytes in a folder; a missing one has none."""
    path, fs = _path(spark, folder)
    return fs.getContentSummary(path).getLength() if fs.exists(path) else 0


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file as a whole: under its name it is there completely or not at all."""
    target, fs = _path(spark, path)
    aside, _ = _path(spark, f"{path}.part")
    out = fs.create(aside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(aside, target):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _path(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
