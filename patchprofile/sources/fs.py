"""File-system metadata checks through the session's Hadoop configuration.

Only metadata (existence, listings) is touched, on the driver, the same way
Spark itself lists a folder before planning a scan.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return hp, hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hp, fs = _fs(spark, path)
    return bool(fs.exists(hp))


def list_names(spark: SparkSession, folder: str) -> set[str]:
    """Names directly under ``folder``; empty when it does not exist."""
    hp, fs = _fs(spark, folder)
    if not fs.exists(hp):
        return set()
    return {st.getPath().getName() for st in fs.listStatus(hp)}


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` holding ``text`` in one step; False (nothing written) when it already exists.

    The text goes to a name of its own and is then renamed, so a crash never leaves
    half a record under ``path``.
    """
    hp, fs = _fs(spark, path)
    if fs.exists(hp):
        return False
    part = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{hp.getParent().toString()}/.{hp.getName()}-{uuid.uuid4().hex}")
    out = fs.create(part, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    return bool(fs.rename(part, hp))


def read_text(spark: SparkSession, path: str) -> str:
    hp, fs = _fs(spark, path)
    stream = fs.open(hp)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    put_bytes(spark, path, text.encode("utf-8"))


def put_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write one small object at ``path``, over what is there."""
    hp, fs = _fs(spark, path)
    out = fs.create(hp, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete ``path`` and what lies under it; nothing when it does not exist."""
    hp, fs = _fs(spark, path)
    fs.delete(hp, True)
