"""Small helpers over the Hadoop file system of a session, so any scheme Spark reads works here too."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _open(spark, path)
    return fs.exists(at)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names directly below ``path``; empty when it does not exist."""
    fs, at = _open(spark, path)
    if not fs.exists(at):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(at))


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _open(spark, path)
    fs.delete(at, True)


def size_in_bytes(spark: SparkSession, path: str) -> int:
    fs, at = _open(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _open(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file appear at ``path`` whole, by a rename; an existing one is never replaced."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/_{name}.{uuid.uuid4().hex}"
    fs, draft_at = _open(spark, draft)
    stream = fs.create(draft_at)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    _, at = _open(spark, path)
    if fs.exists(at) or not fs.rename(draft_at, at):
        fs.delete(draft_at, False)
        raise FileExistsError(f"{path} was written meanwhile")
