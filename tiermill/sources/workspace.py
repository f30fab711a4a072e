"""Folders for tables a query writes and reads again."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import SparkSession

SHARED_DIR = "spark.checkpoint.dir"
WAREHOUSE_DIR = "spark.sql.warehouse.dir"


def _scheme(spark: SparkSession, path: str) -> str:
    """The file system of a path; one without a scheme is on the session's default file system."""
    if ":/" in path:
        return path.partition(":")[0]
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the shared storage the session names in ``spark.checkpoint.dir``.

    Without that setting the session's warehouse serves. On a cluster a warehouse on a local disk
    would be invisible to the other machines, so that raises.
    """
    base = spark.conf.get(SHARED_DIR, None)
    if not base:
        base = spark.conf.get(WAREHOUSE_DIR, None) or ""
        cluster = not spark.conf.get("spark.master", "").startswith("local")
        if not base or cluster and _scheme(spark, base) == "file":
            raise ValueError(f"set {SHARED_DIR} to a folder all executors can reach")
    return f"{base.rstrip('/')}/{purpose}-{uuid4().hex[:12]}"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file wherever it is stored; there must be none."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    stream = files.create(target, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(target)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove_folder(spark: SparkSession, path: str) -> bool:
    """Delete a work folder wherever it is stored; false if there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
