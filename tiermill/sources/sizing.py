"""Sizes of stored data, and task sizes that fit them."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MIB = 1024 * 1024
PARTITION_BYTES = 128 * MIB
# Up to so many tasks a side, partitions keep their size; beyond, both sides' grow together, so that
# map times reduce tasks, the shuffle's blocks, stay bounded. No partition is cut off.
COMFORTABLE_TASKS = 20_000
# How many bytes of shuffled rows come from a byte of stored data.
TEXT_GROWTH = 1
COLUMNAR_GROWTH = 3
# Bytes of text in a byte of a compressed file, by suffix.
PACKED_GROWTH = {".gz": 8, ".bz2": 10, ".zst": 8, ".xz": 12, ".lz4": 4, ".snappy": 4, ".deflate": 8}


def data_bytes(spark: SparkSession, path: str, unpacked: bool = True) -> int:
    """Bytes of the data files under a path, from file listings; no file is opened.

    Compressed text counts as the bytes it is likely to unpack to, unless ``unpacked`` is false.
    """
    size = F.col("length")
    if unpacked:
        for suffix, growth in PACKED_GROWTH.items():
            size = F.when(F.lower("path").endswith(suffix), F.col("length") * growth).otherwise(size)
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .agg(F.sum(size).alias("bytes"))
    )
    return files.first()["bytes"] or 0


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files, or other sources, that a frame reads, by Spark's own estimate."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(
        int(str(leaves.apply(at).stats().sizeInBytes())) for at in range(leaves.size())
    )


def broadcast_bytes(spark: SparkSession) -> int:
    """Up to so many bytes Spark broadcasts a table by itself; negative if it never does."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


# Spark 4.1 or later; others have no such setting and do not mind it.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_cleanup_lock = Lock()
# How many blocks want it, and what it was before the first of them, by session.
_cleanup: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a statement are removed when it ends, not when the driver next collects garbage.

    For statements that run once, such as writes, begun within the block; blocks of several threads may overlap.
    """
    key = spark._jsparkSession.sessionUUID()
    with _cleanup_lock:
        users, before = _cleanup.get(key) or (0, spark.conf.get(SHUFFLE_CLEANUP, None))
        _cleanup[key] = (users + 1, before)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _cleanup_lock:
            users, before = _cleanup.pop(key)
            if users > 1:
                _cleanup[key] = (users - 1, before)
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, before)


def partitions_for(size: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Partitions needed so that none exceeds the given size on average."""
    return max(1, -(-size // partition_bytes))


def task_bytes(size: int, partition_bytes: int = PARTITION_BYTES) -> int:
    """Bytes a task should read: the given size, and more for inputs of very many such tasks.

    Beyond `COMFORTABLE_TASKS` it grows as the square root of the input, shared between task size
    and task count. 100 TiB thus give about 128,000 tasks of 820 MiB.
    """
    tasks = partitions_for(size, partition_bytes)
    if tasks <= COMFORTABLE_TASKS:
        return partition_bytes
    return int(partition_bytes * (tasks / COMFORTABLE_TASKS) ** 0.5)


@contextmanager
def shuffle_sized_for(
    spark: SparkSession,
    size: int,
    growth: int = COLUMNAR_GROWTH,
    partition_bytes: int = PARTITION_BYTES,
    maximum: int | None = None,
) -> Iterator[int]:
    """Fit ``spark.sql.shuffle.partitions`` and the bytes of a scan task to the input for a block.

    Adaptive execution merges partitions that turn out small but cannot split an aggregate's
    partition that turns out large, so the number must start high enough. Neither setting is ever
    lowered, and both hold for everything else that runs in the session meanwhile. ``maximum`` bounds
    the number where a cluster needs that; there is none by default.
    """
    shuffle, scan = "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = {key: spark.conf.get(key) for key in (shuffle, scan)}
    wide = task_bytes(size * growth, partition_bytes)
    fitting = partitions_for(size * growth, wide)
    if maximum is not None:
        fitting = min(fitting, maximum)
    wanted = max(int(before[shuffle]), fitting)
    spark.conf.set(shuffle, str(wanted))
    if wide > partition_bytes:
        spark.conf.set(scan, str(wide))
    try:
        yield wanted
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
