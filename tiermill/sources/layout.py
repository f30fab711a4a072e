"""File layout: few files, each with its own narrow range of the column readers filter on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.sources.sizing import MIB, data_bytes, partitions_for

TARGET_FILE_BYTES = 1024 * MIB
SPREAD = "__spread"


def cluster(df: DataFrame, by: str) -> DataFrame:
    """Range-partition and sort a small result before it is written.

    The number of files is left to adaptive execution, which merges small ranges.
    """
    return df.repartitionByRange(F.col(by)).sortWithinPartitions(by)


def place_in_source() -> Column:
    """A hash of a row's place in its file, the same whenever a task reads it again."""
    return F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index"))


def compact_and_cluster(
    spark: SparkSession,
    source: str,
    target: str,
    by: str,
    files: int | None = None,
    file_bytes: int = TARGET_FILE_BYTES,
) -> str:
    """Rewrite a Parquet table into ``files`` files with non-overlapping ranges of ``by``.

    Without ``files`` their number follows from the table's size. The target must be another
    path: a table cannot be overwritten while it is read.

    A value of ``by`` that holds a large share of the rows is spread over several files: the
    range key goes on with a hash of the row's place in the source. That place does not change
    when a task runs again, so a lost executor cannot lose or double rows.
    """
    if source.rstrip("/") == target.rstrip("/"):
        raise ValueError("the target must differ from the source")
    count = files or partitions_for(data_bytes(spark, source), file_bytes)
    rows = spark.read.parquet(source)
    (
        rows.withColumn(SPREAD, place_in_source())
        .repartitionByRange(count, F.col(by), F.col(SPREAD))
        .sortWithinPartitions(by)
        .drop(SPREAD)
        .write.mode("overwrite")
        .parquet(target)
    )
    return target


def layout_stats(spark: SparkSession, path: str, by: str) -> DataFrame:
    """Rows, smallest and largest value of ``by`` per file of a Parquet table."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.count(F.lit(1)).alias("rows"), F.min(by).alias("low"), F.max(by).alias("high"))
    )
