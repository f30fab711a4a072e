"""Clustered tables that are appended to and put in order again only where ranges overlap.

A table is at ``<root>/<layer>/<name>``; every write puts files into a new ``run-<id>`` folder with a list of all
files that make up the table, and commits as `tiermill.sources.buckets` does. An append lists the old files and
its own. `recluster` sweeps over the ranges of the files and rewrites those that overlap more deeply than
allowed, together with what they overlap; the others stay where they are, unread but for the range column.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.sources.layout import SPREAD, TARGET_FILE_BYTES, place_in_source
from tiermill.sources.sizing import partitions_for
from tiermill.sources.tables import (
    RUN,
    commits_of,
    file_sizes,
    folder_names,
    layer_path,
    make_commit,
)
from tiermill.sources.workspace import read_text, remove_folder, write_text

FILES = "_files"


def _listed(spark: SparkSession, path: str, key: str) -> list[str]:
    return read_text(spark, f"{path}/run-{key}/{FILES}").splitlines()


def table_files(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """The files of a table, relative to its path; none without a table."""
    path = layer_path(root, layer, name)
    commits = commits_of(spark, path)
    return _listed(spark, path, commits[-1][1]) if commits else []


def _rows_of(spark: SparkSession, path: str, files: list[str]) -> DataFrame:
    return spark.read.parquet(*[f"{path}/{one}" for one in files])


def read_clustered(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    """The rows of a table."""
    files = table_files(spark, root, layer, name)
    if not files:
        raise ValueError(f"no table {layer}/{name} under {root}")
    return _rows_of(spark, layer_path(root, layer, name), files)


def _write(
    ordered: DataFrame, path: str, kept: list[str], before: tuple[int, str] | None
) -> list[str]:
    """Write rows to a new run and commit the kept files and these; the new files."""
    spark, key = ordered.sparkSession, uuid4().hex
    run = f"{path}/run-{key}"
    try:
        ordered.write.parquet(run)
        made = [f"run-{key}/{one}" for one in folder_names(spark, run) if one.startswith("part-")]
        write_text(spark, f"{run}/{FILES}", "".join(f"{one}\n" for one in sorted(kept + made)))
        if not make_commit(spark, path, key, after=before):
            raise RuntimeError(f"another write to {path} came in between")
    except BaseException:
        remove_folder(spark, run)
        raise
    last = [key for _, key in commits_of(spark, path)[-2:]]
    used = set(last) | {RUN.fullmatch(one.split("/")[0])[1] for at in last for one in _listed(spark, path, at)}
    for found in folder_names(spark, path):
        if (old := RUN.fullmatch(found)) and old[1] not in used:
            remove_folder(spark, f"{path}/{found}")
    return made


def append_clustered(
    rows: DataFrame, root: str, layer: str, name: str, by: str, files: int | None = None
) -> list[str]:
    """Add rows in files with ranges of ``by`` of their own; the new files.

    The first append makes the table. Without ``files`` their number is left to adaptive execution.
    """
    spark, path = rows.sparkSession, layer_path(root, layer, name)
    commits = commits_of(spark, path)
    kept = _listed(spark, path, commits[-1][1]) if commits else []
    ranges = rows.repartitionByRange(files, F.col(by)) if files else rows.repartitionByRange(F.col(by))
    return _write(ranges.sortWithinPartitions(by), path, kept, commits[-1] if commits else None)


def overlap_depths(stats: DataFrame) -> DataFrame:
    """``file, stretch, depth`` of files with ``file, low, high``.

    Files whose ranges overlap, directly or by way of others, share a stretch; its depth is the largest number
    of files over one value. Ranges that only touch, or hold one value, as a hot one
    spread over files does, do not overlap each other. Files without a range are left out. The
    window has two rows per file.
    """
    point = F.col("low") == F.col("high")
    ranged = stats.filter(F.col("low").isNotNull())
    # At one value: ranges end, then those of that value alone come and go one by one, then ranges begin.
    begin, end = F.when(point, 1).otherwise(2), F.when(point, 1).otherwise(0)
    begins = ranged.select("file", F.col("low").alias("at"), begin.alias("turn"), F.lit(1).alias("step"))
    ends = ranged.select("file", F.col("high").alias("at"), end, F.lit(-1))
    order = Window.orderBy("at", "turn", "file", F.desc("step"))
    order = order.rowsBetween(Window.unboundedPreceding, 0)
    swept = begins.union(ends).withColumn("open", F.sum("step").over(order))
    # A stretch ends where no range is open.
    closed = F.sum(F.when(F.col("open") == 0, 1).otherwise(0)).over(order)
    marked = swept.withColumn("stretch", closed - F.when(F.col("open") == 0, 1).otherwise(0))
    depth = F.max("open").over(Window.partitionBy("stretch"))
    return marked.withColumn("depth", depth).filter("step = 1").select("file", "stretch", "depth")


def recluster(
    spark: SparkSession,
    root: str,
    layer: str,
    name: str,
    by: str,
    depth: int = 1,
    file_bytes: int = TARGET_FILE_BYTES,
) -> tuple[list[str], list[str]]:
    """Rewrite the stretches in which more than ``depth`` files overlap; the files replaced and the new ones.

    ``depth=1`` leaves no overlap. The new files have ranges of their own within the old ones', so no file
    that stays is met. Rows that were spread over the whole range overlap every file: allow a greater depth
    to let several such appends gather.
    """
    path = layer_path(root, layer, name)
    commits = commits_of(spark, path)
    files = _listed(spark, path, commits[-1][1]) if commits else []
    if not files:
        return [], []
    where = F.substring_index(F.col("_metadata.file_path"), "/", -2)
    stats = (
        _rows_of(spark, path, files)
        .groupBy(where.alias("file"))
        .agg(F.min(by).alias("low"), F.max(by).alias("high"))
    )
    # Names of the files to rewrite: metadata, as the list of files is.
    old = sorted(row.file for row in overlap_depths(stats).filter(F.col("depth") > depth).collect())
    if not old:
        return [], []
    sizes = file_sizes(spark, [f"{path}/{one}" for one in old])
    count = partitions_for(sum(sizes), file_bytes)
    ordered = (
        _rows_of(spark, path, old)
        .withColumn(SPREAD, place_in_source())
        .repartitionByRange(count, F.col(by), F.col(SPREAD))
        .sortWithinPartitions(by)
        .drop(SPREAD)
    )
    kept = sorted(set(files) - set(old))
    return old, _write(ordered, path, kept, commits[-1])
