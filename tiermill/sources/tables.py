"""Layer tables at a path: ``<root>/<layer>/<name>``.

A plain-file table is replaced without a gap. Every write goes to a new ``run-<id>`` folder under the
table's path and becomes the table by a commit: an empty file ``commit-<number>-<id>``, its number one above
the highest there is. The highest commit is the table. A writer that finds its number taken by
another commits again, so the last commit wins, whoever started first and whatever the clocks say. No
two writers ever make the same file, so any file system that lists what was created will do.

A write that fails removes its folder; one that dies leaves it, and the table is still the last commit.
Readers of the replaced folder can finish: it stays until the next commit. Folders that no commit names
belong to writers at work, or to dead ones: others' writes never remove them, only `drop_unfinished` does.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.rules import MART_CLUSTERING
from tiermill.sources.layout import cluster
from tiermill.sources.sizing import shuffles_dropped
from tiermill.sources.workspace import read_text, remove_folder, write_text

DEFAULT_FORMAT = "parquet"
MART_LAYER = "gold"
# Of Parquet files; a third less than Spark's default at the same speed.
COMPRESSION = "zstd"


# Formats that replace a table in one commit of their own.
COMMITTING_FORMATS = {"delta", "iceberg", "hudi"}
COMMIT = re.compile(r"commit-(\d{12})-([0-9a-f]{32})")
NOTE = "_note"
RUN = re.compile(r"run-([0-9a-f]{32})")
# So many commit files stay, though only the last two folders do: a commit that is no further behind the
# others finds its number taken.
COMMITS_KEPT = 100
# Writers that name one table at once disturb each other's drop and create so often at most.
NAMING_ATTEMPTS = 100


def layer_path(root: str, layer: str, name: str) -> str:
    """Where a layer table lives."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def _folder(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    target, files = _folder(spark, path)
    if not files.exists(target):
        return []
    return [status.getPath().getName() for status in files.listStatus(target)]


def file_sizes(spark: SparkSession, paths: list[str]) -> list[int]:
    """Bytes of some files, from the file system."""
    found = []
    for path in paths:
        target, files = _folder(spark, path)
        found.append(files.getFileStatus(target).getLen())
    return found


def _commits(names: list[str]) -> list[tuple[int, str]]:
    """Numbers and ids of a table's commits, the last one at the end."""
    return sorted((int(found[1]), found[2]) for name in names if (found := COMMIT.fullmatch(name)))


def commits_of(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """Numbers and ids of the commits at a path, the last one at the end."""
    return _commits(folder_names(spark, path))


def make_commit(spark: SparkSession, path: str, key: str, after: tuple[int, str] | None) -> bool:
    """Commit only if ``after`` is still the last commit; false, and no commit, if it is not.

    Of two writers that try this at once one succeeds, or neither.
    """
    number = after[0] + 1 if after else 1
    target, files = _folder(spark, f"{path}/commit-{number:012d}-{key}")
    before = commits_of(spark, path)
    if (before[-1] if before else None) != after:
        return False
    files.create(target, False).close()
    if commits_of(spark, path)[-1] == (number, key) and all(
        one == key for at, one in commits_of(spark, path) if at == number
    ):
        return True
    files.delete(target, False)
    return False


def _commit(spark: SparkSession, path: str, key: str) -> int:
    """Make a complete folder the table; the number of the commit."""
    while True:
        number = max((at for at, _ in _commits(folder_names(spark, path))), default=0) + 1
        target, files = _folder(spark, f"{path}/commit-{number:012d}-{key}")
        files.create(target, False).close()
        commits = _commits(folder_names(spark, path))
        others = [at for at, one in commits if at == number and one != key]
        if commits[-1] == (number, key) or not others:
            return number


def current_path(spark: SparkSession, path: str) -> str:
    """The folder that holds a table's rows now; the path itself if nothing was written by runs."""
    commits = _commits(folder_names(spark, path))
    return f"{path}/run-{commits[-1][1]}" if commits else path


def _drop_replaced(spark: SparkSession, path: str) -> None:
    """Remove the folders of all commits but the last two, and the oldest commit files."""
    names = folder_names(spark, path)
    commits = _commits(names)
    order = list(dict.fromkeys(key for _, key in reversed(commits)))
    replaced = set(order[2:])
    for name in names:
        if (found := RUN.fullmatch(name)) and found[1] in replaced:
            remove_folder(spark, f"{path}/{name}")
    for number, key in commits[:-COMMITS_KEPT]:
        remove_folder(spark, f"{path}/commit-{number:012d}-{key}")


def drop_unfinished(spark: SparkSession, root: str, layer: str, name: str) -> list[str]:
    """Remove folders that no commit names; call it only while nothing writes the table."""
    path = layer_path(root, layer, name)
    names = folder_names(spark, path)
    named = {f"run-{key}" for _, key in _commits(names)}
    dead = [one for one in names if one.startswith("run-") and one not in named]
    for one in dead:
        remove_folder(spark, f"{path}/{one}")
    return dead


def read_layer(
    spark: SparkSession, root: str, layer: str, name: str, fmt: str = DEFAULT_FORMAT
) -> DataFrame:
    """A layer table. ``fmt`` may be any installed source, such as delta."""
    path = layer_path(root, layer, name)
    return spark.read.format(fmt).load(
        path if fmt in COMMITTING_FORMATS else current_path(spark, path)
    )


def write_layer(
    df: DataFrame,
    root: str,
    layer: str,
    name: str,
    fmt: str = DEFAULT_FORMAT,
    replace_schema: bool = False,
    table: str | None = None,
    note: str | None = None,
) -> str:
    """Replace a layer table and return the folder that holds its rows.

    ``replace_schema`` allows new columns where the format guards the old ones. With ``table``
    the catalog entry follows once the rows are complete. `layer_note` gives ``note`` back for as long as
    these rows are the table; formats with commits of their own do not keep it.
    """
    spark, path = df.sparkSession, layer_path(root, layer, name)
    if table:
        _check_entry(spark, table)
    if fmt in COMMITTING_FORMATS:
        writer = df.write.format(fmt).mode("overwrite")
        if replace_schema and fmt == "delta":
            writer = writer.option("overwriteSchema", True)
        writer.save(path)
        if table:
            register(spark, table, path, fmt, replace=replace_schema)
        return path
    key = uuid4().hex
    run = f"{path}/run-{key}"
    try:
        writer = df.write.format(fmt)
        if fmt == DEFAULT_FORMAT:
            writer = writer.option("compression", COMPRESSION)
        with shuffles_dropped(spark):
            writer.save(run)
        if note is not None:
            write_text(spark, f"{run}/{NOTE}", note)
    except BaseException:
        remove_folder(spark, run)
        raise
    _commit(spark, path, key)
    if table:
        _name_current(spark, table, path, fmt)
    _drop_replaced(spark, path)
    return run


def layer_note(spark: SparkSession, root: str, layer: str, name: str) -> str | None:
    """The note that the rows a layer table has now were written with."""
    path = layer_path(root, layer, name)
    current = current_path(spark, path)
    return read_text(spark, f"{current}/{NOTE}") if NOTE in folder_names(spark, current) else None


def name_layer(spark: SparkSession, root: str, layer: str, name: str, fmt: str, table: str) -> None:
    """Give a layer table a name in the catalog, as its write would have done."""
    if fmt in COMMITTING_FORMATS:
        register(spark, table, layer_path(root, layer, name), fmt)
    else:
        _check_entry(spark, table)
        _name_current(spark, table, layer_path(root, layer, name), fmt)


def _name_current(spark: SparkSession, name: str, path: str, fmt: str) -> None:
    """Let a name follow the table at a path.

    Every writer names the table after its commit and looks again: if another commit came meanwhile, it
    names that one. So the last naming, whoever does it, is of the last commit.
    """
    attempts = 0
    while True:
        current = current_path(spark, path)
        try:
            register(spark, name, current, fmt, replace=True)
        except AnalysisException:
            # Another writer dropped or made the entry, or removed a folder that is no longer current.
            attempts += 1
            if attempts == NAMING_ATTEMPTS:
                raise
            continue
        if current_path(spark, path) == current:
            return


def _check_entry(spark: SparkSession, name: str) -> bool:
    """Whether the name has an external entry; raises if something else holds it."""
    try:
        kind = spark.catalog.getTable(name).tableType
    except AnalysisException:
        # No such entry, or another writer has just dropped it to make it anew.
        return False
    if kind != "EXTERNAL":
        raise ValueError(f"{name} is {kind.lower()}, not a layer table")
    return True


def register(
    spark: SparkSession,
    name: str,
    path: str,
    fmt: str = DEFAULT_FORMAT,
    replace: bool = False,
) -> None:
    """Name a path in the catalog if the name is free; ``replace`` makes the entry anew.

    Only an external entry is ever dropped, which leaves its files alone. A view, or a table that
    owns its files, holds the name for itself: that raises.
    """
    if _check_entry(spark, name):
        if not replace:
            spark.catalog.refreshTable(name)
            return
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})
    spark.catalog.createTable(name, path=path, source=fmt)


def write_counted(
    df: DataFrame, root: str, layer: str, name: str, fmt: str = DEFAULT_FORMAT, **options
) -> int:
    """`write_layer`, and the number of rows written, counted by the write itself."""
    seen = Observation()
    write_layer(
        df.observe(seen, F.count(F.lit(1)).alias("rows")), root, layer, name, fmt, **options
    )
    return seen.get.get("rows", 0)


def write_marts(
    marts: Mapping[str, DataFrame],
    root: str,
    fmt: str = DEFAULT_FORMAT,
    clustering: Mapping[str, str] = MART_CLUSTERING,
    tables: bool = False,
    note: str | None = None,
) -> DataFrame:
    """Write the marts, clustered, and return one row ``(mart, rows)`` per mart.

    The marts do not depend on each other, so their jobs are submitted together and fill each
    other's idle tail. ``tables`` names each mart in the catalog.
    """
    if not marts:
        raise ValueError("no marts given")
    spark = next(iter(marts.values())).sparkSession

    def write(name: str) -> int:
        mart = marts[name]
        if name in clustering:
            mart = cluster(mart, clustering[name])
        return write_counted(
            mart,
            root,
            MART_LAYER,
            name,
            fmt,
            replace_schema=True,
            table=name if tables else None,
            note=note,
        )

    with ThreadPoolExecutor(len(marts)) as pool:
        counts = list(pool.map(inheritable_thread_target(spark)(write), marts))
    return spark.createDataFrame(list(zip(marts, counts)), "mart string, rows bigint")
