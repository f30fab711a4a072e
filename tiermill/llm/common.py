"""Helpers of the operators in this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.sources.workspace import work_folder

# The white space that separates words: blank, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
# Texts handed to one numpy step: bounds a Python worker's memory whatever the batch holds.
CHUNK_CHARS = 1_000_000
ARROW_BOUNDS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": 1000,
    "spark.sql.execution.arrow.maxBytesPerBatch": 8 * 1024 * 1024,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


RUN_FOLDER: ContextVar[str | None] = ContextVar("run folder", default=None)


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all tables that operators write between their steps while the block runs.

    Without it they lie side by side in the session's shared folder, for good. Results are lazy and may read
    them: write what you need, then remove the folder with `remove_folder`.
    """
    path = work_folder(spark, "run")
    token = RUN_FOLDER.set(path)
    try:
        yield path
    finally:
        RUN_FOLDER.reset(token)


def table_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for a table between steps."""
    path = work_folder(spark, purpose)
    run = RUN_FOLDER.get()
    return f"{run}/{path.rpartition('/')[2]}" if run else path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write rows to the session's shared folder and read them back, which ends their lineage."""
    path = table_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def finite(vector: Column | str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    vector = F.col(vector) if isinstance(vector, str) else vector
    sound = F.forall(vector, lambda x: F.coalesce(F.abs(x) < F.lit(float("inf")), F.lit(False)))
    return F.coalesce(vector.isNotNull() & sound, F.lit(False))


def bucketed(df: DataFrame, key: str, buckets: int, purpose: str) -> DataFrame:
    """`stored`, dealt by a key, so that later joins on the key need not move these rows again.

    The catalog knows the table only while it is written; its files stay like those of `stored`.
    """
    spark = df.sparkSession
    path = table_folder(spark, purpose)
    name = path.rpartition("/")[2].replace("-", "_")
    writer = df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key)
    writer.option("path", path).saveAsTable(name)
    try:
        return spark.read.table(name)
    finally:
        spark.sql("DROP TABLE IDENTIFIER(:name)", {"name": name})


# Keys with a thousandth of all rows or more, so a thousand at most, are joined by broadcast.
HOT_KEYS = 1000


def join_totals(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Rows, each with the sum of a value over all rows of its key; null is a key too.

    ``rows`` should be stored, as they are read three times. Sums are combined in each task before they
    move. A hot key's rows stay where they are: its sum goes to them, and only the other keys, each with less
    than a thousandth of the rows, are joined by a shuffle.
    """
    totals = rows.groupBy(F.col(key).alias("__key")).agg(
        F.sum(value).alias(name), F.count("*").alias("__rows")
    )
    least = -(-max(1, rows.count()) // HOT_KEYS)
    same = F.col(key).eqNullSafe(F.col("__key"))
    hot = totals.filter(F.col("__rows") >= least).drop("__rows")
    marked = rows.join(F.broadcast(hot), same, "left")
    done = marked.filter(F.col(name).isNotNull()).drop("__key")
    rest = marked.filter(F.col(name).isNull()).drop("__key", name)
    cold = totals.filter(F.col("__rows") < least).drop("__rows")
    return done.unionByName(rest.join(cold, same).drop("__key"))


def rows_with_keys(rows: DataFrame, keys: DataFrame, key: str, count: str) -> DataFrame:
    """The rows whose key is listed. ``keys`` has each key once, with the number of its rows.

    ``rows`` should be stored, as they are read three times. A key with a thousandth of all rows or more is
    told by broadcast, and its rows are not shuffled; only the others meet their keys by one.
    """
    least = -(-max(1, rows.count()) // HOT_KEYS)
    hot = F.broadcast(keys.filter(F.col(count) >= least).select(key))
    cold = keys.filter(F.col(count) < least).select(key)
    rest = rows.join(hot, key, "left_anti")
    return rows.join(hot, key, "left_semi").unionByName(rest.join(cold, key, "left_semi"))


def to_python(rows: DataFrame) -> DataFrame:
    """The rows, with the session's Arrow batches bounded before they go to Python tasks.

    Texts differ a thousandfold in length, and a batch is held several times over: in the JVM, on
    its way, and in Python. Lowers two session settings, and never raises them.
    """
    conf = rows.sparkSession.conf
    for key, most in ARROW_BOUNDS.items():
        now = int(conf.get(key).rstrip("b"))
        if now <= 0 or now > most:
            conf.set(key, str(most))
    return rows


def words_of(text: Column | str) -> Column:
    """The words of a text as an array; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, even where ``use`` reads it in a loop."""
    return F.transform(F.array(value), use)[0]


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_CHARS):
    """``(start, texts)`` runs of a batch's texts (null: empty) of about ``limit`` characters."""
    texts: list[str] = []
    start, size = 0, 0
    for at, value in enumerate(batch.column(column)):
        text = value.as_py() or ""
        texts.append(text)
        size += len(text)
        if size >= limit:
            yield start, texts
            texts, start, size = [], at + 1, 0
    if texts:
        yield start, texts
