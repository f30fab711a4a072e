"""Bronze, silver and gold in order."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tiermill import operators as op
from tiermill import rules
from tiermill.plans.gold import all_marts
from tiermill.plans.layers import (
    bronze_logs,
    bronze_orders,
    log_quarantine,
    order_quarantine,
    silver_logs,
    silver_orders,
    typed_orders,
)
from tiermill.sources import (
    data_bytes,
    read_access_log_csv,
    read_layer,
    read_orders_csv,
    remove_folder,
    scanned_bytes,
    shuffle_sized_for,
    write_layer,
    write_marts,
)
from tiermill.sources.sizing import COLUMNAR_GROWTH, TEXT_GROWTH
from tiermill.sources.tables import COMPRESSION, DEFAULT_FORMAT, MART_LAYER, layer_note, name_layer

ORDERS, LOGS = "orders", "logs"
QUARANTINE = "quarantine"
TYPED = "_typed"


def input_fingerprint(spark: SparkSession, paths: list[str], *parameters: object) -> str:
    """A text that changes when a file under the paths, a parameter or a cleaning rule does.

    Files count by path, length and time of change, from listings; none is opened.
    """
    listed = []
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        place = F.xxhash64("path", "length", F.unix_micros("modificationTime"))
        seen = files.agg(
            F.count("*").alias("files"), F.sum("length").alias("bytes"), F.bit_xor(place).alias("places")
        ).first()
        listed.append((path, seen["files"], seen["bytes"], seen["places"]))
    fixed = sorted((name, repr(value)) for name, value in vars(rules).items() if name.isupper())
    return hashlib.sha256(repr((listed, parameters, fixed)).encode()).hexdigest()


def run_pipeline(
    spark: SparkSession,
    raw_orders: DataFrame,
    raw_logs: DataFrame | None,
    root: str,
    fmt: str = DEFAULT_FORMAT,
    tables: bool = False,
    input_bytes: int | None = None,
    fingerprint: str | None = None,
    bits: int | None = None,
    parse_once: bool = False,
) -> DataFrame:
    """Write every layer under ``root`` and return the mart row counts ``(mart, rows)``.

    Each layer is read back from storage by the next, which keeps plans short and lets a lost
    executor cost one stage, not the whole run. Orders to marts and the log are two chains that run
    side by side and wait for each other only at the end. The first, unfiltered silver orders are
    not written: the cleaned ones replace them at the same path.

    Shuffles of all layers are sized for ``input_bytes`` shuffled bytes; by default three times
    what the larger input's files hold.

    ``fingerprint`` says what inputs and parameters a run is for. It is stored with every layer table in one
    step with the rows; a run for the same fingerprint goes on where the last one ended and writes only
    the tables that are not there yet.

    ``bits`` is for raw orders that give the same rows each time they are read, as files do: they are read three
    times, and only rows that may have an equal are moved (`dedup_few`). ``parse_once`` is for files that are dear to
    read: their rows with types are stored under ``root`` first, and read instead, until bronze is written.
    """

    def finished(layer: str, name: str) -> bool:
        return fingerprint is not None and layer_note(spark, root, layer, name) == fingerprint

    def write(rows: Callable[[], DataFrame], layer: str, name: str) -> DataFrame:
        table = f"{name}_{layer}" if tables else None
        if not finished(layer, name):
            write_layer(
                rows(), root, layer, name, fmt, replace_schema=True, table=table, note=fingerprint
            )
        elif table:
            name_layer(spark, root, layer, name, fmt, table)
        return read_layer(spark, root, layer, name, fmt)

    def orders_to_marts() -> DataFrame:
        # Not a layer: it goes as soon as bronze is written, or has failed.
        scratch = f"{root.rstrip('/')}/{TYPED}-{uuid4().hex[:12]}"

        def parsed() -> DataFrame:
            typed_orders(raw_orders).write.option("compression", COMPRESSION).parquet(scratch)
            return spark.read.parquet(scratch)

        try:
            bronze = write(lambda: bronze_orders(parsed() if parse_once else raw_orders, bits), "bronze", ORDERS)
        finally:
            remove_folder(spark, scratch)
        silver = write(lambda: silver_orders(bronze), "silver", ORDERS)
        marts = all_marts(silver)
        due = {name: mart for name, mart in marts.items() if not finished(MART_LAYER, name)}
        audit = write_marts(due, root, fmt, tables=tables, note=fingerprint) if due else None
        if len(due) == len(marts):
            return audit
        counts = {row["mart"]: row["rows"] for row in audit.collect()} if audit else {}
        for name in marts.keys() - due.keys():
            counts[name] = read_layer(spark, root, MART_LAYER, name, fmt).count()
            if tables:
                name_layer(spark, root, MART_LAYER, name, fmt, name)
        return spark.createDataFrame([(name, counts[name]) for name in marts], "mart string, rows bigint")

    def logs() -> None:
        if raw_logs is not None:
            bronze = write(lambda: bronze_logs(raw_logs), "bronze", LOGS)
            write(lambda: silver_logs(bronze, distinct_input=True), "silver", LOGS)

    if input_bytes is None:
        inputs = [raw_orders] if raw_logs is None else [raw_orders, raw_logs]
        input_bytes = COLUMNAR_GROWTH * max(map(scanned_bytes, inputs))
    chains: list[Callable] = [orders_to_marts, logs]
    with (
        shuffle_sized_for(spark, input_bytes, growth=1),
        ThreadPoolExecutor(len(chains)) as pool,
    ):
        running = [pool.submit(inheritable_thread_target(spark)(chain)) for chain in chains]
        audit, _ = [chain.result() for chain in running]
    return audit


def run_csv_pipeline(
    spark: SparkSession,
    orders_path: str,
    logs_path: str | None,
    root: str,
    fmt: str = DEFAULT_FORMAT,
    tables: bool = False,
    encoding: str = "UTF-8",
    schema: StructType | str | None = None,
    quarantine: bool = False,
    resume: bool = False,
) -> DataFrame:
    """`run_pipeline` from CSV files, with shuffles sized for them.

    ``schema`` is that of the order file, or ``"infer"`` for both files; all text by default. Rows of the
    wrong shape never reach bronze; ``quarantine=True`` writes them, and those with values that do not
    convert, to the layer ``quarantine``, at the cost of another scan of the files.

    ``resume=True`` goes on where the last run with that setting ended, if the files, the parameters and the
    rules are the same, and starts at bronze if they are not.
    """
    paths = [path for path in (orders_path, logs_path) if path]
    size = TEXT_GROWTH * max(data_bytes(spark, path) for path in paths)
    log_schema = schema if isinstance(schema, str) and schema == "infer" else None
    orders = read_orders_csv(spark, orders_path, schema, encoding, malformed=True)
    logs = None
    if logs_path:
        logs = read_access_log_csv(spark, logs_path, log_schema, encoding, malformed=True)
    if quarantine:
        write_layer(order_quarantine(orders), root, QUARANTINE, ORDERS, fmt)
        if logs is not None:
            write_layer(log_quarantine(logs), root, QUARANTINE, LOGS, fmt)
    return run_pipeline(
        spark,
        orders,
        logs,
        root,
        fmt,
        tables,
        input_bytes=size,
        fingerprint=input_fingerprint(spark, paths, fmt, encoding, schema) if resume else None,
        bits=op.BITMAP_BITS,
        parse_once=True,
    )
