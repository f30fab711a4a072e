"""One runnable query per operator, layer, mart, report and table operation.

Each takes ``(spark, sf_dir)``, reads the whole driver tables and returns a DataFrame. Float sums
and means are rounded the same way as in `checks.oracle`; timestamps are shown as text.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, TimestampNTZType, TimestampType

from checks import star
from tiermill import functions as fn
from tiermill import operators as op
from tiermill import rules
from tiermill.plans import gold, layers, reports
from tiermill.plans.late import add_orders, orders_of
from tiermill.plans.loads import add_load
from tiermill.plans.pipeline import run_csv_pipeline, run_pipeline
from tiermill.sources import (
    compact_and_cluster,
    data_bytes,
    layer_path,
    layout_stats,
    partitions_for,
    read_access_log_csv,
    read_layer,
    read_orders_csv,
    remove_folder,
    work_folder,
    write_layer,
    write_marts,
)
from tiermill.sources.clustered import (
    append_clustered,
    read_clustered,
    recluster,
    table_files,
)
from tiermill.sources.layout import TARGET_FILE_BYTES
from tiermill.sources.sizing import shuffles_dropped

Query = Callable[[SparkSession, str], DataFrame]

KEY = rules.ORDER_KEY
NOISY = ["sales_per_customer", "order_profit_per_order", "order_item_profit_ratio"]
SHOWN = "yyyy-MM-dd HH:mm:ss"


def stable(name: str):
    """A double without the noise that depends on the order of addition."""
    return F.round(F.col(name).cast("decimal(28,6)"), 4).cast("double").alias(name)


def settle(
    df: DataFrame, names: list[str] | None = None, as_text: tuple[str, ...] = ()
) -> DataFrame:
    """Comparable values: settled doubles, timestamps and arrays as text.

    ``as_text`` names integers that hold nulls, which client libraries show in different types.
    """
    columns = []
    for field in df.schema.fields:
        kind, name = field.dataType, field.name
        if name in as_text:
            columns.append(F.col(name).cast("string").alias(name))
        elif isinstance(kind, DoubleType) and (names is None or name in names):
            columns.append(stable(name))
        elif isinstance(kind, (TimestampType, TimestampNTZType)):
            columns.append(F.date_format(name, SHOWN).alias(name))
        elif isinstance(kind, ArrayType):
            columns.append(F.array_join(name, "|").alias(name))
        else:
            columns.append(F.col(name))
    return df.select(*columns)


# --- inputs ----------------------------------------------------------------------------------


def stored_orders(spark: SparkSession, sf_dir: str, root: str | None = None) -> DataFrame:
    """Raw orders, written once as a layer table, so that the layers can read them more than once."""
    root = root or work_folder(spark, "raw-orders")
    write_layer(star.raw_orders(spark, sf_dir), root, "raw", "orders")
    return read_layer(spark, root, "raw", "orders")


def write_silver(spark: SparkSession, sf_dir: str, root: str, **options) -> None:
    """Silver orders written as a layer table; the raw ones go when that is done."""
    folder = work_folder(spark, "raw-orders")
    write_layer(layers.raw_silver_orders(stored_orders(spark, sf_dir, folder)), root, "silver", "orders", **options)
    remove_folder(spark, folder)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze_orders(stored_orders(spark, sf_dir), op.BITMAP_BITS)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.raw_silver_orders(stored_orders(spark, sf_dir))


def named_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.rename_positional(star.raw_logs(spark, sf_dir), rules.LOG_COLUMNS)


def log_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.bronze_logs(star.raw_logs(spark, sf_dir))


def on(
    source: Query,
    step: Callable[[DataFrame], DataFrame],
    *shown: str,
    as_text: tuple[str, ...] = (),
) -> Query:
    """A query that applies a step to an input and shows some columns, or all."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = step(source(spark, sf_dir))
        return settle(result.select(*shown) if shown else result, NOISY, as_text)

    return query


# --- column operators ------------------------------------------------------------------------


def _clean_country(df: DataFrame) -> DataFrame:
    letters = op.strip_non_letters(df, ["order_country"])
    return op.canonicalize(letters, "order_country", rules.COUNTRY_RULES)


def _reparsed(df: DataFrame) -> DataFrame:
    return op.parse_timestamps(layers.clean_logs(df), ["event_time"])


def _parts(df: DataFrame) -> DataFrame:
    return op.split_path(df).withColumn("parts", F.size("url_path"))


def _night(df: DataFrame) -> DataFrame:
    return op.flag_night(op.cast_columns(df, rules.LOG_CASTS))


def _month(df: DataFrame) -> DataFrame:
    return op.month_bucket(op.parse_timestamps(df, rules.ORDER_TIMES), "order_date")


def _profit_pct(df: DataFrame) -> DataFrame:
    share = fn.percent(F.col("order_profit_per_order"), F.col("sales"))
    return df.withColumn("profit_pct", share)


COLUMN_QUERIES = {
    "normalize_names": on(
        star.raw_orders_with_headers,
        op.normalize_names,
        *KEY,
        "customer_segment",
        "days_for_shipping_real",
        "days_for_shipment_scheduled",
        "late_delivery_risk",
        "order_date_dateorders",
        "shipping_date_dateorders",
    ),
    "rename_positional": named_logs,
    "cast_columns": on(
        star.raw_orders_as_text,
        lambda df: op.cast_columns(df, rules.ORDER_CASTS),
        *KEY,
        *rules.ORDER_CASTS,
        as_text=("order_item_quantity",),
    ),
    "drop_columns": on(
        star.raw_orders,
        lambda df: op.drop_columns(df, rules.ORDER_PRIVATE_COLUMNS),
        as_text=("customer_id",),
    ),
    "drop_unused_columns": on(
        bronze, lambda df: op.drop_columns(df, rules.ORDER_UNUSED_COLUMNS)
    ),
    "fill_nulls": on(
        star.raw_orders,
        lambda df: op.fill_nulls(df, rules.ORDER_NULL_DEFAULTS),
        *KEY,
        "customer_lname",
    ),
    "normalize_text": on(
        star.raw_orders,
        lambda df: op.normalize_text(df, rules.ORDER_TEXT_COLUMNS),
        *KEY,
        *rules.ORDER_TEXT_COLUMNS,
    ),
    "strip_non_letters": on(
        star.raw_orders,
        lambda df: op.strip_non_letters(df, rules.ORDER_LETTER_COLUMNS),
        *KEY,
        *rules.ORDER_LETTER_COLUMNS,
    ),
    "null_if_numeric": on(
        star.raw_orders,
        lambda df: op.null_if_numeric(df, "order_country"),
        *KEY,
        "order_country",
    ),
    "canonicalize_country": on(star.raw_orders, _clean_country, *KEY, "order_country"),
    "parse_order_dates": on(
        star.raw_orders_as_text,
        lambda df: op.parse_timestamps(df, rules.ORDER_TIMES),
        *KEY,
        *rules.ORDER_TIMES,
        *rules.ORDER_TIMES.values(),
    ),
    "reparse_event_time": on(star.raw_logs, _reparsed, "ip", "url", "event_time"),
    "split_path": on(named_logs, _parts, "url", "url_path", "parts"),
    "ip_first_octet": on(named_logs, op.ip_first_octet, "ip", "user_region"),
    "ip_prefix": on(named_logs, op.ip_prefix, "ip", "user_region"),
    "flag_night": on(named_logs, _night, "ip", "hour", "is_night", as_text=("hour",)),
    "month_bucket": on(star.raw_orders, _month, *KEY, "order_month"),
    "percent": on(star.raw_orders, _profit_pct, *KEY, "profit_pct"),
}

# --- filters and duplicates ------------------------------------------------------------------


def _parsed_logs(df: DataFrame) -> DataFrame:
    text = op.normalize_text(df, rules.LOG_TEXT_COLUMNS)
    return op.parse_timestamps(text, ["event_time"])


def _finished(df: DataFrame) -> DataFrame:
    text = op.normalize_text(df, ["order_status"])
    return op.keep_in(text, "order_status", rules.ORDER_STATUSES)


FILTER_QUERIES = {
    "require_orders": on(
        star.raw_orders,
        lambda df: op.require(df, rules.ORDER_REQUIRED),
        *KEY,
        "customer_id",
        "sales",
    ),
    "require_logs": on(star.raw_logs, layers.clean_logs, *rules.LOG_REQUIRED),
    "positive_sales": on(
        star.raw_orders,
        lambda df: op.keep_positive(df, rules.ORDER_POSITIVE),
        *KEY,
        *rules.ORDER_POSITIVE,
    ),
    "status_present": on(
        star.raw_orders, lambda df: op.require(df, ["order_status"]), *KEY, "order_status"
    ),
    "dates_present": on(
        star.raw_orders,
        lambda df: op.require(df, list(rules.ORDER_TIMES.values())),
        *KEY,
        *rules.ORDER_TIMES.values(),
    ),
    "valid_status": on(star.raw_orders, _finished, *KEY, "order_status"),
    "valid_hour": on(
        star.raw_logs,
        lambda df: op.keep_between(layers.clean_logs(df), "hour", *rules.LOG_HOURS),
        "product",
        "ip",
        "hour",
    ),
    "event_present": on(
        named_logs,
        lambda df: layers.silver_logs_basic(_parsed_logs(df)),
        "product",
        "event_time",
        "ip",
    ),
    "dedup_rows": on(star.raw_orders, op.dedup_rows, as_text=("customer_id",)),
    "dedup_by_key": on(
        star.raw_orders,
        lambda df: op.dedup_by_key(df, KEY, rules.ORDER_TIE_BREAK),
        *KEY,
        "order_date_dateorders",
        "shipping_date_dateorders",
        "sales",
        "order_profit_per_order",
        "order_status",
        "order_city",
    ),
    "order_rejects": on(star.raw_orders_as_text, layers.order_rejects),
    "order_quarantine": on(
        star.raw_orders_as_text, layers.order_quarantine, *KEY, "sales", "rejected_by"
    ),
}

# --- layers, marts, reports ------------------------------------------------------------------

LAYER_QUERIES = {
    "bronze_orders": on(star.raw_orders, layers.bronze_orders),
    "silver_orders_basic": on(bronze, layers.silver_orders_basic),
    "silver_orders": on(stored_orders, layers.raw_silver_orders),
    "bronze_logs": on(star.raw_logs, layers.bronze_logs, as_text=("hour",)),
    "silver_logs_basic": on(log_bronze, layers.silver_logs_basic, as_text=("hour",)),
    "silver_logs": on(log_bronze, layers.silver_logs),
}


def _mart(name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle(gold.mart(name, silver(spark, sf_dir)))

    return query


def unordered_mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A mart as input of a report: no sort that the report would undo."""
    return gold.all_marts(silver(spark, sf_dir))[name]


def _report(mart: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        report = build(unordered_mart(spark, sf_dir, mart))
        return settle(report)

    return query


def _growth(grain: str) -> Query:
    return _report("monthly_financials", lambda mart: reports.month_over_month(mart, grain))


MART_QUERIES = {name: _mart(name) for name in gold.MARTS}
REPORT_QUERIES = {
    **{name: _report(mart, build) for name, (mart, build) in reports.REPORTS.items()},
    "revenue_growth_by_market": _growth("market"),
    "revenue_growth_total": _growth("total"),
}

# --- sources, sinks, layout, pipeline --------------------------------------------------------

CSV_OPTIONS = {
    "header": True,
    "compression": "gzip",
    "zlib.compress.level": "BEST_SPEED",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def orders_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/orders_csv"
    with shuffles_dropped(spark):
        star.raw_orders_with_headers(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path)
    return path


def logs_csv(spark: SparkSession, sf_dir: str, folder: str) -> str:
    path = f"{folder}/logs_csv"
    star.raw_logs(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path)
    return path


def _bronze_of_file(raw: DataFrame) -> DataFrame:
    """Bronze rows of an order file, which is parsed once: rows with their types are stored, then compared."""
    root = work_folder(raw.sparkSession, "typed-orders")
    write_layer(layers.typed_orders(raw), root, "typed", "orders")
    return layers.bronze_orders(read_layer(raw.sparkSession, root, "typed", "orders"), op.BITMAP_BITS)


def csv_round_trip_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as CSV under original-style headers, read back, bronze."""
    path = orders_csv(spark, sf_dir, work_folder(spark, "csv-orders"))
    read = _bronze_of_file(read_orders_csv(spark, path))
    whole = {name: "int" for name in ["order_item_id"]}
    return settle(op.cast_columns(read, whole), NOISY)


def csv_round_trip_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written as CSV, read back, bronze."""
    path = logs_csv(spark, sf_dir, work_folder(spark, "csv-logs"))
    return settle(layers.bronze_logs(read_access_log_csv(spark, path)), as_text=("hour",))


def _read_named(spark: SparkSession, name: str) -> DataFrame:
    """A table read by name; the name is given back at once, the files stay."""
    table = spark.table(name)
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", {"name": name})
    return table


def write_and_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders written as a layer table, named, and read by name."""
    root, name = work_folder(spark, "register"), f"silver_orders_{uuid4().hex[:12]}"
    write_silver(spark, sf_dir, root, table=name)
    return settle(_read_named(spark, name), NOISY)


def dedup_few(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored raw orders without equal rows, of which only those that may have an equal are moved."""
    root = work_folder(spark, "dedup-few")
    write_layer(star.raw_orders(spark, sf_dir), root, "raw", "orders")
    rows = op.dedup_few(read_layer(spark, root, "raw", "orders"))
    return settle(op.cast_columns(rows, {"order_item_id": "int"}), NOISY, ("customer_id",))


def replace_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First silver log replaced by the second, with another schema, under one name."""
    root, name = work_folder(spark, "replace"), f"silver_logs_{uuid4().hex[:12]}"
    write_layer(log_bronze(spark, sf_dir), root, "bronze", "logs")
    stored = read_layer(spark, root, "bronze", "logs")
    write_layer(layers.silver_logs_basic(stored), root, "silver", "logs", table=name)
    write_layer(
        layers.silver_logs(stored), root, "silver", "logs", replace_schema=True, table=name
    )
    return settle(_read_named(spark, name))


# So many files even where the size asks for fewer, so that there are ranges to compare.
LEAST_FILES = 8


def _clustered_items(spark: SparkSession, sf_dir: str) -> str:
    target = f"{work_folder(spark, 'cluster')}/lineitem"
    source = f"{sf_dir}/lineitem.parquet"
    files = max(LEAST_FILES, partitions_for(data_bytes(spark, source), TARGET_FILE_BYTES))
    return compact_and_cluster(spark, source, target, "l_shipdate", files=files)


def cluster_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items rewritten in ship date order: the same rows as before."""
    rows = spark.read.parquet(_clustered_items(spark, sf_dir))
    return rows.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def items_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file ranges of the rewritten line items: rows, extremes and overlapping neighbours."""
    files = layout_stats(spark, _clustered_items(spark, sf_dir), "l_shipdate")
    # One row per file; the window compares neighbours only.
    before = F.lag("high").over(Window.orderBy("low", "high"))
    compared = files.withColumn("overlap", F.col("low") < before)
    return compared.agg(
        F.sum("rows").alias("rows"),
        F.date_format(F.min("low"), "yyyy-MM-dd").alias("low"),
        F.date_format(F.max("high"), "yyyy-MM-dd").alias("high"),
        F.count_if("overlap").alias("overlaps"),
        F.count("*").alias("files"),
    )


RECLUSTERED_FILES = 24
# About a twentieth of the line items were shipped from then on.
APPENDED_FROM = "2001-07-03"


def _appended_items(spark: SparkSession, sf_dir: str) -> tuple[str, list[str], list[str], int]:
    """Line items in order of their ship date, the last ones appended and put in order."""
    root = work_folder(spark, "recluster")
    items, late = star.table(spark, sf_dir, "lineitem"), F.col("l_shipdate") >= F.lit(APPENDED_FROM)
    names = (root, "raw", "items", "l_shipdate")
    append_clustered(items.filter(~late), *names, files=RECLUSTERED_FILES)
    for odd in (0, 1):
        append_clustered(items.filter(late & (F.col("l_orderkey") % 2 == odd)), *names, files=2)
    before = len(table_files(spark, root, "raw", "items"))
    old, new = recluster(spark, *names, file_bytes=1 << 20)
    return root, old, new, before


def reclustered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items after appends and partial clustering: the same rows."""
    root = _appended_items(spark, sf_dir)[0]
    rows = read_clustered(spark, root, "raw", "items")
    return rows.withColumn("l_shipdate", F.date_format("l_shipdate", "yyyy-MM-dd"))


def recluster_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, overlapping neighbours, and whether few files were rewritten."""
    root, old, _, before = _appended_items(spark, sf_dir)
    rows = read_clustered(spark, root, "raw", "items")
    files = rows.groupBy(F.col("_metadata.file_path")).agg(
        F.count("*").alias("rows"), F.min("l_shipdate").alias("low"), F.max("l_shipdate").alias("high")
    )
    below = F.lag("high").over(Window.orderBy("low", "high"))
    return files.withColumn("overlap", F.col("low") < below).agg(
        F.sum("rows").alias("rows"),
        F.count_if("overlap").alias("overlaps"),
        F.lit(0 < len(old) < before / 5).alias("few_rewritten"),
    )


def mart_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four marts written from stored silver orders; rows counted by the writes."""
    root = work_folder(spark, "marts")
    write_silver(spark, sf_dir, root)
    return write_marts(gold.all_marts(read_layer(spark, root, "silver", "orders")), root)


def _from_loads(name: str) -> Query:
    """A mart after silver orders came in three loads, one of them twice."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_folder(spark, "loads")
        write_silver(spark, sf_dir, root)
        rows = read_layer(spark, root, "silver", "orders")
        for load in (0, 1, 2, 1):
            add_load(rows.filter(F.pmod("order_id", F.lit(3)) == load), root, f"load-{load}")
        return settle(read_layer(spark, root, "gold", name))

    return query


def silver_orders_from_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver orders after bronze rows came in three loads that share order items."""
    root, folder = work_folder(spark, "late"), work_folder(spark, "raw-orders")
    raw = stored_orders(spark, sf_dir, folder)
    # Copies of an order item differ in their image at most.
    load = F.pmod(F.xxhash64("order_id", "product_image"), F.lit(3))
    for at in (2, 0, 1):
        # Stored, as adding it reads it more than once.
        write_layer(layers.bronze_orders(raw.filter(load == at), op.BITMAP_BITS), folder, "bronze", "load")
        add_orders(read_layer(spark, folder, "bronze", "load"), root, buckets=16)
    remove_folder(spark, folder)
    rows = op.cast_columns(orders_of(spark, root), {"order_item_id": "int"})
    return settle(rows, NOISY)


def layers_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from raw frames; mart row counts."""
    return _table_lake(spark, sf_dir)[1]


def layers_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers from CSV files; mart row counts."""
    return _csv_lake(spark, sf_dir)[1]


def _csv_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All layers from CSV files: where they are, and the mart row counts."""
    folder = work_folder(spark, "csv-layers")
    orders, logs = orders_csv(spark, sf_dir, folder), logs_csv(spark, sf_dir, folder)
    root = layer_path(folder, "lake", "tables")
    audit = run_csv_pipeline(spark, orders, logs, root)
    remove_folder(spark, orders)
    remove_folder(spark, logs)
    return root, audit


def _table_lake(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """All layers from raw frames: where they are, and the mart row counts."""
    root, folder = work_folder(spark, "layers"), work_folder(spark, "raw-orders")
    orders, logs = stored_orders(spark, sf_dir, folder), star.raw_logs(spark, sf_dir)
    audit = run_pipeline(spark, orders, logs, root, bits=op.BITMAP_BITS)
    remove_folder(spark, folder)
    return root, audit


def _stored_by(lake: Callable[..., tuple[str, DataFrame]], layer: str, name: str) -> Query:
    """A table as a whole pipeline run left it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, _ = lake(spark, sf_dir)
        rows = read_layer(spark, root, layer, name)
        if "order_item_id" in rows.columns:
            rows = op.cast_columns(rows, {"order_item_id": "int"})
        return settle(rows) if layer == "gold" else settle(rows, NOISY)

    return query


def order_rejects_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bad values in every converted column of an order file, counted per column.

    Two more rows account for the file: all its rows, and those that bronze lacks although they
    are neither equal to another nor short of a required value.
    """
    path = f"{work_folder(spark, 'bad-csv')}/orders_csv"
    with shuffles_dropped(spark):
        star.bad_orders_with_headers(spark, sf_dir).write.options(**CSV_OPTIONS).csv(path)
    raw = read_orders_csv(spark, path)
    counts = layers.order_rejects(raw)
    named = op.normalize_names(raw)
    typed = op.cast_columns(named, layers.order_casts(named))
    root = work_folder(spark, "required-orders")
    write_layer(op.require(typed, rules.ORDER_REQUIRED), root, "typed", "orders")
    required = read_layer(spark, root, "typed", "orders")
    kept = op.drop_columns(op.dedup_few(required), rules.ORDER_PRIVATE_COLUMNS)
    lost = kept.exceptAll(_bronze_of_file(raw)).agg(F.count("*").alias("rows"))
    rows = raw.agg(F.count("*").alias("rows"))
    return counts.unionByName(rows.select(F.lit("all rows").alias("rule"), "rows")).unionByName(
        lost.select(F.lit("lost rows").alias("rule"), "rows")
    )


def _lines_csv(lines: DataFrame, purpose: str) -> str:
    """Lines written as they are; the one column's name is the header."""
    path = f"{work_folder(lines.sparkSession, purpose)}/lines_csv"
    with shuffles_dropped(lines.sparkSession):
        lines.write.options(**CSV_OPTIONS, sep="\u0001", emptyValue="").csv(path)
    return path


def _raw_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_csv(star.log_lines(spark, sf_dir), "bad-logs")
    return read_access_log_csv(spark, path, malformed=True)


def _raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _lines_csv(star.order_lines(spark, sf_dir), "bad-orders")
    return read_orders_csv(spark, path, malformed=True)


def _rejects_and_accounts(rejects: DataFrame, accounts: DataFrame) -> DataFrame:
    return rejects.unionByName(accounts.withColumnRenamed("fate", "rule"))


def log_rejects_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines with values or shapes that do not fit, and what becomes of every line."""
    raw = _raw_log_lines(spark, sf_dir)
    return _rejects_and_accounts(layers.log_rejects(raw), layers.log_accounts(raw))


def order_shapes_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with values or shapes that do not fit, and what becomes of every line."""
    raw = _raw_order_lines(spark, sf_dir)
    return _rejects_and_accounts(layers.order_rejects(raw), layers.order_accounts(raw, _bronze_of_file(raw)))


def log_quarantine_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log lines set aside; whole lines with their field counts where the shape is wrong."""
    found = layers.log_quarantine(_raw_log_lines(spark, sf_dir))
    shown = found.select("product", "event_time", "hour", "ip", "malformed_row", "fields", "rejected_by")
    return settle(shown, as_text=("fields",))


def order_quarantine_from_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order lines set aside; whole lines with their field counts where the shape is wrong."""
    found = layers.order_quarantine(_raw_order_lines(spark, sf_dir))
    # Numbers print differently elsewhere: of a line, its first and last fields are shown.
    ends = F.concat_ws(
        ",", F.split("malformed_row", ",")[0], F.element_at(F.split("malformed_row", ","), -1)
    )
    shown = found.select(
        *KEY,
        "customer_email",
        F.when(F.col("malformed_row").isNotNull(), ends).alias("ends"),
        "fields",
        "rejected_by",
    )
    return settle(shown, as_text=("fields",))


TABLE_QUERIES = {
    "csv_round_trip_orders": csv_round_trip_orders,
    "csv_round_trip_logs": csv_round_trip_logs,
    "dedup_few": dedup_few,
    "silver_orders_from_loads": silver_orders_from_loads,
    "write_and_register": write_and_register,
    "replace_schema": replace_schema,
    "compact_and_cluster": cluster_items,
    "layout_stats": items_layout,
    "reclustered_items": reclustered_items,
    "recluster_layout": recluster_layout,
    "mart_row_counts": mart_row_counts,
    "all_layers_from_tables": layers_from_tables,
    "all_layers_from_csv": layers_from_csv,
    "order_rejects_from_csv": order_rejects_from_csv,
    "order_shapes_from_csv": order_shapes_from_csv,
    "order_quarantine_from_csv": order_quarantine_from_csv,
    "log_rejects_from_csv": log_rejects_from_csv,
    "log_quarantine_from_csv": log_quarantine_from_csv,
    **{f"pipeline_{name}": _stored_by(_csv_lake, "gold", name) for name in gold.MARTS},
    **{f"loads_{name}": _from_loads(name) for name in gold.MARTS},
    "pipeline_silver_orders": _stored_by(_csv_lake, "silver", "orders"),
    "pipeline_silver_logs": _stored_by(_csv_lake, "silver", "logs"),
    "tables_pipeline_kpi_summary": _stored_by(_table_lake, "gold", "kpi_summary"),
    "tables_pipeline_silver_logs": _stored_by(_table_lake, "silver", "logs"),
}


def queries() -> dict[str, Query]:
    """Every query by name."""
    return {
        **COLUMN_QUERIES,
        **FILTER_QUERIES,
        **LAYER_QUERIES,
        **MART_QUERIES,
        **REPORT_QUERIES,
        **TABLE_QUERIES,
    }
