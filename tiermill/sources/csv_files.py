"""CSV sources with a header row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tiermill.rules import MALFORMED

INFER = "infer"
LINE = "__line"


def _read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None,
    encoding: str,
    malformed: bool,
) -> DataFrame:
    reader = spark.read.option("header", True).option("encoding", encoding)
    if schema == INFER:
        if not malformed:
            return reader.csv(path, inferSchema=True)
        schema = reader.csv(path, inferSchema=True).schema
    if schema is None:
        # Reads one header line, not the data.
        headers = reader.csv(path).columns
        schema = StructType()
        for header in headers:
            schema = schema.add(header, StringType())
    if malformed:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        if MALFORMED in schema.names:
            raise ValueError(f"the file has a column named {MALFORMED}")
        names = schema.names
        schema = StructType(schema.fields).add(LINE, StringType())
        # A parser that skips columns nobody reads does not notice rows of the wrong shape.
        reader = reader.option("columnNameOfCorruptRecord", LINE).option("columnPruning", False)
        rows = reader.csv(path, schema=schema, enforceSchema=False)
        # Spark refuses to read that column alone, so the one handed out needs another one too.
        nothing = F.substring(F.coalesce(rows[f"`{names[0]}`"].cast("string"), F.lit("")), 1, 0)
        return rows.withColumn(MALFORMED, F.concat(LINE, nothing)).drop(LINE)
    return reader.csv(path, schema=schema, enforceSchema=False)


def read_orders_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    encoding: str = "UTF-8",
    malformed: bool = False,
) -> DataFrame:
    """Order CSV, headers as in the file, every column as text.

    Bronze converts, so that a bad value reaches the cast (and `order_rejects`) instead of vanishing
    in the reader. ``schema="infer"`` scans the data for types instead. Files under one path whose
    headers differ raise.

    A row with fewer fields than the header is filled up with nulls and one with more is cut, unless
    ``malformed`` asks for a last column ``malformed_row`` that holds the whole line of such a row (null
    for others): bronze then sets these rows aside, and rejects and quarantine show them. Blank lines are
    no rows.
    """
    return _read_csv(spark, path, schema, encoding, malformed)


def read_access_log_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    encoding: str = "UTF-8",
    malformed: bool = False,
) -> DataFrame:
    """Access log CSV, the columns its header names, all text unless a schema says otherwise.

    Bronze renames by position and raises unless there are eight columns; files under one path whose
    headers differ raise too. ``malformed`` as in `read_orders_csv`.
    """
    return _read_csv(spark, path, schema, encoding, malformed)
