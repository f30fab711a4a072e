"""Compare every query with its SQL twin: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from numbers import Number
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from checks.oracle import oracle_sql
from checks.queries import queries

DEFAULT_DIR = "/root/testdata/sf0.01"


def local_session(name: str = "tiermill-checks", cores: str = "8", **settings: str) -> SparkSession:
    """A local session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", cores)
        # A pipeline generates more classes than the default cache holds; evicted ones start cold.
        .config("spark.sql.codegen.cache.maxEntries", "1000")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """An in-process database with the driver's tables as views."""
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


# Results that are handed out in an order: their sort columns, descending ones marked "-".
SORTED = {
    "monthly_financials": ["order_month"],
    "top_markets_by_sales": ["-total_sales"],
    "top_categories_by_profit": ["-total_profit"],
    "late_rate_by_market": ["-avg_late_rate"],
    "revenue_trend": ["order_month"],
    "late_by_shipping_mode": ["-total_late"],
    "late_rate_by_region": ["-late_rate"],
    "revenue_by_segment": ["-revenue"],
    "market_scorecard": ["-revenue"],
    "best_months_by_profit": ["-profit"],
}


def disorder(name: str, ours: pd.DataFrame) -> str | None:
    """Where a sorted result leaves its order, or None. Nulls come first."""
    columns = SORTED.get(name)
    if not columns:
        return None
    column = columns[0]
    down, column = column.startswith("-"), column.lstrip("-")
    values = [(value is not None and value == value, value) for value in ours[column]]
    pairs = [(a, b) if not down else (b, a) for a, b in zip(values, values[1:])]
    wrong = [(a, b) for a, b in pairs if (a[0] and not b[0]) or (a[0] and b[0] and a[1] > b[1])]
    return f"not sorted by {column}: {wrong[:2]}" if wrong else None


def _kind(dtype: object) -> str:
    name = str(dtype).lower()
    if name.startswith(("int", "uint")):
        return "int"
    return "float" if name.startswith("float") else "text"


def _sorted(frame: pd.DataFrame) -> pd.DataFrame:
    def plain(value: object) -> object:
        if pd.isna(value):
            return None
        return float(value) + 0.0 if isinstance(value, Number) else value

    columns = {name: [plain(value) for value in frame[name]] for name in sorted(frame.columns)}
    shown = pd.DataFrame(columns, dtype=object)
    order = shown.map(repr).sort_values(list(shown.columns)).index
    return shown.loc[order].reset_index(drop=True)


def difference(
    result: DataFrame, con: duckdb.DuckDBPyConnection, statement: str, name: str = ""
) -> str | None:
    """What differs between a result and a statement's, or None; the order too for sorted ones."""
    ours, theirs = result.toPandas(), con.execute(statement).df()
    if problem := disorder(name, ours):
        return problem
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    if ours.empty:
        return "no rows"
    for name in ours.columns:
        left, right = _kind(ours[name].dtype), _kind(theirs[name].dtype)
        nulls = ours[name].isna().any()
        if left != right and not nulls:
            return f"type of {name}: {left} != {right}"
    left, right = _sorted(ours), _sorted(theirs)
    for name in left.columns:
        wrong = [(a, b) for a, b in zip(left[name], right[name]) if a != b]
        if wrong:
            return f"{len(wrong)} values of {name}, such as {wrong[:3]}"
    return None


def main(arguments: list[str]) -> int:
    sf_dir = arguments[0] if arguments else DEFAULT_DIR
    spark, con, sqls = local_session(), database(sf_dir), oracle_sql()
    failed = 0
    for name, query in queries().items():
        if arguments[1:] and name not in arguments[1:]:
            continue
        start = time.perf_counter()
        try:
            result = query(spark, sf_dir)
            problem = difference(result, con, sqls[name], name) if name in sqls else None
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {time.perf_counter() - start:6.2f}s {problem or 'ok'}", flush=True)
    print(f"{failed} differ")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
