"""Headline timings; prints one JSON line.

The raw order and log CSV files are written first, untimed. Then each layer is timed from the
stored layer below it, each report from the stored marts, and the whole pipeline from CSV.
``top_markets_from_tables`` is the flagship query straight from the driver's tables, ``dedup_hot_key``
a keyed dedup with a third of the rows on one key. Every figure is the median of three runs after one
warm-up. The written files are removed at the end.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS`` (default 8).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import queries as catalog
from checks.compare import local_session
from tiermill import operators as op
from tiermill.plans import gold, layers, reports
from tiermill.plans.pipeline import run_csv_pipeline
from tiermill.sources import (
    compact_and_cluster,
    layer_path,
    read_access_log_csv,
    read_layer,
    read_orders_csv,
    remove_folder,
    work_folder,
    write_layer,
)

RUNS = 3


def seconds(run: Callable[[], object]) -> float:
    """Median time of three runs after a warm-up."""
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def evaluate(df: DataFrame) -> None:
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("tiermill-bench", os.environ.get("BENCH_CPUS", "8"))
    root = work_folder(spark, "bench")
    orders_csv = catalog.orders_csv(spark, sf_dir, root)
    logs_csv = catalog.logs_csv(spark, sf_dir, root)
    run_csv_pipeline(spark, orders_csv, logs_csv, root)

    def stored(layer: str, name: str) -> DataFrame:
        return read_layer(spark, root, layer, name)

    def save(df: DataFrame, name: str) -> None:
        write_layer(df, root, "bench", name)

    def raw_orders() -> DataFrame:
        return read_orders_csv(spark, orders_csv)

    def raw_logs() -> DataFrame:
        return read_access_log_csv(spark, logs_csv)

    runs: dict[str, Callable[[], object]] = {
        "bronze_orders": lambda: save(layers.bronze_orders(raw_orders()), "bronze_orders"),
        "silver_orders": lambda: save(
            layers.silver_orders(stored("bronze", "orders")), "silver_orders"
        ),
        "bronze_logs": lambda: save(layers.bronze_logs(raw_logs()), "bronze_logs"),
        "silver_logs": lambda: save(
            layers.silver_logs(stored("bronze", "logs"), distinct_input=True), "silver_logs"
        ),
    }
    for name in gold.all_marts(stored("silver", "orders")):
        runs[name] = lambda name=name: evaluate(
            gold.all_marts(stored("silver", "orders"))[name]
        )
    for name, (mart, build) in reports.REPORTS.items():
        runs[name] = lambda mart=mart, build=build: evaluate(build(stored("gold", mart)))
    runs["all_layers_from_csv"] = lambda: run_csv_pipeline(
        spark, orders_csv, logs_csv, layer_path(root, "lake", "run")
    )
    runs["top_markets_from_tables"] = lambda: evaluate(
        catalog.queries()["top_markets_by_sales"](spark, sf_dir)
    )

    items = f"{sf_dir}/lineitem.parquet"
    runs["compact_and_cluster"] = lambda: compact_and_cluster(
        spark, items, f"{root}/clustered", "l_shipdate"
    )
    # A third of the rows under one key.
    hot = F.when(F.col("l_partkey") % 3 == 0, 7).otherwise(F.col("l_orderkey"))
    runs["dedup_hot_key"] = lambda: evaluate(
        op.dedup_by_key(spark.read.parquet(items).withColumn("l_orderkey", hot), ["l_orderkey"])
    )

    times = {}
    for name, run in runs.items():
        times[name] = seconds(run)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    report = {
        "metric": "sum of median query seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    remove_folder(spark, root)
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()
