from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries as catalog
from checks import star
from tiermill import sources as src
from tiermill.plans import gold, layers, reports
from tiermill.plans.pipeline import run_csv_pipeline, run_pipeline
from tiermill.schemas import MARTS

COUNTS = {
    "kpi_summary": 30,
    "monthly_financials": 371,
    "shipping_performance": 125,
    "customer_analytics": 25,
}


def contents(spark, root, layer, name):
    table = catalog.settle(src.read_layer(spark, root, layer, name))
    return sorted(map(repr, table.collect()))


def test_the_pipeline_writes_every_layer_and_runs_again(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    orders, logs = star.raw_orders(spark, sf_dir), star.raw_logs(spark, sf_dir)
    tables = [("bronze", "orders"), ("silver", "orders"), ("bronze", "logs"), ("silver", "logs")]
    tables += [("gold", name) for name in MARTS]
    runs = []
    for _ in range(2):
        audit = run_pipeline(spark, orders, logs, root)
        assert {row.mart: row.rows for row in audit.collect()} == COUNTS
        runs.append({table: contents(spark, root, *table) for table in tables})
    assert runs[0] == runs[1]
    assert {table: len(found) for table, found in runs[0].items() if table[0] != "gold"} == {
        ("bronze", "orders"): 5876,
        ("silver", "orders"): 2869,
        ("bronze", "logs"): layers.bronze_logs(logs).count(),
        ("silver", "logs"): layers.silver_logs(layers.bronze_logs(logs)).count(),
    }
    for name in MARTS:
        stored = src.read_layer(spark, root, "gold", name)
        assert ", ".join(f"{c} {kind}" for c, kind in stored.dtypes) == MARTS[name]


def test_registered_layers_answer_sql(spark, sf_dir, tmp_path):
    run_pipeline(spark, star.raw_orders(spark, sf_dir), None, str(tmp_path), tables=True)
    for name, rows in COUNTS.items():
        assert spark.table(name).count() == rows
    assert spark.table("orders_silver").count() == 2869
    top = spark.sql(
        "SELECT market, sum(total_sales) AS total_sales FROM kpi_summary"
        " GROUP BY market ORDER BY total_sales DESC, market LIMIT 5"
    )
    ours = reports.top_markets_by_sales(spark.table("kpi_summary"))
    assert catalog.settle(ours).collect() == catalog.settle(top).collect()
    growth = spark.sql(
        "SELECT order_month, monthly_revenue, lag(monthly_revenue)"
        " OVER (ORDER BY order_month, market) AS prev_month FROM monthly_financials"
    )
    ours = reports.revenue_growth_mom(spark.table("monthly_financials")).drop("growth_pct")
    assert sorted(map(repr, ours.collect())) == sorted(map(repr, growth.collect()))
    for name in [*COUNTS, "orders_silver", "orders_bronze"]:
        spark.sql(f"DROP TABLE {name}")


def test_csv_and_frames_give_the_same_marts(spark, sf_dir, tmp_path):
    folder, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    orders = catalog.orders_csv(spark, sf_dir, folder)
    logs = catalog.logs_csv(spark, sf_dir, folder)
    audit = run_csv_pipeline(spark, orders, logs, lake)
    assert {row.mart: row.rows for row in audit.collect()} == COUNTS
    direct = gold.all_marts(catalog.silver(spark, sf_dir))
    for name, mart in direct.items():
        expected = sorted(map(repr, catalog.settle(mart).collect()))
        assert contents(spark, lake, "gold", name) == expected


def test_a_failing_branch_stops_the_pipeline(spark, sf_dir, tmp_path):
    broken = star.raw_logs(spark, sf_dir).drop("url")
    with pytest.raises(ValueError, match="8 names for 7 columns"):
        run_pipeline(spark, star.raw_orders(spark, sf_dir), broken, str(tmp_path))


def test_stateless_steps_accept_a_stream(spark, sf_dir, tmp_path):
    raw = star.raw_logs(spark, sf_dir)
    raw.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(raw.schema).parquet(str(tmp_path / "in"))
    query = (
        layers.clean_logs(stream)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    assert query.awaitTermination(120)
    out, batch = spark.read.parquet(str(tmp_path / "out")), layers.clean_logs(raw)
    assert out.exceptAll(batch).count() == batch.exceptAll(out).count() == 0


def test_bronze_shuffles_are_sized_when_frames_are_given(spark, sf_dir, tmp_path, monkeypatch):
    """The number asked for, in effect while bronze is written."""
    from tiermill.plans import pipeline

    seen = {}
    plain = pipeline.write_layer

    def watched(df, root, layer, name, *args, **kwargs):
        seen[layer, name] = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return plain(df, root, layer, name, *args, **kwargs)

    monkeypatch.setattr(pipeline, "write_layer", watched)
    orders, logs = star.raw_orders(spark, sf_dir), star.raw_logs(spark, sf_dir)
    run_pipeline(spark, orders, logs, str(tmp_path), input_bytes=40 * 128 * 2**20)
    assert seen == {(layer, name): 40 for layer in ("bronze", "silver") for name in ("orders", "logs")}


def test_inferred_types_through_the_pipeline(spark, sf_dir, tmp_path):
    folder, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    orders = catalog.orders_csv(spark, sf_dir, folder)
    audit = run_csv_pipeline(spark, orders, None, lake, schema="infer")
    assert {row.mart: row.rows for row in audit.collect()} == COUNTS


def test_marts_over_text_with_values_that_are_no_numbers(spark, sf_dir):
    raw = star.raw_orders(spark, sf_dir)
    texts = raw.select(*[F.col(name).cast("string").alias(name) for name in raw.columns])
    dirty = texts.withColumn(
        "order_item_discount_rate",
        F.when(F.col("order_item_id") == "1", "n/a").otherwise(F.col("order_item_discount_rate")),
    )
    kpi = gold.kpi_summary(layers.silver_orders(layers.bronze_orders(dirty)))
    assert kpi.count() == COUNTS["kpi_summary"]
    assert kpi.agg(F.sum("total_orders")).first()[0] == 2869
