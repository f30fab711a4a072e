from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks import star
from tests.plans import physical_plan
from tiermill import operators as op
from tiermill import rules
from tiermill.plans import layers

ORDER = {
    "Order Id": 1,
    "Order Item Id": 1,
    "Customer Id": 7,
    "Customer Lname": "Doe",
    "Customer Email": "d@example.com",
    "Customer Password": "secret",
    "Customer City": " Lyon ",
    "Customer State": "RA",
    "Customer Segment": "Consumer",
    "Order Country": "Francia",
    "Order City": "Mâcon 1",
    "Order State": " X ",
    "Order Region": "West",
    "Order Status": " COMPLETE ",
    "Category Name": " Cat ",
    "Department Name": "Dep",
    "Market": " Europe ",
    "Product Description": "one",
    "Product Image": "img",
    "Sales": "10.5",
    "Order Item Quantity": "2",
    "Order Item Product Price": "5.25",
    "Order Profit Per Order": "1.5",
    "Latitude": "1",
    "Longitude": "2",
    "order date (DateOrders)": "1/9/2018 6:05",
    "shipping date (DateOrders)": "1/12/2018 0:00",
}


@pytest.fixture
def raw(spark):
    def build(*changes):
        kinds = {name: "bigint" if isinstance(v, int) else "string" for name, v in ORDER.items()}
        schema = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
        return spark.createDataFrame([tuple({**ORDER, **c}.values()) for c in changes], schema)

    return build


def test_bronze_dedups_before_it_drops_private_columns(raw):
    bronze = layers.bronze_orders(raw({}, {}, {"Product Description": "two"}))
    assert bronze.count() == 2
    assert bronze.dropDuplicates().count() == 1
    assert not set(rules.ORDER_PRIVATE_COLUMNS) & set(bronze.columns)


def test_bronze_needs_keys_and_readable_sales(raw):
    bronze = layers.bronze_orders(
        raw({}, {"Sales": "n/a"}, {"Sales": "NaN"}, {"Customer Id": None}, {"Order Id": None})
    )
    assert bronze.count() == 1
    assert dict(bronze.dtypes)["order_item_quantity"] == "int"
    assert dict(bronze.dtypes)["latitude"] == "double"


def test_first_silver_keeps_any_status_but_null(raw):
    bronze = layers.bronze_orders(
        raw({}, {"Order Status": "PENDING"}, {"Order Status": None}, {"Sales": "0"})
    )
    statuses = [row.order_status for row in layers.silver_orders_basic(bronze).collect()]
    assert sorted(statuses) == [" COMPLETE ", "PENDING"]


def test_silver_cleans_every_field(raw):
    silver = layers.silver_orders(layers.bronze_orders(raw({"Customer Lname": None})))
    row = silver.first().asDict()
    assert row["customer_lname"] == "unknown"
    assert (row["order_country"], row["order_city"]) == ("France", "mcon")
    assert (row["market"], row["order_status"], row["customer_city"]) == (
        "europe",
        "complete",
        "lyon",
    )
    assert (row["order_region"], row["customer_segment"]) == ("West", "Consumer")
    assert row["order_date"] == datetime(2018, 1, 9, 6, 5)
    assert row["order_date_dateorders"] == "1/9/2018 6:05"
    assert "customer_email" not in row


def test_dates_are_tested_before_parsing(raw):
    silver = layers.silver_orders(
        layers.bronze_orders(
            raw(
                {"order date (DateOrders)": "bad"},
                {"Order Item Id": 2, "order date (DateOrders)": None},
            )
        )
    )
    assert [(r.order_item_id, r.order_date) for r in silver.collect()] == [(1, None)]


def test_the_kept_row_decides_whether_a_key_survives_the_status_filter(raw):
    pending_first = raw(
        {"Order Status": "PENDING", "shipping date (DateOrders)": "1/10/2018 0:00"},
        {"shipping date (DateOrders)": "1/11/2018 0:00"},
    )
    complete_first = raw(
        {"shipping date (DateOrders)": "1/10/2018 0:00"},
        {"Order Status": "PENDING", "shipping date (DateOrders)": "1/11/2018 0:00"},
    )
    assert layers.silver_orders(layers.bronze_orders(pending_first)).count() == 0
    assert layers.silver_orders(layers.bronze_orders(complete_first)).count() == 1


def test_order_rejects_name_the_bad_columns(raw):
    counts = layers.order_rejects(
        raw({"Sales": "n/a"}, {"order date (DateOrders)": "13/1/2018 1:00"}, {})
    )
    found = {row.rule: row.rows for row in counts.collect() if row.rows}
    assert found == {"sales": 1, "order_date_dateorders": 1}


@pytest.fixture
def log(spark):
    base = [" Shoe ", " Cat", "1/9/2018 6:05", "Jan", "5", " Dep ", "10.2.3.4", "/a/b"]
    headers = ["Product", "Category", "Date", "Month", "Hour", "Department", "ip", "url"]

    def build(*changes):
        rows = [
            tuple(change.get(name, value) for name, value in zip(headers, base))
            for change in changes
        ]
        return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in headers))

    return build


def test_bronze_log_is_parsed_distinct_and_derived(log):
    bronze = layers.bronze_logs(
        log({}, {"Product": "SHOE"}, {"Date": "nonsense"}, {"ip": None}, {"Product": None})
    )
    (row,) = bronze.collect()
    assert (row.product, row.hour, row.department) == ("shoe", 5, "dep")
    assert row.event_time == datetime(2018, 1, 9, 6, 5)
    assert (row.url_path, row.user_region) == (["", "a", "b"], "10")


def test_silver_log_replaces_the_region_and_checks_the_hour(log):
    bronze = layers.bronze_logs(
        log({}, {"Hour": "24"}, {"Hour": None}, {"Hour": "x"}, {"Hour": "23"})
    )
    silver = layers.silver_logs(bronze)
    rows = {(r.hour, r.is_night, r.user_region) for r in silver.collect()}
    assert rows == {(5, 1, "10."), (23, 0, "10.")}
    # The missing and the unreadable hour are both null by the time equal rows are dropped.
    assert layers.silver_logs_basic(bronze).count() == 4


def test_skipping_the_second_log_dedup_changes_nothing(spark, sf_dir, tmp_path):
    layers.bronze_logs(star.raw_logs(spark, sf_dir)).write.parquet(str(tmp_path / "bronze"))
    bronze = spark.read.parquet(str(tmp_path / "bronze"))
    full, short = layers.silver_logs(bronze), layers.silver_logs(bronze, distinct_input=True)
    assert full.exceptAll(short).count() == short.exceptAll(full).count() == 0
    assert "Exchange" in physical_plan(full)
    assert "Exchange" not in physical_plan(short)


def test_silver_has_one_row_per_key_and_only_cleaned_values(spark, sf_dir):
    bronze = layers.bronze_orders(star.raw_orders(spark, sf_dir))
    silver = layers.silver_orders(bronze)
    counts = silver.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~(F.col("sales") > 0)).alias("unsold"),
        F.count_if(~F.col("order_status").isin("complete", "closed")).alias("open"),
    ).first()
    assert counts.rows == 2869
    assert (counts.unsold, counts.open) == (0, 0)
    assert silver.select(*rules.ORDER_KEY).distinct().count() == 2869


def test_cleaning_is_one_stage_without_a_shuffle(spark, sf_dir):
    raw = star.raw_orders(spark, sf_dir).limit(0)
    frame = spark.createDataFrame([], op.normalize_names(raw).schema)
    plan = physical_plan(layers.clean_orders(frame))
    assert "Exchange" not in plan
    assert "EvalPython" not in plan


def test_a_hot_order_is_not_pinned_by_the_fact_join(spark, sf_dir):
    raw = star.raw_orders(spark, sf_dir)
    head = physical_plan(layers.bronze_orders(raw)).split("\n\n")[0]
    final, partial = head.index("HashAggregate"), head.rindex("HashAggregate")
    assert "SortMergeJoin" in head
    assert "Exchange" in head[final:partial]


def test_bronze_by_a_bitmap_is_the_same(spark, sf_dir, tmp_path):
    for name, build in (("raw_orders", layers.bronze_orders), ("raw_logs", layers.bronze_logs)):
        path = str(tmp_path / name)
        getattr(star, name)(spark, sf_dir).write.parquet(path)
        raw = spark.read.parquet(path)
        plain, few = build(raw), build(raw, bits=1 << 20)
        assert plain.count() == few.count() < raw.count()
        assert plain.exceptAll(few).count() == 0
