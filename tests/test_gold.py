from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from checks import queries as catalog
from checks import star
from tests.plans import physical_plan
from tiermill.plans import gold, layers
from tiermill.schemas import MARTS

COLUMNS = (
    "order_id bigint, customer_id bigint, market string, category_name string,"
    " customer_segment string, shipping_mode string, order_region string,"
    " order_date_dateorders string, sales double, order_profit_per_order double,"
    " late_delivery_risk int, order_item_discount_rate double, order_item_profit_ratio double,"
    " sales_per_customer double, days_for_shipping_real int, days_for_shipment_scheduled int"
)


@pytest.fixture(scope="module")
def silver(spark):
    day, next_month = "1/9/2018 6:05", "2/1/2018 0:00"
    rows = [
        (1, 7, "eu", "a", "home", "air", "west", day, 10.0, 2.0, 0, 0.1, 0.2, 9.0, 5, 3),
        (1, 7, "eu", "a", "home", "air", "west", day, 30.0, -1.0, 1, 0.2, None, 27.0, 2, 3),
        (2, 8, "eu", "a", "home", "sea", "west", next_month, 2.0, 1.0, 1, 0.0, 0.5, 2.0, None, 3),
        (3, 9, "eu", "b", "corp", "air", None, "bad", 5.0, 0.5, None, 0.0, 0.1, 5.0, 4, 4),
        (4, None, "us", "a", "corp", "air", "west", day, 1.0, 0.0, 0, 0.0, 0.0, 1.0, 4, 1),
    ]
    return spark.createDataFrame(rows, COLUMNS)


def by(df, *keys):
    return {tuple(row[k] for k in keys): row for row in df.collect()}


def test_kpis_count_items_and_distinct_customers(silver):
    kpi = by(gold.kpi_summary(silver), "market", "category_name")
    row = kpi["eu", "a"]
    assert (row.total_sales, row.total_profit) == (42.0, 2.0)
    assert (row.total_orders, row.unique_customers, row.total_late_risks) == (3, 2, 2)
    assert row.avg_order_value == 14.0
    assert (row.avg_discount_rate, row.avg_profit_ratio) == (10.0, 35.0)
    assert row.late_delivery_rate == 66.67
    assert kpi["us", "a"].unique_customers == 0
    assert kpi["eu", "b"].total_late_risks is None
    assert kpi["eu", "b"].late_delivery_rate is None


def test_months_come_from_the_raw_date(silver):
    monthly = by(gold.monthly_financials(silver), "order_month", "market")
    assert set(monthly) == {("2018-01", "eu"), ("2018-02", "eu"), (None, "eu"), ("2018-01", "us")}
    assert monthly["2018-01", "eu"].monthly_revenue == 40.0
    assert monthly["2018-01", "eu"].profit_margin_pct == 2.5
    assert monthly["2018-01", "eu"].avg_order_value == 20.0


def test_months_are_sorted_only_when_asked(silver):
    months = [row.order_month for row in gold.monthly_financials(silver).collect()]
    assert months == [None, "2018-01", "2018-01", "2018-02"]
    assert "rangepartitioning" in physical_plan(gold.monthly_financials(silver))
    assert "rangepartitioning" not in physical_plan(gold.monthly_financials(silver, False))


def test_lateness_is_actual_over_scheduled_days(silver):
    shipping = by(gold.shipping_performance(silver), "shipping_mode", "order_region")
    row = shipping["air", "west"]
    assert (row.total_shipments, row.late_shipment_count) == (3, 2)
    assert row.on_time_failure_rate == 66.67
    assert row.avg_delay_days == 1.33
    sea = shipping["sea", "west"]
    assert (sea.late_shipment_count, sea.avg_actual_shipping_days, sea.avg_delay_days) == (
        0,
        None,
        None,
    )
    assert ("air", None) in shipping


def test_segments(silver):
    customers = by(gold.customer_analytics(silver), "customer_segment", "market")
    home = customers["home", "eu"]
    assert (home.total_customers, home.total_orders, home.segment_revenue) == (2, 3, 42.0)
    assert home.avg_revenue_per_customer == 12.67
    assert home.late_delivery_rate == 66.67


@pytest.mark.parametrize("name", MARTS)
def test_mart_schemas(silver, name):
    mart = gold.all_marts(silver)[name]
    assert ", ".join(f"{column} {kind}" for column, kind in mart.dtypes) == MARTS[name]


def test_zero_revenue_has_no_margin(silver):
    nothing = silver.withColumn("sales", F.lit(0.0))
    assert {row.profit_margin_pct for row in gold.monthly_financials(nothing).collect()} == {None}


def test_marts_add_up_to_silver(spark, sf_dir):
    silver = catalog.silver(spark, sf_dir)
    whole = silver.agg(F.round(F.sum("sales"), 2), F.count("order_id")).first()
    measures = {
        "kpi_summary": ("total_sales", "total_orders"),
        "monthly_financials": ("monthly_revenue", "total_orders"),
        "customer_analytics": ("segment_revenue", "total_orders"),
    }
    for name, (money, rows) in measures.items():
        mart = gold.all_marts(silver)[name]
        assert mart.agg(F.round(F.sum(money), 2), F.sum(rows)).first() == whole
    shipped = gold.shipping_performance(silver).agg(F.sum("total_shipments")).first()[0]
    assert shipped == whole[1]


def test_groups_are_combined_before_the_shuffle(silver):
    plan = physical_plan(gold.kpi_summary(silver)).split("\n\n")[0]
    assert plan.count("HashAggregate") == 4
    assert "SortAggregate" not in plan
    # The distinct count spreads a group over (group, customer) first.
    full = physical_plan(gold.kpi_summary(silver))
    assert "hashpartitioning(market" in full and "customer_id" in full


def test_a_fifth_mart_is_a_declaration(spark, sf_dir):
    silver = layers.silver_orders(layers.bronze_orders(star.raw_orders(spark, sf_dir)))
    by_status = gold.Mart(
        keys=gold.by("order_status"),
        measures={"revenue": "revenue", "orders": "items", "late": "late_items"},
        ratios={"late_pct": gold.share_of("late", "orders")},
        columns=("order_status", "late_pct", "revenue"),
        sort="order_status",
    ).build(silver)
    assert by_status.columns == ["order_status", "late_pct", "revenue"]
    assert [row.order_status for row in by_status.collect()] == ["closed", "complete"]


def test_published_names_and_order(spark, sf_dir):
    silver = layers.silver_orders(layers.bronze_orders(star.raw_orders(spark, sf_dir)))
    for name, mart in gold.all_marts(silver).items():
        assert ", ".join(f"{c} {kind}" for c, kind in mart.dtypes) == MARTS[name]
