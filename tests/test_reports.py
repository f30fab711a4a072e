from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from tiermill.plans import reports
from tiermill.schemas import MARTS


@pytest.fixture(scope="module")
def kpi(spark):
    rows = [
        ("eu", "a", 100.0, 10.0, 10, 5, 1.0, 2.0, 3, 10.0, 50.0),
        ("eu", "b", 50.0, 30.0, 100, 10, 9.0, 1.0, 3, 10.0, 10.0),
        ("us", "a", 150.0, 5.0, 10, 2, 9.0, 0.5, 3, 10.0, 20.0),
        ("ap", "c", 20.0, 1.0, 10, 1, None, None, 3, 10.0, None),
    ]
    return spark.createDataFrame(rows, MARTS["kpi_summary"])


@pytest.fixture(scope="module")
def monthly(spark):
    rng = random.Random(11)
    months = [None] + [f"20{y:02d}-{m:02d}" for y in (17, 18) for m in range(1, 13)]
    rows = [
        (month, market, rng.choice([0.0, 10.0, 20.5, 31.25]), rng.uniform(-5, 5), 1, 1.0, 1.0)
        for month in months
        for market in (None, "ap", "eu", "us")
        if rng.random() < 0.7
    ]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, MARTS["monthly_financials"])


def lines(df):
    return [tuple(row) for row in df.collect()]


def test_top_reports_break_ties_by_name(kpi):
    assert lines(reports.top_markets_by_sales(kpi)) == [("eu", 150.0), ("us", 150.0), ("ap", 20.0)]
    assert lines(reports.top_markets_by_sales(kpi, 1)) == [("eu", 150.0)]
    assert lines(reports.top_categories_by_profit(kpi, 2)) == [("b", 30.0), ("a", 15.0)]
    assert "TakeOrderedAndProject" in physical_plan(reports.top_markets_by_sales(kpi))


def test_market_rates_are_unweighted_means(kpi):
    rates = dict(lines(reports.late_rate_by_market(kpi)))
    assert rates == {"eu": 30.0, "us": 20.0, "ap": None}
    weighted = kpi.filter("market = 'eu'").agg(
        F.sum("total_late_risks") / F.sum("total_orders") * 100
    )
    assert round(weighted.first()[0], 2) != rates["eu"]
    assert [m for m, _ in lines(reports.late_rate_by_market(kpi))] == ["eu", "us", "ap"]


def test_discount_report_has_one_row_per_market_and_category(kpi):
    assert lines(reports.discount_vs_profit(kpi)) == [
        ("a", 9.0, 0.5),
        ("b", 9.0, 1.0),
        ("a", 1.0, 2.0),
        ("c", None, None),
    ]


def test_scorecard_sorts_by_revenue_profit_and_rate(kpi):
    assert lines(reports.market_scorecard(kpi)) == [
        ("eu", 150.0, 40.0, 30.0),
        ("us", 150.0, 5.0, 20.0),
        ("ap", 20.0, 1.0, None),
    ]


def growth(current, previous):
    return None if not previous else round((current - previous) / previous * 100 + 1e-9, 2)


def sort_key(value):
    return (value is not None, value or "")


def lagged(rows):
    before = None
    for month, market, revenue in rows:
        yield month, market, revenue, before, None if before is None else growth(revenue, before)
        before = revenue


def test_growth_by_row_equals_one_global_lag(monthly):
    rows = [tuple(row)[:3] for row in monthly.collect()]
    rows.sort(key=lambda r: (sort_key(r[0]), sort_key(r[1])))
    expected = sorted(lagged(rows), key=repr)
    assert sorted(lines(reports.month_over_month(monthly, "row")), key=repr) == expected
    assert reports.revenue_growth_mom(monthly).columns == [
        "order_month",
        "monthly_revenue",
        "prev_month",
        "growth_pct",
    ]


def test_growth_by_row_handles_equal_months_and_single_rows(spark):
    schema = MARTS["monthly_financials"]
    empty = spark.createDataFrame([], schema)
    assert lines(reports.revenue_growth_mom(empty)) == []
    one = spark.createDataFrame([("2018-01", "eu", 5.0, 1.0, 1, 1.0, 1.0)], schema)
    assert lines(reports.revenue_growth_mom(one)) == [("2018-01", 5.0, None, None)]


def test_growth_by_market_and_total(monthly):
    rows = [tuple(row)[:3] for row in monthly.collect()]
    rows.sort(key=lambda r: sort_key(r[0]))
    expected = []
    for market in {r[1] for r in rows}:
        expected += lagged([r for r in rows if r[1] == market])
    found = lines(reports.month_over_month(monthly, "market"))
    assert sorted(found, key=repr) == sorted(expected, key=repr)

    totals = {}
    for month, _, revenue in rows:
        totals[month] = totals.get(month, 0.0) + revenue
    ordered = sorted(totals.items(), key=lambda item: sort_key(item[0]))
    expected = [(m, r, p, g) for m, _, r, p, g in lagged([(m, None, r) for m, r in ordered])]
    found = sorted(lines(reports.month_over_month(monthly, "total")), key=repr)
    assert found == sorted(expected, key=repr)


def test_growth_grain_is_checked(monthly):
    with pytest.raises(ValueError, match="week"):
        reports.month_over_month(monthly, "week")


def test_no_report_window_gathers_the_mart_in_one_task(monthly):
    plan = physical_plan(reports.month_over_month(monthly, "row"))
    # Only the one-row-per-month carry is gathered, after its aggregate.
    assert plan.split("\n\n")[0].count("Window") == 2
    assert "hashpartitioning(order_month" in plan


def test_trend_and_best_months(monthly):
    months = [row.order_month for row in reports.revenue_trend(monthly).collect()]
    assert months == sorted(months, key=sort_key)
    best = reports.best_months_by_profit(monthly).collect()
    assert len(best) == 5
    assert [row.profit for row in best] == sorted((row.profit for row in best), reverse=True)


def test_shipping_and_segment_reports(spark):
    shipping = spark.createDataFrame(
        [
            ("air", "west", 1.0, 1.0, 10, 4, 40.0, 0.0),
            ("air", "east", 1.0, 1.0, 10, 1, 10.0, 0.0),
            ("sea", "west", 1.0, 1.0, 10, 9, 90.0, 0.0),
        ],
        MARTS["shipping_performance"],
    )
    assert lines(reports.late_by_shipping_mode(shipping)) == [("sea", 9), ("air", 5)]
    assert lines(reports.late_rate_by_region(shipping)) == [("west", 65.0), ("east", 10.0)]
    customers = spark.createDataFrame(
        [("home", "eu", 1, 1.0, 5.0, 1.0, 1, 1, 1.0), ("corp", "eu", 1, 1.0, 7.0, 1.0, 1, 1, 1.0)],
        MARTS["customer_analytics"],
    )
    assert lines(reports.revenue_by_segment(customers)) == [("corp", 7.0), ("home", 5.0)]
