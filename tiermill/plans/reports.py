"""Reports on the marts.

Names and arithmetic follow the published report queries, including where a name promises more
than it computes: the mean rates are unweighted means over mart rows, and `discount_vs_profit`
has one row per market and category with the market hidden. Sorts end with the group key, so
ties have one order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill import functions as fn
from tiermill.rules import TOP_K

GRAINS = ("row", "market", "total")


def _top(totals: DataFrame, measure: str, key: str, k: int) -> DataFrame:
    return totals.orderBy(F.desc(measure), F.asc(key)).limit(k)


def top_markets_by_sales(kpi: DataFrame, k: int = TOP_K) -> DataFrame:
    """Markets with the most sales."""
    totals = kpi.groupBy("market").agg(F.sum("total_sales").alias("total_sales"))
    return _top(totals, "total_sales", "market", k)


def top_categories_by_profit(kpi: DataFrame, k: int = TOP_K) -> DataFrame:
    """Categories with the most profit."""
    totals = kpi.groupBy("category_name").agg(F.sum("total_profit").alias("total_profit"))
    return _top(totals, "total_profit", "category_name", k)


def late_rate_by_market(kpi: DataFrame) -> DataFrame:
    """Unweighted mean late rate of a market's categories, highest first."""
    rates = kpi.groupBy("market").agg(F.avg("late_delivery_rate").alias("avg_late_rate"))
    return rates.orderBy(F.desc("avg_late_rate"), F.asc("market"))


def discount_vs_profit(kpi: DataFrame) -> DataFrame:
    """Discount and profit ratio of every mart row, highest discount first."""
    columns = ["category_name", "avg_discount_rate", "avg_profit_ratio"]
    return kpi.select(*columns).orderBy(
        F.desc("avg_discount_rate"), F.asc("avg_profit_ratio"), F.asc("category_name")
    )


def revenue_trend(monthly: DataFrame) -> DataFrame:
    """Revenue by month."""
    totals = monthly.groupBy("order_month").agg(F.sum("monthly_revenue").alias("revenue"))
    return totals.orderBy("order_month")


def _growth(current: Column, previous: Column) -> Column:
    return fn.percent(current - previous, previous)


def month_over_month(monthly: DataFrame, grain: str = "row") -> DataFrame:
    """Revenue against the row before, as ``prev_month`` and ``growth_pct``.

    * ``row``: the published report. The row before in (month, market) order, so neighbours are
      mostly *other markets*; ties in the month go by market.
    * ``market``: the month before of the same market.
    * ``total``: the month before over all markets.
    """
    if grain == "row":
        return _row_over_row(monthly)
    if grain == "market":
        facts = monthly.select("order_month", "market", "monthly_revenue")
        window = Window.partitionBy("market").orderBy("order_month")
    elif grain == "total":
        facts = monthly.groupBy("order_month").agg(
            F.sum("monthly_revenue").alias("monthly_revenue")
        )
        # One row per calendar month by now: the single window task sees a few hundred rows.
        window = Window.orderBy("order_month")
    else:
        raise ValueError(f"unknown grain {grain!r}; use one of {GRAINS}")
    revenue = F.col("monthly_revenue")
    return facts.withColumn("prev_month", F.lag(revenue).over(window)).withColumn(
        "growth_pct", _growth(revenue, F.col("prev_month"))
    )


def _row_over_row(monthly: DataFrame) -> DataFrame:
    """LAG over the whole mart in (month, market) order without sorting it in one task.

    Inside a month the row before comes from a window per month. The first row of a month takes
    the last row of the month before, found by one aggregate row per month.
    """
    facts = monthly.select("order_month", "market", "monthly_revenue")
    line = F.struct("market", "monthly_revenue")
    months = facts.groupBy("order_month").agg(F.max(line).alias("last_line"))
    carried = months.select(
        F.col("order_month").alias("carry_month"),
        F.lag("last_line.monthly_revenue").over(Window.orderBy("order_month")).alias("carry"),
    )
    in_month = Window.partitionBy("order_month").orderBy("market", "monthly_revenue")
    numbered = facts.withColumn("line_no", F.row_number().over(in_month)).withColumn(
        "line_before", F.lag("monthly_revenue").over(in_month)
    )
    joined = numbered.join(carried, F.col("order_month").eqNullSafe(F.col("carry_month")))
    previous = F.when(F.col("line_no") == 1, F.col("carry")).otherwise(F.col("line_before"))
    revenue = F.col("monthly_revenue")
    return joined.withColumn("prev_month", previous).select(
        "order_month",
        "market",
        "monthly_revenue",
        "prev_month",
        _growth(revenue, F.col("prev_month")).alias("growth_pct"),
    )


def revenue_growth_mom(monthly: DataFrame) -> DataFrame:
    """The published month-over-month report: `month_over_month` by row, without the market."""
    return month_over_month(monthly, "row").drop("market")


def late_by_shipping_mode(shipping: DataFrame) -> DataFrame:
    """Late shipments by mode, most first."""
    totals = shipping.groupBy("shipping_mode").agg(
        F.sum("late_shipment_count").alias("total_late")
    )
    return totals.orderBy(F.desc("total_late"), F.asc("shipping_mode"))


def late_rate_by_region(shipping: DataFrame) -> DataFrame:
    """Unweighted mean late rate of a region's modes, highest first."""
    rates = shipping.groupBy("order_region").agg(F.avg("on_time_failure_rate").alias("late_rate"))
    return rates.orderBy(F.desc("late_rate"), F.asc("order_region"))


def revenue_by_segment(customers: DataFrame) -> DataFrame:
    """Revenue by customer segment, most first."""
    totals = customers.groupBy("customer_segment").agg(F.sum("segment_revenue").alias("revenue"))
    return totals.orderBy(F.desc("revenue"), F.asc("customer_segment"))


def market_scorecard(kpi: DataFrame) -> DataFrame:
    """Revenue, profit and mean late rate by market."""
    scores = kpi.groupBy("market").agg(
        F.sum("total_sales").alias("revenue"),
        F.sum("total_profit").alias("profit"),
        F.avg("late_delivery_rate").alias("late_rate"),
    )
    return scores.orderBy(
        F.desc("revenue"), F.desc("profit"), F.asc("late_rate"), F.asc("market")
    )


def best_months_by_profit(monthly: DataFrame, k: int = TOP_K) -> DataFrame:
    """Months with the most profit."""
    totals = monthly.groupBy("order_month").agg(
        F.sum("monthly_revenue").alias("revenue"), F.sum("monthly_profit").alias("profit")
    )
    return _top(totals, "profit", "order_month", k)


# Report name -> (mart it reads, function).
REPORTS = {
    "top_markets_by_sales": ("kpi_summary", top_markets_by_sales),
    "top_categories_by_profit": ("kpi_summary", top_categories_by_profit),
    "late_rate_by_market": ("kpi_summary", late_rate_by_market),
    "discount_vs_profit": ("kpi_summary", discount_vs_profit),
    "revenue_trend": ("monthly_financials", revenue_trend),
    "revenue_growth_mom": ("monthly_financials", revenue_growth_mom),
    "late_by_shipping_mode": ("shipping_performance", late_by_shipping_mode),
    "late_rate_by_region": ("shipping_performance", late_rate_by_region),
    "revenue_by_segment": ("customer_analytics", revenue_by_segment),
    "market_scorecard": ("kpi_summary", market_scorecard),
    "best_months_by_profit": ("monthly_financials", best_months_by_profit),
}
