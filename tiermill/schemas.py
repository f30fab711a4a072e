"""Explicit schemas of the four marts: fixed names, types and order of columns."""

from __future__ import annotations

MARTS = {
    "kpi_summary": (
        "market string, category_name string, total_sales double, total_profit double,"
        " total_orders bigint, total_late_risks bigint, avg_discount_rate double,"
        " avg_profit_ratio double, unique_customers bigint, avg_order_value double,"
        " late_delivery_rate double"
    ),
    "monthly_financials": (
        "order_month string, market string, monthly_revenue double, monthly_profit double,"
        " total_orders bigint, avg_order_value double, profit_margin_pct double"
    ),
    "shipping_performance": (
        "shipping_mode string, order_region string, avg_actual_shipping_days double,"
        " avg_scheduled_shipping_days double, total_shipments bigint,"
        " late_shipment_count bigint, on_time_failure_rate double, avg_delay_days double"
    ),
    "customer_analytics": (
        "customer_segment string, market string, total_customers bigint,"
        " avg_revenue_per_customer double, segment_revenue double, segment_profit double,"
        " total_orders bigint, total_late_risks bigint, late_delivery_rate double"
    ),
}
