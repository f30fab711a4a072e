"""The queries of `checks.queries` in plain SQL over the driver's tables, for DuckDB."""

from __future__ import annotations


def stable(value: str) -> str:
    """A float sum or mean, free of the noise that depends on the order of addition."""
    return f"cast(round(cast({value} AS decimal(28,6)), 4) AS double)"


def rate(value: str) -> str:
    """A figure rounded to two digits on its decimal value."""
    return f"cast(round(cast({value} AS decimal(28,10)), 2) AS double)"


TIME = "%-m/%-d/%Y %-H:%M"
SHOWN = "%Y-%m-%d %H:%M:%S"

RAW_ORDERS = f"""
facts AS (
  SELECT *, cast(date_diff('day', o_orderdate, l_shipdate) AS integer) AS days
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
copied AS (
  SELECT *, 1 AS copy FROM facts
  UNION ALL
  SELECT *, 2 AS copy FROM facts WHERE l_partkey % 97 = 0
),
measured AS (
  SELECT *,
    l_extendedprice * (1 - l_discount) AS net,
    ((days % 7) + 7) % 7 AS actual_days,
    CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
      ELSE 4 END AS planned_days
  FROM copied
),
raw_orders AS (
  SELECT
    l_orderkey AS order_id,
    l_linenumber AS order_item_id,
    CASE WHEN l_linenumber = 7 AND l_quantity = 5 THEN NULL ELSE o_custkey END AS customer_id,
    CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE c_name END AS customer_lname,
    c_name || '@example.com' AS customer_email,
    '  City ' || c_nationkey || ' ' AS customer_city,
    upper(substr(r_name, 1, 2)) AS customer_state,
    c_mktsegment AS customer_segment,
    'XXXXXXXXX' AS customer_password,
    n_name AS order_region,
    o_orderpriority AS shipping_mode,
    ' ' || r_name || ' ' AS market,
    CASE n_nationkey % 11
      WHEN 0 THEN 'Estados Unidos' WHEN 1 THEN 'Turquía' WHEN 2 THEN 'Francia'
      WHEN 3 THEN 'México' WHEN 4 THEN 'Japón' WHEN 5 THEN ' Pakistán '
      WHEN 6 THEN 'República Democrática del Congo' WHEN 7 THEN '12345' WHEN 8 THEN 'USA'
      WHEN 9 THEN 'replica x congo' ELSE n_name END AS order_country,
    n_name || ' City-' || (l_suppkey % 3) AS order_city,
    n_name || ' State' AS order_state,
    cast(10000 + c_nationkey AS varchar) AS order_zipcode,
    p_type AS category_name,
    p_brand AS department_name,
    p_name AS product_description,
    'http://images.example.com/' || p_brand
      || CASE WHEN copy = 2 AND l_linenumber = 1 THEN '?v=2' ELSE '' END AS product_image,
    CASE WHEN l_partkey % 89 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN ' COMPLETE '
      WHEN o_orderstatus = 'O' THEN 'Closed' ELSE 'PENDING' END AS order_status,
    CASE WHEN l_quantity = 13 THEN NULL WHEN l_quantity = 17 THEN cast(0 AS double)
      ELSE l_extendedprice END AS sales,
    CASE WHEN l_quantity = 19 THEN 0 ELSE cast(trunc(l_quantity) AS integer) END
      AS order_item_quantity,
    p_retailprice AS order_item_product_price,
    l_discount AS order_item_discount_rate,
    net AS sales_per_customer,
    net - cast(0.85 AS double) * l_quantity * p_retailprice AS order_profit_per_order,
    (net - cast(0.85 AS double) * l_quantity * p_retailprice) / l_extendedprice
      AS order_item_profit_ratio,
    c_nationkey * cast(1.5 AS double) AS latitude,
    c_nationkey * cast(-2.5 AS double) AS longitude,
    cast(actual_days AS integer) AS days_for_shipping_real,
    planned_days AS days_for_shipment_scheduled,
    CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS late_delivery_risk,
    CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_partkey % 107 = 0 THEN '13/45/2001 9:99'
      ELSE strftime(o_orderdate, '{TIME}') END AS order_date_dateorders,
    CASE WHEN l_partkey % 103 = 0 THEN NULL ELSE strftime(l_shipdate, '{TIME}') END
      AS shipping_date_dateorders
  FROM measured
)"""

TEXT_ORDERS = """
text_orders AS (
  SELECT * REPLACE (
    CASE WHEN order_item_quantity = 23 THEN 'n/a' ELSE cast(sales AS varchar) END AS sales,
    CASE WHEN order_item_quantity = 29 THEN 'many' ELSE order_item_quantity || '.0' END
      AS order_item_quantity,
    cast(order_item_product_price AS varchar) AS order_item_product_price,
    cast(order_profit_per_order AS varchar) AS order_profit_per_order,
    CASE WHEN order_item_quantity = 23 THEN '' ELSE cast(latitude AS varchar) END AS latitude,
    cast(longitude AS varchar) AS longitude,
    CASE WHEN order_item_quantity = 23 THEN '13/45/2001 9:99' ELSE order_date_dateorders END
      AS order_date_dateorders)
  FROM raw_orders
)"""

BRONZE_ORDERS = """
bronze_orders AS (
  SELECT * EXCLUDE (customer_password, product_description, product_image)
  FROM (
    SELECT DISTINCT * FROM raw_orders
    WHERE customer_id IS NOT NULL AND order_id IS NOT NULL
      AND sales IS NOT NULL AND NOT isnan(sales)
  )
)"""

LETTERS = "trim(regexp_replace({0}, '[^a-zA-Z\\s]', '', 'g'))"
# The country rules and the text columns, stated here on their own.
COUNTRY = """CASE
    WHEN {0} LIKE '%Turqu%' THEN 'Turkey'
    WHEN {0} LIKE '%replica%congo%' THEN 'Democratic Republic of the Congo'
    WHEN {0} IN ('Estados Unidos', 'USA') THEN 'United States'
    WHEN {0} = 'Francia' THEN 'France'
    WHEN {0} LIKE '%Mxico%' THEN 'Mexico'
    WHEN {0} LIKE '%Jap%' THEN 'Japan'
    WHEN {0} LIKE '%Pakist%' THEN 'Pakistan'
    ELSE {0} END"""
TEXT_COLUMNS = [
    "customer_city",
    "customer_state",
    "order_city",
    "order_state",
    "category_name",
    "department_name",
    "market",
    "order_status",
]
KEEP_ORDER = ", ".join(
    f"{name} ASC NULLS LAST"
    for name in [
        "shipping_date_dateorders",
        "sales",
        "order_profit_per_order",
        "order_item_discount_rate",
        "order_item_product_price",
        "order_item_quantity",
        "category_name",
        "department_name",
        "order_city",
        "customer_id",
        "customer_lname",
        "sales_per_customer",
        "days_for_shipping_real",
    ]
)
FIRST_OF_KEY = (
    f"row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY {KEEP_ORDER}) = 1"
)

SILVER_ORDERS = f"""
chosen AS (
  SELECT * FROM bronze_orders
  WHERE order_date_dateorders IS NOT NULL AND shipping_date_dateorders IS NOT NULL
  QUALIFY {FIRST_OF_KEY}
),
lettered AS (
  SELECT * EXCLUDE (order_zipcode, customer_email) REPLACE (
    coalesce(customer_lname, 'unknown') AS customer_lname,
    {LETTERS.format("order_country")} AS order_country,
    {LETTERS.format("order_city")} AS order_city)
  FROM chosen
),
named AS (
  SELECT * REPLACE (
    {COUNTRY.format("order_country")} AS order_country,
    {", ".join(f"lower(trim({name})) AS {name}" for name in TEXT_COLUMNS)})
  FROM lettered
),
kept AS (
  SELECT *,
    try_strptime(order_date_dateorders, '{TIME}') AS order_date,
    try_strptime(shipping_date_dateorders, '{TIME}') AS shipping_date
  FROM named
),
silver_orders AS (
  SELECT * FROM kept
  WHERE sales > 0 AND order_item_quantity > 0 AND order_status IN ('complete', 'closed')
)"""

MARTS = {
    "kpi_summary": f"""
kpi_summary AS (
  SELECT market, category_name,
    {stable("sum(sales)")} AS total_sales,
    {stable("sum(order_profit_per_order)")} AS total_profit,
    count(order_id) AS total_orders,
    cast(sum(late_delivery_risk) AS bigint) AS total_late_risks,
    {rate("avg(order_item_discount_rate) * 100")} AS avg_discount_rate,
    {rate("avg(order_item_profit_ratio) * 100")} AS avg_profit_ratio,
    count(DISTINCT customer_id) AS unique_customers,
    {stable("avg(sales)")} AS avg_order_value,
    {rate("cast(sum(late_delivery_risk) AS double) / count(order_id) * 100")}
      AS late_delivery_rate
  FROM silver_orders
  GROUP BY market, category_name
)""",
    "monthly_financials": f"""
monthly_financials AS (
  SELECT strftime(try_strptime(order_date_dateorders, '{TIME}'), '%Y-%m') AS order_month, market,
    {stable("sum(sales)")} AS monthly_revenue,
    {stable("sum(order_profit_per_order)")} AS monthly_profit,
    count(order_id) AS total_orders,
    {stable("avg(sales)")} AS avg_order_value,
    {rate("sum(order_profit_per_order) / nullif(sum(sales), 0) * 100")} AS profit_margin_pct
  FROM silver_orders
  GROUP BY 1, 2
)""",
    "shipping_performance": f"""
shipping_performance AS (
  SELECT shipping_mode, order_region,
    {stable("avg(days_for_shipping_real)")} AS avg_actual_shipping_days,
    {stable("avg(days_for_shipment_scheduled)")} AS avg_scheduled_shipping_days,
    count(order_id) AS total_shipments,
    count(*) FILTER (WHERE days_for_shipping_real > days_for_shipment_scheduled)
      AS late_shipment_count,
    {rate(
        "cast(count(*) FILTER (WHERE days_for_shipping_real > days_for_shipment_scheduled)"
        " AS double) / count(order_id) * 100"
    )} AS on_time_failure_rate,
    {rate("avg(days_for_shipping_real) - avg(days_for_shipment_scheduled)")} AS avg_delay_days
  FROM silver_orders
  GROUP BY shipping_mode, order_region
)""",
    "customer_analytics": f"""
customer_analytics AS (
  SELECT customer_segment, market,
    count(DISTINCT customer_id) AS total_customers,
    {rate("avg(sales_per_customer)")} AS avg_revenue_per_customer,
    {stable("sum(sales)")} AS segment_revenue,
    {stable("sum(order_profit_per_order)")} AS segment_profit,
    count(order_id) AS total_orders,
    cast(sum(late_delivery_risk) AS bigint) AS total_late_risks,
    {rate("cast(sum(late_delivery_risk) AS double) / count(order_id) * 100")}
      AS late_delivery_rate
  FROM silver_orders
  GROUP BY customer_segment, market
)""",
}

RAW_LOGS = f"""
copied_events AS (
  SELECT * FROM events
  UNION ALL
  SELECT * FROM events WHERE event_id % 50 = 0
),
raw_logs AS (
  SELECT
    CASE WHEN event_id % 97 = 0 THEN NULL ELSE '  ' || upper(event_type) || ' ' END AS product,
    ' Cat ' || (user_id % 7) AS category,
    CASE WHEN event_id % 83 = 0 THEN NULL WHEN event_id % 89 = 0 THEN 'not-a-time'
      ELSE strftime(ts, '{TIME}') END AS event_time,
    strftime(ts, '%b') AS month,
    CASE WHEN event_id % 71 = 0 THEN NULL WHEN event_id % 79 = 0 THEN '24'
      ELSE cast(hour(ts) AS varchar) END AS hour,
    ' Dept ' || (user_id % 5) AS department,
    CASE WHEN event_id % 67 = 0 THEN NULL
      ELSE (user_id % 223 + 1) || '.' || (event_id % 256) || '.0.1' END AS ip,
    '/department/d' || (user_id % 5) || '/product/' || event_type AS url
  FROM copied_events
)"""

CLEAN_LOGS = f"""
parsed_logs AS (
  SELECT * REPLACE (
    lower(trim(product)) AS product,
    lower(trim(category)) AS category,
    lower(trim(department)) AS department,
    try_strptime(event_time, '{TIME}') AS event_time,
    try_cast(hour AS integer) AS hour)
  FROM raw_logs
),
clean_logs AS (
  SELECT * FROM parsed_logs
  WHERE product IS NOT NULL AND event_time IS NOT NULL AND ip IS NOT NULL
)"""

BRONZE_LOGS = """
bronze_logs AS (
  SELECT *, string_split(url, '/') AS url_path, string_split(ip, '.')[1] AS user_region
  FROM (SELECT DISTINCT * FROM clean_logs)
)"""

SILVER_LOGS = """
silver_logs AS (
  SELECT * REPLACE (substr(ip, 1, 3) AS user_region),
    CASE WHEN hour < 6 THEN 1 ELSE 0 END AS is_night
  FROM (SELECT DISTINCT * FROM bronze_logs)
  WHERE event_time IS NOT NULL AND product IS NOT NULL AND hour BETWEEN 0 AND 23
)"""

RAW = [RAW_ORDERS]
TEXT = [RAW_ORDERS, TEXT_ORDERS]
BRONZE = [RAW_ORDERS, BRONZE_ORDERS]
SILVER = [RAW_ORDERS, BRONZE_ORDERS, SILVER_ORDERS]
LOG_RAW = [RAW_LOGS]
LOG_CLEAN = [RAW_LOGS, CLEAN_LOGS]
LOG_BRONZE = [RAW_LOGS, CLEAN_LOGS, BRONZE_LOGS]
LOG_SILVER = [RAW_LOGS, CLEAN_LOGS, BRONZE_LOGS, SILVER_LOGS]

KEY = "order_id, order_item_id"
LOG_SHOWN = f"""product, category, strftime(event_time, '{SHOWN}') AS event_time, month,
  cast(hour AS varchar) AS hour, department, ip, url, array_to_string(url_path, '|') AS url_path, user_region"""
ORDER_SHOWN = f"""* REPLACE (
  strftime(order_date, '{SHOWN}') AS order_date,
  strftime(shipping_date, '{SHOWN}') AS shipping_date)"""


def sql(parts: list[str], select: str) -> str:
    """A statement from common table expressions and a final select."""
    return "WITH" + ",".join(parts) + "\n" + select


def on_mart(mart: str, select: str) -> str:
    """A statement over one mart."""
    return sql([*SILVER, MARTS[mart]], select)


def _growth(window: str) -> str:
    before = f"lag(monthly_revenue) OVER ({window})"
    change = f"(monthly_revenue - {before}) / nullif({before}, 0) * 100"
    return f"monthly_revenue, {before} AS prev_month, {rate(change)} AS growth_pct"


MART_COUNTS = sql(
    [*SILVER, *MARTS.values()],
    "\nUNION ALL\n".join(
        f"SELECT '{name}' AS mart, count(*) AS \"rows\" FROM {name}" for name in MARTS
    ),
)

COLUMN_SQL = {
    "normalize_names": sql(
        RAW,
        f"""SELECT {KEY}, customer_segment, days_for_shipping_real, days_for_shipment_scheduled,
          late_delivery_risk, order_date_dateorders, shipping_date_dateorders FROM raw_orders""",
    ),
    "rename_positional": sql(LOG_RAW, "SELECT * FROM raw_logs"),
    "cast_columns": sql(
        TEXT,
        f"""SELECT {KEY}, try_cast(sales AS double) AS sales,
          cast(try_cast(trunc(try_cast(order_item_quantity AS decimal(38,10))) AS integer) AS varchar)
            AS order_item_quantity,
          try_cast(order_item_product_price AS double) AS order_item_product_price,
          {stable("try_cast(order_profit_per_order AS double)")} AS order_profit_per_order,
          try_cast(latitude AS double) AS latitude, try_cast(longitude AS double) AS longitude
        FROM text_orders""",
    ),
    "drop_columns": sql(
        RAW,
        f"""SELECT * EXCLUDE (customer_password, product_description, product_image) REPLACE (
          cast(customer_id AS varchar) AS customer_id,
          {stable("sales_per_customer")} AS sales_per_customer,
          {stable("order_profit_per_order")} AS order_profit_per_order,
          {stable("order_item_profit_ratio")} AS order_item_profit_ratio) FROM raw_orders""",
    ),
    "drop_unused_columns": sql(
        BRONZE,
        f"""SELECT * EXCLUDE (order_zipcode, customer_email) REPLACE (
          {stable("sales_per_customer")} AS sales_per_customer,
          {stable("order_profit_per_order")} AS order_profit_per_order,
          {stable("order_item_profit_ratio")} AS order_item_profit_ratio) FROM bronze_orders""",
    ),
    "fill_nulls": sql(
        RAW,
        f"""SELECT {KEY}, coalesce(customer_lname, 'unknown') AS customer_lname
        FROM raw_orders""",
    ),
    "normalize_text": sql(
        RAW,
        f"""SELECT {KEY}, {", ".join(f"lower(trim({n})) AS {n}" for n in TEXT_COLUMNS)}
        FROM raw_orders""",
    ),
    "strip_non_letters": sql(
        RAW,
        f"""SELECT {KEY}, {LETTERS.format("order_country")} AS order_country,
          {LETTERS.format("order_city")} AS order_city FROM raw_orders""",
    ),
    "null_if_numeric": sql(
        RAW,
        f"""SELECT {KEY}, CASE WHEN regexp_full_match(order_country, '[0-9]+') THEN NULL
          ELSE order_country END AS order_country FROM raw_orders""",
    ),
    "canonicalize_country": sql(
        RAW,
        f"""SELECT {KEY}, {COUNTRY.format("order_country")} AS order_country FROM
          (SELECT {KEY}, {LETTERS.format("order_country")} AS order_country FROM raw_orders)""",
    ),
    "parse_order_dates": sql(
        TEXT,
        f"""SELECT {KEY}, order_date_dateorders, shipping_date_dateorders,
          strftime(try_strptime(order_date_dateorders, '{TIME}'), '{SHOWN}') AS order_date,
          strftime(try_strptime(shipping_date_dateorders, '{TIME}'), '{SHOWN}') AS shipping_date
        FROM text_orders""",
    ),
    "reparse_event_time": sql(
        LOG_CLEAN,
        f"SELECT ip, url, strftime(event_time, '{SHOWN}') AS event_time FROM clean_logs",
    ),
    "split_path": sql(
        LOG_RAW,
        """SELECT url, array_to_string(string_split(url, '/'), '|') AS url_path,
          cast(len(string_split(url, '/')) AS integer) AS parts FROM raw_logs""",
    ),
    "ip_first_octet": sql(
        LOG_RAW, "SELECT ip, string_split(ip, '.')[1] AS user_region FROM raw_logs"
    ),
    "ip_prefix": sql(LOG_RAW, "SELECT ip, substr(ip, 1, 3) AS user_region FROM raw_logs"),
    "flag_night": sql(
        LOG_RAW,
        """SELECT ip, cast(hour AS varchar) AS hour, CASE WHEN hour < 6 THEN 1 ELSE 0 END AS is_night
        FROM (SELECT ip, try_cast(hour AS integer) AS hour FROM raw_logs)""",
    ),
    "month_bucket": sql(
        RAW,
        f"""SELECT {KEY}, strftime(try_strptime(order_date_dateorders, '{TIME}'), '%Y-%m')
          AS order_month FROM raw_orders""",
    ),
    "percent": sql(
        RAW,
        f"""SELECT {KEY}, {rate("order_profit_per_order / nullif(sales, 0) * 100")}
          AS profit_pct FROM raw_orders""",
    ),
}

FILTER_SQL = {
    "require_orders": sql(
        RAW,
        f"""SELECT {KEY}, customer_id, sales FROM raw_orders
        WHERE customer_id IS NOT NULL AND order_id IS NOT NULL AND sales IS NOT NULL""",
    ),
    "require_logs": sql(
        LOG_CLEAN,
        f"""SELECT product, strftime(event_time, '{SHOWN}') AS event_time, ip FROM clean_logs""",
    ),
    "positive_sales": sql(
        RAW,
        f"""SELECT {KEY}, sales, order_item_quantity FROM raw_orders
        WHERE sales > 0 AND order_item_quantity > 0""",
    ),
    "status_present": sql(
        RAW, f"SELECT {KEY}, order_status FROM raw_orders WHERE order_status IS NOT NULL"
    ),
    "dates_present": sql(
        RAW,
        f"""SELECT {KEY}, order_date_dateorders, shipping_date_dateorders FROM raw_orders
        WHERE order_date_dateorders IS NOT NULL AND shipping_date_dateorders IS NOT NULL""",
    ),
    "valid_status": sql(
        RAW,
        f"""SELECT {KEY}, lower(trim(order_status)) AS order_status FROM raw_orders
        WHERE lower(trim(order_status)) IN ('complete', 'closed')""",
    ),
    "valid_hour": sql(
        LOG_CLEAN, "SELECT product, ip, hour FROM clean_logs WHERE hour BETWEEN 0 AND 23"
    ),
    "event_present": sql(
        LOG_CLEAN,
        f"""SELECT product, strftime(event_time, '{SHOWN}') AS event_time, ip FROM parsed_logs
        WHERE event_time IS NOT NULL AND product IS NOT NULL""",
    ),
    "dedup_rows": sql(
        RAW,
        f"""SELECT * REPLACE (
          cast(customer_id AS varchar) AS customer_id,
          {stable("sales_per_customer")} AS sales_per_customer,
          {stable("order_profit_per_order")} AS order_profit_per_order,
          {stable("order_item_profit_ratio")} AS order_item_profit_ratio)
        FROM (SELECT DISTINCT * FROM raw_orders)""",
    ),
    "dedup_by_key": sql(
        RAW,
        f"""SELECT {KEY}, order_date_dateorders, shipping_date_dateorders, sales,
          {stable("order_profit_per_order")} AS order_profit_per_order, order_status, order_city
        FROM raw_orders QUALIFY {FIRST_OF_KEY}""",
    ),
    "order_quarantine": sql(
        TEXT,
        f"""SELECT * FROM (SELECT {KEY}, sales, concat_ws('|',
          CASE WHEN sales = 'n/a' THEN 'sales' END,
          CASE WHEN order_item_quantity = 'many' THEN 'order_item_quantity' END,
          CASE WHEN latitude = '' THEN 'latitude' END,
          CASE WHEN order_date_dateorders = '13/45/2001 9:99' THEN 'order_date_dateorders' END)
          AS rejected_by FROM text_orders) WHERE rejected_by <> ''""",
    ),
    "order_rejects": sql(
        TEXT,
        "\nUNION ALL\n".join(
            f"""SELECT '{name}' AS rule, count(*) AS "rows" FROM text_orders
            WHERE {name} IS NOT NULL AND {test} IS NULL"""
            for name, test in {
                **{
                    n: f"try_cast({n} AS double)"
                    for n in [
                        "sales",
                        "order_item_quantity",
                        "order_item_product_price",
                        "order_profit_per_order",
                        "latitude",
                        "longitude",
                    ]
                },
                **{
                    n: f"try_strptime({n}, '{TIME}')"
                    for n in ["order_date_dateorders", "shipping_date_dateorders"]
                },
            }.items()
        ),
    ),
}

ROUNDED = f"""{stable("sales_per_customer")} AS sales_per_customer,
  {stable("order_profit_per_order")} AS order_profit_per_order,
  {stable("order_item_profit_ratio")} AS order_item_profit_ratio"""

LAYER_SQL = {
    "bronze_orders": sql(BRONZE, f"SELECT * REPLACE ({ROUNDED}) FROM bronze_orders"),
    "silver_orders_basic": sql(
        BRONZE,
        f"""SELECT * REPLACE ({ROUNDED}) FROM bronze_orders
        WHERE sales > 0 AND order_item_quantity > 0 AND order_status IS NOT NULL""",
    ),
    "silver_orders": sql(
        SILVER,
        f"""SELECT * REPLACE ({ROUNDED}, strftime(order_date, '{SHOWN}') AS order_date,
          strftime(shipping_date, '{SHOWN}') AS shipping_date) FROM silver_orders""",
    ),
    "bronze_logs": sql(LOG_BRONZE, f"SELECT {LOG_SHOWN} FROM bronze_logs"),
    "silver_logs_basic": sql(
        LOG_BRONZE,
        f"""SELECT {LOG_SHOWN} FROM bronze_logs
        WHERE event_time IS NOT NULL AND product IS NOT NULL""",
    ),
    "silver_logs": sql(LOG_SILVER, f"SELECT * REPLACE (hour::integer AS hour) FROM (SELECT {LOG_SHOWN}, is_night FROM silver_logs)"),
}

MART_SQL = {name: on_mart(name, f"SELECT * FROM {name}") for name in MARTS}

REPORT_SQL = {
    "top_markets_by_sales": on_mart(
        "kpi_summary",
        f"""SELECT market, {stable("sum(total_sales)")} AS total_sales FROM kpi_summary
        GROUP BY market ORDER BY total_sales DESC, market LIMIT 5""",
    ),
    "top_categories_by_profit": on_mart(
        "kpi_summary",
        f"""SELECT category_name, {stable("sum(total_profit)")} AS total_profit FROM kpi_summary
        GROUP BY category_name ORDER BY total_profit DESC, category_name LIMIT 5""",
    ),
    "late_rate_by_market": on_mart(
        "kpi_summary",
        f"""SELECT market, {stable("avg(late_delivery_rate)")} AS avg_late_rate
        FROM kpi_summary GROUP BY market""",
    ),
    "discount_vs_profit": on_mart(
        "kpi_summary",
        "SELECT category_name, avg_discount_rate, avg_profit_ratio FROM kpi_summary",
    ),
    "revenue_trend": on_mart(
        "monthly_financials",
        f"""SELECT order_month, {stable("sum(monthly_revenue)")} AS revenue
        FROM monthly_financials GROUP BY order_month""",
    ),
    "revenue_growth_mom": on_mart(
        "monthly_financials",
        f"""SELECT order_month,
          {_growth("ORDER BY order_month NULLS FIRST, market NULLS FIRST")}
        FROM monthly_financials""",
    ),
    "revenue_growth_by_market": on_mart(
        "monthly_financials",
        f"""SELECT order_month, market,
          {_growth("PARTITION BY market ORDER BY order_month NULLS FIRST")}
        FROM monthly_financials""",
    ),
    "revenue_growth_total": sql(
        [
            *SILVER,
            MARTS["monthly_financials"],
            f"""
months AS (
  SELECT order_month, {stable("sum(monthly_revenue)")} AS monthly_revenue
  FROM monthly_financials GROUP BY order_month
)""",
        ],
        f"SELECT order_month, {_growth('ORDER BY order_month NULLS FIRST')} FROM months",
    ),
    "late_by_shipping_mode": on_mart(
        "shipping_performance",
        """SELECT shipping_mode, cast(sum(late_shipment_count) AS bigint) AS total_late
        FROM shipping_performance GROUP BY shipping_mode""",
    ),
    "late_rate_by_region": on_mart(
        "shipping_performance",
        f"""SELECT order_region, {stable("avg(on_time_failure_rate)")} AS late_rate
        FROM shipping_performance GROUP BY order_region""",
    ),
    "revenue_by_segment": on_mart(
        "customer_analytics",
        f"""SELECT customer_segment, {stable("sum(segment_revenue)")} AS revenue
        FROM customer_analytics GROUP BY customer_segment""",
    ),
    "market_scorecard": on_mart(
        "kpi_summary",
        f"""SELECT market, {stable("sum(total_sales)")} AS revenue,
          {stable("sum(total_profit)")} AS profit,
          {stable("avg(late_delivery_rate)")} AS late_rate FROM kpi_summary GROUP BY market""",
    ),
    "best_months_by_profit": on_mart(
        "monthly_financials",
        f"""SELECT order_month, {stable("sum(monthly_revenue)")} AS revenue,
          {stable("sum(monthly_profit)")} AS profit FROM monthly_financials
        GROUP BY order_month ORDER BY profit DESC, order_month LIMIT 5""",
    ),
}

TABLE_SQL = {
    "csv_round_trip_orders": LAYER_SQL["bronze_orders"],
    "csv_round_trip_logs": LAYER_SQL["bronze_logs"],
    "silver_orders_from_loads": LAYER_SQL["silver_orders"],
    "dedup_few": FILTER_SQL["dedup_rows"],
    "write_and_register": LAYER_SQL["silver_orders"],
    "replace_schema": LAYER_SQL["silver_logs"],
    "compact_and_cluster": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate)"
    " FROM lineitem",
    "layout_stats": """SELECT count(*) AS "rows",
          strftime(min(l_shipdate), '%Y-%m-%d') AS low,
          strftime(max(l_shipdate), '%Y-%m-%d') AS high,
          cast(0 AS bigint) AS overlaps,
          cast(8 AS bigint) AS files FROM lineitem""",
    "reclustered_items": "SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate) FROM lineitem",
    "recluster_layout": """SELECT count(*) AS "rows", cast(0 AS bigint) AS overlaps, true AS few_rewritten
        FROM lineitem""",
    "mart_row_counts": MART_COUNTS,
    "all_layers_from_tables": MART_COUNTS,
    "all_layers_from_csv": MART_COUNTS,
}


# The remainders at which the bad order file has a value that does not convert.
BAD_VALUES = {
    "order_id": 1,
    "order_item_id": 2,
    "customer_id": 3,
    "late_delivery_risk": 4,
    "days_for_shipping_real": 5,
    "days_for_shipment_scheduled": 6,
    "order_item_discount_rate": 7,
    "order_item_profit_ratio": 8,
    "sales_per_customer": 9,
    "sales": 10,
    "order_item_quantity": 11,
    "order_item_product_price": 12,
    "order_profit_per_order": 13,
    "latitude": 14,
    "longitude": 15,
    "order_date_dateorders": 16,
    "shipping_date_dateorders": 17,
}


def _bad_count(name: str, at: int) -> str:
    marked = f"(order_id + order_item_id) % 31 = {at}"
    wrong = marked
    if name == "order_date_dateorders":
        wrong += f" OR {name} = '13/45/2001 9:99'"
    return f"""SELECT '{name}' AS rule, count(*) FILTER (WHERE {wrong}) AS "rows" FROM raw_orders"""


LOG_MARK = "coalesce(cast(split_part(ip, '.', 1) AS integer) * 256 + cast(split_part(ip, '.', 2) AS integer), 1)"
LOG_LINES = [
    RAW_LOGS,
    f"""
marked AS (
  SELECT * REPLACE (CASE WHEN mark % 53 = 0 THEN 'noon' ELSE hour END AS hour),
    mark % 61 = 0 AS narrow, mark % 61 <> 0 AND mark % 59 = 0 AS wide
  FROM (SELECT *, {LOG_MARK} AS mark FROM raw_logs)
),
sound AS (SELECT * FROM marked WHERE NOT narrow AND NOT wide),
kept AS (
  SELECT DISTINCT lower(trim(product)), lower(trim(category)), lower(trim(department)),
    try_strptime(event_time, '{TIME}'), try_cast(hour AS integer), month, ip, url
  FROM sound WHERE product IS NOT NULL AND ip IS NOT NULL AND try_strptime(event_time, '{TIME}') IS NOT NULL
)""",
]
ORDER_MARK = "cast(substr(customer_email, 10, 9) AS integer)"
ORDER_LINES = [
    RAW_ORDERS,
    f"""
marked AS (
  SELECT *, {ORDER_MARK} % 61 = 0 AS narrow, {ORDER_MARK} % 61 <> 0 AND {ORDER_MARK} % 59 = 0 AS wide,
    (order_id + order_item_id) % 31 AS bad
  FROM raw_orders
),
sound AS (SELECT * FROM marked WHERE NOT narrow AND NOT wide),
candidates AS (
  SELECT * FROM sound WHERE bad NOT IN (1, 3, 10) AND customer_id IS NOT NULL AND sales IS NOT NULL
)""",
]


def _count(rule: str, rows: str, test: str = "true") -> str:
    return f"""SELECT '{rule}' AS rule, count(*) FILTER (WHERE {test}) AS "rows" FROM {rows}"""


def _accounted(lost: str, missing: str, candidates: str, kept: str) -> list[str]:
    return [
        _count("row_shape", "marked", "narrow OR wide"),
        _count("row of the wrong shape", "marked", "narrow OR wide"),
        _count("value rejected", "sound", lost),
        _count("value missing", "sound", f"NOT ({lost}) AND ({missing})"),
        f"""SELECT 'equal copy' AS rule, (SELECT count(*) FROM {candidates}) - (SELECT count(*) FROM {kept})""",
        _count("kept", kept),
    ]


TABLE_SQL |= {
    "log_rejects_from_csv": sql(
        LOG_LINES,
        "\nUNION ALL\n".join(
            [
                _count("event_time", "sound", "event_time = 'not-a-time'"),
                _count("hour", "sound", "hour = 'noon'"),
                *_accounted(
                    "event_time IS NOT DISTINCT FROM 'not-a-time'",
                    "product IS NULL OR event_time IS NULL OR ip IS NULL",
                    "(SELECT * FROM sound WHERE product IS NOT NULL AND ip IS NOT NULL"
                    f" AND try_strptime(event_time, '{TIME}') IS NOT NULL)",
                    "kept",
                ),
            ]
        ),
    ),
    "log_quarantine_from_csv": sql(
        LOG_LINES,
        """SELECT product, event_time, hour, ip, NULL AS malformed_row, NULL AS fields,
          concat_ws('|', CASE WHEN event_time = 'not-a-time' THEN 'event_time' END,
            CASE WHEN hour = 'noon' THEN 'hour' END) AS rejected_by
        FROM sound WHERE event_time = 'not-a-time' OR hour = 'noon'
        UNION ALL
        SELECT NULL, NULL, NULL, NULL,
          CASE WHEN wide THEN 'Soap,' ELSE '' END || array_to_string([coalesce(product, ''), category,
            coalesce(event_time, ''), month, coalesce(hour, ''), department, coalesce(ip, '')], ',')
            || CASE WHEN wide THEN ',' || url ELSE '' END,
          CASE WHEN wide THEN '9' ELSE '7' END, 'row_shape'
        FROM marked WHERE narrow OR wide""",
    ),
    "order_shapes_from_csv": sql(
        ORDER_LINES,
        "\nUNION ALL\n".join(
            [
                _bad_count(name, at).replace("FROM raw_orders", "FROM sound")
                for name, at in BAD_VALUES.items()
            ]
            + _accounted(
                "bad IN (1, 3, 10)",
                "customer_id IS NULL OR sales IS NULL",
                "candidates",
                "(SELECT DISTINCT * FROM candidates)",
            )
        ),
    ),
    "order_quarantine_from_csv": sql(
        ORDER_LINES,
        "SELECT CASE WHEN bad = 1 THEN 'X1' ELSE cast(order_id AS varchar) END AS order_id,"
        " CASE WHEN bad = 2 THEN 'X2' ELSE cast(order_item_id AS varchar) END AS order_item_id,"
        " customer_email, NULL AS ends, NULL AS fields, concat_ws('|', "
        + ", ".join(
            f"CASE WHEN bad = {at}"
            + (f" OR {name} = '13/45/2001 9:99'" if name == "order_date_dateorders" else "")
            + f" THEN '{name}' END"
            for name, at in BAD_VALUES.items()
        )
        + """) AS rejected_by FROM sound
        WHERE bad BETWEEN 1 AND 17 OR order_date_dateorders = '13/45/2001 9:99'
        UNION ALL
        SELECT NULL, NULL, NULL,
          CASE WHEN wide THEN 'Soap' WHEN bad = 1 THEN 'X1' ELSE cast(order_id AS varchar) END || ',' ||
          CASE WHEN wide THEN CASE WHEN bad = 17 THEN 'X17' ELSE coalesce(shipping_date_dateorders, '') END
            WHEN bad = 16 THEN 'X16' ELSE coalesce(order_date_dateorders, '') END,
          CASE WHEN wide THEN '36' ELSE '34' END, 'row_shape'
        FROM marked WHERE narrow OR wide""",
    ),
}

TABLE_SQL |= {
    "order_rejects_from_csv": sql(
        RAW,
        "\nUNION ALL\n".join(
            [_bad_count(name, at) for name, at in BAD_VALUES.items()]
            + ["""SELECT 'all rows' AS rule, count(*) AS "rows" FROM raw_orders"""]
            + ["""SELECT 'lost rows' AS rule, cast(0 AS bigint) AS "rows" """]
        ),
    ),
    **{f"pipeline_{name}": MART_SQL[name] for name in MARTS},
    **{f"loads_{name}": MART_SQL[name] for name in MARTS},
    "pipeline_silver_orders": LAYER_SQL["silver_orders"],
    "pipeline_silver_logs": LAYER_SQL["silver_logs"],
    "tables_pipeline_kpi_summary": MART_SQL["kpi_summary"],
    "tables_pipeline_silver_logs": LAYER_SQL["silver_logs"],
}


def oracle_sql() -> dict[str, str]:
    """SQL per query name."""
    return {
        **COLUMN_SQL,
        **FILTER_SQL,
        **LAYER_SQL,
        **MART_SQL,
        **REPORT_SQL,
        **TABLE_SQL,
    }
