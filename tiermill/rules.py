"""Fixed values of the cleaning and mart rules, kept as data.

Everything that decides *which* columns, patterns and thresholds apply lives here, so that a
different dataset needs different arguments and not different operators.
"""

# --- fixed values: formats -------------------------------------------------------------------
RAW_TIME_FORMAT = "M/d/yyyy H:mm"
MONTH_FORMAT = "yyyy-MM"
NON_LETTERS = r"[^a-zA-Z\s]"
ALL_DIGITS = "^[0-9]+$"

# --- fixed values: order table ---------------------------------------------------------------
ORDER_CASTS = {
    "sales": "double",
    "order_item_quantity": "int",
    "order_item_product_price": "double",
    "order_profit_per_order": "double",
    "latitude": "double",
    "longitude": "double",
}
# Converted where a source gives them as text, as a file does.
ORDER_TEXT_CASTS = {
    "order_id": "bigint",
    "order_item_id": "bigint",
    "customer_id": "bigint",
    "late_delivery_risk": "int",
    "days_for_shipping_real": "int",
    "days_for_shipment_scheduled": "int",
    "order_item_discount_rate": "double",
    "order_item_profit_ratio": "double",
    "sales_per_customer": "double",
}
ORDER_REQUIRED = ["customer_id", "order_id", "sales"]
ORDER_PRIVATE_COLUMNS = ["customer_password", "product_description", "product_image"]
ORDER_UNUSED_COLUMNS = ["order_zipcode", "customer_email"]
ORDER_NULL_DEFAULTS = {"customer_lname": "unknown"}
ORDER_LETTER_COLUMNS = ["order_country", "order_city"]
ORDER_TEXT_COLUMNS = [
    "customer_city",
    "customer_state",
    "order_city",
    "order_state",
    "category_name",
    "department_name",
    "market",
    "order_status",
]
ORDER_TIMES = {
    "order_date": "order_date_dateorders",
    "shipping_date": "shipping_date_dateorders",
}
ORDER_KEY = ["order_id", "order_item_id"]
ORDER_POSITIVE = ["sales", "order_item_quantity"]
ORDER_STATUSES = ["complete", "closed"]

# First match wins; a value that matches nothing stays as it is. LIKE is case-sensitive.
COUNTRY_RULES = [
    ("like", ["%Turqu%"], "Turkey"),
    ("like", ["%replica%congo%"], "Democratic Republic of the Congo"),
    ("in", ["Estados Unidos", "USA"], "United States"),
    ("in", ["Francia"], "France"),
    ("like", ["%Mxico%"], "Mexico"),
    ("like", ["%Jap%"], "Japan"),
    ("like", ["%Pakist%"], "Pakistan"),
]

# --- fixed values: access log ----------------------------------------------------------------
LOG_COLUMNS = ["product", "category", "event_time", "month", "hour", "department", "ip", "url"]
LOG_TEXT_COLUMNS = ["product", "category", "department"]
LOG_CASTS = {"hour": "int"}
LOG_REQUIRED = ["product", "event_time", "ip"]
LOG_HOURS = (0, 23)
NIGHT_ENDS_AT = 6
IP_PREFIX_LENGTH = 3

# --- fixed values: marts ---------------------------------------------------------------------
MART_CLUSTERING = {
    "kpi_summary": "market",
    "monthly_financials": "order_month",
    "shipping_performance": "shipping_mode",
    "customer_analytics": "customer_segment",
}
TOP_K = 5

# --- our own choices -------------------------------------------------------------------------
# Where a reader puts the whole line of a row whose number of fields is not the header's.
MALFORMED = "malformed_row"
# Which of several rows with one order key is kept: the smallest by these columns (nulls last),
# then by every other column, so the choice never depends on partitioning or task order.
ORDER_TIE_BREAK = [
    "shipping_date_dateorders",
    "sales",
    "order_profit_per_order",
    "order_item_discount_rate",
    "order_item_product_price",
    "order_item_quantity",
    "category_name",
    "department_name",
    "order_city",
]
