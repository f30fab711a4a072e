"""Raw orders and a raw access log made from the star-schema tables.

Every row of the tables goes through. Dirt is added on the way: nulls, zeros, odd spellings,
unparseable times, equal rows. `checks.oracle` states the same inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.rules import RAW_TIME_FORMAT
from tiermill.sources.sizing import broadcast_bytes, scanned_bytes

COUNTRIES = [
    "Estados Unidos",
    "Turquía",
    "Francia",
    "México",
    "Japón",
    " Pakistán ",
    "República Democrática del Congo",
    "12345",
    "USA",
    "replica x congo",
]

UNPARSEABLE_TIME = "13/45/2001 9:99"

# Original-style header -> normal name, for the columns whose header is not just the name in
# words.
ODD_HEADERS = {
    "order_date_dateorders": "order date (DateOrders)",
    "shipping_date_dateorders": "shipping date (DateOrders)",
    "days_for_shipping_real": "Days for shipping (real)",
    "days_for_shipment_scheduled": "Days for shipment (scheduled)",
    "late_delivery_risk": "Late_delivery_risk",
}


def header_of(name: str) -> str:
    """A header that normalises to the given name."""
    return ODD_HEADERS.get(name, name.replace("_", " ").title())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_copies(df: DataFrame, copied: Column) -> DataFrame:
    """Rows for which ``copied`` holds appear twice, told apart by ``copy``; one scan, no union."""
    times = F.when(copied, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("copy", F.explode(times))


def _null_when(test: Column, value: Column) -> Column:
    return F.when(~test, value)


def _computed(key: Column) -> Column:
    """The same integer as a computed value, which does not pass on the join's partitioning.

    With the plain key the dedup steps would reuse that partitioning: no shuffle of their own, so
    a hot order would stay in one task from the join to the end, and adaptive execution would
    refuse to split it in the join. (Spark folds ``key + 0`` back into the key.)
    """
    return key.bitwiseXOR(F.lit(0))


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order, customer, nation, region and part.

    Orders meet their customers first, so the largest table is shuffled for the order key and
    the part key only. Parts too large for a broadcast come before the orders: a line item is narrower
    with its part than with its order, and the rows end up beside those of their order, which files and duplicate
    removals gain by. Places join last, so that no shuffle carries their names. Both fact tables grow
    together, so their join is a merge join at every size, where adaptive execution splits a hot order
    key. Which dimension is broadcast is left to Spark, which checks sizes.
    """
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    items, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    same_order, same_part = F.col("l_orderkey") == F.col("o_orderkey"), F.col("l_partkey") == F.col("p_partkey")
    if scanned_bytes(parts) > broadcast_bytes(spark):
        facts = items.join(parts, same_part).join(orders.hint("merge"), same_order)
    else:
        facts = items.join(orders.hint("merge"), same_order).join(parts, same_part)
    return facts.join(places, F.col("c_nationkey") == F.col("n_nationkey"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders under their normal names, one row per order item, with dirt."""
    c = F.col
    facts = _with_copies(order_facts(spark, sf_dir), c("l_partkey") % 97 == 0)
    price, net = c("l_extendedprice"), c("l_extendedprice") * (1 - c("l_discount"))
    profit = net - 0.85 * c("l_quantity") * c("p_retailprice")
    days = F.datediff("l_shipdate", "o_orderdate")
    real = ((days % 7) + 7) % 7
    scheduled = (
        F.when(c("o_orderpriority") == "1-URGENT", 0)
        .when(c("o_orderpriority") == "2-HIGH", 1)
        .when(c("o_orderpriority") == "3-MEDIUM", 2)
        .otherwise(4)
    )
    country = c("n_name")
    for index, name in enumerate(COUNTRIES):
        country = F.when(c("n_nationkey") % 11 == index, name).otherwise(country)
    status = (
        F.when(c("l_partkey") % 89 == 0, F.lit(None))
        .when(c("o_orderstatus") == "F", " COMPLETE ")
        .when(c("o_orderstatus") == "O", "Closed")
        .otherwise("PENDING")
    )
    return facts.select(
        _computed(c("l_orderkey")).alias("order_id"),
        c("l_linenumber").alias("order_item_id"),
        _null_when((c("l_linenumber") == 7) & (c("l_quantity") == 5), c("o_custkey")).alias(
            "customer_id"
        ),
        _null_when(c("o_custkey") % 10 == 0, c("c_name")).alias("customer_lname"),
        F.concat("c_name", F.lit("@example.com")).alias("customer_email"),
        F.concat(F.lit("  City "), c("c_nationkey").cast("string"), F.lit(" ")).alias(
            "customer_city"
        ),
        F.upper(c("r_name").substr(1, 2)).alias("customer_state"),
        c("c_mktsegment").alias("customer_segment"),
        F.lit("XXXXXXXXX").alias("customer_password"),
        c("n_name").alias("order_region"),
        c("o_orderpriority").alias("shipping_mode"),
        F.concat(F.lit(" "), c("r_name"), F.lit(" ")).alias("market"),
        country.alias("order_country"),
        F.concat("n_name", F.lit(" City-"), (c("l_suppkey") % 3).cast("string")).alias(
            "order_city"
        ),
        F.concat("n_name", F.lit(" State")).alias("order_state"),
        (10000 + c("c_nationkey")).cast("string").alias("order_zipcode"),
        c("p_type").alias("category_name"),
        c("p_brand").alias("department_name"),
        c("p_name").alias("product_description"),
        # Some second copies differ in this private column only.
        F.concat(
            F.lit("http://images.example.com/"),
            c("p_brand"),
            F.when((c("copy") == 2) & (c("l_linenumber") == 1), "?v=2").otherwise(""),
        ).alias("product_image"),
        status.alias("order_status"),
        _null_when(
            c("l_quantity") == 13, F.when(c("l_quantity") == 17, 0.0).otherwise(price)
        ).alias("sales"),
        F.when(c("l_quantity") == 19, 0)
        .otherwise(c("l_quantity").cast("int"))
        .alias("order_item_quantity"),
        c("p_retailprice").alias("order_item_product_price"),
        c("l_discount").alias("order_item_discount_rate"),
        net.alias("sales_per_customer"),
        profit.alias("order_profit_per_order"),
        (profit / price).alias("order_item_profit_ratio"),
        (c("c_nationkey") * 1.5).cast("double").alias("latitude"),
        (c("c_nationkey") * -2.5).cast("double").alias("longitude"),
        real.alias("days_for_shipping_real"),
        scheduled.alias("days_for_shipment_scheduled"),
        # Not the same as late: real > scheduled.
        F.when(c("l_suppkey") % 3 == 0, 1).otherwise(0).alias("late_delivery_risk"),
        F.when(c("l_partkey") % 101 == 0, F.lit(None))
        .when(c("l_partkey") % 107 == 0, UNPARSEABLE_TIME)
        .otherwise(F.date_format("o_orderdate", RAW_TIME_FORMAT))
        .alias("order_date_dateorders"),
        _null_when(
            c("l_partkey") % 103 == 0, F.date_format("l_shipdate", RAW_TIME_FORMAT)
        ).alias("shipping_date_dateorders"),
    )


def raw_orders_with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders under original-style headers."""
    raw = raw_orders(spark, sf_dir)
    return raw.toDF(*[header_of(name) for name in raw.columns])


def raw_orders_as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as a text file would give them, with values that do not convert."""
    raw = raw_orders(spark, sf_dir)
    bad = F.col("l_mark") == 23
    marked = raw.withColumn("l_mark", F.col("order_item_quantity"))
    return marked.withColumns(
        {
            "sales": F.when(bad, "n/a").otherwise(F.col("sales").cast("string")),
            "order_item_quantity": F.when(F.col("l_mark") == 29, "many").otherwise(
                F.concat(F.col("l_mark").cast("string"), F.lit(".0"))
            ),
            "order_item_product_price": F.col("order_item_product_price").cast("string"),
            "order_profit_per_order": F.col("order_profit_per_order").cast("string"),
            "latitude": F.when(bad, "").otherwise(F.col("latitude").cast("string")),
            "longitude": F.col("longitude").cast("string"),
            "order_date_dateorders": F.when(bad, UNPARSEABLE_TIME).otherwise(
                F.col("order_date_dateorders")
            ),
        }
    ).drop("l_mark")


# Every converted column of an order file, with the remainder of ``l_partkey`` by 31 at which its
# value does not convert.
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


def bad_orders_with_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as text, each converted column with some values that are no numbers or times."""
    raw = raw_orders(spark, sf_dir)
    # The order's own key picks the rows, so that SQL can pick the same ones.
    mark = (F.col("order_id") + F.col("order_item_id")) % 31
    marked = raw.withColumn("__mark", mark)
    bad = marked.withColumns(
        {
            name: F.when(F.col("__mark") == at, F.concat(F.lit("X"), F.col("__mark").cast("string")))
            .otherwise(F.col(name).cast("string"))
            for name, at in BAD_VALUES.items()
        }
    ).drop("__mark")
    return bad.toDF(*[header_of(name) for name in bad.columns])


def with_wrong_shapes(rows: DataFrame, narrow: Column, wide: Column) -> DataFrame:
    """Rows as lines of a CSV file under their header, some with a field too few or too many.

    No value may hold a comma, a quote or a line break. One column, whose name is the header line: written
    with another separator, its values stay the lines they are.
    """
    fields = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")) for name in rows.columns]
    line = (
        F.when(narrow, F.concat_ws(",", *fields[:-1]))
        .when(wide, F.concat_ws(",", F.lit("Soap"), *fields))
        .otherwise(F.concat_ws(",", *fields))
    )
    return rows.select(line.alias(",".join(rows.columns)))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw log as lines; by its address, a line lacks the url, has a field too many or an odd hour."""
    octet = F.split("ip", r"\.")
    mark = F.coalesce(octet[0].cast("int") * 256 + octet[1].cast("int"), F.lit(1))
    raw = raw_logs(spark, sf_dir).withColumn("Hour", F.when(mark % 53 == 0, "noon").otherwise(F.col("Hour")))
    return with_wrong_shapes(raw, mark % 61 == 0, mark % 59 == 0)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders as lines with bad values; by customer, a line lacks a field or has one too many."""
    bad = bad_orders_with_headers(spark, sf_dir)
    mark = F.substring("Customer Email", 10, 9).cast("int")
    return with_wrong_shapes(bad, mark % 61 == 0, mark % 59 == 0)


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw access log, eight text columns in file order under file-style headers, with dirt."""
    c = F.col
    event = c("event_id")
    events = _with_copies(table(spark, sf_dir, "events"), event % 50 == 0)

    def text(column: Column) -> Column:
        return column.cast("string")

    return events.select(
        _null_when(
            event % 97 == 0, F.concat(F.lit("  "), F.upper("event_type"), F.lit(" "))
        ).alias("Product"),
        F.concat(F.lit(" Cat "), text(c("user_id") % 7)).alias("Category"),
        F.when(event % 83 == 0, F.lit(None))
        .when(event % 89 == 0, "not-a-time")
        .otherwise(F.date_format("ts", RAW_TIME_FORMAT))
        .alias("Date"),
        F.date_format("ts", "MMM").alias("Month"),
        F.when(event % 71 == 0, F.lit(None))
        .when(event % 79 == 0, "24")
        .otherwise(text(F.hour("ts")))
        .alias("Hour"),
        F.concat(F.lit(" Dept "), text(c("user_id") % 5)).alias("Department"),
        _null_when(
            event % 67 == 0,
            F.concat(
                text(c("user_id") % 223 + 1), F.lit("."), text(event % 256), F.lit(".0.1")
            ),
        ).alias("ip"),
        F.concat(
            F.lit("/department/d"), text(c("user_id") % 5), F.lit("/product/"), c("event_type")
        ).alias("url"),
    )
