"""Rows of a CSV file that have another number of fields than its header."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tiermill import operators as op
from tiermill import sources as src
from tiermill.plans import layers
from tiermill.plans.pipeline import run_csv_pipeline

LOG = "P,C,Date,M,H,D,ip,url"
GOOD = "soap,c,1/9/2018 6:05,Jan,5,d,10.0.0.1,/a"
LINES = [
    GOOD,
    GOOD,
    "Soap, big,c,1/9/2018 6:05,Jan,5,d,10.0.0.1,/a",
    "soap,c,1/9/2018 6:05,Jan,5,d,10.0.0.1",
    '"Soap, big",c,1/9/2018 6:05,Jan,5,d,10.0.0.2,/a',
    "soap,c,never,Jan,5,d,10.0.0.1,/a",
    "soap,c,1/9/2018 6:05,Jan,noon,d,10.0.0.3,/a",
    ",c,1/9/2018 6:05,Jan,5,d,10.0.0.1,/a",
    "soap,c,1/9/2018 6:05,Jan,5,d,,/a",
]


@pytest.fixture
def log(spark, tmp_path):
    path = tmp_path / "log.csv"
    path.write_text("\n".join([LOG, *LINES, ""]))
    return str(path)


def counts(df, key="rule"):
    return {row[key]: row["rows"] for row in df.collect()}


def test_every_log_line_is_kept_a_copy_or_counted(spark, log):
    raw = src.read_access_log_csv(spark, log, malformed=True)
    assert counts(layers.log_rejects(raw)) == {"row_shape": 2, "event_time": 1, "hour": 1}
    fates = counts(layers.log_accounts(raw), "fate")
    assert fates == {
        "row of the wrong shape": 2,
        "value rejected": 1,
        "value missing": 2,
        "equal copy": 1,
        "kept": 3,
    }
    assert sum(fates.values()) == len(LINES)
    kept = sorted((r.product, r.ip) for r in layers.bronze_logs(raw).collect())
    assert kept == [("soap", "10.0.0.1"), ("soap", "10.0.0.3"), ("soap, big", "10.0.0.2")]


def test_the_log_quarantine_shows_lines_and_rules(spark, log):
    raw = src.read_access_log_csv(spark, log, malformed=True)
    found = layers.log_quarantine(raw).collect()
    shown = sorted((r.malformed_row, r.fields, r.product, r.rejected_by) for r in found if r.malformed_row)
    assert shown == [(LINES[2], 9, None, ["row_shape"]), (LINES[3], 7, None, ["row_shape"])]
    others = sorted((r.event_time, r.hour, r.fields, r.rejected_by) for r in found if not r.malformed_row)
    assert others == [("1/9/2018 6:05", "noon", None, ["hour"]), ("never", "5", None, ["event_time"])]


def test_shapes_are_seen_whatever_columns_are_read(spark, log):
    raw = src.read_access_log_csv(spark, log, malformed=True)
    assert raw.filter("malformed_row IS NOT NULL").select("ip", "malformed_row").count() == 2
    assert raw.filter("malformed_row IS NULL").select("url").count() == len(LINES) - 2


def test_readers_that_do_not_ask_see_files_as_before(spark, log):
    raw = src.read_access_log_csv(spark, log)
    assert raw.columns == LOG.split(",") and raw.count() == len(LINES)
    assert counts(layers.log_rejects(raw)) == {"event_time": 2, "hour": 2}


def test_inferred_and_given_schemas(spark, log, tmp_path):
    raw = src.read_access_log_csv(spark, log, "infer", malformed=True)
    assert raw.columns == [*LOG.split(","), "malformed_row"]
    assert raw.filter("malformed_row IS NOT NULL").select("ip", "malformed_row").count() >= 2
    path = tmp_path / "orders.csv"
    path.write_text("Sales,Order Id\n1.5,7\n1.5\n1.5,7,8\n")
    given = src.read_orders_csv(spark, str(path), "Sales string, `Order Id` string", malformed=True)
    assert sorted(map(str, (r.malformed_row for r in given.collect()))) == ["1.5", "1.5,7,8", "None"]
    path.write_text("Sales,malformed_row\n1.5,7\n")
    with pytest.raises(ValueError, match="malformed_row"):
        src.read_orders_csv(spark, str(path), malformed=True)


def test_every_order_line_is_kept_a_copy_or_counted(spark, tmp_path):
    head = (
        "Order Id,Order Item Id,Customer Id,Sales,Order Item Quantity,Order Item Product Price,"
        "Order Profit Per Order,Latitude,Longitude,order date (DateOrders),shipping date (DateOrders)"
    )
    end = ",1,1,1,1,1,1/9/2018 6:05,1/9/2018 6:05"
    lines = [
        "1,1,5,1.0" + end,
        "1,1,5,1.0" + end,
        "2,1,5,1.0" + end + ",more",
        "3,1,5,1.0,1",
        "X,1,5,1.0" + end,
        "4,1,,1.0" + end,
        "5,1,5,NaN" + end,
        "6,X,5,1.0" + end,
    ]
    path = tmp_path / "orders.csv"
    path.write_text("\n".join([head, *lines, ""]))
    raw = src.read_orders_csv(spark, str(path), malformed=True)
    fates = counts(layers.order_accounts(raw), "fate")
    assert fates == {
        "row of the wrong shape": 2,
        "value rejected": 2,
        "value missing": 1,
        "equal copy": 1,
        "kept": 2,
    }
    rejects = {rule: n for rule, n in counts(layers.order_rejects(raw)).items() if n}
    assert rejects == {"row_shape": 2, "order_id": 1, "order_item_id": 1}
    aside = layers.order_quarantine(raw).filter("malformed_row IS NOT NULL").collect()
    assert sorted((r.fields, r.sales, r.rejected_by) for r in aside) == [
        (5, None, ["row_shape"]),
        (12, None, ["row_shape"]),
    ]


def test_the_pipeline_sets_rows_aside(spark, log, tmp_path):
    orders = tmp_path / "orders.csv"
    named = [
        "Order Id", "Order Item Id", "Customer Id", "Sales", "Order Item Quantity",
        "Order Item Product Price", "Order Profit Per Order", "Latitude", "Longitude",
        "order date (DateOrders)", "shipping date (DateOrders)", "Order Status", "Market",
        "Category Name", "Late_delivery_risk", "Order Item Discount Rate", "Order Item Profit Ratio",
        "Shipping Mode", "Order Region", "Days for shipping (real)", "Days for shipment (scheduled)",
        "Customer Segment", "Sales per customer", "Customer Lname", "Order Country", "Order City",
        "Customer City", "Customer State", "Order State", "Department Name",
    ]
    row = "1,1,5,2.0,1,1,1,1,1,1/9/2018 6:05,1/9/2018 6:05,COMPLETE,m,c,0,0.1,0.1,s,r,2,2,g,1,n,F,x,y,z,w,d"
    orders.write_text("\n".join([",".join(named), row, row + ",more", ""]))
    root = str(tmp_path / "lake")
    audit = run_csv_pipeline(spark, str(orders), log, root, quarantine=True)
    assert counts(audit, "mart")["kpi_summary"] == 1
    assert src.read_layer(spark, root, "silver", "orders").count() == 1
    aside = src.read_layer(spark, root, "quarantine", "orders").collect()
    assert [(r.malformed_row, r.fields) for r in aside] == [(row + ",more", len(named) + 1)]
    assert src.read_layer(spark, root, "quarantine", "logs").count() == 4
    assert src.read_layer(spark, root, "bronze", "logs").count() == 3


def test_fields_of_quoted_lines(spark):
    lines = ["a,b", '"a,b",c', 'a,"x ""y, z""",b', r'"a\",b",c', "", ",", '"' + "x" * 50_000 + ',",b']
    df = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "i int, line string")
    found = df.select("i", op.count_fields(F.col("line")).alias("n")).orderBy("i").collect()
    assert [row.n for row in found] == [2, 2, 3, 2, 1, 2, 2]
