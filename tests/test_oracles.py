"""Every query against its SQL twin on the smallest data set."""

from __future__ import annotations

import pandas as pd
import pytest

import __spark_entry__ as contract
from checks.compare import SORTED, database, difference, disorder
from checks import star
from checks.oracle import oracle_sql
from checks.queries import queries
from tiermill import operators as op
from tiermill import rules
from tiermill.plans import gold, layers

QUERIES, SQL = queries(), oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)


def test_flagship_query(spark):
    result = contract.entry(spark)
    assert result.columns == ["market", "total_sales"]
    assert result.count() == 5


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, con, name):
    assert difference(QUERIES[name](spark, sf_dir), con, SQL[name], name) is None


def test_the_contract_has_them_all():
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


def test_a_wrong_order_is_noticed():
    assert set(SORTED) <= set(QUERIES)
    up, down = pd.DataFrame({"order_month": [None, "a", "b"]}), pd.DataFrame({"revenue": [3.0, 2.0, None]})
    assert disorder("revenue_trend", up) is None and disorder("revenue_trend", up[::-1])
    assert disorder("revenue_by_segment", down) is None and disorder("revenue_by_segment", down[::-1])


def test_the_inputs_can_tell_the_rules_apart(spark, sf_dir):
    raw = star.raw_orders(spark, sf_dir)
    bronze = layers.bronze_orders(raw)
    # some rows have no status.
    assert raw.filter("order_status IS NULL").count() > 0
    assert layers.silver_orders_basic(bronze).count() < op.keep_positive(bronze, rules.ORDER_POSITIVE).count()
    # G2: some dates do not parse, so a month is null.
    silver = layers.silver_orders(bronze)
    assert gold.monthly_financials(silver).filter("order_month IS NULL").count() > 0
    # G3 and the late risk differ.
    late = "days_for_shipping_real > days_for_shipment_scheduled"
    assert silver.filter(f"({late}) <> (late_delivery_risk = 1)").count() > 0
    # D1 comes before P4: rows that differ in a private column only are two.
    swapped = op.drop_columns(raw, rules.ORDER_PRIVATE_COLUMNS).transform(layers.bronze_orders)
    assert swapped.count() < bronze.count()
