from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.plans import physical_plan
from tiermill import functions as fn
from tiermill import operators as op


def ids(df):
    return [row.i for row in df.orderBy("i").collect()]


def test_require_drops_null_and_nan(spark):
    rows = [(1, "a", 1.0), (2, None, 1.0), (3, "a", None), (4, "a", float("nan")), (5, "b", 0.0)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    assert ids(op.require(df, ["s", "d"])) == [1, 5]
    assert ids(op.require(df, [])) == [1, 2, 3, 4, 5]


def test_require_reaches_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = physical_plan(op.require(df, ["l_shipdate", "l_tax"]).select("l_tax"))
    assert "PushedFilters: [IsNotNull(l_shipdate), IsNotNull(l_tax)]" in plan
    assert "ReadSchema: struct<l_tax:double,l_shipdate:timestamp_ntz>" in plan


def test_positive_is_strict(spark):
    df = spark.createDataFrame(
        [(1, 1.0, 1), (2, 0.0, 1), (3, 1.0, 0), (4, None, 1), (5, -1.0, 1)],
        "i int, sales double, n int",
    )
    assert ids(op.keep_positive(df, ["sales", "n"])) == [1]


def test_membership_and_range_drop_null(spark):
    df = spark.createDataFrame(
        [(1, "closed", 0), (2, "open", 23), (3, None, 24), (4, "complete", None), (5, "x", -1)],
        "i int, s string, h int",
    )
    assert ids(op.keep_in(df, "s", ["complete", "closed"])) == [1, 4]
    assert ids(op.keep_between(df, "h", 0, 23)) == [1, 2]


def test_rejects_count_values_lost_by_conversion(spark):
    df = spark.createDataFrame(
        [("1", "1/1/2001 1:00"), ("x", "bad"), (None, None), ("", "2/30/2001 1:00")],
        "n string, t string",
    )
    lost = op.rejects(
        df,
        {
            "n": ("n", fn.as_type(F.col("n"), "double")),
            "t": ("t", fn.parse_time(F.col("t"))),
        },
    )
    assert {row.rule: row.rows for row in lost.collect()} == {"n": 2, "t": 2}
    with pytest.raises(ValueError, match="no rules"):
        op.rejects(df, {})


def test_rejected_rows_are_set_aside_with_their_reasons(spark):
    rows = [("1", "2"), ("x", "3"), ("y", "z"), (None, "4"), (None, None)]
    df = spark.createDataFrame(rows, "a string, b string")
    rules = {name: (name, F.col(name).try_cast("int")) for name in ("a", "b")}
    found = {(r.a, r.b): r.rejected_by for r in op.rejected_rows(df, rules).collect()}
    assert found == {("x", "3"): ["a"], ("y", "z"): ["a", "b"]}
