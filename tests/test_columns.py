from __future__ import annotations

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tiermill import functions as fn
from tiermill import operators as op
from tiermill import rules


def test_names_are_lowered_and_stripped_of_parentheses(spark):
    headers = ["order date (DateOrders)", "Days for shipping (real)", "Late_delivery_risk", "A.b"]
    df = spark.createDataFrame([(1, 2, 3, 4)], headers)
    assert op.normalize_names(df).columns == [
        "order_date_dateorders",
        "days_for_shipping_real",
        "late_delivery_risk",
        "a.b",
    ]


def test_headers_that_become_one_name_raise(spark):
    df = spark.createDataFrame([(1, 2)], ["Order Id", "order_id"])
    with pytest.raises(ValueError, match="order_id"):
        op.normalize_names(df)


def test_positional_rename_needs_every_name(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert op.rename_positional(df, ["x", "y"]).columns == ["x", "y"]
    with pytest.raises(ValueError, match="1 names for 2 columns"):
        op.rename_positional(df, ["x"])


def test_bad_doubles_become_null(values):
    cast = values(["1.5", "n/a", "", None, " 2 "], lambda d: op.cast_columns(d, {"x": "double"}))
    assert cast == [1.5, None, None, None, 2.0]


def test_ints_come_from_decimal_text_and_out_of_range_is_null(values):
    items = ["3", "3.0", "3.7", "x", "99999999999", None]
    cast = values(items, lambda d: op.cast_columns(d, {"x": "int"}))
    assert cast == [3, 3, 3, None, None, None]


def test_bigint_keeps_every_digit(values):
    cast = values(["9007199254740993"], lambda d: op.cast_columns(d, {"x": "bigint"}))
    assert cast == [9007199254740993]


def test_drop_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    assert op.drop_columns(df, ["b", "absent"]).columns == ["a"]


def test_fill_replaces_nulls_and_needs_the_column(spark, values):
    assert values(["a", None], lambda d: op.fill_nulls(d, {"x": "unknown"})) == ["a", "unknown"]
    with pytest.raises(Exception, match="absent"):
        op.fill_nulls(spark.range(1), {"absent": "unknown"}).collect()


def test_text_is_lowered_and_trimmed_of_spaces_only(values):
    cleaned = values(["  Ab C ", "\tTab ", None], lambda d: op.normalize_text(d, ["x"]))
    assert cleaned == ["ab c", "\ttab", None]


def test_strip_loses_accents_digits_and_dots(values):
    items = ["México", "12345", " St. Gallen 9 ", "M�xico", "a\tb", None]
    stripped = values(items, lambda d: op.strip_non_letters(d, ["x"]))
    assert stripped == ["Mxico", "", "St Gallen", "Mxico", "a\tb", None]


def test_numeric_values_become_null_but_not_after_strip(values):
    assert values(["123", "a1", "", None], lambda d: op.null_if_numeric(d, "x")) == [
        None,
        "a1",
        "",
        None,
    ]
    both = values(["123"], lambda d: op.null_if_numeric(op.strip_non_letters(d, ["x"]), "x"))
    assert both == [""]


def test_country_rules_are_ordered_and_case_sensitive(values):
    expected = {
        "Turqua": "Turkey",
        "replica x congo": "Democratic Republic of the Congo",
        "Repblica Democrtica del Congo": "Repblica Democrtica del Congo",
        "Estados Unidos": "United States",
        "USA": "United States",
        "usa": "usa",
        "Francia": "France",
        "La Francia": "La Francia",
        "Mxico": "Mexico",
        "Japn": "Japan",
        "Pakistn": "Pakistan",
        "Turqu Mxico": "Turkey",
        "": "",
        None: None,
    }
    mapped = values(
        list(expected), lambda d: op.canonicalize(d, "x", rules.COUNTRY_RULES)
    )
    assert mapped == list(expected.values())


def test_unknown_rule_kind_raises_and_no_rules_change_nothing(values):
    with pytest.raises(ValueError, match="glob"):
        fn.first_match(F.col("x"), [("glob", ["a*"], "b")])
    assert values(["a"], lambda d: op.canonicalize(d, "x", [])) == ["a"]


def test_times_parse_padded_and_not_and_bad_ones_become_null(values):
    items = ["1/9/2018 6:05", "01/09/2018 06:05", "13/1/2018 1:00", "", "nonsense", None]
    parsed = values(items, lambda d: op.parse_timestamps(d, {"t": "x"}), shown="t")
    assert parsed == [datetime(2018, 1, 9, 6, 5)] * 2 + [None] * 4


def test_parsing_keeps_the_source_text_and_leaves_timestamps_alone(values):
    kept = values(["1/9/2018 6:05"], lambda d: op.parse_timestamps(d, {"t": "x"}))
    assert kept == ["1/9/2018 6:05"]
    moment = datetime(2018, 1, 9, 6, 5, 33)
    again = values([moment], lambda d: op.parse_timestamps(d, ["x"]), kind="timestamp")
    assert again == [moment]


def test_paths_keep_empty_parts(values):
    parts = values(["/a/b/", "", None], lambda d: op.split_path(d, "x", "p"), shown="p")
    assert parts == [["", "a", "b", ""], [""], None]


def test_the_two_regions_differ(values):
    items = ["10.2.3.4", "203.0.0.1", "7", None]
    first = values(items, lambda d: op.ip_first_octet(d, "x", "r"), shown="r")
    start = values(items, lambda d: op.ip_prefix(d, "x", "r"), shown="r")
    assert first == ["10", "203", "7", None]
    assert start == ["10.", "203", "7", None]


def test_night_ends_at_six_and_null_is_day(values):
    flags = values([0, 5, 6, 23, None], lambda d: op.flag_night(d, "x", "n"), "int", "n")
    assert flags == [1, 1, 0, 0, 0]


def test_month_of_a_timestamp(values):
    months = values(
        [datetime(2018, 1, 31, 23, 59), None],
        lambda d: op.month_bucket(d, "x", "m"),
        "timestamp",
        "m",
    )
    assert months == ["2018-01", None]


def test_rounding_is_half_up_on_the_decimal_value(values):
    items = [1.005, -1.005, 2.675, 0.125, 1e300, float("nan"), None]
    rounded = values(items, lambda d: d.withColumn("x", fn.round_to(F.col("x"))), "double")
    assert rounded[:5] == [1.01, -1.01, 2.68, 0.13, 1e300]
    assert rounded[5] != rounded[5]
    assert rounded[6] is None


def test_percent_of_zero_or_null_is_null(spark):
    rows = [(1, 1, 8), (2, 1, 0), (3, 1, None), (4, None, 8)]
    df = spark.createDataFrame(rows, "i int, a int, b int")
    result = df.orderBy("i").select(fn.percent(F.col("a"), F.col("b")).alias("p")).collect()
    assert [row.p for row in result] == [12.5, None, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=20, max_size=60))
def test_text_steps_twice_equal_once(spark, texts):
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    steps = {
        "text": fn.clean_text,
        "letters": fn.letters_only,
        "country": lambda c: fn.first_match(c, rules.COUNTRY_RULES),
    }
    changed = df.select(
        *[
            F.count_if(~step(step(F.col("x"))).eqNullSafe(step(F.col("x")))).alias(name)
            for name, step in steps.items()
        ]
    )
    assert changed.first().asDict() == {"text": 0, "letters": 0, "country": 0}


def test_integers_are_exact_and_suffixes_are_no_numbers(values):
    texts = ["5d", "7f", "3.0", "9007199254740993", "1e3", "x", "", None, " 4 "]
    for kind in ("int", "bigint", "smallint"):
        found = values(texts, lambda df: op.cast_columns(df, {"x": kind}))
        big = 2**53 + 1 if kind == "bigint" else None
        assert found == [None, None, 3, big, 1000, None, None, None, 4], kind


def test_letters_of_plain_texts_are_those_of_the_pattern(spark):
    letters = "".join(map(chr, range(128)))
    texts = [letters, *letters, "a" + letters[::-1] + "é", "Türkei 1", "", None, " x ", "Nation City-2"]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    shown = df.select(fn.letters_only(F.col("x")).alias("got"), F.trim(F.regexp_replace("x", r"[^a-zA-Z\s]", "")).alias("want"))
    assert all(row.got == row.want for row in shown.collect())


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_plain_integers_convert_as_by_decimal(spark, kind):
    texts = ["1", "-7", "+5", " 3 ", "\t4\n", "3.0", "2.9", "1e3", "5d", "5L", "", " ", "-", "5.", ".5", "5\x7f", "٣",
             "2147483648", "9223372036854775807", "9223372036854775808", "9" * 30, "0x1", "1_0", "1,0", "NaN", None]
    df = spark.createDataFrame([(text,) for text in texts], "x string")
    shown = df.select("x", fn.as_type(F.col("x"), kind, "string").alias("got"), fn.as_type(F.col("x"), kind).alias("want"))
    assert all(row.got == row.want for row in shown.collect())
    plan = op.cast_columns(df, {"x": kind})
    assert "coalesce" in plan._jdf.queryExecution().optimizedPlan().toString()
