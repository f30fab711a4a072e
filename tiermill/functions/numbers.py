"""Casts, ratios and rounding that never raise under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGERS = {"tinyint", "smallint", "int", "bigint"}


def as_type(column: Column, target: str, source: str | None = None) -> Column:
    """Cast, with null for a value that does not convert.

    Integers go through an exact decimal: text such as ``3.0`` counts as 3, every key of a
    ``bigint`` stays what it is, and a type suffix (``5d``) is no number. Where the ``source`` type is known
    to be an integer, or to be text and the text is a plain integer, the same comes without the decimal, at a
    fraction of its cost.
    """
    if target not in INTEGERS or source in INTEGERS:
        return column.try_cast(target)
    exact = column.try_cast("decimal(38,10)").try_cast(target)
    if source != "string":
        return exact
    # The one character that only the shorter way takes for a blank.
    plain = F.when(~F.contains(column, F.lit("\x7f")), column).try_cast(target)
    return F.coalesce(plain, exact)


def round_to(value: Column, digits: int = 2) -> Column:
    """Round half up on the decimal the double stands for.

    Rounding a double directly can flip an exact tie on float noise that changes with the order
    of addition. Values a ``decimal(28,10)`` cannot hold (huge, NaN, infinite) are rounded as
    doubles.
    """
    snapped = F.round(value.try_cast("decimal(28,10)"), digits).cast("double")
    return F.coalesce(snapped, F.round(value.cast("double"), digits))


def percent(numerator: Column, denominator: Column | None = None, digits: int = 2) -> Column:
    """``numerator / denominator * 100`` rounded; null when the denominator is null or zero."""
    ratio = numerator if denominator is None else F.try_divide(numerator, denominator)
    return round_to(ratio * 100, digits)
