"""Sums of doubles that do not depend on the order of addition.

A double is split into whole multiples of fixed powers of two, `BIN_BITS` bits apart. Each of these digits is a
small integer, so Spark's partial and final sums of them are exact, in any order, over any partitioning and any
number of loads that are merged later. The totals are then carried over into one number and rounded once.

Values from 2^-30 to 2^82 in size lose nothing. Of smaller ones, what lies below 2^-84 (about 10^-25) is cut
off value by value, still the same in any order. A group with a value of 2^82 or more, infinite or NaN falls
back to Spark's own sum. A group may have 2^38 rows before a digit's total overflows, which raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BIN_BITS = 24
# Exponents of the bins, highest first: 2^60 ... 2^-84.
BINS = range(60, -85, -BIN_BITS)
LARGEST = 2.0 ** (BINS[0] + BIN_BITS - 2)


def _digit(value: str, exponent: int) -> str:
    """The value's multiple of ``2**exponent`` beyond its multiple of the next higher bin, in SQL.

    Scaling by powers of two, rounding to a whole number and this difference are exact. Digits of what is too
    large would be no integers; its group does not use them.
    """
    digit = f"rint({value} * {2.0**-exponent!r}D)"
    if exponent != BINS[0]:
        higher = f"rint({value} * {2.0 ** -(exponent + BIN_BITS)!r}D)"
        digit = f"{digit} - {higher} * {2.0**BIN_BITS!r}D"
    return f"if(abs({value}) < {LARGEST!r}D, cast({digit} AS bigint), NULL)"


def exact_parts(value: str) -> dict[str, tuple[str, str]]:
    """What to aggregate for the sum of a double: ``suffix -> (aggregate function, argument)``, in SQL.

    Parts of several sets of rows merge by the same functions, applied to the parts.
    """
    value = f"cast({value} AS double)"
    digits = {f"digit{i}": ("sum", _digit(value, at)) for i, at in enumerate(reversed(BINS))}
    return digits | {"largest": ("max", f"abs({value})"), "plain": ("sum", value)}


# Totals, lowest first, carried over into digits from 0 to 2^24 - 1 and added from the lowest up; what
# rounding adds is 2^-24 of the last place at most. The highest total keeps its sign.
_LOW = f"""aggregate(slice(totals, 1, {len(BINS) - 1}), named_struct('carry', 0L, 'value', 0D),
  (a, t) -> named_struct('carry', shiftright(t + a.carry, {BIN_BITS}),
    'value', ((t + a.carry) & {(1 << BIN_BITS) - 1}L) + a.value * {2.0**-BIN_BITS!r}D))"""
_TOP = f"(element_at(totals, {len(BINS)}) + {_LOW}.carry)"
_NUMBER = f"({_TOP} + {_LOW}.value * {2.0**-BIN_BITS!r}D) * {2.0 ** BINS[0]!r}D"


def exact_value(parts: dict[str, str]) -> str:
    """The sum, null without values, from expressions of its merged parts by suffix, in SQL."""
    totals = ", ".join(parts[f"digit{i}"] for i in range(len(BINS)))
    # One array each, to name its value: the totals, and those of the number without its sign.
    signed = f"""transform(array(array({totals})), totals -> if({_TOP} < 0,
      -(transform(array(transform(totals, t -> -t)), totals -> {_NUMBER})[0]), {_NUMBER}))[0]"""
    # NaN is above all numbers.
    return f"if({parts['largest']} < {LARGEST!r}D, {signed}, {parts['plain']})"


def _sum(value: str) -> str:
    return exact_value({name: f"{how}({what})" for name, (how, what) in exact_parts(value).items()})


def exact_sum(value: str) -> Column:
    """An aggregate: the sum of a double column (or SQL expression), the same for any order of its rows.

    Null without values.
    """
    return F.expr(_sum(value))


def exact_avg(value: str) -> Column:
    """An aggregate: the mean of a double column (or SQL expression) from its exact sum."""
    return F.expr(f"try_divide({_sum(value)}, cast(count({value}) AS double))")
