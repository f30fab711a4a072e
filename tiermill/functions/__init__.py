"""Column expressions. All are built-in JVM expressions, null on bad input, without UDFs."""

from tiermill.functions.exact import exact_avg, exact_sum
from tiermill.functions.numbers import as_type, percent, round_to
from tiermill.functions.text import (
    clean_text,
    first_match,
    first_octet,
    letters_only,
    null_if_digits,
    path_parts,
    prefix,
)
from tiermill.functions.times import month_of, night_flag, parse_time

__all__ = [
    "exact_avg",
    "exact_sum",
    "as_type",
    "clean_text",
    "first_match",
    "first_octet",
    "letters_only",
    "month_of",
    "night_flag",
    "null_if_digits",
    "parse_time",
    "path_parts",
    "percent",
    "prefix",
    "round_to",
]
