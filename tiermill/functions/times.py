"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiermill.rules import MONTH_FORMAT, NIGHT_ENDS_AT, RAW_TIME_FORMAT


def parse_time(column: Column, fmt: str = RAW_TIME_FORMAT) -> Column:
    """Text to timestamp, null when it does not parse."""
    return F.try_to_timestamp(column, F.lit(fmt))


def month_of(time: Column) -> Column:
    """``yyyy-MM`` of a timestamp."""
    return F.date_format(time, MONTH_FORMAT)


def night_flag(hour: Column, ends_at: int = NIGHT_ENDS_AT) -> Column:
    """1 before ``ends_at``, else 0; a null hour gives 0."""
    return F.when(hour < ends_at, 1).otherwise(0)
