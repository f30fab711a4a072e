"""Projection operators: names, types, text, times, derived columns.

Each one is a single projection, so Catalyst folds a chain of them into one codegen stage.
All of them are stateless and accept a streaming DataFrame as well.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from tiermill import functions as fn
from tiermill.rules import IP_PREFIX_LENGTH, NIGHT_ENDS_AT, RAW_TIME_FORMAT


def normal_name(header: str) -> str:
    """Lower case, space to underscore, parentheses removed; nothing else."""
    return header.lower().translate(str.maketrans(" ", "_", "()"))


def _unique(names: Sequence[str]) -> list[str]:
    # Spark accepts equal names and fails at the first reference, far from the cause.
    twice = sorted(name for name, n in Counter(map(str.lower, names)).items() if n > 1)
    if twice:
        raise ValueError(f"columns share a name: {twice}")
    return list(names)


def normalize_names(df: DataFrame) -> DataFrame:
    """Give every column its normal name; raise when two headers become one name."""
    return df.toDF(*_unique([normal_name(name) for name in df.columns]))


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Replace all names by position; the count must match."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*_unique(names))


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns; a value that does not convert becomes null."""
    kinds = dict(df.dtypes)
    return df.withColumns({name: fn.as_type(F.col(name), to, kinds.get(name)) for name, to in types.items()})


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns; absent names are fine."""
    return df.drop(*names)


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace nulls by a constant per column; a missing column raises."""
    return df.fillna(dict(values))


def normalize_text(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Lower case and trim the named columns."""
    return df.withColumns({name: fn.clean_text(F.col(name)) for name in names})


def strip_non_letters(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep ASCII letters and inner white space of the named columns."""
    return df.withColumns({name: fn.letters_only(F.col(name)) for name in names})


def null_if_numeric(df: DataFrame, name: str) -> DataFrame:
    """Null where the column holds digits only."""
    return df.withColumn(name, fn.null_if_digits(F.col(name)))


def canonicalize(df: DataFrame, name: str, rules: Sequence[tuple[str, list[str], str]]) -> DataFrame:
    """Map spellings of one column to a common one by ordered first-match rules."""
    return df.withColumn(name, fn.first_match(F.col(name), rules))


def parse_timestamps(
    df: DataFrame, times: Mapping[str, str] | Sequence[str], fmt: str = RAW_TIME_FORMAT
) -> DataFrame:
    """Parse text columns to timestamps.

    A mapping ``{new: source}`` keeps the source text; a list parses in place. A source that is a
    timestamp already is taken as it is.
    """
    sources = times if isinstance(times, Mapping) else {name: name for name in times}
    parsed = {}
    for target, source in sources.items():
        known = isinstance(df.schema[source].dataType, (TimestampType, TimestampNTZType))
        parsed[target] = F.col(source) if known else fn.parse_time(F.col(source), fmt)
    return df.withColumns(parsed)


def month_bucket(df: DataFrame, source: str, target: str = "order_month") -> DataFrame:
    """Add the ``yyyy-MM`` text of a timestamp column."""
    return df.withColumn(target, fn.month_of(F.col(source)))


def split_path(df: DataFrame, source: str = "url", target: str = "url_path") -> DataFrame:
    """Add the parts of a path as an array."""
    return df.withColumn(target, fn.path_parts(F.col(source)))


def ip_first_octet(df: DataFrame, source: str = "ip", target: str = "user_region") -> DataFrame:
    """Add the first octet of an address (the bronze region)."""
    return df.withColumn(target, fn.first_octet(F.col(source)))


def ip_prefix(
    df: DataFrame,
    source: str = "ip",
    target: str = "user_region",
    length: int = IP_PREFIX_LENGTH,
) -> DataFrame:
    """Add the first characters of an address (the silver region, which replaces bronze's)."""
    return df.withColumn(target, fn.prefix(F.col(source), length))


def flag_night(
    df: DataFrame, source: str = "hour", target: str = "is_night", ends_at: int = NIGHT_ENDS_AT
) -> DataFrame:
    """Add 1 for the hours before ``ends_at``, else 0."""
    return df.withColumn(target, fn.night_flag(F.col(source), ends_at))
