"""Row filters and the count of values a cleaning step would lose."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def _all(tests: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def require(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep rows where every named column has a value; NaN counts as missing.

    Written as IS NOT NULL tests because those reach the Parquet scan and `dropna` does not.
    """
    tests = []
    for name in names:
        tests.append(F.col(name).isNotNull())
        if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
            tests.append(~F.isnan(name))
    return df.filter(_all(tests))


def keep_positive(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep rows where every named column is above zero; null is not."""
    return df.filter(_all([F.col(name) > 0 for name in names]))


def keep_in(df: DataFrame, name: str, values: Sequence[object]) -> DataFrame:
    """Keep rows whose value is in the list; null is not."""
    return df.filter(F.col(name).isin(list(values)))


def keep_between(df: DataFrame, name: str, low: object, high: object) -> DataFrame:
    """Keep rows with ``low <= value <= high``; null is not."""
    return df.filter(F.col(name).between(low, high))


REJECTED_BY = "rejected_by"


def _lost(source: str | Column, converted: Column) -> Column:
    source = F.col(source) if isinstance(source, str) else source
    return source.isNotNull() & converted.isNull()


def count_fields(line: Column, separator: str = ",") -> Column:
    """How many fields a line of a separated file has; separators in quotes do not count."""
    bare = F.regexp_replace(line, r'"[^"\\]*+(?:(?:\\.|"")[^"\\]*+)*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(separator), F.lit(""))) + 1


def account(
    rows: DataFrame, fates: Mapping[str, Column], kept: DataFrame, copies: str, rest: str
) -> DataFrame:
    """What becomes of every row: one row ``(fate, rows)`` per fate, ``copies`` and ``rest`` last.

    ``fates`` names conditions under which a row is lost, of which the first that holds counts. The rows
    for which none does are the input of a duplicate removal that leaves ``kept``: the difference are
    copies. The figures add up to the number of rows. One aggregate over the rows, and the plan of
    ``kept``.
    """
    fate = reduce(
        lambda rest_, one: F.when(one[1], F.lit(one[0])).otherwise(rest_),
        reversed(list(fates.items())),
        F.lit(copies),
    )
    names = [*fates, copies]
    marked = rows.select(fate.alias("fate"))
    counted = marked.agg(*[F.count_if(F.col("fate") == name).alias(name) for name in names])
    lost = counted.unpivot([], names, "fate", "rows")
    left = kept.agg(F.count(F.lit(1)).alias("rows"))
    both = lost.unionByName(left.select(F.lit(copies).alias("fate"), (-F.col("rows")).alias("rows"))).unionByName(
        left.select(F.lit(rest).alias("fate"), "rows")
    )
    return both.groupBy("fate").agg(F.sum("rows").alias("rows"))


def rejected_rows(
    df: DataFrame, rules: Mapping[str, tuple[str | Column, Column]]
) -> DataFrame:
    """The rows, as given, with a value that is present but comes out null, to set aside.

    ``rules`` is that of `rejects`; ``rejected_by`` lists the rules a row breaks, in their order.
    One filter over one scan, no shuffle.
    """
    broken = F.array_compact(
        F.array(*[F.when(_lost(*rule), F.lit(name)) for name, rule in rules.items()])
    )
    return df.withColumn(REJECTED_BY, broken).filter(F.size(REJECTED_BY) > 0)


def rejects(df: DataFrame, rules: Mapping[str, tuple[str | Column, Column]]) -> DataFrame:
    """Count, per rule, the values that are present but come out null.

    ``rules`` maps a rule name to ``(source column or expression, converted expression)``. The result is one
    row ``(rule, rows)`` per rule, from a single aggregate over one scan.
    """
    if not rules:
        raise ValueError("no rules given")
    counts = df.agg(
        *[
            F.count_if(_lost(*sides)).alias(rule) for rule, sides in rules.items()
        ]
    )
    return counts.unpivot([], list(rules), "rule", "rows")
