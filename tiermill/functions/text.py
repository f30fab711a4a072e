"""Text cleaning expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tiermill.rules import ALL_DIGITS, IP_PREFIX_LENGTH, NON_LETTERS

ASCII_NON_LETTERS = "".join(re.findall(NON_LETTERS, "".join(map(chr, range(128))), re.ASCII))


def clean_text(column: Column) -> Column:
    """Lower case without surrounding spaces (spaces only: a tab stays)."""
    return F.lower(F.trim(column))


def letters_only(column: Column) -> Column:
    """Delete everything but ASCII letters and white space, then trim. Accented letters are lost.

    The pattern costs ten times as much as deleting single characters, which does for texts of ASCII alone.
    """
    ascii_only = F.octet_length(column) == F.char_length(column)
    plain = F.translate(column, ASCII_NON_LETTERS, "")
    return F.trim(F.when(ascii_only, plain).otherwise(F.regexp_replace(column, NON_LETTERS, "")))


def null_if_digits(column: Column) -> Column:
    """Null for a value made of digits only.

    After `letters_only` no digit is left, so there this never fires: ``12345`` is already ``''``.
    """
    return F.when(~F.coalesce(column.rlike(ALL_DIGITS), F.lit(False)), column)


def first_match(column: Column, rules: Iterable[tuple[str, list[str], str]]) -> Column:
    """Replace by the first rule that matches; keep the value when none does.

    A rule is ``("like", patterns, replacement)`` or ``("in", values, replacement)``.
    """
    chain = None
    for kind, operands, replacement in rules:
        if kind == "in":
            test = column.isin(operands)
        elif kind == "like":
            test = column.like(operands[0])
            for pattern in operands[1:]:
                test = test | column.like(pattern)
        else:
            raise ValueError(f"unknown rule kind {kind!r}; use 'like' or 'in'")
        chain = (F if chain is None else chain).when(test, replacement)
    return column if chain is None else chain.otherwise(column)


def path_parts(url: Column) -> Column:
    """Split on ``/``, empty leading and trailing parts kept."""
    return F.split(url, "/")


def first_octet(ip: Column) -> Column:
    """Text before the first dot; the whole text when there is none."""
    return F.substring_index(ip, ".", 1)


def prefix(column: Column, length: int = IP_PREFIX_LENGTH) -> Column:
    """The first characters of a text."""
    return column.substr(1, length)
