"""Cleaning of text and code columns."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill_blank(col: Column, fill: str = "unknown") -> Column:
    """Null and empty text become ``fill``; numbers are read as text."""
    text = col.cast("string")
    return F.when(text.isNull() | (text == ""), fill).otherwise(text)


def tristate_text(col: Column) -> Column:
    """Boolean as True / False / Unknown."""
    return F.when(col, "True").when(~col, "False").otherwise("Unknown")


def strip_code(col: Column) -> Column:
    """Drop every space, bar, comma and dash from a code."""
    return F.translate(col, " |,-", "")


def drop_dots(col: Column) -> Column:
    return F.translate(col, ".", "")


def underscore_label(col: Column) -> Column:
    """Label fit for a column name: space, comma and brackets become underscores."""
    return F.translate(col, " ,()", "____")


def keep_alphanumeric(col: Column) -> Column:
    """Keep ASCII letters, digits and spaces."""
    return F.regexp_replace(col, "[^a-zA-Z0-9 ]", "")


def map_values(col: Column, mapping: dict[str, str]) -> Column:
    """Look values up in a small fixed dictionary; unlisted values become null."""
    entries = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.create_map(*entries)[col]


def like_any(col: Column, patterns: list[str]) -> Column:
    return reduce(or_, [col.like(p) for p in patterns])


def is_present(col: Column) -> Column:
    """Not null and not empty."""
    return col.isNotNull() & (col.cast("string") != "")
