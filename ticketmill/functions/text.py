"""Text clean-up expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def blank_or(c: Column, type_name: str) -> Column:
    """'' becomes null, anything else must cast (ANSI raises on bad text)."""
    return blank_to_null(c).cast(type_name)


def trim_all(c: Column) -> Column:
    """Strip every kind of Unicode white space from both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_true_text(c: Column) -> Column:
    """Only the word ``true`` is true; other text is false, null stays null."""
    return c == F.lit("true")


def number_with_commas(c: Column) -> Column:
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).cast("double")
