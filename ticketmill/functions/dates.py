"""Date and timestamp expressions. Calendar results are ``bigint``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def parse_iso(c: Column) -> Column:
    """Strict: bad text or a bare date raises."""
    return F.to_timestamp_ntz(c, F.lit(ISO_TEXT))


def try_parse_iso(c: Column) -> Column:
    """Null instead of an error (the session zone is UTC, so the cast keeps the wall clock)."""
    return F.try_to_timestamp(c, F.lit(ISO_TEXT)).cast("timestamp_ntz")


def iso_text(c: Column) -> Column:
    """The way landed records spell a timestamp."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")


def iso_weekday(c: Column) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(c) + 1).cast("bigint")


def days_between(later: Column, earlier: Column) -> Column:
    """Midnights crossed; negative when ``later`` comes first."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


def month_index(c: Column) -> Column:
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def as_of_or_today(as_of) -> Column:
    """``as_of`` may be a date, ISO text, a column, or None for the current date."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")
