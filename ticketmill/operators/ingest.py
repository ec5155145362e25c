"""Landed all-text records to typed tickets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import dates, text


def with_missing_columns(df: DataFrame, schema=S.RAW_SCHEMA) -> DataFrame:
    """Add absent columns as typed nulls."""
    have = set(df.columns)
    return df.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in have}
    )


def rename_raw(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(S.RENAMES)


def with_timestamps(df: DataFrame, parse=dates.parse_iso) -> DataFrame:
    return df.withColumns(
        {
            "created_date": parse(F.col("created_date")),
            "closed_date": parse(text.blank_to_null(F.col("closed_date"))),
            "last_modified_date": parse(F.col("last_modified_date")),
        }
    )


def with_calendar_parts(df: DataFrame) -> DataFrame:
    created = F.col("created_date")
    return df.withColumns(
        {
            "created_year": F.year(created).cast("bigint"),
            "created_month": F.month(created).cast("bigint"),
            "created_day_of_week": dates.iso_weekday(created),
        }
    )


def with_numbers(df: DataFrame) -> DataFrame:
    casts = {c: text.blank_or(F.col(c), "bigint") for c in S.INTEGERS}
    casts |= {c: text.blank_or(F.col(c), "double") for c in S.DOUBLES}
    return df.withColumns(casts)


def with_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.is_true_text(F.col(c)) for c in S.FLAGS})


def with_blanks_as_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in S.BLANK_IS_NULL})


def keyed_rows(df: DataFrame, also: Column | None = None) -> DataFrame:
    """Trim the key, then drop rows without one, but for those that ``also`` names."""
    key = F.col(S.KEY)
    keyed = key.isNotNull() & (key != "")
    return df.withColumn(S.KEY, text.trim_all(key)).where(keyed if also is None else keyed | also)


def exact_columns(df: DataFrame) -> DataFrame:
    return df.select(*S.TYPED_COLUMNS)


def typed_tickets(raw: DataFrame) -> DataFrame:
    """The whole typing step: narrow work only, one projection after optimization.

    Strict: a value that does not parse fails the job (see :func:`parse_errors`).
    """
    df = rename_raw(with_missing_columns(raw))
    for step in (with_timestamps, with_calendar_parts, with_numbers, with_flags,
                 with_blanks_as_null, keyed_rows, exact_columns):
        df = step(df)
    return df


def parse_errors(raw: DataFrame) -> Column:
    """How many fields of a landed record would make the strict step fail."""
    have = set(raw.columns)

    def bad(name: str, parsed: Column) -> Column:
        must_parse = name in ("created_date", "last_modified_date")
        value = F.col(name) if must_parse else text.blank_to_null(F.col(name))
        return (value.isNotNull() & parsed.isNull()).cast("int")

    checks = [bad(c, dates.try_parse_iso(text.blank_to_null(F.col(c)))) for c in S.TIMESTAMPS
              if c in have]
    checks += [bad(c, text.blank_to_null(F.col(c)).try_cast("bigint")) for c in S.INTEGERS
               if c in have]
    checks += [bad(c, text.blank_to_null(F.col(c)).try_cast("double")) for c in S.DOUBLES
               if c in have]
    return sum(checks, F.lit(0))


def lenient_tickets(raw: DataFrame, keep: Sequence[str] = (), also: Column | None = None) -> DataFrame:
    """Typed tickets plus ``parse_errors``; a bad field is null instead of a failure.

    ``keep`` names further columns to carry along; rows without a key stay if ``also`` is true.
    """
    raw = with_missing_columns(raw)
    errors = parse_errors(raw)
    good = {c: F.when(text.blank_to_null(F.col(c)).try_cast(t).isNotNull(), F.col(c))
            for names, t in ((S.INTEGERS, "bigint"), (S.DOUBLES, "double")) for c in names}
    df = rename_raw(raw.withColumn("parse_errors", errors).withColumns(good))
    df = with_timestamps(df, lambda c: dates.try_parse_iso(text.blank_to_null(c)))
    for step in (with_calendar_parts, with_numbers, with_flags, with_blanks_as_null):
        df = step(df)
    return keyed_rows(df, also).select(*S.TYPED_COLUMNS, "parse_errors", *keep)
