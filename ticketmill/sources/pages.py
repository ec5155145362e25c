"""Landed pages of all-text records, and the date filter of an extract."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ticketmill import schemas as S
from ticketmill.functions import dates


def read_raw_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """JSON-lines pages; fields a page leaves out are null, unknown fields are dropped.

    Pages may overlap: the merge keeps one row per key. Malformed lines fail the read.
    """
    return spark.read.schema(S.RAW_SCHEMA).option("mode", "FAILFAST").json(path)


def write_raw_pages(raw: DataFrame, path: str, page_rows: int = 50_000) -> None:
    """Land records as gzipped JSON-lines files of at most ``page_rows`` rows; nulls are left out.

    The text repeats every field's name and most of its values in each record, so it is the bulk of
    what a load writes. A gzipped file is read by one task, which ``page_rows`` bounds.
    """
    raw.write.option("maxRecordsPerFile", page_rows).option("compression", "gzip").json(path)


def readable(field: str) -> Column:
    """Whether a record's date text is a time; null, blank, padded and impossible text is not."""
    return dates.try_parse_iso(F.col(field)).isNotNull()


def in_range(df: DataFrame, field: str, start, end) -> Column:
    """Whether ``start <= field < end``.

    Unparsed records are compared as text, which runs inside the JSON reader: for ISO text
    that is time order once the bounds carry no trailing zeros, as a record may or may not
    spell its fraction out. Text that is no time may fall on either side: loads put such
    records aside, see :func:`readable`.
    """
    kind = df.schema[field].dataType
    if isinstance(kind, StringType):
        start, end = (re.sub(r"\.?0*$", "", b) if "." in b else b for b in (start, end))
    low, high = F.lit(start).cast(kind), F.lit(end).cast(kind)
    return (F.col(field) >= low) & (F.col(field) < high)


def date_range(df: DataFrame, field: str, start, end) -> DataFrame:
    """The rows of the half-open range ``start <= field < end``, see :func:`in_range`."""
    return df.where(in_range(df, field, start, end))
