"""Lookup joins whose broadcast side has a measured size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 200_000
MAX_BYTES = 64 * 1024 * 1024


def sized(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if it is measured to be small, else unchanged.

    Without the hint the join is a shuffle join, which adaptive execution splits on skewed
    keys, so a lookup that outgrows the bound gets slower but never exhausts a process.
    Meant for written tables and seeds: measuring reads at most ``max_rows`` + 1 rows.
    """
    width = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    rows, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), width).first()
    return F.broadcast(df) if rows <= max_rows and (size or 0) <= max_bytes else df


def broadcast_if(df: DataFrame, known_rows: int, max_rows: int = MAX_ROWS) -> DataFrame:
    """The same choice where an earlier step has already counted the rows."""
    return F.broadcast(df) if known_rows <= max_rows else df
