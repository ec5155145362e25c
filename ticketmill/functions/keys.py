"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(c: Column) -> Column:
    """A 60-bit number from the text's md5; null text has a null key.

    md5 rather than Spark's own hash, so that any other engine can compute the same ids.
    """
    return F.conv(F.substring(F.md5(c), 1, 15), 16, 10).cast("bigint")
