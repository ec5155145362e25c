"""The staging model over the main ticket table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import dates


def without_legacy(tickets: DataFrame) -> DataFrame:
    """Three-valued: a null flag is dropped like a true one."""
    return tickets.where(~F.col("legacy_record"))


def with_durations(tickets: DataFrame, as_of=None) -> DataFrame:
    """``days_open`` for open tickets, ``resolution_days`` for closed ones."""
    created, closed = F.col("created_date"), F.col("closed_date")
    today = dates.as_of_or_today(as_of)
    return tickets.withColumns(
        {
            "days_open": F.when(closed.isNull(), dates.days_between(today, created)),
            "resolution_days": F.when(closed.isNotNull(), dates.days_between(closed, created)),
        }
    )


def stg_service_requests(tickets: DataFrame, as_of=None, audit_column: bool = False) -> DataFrame:
    out = with_durations(without_legacy(tickets.select(*S.TYPED_COLUMNS)), as_of)
    return out.withColumn("dbt_loaded_at", F.current_timestamp()) if audit_column else out
