"""The two fact tables. Narrow work plus lookup joins: no shuffle of tickets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions.keys import surrogate_key
from ticketmill.functions.labels import COMPLETED


def sla_met(status: Column, days: Column, target: Column) -> Column:
    """Null unless completed with both numbers known."""
    return F.when(status == COMPLETED, days <= target)


def sla_breached(status: Column, days: Column, target: Column) -> Column:
    """False whenever the breach cannot be shown."""
    return F.coalesce((status == COMPLETED) & (days > target), F.lit(False))


def with_key(stg: DataFrame, text: str, key: str, dim: DataFrame | None, name: str,
             *extra: str) -> DataFrame:
    """Add a dimension's key for a text column, with ``extra`` columns of the dimension.

    A key is a hash of its name, so looking the name up gives the same key as hashing every
    ticket's text, at a tenth of the cost. Names the dimension lacks are hashed.
    """
    hashed = surrogate_key(F.col(text))
    if dim is None:
        return stg.withColumn(key, hashed)
    lookup = dim.select(F.col(name).alias(text), F.col(key).alias("_key"), *extra)
    return stg.join(lookup, text, "left").withColumn(key, F.coalesce("_key", hashed)).drop("_key")


def with_target(stg: DataFrame, dim_request_type: DataFrame, default_days: int | None = None) -> DataFrame:
    """Type key and target days; the dimension has one row per type. With ``default_days``, tickets
    without a target get it, and ``sla_target_source`` says where each target is from."""
    extra = ["sla_target_days"] if default_days is None else ["sla_target_days", "sla_target_source"]
    out = with_key(stg, "sr_type", "request_type_id", dim_request_type, "request_type_name", *extra)
    if default_days is None:
        return out
    given = F.col("sla_target_days").isNotNull()
    return out.withColumns({
        "sla_target_source": F.when(given, F.col("sla_target_source")).otherwise("default"),
        "sla_target_days": F.coalesce("sla_target_days", F.lit(default_days).cast("bigint"))})


def with_department(stg: DataFrame, dim_department: DataFrame | None) -> DataFrame:
    return with_key(stg, "owner_department", "department_id", dim_department,
                    "raw_department_name")


def fct_service_requests(stg: DataFrame, dim_request_type: DataFrame,
                         dim_department: DataFrame | None = None,
                         dim_status: DataFrame | None = None,
                         mark_duplicates: bool = False, default_days: int | None = None) -> DataFrame:
    """Accumulating snapshot: one row per ticket; optionally with ``is_duplicate``, and with
    ``sla_at_risk`` (open for longer than the target) where types without one get a default."""
    keyed = with_department(with_target(stg, dim_request_type, default_days), dim_department)
    keyed = with_key(keyed, "current_status", "status_id", dim_status, "status_name")
    status, days, target = F.col("current_status"), F.col("resolution_days"), F.col("sla_target_days")
    return keyed.select(
        "service_request_number",
        "request_type_id",
        "department_id",
        F.col("community_area").alias("community_area_id"),
        "status_id",
        F.to_date("created_date").alias("created_date"),
        F.to_date("closed_date").alias("closed_date"),
        F.col("created_date").alias("created_timestamp"),
        F.col("closed_date").alias("closed_timestamp"),
        "last_modified_date",
        "latitude",
        "longitude",
        "ward",
        "resolution_days",
        sla_met(status, days, target).alias("is_sla_met"),
        sla_breached(status, days, target).alias("is_sla_breached"),
        *([F.coalesce("duplicate", F.lit(False)).alias("is_duplicate")] if mark_duplicates else []),
        *([F.coalesce(F.col("days_open") > target, F.lit(False)).alias("sla_at_risk")]
          if default_days is not None else []),
    )


def completed(stg: DataFrame) -> DataFrame:
    return stg.where(F.col("current_status") == COMPLETED)


def fct_sla_performance(stg: DataFrame, dim_request_type: DataFrame,
                        dim_department: DataFrame | None = None,
                        default_days: int | None = None) -> DataFrame:
    """Transaction fact: one row per completed ticket; with ``default_days``, types without a target
    get that one and ``sla_target_source`` says so."""
    keyed = with_department(with_target(completed(stg), dim_request_type, default_days), dim_department)
    days, target = F.col("resolution_days"), F.col("sla_target_days")
    return keyed.select(
        "service_request_number",
        "request_type_id",
        "department_id",
        F.col("community_area").alias("community_area_id"),
        F.to_date("closed_date").alias("closed_date"),
        F.col("closed_date").alias("closed_timestamp"),
        F.to_date("created_date").alias("created_date"),
        "resolution_days",
        "sla_target_days",
        (days - target).alias("days_over_sla"),
        F.coalesce(days > target, F.lit(False)).alias("is_breached"),
        *(["sla_target_source"] if default_days is not None else []),
    )


def _high_water(target: DataFrame, column: str):
    """The stored maximum as a literal, so that the slice filter reaches the scan."""
    return target.agg(F.max(column)).first()[0]


def modified_since(stg: DataFrame, high, lookback_hours: int = 3) -> DataFrame:
    """Tickets at or after ``high`` (a time, its text, or None: no tickets) minus the lookback."""
    floor = F.lit(high).cast("timestamp_ntz") - F.expr(f"interval {lookback_hours} hours")
    return stg.where(F.col("last_modified_date") >= floor)


def closed_since(stg: DataFrame, high) -> DataFrame:
    """Tickets closed on or after the day ``high`` (that day is redone)."""
    return stg.where(F.to_date("closed_date") >= F.lit(high).cast("date"))


def modified_slice(stg: DataFrame, target: DataFrame, lookback_hours: int = 3) -> DataFrame:
    """Tickets at or after the stored maximum minus the lookback; none for an empty target."""
    return modified_since(stg, _high_water(target, "last_modified_date"), lookback_hours)


def closed_slice(stg: DataFrame, target: DataFrame) -> DataFrame:
    """Tickets closed on or after the stored maximum day (that day is redone)."""
    return closed_since(stg, _high_water(target, "closed_date"))
