"""Result frames of the operations board, from ``mart_operational``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.functions import labels

COLUMNS = (
    "service_request_number", "created_date", "community_area_name", "department_name",
    "request_type_name", "priority_level", "days_open", "days_until_breach", "triage_status",
)


def board_frame(mart: DataFrame) -> DataFrame:
    return mart.select(*COLUMNS).withColumn("age_bucket", labels.age_bucket(F.col("days_open")))


def choose(df: DataFrame, **picks) -> DataFrame:
    """Equality filters by column; ``"All"`` or None passes everything."""
    for column, value in picks.items():
        if value is not None and value != "All":
            df = df.where(F.col(column) == value)
    return df


def choose_many(df: DataFrame, between: dict | None = None, year: dict | None = None,
                **picks: Sequence) -> DataFrame:
    """Multi-select lists, inclusive ``between`` ranges and ``year`` picks, by column."""
    for column, values in picks.items():
        if values:
            df = df.where(F.col(column).isin(list(values)))
    for column, (low, high) in (between or {}).items():
        df = df.where(F.col(column).between(F.lit(low), F.lit(high)))
    for column, value in (year or {}).items():
        # a range rather than year(column) = value, so that the filter reaches the scan
        df = df.where((F.col(column) >= F.lit(f"{value:04d}-01-01").cast("date"))
                      & (F.col(column) < F.lit(f"{value + 1:04d}-01-01").cast("date")))
    return df


def _is(status: str) -> Column:
    return F.col("triage_status") == status


def kpis(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_open"),
        F.count_if(_is(labels.OVERDUE)).alias("overdue"),
        F.count_if(_is(labels.DUE_TODAY)).alias("due_today"),
        F.count_if(_is(labels.AT_RISK)).alias("at_risk"),
    )


def by_priority(mart: DataFrame, ranked: bool = False) -> DataFrame:
    """Sorted by the label's text, or (``ranked``) from Critical to Low."""
    out = mart.groupBy("priority_level").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        F.round(F.avg("days_open"), 1).alias("avg_days_open"),
    )
    order = labels.rank_in(F.col("priority_level"), labels.PRIORITIES)
    return out.orderBy(order.asc_nulls_first() if ranked else F.asc_nulls_first("priority_level"))


def by_age(board: DataFrame) -> DataFrame:
    out = board.groupBy("age_bucket").agg(F.count(F.lit(1)).alias("ticket_count"))
    return out.orderBy(F.asc_nulls_first("age_bucket"))


def by_age_closed_ranges(mart: DataFrame) -> DataFrame:
    bucket = labels.age_bucket_closed(F.col("days_open")).alias("age_bucket")
    out = mart.groupBy(bucket).agg(F.count(F.lit(1)).alias("ticket_count"))
    return out.orderBy(labels.rank_in(F.col("age_bucket"), labels.AGE_BUCKETS))


def triage_pivot(mart: DataFrame) -> DataFrame:
    """Department by triage status; the labels are given, so no extra job looks for them."""
    return (
        mart.groupBy("department_name")
        .pivot("triage_status", list(labels.TRIAGE))
        .agg(F.count("service_request_number"))
        .na.fill(0, list(labels.TRIAGE))
    )


def triage_sums(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("department_name")
        .agg(
            F.count_if(_is(labels.OVERDUE)).alias("overdue"),
            F.count_if(_is(labels.DUE_TODAY)).alias("due_today"),
            F.count_if(_is(labels.AT_RISK)).alias("at_risk"),
            F.count_if(_is(labels.ON_TRACK)).alias("on_track"),
            F.count(F.lit(1)).alias("total"),
        )
        .orderBy(F.desc("overdue"), F.asc_nulls_first("department_name"))
    )


def oldest_open(mart: DataFrame, n: int = 200) -> DataFrame:
    return (
        mart.select("service_request_number", "created_date", "request_type_name",
                    "department_name", "days_open", "triage_status")
        .orderBy(F.desc_nulls_first("days_open"), "service_request_number")
        .limit(n)
    )


def nearest_breach(mart: DataFrame, n: int = 200) -> DataFrame:
    return (
        mart.select("service_request_number", "created_date", "request_type_name",
                    "community_area_name", "department_name", "days_open",
                    "days_until_breach", "triage_status")
        .orderBy(F.asc_nulls_first("days_until_breach"), "service_request_number")
        .limit(n)
    )


def department_choices(mart: DataFrame) -> DataFrame:
    return mart.select("department_name").na.drop().distinct()


def open_by_status(mart: DataFrame) -> DataFrame:
    """Open under both readings: every backlog row, and rows not marked completed."""
    return mart.agg(
        F.count(F.lit(1)).alias("no_closing_time"),
        F.count_if(F.col("status_name") != labels.COMPLETED).alias("not_completed"),
        F.count_if(_is(labels.OVERDUE)).alias("overdue"),
        F.count_if(_is(labels.DUE_TODAY)).alias("due_today"),
        F.count_if(_is(labels.AT_RISK)).alias("at_risk"),
    )


def with_bands(mart: DataFrame) -> DataFrame:
    return mart.withColumns(
        {
            "deadline_band": labels.deadline_band(F.col("days_until_breach")),
            "triage_band": labels.triage_band(F.col("triage_status")),
        }
    )


def drill_down(fct: DataFrame, geography: DataFrame, request_type: DataFrame,
               area: str, request: str) -> DataFrame:
    """Ticket rows of one area and request type.

    The names are looked up on the small sides; joined as sized lookups, they filter the
    fact while it is scanned.
    """
    areas = geography.where(F.col("community_area_name") == area)
    types = request_type.where(F.col("request_type_name") == request)
    return fct.join(areas.select("community_area_id", "community_area_name"),
                    "community_area_id").join(
        types.select("request_type_id", "request_type_name"), "request_type_id"
    ).select("service_request_number", "community_area_name", "request_type_name",
             "created_date", "closed_date", "resolution_days", "is_sla_breached")


def rows_by_year(tickets: DataFrame) -> DataFrame:
    """Ticket counts per creation year; the row with a null year is the total.

    The roll-up adds up counted years, as rolling up tickets would double every row first.
    """
    years = tickets.groupBy("created_year").agg(F.count(F.lit(1)).alias("n"))
    return years.rollup("created_year").agg(F.sum("n").alias("row_count"))
