"""The open-backlog mart and the SLA and equity mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import dates, labels


def open_backlog(fct: DataFrame) -> DataFrame:
    """Open means no closing time; the status is not consulted."""
    return fct.where(F.col("closed_timestamp").isNull())


def enriched(fct: DataFrame, geography: DataFrame, request_type: DataFrame,
             department: DataFrame, status: DataFrame) -> DataFrame:
    """Four left equi-joins; each lookup is cut to the columns the mart shows."""
    return (
        fct.join(geography.select("community_area_id", "community_area_name"),
                 "community_area_id", "left")
        .join(request_type.select("request_type_id", "request_type_name", "priority_level",
                                  "sla_target_days"), "request_type_id", "left")
        .join(department.select("department_id", "department_name", "bureau"),
              "department_id", "left")
        .join(status.select("status_id", "status_name"), "status_id", "left")
    )


def with_triage(backlog: DataFrame, as_of=None) -> DataFrame:
    days_open = dates.days_between(dates.as_of_or_today(as_of), F.col("created_date"))
    left = F.col("days_until_breach")
    return (
        backlog.withColumn("days_open", days_open)
        .withColumn("days_until_breach", F.col("sla_target_days") - F.col("days_open"))
        .withColumn("triage_status", labels.triage(left))
    )


def mart_operational(fct: DataFrame, geography: DataFrame, request_type: DataFrame,
                     department: DataFrame, status: DataFrame, as_of=None) -> DataFrame:
    rows = enriched(open_backlog(fct), geography, request_type, department, status)
    return with_triage(rows, as_of).select(
        "service_request_number", "created_date", "last_modified_date", "community_area_name",
        "ward", "latitude", "longitude", "department_name", "bureau", "request_type_name",
        "priority_level", "sla_target_days", "status_name", "days_open", "days_until_breach",
        "triage_status",
    )


def area_performance(sla: DataFrame) -> DataFrame:
    """Sums rather than averages, so that coarser levels can be built from these rows."""
    return sla.groupBy("community_area_id", "request_type_id", "department_id").agg(
        F.sum("resolution_days").alias("days_total"),
        F.count("resolution_days").alias("days_known"),
        F.count("service_request_number").alias("area_total_requests"),
        F.count_if("is_breached").alias("area_breached_requests"),
    ).withColumn("area_avg_resolution_days", F.try_divide("days_total", "days_known"))


def equity(sla: DataFrame, min_requests: int = 10) -> DataFrame:
    """Area against city-wide average per type, for groups with enough tickets.

    The city-wide figures are summed from the area rows: one pass over the fact, and the
    second step sees one row per area, type and department, so a type with a third of all
    tickets is no heavier than any other. Rows without a type have no baseline and drop out.
    """
    same_type = Window.partitionBy("request_type_id")
    city_avg = F.try_divide(
        F.sum("days_total").over(same_type), F.sum("days_known").over(same_type)
    )
    return (
        area_performance(sla)
        .where(F.col("request_type_id").isNotNull())
        .withColumn("citywide_avg_resolution_days", city_avg)
        .withColumn("citywide_total_requests", F.sum("area_total_requests").over(same_type))
        .where(F.col("area_total_requests") >= min_requests)
        .withColumn("area_breach_rate",
                    F.try_divide("area_breached_requests", "area_total_requests"))
        .withColumn("equity_index",
                    F.try_divide("area_avg_resolution_days", "citywide_avg_resolution_days"))
        .withColumn("equity_status", labels.equity(F.col("equity_index")))
    )


def mart_sla_performance(sla: DataFrame, geography: DataFrame, request_type: DataFrame,
                         department: DataFrame, min_requests: int = 10) -> DataFrame:
    """The status is set on the exact index; only the shown index is rounded."""
    return (
        equity(sla, min_requests)
        .join(geography.select("community_area_id", "community_area_name", "city_side"),
              "community_area_id", "left")
        .join(request_type.select("request_type_id", "request_type_name", "priority_level"),
              "request_type_id", "left")
        .join(department.select("department_id", "department_name", "bureau"),
              "department_id", "left")
        .select(
            "community_area_name", "city_side", "request_type_name", "priority_level",
            "department_name", "bureau", "area_total_requests", "area_breached_requests",
            "area_breach_rate", "area_avg_resolution_days", "citywide_avg_resolution_days",
            F.round("equity_index", 2).alias("equity_index"), "equity_status",
        )
    )
