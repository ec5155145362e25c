"""Result frames of the SLA and equity board, from ``mart_sla_performance``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import dates, labels


def board_frame(mart: DataFrame) -> DataFrame:
    """Short labels, set on the rounded index the mart shows."""
    short = labels.equity(F.col("equity_index"), labels.EQUITY_SHORT)
    return mart.withColumn("equity_bucket", short)


def kpis(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count(F.lit(1)).alias("total_areas"),
        F.avg("area_breach_rate").alias("avg_breach_rate"),
        F.count_if(F.col("equity_status") == labels.SEVERE).alias("severely_underserved"),
        F.avg("area_avg_resolution_days").alias("avg_resolution_days"),
    )


def requests_by_equity(mart: DataFrame) -> DataFrame:
    out = mart.groupBy("equity_status").agg(F.sum("area_total_requests").alias("total_requests"))
    return out.orderBy(F.asc_nulls_first("equity_status"))


def _row_order(first):
    names = ("community_area_name", "request_type_name", "department_name")
    return [first, *[F.asc_nulls_first(n) for n in names]]


def top_breach(mart: DataFrame, n: int = 10) -> DataFrame:
    return (
        mart.orderBy(*_row_order(F.desc_nulls_first("area_breach_rate"))).limit(n)
        .select("community_area_name", "area_breach_rate")
    )


def department_breach(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("department_name")
        .agg(F.sum("area_breached_requests").alias("breached"),
             F.sum("area_total_requests").alias("total"))
        .withColumn("breach_rate", F.try_divide("breached", "total"))
        .orderBy(F.desc_nulls_first("breach_rate"), F.asc_nulls_first("department_name"))
    )


def slowest(mart: DataFrame, n: int = 20) -> DataFrame:
    return (
        mart.orderBy(*_row_order(F.desc_nulls_first("area_avg_resolution_days"))).limit(n)
        .select("community_area_name", "area_avg_resolution_days",
                "citywide_avg_resolution_days")
    )


def detail(mart: DataFrame, n: int = 200) -> DataFrame:
    return (
        mart.orderBy(*_row_order(F.desc_nulls_first("area_breach_rate"))).limit(n)
        .select("community_area_name", "city_side", "request_type_name", "department_name",
                "area_total_requests", "area_breach_rate", "area_avg_resolution_days",
                "equity_index", "equity_status")
    )


def completion_rate(mart: DataFrame) -> DataFrame:
    known = F.count("equity_index").cast("double")
    rate = F.round(F.try_divide(known * 100, F.count(F.lit(1))), 1)
    return mart.agg(rate.alias("completion_rate"))


def mean_resolution(mart: DataFrame) -> DataFrame:
    return mart.agg(F.round(F.avg("area_avg_resolution_days"), 1).alias("avg_resolution_days"))


def breach_rate(mart: DataFrame) -> DataFrame:
    breached = F.sum("area_breached_requests").cast("double")
    rate = F.round(F.try_divide(breached * 100, F.sum("area_total_requests")), 1)
    return mart.agg(rate.alias("breach_rate"))


def mean_equity(mart: DataFrame, min_requests: int = 10) -> DataFrame:
    enough = mart.where(F.col("area_total_requests") >= min_requests)
    return enough.agg(F.round(F.avg("equity_index"), 2).alias("equity_index"))


def heatmap(mart: DataFrame, min_requests: int = 10) -> DataFrame:
    return (
        mart.where(F.col("area_total_requests") >= min_requests)
        .select("community_area_name", "request_type_name", "area_total_requests",
                F.round("area_avg_resolution_days", 1).alias("avg_days"),
                F.round("equity_index", 2).alias("equity_index"), "equity_status")
        .orderBy(F.asc_nulls_first("community_area_name"), F.desc_nulls_last("equity_index"))
    )


def heatmap_grid(mart: DataFrame, request_types: Sequence[str]) -> DataFrame:
    """The heatmap as a grid, weighted over departments; the types to show are given."""
    weight = F.when(F.col("equity_index").isNotNull(), F.col("area_total_requests"))
    cells = mart.groupBy("community_area_name").pivot("request_type_name", list(request_types))
    return cells.agg(
        F.round(F.try_divide(F.sum(F.col("equity_index") * weight), F.sum(weight)), 2)
    )


def department_breach_percent(mart: DataFrame) -> DataFrame:
    breached = F.sum("area_breached_requests").cast("double")
    rate = F.round(F.try_divide(breached * 100, F.sum("area_total_requests")), 1)
    return (
        mart.groupBy("department_name").agg(rate.alias("breach_rate"))
        .orderBy(F.desc_nulls_last("breach_rate"), F.asc_nulls_first("department_name"))
    )


def equity_summary(mart: DataFrame, min_requests: int = 10) -> DataFrame:
    """The window runs over the grouped rows, one per equity status."""
    share = F.col("_rows").cast("double") * 100 / F.sum("_rows").over(Window.partitionBy())
    return (
        mart.where(F.col("area_total_requests") >= min_requests)
        .groupBy("equity_status")
        .agg(F.countDistinct("community_area_name").alias("num_areas"),
             F.count(F.lit(1)).alias("_rows"),
             F.round(F.avg("area_avg_resolution_days"), 1).alias("avg_resolution_days"))
        .select("equity_status", "num_areas", F.round(share, 1).alias("pct_of_city"),
                "avg_resolution_days")
        .orderBy(labels.rank_in(F.col("equity_status"), labels.EQUITY))
    )


def with_bands(mart: DataFrame) -> DataFrame:
    return mart.withColumns(
        {
            "equity_band": labels.equity_band(F.col("equity_index")),
            "breach_band": labels.breach_band(F.col("area_breach_rate")),
        }
    )


def with_prior(df: DataFrame, period: str, values: Sequence[str], months: int = 1,
               keys: Sequence[str] = ()) -> DataFrame:
    """Each value ``months`` earlier, null when that month has no row.

    A range frame on the month number finds the exact month, gaps or not. The input has one
    row per key and month, so a partition holds no more rows than there are months.
    """
    w = (
        Window.partitionBy(*keys).orderBy(dates.month_index(F.col(period)))
        .rangeBetween(-months, -months)
    )
    return df.withColumns({f"prior_{v}": F.max(v).over(w) for v in values})


def scorecard_delta(sla: DataFrame, months: int = 1) -> DataFrame:
    """Monthly scorecards from the SLA fact with the change against an earlier month."""
    period = F.trunc("closed_date", "MM").alias("period_month")
    monthly = (
        sla.where(F.col("closed_date").isNotNull()).groupBy(period)
        .agg(F.count(F.lit(1)).alias("completed"),
             F.avg("resolution_days").alias("avg_resolution_days"),
             F.try_divide(F.count_if("is_breached"), F.count(F.lit(1))).alias("breach_rate"))
    )
    values = ("completed", "avg_resolution_days", "breach_rate")
    out = with_prior(monthly, "period_month", values, months)
    return out.select(
        "period_month", *values,
        *[(F.col(v) - F.col(f"prior_{v}")).alias(f"{v}_delta") for v in values],
    )


def trend(sla: DataFrame, grain: str = "month") -> DataFrame:
    """Completed tickets, breaches and mean days per closing day, week or month."""
    day = F.col("closed_date")
    period = day if grain == "day" else F.trunc(day, grain)
    return sla.where(day.isNotNull()).groupBy(period.alias("period")).agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if("is_breached").alias("breached"),
        F.avg("resolution_days").alias("avg_resolution_days"),
    )
