"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.functions import geometry, text
from ticketmill.functions.keys import surrogate_key

# State holidays of 2024, 2025 and 2026.
STATE_HOLIDAYS = (
    "2024-01-01", "2024-01-15", "2024-02-12", "2024-02-19", "2024-03-04",
    "2024-05-27", "2024-06-19", "2024-07-04", "2024-09-02", "2024-10-14",
    "2024-11-05", "2024-11-11", "2024-11-28", "2024-11-29", "2024-12-25",
    "2025-01-01", "2025-01-20", "2025-02-12", "2025-02-17", "2025-03-03",
    "2025-05-26", "2025-06-19", "2025-07-04", "2025-09-01", "2025-10-13",
    "2025-11-11", "2025-11-27", "2025-11-28", "2025-12-25",
    "2026-01-01", "2026-01-19", "2026-02-12", "2026-02-16", "2026-03-02",
    "2026-05-25", "2026-06-19", "2026-07-03", "2026-09-07", "2026-10-12",
    "2026-11-03", "2026-11-11", "2026-11-26", "2026-11-27", "2026-12-25",
)
# The calendar's own range, end exclusive.
CALENDAR_START, CALENDAR_END = "2024-01-01", "2027-01-01"


def holidays(spark: SparkSession, days=STATE_HOLIDAYS) -> DataFrame:
    dates = F.array(*[F.lit(d).cast("date") for d in days])
    return spark.range(1).select(F.explode(dates).alias("holiday_date"))


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from a one-row frame with ``start`` and (exclusive) ``end`` dates."""
    last = F.greatest(F.date_sub("end", 1), "start")
    days = F.sequence(F.col("start"), last, F.expr("interval 1 day"))
    return bounds.where(F.col("start") < F.col("end")).select(F.explode(days).alias("date_day"))


def fixed_bounds(spark: SparkSession, start=CALENDAR_START, end=CALENDAR_END) -> DataFrame:
    return spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )


def calendar_attributes(spine: DataFrame) -> DataFrame:
    d = F.col("date_day")
    return spine.select(
        d,
        F.year(d).cast("bigint").alias("date_year"),
        F.month(d).cast("bigint").alias("date_month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofweek(d).cast("bigint").alias("day_of_week_num"),
        F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.quarter(d).cast("bigint").alias("date_quarter"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
    )


def with_weekend(calendar: DataFrame) -> DataFrame:
    return calendar.withColumn("is_weekend", F.dayofweek("date_day").isin(1, 7))


def with_holiday(calendar: DataFrame, holiday_dates: DataFrame) -> DataFrame:
    marked = holiday_dates.select(F.col("holiday_date").alias("date_day")).distinct()
    marked = marked.withColumn("_holiday", F.lit(True))
    return (
        calendar.join(marked, "date_day", "left")
        .withColumn("is_illinois_holiday", F.col("_holiday").isNotNull())
        .drop("_holiday")
    )


def with_business_day(calendar: DataFrame) -> DataFrame:
    return calendar.withColumn(
        "is_business_day", ~F.col("is_weekend") & ~F.col("is_illinois_holiday")
    )


def dim_date(bounds: DataFrame, holiday_dates: DataFrame) -> DataFrame:
    calendar = with_weekend(calendar_attributes(date_spine(bounds)))
    return with_business_day(with_holiday(calendar, holiday_dates))


def members(stg: DataFrame) -> DataFrame:
    """Distinct combinations of the columns that feed the three text dimensions.

    One pass over the tickets instead of three; duplicates collapse before the shuffle, so
    what moves is the number of combinations, whatever the number of tickets.
    """
    return stg.select("sr_type", "sr_short_code", "owner_department", "current_status").distinct()


def distinct_departments(stg: DataFrame) -> DataFrame:
    return stg.select("owner_department").where("owner_department is not null").distinct()


def dim_department(stg: DataFrame, metadata: DataFrame) -> DataFrame:
    raw = F.col("owner_department")
    return distinct_departments(stg).join(metadata, "owner_department", "left").select(
        surrogate_key(raw).alias("department_id"),
        raw.alias("raw_department_name"),
        F.coalesce("display_name", raw).alias("department_name"),
        "bureau",
    )


def dim_request_type(stg: DataFrame, targets: DataFrame, by_code: bool = False) -> DataFrame:
    """One row per type, with its lowest short code.

    ``by_code`` keeps a row per (type, short code) pair; such a dimension repeats its id and
    would multiply fact rows, so facts take the default form.
    """
    types = stg.select("sr_type", "sr_short_code").where("sr_type is not null").distinct()
    if not by_code:
        types = types.groupBy("sr_type").agg(F.min("sr_short_code").alias("sr_short_code"))
    return types.join(targets, "sr_type", "left").select(
        surrogate_key(F.col("sr_type")).alias("request_type_id"),
        F.col("sr_type").alias("request_type_name"),
        "sr_short_code",
        F.col("target_days").cast("bigint").alias("sla_target_days"),
        F.col("priority").alias("priority_level"),
        "sla_target_source",
    )


def dim_status(stg: DataFrame) -> DataFrame:
    status = F.col("current_status")
    return stg.select(status).where(status.isNotNull()).distinct().select(
        surrogate_key(status).alias("status_id"), status.alias("status_name")
    )


def dim_geography(areas: DataFrame) -> DataFrame:
    """One row per area; ward stays on the fact, since an area spans several wards. A boundary that
    is no valid shape fails, with the area's name and the ring."""
    boundary = geometry.checked(geometry.multipolygon(F.col("the_geom")), F.col("area_name"))
    return areas.select(
        F.col("area_number").cast("bigint").alias("community_area_id"),
        F.col("area_name").alias("community_area_name"),
        F.col("side").alias("city_side"),
        boundary.alias("area_boundary"),
        text.number_with_commas(F.col("shape_area")).alias("shape_area"),
        text.number_with_commas(F.col("shape_len")).alias("shape_length"),
    )


def with_rebuild_time(model: DataFrame) -> DataFrame:
    return model.withColumn("dbt_updated_at", F.current_timestamp())
