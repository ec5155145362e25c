"""Documented business rules and questions beyond the models: duplicates, default targets,
business days, daily and monthly marts, period comparisons, and department history.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions import dates, labels
from ticketmill.operators.equity_board import with_prior
from ticketmill.operators.facts import completed

DEFAULT_TARGET_DAYS = 14


# --- row rules -------------------------------------------------------------------------

def without_duplicates(tickets: DataFrame) -> DataFrame:
    """Duplicates stay out of the SLA fact and both marts; an unknown flag is no duplicate."""
    return tickets.where(~F.coalesce("duplicate", F.lit(False)))


def with_default_target(dim_request_type: DataFrame, days: int = DEFAULT_TARGET_DAYS) -> DataFrame:
    missing = F.col("sla_target_days").isNull()
    return dim_request_type.withColumns(
        {
            "sla_target_source": F.when(missing, "default").otherwise(F.col("sla_target_source")),
            "sla_target_days": F.coalesce("sla_target_days", F.lit(days).cast("bigint")),
        }
    )


def _or_default(days: str) -> Column:
    return F.coalesce(days, F.lit(DEFAULT_TARGET_DAYS).cast("bigint"))


def business_day_numbers(dim_date: DataFrame) -> DataFrame:
    """Running count of business days; one row per calendar day is all this window sees."""
    up_to = Window.orderBy("date_day").rowsBetween(Window.unboundedPreceding, 0)
    number = F.sum(F.col("is_business_day").cast("bigint")).over(up_to)
    return dim_date.select("date_day", number.alias("business_day_number"))


def with_business_days(tickets: DataFrame, day_numbers: DataFrame, name: str = "business_days",
                       start: str = "created_date", end: str = "closed_date") -> DataFrame:
    """Business days in (start, end]: two equality lookups and a subtraction, no range join."""
    def at(day: str, number: str) -> DataFrame:
        return day_numbers.select(F.col("date_day").alias(day),
                                  F.col("business_day_number").alias(number))

    return (
        tickets.withColumn("_start", F.to_date(start)).withColumn("_end", F.to_date(end))
        .join(at("_start", "_n0"), "_start", "left")
        .join(at("_end", "_n1"), "_end", "left")
        .withColumn(name, F.col("_n1") - F.col("_n0"))
        .drop("_start", "_end", "_n0", "_n1")
    )


def sla_at_risk(stg: DataFrame, dim_request_type: DataFrame) -> DataFrame:
    """Open tickets older than their type's target are at risk; unknown targets are not."""
    targets = dim_request_type.select(F.col("request_type_name").alias("sr_type"),
                                      "sla_target_days")
    risk = F.coalesce(F.col("days_open") > F.col("sla_target_days"), F.lit(False))
    return stg.join(targets, "sr_type", "left").withColumn("sla_at_risk", risk)


def with_status_labels(dim_status: DataFrame) -> DataFrame:
    # The status vocabulary.
    name = F.col("status_name")
    return dim_status.withColumns(
        {
            "status_label": F.when(name == "Open", "Open")
            .when(name == "Completed", "Resolved")
            .when(name == "Completed - Dup", "Resolved (duplicate)")
            .when(name == "Open - Dup", "Open (duplicate)")
            .otherwise(name),
            "is_resolved": name.isin("Completed", "Completed - Dup"),
        }
    )


def with_category(dim_request_type: DataFrame, categories: DataFrame) -> DataFrame:
    """``categories``: ``sr_type``, ``category``; types without one are Uncategorized."""
    seed = categories.select(F.col("sr_type").alias("request_type_name"), "category")
    return dim_request_type.join(seed, "request_type_name", "left").withColumn(
        "category", F.coalesce("category", F.lit("Uncategorized"))
    )


# --- documented marts ------------------------------------------------------------------

def daily_backlog(stg: DataFrame, targets: DataFrame, areas: DataFrame, end) -> DataFrame:
    """Open backlog per area, type and day, from each pair's first ticket through ``end``.

    A ticket is open from its creation day up to the day before it closes, and older than
    its target once its age exceeds it. Every ticket contributes at most three dated
    changes; those are summed per day before the only running window, which therefore holds
    at most one row per day for an area and type, whatever the number of tickets. Days
    without changes are filled in from the running sums, so no ticket meets a calendar row.
    ``targets`` has sr_type and target_days, types without one get the default; duplicates are
    left out; the department shown is the pair's busiest.
    """
    stg = without_duplicates(stg)
    created, closed = F.to_date("created_date"), F.to_date("closed_date")
    last = F.lit(str(end)).cast("date")
    age_day = F.datediff(created, F.lit("1970-01-01").cast("date")).cast("bigint")
    late_from = F.date_add(created, F.col("target_days").cast("int") + 1)
    goes_late = closed.isNull() | (closed >= late_from)

    def change(day: Column, opened: Column, days: Column, late: Column, new: Column) -> Column:
        return F.struct(day.alias("day"), opened.alias("opened"), days.alias("day_sum"),
                        late.alias("late"), new.alias("created"))

    zero, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    changes = F.array(
        change(created, one, age_day, zero, one),
        F.when(closed.isNotNull(),
               change(F.greatest(closed, created), -one, -age_day,
                      F.when(goes_late, -one).otherwise(zero), zero)),
        F.when(goes_late, change(late_from, zero, zero, one, zero)),
    )
    pair = ["community_area", "sr_type"]
    known = stg.where("community_area is not null and sr_type is not null")
    per_day = (
        known.join(targets.select("sr_type", "target_days"), "sr_type", "left")
        .withColumn("target_days", _or_default("target_days"))
        .select(*pair, F.explode(F.array_compact(changes)).alias("c"))
        .select(*pair, "c.*").where(F.col("day") <= last)
        .groupBy(*pair, "day")
        .agg(*[F.sum(c).alias(c) for c in ("opened", "day_sum", "late", "created")])
    )
    by_day = Window.partitionBy(*pair).orderBy("day")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    running = per_day.select(
        *pair, "day", "created", F.sum("opened").over(so_far).alias("open_requests"),
        F.sum("day_sum").over(so_far).alias("day_sum"),
        F.sum("late").over(so_far).alias("requests_older_than_sla"),
        F.coalesce(F.date_sub(F.lead("day").over(by_day), 1), last).alias("until"),
    ).withColumn("snapshot_date", F.explode(F.sequence("day", "until")))
    today = F.datediff("snapshot_date", F.lit("1970-01-01").cast("date")).cast("bigint")
    age_total = F.col("open_requests") * today - F.col("day_sum")
    return (
        running.join(busiest_department(known), pair, "left")
        .join(areas.select(F.col("community_area_id").alias("community_area"),
                           "community_area_name"), "community_area", "left")
        .select(
            "snapshot_date", "community_area", "community_area_name", "sr_type",
            "owner_department", "open_requests",
            F.try_divide(age_total, F.col("open_requests")).alias("avg_days_open"),
            "requests_older_than_sla",
            F.when(F.col("snapshot_date") == F.col("day"), F.col("created"))
            .otherwise(0).cast("bigint").alias("total_created_today"),
        )
    )


def busiest_department(stg: DataFrame) -> DataFrame:
    """The department with most tickets per area and type; ties go to the lower name."""
    counts = stg.where("owner_department is not null").groupBy(
        "community_area", "sr_type", "owner_department").agg(F.count(F.lit(1)).alias("n"))
    first = F.struct(-F.col("n"), F.col("owner_department"))
    return counts.groupBy("community_area", "sr_type").agg(
        F.min_by("owner_department", first).alias("owner_department"))


def monthly_sla(stg: DataFrame, targets: DataFrame, areas: DataFrame,
                day_numbers: DataFrame) -> DataFrame:
    """Completed tickets per closing month, type, department and area.

    ``targets`` has sr_type and target_days; types without one get the default. The equity index compares with the same type
    and month city-wide; its window runs over grouped rows. Tickets are first counted per
    number of days, so the exact median works on weighted day counts, not on tickets.
    """
    done = completed(without_duplicates(stg)).where("closed_date is not null")
    done = with_business_days(
        done.join(targets.select("sr_type", "target_days"), "sr_type", "left"), day_numbers
    ).withColumn("target_days", _or_default("target_days"))
    days = F.col("resolution_days")
    grain = ["period_month", "sr_type", "owner_department", "community_area"]
    per_days = done.withColumn("period_month", F.to_date(F.trunc("closed_date", "MM"))).groupBy(
        *grain, "resolution_days").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(days > F.col("target_days")).alias("late"),
        F.sum("business_days").alias("business"),
        F.count("business_days").alias("business_known"),
    )
    grouped = per_days.groupBy(*grain).agg(
        F.sum("n").alias("total_closed"),
        F.sum("late").alias("total_breached"),
        F.sum(days * F.col("n")).alias("_days"),
        F.sum(F.when(days.isNotNull(), F.col("n"))).alias("_known"),
        F.try_divide(F.sum("business"), F.sum("business_known")).alias("avg_business_days_taken"),
        F.percentile(days, 0.5, F.col("n")).alias("median_resolution_days"),
    )
    same = Window.partitionBy("period_month", "sr_type")
    average = F.try_divide(F.col("_days"), F.col("_known"))
    city = F.try_divide(F.sum("_days").over(same), F.sum("_known").over(same))
    return (
        grouped.withColumn("avg_resolution_days", average)
        .withColumn("equity_index", F.try_divide(F.col("avg_resolution_days"), city))
        .withColumn("breach_rate", F.col("total_breached") / F.col("total_closed"))
        .join(areas.select(F.col("community_area_id").alias("community_area"),
                           "community_area_name"), "community_area", "left")
        .select(*grain, "community_area_name", "total_closed", "total_breached", "breach_rate",
                "avg_resolution_days", "avg_business_days_taken", "median_resolution_days",
                "equity_index")
    )


def period_equity(sla: DataFrame) -> DataFrame:
    """Equity index per area, type and closing month, against the same type and month."""
    period = F.trunc("closed_date", "MM").alias("period_month")
    same = Window.partitionBy("period_month", "request_type_id")
    grouped = (
        sla.where("closed_date is not null and request_type_id is not null")
        .groupBy(period, "request_type_id", "community_area_id")
        .agg(F.count(F.lit(1)).alias("completed"), F.sum("resolution_days").alias("_days"),
             F.count("resolution_days").alias("_known"))
    )
    city = F.try_divide(F.sum("_days").over(same), F.sum("_known").over(same))
    return grouped.select(
        "period_month", "request_type_id", "community_area_id", "completed",
        F.try_divide("_days", "_known").alias("area_avg_resolution_days"),
        city.alias("citywide_avg_resolution_days"),
    ).withColumn("equity_index", F.try_divide("area_avg_resolution_days",
                                              "citywide_avg_resolution_days"))


# --- questions of the operations team --------------------------------------------------

def overdue_by_department(mart: DataFrame) -> DataFrame:
    return (
        mart.groupBy("department_name")
        .agg(F.count_if(F.col("triage_status") == labels.OVERDUE).alias("overdue"))
        .orderBy(F.desc("overdue"), F.asc_nulls_first("department_name"))
    )


def breaches_this_week(sla: DataFrame, dim_request_type: DataFrame, as_of) -> DataFrame:
    """Breaches per request type among tickets closed since Monday, through ``as_of``."""
    today = dates.as_of_or_today(as_of)
    closed = F.col("closed_date")
    recent = sla.where((closed >= F.trunc(today, "week")) & (closed <= today))
    names = dim_request_type.select("request_type_id", "request_type_name")
    return (
        recent.groupBy("request_type_id")
        .agg(F.count(F.lit(1)).alias("completed"), F.count_if("is_breached").alias("breached"))
        .join(names, "request_type_id", "left")
        .select("request_type_name", "completed", "breached")
        .orderBy(F.desc("breached"), F.asc_nulls_first("request_type_name"))
    )


def backlog_change(tickets: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Tickets created and closed per week, their difference, and the running backlog.

    One pass: a ticket yields its creation week and, if closed, its closing week. The
    running sum is over the weeks of a key.
    """
    def event(day: str, created: int) -> Column:
        return F.struct(F.trunc(day, "week").alias("week_start"), F.lit(created).alias("created"))

    events = F.array(event("created_date", 1),
                     F.when(F.col("closed_date").isNotNull(), event("closed_date", 0)))
    weekly = (
        tickets.select(*keys, F.explode(F.array_compact(events)).alias("e"))
        .select(*keys, "e.*").groupBy(*keys, "week_start")
        .agg(F.count_if(F.col("created") == 1).alias("created"),
             F.count_if(F.col("created") == 0).alias("closed"))
    )
    so_far = (Window.partitionBy(*keys).orderBy("week_start")
              .rowsBetween(Window.unboundedPreceding, 0))
    net = F.col("created") - F.col("closed")
    return weekly.withColumn("net_change", net).withColumn(
        "backlog", F.sum("net_change").over(so_far))


def oldest_by_area(mart: DataFrame) -> DataFrame:
    """Oldest unresolved ticket per area; a minimum, so areas of any size combine map-side."""
    first = F.min(F.struct("created_date", "service_request_number", "days_open"))
    return mart.groupBy("community_area_name").agg(
        first.alias("t"), F.count(F.lit(1)).alias("open_requests")
    ).select("community_area_name", "t.created_date", "t.service_request_number",
             "t.days_open", "open_requests")


# --- questions of the executives -------------------------------------------------------

def compliance_by_month(sla: DataFrame, months: int = 1) -> DataFrame:
    """Share of completed tickets with a target that met it, against ``months`` earlier."""
    judged = sla.where("closed_date is not null and sla_target_days is not null")
    monthly = judged.groupBy(F.trunc("closed_date", "MM").alias("period_month")).agg(
        F.count(F.lit(1)).alias("completed"),
        F.count_if(~F.col("is_breached")).alias("met"),
    ).withColumn("compliance_rate", F.col("met") / F.col("completed"))
    out = with_prior(monthly, "period_month", ["compliance_rate"], months)
    return out.withColumn("compliance_change",
                          F.col("compliance_rate") - F.col("prior_compliance_rate"))


def slow_areas(mart: DataFrame, at_least: float = 1.10) -> DataFrame:
    """Per area: graded rows, how many are slow, and their share."""
    return (
        mart.groupBy("community_area_name")
        .agg(F.count("equity_index").alias("graded"),
             F.count_if(F.col("equity_index") >= at_least).alias("slow"))
        .withColumn("slow_share", F.try_divide("slow", "graded"))
        .orderBy(F.desc_nulls_last("slow_share"), F.asc_nulls_first("community_area_name"))
    )


def equity_trend(sla: DataFrame, months: int = 1) -> DataFrame:
    """Share of area and type pairs slower than average per month, and its change."""
    monthly = period_equity(sla).groupBy("period_month").agg(
        F.count("equity_index").alias("graded"),
        F.count_if(F.col("equity_index") >= 1.10).alias("slow"),
    ).withColumn("slow_share", F.try_divide("slow", "graded"))
    out = with_prior(monthly, "period_month", ["slow_share"], months)
    return out.withColumn("slow_share_change", F.col("slow_share") - F.col("prior_slow_share"))


def annual_audit(sla: DataFrame, dim_department: DataFrame,
                 dim_request_type: DataFrame) -> DataFrame:
    """Compliance per closing year, with department and type subtotals.

    Tickets are summed once at the finest level; the roll-up runs over those sums.
    """
    fine = (
        sla.where("closed_date is not null")
        .groupBy(F.year("closed_date").cast("bigint").alias("closed_year"),
                 "department_id", "request_type_id")
        .agg(F.count(F.lit(1)).alias("completed"),
             F.count("sla_target_days").alias("judged"),
             F.count_if("is_breached").alias("breached"),
             F.sum("resolution_days").alias("days"))
        .join(dim_department.select("department_id", "department_name"), "department_id", "left")
        .join(dim_request_type.select("request_type_id", "request_type_name"),
              "request_type_id", "left")
    )
    rolled = fine.groupingSets(
        [["closed_year"], ["closed_year", "department_name"],
         ["closed_year", "department_name", "request_type_name"]],
        "closed_year", "department_name", "request_type_name",
    ).agg(*_audit_sums(),
          F.grouping_id("closed_year", "department_name", "request_type_name").alias("lvl"))
    level = F.when(F.col("lvl") == 3, "year").when(F.col("lvl") == 1, "department").otherwise("type")
    return rolled.select(
        "closed_year", "department_name", "request_type_name", level.alias("audit_level"),
        "completed", "breached",
        F.try_divide(F.col("judged") - F.col("breached"), F.col("judged")).alias("compliance_rate"),
        F.try_divide("days", "completed").alias("avg_resolution_days"),
    )


def _audit_sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("completed", "judged", "breached", "days")]


# --- history ---------------------------------------------------------------------------

def _neighbour(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column,
               name: str, ahead: bool) -> DataFrame:
    """The previous (or next) row's non-null ``value`` within ``keys``, in ``order``.

    Rows carry a ``_bucket`` that follows the order. The window runs inside a bucket, and a
    second one over a single edge row per bucket links the buckets, so one key's rows spread
    over as many tasks as it has buckets.
    """
    step, edge = (F.lead, F.min_by) if ahead else (F.lag, F.max_by)
    inside = df.withColumn(name, step(value).over(
        Window.partitionBy(*keys, "_bucket").orderBy(*order)))
    edges = df.groupBy(*keys, "_bucket").agg(edge(value, F.struct(*order)).alias("_edge"))
    edges = edges.withColumn("_edge", step("_edge").over(
        Window.partitionBy(*keys).orderBy("_bucket")))
    return inside.join(edges, [*keys, "_bucket"], "left").withColumn(
        name, F.coalesce(name, "_edge")).drop("_edge")


def scd2(history: DataFrame, keys: Sequence[str], attributes: Sequence[str], at: str,
         tiebreak: str | None = None, bucket: str = "month") -> DataFrame:
    """Type 2 history: one row per period in which ``attributes`` did not change.

    ``valid_to`` is the start of the next period, null on the current row. ``bucket`` is the
    ``date_trunc`` unit that spreads a busy key; it does not affect the result. Keys and
    ``at`` are not null.
    """
    order = [at, *([tiebreak] if tiebreak else [])]
    state = F.struct(*attributes)
    rows = history.select(*keys, *attributes, *order).withColumn(
        "_bucket", F.date_trunc(bucket, at))
    rows = _neighbour(rows, keys, order, state, "_before", ahead=False)
    changes = rows.where(~state.eqNullSafe(F.col("_before"))).drop("_before")
    changes = _neighbour(changes, keys, order, F.struct(at), "_next", ahead=True)
    return changes.select(
        *keys, *attributes, F.col(at).alias("valid_from"),
        F.col("_next").getField(at).alias("valid_to"),
        F.col("_next").isNull().alias("is_current"),
    )
