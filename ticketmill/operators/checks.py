"""Data-quality checks: failing rows of one check, and suites over a table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Check:
    """``columns`` has several names only for a unique combination."""

    name: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None

    @property
    def label(self) -> str:
        return ", ".join(self.columns)


def unique(column: str) -> Check:
    return Check("unique", (column,))


def unique_combination(*columns: str) -> Check:
    return Check("unique_combination", columns)


def not_null(column: str) -> Check:
    return Check("not_null", (column,))


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Check:
    return Check("accepted_range", (column,), low, high)


def duplicates(df: DataFrame, columns: Sequence[str], ignore_null: bool) -> DataFrame:
    """Repeated values with their counts; copies collapse before the shuffle."""
    if ignore_null:
        df = df.where(F.col(columns[0]).isNotNull())
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def _row_fails(check: Check) -> Column:
    c = F.col(check.columns[0])
    if check.name == "not_null":
        return c.isNull()
    fails = F.lit(False)
    if check.low is not None:
        fails = fails | (c < check.low)
    if check.high is not None:
        fails = fails | (c > check.high)
    return F.coalesce(fails, F.lit(False))


def failing_rows(df: DataFrame, check: Check) -> DataFrame:
    if check.name.startswith("unique"):
        return duplicates(df, check.columns, ignore_null=check.name == "unique")
    return df.where(_row_fails(check))


RESULT = "model string, check_name string, checked string, failures bigint, passed boolean"


def run_suites(suites: Mapping[str, tuple[DataFrame, Iterable[Check]]]) -> DataFrame:
    """One row per model and check: ``model``, ``check_name``, ``checked``, ``failures``, ``passed``.

    All checks that look at single rows share one aggregate over their table, and all uniqueness
    checks of the same columns one grouping, which sends each task's distinct keys once. Equal
    checks of a model are run and listed once. A failing check is a row in the result, never an
    error.
    """
    parts = []
    for model, (df, checks) in suites.items():
        checks = list(dict.fromkeys(checks))
        row_checks = [c for c in checks if not c.name.startswith("unique")]
        if row_checks:
            counts = df.agg(*[F.count_if(_row_fails(c)).alias(f"f{i}") for i, c in enumerate(row_checks)])
            parts.append(_listed(counts, model, row_checks))
        by_key: dict[tuple[str, ...], list[Check]] = {}
        for c in checks:
            if c.name.startswith("unique"):
                by_key.setdefault(c.columns, []).append(c)
        for columns, same in by_key.items():
            repeated = duplicates(df, columns, ignore_null=all(c.name == "unique" for c in same))
            known = F.col(columns[0]).isNotNull()
            counts = repeated.agg(*[
                (F.count_if(known) if c.name == "unique" else F.count(F.lit(1))).alias(f"f{i}")
                for i, c in enumerate(same)])
            parts.append(_listed(counts, model, same))
    if not parts:
        spark = next((df.sparkSession for df, _ in suites.values()), None) or SparkSession.active()
        return spark.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts).withColumn("passed", F.col("failures") == 0)


def _listed(counts: DataFrame, model: str, checks: Sequence[Check]) -> DataFrame:
    """The one row of ``counts`` (f0, f1, ...) as a row per check."""
    rows = F.array(*[
        F.struct(F.lit(model).alias("model"), F.lit(c.name).alias("check_name"),
                 F.lit(c.label).alias("checked"), F.col(f"f{i}").alias("failures"))
        for i, c in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


def run_suite(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """:func:`run_suites` of one table, without the model's name."""
    return run_suites({"": (df, checks)}).drop("model")


def freshness(df: DataFrame, as_of, max_hours: int = 24,
              column: str = "last_modified_date") -> DataFrame:
    """Newest change, its age in whole hours at ``as_of`` (a timestamp), and the verdict."""
    now = F.lit(as_of).cast("timestamp_ntz") if as_of is not None else F.localtimestamp()
    age = F.timestamp_diff("HOUR", F.col("newest"), now).cast("bigint")
    limit = F.expr(f"interval {max_hours} hours")
    return df.agg(F.max(column).alias("newest")).select(
        "newest", age.alias("age_hours"),
        F.coalesce(now <= F.col("newest") + limit, F.lit(False)).alias("passed"),
    )


# The suites of the source table, the models and the seeds.
SOURCE = (
    unique("service_request_number"), not_null("service_request_number"), not_null("sr_type"),
    not_null("current_status"), not_null("owner_department"), not_null("created_date"),
    not_null("last_modified_date"), not_null("community_area"), not_null("created_year"),
    not_null("created_month"), accepted_range("created_month", 1, 12),
)
STAGING = (
    unique("service_request_number"), not_null("service_request_number"), not_null("sr_type"),
    not_null("current_status"), not_null("owner_department"), not_null("created_date"),
    not_null("last_modified_date"), not_null("community_area"), not_null("dbt_loaded_at"),
    accepted_range("latitude", -90, 90),
    accepted_range("longitude", -180, 180), not_null("created_year"), not_null("created_month"),
    accepted_range("created_month", 1, 12),
)
DIM_DATE = (unique("date_day"), not_null("date_day"))
DIM_DEPARTMENT = (not_null("department_id"), not_null("dbt_updated_at"))
DIM_GEOGRAPHY = (
    unique("community_area_id"), not_null("community_area_id"), not_null("dbt_updated_at"),
)
DIM_REQUEST_TYPE = (
    unique("request_type_id"), not_null("request_type_id"), not_null("dbt_updated_at"),
)
DIM_STATUS = (not_null("status_id"), not_null("dbt_updated_at"))
FACT = (
    unique_combination("service_request_number"), unique("service_request_number"),
    not_null("service_request_number"), not_null("request_type_id"), not_null("department_id"),
    not_null("community_area_id"),
)
SLA_FACT = (
    unique_combination("service_request_number"), unique("service_request_number"),
    not_null("service_request_number"),
)
MART_OPERATIONAL = (
    unique("service_request_number"), not_null("service_request_number"),
    not_null("created_date"),
)
SEED_AREAS = (
    unique("area_number"), not_null("area_number"), unique("area_name"), not_null("area_name"),
    not_null("side"),
)
SEED_TARGETS = (unique("sr_type"), not_null("sr_type"))
SEED_DEPARTMENTS = (unique("owner_department"), not_null("owner_department"))
# The contracts of the two documented marts (see ``rules.daily_backlog`` and ``monthly_sla``).
CONTRACT_DAILY = (
    unique_combination("community_area", "sr_type", "snapshot_date"), not_null("snapshot_date"),
    not_null("community_area"), accepted_range("community_area", 1, 77),
    not_null("community_area_name"), not_null("sr_type"), not_null("owner_department"),
    not_null("open_requests"), accepted_range("open_requests", 0),
    not_null("requests_older_than_sla"), accepted_range("requests_older_than_sla", 0),
    not_null("total_created_today"), accepted_range("total_created_today", 0),
)
CONTRACT_MONTHLY = (
    unique_combination("period_month", "sr_type", "owner_department", "community_area"),
    not_null("period_month"), not_null("sr_type"), not_null("owner_department"),
    not_null("community_area"), not_null("community_area_name"), not_null("total_closed"),
    accepted_range("total_closed", 0), not_null("total_breached"),
    accepted_range("total_breached", 0), not_null("breach_rate"),
    accepted_range("breach_rate", 0.0, 1.0),
)

