"""Data-quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators import checks, rules
from ticketmill.registry import query
from ticketmill.registry.oracle import AS_OF as AS_OF_SQL
from ticketmill.samples import AS_OF, Bed


def _suite(table: str, *rows: tuple[str, str, str]) -> str:
    """SQL for a suite: check name, columns as shown, and the failing-row count."""
    return "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, '{cols}' AS checked, ({count}) AS failures"
        for name, cols, count in (_check(table, *r) for r in rows)) + ")"


def _check(table: str, name: str, cols: str, arg: str = "") -> tuple[str, str, str]:
    if name.startswith("unique"):
        null = f" WHERE {cols} IS NOT NULL" if name == "unique" else ""
        return name, cols, (f"SELECT count(*) FROM (SELECT {cols} FROM {table}{null} "
                            f"GROUP BY {cols} HAVING count(*) > 1)")
    condition = f"{cols} IS NULL" if name == "not_null" else arg
    return name, cols, f"SELECT count(*) FROM {table} WHERE {condition}"


@query("SELECT user_id, count(*) AS n_records FROM events GROUP BY ALL HAVING count(*) > 1")
def v01_unique(b: Bed) -> DataFrame:
    return checks.failing_rows(b.events, checks.unique("user_id"))


@query("SELECT service_request_number FROM log WHERE closed_date IS NULL")
def v02_not_null(b: Bed) -> DataFrame:
    return checks.failing_rows(b.log, checks.not_null("closed_date")).select(
        "service_request_number")


@query("SELECT event_id, value FROM events WHERE value < 2 OR value > 40")
def v03_accepted_range(b: Bed) -> DataFrame:
    return checks.failing_rows(b.events, checks.accepted_range("value", 2, 40)).select(
        "event_id", "value")


@query("""SELECT user_id, event_type, count(*) AS n_records FROM events
  GROUP BY ALL HAVING count(*) > 1""")
def v04_unique_combination(b: Bed) -> DataFrame:
    return checks.failing_rows(b.events, checks.unique_combination("user_id", "event_type"))


@query(_suite(
    "log", ("unique", "service_request_number"), ("not_null", "service_request_number"),
    ("not_null", "sr_type"), ("not_null", "current_status"), ("not_null", "owner_department"),
    ("not_null", "created_date"), ("not_null", "last_modified_date"),
    ("not_null", "community_area"), ("not_null", "created_year"), ("not_null", "created_month"),
    ("accepted_range", "created_month", "created_month < 1 OR created_month > 12")))
def v05_source_suite(b: Bed) -> DataFrame:
    return checks.run_suite(b.log, checks.SOURCE)


@query(_suite(
    "fct", ("unique_combination", "service_request_number"), ("unique", "service_request_number"),
    ("not_null", "service_request_number"), ("not_null", "request_type_id"),
    ("not_null", "department_id"), ("not_null", "community_area_id")))
def v05_fact_suite(b: Bed) -> DataFrame:
    return checks.run_suite(b.fct, checks.FACT)


@query(_suite(
    "stg", ("not_null", "closed_date"), ("accepted_range", "ward", "ward < 5 OR ward > 40"),
    ("unique", "ward")))
def v05_failing_suite(b: Bed) -> DataFrame:
    """Failing checks are rows of the result, not errors."""
    return checks.run_suite(b.stg, [checks.not_null("closed_date"),
                                    checks.accepted_range("ward", 5, 40), checks.unique("ward")])


@query("""m AS (SELECT date_trunc('month', closed_date) AS period_month, sr_type,
      owner_department, community_area, count(*) AS total_closed,
      count(*) FILTER (resolution_days > target_days) / count(*) AS breach_rate
    FROM stg LEFT JOIN targets USING (sr_type)
    WHERE current_status = 'Completed' AND NOT duplicate GROUP BY ALL)
  SELECT 'groups' AS what, count(*) AS failures FROM m
  UNION ALL SELECT 'failing checks', CAST(0 AS BIGINT)
  UNION ALL SELECT 'checks', CAST(12 AS BIGINT)""")
def v06_contract(b: Bed) -> DataFrame:
    monthly = rules.monthly_sla(b.stg, b.targets, b.dims.geography,
                                rules.business_day_numbers(b.dims.date))
    result = checks.run_suite(monthly, checks.CONTRACT_MONTHLY)
    tally = result.agg(F.count_if(~F.col("passed")).alias("bad"), F.count(F.lit(1)).alias("n"))
    return tally.select(F.explode(F.array(
        F.struct(F.lit("failing checks").alias("what"), F.col("bad").alias("failures")),
        F.struct(F.lit("checks").alias("what"), F.col("n").alias("failures")),
    )).alias("r")).select("r.*").unionByName(
        monthly.agg(F.lit("groups").alias("what"), F.count(F.lit(1)).alias("failures")))


@query(f"""d AS (SELECT 1) SELECT 'accepted_range' AS check_name, 'community_area' AS checked,
    CAST(sum({AS_OF_SQL} - first_day + 1) AS BIGINT) AS failures, false AS passed
  FROM (SELECT sr_type, min(CAST(created_date AS DATE)) AS first_day FROM stg
        WHERE community_area = 0 AND NOT coalesce(duplicate, false) GROUP BY ALL)""")
def v06_contract_daily(b: Bed) -> DataFrame:
    """Area 0 of the sample lies outside the contract's 1..77; all else must hold."""
    daily = rules.daily_backlog(b.stg, b.targets, b.dims.geography, AS_OF)
    return checks.run_suite(daily, checks.CONTRACT_DAILY).where(~F.col("passed"))


@query("""SELECT max(last_modified_date) AS newest,
    date_diff('second', max(last_modified_date), TIMESTAMP '2001-09-02 06:30:00') // 3600
      AS age_hours,
    TIMESTAMP '2001-09-02 06:30:00' <= max(last_modified_date) + INTERVAL 24 HOUR AS passed
  FROM log""")
def v07_freshness(b: Bed) -> DataFrame:
    return checks.freshness(b.log, "2001-09-02 06:30:00")
