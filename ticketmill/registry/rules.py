"""Documented rules and questions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators import facts, history, rules
from ticketmill.plans import documented, loads
from ticketmill.registry import query
from ticketmill.registry.oracle import AS_OF as AS_OF_SQL
from ticketmill.registry.oracle import key_of
from ticketmill.samples import AS_OF, CATEGORIES, Bed
from ticketmill.sources import table



@query("""SELECT request_type_id, count(*) AS completed
  FROM sla JOIN stg USING (service_request_number) WHERE NOT duplicate GROUP BY ALL""")
def x01_no_duplicates(b: Bed) -> DataFrame:
    sla = facts.fct_sla_performance(rules.without_duplicates(b.stg), b.dims.request_type)
    return sla.groupBy("request_type_id").agg(F.count(F.lit(1)).alias("completed"))


@query("SELECT f.service_request_number, f.status_id, s.duplicate AS is_duplicate "
       "FROM fct f JOIN stg s USING (service_request_number)")
def x01_marked_duplicates(b: Bed) -> DataFrame:
    fct = facts.fct_service_requests(b.stg, b.dims.request_type, mark_duplicates=True)
    return fct.select("service_request_number", "status_id", "is_duplicate")


@query("""SELECT request_type_name, coalesce(sla_target_days, 14) AS sla_target_days,
    CASE WHEN sla_target_days IS NULL THEN 'default' ELSE sla_target_source END
      AS sla_target_source FROM dim_request_type""")
def x02_default_target(b: Bed) -> DataFrame:
    return rules.with_default_target(b.dims.request_type).select(
        "request_type_name", "sla_target_days", "sla_target_source")


@query("""c AS (SELECT date_day,
      CAST(sum(CAST(is_business_day AS BIGINT)) OVER (ORDER BY date_day) AS BIGINT) AS k
    FROM dim_date)
  SELECT s.service_request_number, s.resolution_days, c1.k - c0.k AS business_days
  FROM stg s LEFT JOIN c c0 ON c0.date_day = CAST(s.created_date AS DATE)
  LEFT JOIN c c1 ON c1.date_day = CAST(s.closed_date AS DATE)""")
def x03_business_days(b: Bed) -> DataFrame:
    numbers = rules.business_day_numbers(b.dims.date)
    return rules.with_business_days(b.stg, numbers).select(
        "service_request_number", "resolution_days", "business_days")


@query("""SELECT service_request_number, coalesce(days_open > target_days, false) AS sla_at_risk
  FROM stg LEFT JOIN targets USING (sr_type)""")
def x04_at_risk(b: Bed) -> DataFrame:
    return rules.sla_at_risk(b.stg, b.dims.request_type).select(
        "service_request_number", "sla_at_risk")


@query("""SELECT service_request_number, last_modified_date,
    TIMESTAMP '2002-01-01' AS watermark FROM log""")
def x05_watermark(b: Bed) -> DataFrame:
    """Two incremental loads; the second starts where the first one ended."""
    lake = b.lake()
    for now in (datetime(1998, 3, 1), datetime(2002, 1, 1)):
        loads.incremental_load(b.spark, lake, b.raw, now)
    mark = loads.watermark(b.spark, lake)
    return table.read(b.spark, lake.main).select(
        "service_request_number", "last_modified_date",
        F.lit(mark).cast("timestamp_ntz").alias("watermark"))


@query(f"""t AS (SELECT s.community_area, s.sr_type, s.owner_department,
      CAST(created_date AS DATE) AS c, CAST(closed_date AS DATE) AS x,
      coalesce(target_days, 14) AS target_days
    FROM stg s LEFT JOIN targets USING (sr_type) WHERE NOT coalesce(duplicate, false)),
  p AS (SELECT community_area, sr_type, min(c) AS first_day FROM t GROUP BY ALL),
  n AS (SELECT community_area, sr_type, owner_department, count(*) AS n FROM t GROUP BY ALL),
  busy AS (SELECT community_area, sr_type, owner_department FROM (
      SELECT *, row_number() OVER (PARTITION BY community_area, sr_type
        ORDER BY n DESC, owner_department) AS rn FROM n) WHERE rn = 1),
  g AS (SELECT date_day, p.* FROM spine JOIN p ON date_day BETWEEN first_day AND {AS_OF_SQL}),
  r AS (SELECT g.date_day AS snapshot_date, g.community_area, g.sr_type,
      count(*) FILTER (c <= date_day AND (x IS NULL OR x > date_day)) AS open_requests,
      sum(date_day - c) FILTER (c <= date_day AND (x IS NULL OR x > date_day)) AS ages,
      count(*) FILTER (c <= date_day AND (x IS NULL OR x > date_day)
        AND date_day - c > target_days) AS requests_older_than_sla,
      count(*) FILTER (c = date_day) AS total_created_today
    FROM g JOIN t ON t.community_area = g.community_area AND t.sr_type = g.sr_type
    GROUP BY ALL)
  SELECT snapshot_date, community_area, community_area_name, sr_type, owner_department,
    open_requests, CASE WHEN open_requests > 0 THEN CAST(ages AS DOUBLE) / open_requests END
      AS avg_days_open, requests_older_than_sla, total_created_today
  FROM r JOIN busy USING (community_area, sr_type)
  LEFT JOIN dim_geography ON community_area_id = community_area""")
def x06_daily_backlog(b: Bed) -> DataFrame:
    return rules.daily_backlog(b.stg, b.targets, b.dims.geography, AS_OF)


@query("""c AS (SELECT date_day,
      sum(CAST(is_business_day AS BIGINT)) OVER (ORDER BY date_day) AS k FROM dim_date),
  d AS (SELECT s.*, coalesce(t.target_days, 14) AS target_days, CAST(c1.k - c0.k AS BIGINT) AS business_days,
      CAST(date_trunc('month', closed_date) AS DATE) AS period_month
    FROM stg s LEFT JOIN targets t USING (sr_type)
    LEFT JOIN c c0 ON c0.date_day = CAST(s.created_date AS DATE)
    LEFT JOIN c c1 ON c1.date_day = CAST(s.closed_date AS DATE)
    WHERE current_status = 'Completed' AND NOT duplicate AND closed_date IS NOT NULL),
  cw AS (SELECT period_month, sr_type, avg(resolution_days) AS city_days FROM d GROUP BY ALL),
  m AS (SELECT period_month, sr_type, owner_department, community_area,
      count(*) AS total_closed,
      count(*) FILTER (resolution_days > target_days) AS total_breached,
      avg(resolution_days) AS avg_resolution_days,
      avg(business_days) AS avg_business_days_taken,
      quantile_cont(CAST(resolution_days AS DOUBLE), 0.5) AS median_resolution_days
    FROM d GROUP BY ALL)
  SELECT m.*, community_area_name, total_breached / total_closed AS breach_rate,
    CASE WHEN city_days <> 0 THEN avg_resolution_days / city_days END AS equity_index
  FROM m JOIN cw USING (period_month, sr_type)
  LEFT JOIN dim_geography ON community_area_id = community_area""")
def x07_monthly_sla(b: Bed) -> DataFrame:
    return rules.monthly_sla(b.stg, b.targets, b.dims.geography,
                             rules.business_day_numbers(b.dims.date))


PERIOD = """m AS (SELECT CAST(date_trunc('month', closed_date) AS DATE) AS period_month,
      request_type_id, community_area_id, count(*) AS completed,
      avg(resolution_days) AS area_avg_resolution_days
    FROM sla WHERE closed_date IS NOT NULL GROUP BY ALL),
  c AS (SELECT CAST(date_trunc('month', closed_date) AS DATE) AS period_month, request_type_id,
      avg(resolution_days) AS citywide_avg_resolution_days
    FROM sla WHERE closed_date IS NOT NULL GROUP BY ALL),
  pe AS (SELECT m.*, c.citywide_avg_resolution_days,
      CASE WHEN c.citywide_avg_resolution_days <> 0
           THEN m.area_avg_resolution_days / c.citywide_avg_resolution_days END AS equity_index
    FROM m JOIN c USING (period_month, request_type_id))"""


@query(f"{PERIOD} SELECT * FROM pe")
def x08_period_equity(b: Bed) -> DataFrame:
    return rules.period_equity(b.sla)


#: The SLA fact as documented: no duplicates, default targets, business days.
_DOCUMENTED = """dsla AS (
  SELECT s.service_request_number, KEY_TYPE AS request_type_id, KEY_DEPARTMENT AS department_id,
    s.community_area AS community_area_id, CAST(s.closed_date AS DATE) AS closed_date,
    CAST(s.created_date AS DATE) AS created_date, s.resolution_days,
    coalesce(t.target_days, 14) AS sla_target_days,
    s.resolution_days - coalesce(t.target_days, 14) AS days_over_sla,
    coalesce(s.resolution_days > coalesce(t.target_days, 14), false) AS is_breached,
    CASE WHEN t.target_days IS NULL THEN 'default' ELSE t.sla_target_source END AS sla_target_source,
    CASE WHEN s.closed_date IS NOT NULL THEN (SELECT count(*) FROM dim_date d WHERE d.is_business_day
      AND d.date_day > CAST(s.created_date AS DATE) AND d.date_day <= CAST(s.closed_date AS DATE)) END
      AS business_days
  FROM stg s LEFT JOIN targets t USING (sr_type)
  WHERE s.current_status = 'Completed' AND NOT coalesce(s.duplicate, false))""".replace(
    "KEY_TYPE", key_of("s.sr_type")).replace("KEY_DEPARTMENT", key_of("s.owner_department"))


def _documented(b: Bed) -> DataFrame:
    return documented.sla_fact(b.stg, b.dims)


@query(f"{_DOCUMENTED} SELECT * FROM dsla")
def x03_documented_sla(b: Bed) -> DataFrame:
    return _documented(b).drop("closed_timestamp")


@query("""SELECT s.service_request_number, coalesce(s.duplicate, false) AS is_duplicate,
    coalesce(s.days_open > coalesce(t.target_days, 14), false) AS sla_at_risk
  FROM stg s LEFT JOIN targets t USING (sr_type)""")
def x04_documented_requests(b: Bed) -> DataFrame:
    return documented.request_fact(b.stg, b.dims).select(
        "service_request_number", "is_duplicate", "sla_at_risk")


@query(f"{_DOCUMENTED}, {PERIOD.replace('FROM sla', 'FROM dsla')} SELECT * FROM pe")
def x08_documented_equity(b: Bed) -> DataFrame:
    return rules.period_equity(_documented(b))


@query(f"""{_DOCUMENTED}, m AS (SELECT CAST(date_trunc('month', closed_date) AS DATE) AS period_month,
      count(*) AS completed, count(*) FILTER (NOT is_breached) AS met
    FROM dsla WHERE closed_date IS NOT NULL GROUP BY ALL)
  SELECT m.*, m.met / m.completed AS compliance_rate,
    p.met / p.completed AS prior_compliance_rate,
    m.met / m.completed - p.met / p.completed AS compliance_change
  FROM m LEFT JOIN m p ON p.period_month = m.period_month - INTERVAL 1 MONTH""")
def x10_documented_compliance(b: Bed) -> DataFrame:
    return rules.compliance_by_month(_documented(b))


@query(f"""{_DOCUMENTED} SELECT year(closed_date) AS closed_year, department_name, request_type_name,
    CASE GROUPING(department_name) * 2 + GROUPING(request_type_name)
      WHEN 3 THEN 'year' WHEN 1 THEN 'department' ELSE 'type' END AS audit_level,
    count(*) AS completed, count(*) FILTER (is_breached) AS breached,
    (count(*) - count(*) FILTER (is_breached)) / count(*) AS compliance_rate,
    CAST(sum(resolution_days) AS DOUBLE) / count(*) AS avg_resolution_days
  FROM dsla LEFT JOIN dim_department USING (department_id)
  LEFT JOIN dim_request_type USING (request_type_id) WHERE closed_date IS NOT NULL
  GROUP BY GROUPING SETS ((year(closed_date)), (year(closed_date), department_name),
    (year(closed_date), department_name, request_type_name))""")
def x10_documented_audit(b: Bed) -> DataFrame:
    return rules.annual_audit(_documented(b), b.dims.department, b.dims.request_type)


@query("""SELECT department_name, count(*) FILTER (triage_status = '1 - Overdue') AS overdue
  FROM ops GROUP BY ALL""")
def x09_overdue_by_department(b: Bed) -> DataFrame:
    return rules.overdue_by_department(b.ops)


@query(f"""SELECT request_type_name, count(*) AS completed,
    count(*) FILTER (is_breached) AS breached
  FROM sla LEFT JOIN dim_request_type USING (request_type_id)
  WHERE closed_date BETWEEN CAST(date_trunc('week', {AS_OF_SQL}) AS DATE) AND {AS_OF_SQL}
  GROUP BY ALL""")
def x09_breaches_this_week(b: Bed) -> DataFrame:
    return rules.breaches_this_week(b.sla, b.dims.request_type, AS_OF)


@query("""e AS (SELECT owner_department,
      CAST(date_trunc('week', created_date) AS DATE) AS week_start, 1 AS c, 0 AS x FROM stg
    UNION ALL SELECT owner_department, CAST(date_trunc('week', closed_date) AS DATE), 0, 1
    FROM stg WHERE closed_date IS NOT NULL),
  w AS (SELECT owner_department, week_start, CAST(sum(c) AS BIGINT) AS created,
      CAST(sum(x) AS BIGINT) AS closed FROM e GROUP BY ALL)
  SELECT *, created - closed AS net_change, CAST(sum(created - closed) OVER (
    PARTITION BY owner_department ORDER BY week_start) AS BIGINT) AS backlog FROM w""")
def x09_backlog_change(b: Bed) -> DataFrame:
    return rules.backlog_change(b.stg, ["owner_department"])


@query("""SELECT community_area_name, created_date, service_request_number, days_open,
    open_requests FROM (
      SELECT *, row_number() OVER (PARTITION BY community_area_name
          ORDER BY created_date, service_request_number) AS rn,
        count(*) OVER (PARTITION BY community_area_name) AS open_requests FROM ops)
  WHERE rn = 1""")
def x09_oldest_by_area(b: Bed) -> DataFrame:
    return rules.oldest_by_area(b.ops)


@query("""m AS (SELECT CAST(date_trunc('month', closed_date) AS DATE) AS period_month,
      count(*) AS completed, count(*) FILTER (NOT is_breached) AS met
    FROM sla WHERE sla_target_days IS NOT NULL AND closed_date IS NOT NULL GROUP BY ALL)
  SELECT m.*, m.met / m.completed AS compliance_rate,
    p.met / p.completed AS prior_compliance_rate,
    m.met / m.completed - p.met / p.completed AS compliance_change
  FROM m LEFT JOIN m p ON p.period_month = m.period_month - INTERVAL 1 MONTH""")
def x10_compliance(b: Bed) -> DataFrame:
    return rules.compliance_by_month(b.sla)


@query("""SELECT community_area_name, count(equity_index) AS graded,
    count(*) FILTER (equity_index >= 1.10) AS slow,
    count(*) FILTER (equity_index >= 1.10) / nullif(count(equity_index), 0) AS slow_share
  FROM perf GROUP BY ALL""")
def x10_slow_areas(b: Bed) -> DataFrame:
    return rules.slow_areas(b.perf)


@query(f"""{PERIOD},
  t AS (SELECT period_month, count(equity_index) AS graded,
      count(*) FILTER (equity_index >= 1.10) AS slow,
      count(*) FILTER (equity_index >= 1.10) / nullif(count(equity_index), 0) AS slow_share
    FROM pe GROUP BY ALL)
  SELECT t.*, p.slow_share AS prior_slow_share, t.slow_share - p.slow_share AS slow_share_change
  FROM t LEFT JOIN t p ON p.period_month = t.period_month - INTERVAL 1 MONTH""")
def x10_equity_trend(b: Bed) -> DataFrame:
    return rules.equity_trend(b.sla)


@query("""SELECT year(closed_date) AS closed_year, department_name, request_type_name,
    CASE GROUPING(department_name) * 2 + GROUPING(request_type_name)
      WHEN 3 THEN 'year' WHEN 1 THEN 'department' ELSE 'type' END AS audit_level,
    count(*) AS completed, count(*) FILTER (is_breached) AS breached,
    (count(sla.sla_target_days) - count(*) FILTER (is_breached))
      / nullif(count(sla.sla_target_days), 0)
      AS compliance_rate,
    CAST(sum(resolution_days) AS DOUBLE) / count(*) AS avg_resolution_days
  FROM sla LEFT JOIN dim_department USING (department_id)
  LEFT JOIN dim_request_type USING (request_type_id) WHERE closed_date IS NOT NULL
  GROUP BY GROUPING SETS ((year(closed_date)), (year(closed_date), department_name),
    (year(closed_date), department_name, request_type_name))""")
def x10_annual_audit(b: Bed) -> DataFrame:
    return rules.annual_audit(b.sla, b.dims.department, b.dims.request_type)


@query("""h AS (SELECT user_id, event_type, ts, event_id,
      lag(event_type) OVER w AS before, row_number() OVER w AS rn
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  c AS (SELECT * FROM h WHERE rn = 1 OR before IS DISTINCT FROM event_type)
  SELECT user_id, event_type, ts AS valid_from,
    lead(ts) OVER v AS valid_to, lead(ts) OVER v IS NULL AS is_current
  FROM c WINDOW v AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def x11_history(b: Bed) -> DataFrame:
    """Periods of unchanged state per user, from the change feed."""
    return rules.scd2(b.events, ["user_id"], ["event_type"], "ts", "event_id", bucket="day")


#: Departments under codes, renamed in the course of 1996: both names are in use for two months, the
#: furniture one goes back to its old name in 1997.
_RENAMED = """r AS (SELECT stg.*, CASE
      WHEN owner_department = 'FURNITURE' AND created_date >= TIMESTAMP '1997-05-01' THEN 'Old'
      WHEN created_date >= TIMESTAMP '1996-08-01' THEN 'New'
      WHEN created_date >= TIMESTAMP '1996-06-01'
        AND CAST(substr(service_request_number, 3) AS BIGINT) % 3 = 0 THEN 'New' ELSE 'Old' END AS era
    FROM stg),
  named AS (SELECT * REPLACE (owner_department || ' - ' || era AS owner_department),
      owner_department AS code FROM r),
  daily AS (SELECT code, day, owner_department AS name FROM (
      SELECT *, row_number() OVER (PARTITION BY code, day ORDER BY n DESC, owner_department) AS rn FROM (
        SELECT code, CAST(created_date AS DATE) AS day, owner_department, count(*) AS n
        FROM named GROUP BY ALL)) WHERE rn = 1),
  changed AS (SELECT * FROM (SELECT *, lag(name) OVER (PARTITION BY code ORDER BY day) AS before FROM daily)
    WHERE before IS DISTINCT FROM name),
  seed(raw_department_name, display_name, bureau) AS (
    VALUES ('FURNITURE - New', 'Furnishings', 'Homes'), ('BUILDING - Old', 'Buildings', 'Works')),
  periods AS (SELECT code AS department_code, name AS raw_department_name, day AS valid_from,
      lead(day) OVER (PARTITION BY code ORDER BY day) AS valid_to FROM changed),
  history AS (SELECT KEY AS department_version_id, p.department_code, p.raw_department_name,
      coalesce(seed.display_name, p.raw_department_name) AS department_name, seed.bureau, p.valid_from,
      p.valid_to, p.valid_to IS NULL AS is_current FROM periods p LEFT JOIN seed USING (raw_department_name))
  """.replace("KEY", key_of("p.department_code || '|' || CAST(p.valid_from AS VARCHAR)"))
_RENAMES = [("FURNITURE - New", "Furnishings", "Homes"), ("BUILDING - Old", "Buildings", "Works")]


def _renamed(b: Bed) -> tuple[DataFrame, DataFrame]:
    """The staged tickets under those names, and the department history that they give."""
    created, name = F.col("created_date"), F.col("owner_department")
    third = F.substring(S.KEY, 3, 9).cast("bigint") % 3 == 0
    era = (F.when((name == "FURNITURE") & (created >= "1997-05-01T00:00:00"), "Old")
           .when((created >= "1996-08-01T00:00:00") | ((created >= "1996-06-01T00:00:00") & third), "New")
           .otherwise("Old"))
    named = b.stg.withColumn("owner_department", F.concat_ws(" - ", name, era))
    return named, history.department_history(named, b.rows(_RENAMES, S.DEPARTMENTS_SCHEMA))


@query(f"{_RENAMED} SELECT * FROM history")
def x11_department_history(b: Bed) -> DataFrame:
    return _renamed(b)[1]


@query(f"""{_RENAMED} SELECT n.service_request_number, n.owner_department, n.code AS department_code,
    h.department_version_id, h.department_name, h.bureau
  FROM named n LEFT JOIN history h ON h.department_code = n.code
    AND h.valid_from <= CAST(n.created_date AS DATE)
    AND (h.valid_to IS NULL OR CAST(n.created_date AS DATE) < h.valid_to)""")
def x11_ticket_departments(b: Bed) -> DataFrame:
    """Every ticket with the name its department had when it was created."""
    tickets, versions = _renamed(b)
    return history.with_department_version(tickets, versions).select(
        S.KEY, "owner_department", "department_code", *history.VERSION_COLUMNS)


@query("""SELECT status_id, status_name,
    CASE status_name WHEN 'Completed' THEN 'Resolved' WHEN 'Open' THEN 'Open'
      WHEN 'Completed - Dup' THEN 'Resolved (duplicate)' WHEN 'Open - Dup'
      THEN 'Open (duplicate)' END AS status_label,
    status_name IN ('Completed', 'Completed - Dup') AS is_resolved FROM dim_status""")
def x12_status_labels(b: Bed) -> DataFrame:
    return rules.with_status_labels(b.dims.status)


@query("""SELECT request_type_name, CASE WHEN request_type_name IN ('1-URGENT', '2-HIGH')
    THEN 'Rush' WHEN request_type_name = '3-MEDIUM' THEN 'Routine' ELSE 'Uncategorized' END
    AS category FROM dim_request_type""")
def x13_categories(b: Bed) -> DataFrame:
    seed = b.rows(CATEGORIES, "sr_type string, category string")
    return rules.with_category(b.dims.request_type, seed).select("request_type_name", "category")
