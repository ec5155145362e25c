"""Staging, dimensions, facts and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import geometry, text
from ticketmill.functions.keys import surrogate_key
from ticketmill.operators import dims, facts, marts, staging
from ticketmill.operators.wap import upsert
from ticketmill.plans import build
from ticketmill.registry import query
from ticketmill.registry.oracle import AS_OF as AS_OF_SQL
from ticketmill.registry.oracle import TYPED, key_of
from ticketmill.samples import AS_OF, Bed
from ticketmill.sources import table

# --- staging ---------------------------------------------------------------------------


@query(f"SELECT {TYPED}, days_open, resolution_days FROM stg")
def t01_staging(b: Bed) -> DataFrame:
    return b.stg


@query("""SELECT service_request_number FROM log
  WHERE NOT legacy_record AND n % 89 <> 0""")
def t02_legacy_filter(b: Bed) -> DataFrame:
    n = F.substring(S.KEY, 3, 18).cast("bigint")
    flags = b.log.withColumn("legacy_record", F.when(n % 89 != 0, F.col("legacy_record")))
    return staging.without_legacy(flags).select(S.KEY)


@query(f"""SELECT service_request_number,
    CASE WHEN closed_date IS NULL THEN {AS_OF_SQL} - CAST(created_date AS DATE) END AS days_open
  FROM log""")
def t03_days_open(b: Bed) -> DataFrame:
    return staging.with_durations(b.log, AS_OF).select(S.KEY, "days_open")


@query("""SELECT user_id, event_id,
    CAST(TIMESTAMP '2024-01-15 12:00:00' AS DATE) - CAST(ts AS DATE) AS resolution_days
  FROM events""")
def t04_resolution_days(b: Bed) -> DataFrame:
    """Over event times, so that times of day and negative spans occur."""
    spans = b.events.withColumnRenamed("ts", "created_date").withColumn(
        "closed_date", F.lit("2024-01-15 12:00:00").cast("timestamp_ntz"))
    return staging.with_durations(spans, AS_OF).select("user_id", "event_id", "resolution_days")


@query("SELECT count(*) AS row_count, count(*) AS loaded FROM stg")
def t05_load_time(b: Bed) -> DataFrame:
    return staging.stg_service_requests(b.log, AS_OF, audit_column=True).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("dbt_loaded_at").alias("loaded"))


# --- dimensions ------------------------------------------------------------------------

CALENDAR = ("date_day, date_year, date_month, month_name, day_of_month, day_of_week_num, "
            "day_of_week_name, date_quarter, day_of_year")


@query("SELECT date_day FROM spine")
def d01_date_spine(b: Bed) -> DataFrame:
    return dims.date_spine(b.bounds)


@query("""days AS (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2026-12-31', INTERVAL 1 DAY))
      AS DATE) AS d),
  parts AS (SELECT d, month(d) AS m, day(d) AS n, isodow(d) AS w FROM days),
  holidays AS (SELECT d AS holiday_date FROM parts WHERE (m, n) IN ((1, 1), (2, 12), (6, 19), (11, 11), (12, 25))
    OR (m = 7 AND ((n = 4 AND w <> 6) OR (n = 3 AND w = 5)))
    OR (w = 1 AND ((m IN (1, 2) AND n BETWEEN 15 AND 21) OR (m IN (3, 9) AND n <= 7)
      OR (m = 5 AND n >= 25) OR (m = 10 AND n BETWEEN 8 AND 14)))
    OR (m = 11 AND ((w = 2 AND n BETWEEN 2 AND 8 AND year(d) % 2 = 0)
      OR (w = 4 AND n BETWEEN 22 AND 28) OR (w = 5 AND n BETWEEN 23 AND 29))))
  SELECT holiday_date, count(n) AS tickets FROM holidays
  LEFT JOIN log ON CAST(created_date + INTERVAL 32 YEAR AS DATE) = holiday_date GROUP BY ALL""")
def d02_holidays(b: Bed) -> DataFrame:
    """Tickets per state holiday, those of 32 years before standing for the calendar's years;
    tickets are counted per day before the lookup."""
    day = F.to_date(F.col("created_date") + F.expr("interval 32 years")).alias("holiday_date")
    per_day = b.log.groupBy(day).agg(F.count(F.lit(1)).alias("tickets"))
    return dims.holidays(b.spark).join(per_day, "holiday_date", "left").select(
        "holiday_date", F.coalesce("tickets", F.lit(0)).alias("tickets"))


@query(f"SELECT {CALENDAR} FROM dim_date")
def d03_calendar(b: Bed) -> DataFrame:
    return dims.calendar_attributes(dims.date_spine(b.bounds))


@query("SELECT date_day, is_weekend FROM dim_date")
def d04_weekend(b: Bed) -> DataFrame:
    return dims.with_weekend(dims.date_spine(b.bounds))


@query("SELECT date_day, is_illinois_holiday FROM dim_date")
def d05_holiday_flag(b: Bed) -> DataFrame:
    return dims.with_holiday(dims.date_spine(b.bounds), b.holidays)


@query(f"SELECT {CALENDAR}, is_weekend, is_illinois_holiday, is_business_day FROM dim_date")
def d06_dim_date(b: Bed) -> DataFrame:
    return dims.dim_date(b.bounds, b.holidays)


@query("SELECT DISTINCT owner_department FROM stg WHERE owner_department IS NOT NULL")
def d07_distinct_departments(b: Bed) -> DataFrame:
    return dims.distinct_departments(b.stg)


@query(f"""SELECT DISTINCT street_name, {key_of('street_name')} AS street_id
  FROM (SELECT CASE WHEN n % 10 <> 0 THEN sr_type || n % 1000 END AS street_name FROM log)""")
def d08_surrogate_key(b: Bed) -> DataFrame:
    n = F.substring(S.KEY, 3, 18).cast("bigint")
    name = F.when(n % 10 != 0, F.concat("sr_type", (n % 1000).cast("string")))
    names = b.log.select(name.alias("street_name")).distinct()
    return names.withColumn("street_id", surrogate_key(F.col("street_name")))


@query("SELECT department_id, raw_department_name, department_name, bureau FROM dim_department")
def d09_dim_department(b: Bed) -> DataFrame:
    return dims.dim_department(b.stg, b.seeds.department_metadata)


@query("""SELECT request_type_id, request_type_name, sr_short_code, sla_target_days,
    priority_level, sla_target_source FROM dim_request_type""")
def d10_dim_request_type(b: Bed) -> DataFrame:
    return dims.dim_request_type(b.stg, b.targets)


@query(f"""SELECT {key_of('s.sr_type')} AS request_type_id, s.sr_type AS request_type_name,
    s.sr_short_code, t.target_days AS sla_target_days, t.priority AS priority_level,
    t.sla_target_source
  FROM (SELECT DISTINCT sr_type, owner_department AS sr_short_code FROM stg) s
  LEFT JOIN targets t USING (sr_type)""")
def d10_request_type_pairs(b: Bed) -> DataFrame:
    coded = b.stg.withColumn("sr_short_code", F.col("owner_department"))
    return dims.dim_request_type(coded, b.targets, by_code=True)


@query("SELECT status_id, status_name FROM dim_status")
def d11_dim_status(b: Bed) -> DataFrame:
    return dims.dim_status(b.stg)


@query("""SELECT community_area_id, community_area_name, city_side, shape_area, shape_length
  FROM dim_geography""")
def d12_dim_geography(b: Bed) -> DataFrame:
    return dims.dim_geography(b.areas).drop("area_boundary")


@query("""SELECT o_orderkey, CAST(CAST(o_totalprice AS BIGINT) AS DOUBLE) AS amount
  FROM orders""")
def d13_thousands_commas(b: Bed) -> DataFrame:
    # half-to-even, as the SQL cast rounds
    written = F.format_number(F.bround("o_totalprice", 0), 0)
    return b.orders.select("o_orderkey", text.number_with_commas(written).alias("amount"))


@query("""SELECT n_nationkey AS area, 1 AS polygons, 5 AS points,
    CAST(n_nationkey AS DOUBLE) AS west, CAST(n_nationkey + 1 AS DOUBLE) AS east,
    0.0::DOUBLE AS south, 1.0::DOUBLE AS north FROM nation""")
def d14_boundaries(b: Bed) -> DataFrame:
    shape = geometry.multipolygon(F.col("the_geom"))
    flat = b.areas.select(F.col("area_number").cast("int").alias("area"),
                          F.size(shape).alias("polygons"), geometry.points(shape).alias("p"))
    lon, lat = F.col("p.lon"), F.col("p.lat")
    return flat.select("area", "polygons", F.size("p").alias("points"),
                       F.array_min(lon).alias("west"), F.array_max(lon).alias("east"),
                       F.array_min(lat).alias("south"), F.array_max(lat).alias("north"))


@query("SELECT count(*) AS row_count, count(*) AS stamped FROM dim_status")
def d15_rebuild_time(b: Bed) -> DataFrame:
    return dims.with_rebuild_time(dims.dim_status(b.stg)).agg(
        F.count(F.lit(1)).alias("row_count"), F.count("dbt_updated_at").alias("stamped"))


# --- facts -----------------------------------------------------------------------------

FCT = ("service_request_number, request_type_id, department_id, community_area_id, status_id, "
       "created_date, closed_date, created_timestamp, closed_timestamp, last_modified_date, "
       "latitude, longitude, ward, resolution_days, is_sla_met, is_sla_breached")
SLA = ("service_request_number, request_type_id, department_id, community_area_id, closed_date, "
       "closed_timestamp, created_date, resolution_days, sla_target_days, days_over_sla, "
       "is_breached")


@query(f"SELECT {FCT} FROM fct")
def f01_fact(b: Bed) -> DataFrame:
    return b.fct


@query("SELECT event_id, CAST(ts AS DATE) AS created_date FROM events")
def f02_date_keys(b: Bed) -> DataFrame:
    return b.events.select("event_id", F.to_date("ts").alias("created_date"))


@query("""SELECT event_id, ts FROM events
  WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR""")
def f03_modified_slice(b: Bed) -> DataFrame:
    changes = b.events.select("event_id", F.col("ts").alias("last_modified_date"))
    return facts.modified_slice(changes, changes).withColumnRenamed("last_modified_date", "ts")


@query(f"""SELECT s.service_request_number, {key_of('s.sr_type')} AS request_type_id,
    t.target_days AS sla_target_days FROM stg s LEFT JOIN targets t USING (sr_type)""")
def f04_target_join(b: Bed) -> DataFrame:
    return facts.with_target(b.stg, b.dims.request_type).select(
        S.KEY, "request_type_id", "sla_target_days")


@query("SELECT is_sla_met, count(*) AS tickets FROM fct GROUP BY ALL")
def f05_sla_met(b: Bed) -> DataFrame:
    return b.fct.groupBy("is_sla_met").agg(F.count(F.lit(1)).alias("tickets"))


@query("SELECT is_sla_breached, count(*) AS tickets FROM fct GROUP BY ALL")
def f06_sla_breached(b: Bed) -> DataFrame:
    return b.fct.groupBy("is_sla_breached").agg(F.count(F.lit(1)).alias("tickets"))


@query(f"""SELECT {FCT} FROM fct WHERE last_modified_date < TIMESTAMP '1999-07-01'
  UNION ALL SELECT {FCT} FROM fct WHERE last_modified_date >= TIMESTAMP '1999-07-01'""")
def f07_incremental_fact(b: Bed) -> DataFrame:
    """A fact stored in mid-1999, then brought up to date; equals a full build."""
    path = b.scratch("fct")
    earlier = b.stg.where("last_modified_date < '1999-07-01'")
    for tickets in (earlier, b.stg):
        build.refresh_fact(b.spark, path, "fct_service_requests", tickets, b.dims)
    return table.read(b.spark, path)


@query("SELECT service_request_number, closed_date FROM stg WHERE current_status = 'Completed'")
def f08_completed_only(b: Bed) -> DataFrame:
    return facts.completed(b.stg).select(S.KEY, "closed_date")


@query("""SELECT service_request_number, closed_date FROM stg
  WHERE CAST(closed_date AS DATE) >= (SELECT max(closed_date) FROM sla
    WHERE closed_date < DATE '2000-01-01')""")
def f09_closed_slice(b: Bed) -> DataFrame:
    stored = b.sla.where("closed_date < '2000-01-01'")
    return facts.closed_slice(b.stg, stored).select(S.KEY, "closed_date")


@query("SELECT service_request_number, resolution_days, sla_target_days, days_over_sla FROM sla")
def f10_days_over(b: Bed) -> DataFrame:
    return b.sla.select(S.KEY, "resolution_days", "sla_target_days", "days_over_sla")


@query("SELECT request_type_id, is_breached, count(*) AS tickets FROM sla GROUP BY ALL")
def f11_breached(b: Bed) -> DataFrame:
    return b.sla.groupBy("request_type_id", "is_breached").agg(F.count(F.lit(1)).alias("tickets"))


@query(f"SELECT {SLA} FROM sla")
def f12_incremental_sla(b: Bed) -> DataFrame:
    """The SLA fact stored at the end of 1999, then brought up to date."""
    path = b.scratch("sla")
    earlier = b.stg.where("closed_date < '2000-01-01'")
    for tickets in (earlier, b.stg):
        build.refresh_fact(b.spark, path, "fct_sla_performance", tickets, b.dims)
    return table.read(b.spark, path)


@query("""SELECT coalesce(s.state_key, t.state_key) AS state_key,
    CASE WHEN s.state_key IS NULL THEN t.event_id ELSE s.event_id END AS event_id,
    CASE WHEN s.state_key IS NULL THEN t.ts ELSE s.ts END AS ts
  FROM feed_target t FULL JOIN feed_source s ON t.state_key = s.state_key""")
def f12_upsert(b: Bed) -> DataFrame:
    return upsert(b.feed_target(), b.feed_source(), "state_key").select(
        "state_key", "event_id", "ts")


@query(f"SELECT {SLA} FROM sla")
def f13_sla_fact(b: Bed) -> DataFrame:
    return b.sla


# --- marts -----------------------------------------------------------------------------

OPS = ("service_request_number, created_date, last_modified_date, community_area_name, ward, "
       "latitude, longitude, department_name, bureau, request_type_name, priority_level, "
       "sla_target_days, status_name, days_open, days_until_breach, triage_status")


@query("SELECT service_request_number, created_date FROM fct WHERE closed_timestamp IS NULL")
def m01_open_backlog(b: Bed) -> DataFrame:
    return marts.open_backlog(b.fct).select(S.KEY, "created_date")


@query("""SELECT f.service_request_number, g.community_area_name, d.department_name, d.bureau,
    r.request_type_name, r.priority_level, st.status_name
  FROM fct f LEFT JOIN dim_geography g USING (community_area_id)
  LEFT JOIN dim_request_type r USING (request_type_id)
  LEFT JOIN dim_department d USING (department_id) LEFT JOIN dim_status st USING (status_id)""")
def m02_enrichment(b: Bed) -> DataFrame:
    d = b.dims
    return marts.enriched(b.fct, d.geography, d.request_type, d.department, d.status).select(
        S.KEY, "community_area_name", "department_name", "bureau", "request_type_name",
        "priority_level", "status_name")


@query("SELECT service_request_number, days_open FROM ops")
def m03_days_open(b: Bed) -> DataFrame:
    return b.ops.select(S.KEY, "days_open")


@query("SELECT service_request_number, sla_target_days, days_until_breach FROM ops")
def m04_days_until_breach(b: Bed) -> DataFrame:
    return b.ops.select(S.KEY, "sla_target_days", "days_until_breach")


@query(f"SELECT {OPS} FROM ops")
def m05_mart_operational(b: Bed) -> DataFrame:
    return b.ops


@query("""SELECT request_type_id, citywide_avg_resolution_days, citywide_total_requests
  FROM city WHERE request_type_id IS NOT NULL""")
def m06_citywide(b: Bed) -> DataFrame:
    """The baseline that every row of the equity mart of a type carries."""
    return marts.equity(b.sla, min_requests=0).select(
        "request_type_id", "citywide_avg_resolution_days", "citywide_total_requests").distinct()


@query("""SELECT community_area_id, request_type_id, department_id, area_avg_resolution_days,
    area_total_requests, area_breached_requests FROM area""")
def m07_area(b: Bed) -> DataFrame:
    return marts.area_performance(b.sla).drop("days_total", "days_known")


@query("""SELECT a.community_area_id, a.request_type_id, a.department_id, a.area_total_requests,
    c.citywide_avg_resolution_days, c.citywide_total_requests
  FROM area a JOIN city c USING (request_type_id)""")
def m08_area_to_city(b: Bed) -> DataFrame:
    return marts.equity(b.sla, min_requests=0).select(
        "community_area_id", "request_type_id", "department_id", "area_total_requests",
        "citywide_avg_resolution_days", "citywide_total_requests")


@query("SELECT community_area_id, request_type_id, department_id, area_breach_rate FROM eq")
def m09_breach_rate(b: Bed) -> DataFrame:
    return marts.equity(b.sla).select(
        "community_area_id", "request_type_id", "department_id", "area_breach_rate")


@query("""SELECT community_area_id, request_type_id, department_id,
    exact_index AS equity_index FROM eq""")
def m10_equity_index(b: Bed) -> DataFrame:
    return marts.equity(b.sla).select(
        "community_area_id", "request_type_id", "department_id", "equity_index")


@query("""SELECT community_area_id, request_type_id, department_id, area_total_requests
  FROM area WHERE area_total_requests >= 14 AND request_type_id IS NOT NULL""")
def m11_enough_tickets(b: Bed) -> DataFrame:
    return marts.equity(b.sla, min_requests=14).select(
        "community_area_id", "request_type_id", "department_id", "area_total_requests")


@query("SELECT equity_status, count(*) AS groups FROM perf GROUP BY ALL")
def m12_equity_status(b: Bed) -> DataFrame:
    return b.perf.groupBy("equity_status").agg(F.count(F.lit(1)).alias("groups"))


@query("""SELECT community_area_name, city_side, request_type_name, priority_level,
    department_name, bureau, area_total_requests, area_breached_requests, area_breach_rate,
    area_avg_resolution_days, citywide_avg_resolution_days, equity_index, equity_status
  FROM perf""")
def m13_mart_sla(b: Bed) -> DataFrame:
    return b.perf
