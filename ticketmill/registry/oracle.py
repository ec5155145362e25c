"""The models restated as SQL common tables over the given tables."""

from __future__ import annotations

AS_OF = "DATE '2001-08-02'"


def key_of(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"


def _triage(left: str) -> str:
    return (f"CASE WHEN {left} < 0 THEN '1 - Overdue' WHEN {left} = 0 THEN '2 - Due Today' "
            f"WHEN {left} <= 2 THEN '3 - At Risk' ELSE '4 - On Track' END")


MODELS = f"""
log0 AS (
  SELECT o.*, c.c_mktsegment, c.c_nationkey,
    CASE WHEN o_orderstatus = 'F' OR (o_orderstatus = 'P' AND o_orderkey % 2 = 0)
         THEN CAST(CAST(o_orderdate AS DATE) + CAST((o_orderkey * 7) % 31 AS INTEGER) AS TIMESTAMP)
    END AS closed
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
log AS (
  SELECT printf('SR%09d', o_orderkey) AS service_request_number,
    CAST(o_orderdate AS TIMESTAMP) AS created_date, closed AS closed_date,
    o_orderpriority AS sr_type, substr(o_orderpriority, 1, 1) AS sr_short_code,
    CASE WHEN o_orderstatus = 'F' THEN 'Completed' WHEN o_orderstatus = 'O' THEN 'Open'
         WHEN o_orderkey % 2 = 0 THEN 'Completed - Dup' ELSE 'Open - Dup' END AS current_status,
    CAST(NULL AS VARCHAR) AS origin, c_mktsegment AS owner_department,
    CAST(NULL AS VARCHAR) AS created_department, CAST(NULL AS VARCHAR) AS street_address,
    CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS street_number,
    CAST(NULL AS VARCHAR) AS street_direction, CAST(NULL AS VARCHAR) AS street_name,
    CAST(NULL AS VARCHAR) AS street_type, CAST(c_nationkey AS BIGINT) AS community_area,
    o_custkey % 50 + 1 AS ward, CAST(NULL AS VARCHAR) AS police_sector,
    CAST(NULL AS VARCHAR) AS police_district, CAST(NULL AS VARCHAR) AS police_beat,
    CAST(NULL AS VARCHAR) AS precinct, year(o_orderdate) AS created_year,
    month(o_orderdate) AS created_month, CAST(NULL AS BIGINT) AS created_hour,
    isodow(o_orderdate) AS created_day_of_week, CAST(NULL AS DOUBLE) AS x_coordinate,
    CAST(NULL AS DOUBLE) AS y_coordinate, CAST(NULL AS DOUBLE) AS latitude,
    CAST(NULL AS DOUBLE) AS longitude, o_orderstatus = 'P' AS duplicate,
    o_orderkey % 97 = 0 AS legacy_record, CAST(NULL AS VARCHAR) AS electrical_district,
    CAST(NULL AS VARCHAR) AS electricity_grid, CAST(NULL AS VARCHAR) AS parent_sr_number,
    coalesce(closed, CAST(o_orderdate AS TIMESTAMP)) AS last_modified_date,
    o_orderkey AS n
  FROM log0),
feed AS (
  SELECT log.*, false AS keyless FROM log
  UNION ALL SELECT log.*, true FROM log WHERE n % 101 = 0),
stg AS (
  SELECT * EXCLUDE (n),
    CASE WHEN closed_date IS NULL
         THEN {AS_OF} - CAST(created_date AS DATE) END AS days_open,
    CASE WHEN closed_date IS NOT NULL
         THEN CAST(closed_date AS DATE) - CAST(created_date AS DATE) END AS resolution_days
  FROM log WHERE NOT legacy_record),
targets(sr_type, target_days, priority, sla_target_source) AS (
  VALUES ('1-URGENT', CAST(1 AS BIGINT), 'Critical', 'sample'),
         ('2-HIGH', 7, 'High', 'sample'), ('3-MEDIUM', 14, 'Medium', 'sample'),
         ('5-LOW', 30, 'Low', 'sample')),
departments(owner_department, display_name, bureau) AS (
  VALUES ('AUTOMOBILE', 'Automobile', 'Vehicles'), ('BUILDING', 'Building', 'Works'),
         ('FURNITURE', 'Furniture', 'Works'), ('HOUSEHOLD', 'Household', 'Homes')),
spine AS (
  SELECT CAST(unnest(generate_series(
      (SELECT date_trunc('year', min(created_date)) FROM log),
      (SELECT date_trunc('year', max(last_modified_date)) FROM log)
        + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS date_day),
dim_date AS (
  SELECT date_day, year(date_day) AS date_year, month(date_day) AS date_month,
    monthname(date_day) AS month_name, day(date_day) AS day_of_month,
    dayofweek(date_day) + 1 AS day_of_week_num, dayname(date_day) AS day_of_week_name,
    quarter(date_day) AS date_quarter, dayofyear(date_day) AS day_of_year,
    isodow(date_day) >= 6 AS is_weekend,
    strftime(date_day, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_illinois_holiday,
    isodow(date_day) < 6 AND strftime(date_day, '%m-%d') NOT IN ('01-01', '07-04', '12-25')
      AS is_business_day
  FROM spine),
dim_department AS (
  SELECT {key_of('s.owner_department')} AS department_id,
    s.owner_department AS raw_department_name,
    coalesce(d.display_name, s.owner_department) AS department_name, d.bureau
  FROM (SELECT DISTINCT owner_department FROM stg WHERE owner_department IS NOT NULL) s
  LEFT JOIN departments d USING (owner_department)),
dim_request_type AS (
  SELECT {key_of('s.sr_type')} AS request_type_id, s.sr_type AS request_type_name,
    s.sr_short_code, t.target_days AS sla_target_days, t.priority AS priority_level,
    t.sla_target_source
  FROM (SELECT sr_type, min(sr_short_code) AS sr_short_code FROM stg
        WHERE sr_type IS NOT NULL GROUP BY sr_type) s
  LEFT JOIN targets t USING (sr_type)),
dim_status AS (
  SELECT DISTINCT {key_of('current_status')} AS status_id, current_status AS status_name
  FROM stg WHERE current_status IS NOT NULL),
dim_geography AS (
  SELECT CAST(n_nationkey AS BIGINT) AS community_area_id, n_name AS community_area_name,
    r_name AS city_side, n_nationkey * 1000 + 1000.5::DOUBLE AS shape_area,
    CAST(n_nationkey * 100 + 4 AS DOUBLE) AS shape_length
  FROM nation JOIN region ON n_regionkey = r_regionkey),
fct AS (
  SELECT s.service_request_number, {key_of('s.sr_type')} AS request_type_id,
    {key_of('s.owner_department')} AS department_id, s.community_area AS community_area_id,
    {key_of('s.current_status')} AS status_id, CAST(s.created_date AS DATE) AS created_date,
    CAST(s.closed_date AS DATE) AS closed_date, s.created_date AS created_timestamp,
    s.closed_date AS closed_timestamp, s.last_modified_date, s.latitude, s.longitude, s.ward,
    s.resolution_days,
    CASE WHEN s.current_status = 'Completed' AND s.resolution_days <= t.target_days THEN true
         WHEN s.current_status = 'Completed' AND s.resolution_days > t.target_days THEN false
    END AS is_sla_met,
    coalesce(s.current_status = 'Completed' AND s.resolution_days > t.target_days, false)
      AS is_sla_breached
  FROM stg s LEFT JOIN targets t USING (sr_type)),
sla AS (
  SELECT s.service_request_number, {key_of('s.sr_type')} AS request_type_id,
    {key_of('s.owner_department')} AS department_id, s.community_area AS community_area_id,
    CAST(s.closed_date AS DATE) AS closed_date, s.closed_date AS closed_timestamp,
    CAST(s.created_date AS DATE) AS created_date, s.resolution_days,
    t.target_days AS sla_target_days, s.resolution_days - t.target_days AS days_over_sla,
    coalesce(s.resolution_days > t.target_days, false) AS is_breached
  FROM stg s LEFT JOIN targets t USING (sr_type) WHERE s.current_status = 'Completed'),
ops0 AS (
  SELECT f.service_request_number, f.created_date, f.last_modified_date,
    g.community_area_name, f.ward, f.latitude, f.longitude, d.department_name, d.bureau,
    r.request_type_name, r.priority_level, r.sla_target_days, st.status_name,
    {AS_OF} - f.created_date AS days_open
  FROM fct f LEFT JOIN dim_geography g USING (community_area_id)
  LEFT JOIN dim_request_type r USING (request_type_id)
  LEFT JOIN dim_department d USING (department_id) LEFT JOIN dim_status st USING (status_id)
  WHERE f.closed_timestamp IS NULL),
ops AS (
  SELECT *, sla_target_days - days_open AS days_until_breach,
    {_triage('(sla_target_days - days_open)')} AS triage_status
  FROM ops0),
area AS (
  SELECT community_area_id, request_type_id, department_id,
    avg(resolution_days) AS area_avg_resolution_days, count(*) AS area_total_requests,
    CAST(sum(CASE WHEN is_breached THEN 1 ELSE 0 END) AS BIGINT) AS area_breached_requests
  FROM sla GROUP BY ALL),
city AS (
  SELECT request_type_id, avg(resolution_days) AS citywide_avg_resolution_days,
    count(*) AS citywide_total_requests
  FROM sla GROUP BY ALL),
eq AS (
  SELECT a.*, c.citywide_avg_resolution_days, c.citywide_total_requests,
    a.area_breached_requests / a.area_total_requests AS area_breach_rate,
    CASE WHEN c.citywide_avg_resolution_days <> 0
         THEN a.area_avg_resolution_days / c.citywide_avg_resolution_days END AS exact_index
  FROM area a JOIN city c USING (request_type_id) WHERE a.area_total_requests >= 10),
perf AS (
  SELECT g.community_area_name, g.city_side, r.request_type_name, r.priority_level,
    d.department_name, d.bureau, e.area_total_requests, e.area_breached_requests,
    e.area_breach_rate, e.area_avg_resolution_days, e.citywide_avg_resolution_days,
    round(e.exact_index, 2) AS equity_index,
    CASE WHEN exact_index >= 1.25 THEN 'Severely Underserved (25%+ Slower)'
         WHEN exact_index >= 1.10 THEN 'Underserved (10-24% Slower)'
         WHEN exact_index <= 0.90 THEN 'Over-served (Faster than Average)'
         ELSE 'Equitable (Average)' END AS equity_status
  FROM eq e LEFT JOIN dim_geography g USING (community_area_id)
  LEFT JOIN dim_request_type r USING (request_type_id)
  LEFT JOIN dim_department d USING (department_id)),
states AS (
  SELECT *, user_id || '/' || strftime(ts, '%Y-%m-%d') AS state_key FROM events),
feed_target AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY state_key ORDER BY ts DESC, event_id DESC) AS rn
    FROM states WHERE ts < TIMESTAMP '2024-01-20 12:00:00') WHERE rn = 1),
feed_source AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY state_key ORDER BY ts DESC, event_id DESC) AS rn
    FROM states WHERE ts >= TIMESTAMP '2024-01-20') WHERE rn = 1),
feed_merged AS (
  SELECT coalesce(t.state_key, s.state_key) AS state_key,
    CASE WHEN t.state_key IS NULL THEN s.user_id ELSE t.user_id END AS user_id,
    CASE WHEN t.state_key IS NULL THEN s.event_id ELSE t.event_id END AS event_id,
    CASE WHEN t.state_key IS NULL OR s.ts > t.ts THEN s.ts ELSE t.ts END AS ts,
    CASE WHEN t.state_key IS NULL OR s.ts > t.ts THEN s.event_type ELSE t.event_type END
      AS event_type,
    CASE WHEN t.state_key IS NULL THEN s.value ELSE t.value END AS value,
    CASE WHEN t.state_key IS NULL THEN s.props ELSE t.props END AS props,
    CASE WHEN t.state_key IS NULL THEN 'insert' WHEN s.ts > t.ts THEN 'update' ELSE 'keep' END
      AS action
  FROM feed_target t FULL JOIN feed_source s ON t.state_key = s.state_key)
"""

TYPED = (
    "service_request_number, created_date, closed_date, sr_type, sr_short_code, current_status, "
    "origin, owner_department, created_department, street_address, zip_code, street_number, "
    "street_direction, street_name, street_type, community_area, ward, police_sector, "
    "police_district, police_beat, precinct, created_year, created_month, created_hour, "
    "created_day_of_week, x_coordinate, y_coordinate, latitude, longitude, duplicate, "
    "legacy_record, electrical_district, electricity_grid, parent_sr_number, last_modified_date"
)


def with_models(body: str) -> str:
    """``body`` is a select, or further common tables followed by one."""
    body = body.strip()
    joint = "," if not body.upper().startswith("SELECT") else ""
    return f"WITH {MODELS.strip()}{joint}\n{body}"
