"""Dashboard frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.operators import equity_board as equity
from ticketmill.operators import operations_board as board
from ticketmill.registry import query
from ticketmill.samples import Bed

AGE = ("CASE WHEN days_open <= 3 THEN '0-3 days' WHEN days_open <= 7 THEN '4-7 days' "
       "WHEN days_open <= 14 THEN '8-14 days' ELSE '15+ days' END")
KPIS = """count(*) FILTER (triage_status = '1 - Overdue') AS overdue,
    count(*) FILTER (triage_status = '2 - Due Today') AS due_today,
    count(*) FILTER (triage_status = '3 - At Risk') AS at_risk"""
PCT = "round(CAST(sum(area_breached_requests) AS DOUBLE) * 100 / sum(area_total_requests), 1)"


@query("""SELECT 'operations' AS board, count(*) AS row_count FROM ops
    WHERE department_name = 'Building' AND priority_level = 'High'
  UNION ALL SELECT 'operations, all', count(*) FROM ops
  UNION ALL SELECT 'equity', count(*) FROM perf
    WHERE equity_status = 'Underserved (10-24% Slower)'""")
def q01_choices(b: Bed) -> DataFrame:
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(name).alias("board"), F.count(F.lit(1)).alias("row_count"))

    some = board.choose(b.ops, department_name="Building", priority_level="High")
    everything = board.choose(b.ops, department_name="All", priority_level="All")
    slow = board.choose(b.perf, department_name="All",
                        equity_status="Underserved (10-24% Slower)")
    return counted("operations", some).unionByName(
        counted("operations, all", everything)).unionByName(counted("equity", slow))


@query(f"""SELECT service_request_number, created_date, community_area_name, department_name,
    request_type_name, priority_level, days_open, days_until_breach, triage_status,
    {AGE} AS age_bucket FROM ops""")
def q02_age_bucket(b: Bed) -> DataFrame:
    return board.board_frame(b.ops)


@query(f"SELECT count(*) AS total_open, {KPIS} FROM ops")
def q03_operations_kpis(b: Bed) -> DataFrame:
    return board.kpis(b.ops)


@query("""SELECT priority_level, count(*) AS ticket_count,
    round(avg(days_open), 1) AS avg_days_open FROM ops GROUP BY ALL
  ORDER BY priority_level NULLS FIRST""")
def q04_by_priority(b: Bed) -> DataFrame:
    return board.by_priority(b.ops)


@query(f"""SELECT {AGE} AS age_bucket, count(*) AS ticket_count FROM ops GROUP BY ALL
  ORDER BY age_bucket""")
def q05_by_age(b: Bed) -> DataFrame:
    return board.by_age(board.board_frame(b.ops))


@query("""SELECT department_name,
    count(*) FILTER (triage_status = '1 - Overdue') AS "1 - Overdue",
    count(*) FILTER (triage_status = '2 - Due Today') AS "2 - Due Today",
    count(*) FILTER (triage_status = '3 - At Risk') AS "3 - At Risk",
    count(*) FILTER (triage_status = '4 - On Track') AS "4 - On Track"
  FROM ops GROUP BY ALL""")
def q06_triage_pivot(b: Bed) -> DataFrame:
    return board.triage_pivot(b.ops)


@query("""SELECT service_request_number, created_date, request_type_name, department_name,
    days_open, triage_status FROM ops
  ORDER BY days_open DESC NULLS FIRST, service_request_number LIMIT 200""")
def q07_oldest_open(b: Bed) -> DataFrame:
    return board.oldest_open(b.ops)


@query("SELECT DISTINCT department_name FROM ops WHERE department_name IS NOT NULL")
def q08_department_choices(b: Bed) -> DataFrame:
    return board.department_choices(b.ops)


@query("""SELECT community_area_name, request_type_name, department_name, equity_index,
    CASE WHEN equity_index >= 1.25 THEN 'Severely Underserved'
         WHEN equity_index >= 1.10 THEN 'Underserved'
         WHEN equity_index <= 0.90 THEN 'Over-served' ELSE 'Equitable' END AS equity_bucket
  FROM perf""")
def q09_equity_bucket(b: Bed) -> DataFrame:
    return equity.board_frame(b.perf).select(
        "community_area_name", "request_type_name", "department_name", "equity_index",
        "equity_bucket")


@query("""SELECT count(*) AS total_areas, round(avg(area_breach_rate), 6) AS avg_breach_rate,
    count(*) FILTER (equity_status = 'Severely Underserved (25%+ Slower)')
      AS severely_underserved,
    round(avg(area_avg_resolution_days), 6) AS avg_resolution_days FROM perf""")
def q10_equity_kpis(b: Bed) -> DataFrame:
    return equity.kpis(b.perf).withColumns({
        c: F.round(c, 6) for c in ("avg_breach_rate", "avg_resolution_days")})


@query("""SELECT equity_status, CAST(sum(area_total_requests) AS BIGINT) AS total_requests
  FROM perf GROUP BY ALL""")
def q11_requests_by_equity(b: Bed) -> DataFrame:
    return equity.requests_by_equity(b.perf)


TIES = """community_area_name NULLS FIRST, request_type_name NULLS FIRST,
    department_name NULLS FIRST"""


@query(f"""SELECT community_area_name, area_breach_rate FROM perf
  ORDER BY area_breach_rate DESC NULLS FIRST, {TIES} LIMIT 10""")
def q12_top_breach(b: Bed) -> DataFrame:
    return equity.top_breach(b.perf)


@query("""SELECT department_name, CAST(sum(area_breached_requests) AS BIGINT) AS breached,
    CAST(sum(area_total_requests) AS BIGINT) AS total,
    CAST(sum(area_breached_requests) AS DOUBLE) / sum(area_total_requests) AS breach_rate
  FROM perf GROUP BY ALL""")
def q13_department_breach(b: Bed) -> DataFrame:
    return equity.department_breach(b.perf)


@query(f"""SELECT community_area_name, area_avg_resolution_days, citywide_avg_resolution_days
  FROM perf ORDER BY area_avg_resolution_days DESC NULLS FIRST, {TIES} LIMIT 20""")
def q14_slowest(b: Bed) -> DataFrame:
    return equity.slowest(b.perf)


@query(f"""SELECT community_area_name, city_side, request_type_name, department_name,
    area_total_requests, area_breach_rate, area_avg_resolution_days, equity_index, equity_status
  FROM perf ORDER BY area_breach_rate DESC NULLS FIRST, {TIES} LIMIT 200""")
def q15_equity_detail(b: Bed) -> DataFrame:
    return equity.detail(b.perf)


@query("""SELECT priority_level, count(*) AS ticket_count,
    round(avg(days_open), 1) AS avg_days_open FROM ops GROUP BY ALL""")
def q16_by_priority_ranked(b: Bed) -> DataFrame:
    return board.by_priority(b.ops, ranked=True)


@query("""SELECT CASE WHEN days_open BETWEEN 0 AND 3 THEN '0-3 days'
    WHEN days_open BETWEEN 4 AND 7 THEN '4-7 days'
    WHEN days_open BETWEEN 8 AND 14 THEN '8-14 days' ELSE '15+ days' END AS age_bucket,
    count(*) AS ticket_count FROM ops GROUP BY ALL""")
def q17_by_age_ranked(b: Bed) -> DataFrame:
    return board.by_age_closed_ranges(b.ops)


@query(f"""SELECT department_name, {KPIS},
    count(*) FILTER (triage_status = '4 - On Track') AS on_track, count(*) AS total
  FROM ops GROUP BY ALL""")
def q18_triage_sums(b: Bed) -> DataFrame:
    return board.triage_sums(b.ops)


@query("""SELECT service_request_number, created_date, request_type_name, community_area_name,
    department_name, days_open, days_until_breach, triage_status FROM ops
  ORDER BY days_until_breach NULLS FIRST, service_request_number LIMIT 200""")
def q19_nearest_breach(b: Bed) -> DataFrame:
    return board.nearest_breach(b.ops)


@query("""SELECT round(CAST(count(equity_index) AS DOUBLE) * 100 / count(*), 1)
    AS completion_rate FROM perf""")
def q20_completion_rate(b: Bed) -> DataFrame:
    return equity.completion_rate(b.perf)


@query("SELECT round(avg(area_avg_resolution_days), 1) AS avg_resolution_days FROM perf")
def q21_mean_resolution(b: Bed) -> DataFrame:
    return equity.mean_resolution(b.perf)


@query(f"SELECT {PCT} AS breach_rate FROM perf")
def q22_breach_rate(b: Bed) -> DataFrame:
    return equity.breach_rate(b.perf)


@query("""SELECT round(avg(equity_index), 2) AS equity_index FROM perf
  WHERE area_total_requests >= 10""")
def q23_mean_equity(b: Bed) -> DataFrame:
    return equity.mean_equity(b.perf)


@query("""SELECT community_area_name, request_type_name, area_total_requests,
    round(area_avg_resolution_days, 1) AS avg_days, round(equity_index, 2) AS equity_index,
    equity_status FROM perf WHERE area_total_requests >= 10""")
def q24_heatmap(b: Bed) -> DataFrame:
    return equity.heatmap(b.perf)


#: The request types of the sample.
GRID_TYPES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("SELECT community_area_name, " + ", ".join(f"""
    round(sum(equity_index * area_total_requests) FILTER (request_type_name = '{t}')
      / sum(area_total_requests) FILTER (request_type_name = '{t}'
          AND equity_index IS NOT NULL), 2) AS "{t}\"""" for t in GRID_TYPES) + " FROM perf GROUP BY ALL")
def q24_heatmap_grid(b: Bed) -> DataFrame:
    return equity.heatmap_grid(b.perf, GRID_TYPES)


@query(f"SELECT department_name, {PCT} AS breach_rate FROM perf GROUP BY ALL")
def q25_department_breach_percent(b: Bed) -> DataFrame:
    return equity.department_breach_percent(b.perf)


@query("""SELECT equity_status, count(DISTINCT community_area_name) AS num_areas,
    round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 1) AS pct_of_city,
    round(avg(area_avg_resolution_days), 1) AS avg_resolution_days
  FROM perf WHERE area_total_requests >= 10 GROUP BY ALL""")
def q26_equity_summary(b: Bed) -> DataFrame:
    return equity.equity_summary(b.perf)


def _delta(months: int) -> str:
    return f"""m AS (SELECT CAST(date_trunc('month', closed_date) AS DATE) AS period_month,
      count(*) AS completed, avg(resolution_days) AS avg_resolution_days,
      count(*) FILTER (is_breached) / count(*) AS breach_rate
    FROM sla WHERE closed_date IS NOT NULL GROUP BY ALL)
  SELECT m.*, m.completed - p.completed AS completed_delta,
    m.avg_resolution_days - p.avg_resolution_days AS avg_resolution_days_delta,
    m.breach_rate - p.breach_rate AS breach_rate_delta
  FROM m LEFT JOIN m p ON p.period_month = m.period_month - INTERVAL {months} MONTH"""


@query(_delta(1))
def q27_delta_month(b: Bed) -> DataFrame:
    return equity.scorecard_delta(b.sla)


@query(_delta(12))
def q27_delta_year(b: Bed) -> DataFrame:
    return equity.scorecard_delta(b.sla, months=12)


@query("""SELECT service_request_number, created_date, department_name, community_area_name
  FROM ops WHERE department_name IN ('Building', 'MACHINERY')
    AND community_area_name IN ('NATION_1', 'NATION_2', 'NATION_3')
    AND created_date BETWEEN DATE '1998-03-01' AND DATE '2000-12-31'
    AND year(created_date) = 1999""")
def q28_multi_select(b: Bed) -> DataFrame:
    return board.choose_many(
        b.ops, department_name=["Building", "MACHINERY"],
        community_area_name=["NATION_1", "NATION_2", "NATION_3"], priority_level=[],
        between={"created_date": ("1998-03-01", "2000-12-31")}, year={"created_date": 1999},
    ).select("service_request_number", "created_date", "department_name", "community_area_name")


@query("""SELECT service_request_number,
    CASE WHEN days_until_breach < 0 THEN 'Red' WHEN days_until_breach <= 2 THEN 'Orange'
         WHEN days_until_breach > 2 THEN 'Green' END AS deadline_band,
    CASE triage_status WHEN '1 - Overdue' THEN 'Red' WHEN '2 - Due Today' THEN 'Yellow' END
      AS triage_band FROM ops""")
def q29_ticket_bands(b: Bed) -> DataFrame:
    return board.with_bands(b.ops).select("service_request_number", "deadline_band",
                                          "triage_band")


@query("""SELECT community_area_name, request_type_name, department_name,
    CASE WHEN equity_index > 1.25 THEN 'Red' WHEN equity_index >= 1.10 THEN 'Orange'
         WHEN equity_index >= 0.90 THEN 'Yellow' WHEN equity_index < 0.90 THEN 'Green' END
      AS equity_band,
    CASE WHEN area_breach_rate > 0.15 THEN 'Red' WHEN area_breach_rate >= 0.10 THEN 'Orange'
         WHEN area_breach_rate < 0.10 THEN 'Green' END AS breach_band FROM perf""")
def q29_area_bands(b: Bed) -> DataFrame:
    return equity.with_bands(b.perf).select(
        "community_area_name", "request_type_name", "department_name", "equity_band",
        "breach_band")


@query(f"""SELECT count(*) AS no_closing_time,
    count(*) FILTER (status_name <> 'Completed') AS not_completed, {KPIS} FROM ops""")
def q30_open_variants(b: Bed) -> DataFrame:
    return board.open_by_status(b.ops)


@query("""SELECT f.service_request_number, g.community_area_name, r.request_type_name,
    f.created_date, f.closed_date, f.resolution_days, f.is_sla_breached
  FROM fct f JOIN dim_geography g USING (community_area_id)
  JOIN dim_request_type r USING (request_type_id)
  WHERE g.community_area_name = 'NATION_7' AND r.request_type_name = '2-HIGH'""")
def q31_drill_down(b: Bed) -> DataFrame:
    return board.drill_down(b.fct, b.dims.geography, b.dims.request_type, "NATION_7", "2-HIGH")


def _trend(period: str) -> str:
    return f"""SELECT CAST({period} AS DATE) AS period, count(*) AS completed,
    count(*) FILTER (is_breached) AS breached, avg(resolution_days) AS avg_resolution_days
  FROM sla WHERE closed_date IS NOT NULL GROUP BY ALL"""


@query(_trend("closed_date"))
def q32_trend_day(b: Bed) -> DataFrame:
    return equity.trend(b.sla, "day")


@query(_trend("date_trunc('week', closed_date)"))
def q32_trend_week(b: Bed) -> DataFrame:
    return equity.trend(b.sla, "week")


@query(_trend("date_trunc('month', closed_date)"))
def q32_trend_month(b: Bed) -> DataFrame:
    return equity.trend(b.sla, "month")


@query("SELECT created_year, count(*) AS row_count FROM log GROUP BY ROLLUP (created_year)")
def q33_rows_by_year(b: Bed) -> DataFrame:
    return board.rows_by_year(b.log)
