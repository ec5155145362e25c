"""Sources, sinks, typing and write-audit-publish."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators import ingest, wap
from ticketmill.operators import operations_board as board
from ticketmill.plans import build, loads
from ticketmill.plans.publish import merge_into, upsert_into
from ticketmill.registry import query
from ticketmill.registry.oracle import TYPED
from ticketmill.samples import AS_OF, Bed
from ticketmill.sources import export, pages, seeds, table

RAW_KEY = """CASE WHEN keyless THEN CASE WHEN n % 2 = 0 THEN ' ' END
  WHEN n % 5 = 0 THEN chr(9) || service_request_number || chr(8195)
  ELSE service_request_number END"""


def _text(column: str) -> str:
    return (f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN n % 3 = 0 THEN '' ELSE '.000' END")


def _flag(column: str) -> str:
    return f"CASE WHEN n % 13 = 0 THEN false WHEN n % 17 <> 0 THEN {column} END"


# --- sources and sinks -----------------------------------------------------------------

@query(f"""SELECT {RAW_KEY} AS sr_number, current_status AS status,
    {_text('created_date')} AS created_date,
    CASE WHEN closed_date IS NOT NULL THEN {_text('closed_date')} WHEN n % 2 = 0 THEN '' END
      AS closed_date,
    CASE WHEN n % 19 = 0 THEN '' ELSE CAST(41 + (n % 64) / 64 AS VARCHAR) END AS latitude,
    CASE WHEN duplicate THEN 'SR' ELSE '' END AS parent_mark, 'Springfield' AS city
  FROM feed""")
def s01_raw_pages(b: Bed) -> DataFrame:
    return b.raw.select("sr_number", "status", "created_date", "closed_date", "latitude",
                        F.substring("parent_sr_number", 1, 2).alias("parent_mark"), "city")


@query("""SELECT service_request_number, created_date, last_modified_date FROM log
  WHERE created_date >= TIMESTAMP '1998-01-15' AND created_date < TIMESTAMP '1998-07-01'""")
def s02_date_range(b: Bed) -> DataFrame:
    rows = pages.date_range(b.log, "created_date", "1998-01-15T00:00:00", "1998-07-01T00:00:00")
    return rows.select(S.KEY, "created_date", "last_modified_date")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS area_number, n_name AS area_name, r_name AS side,
    format('{:,}.5', n_nationkey * 1000 + 1000) AS shape_area, length(the_geom) AS geom_length
  FROM (SELECT *, printf('MULTIPOLYGON (((%d 0, %d 0, %d 1, %d 1, %d 0)))', n_nationkey,
          n_nationkey + 1, n_nationkey + 1, n_nationkey, n_nationkey) AS the_geom
        FROM nation JOIN region ON n_regionkey = r_regionkey)""")
def s03_seed_csv(b: Bed) -> DataFrame:
    path = b.scratch("areas")
    export.write_csv(b.areas, path)
    return seeds.community_areas(b.spark, path).select(
        "area_number", "area_name", "side", "shape_area",
        F.length("the_geom").cast("bigint").alias("geom_length"))


@query("SELECT created_year, count(*) AS row_count FROM log GROUP BY ALL")
def s04_create_main(b: Bed) -> DataFrame:
    lake = b.lake()
    loads.ensure_tables(b.spark, lake)
    table.overwrite(b.spark, lake.main, b.log)
    loads.ensure_tables(b.spark, lake)  # an existing table keeps its content
    return table.read(b.spark, lake.main).groupBy("created_year").agg(
        F.count(F.lit(1)).alias("row_count"))


@query("""SELECT service_request_number, created_date, current_status FROM log
  WHERE created_date >= TIMESTAMP '1999-01-01'""")
def s05_staging_overwrite(b: Bed) -> DataFrame:
    lake = b.lake()
    loads.ensure_tables(b.spark, lake, "year")
    table.overwrite(b.spark, lake.staging, b.log.where("created_date < '1999-01-01'"))
    table.overwrite(b.spark, lake.staging, b.log.where("created_date >= '1999-01-01'"))
    table.overwrite(b.spark, lake.staging, b.log.where("created_date < '1900-01-01'"))
    return table.read(b.spark, lake.staging).select(S.KEY, "created_date", "current_status")


@query("SELECT CAST(0 AS BIGINT) AS row_count, count(*) AS staged_before FROM log")
def s06_truncate_staging(b: Bed) -> DataFrame:
    lake = b.lake()
    loads.ensure_tables(b.spark, lake, "year")
    staged = table.overwrite(b.spark, lake.staging, b.log)
    table.truncate(b.spark, lake.staging)
    return table.read(b.spark, lake.staging).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(staged).cast("bigint").alias("staged_before"))


@query("SELECT current_status, count(*) AS row_count FROM log GROUP BY ALL")
def s07_create_staging(b: Bed) -> DataFrame:
    lake = b.lake()
    loads.ensure_tables(b.spark, lake, "year")
    table.overwrite(b.spark, lake.staging, b.log)
    loads.ensure_tables(b.spark, lake, "year")
    return table.read(b.spark, lake.staging).groupBy("current_status").agg(
        F.count(F.lit(1)).alias("row_count"))


@query(f"SELECT {TYPED} FROM log")
def s08_main_scan(b: Bed) -> DataFrame:
    return b.log


@query("""SELECT community_area_name, city_side, request_type_name, priority_level,
    department_name, bureau, area_total_requests, area_breached_requests, area_breach_rate,
    area_avg_resolution_days, citywide_avg_resolution_days, equity_index, equity_status
  FROM perf""")
def s09_mart_scan(b: Bed) -> DataFrame:
    return b.perf


@query("""SELECT * FROM (VALUES
    ('stg_service_requests', (SELECT count(*) FROM stg)),
    ('dim_date', (SELECT count(*) FROM dim_date)),
    ('dim_geography', (SELECT count(*) FROM dim_geography)),
    ('dim_request_type', (SELECT count(*) FROM dim_request_type)),
    ('dim_department', (SELECT count(*) FROM dim_department)),
    ('dim_status', (SELECT count(*) FROM dim_status)),
    ('fct_service_requests', (SELECT count(*) FROM fct)),
    ('fct_sla_performance', (SELECT count(*) FROM sla)),
    ('mart_operational', (SELECT count(*) FROM ops)),
    ('mart_sla_performance', (SELECT count(*) FROM perf))) AS m(model, row_count)""")
def s10_build_models(b: Bed) -> DataFrame:
    models = build.build_models(b.spark, b.scratch("warehouse"), b.log, b.seeds, AS_OF,
                                b.bounds, b.holidays)
    counts = [df.agg(F.lit(name).alias("model"), F.count(F.lit(1)).alias("row_count"))
              for name, df in models.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


@query("""SELECT service_request_number, created_date, request_type_id FROM fct
  WHERE created_date BETWEEN DATE '1998-02-10' AND DATE '1998-04-20'""")
def s11_partition_layout(b: Bed) -> DataFrame:
    root = b.scratch("fct")
    build.refresh_fact(b.spark, root, "fct_service_requests", b.stg, b.dims)
    some = table.read(b.spark, root, low="1998-02-10", high="1998-04-20")
    return some.where("created_date between '1998-02-10' and '1998-04-20'").select(
        S.KEY, "created_date", "request_type_id")


@query("""SELECT service_request_number, CAST(created_date AS VARCHAR) AS created_date,
    request_type_name, department_name, CAST(days_open AS VARCHAR) AS days_open, triage_status
  FROM ops ORDER BY ops.days_open DESC NULLS FIRST, service_request_number LIMIT 200""")
def s12_csv_export(b: Bed) -> DataFrame:
    path = b.scratch("detail")
    export.write_csv(board.oldest_open(b.ops), path)
    return b.spark.read.option("header", True).csv(path)


# --- typing ----------------------------------------------------------------------------

@query(f"""SELECT {RAW_KEY} AS service_request_number, created_date, last_modified_date
  FROM feed""")
def p01_timestamps(b: Bed) -> DataFrame:
    return ingest.with_timestamps(ingest.rename_raw(b.raw)).select(
        S.KEY, "created_date", S.VERSION)


@query(f"SELECT {RAW_KEY} AS service_request_number, closed_date FROM feed")
def p02_closed_date(b: Bed) -> DataFrame:
    return ingest.with_timestamps(ingest.rename_raw(b.raw)).select(S.KEY, "closed_date")


@query(f"""SELECT {RAW_KEY} AS service_request_number, created_year, created_month,
  created_day_of_week FROM feed""")
def p03_calendar_parts(b: Bed) -> DataFrame:
    typed = ingest.with_calendar_parts(ingest.with_timestamps(ingest.rename_raw(b.raw)))
    return typed.select(S.KEY, *S.CALENDAR_PARTS)


@query(f"""SELECT {RAW_KEY} AS service_request_number, ward,
    CASE WHEN n % 11 <> 0 THEN community_area END AS community_area,
    CASE WHEN n % 7 <> 0 THEN n % 24 END AS created_hour FROM feed""")
def p04_integers(b: Bed) -> DataFrame:
    return ingest.with_numbers(ingest.rename_raw(b.raw)).select(
        S.KEY, "ward", "community_area", "created_hour")


@query(f"""SELECT {RAW_KEY} AS service_request_number,
    CASE WHEN n % 19 <> 0 THEN 41 + (n % 64) / 64 END AS latitude,
    -87 - (n % 64) / 64 AS longitude, CAST(NULL AS DOUBLE) AS x_coordinate,
    CAST(NULL AS DOUBLE) AS y_coordinate FROM feed""")
def p05_doubles(b: Bed) -> DataFrame:
    return ingest.with_numbers(ingest.rename_raw(b.raw)).select(
        S.KEY, "latitude", "longitude", "x_coordinate", "y_coordinate")


@query(f"""SELECT {RAW_KEY} AS service_request_number, {_flag('duplicate')} AS duplicate,
    {_flag('legacy_record')} AS legacy_record FROM feed""")
def p06_booleans(b: Bed) -> DataFrame:
    return ingest.with_flags(ingest.rename_raw(b.raw)).select(
        S.KEY, "duplicate", "legacy_record")


@query(f"""SELECT {RAW_KEY} AS service_request_number,
    CASE WHEN n % 2 <> 0 THEN '60601' END AS zip_code, sr_short_code,
    CASE WHEN n % 3 <> 0 THEN 'phone' END AS origin,
    CASE WHEN n % 4 <> 0 THEN 'G1' END AS electricity_grid,
    CASE WHEN duplicate THEN printf('SR%09d', n - 1) END AS parent_sr_number FROM feed""")
def p07_blank_to_null(b: Bed) -> DataFrame:
    return ingest.with_blanks_as_null(ingest.rename_raw(b.raw)).select(
        S.KEY, "zip_code", "sr_short_code", "origin", "electricity_grid", "parent_sr_number")


@query(f"SELECT {RAW_KEY} AS service_request_number, current_status FROM feed")
def p08_rename(b: Bed) -> DataFrame:
    return ingest.rename_raw(b.raw).select(S.KEY, "current_status")


@query("SELECT service_request_number, sr_type FROM log")
def p09_key_filter(b: Bed) -> DataFrame:
    return ingest.keyed_rows(ingest.rename_raw(b.raw)).select(S.KEY, "sr_type")


@query("""SELECT service_request_number, sr_type, CAST(NULL AS BIGINT) AS ward,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS BOOLEAN) AS duplicate,
    CAST(NULL AS TIMESTAMP) AS closed_date, CAST(NULL AS VARCHAR) AS zip_code,
    CAST(NULL AS VARCHAR) AS parent_sr_number FROM log""")
def p10_missing_columns(b: Bed) -> DataFrame:
    three = b.raw.select("sr_number", "sr_type", "created_date", "last_modified_date")
    return ingest.typed_tickets(three).select(
        S.KEY, "sr_type", "ward", "latitude", "duplicate", "closed_date", "zip_code",
        "parent_sr_number")


@query("SELECT service_request_number, length(service_request_number) AS key_length FROM log")
def p11_trim_key(b: Bed) -> DataFrame:
    return ingest.keyed_rows(ingest.rename_raw(b.raw)).select(
        S.KEY, F.length(S.KEY).cast("bigint").alias("key_length"))


#: The tickets as typing makes them of the landed records.
_LANDED = f"""landed AS (SELECT {TYPED} FROM (SELECT * REPLACE (
    CASE WHEN n % 3 <> 0 THEN 'phone' END AS origin,
    CASE WHEN n % 2 <> 0 THEN '60601' END AS zip_code,
    CASE WHEN n % 11 <> 0 THEN community_area END AS community_area,
    CASE WHEN n % 7 <> 0 THEN n % 24 END AS created_hour,
    CASE WHEN n % 19 <> 0 THEN 41 + (n % 64) / 64 END AS latitude,
    -87 - (n % 64) / 64 AS longitude, {_flag('duplicate')} AS duplicate,
    {_flag('legacy_record')} AS legacy_record,
    CASE WHEN n % 4 <> 0 THEN 'G1' END AS electricity_grid,
    CASE WHEN duplicate THEN printf('SR%09d', n - 1) END AS parent_sr_number)
  FROM log))"""


@query(f"{_LANDED} SELECT {TYPED} FROM landed")
def p12_typed_tickets(b: Bed) -> DataFrame:
    return ingest.typed_tickets(b.raw)


# --- audit, deduplication, merge -------------------------------------------------------

@query("""SELECT 'created_date' AS required, count(*) AS row_count,
    count(*) FILTER (created_date IS NULL) AS null_count,
    count(*) >= 1 AND count(*) FILTER (created_date IS NULL) = 0 AS passed FROM log
  UNION ALL SELECT 'closed_date', count(*), count(*) FILTER (closed_date IS NULL),
    count(*) >= 1 AND count(*) FILTER (closed_date IS NULL) = 0 FROM log
  UNION ALL SELECT 'none', 0, 0, false""")
def w01_audit(b: Bed) -> DataFrame:
    one = wap.audit(b.log).withColumn("required", F.lit("created_date"))
    two = wap.audit(b.log, required="closed_date").withColumn("required", F.lit("closed_date"))
    three = wap.audit(b.log.where("created_date < '1900-01-01'")).withColumn(
        "required", F.lit("none"))
    return one.unionByName(two).unionByName(three)


@query("""SELECT user_id, event_id, ts, event_type, value, props FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) WHERE rn = 1""")
def w02_latest_wins(b: Bed) -> DataFrame:
    return wap.latest_wins(b.events, "user_id", "ts", ["event_id"])


def _feed_merge(b: Bed) -> DataFrame:
    return wap.merge(b.feed_target(), b.feed_source(), "state_key", "ts", ("event_type", "ts"))


@query("SELECT state_key, user_id, event_id, ts, event_type, value, props, action FROM feed_merged "
       "WHERE action <> 'insert'")
def w03_merge_update(b: Bed) -> DataFrame:
    return _feed_merge(b).where("action <> 'insert'")


@query("SELECT state_key, user_id, event_id, ts, event_type, value, props, action "
       "FROM feed_merged")
def w04_merge_insert(b: Bed) -> DataFrame:
    return _feed_merge(b)


@query("""SELECT count(*) FILTER (action = 'insert') AS inserted,
    count(*) FILTER (action = 'update') AS updated, count(*) FILTER (action = 'keep') AS kept,
    count(*) FILTER (action <> 'keep') AS affected FROM feed_merged""")
def w05_affected_rows(b: Bed) -> DataFrame:
    return wap.affected(_feed_merge(b))


#: The columns that a merge moves (of those that the sample fills).
MOVED = ("current_status", "closed_date", "last_modified_date", "duplicate", "owner_department")
STORED = S.TYPED_COLUMNS


def _number() -> Column:
    return F.substring(S.KEY, 3, 9).cast("bigint")


def _changed_tickets(b: Bed) -> DataFrame:
    """Every third ticket with other statuses, wards and dates; the version is newer, equal,
    older or null."""
    day = F.expr("interval 1 day")
    case = _number() % 4
    version = F.when(case == 0, F.col(S.VERSION) + day).when(case == 1, F.col(S.VERSION)).when(
        case == 2, F.col(S.VERSION) - day)
    return b.log.where(_number() % 3 == 0).withColumns({
        S.VERSION: version, "current_status": F.lit("Changed"), "ward": F.lit(99).cast("bigint"),
        "closed_date": F.col("created_date") + F.expr("interval 3 days"),
        "created_date": F.col("created_date") + F.expr("interval 40 days"),
        "owner_department": F.lit("Moved"), "duplicate": ~F.col("duplicate")})


_CHANGED = """t AS (SELECT *, CAST(substr(service_request_number, 3) AS BIGINT) AS n FROM log),
  s AS (SELECT * REPLACE (
      CASE n % 4 WHEN 0 THEN last_modified_date + INTERVAL 1 DAY WHEN 1 THEN last_modified_date
        WHEN 2 THEN last_modified_date - INTERVAL 1 DAY END AS last_modified_date,
      'Changed' AS current_status, CAST(99 AS BIGINT) AS ward,
      created_date + INTERVAL 3 DAY AS closed_date, created_date + INTERVAL 40 DAY AS created_date,
      'Moved' AS owner_department, NOT duplicate AS duplicate) FROM t WHERE n % 3 = 0)"""


@query(f"""{_CHANGED},
  m AS (SELECT t.* REPLACE (UPDATES) FROM t LEFT JOIN s
        ON s.n = t.n AND s.last_modified_date > t.last_modified_date WHERE t.n % 10 <> 0
    UNION ALL SELECT * FROM s WHERE n % 10 = 0)
  SELECT {', '.join(STORED)} FROM m""".replace("UPDATES", ", ".join(
    f"CASE WHEN s.n IS NULL THEN t.{c} ELSE s.{c} END AS {c}" for c in MOVED)))
def w04_stored_merge(b: Bed) -> DataFrame:
    """The merge that loads run, into a stored table: only some columns move."""
    lake = b.lake()
    loads.ensure_tables(b.spark, lake)
    table.overwrite(b.spark, lake.main, b.log.where(_number() % 10 != 0))
    table.overwrite(b.spark, lake.staging, _changed_tickets(b))
    merge_into(b.spark, lake.main, table.read(b.spark, lake.staging))
    return table.read(b.spark, lake.main).select(*STORED)


@query(f"""{_CHANGED}, j AS (SELECT s.n, s.n % 10 = 0 AS new,
      s.last_modified_date > t.last_modified_date AS newer FROM s JOIN t USING (n))
  SELECT count(*) FILTER (new) AS inserted, count(*) FILTER (NOT new AND newer) AS updated,
    count(*) FILTER (new OR newer) AS affected FROM j""")
def w05_stored_counts(b: Bed) -> DataFrame:
    """What the merge into a stored table says of itself."""
    lake = b.lake()
    loads.ensure_tables(b.spark, lake)
    table.overwrite(b.spark, lake.main, b.log.where(_number() % 10 != 0))
    table.overwrite(b.spark, lake.staging, _changed_tickets(b))
    counts = merge_into(b.spark, lake.main, table.read(b.spark, lake.staging))
    return b.spark.range(1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()])


@query(f"""{_CHANGED}
  SELECT {', '.join(STORED)} FROM (SELECT * FROM t WHERE n % 10 <> 0 AND n % 3 <> 0
    UNION ALL SELECT * FROM s)""")
def f12_stored_upsert(b: Bed) -> DataFrame:
    """The upsert that fact builds run, into a stored table; rows move between months."""
    lake = b.lake()
    loads.ensure_tables(b.spark, lake)
    table.overwrite(b.spark, lake.main, b.log.where(_number() % 10 != 0))
    upsert_into(b.spark, lake.main, _changed_tickets(b))
    return table.read(b.spark, lake.main).select(*STORED)


@query("""b AS (SELECT CAST(min(created_date) AS DATE) + 14 AS lo,
    CAST(max(created_date) AS DATE) AS hi FROM log),
  f AS (SELECT lo, hi, CAST(unnest(generate_series(date_trunc('month', lo),
    hi - INTERVAL 1 DAY, INTERVAL 3 MONTH)) AS DATE) AS first FROM b)
  SELECT greatest(first, lo) AS chunk_start,
    least(CAST(first + INTERVAL 3 MONTH AS DATE), hi) AS chunk_end FROM f""")
def w06_chunk_planner(b: Bed) -> DataFrame:
    bounds = b.log.agg(F.date_add(F.to_date(F.min("created_date")), 14).alias("start"),
                       F.to_date(F.max("created_date")).alias("end"))
    return loads.chunk_frame(bounds, 3)


LOADED = TYPED


def _loaded(b: Bed, lake: loads.Lake, result: loads.LoadResult) -> DataFrame:
    return table.read(b.spark, lake.main).select(
        *LOADED.split(", "), F.lit(result.rows).cast("bigint").alias("loaded"),
        F.lit(result.failed).cast("bigint").alias("failed"))


def _expected(low: str, high: str) -> str:
    return (f"{_LANDED} SELECT {LOADED}, count(*) OVER () AS loaded, CAST(0 AS BIGINT) AS failed "
            f"FROM landed WHERE created_date >= TIMESTAMP '{low}' AND created_date < TIMESTAMP '{high}'")


def _padded_month(b: Bed, field: str, month: str) -> DataFrame:
    """The landed records, with a month's texts of ``field`` padded and so unreadable."""
    bad = F.col(field).startswith(month)
    return b.raw.withColumn(field, F.when(bad, F.concat(F.lit(" "), field)).otherwise(F.col(field)))


@query(f"""{_LANDED}, b AS (SELECT count(*) AS set_aside FROM feed
      WHERE strftime(created_date, '%Y-%m') = '1995-07')
  SELECT {LOADED}, count(*) OVER () AS loaded, CAST(1 AS BIGINT) AS failed, set_aside FROM landed, b
  WHERE created_date >= TIMESTAMP '1995-01-01' AND created_date < TIMESTAMP '1996-01-01'
    AND strftime(created_date, '%Y-%m') <> '1995-07'""")
def w08_bad_dates(b: Bed) -> DataFrame:
    """A year with a month of padded dates: reported and set aside, the rest loads; a second,
    clean load keeps what was set aside."""
    lake = b.lake()
    raw = _padded_month(b, "created_date", "1995-07")
    result = loads.backfill(b.spark, lake, raw, date(1995, 1, 1), date(1996, 1, 1))
    loads.yearly_load(b.spark, lake, b.raw.where(F.lit(False)), 1996)
    kept = table.read(b.spark, lake.quarantine).count()
    return _loaded(b, lake, result).withColumn("set_aside", F.lit(kept).cast("bigint"))


@query(f"""{_LANDED}, f AS (SELECT *, strftime(last_modified_date, '%Y-%m-%d') = '2000-06-14' AS bad,
      last_modified_date >= TIMESTAMP '2000-06-14 12:00:00'
      AND last_modified_date < TIMESTAMP '2000-06-15 12:00:00' AS fresh FROM landed),
  r AS (SELECT count(*) AS set_aside FROM feed
      WHERE strftime(last_modified_date, '%Y-%m-%d') = '2000-06-14')
  SELECT {LOADED}, count(*) FILTER (NOT replayed) OVER () AS loaded, CAST(1 AS BIGINT) AS failed,
    count(*) FILTER (replayed) OVER () AS replayed_rows, set_aside
  FROM (SELECT *, bad AS replayed FROM f WHERE bad OR fresh), r""")
def w09_bad_dates(b: Bed) -> DataFrame:
    """A daily load of records whose change times are padded on one day: reported and set aside,
    then corrected and replayed."""
    lake = b.lake()
    raw = _padded_month(b, S.VERSION, "2000-06-14")
    result = loads.daily_load(b.spark, lake, raw, datetime(2000, 6, 15, 12))
    again = loads.replay(b.spark, lake, lambda bad: bad.withColumn(S.VERSION, F.trim(S.VERSION)), "by hand")
    kept = table.read(b.spark, lake.quarantine).count()
    return _loaded(b, lake, result).withColumns({
        "replayed_rows": F.lit(again.rows).cast("bigint"), "set_aside": F.lit(kept).cast("bigint")})


@query(_expected("1995-01-01", "2001-10-15"))
def w07_chunk_loop(b: Bed) -> DataFrame:
    lake = b.lake()
    result = loads.backfill(b.spark, lake, b.raw, date(1995, 1, 1), date(2001, 10, 15), 12,
                            at_once=False)
    return _loaded(b, lake, result)


@query(_expected("1997-01-01", "1998-01-01"))
def w08_yearly_load(b: Bed) -> DataFrame:
    lake = b.lake()
    return _loaded(b, lake, loads.yearly_load(b.spark, lake, b.raw, 1997))


@query(f"""{_LANDED}, w AS (SELECT *, last_modified_date >= TIMESTAMP '2000-06-14 12:00:00'
      AND last_modified_date < TIMESTAMP '2000-06-15 12:00:00' AS fresh FROM landed),
  base AS (SELECT * REPLACE (
      CASE WHEN hide THEN 'Open' ELSE current_status END AS current_status,
      CASE WHEN hide THEN NULL ELSE closed_date END AS closed_date,
      CASE WHEN hide THEN created_date ELSE last_modified_date END AS last_modified_date)
    FROM (SELECT *, NOT fresh AND closed_date >= TIMESTAMP '2000-06-14 12:00:00' AS hide FROM w)
    WHERE created_date < TIMESTAMP '2000-06-14')
  SELECT {LOADED} FROM base
  UNION ALL SELECT {LOADED} FROM w WHERE fresh
    AND created_date >= TIMESTAMP '2000-06-14'""")
def w09_daily_load(b: Bed) -> DataFrame:
    """The main table as it stood at noon of 14 June, then one day's changes."""
    lake = b.lake()
    later = F.col("closed_date") >= "2000-06-14T12:00:00"
    before = b.raw.withColumns({
        "status": F.when(later, "Open").otherwise(F.col("status")),
        "last_modified_date": F.when(later, F.col("created_date"))
        .otherwise(F.col("last_modified_date")),
        "closed_date": F.when(~later, F.col("closed_date")),
    })
    loads.backfill(b.spark, lake, before, date(1995, 1, 1), date(2000, 6, 14))
    loads.daily_load(b.spark, lake, b.raw, datetime(2000, 6, 15, 12))
    return table.read(b.spark, lake.main).select(*LOADED.split(", "))


@query(_expected("1995-01-01", "2002-01-01"))
def w10_backfill(b: Bed) -> DataFrame:
    lake = b.lake()
    result = loads.backfill(b.spark, lake, b.raw, date(1995, 1, 1), date(2002, 1, 1), 3)
    return _loaded(b, lake, result)


@query("""SELECT strftime(created_date, '%Y-%m') AS month, count(*) AS row_count,
    count(*) FILTER (n % 7 = 0) AS parse_errors, count(*) FILTER (n % 7 = 0) = 0 AS passed
  FROM log GROUP BY ALL""")
def w07_audit_by_chunk(b: Bed) -> DataFrame:
    """The grouped audit of a one-pass load, with every seventh closing time spoilt."""
    n = F.regexp_extract("sr_number", r"SR(\d+)", 1)
    spoilt = b.raw.where("sr_number like '%SR%'").withColumn(
        "closed_date", F.when(n.cast("bigint") % 7 == 0, "soon").otherwise(F.col("closed_date")))
    typed = ingest.lenient_tickets(spoilt).withColumn(
        "month", F.date_format("created_date", "yyyy-MM"))
    return wap.audit_by(typed, "month", errors="parse_errors").select(
        "month", "row_count", "parse_errors", "passed")

