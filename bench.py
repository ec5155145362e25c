"""Time the headline work and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the
local cores, BENCH_COPIES (default 29; 0 skips) the scale-up of the ticket log, which at
sf0.1 gives about 4.35 million tickets.

Every query is run once to compile it and then timed once, writing all rows to a sink that
drops them. ``setup`` (ticket log and dimensions) and the loads are timed on their first run.
"""

from __future__ import annotations

import json
import os
import time
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill import registry, session
from ticketmill import schemas as S
from ticketmill.operators import wap
from ticketmill.plans import build, loads
from ticketmill.plans.publish import merge_into
from ticketmill.samples import AS_OF, bed
from ticketmill.sources import table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
COPIES = int(os.environ.get("BENCH_COPIES", "29"))

QUERIES = (
    "p12_typed_tickets", "w02_latest_wins", "w04_merge_insert", "t01_staging", "d06_dim_date",
    "d09_dim_department", "d10_dim_request_type", "f01_fact", "f13_sla_fact",
    "m05_mart_operational", "m13_mart_sla", "q03_operations_kpis", "q06_triage_pivot",
    "q07_oldest_open", "q13_department_breach", "q15_equity_detail", "q18_triage_sums",
    "q26_equity_summary", "q27_delta_month", "q32_trend_month", "q33_rows_by_year",
    "v05_source_suite", "x03_business_days", "x06_daily_backlog", "x07_monthly_sla",
    "x09_backlog_change", "x10_annual_audit", "x11_history",
)


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(out: dict, name: str, work) -> None:
    started = time.perf_counter()
    work()
    out[name] = round(time.perf_counter() - started, 3)


def scaled_log(log: DataFrame, copies: int) -> DataFrame:
    """The ticket log several times over, each copy with keys of its own."""
    copy = F.explode(F.sequence(F.lit(1), F.lit(copies)))
    return log.withColumn("_copy", copy).withColumn(
        S.KEY, F.concat(S.KEY, F.lit("-"), F.col("_copy").cast("string"))).drop("_copy")


def scaled_raw(raw: DataFrame, copies: int) -> DataFrame:
    """The landed records several times over, each copy with keys of its own."""
    key = F.concat(F.trim("sr_number"), F.lit("-"), F.col("_copy").cast("string"))
    return raw.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(copies)))).withColumn(
        "sr_number", F.when(F.trim("sr_number") != "", key)).drop("_copy")


def scale_up(b, out: dict) -> dict:
    """Ticket table, model builds, merges and a load at the size of the published main table."""
    spark, lake = b.spark, b.lake()
    loads.ensure_tables(spark, lake)
    big = scaled_log(b.log, COPIES)
    timed(out, "scale_write_main", lambda: table.overwrite(spark, lake.main, big))
    tickets = table.read(spark, lake.main)
    root = b.scratch("warehouse")

    def build_all():
        return build.build_models(spark, root, lake.main, b.seeds, AS_OF, b.bounds, b.holidays)

    timed(out, "scale_build_models", build_all)
    fct = table.read(spark, f"{root}/fct_service_requests")
    timed(out, "scale_scan_fact", lambda: drain(fct))
    timed(out, "scale_mart_operational", lambda: drain(spark.table("mart_operational")))
    modified = F.col(S.VERSION)

    def newer(rows: DataFrame) -> DataFrame:
        table.overwrite(spark, lake.staging, rows.withColumn(S.VERSION, modified + F.expr("interval 1 hour")))
        return table.read(spark, lake.staging)

    staged = newer(tickets.where((modified >= "2000-06-14") & (modified < "2000-06-15")))
    timed(out, "scale_daily_merge", lambda: (
        wap.audit(staged).first(), merge_into(spark, lake.main, staged)))
    timed(out, "scale_rebuild_after_day", build_all)
    # a change in every month: one ticket in ten thousand
    before = table.snapshot(spark, lake.main)
    staged = newer(tickets.where(F.xxhash64(S.KEY) % 10_000 == 0))
    timed(out, "scale_spread_merge", lambda: merge_into(spark, lake.main, staged))
    after = table.snapshot(spark, lake.main)
    sizes = [{(p, x): table.stored_bytes(spark, lake.main, replace(s, parts={p: [x]}), [p])
              for p, batches in s.parts.items() for x in batches} for s in (before, after)]
    kept = sum(n for entry, n in sizes[1].items() if entry in sizes[0])
    loading = b.lake()
    timed(out, "scale_load", lambda: loads.backfill(
        spark, loading, scaled_raw(b.raw, COPIES), date(1995, 1, 1), date(2002, 1, 1)))
    rows = tickets.count()
    return {"scale_tickets": rows, "scale": out,
            "scale_load_rows_per_sec": round(table.read(spark, loading.main).count() / out["scale_load"]),
            "scale_spread_merge_rewritten": round(1 - kept / sum(sizes[0].values()), 3)}


def main() -> None:
    spark = (
        session.builder("ticketmill-bench").master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS).config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    b, registered, times = bed(spark, SF_DIR), registry.load(), {}
    timed(times, "setup", lambda: (b.log, b.dims))
    for name in QUERIES:
        run = registered[name].run
        drain(run(b))
        timed(times, name, lambda run=run: drain(run(b)))
    raw, lake = b.raw, b.lake()
    timed(times, "load_all_years", lambda: loads.backfill(
        spark, lake, raw, date(1995, 1, 1), date(2002, 1, 1)))
    rows = b.log.count()
    doc = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": dict(times),
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "tickets": rows,
        "load_rows_per_sec": round(rows / times["load_all_years"]),
        "cpus": int(CPUS),
        "spark": spark.version,
    }
    if COPIES:
        doc |= scale_up(b, {})
    print(json.dumps(doc))


if __name__ == "__main__":
    main()
