from __future__ import annotations

from datetime import date

import pytest
from helpers import T, as_dicts, column, ticket, tickets
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import geometry, labels, text
from ticketmill.functions.keys import surrogate_key
from ticketmill.operators import checks, dims, facts, ingest, marts, staging
from ticketmill.plans import build, documented, loads, published
from ticketmill.plans.publish import merge_into
from ticketmill.sources import seeds, table

AS_OF = date(2026, 3, 1)


def targets(spark, *rows):
    return spark.createDataFrame(
        [(t, d, "High", "test") for t, d in rows], S.SLA_TARGETS_SCHEMA)


def one_row_fact(spark, model, target=("Pothole", 3), **more):
    stg = staging.stg_service_requests(tickets(spark, ticket(**more)), AS_OF)
    return model(stg, dims.dim_request_type(stg, targets(spark, target))).first()


def test_staging_drops_true_and_unknown_legacy(spark):
    rows = tickets(spark, *[ticket(k, legacy_record=v)
                            for k, v in (("A", False), ("B", True), ("C", None))])
    assert column(staging.stg_service_requests(rows, AS_OF), S.KEY) == ["A"]


@pytest.mark.parametrize(("created", "closed", "days_open", "days"), [
    ("2026-02-27 23:59:00", None, 2, None), ("2026-02-27 23:59:00", "2026-02-28 00:01:00", None, 1),
    ("2026-02-27 00:00:00", "2026-02-27 23:00:00", None, 0),
    ("2026-02-27 00:00:00", "2026-02-25 00:00:00", None, -2)])
def test_durations(spark, created, closed, days_open, days):
    row = staging.stg_service_requests(
        tickets(spark, ticket(created=created, closed_date=closed)), AS_OF).first()
    assert (row["days_open"], row["resolution_days"]) == (days_open, days)


# status, days to close, target: met, breached
SLA_CASES = [
    ("Completed", 3, 3, True, False), ("Completed", 4, 3, False, True),
    ("Completed", 2, 3, True, False), ("Completed", 4, None, None, False),
    ("Completed", None, 3, None, False), ("Completed - Dup", 9, 3, None, False),
    ("Open", None, 3, None, False), (None, 9, 3, None, False)]


@pytest.mark.parametrize(("status", "days", "target", "met", "breached"), SLA_CASES)
def test_sla_flags(spark, status, days, target, met, breached):
    closed = None if days is None else f"2026-01-{15 + days} 00:00:00"
    row = one_row_fact(spark, facts.fct_service_requests, ("Pothole", target),
                       current_status=status, closed_date=closed)
    assert (row["is_sla_met"], row["is_sla_breached"]) == (met, breached)


def test_sla_fact_has_completed_only(spark):
    assert one_row_fact(spark, facts.fct_sla_performance, current_status="Completed - Dup") is None
    row = one_row_fact(spark, facts.fct_sla_performance, current_status="Completed",
                       closed_date="2026-01-20 00:00:00")
    assert (row["days_over_sla"], row["is_breached"]) == (2, True)
    row = one_row_fact(spark, facts.fct_sla_performance, ("Other", 1), current_status="Completed")
    assert (row["days_over_sla"], row["is_breached"], row["closed_date"]) == (None, False, None)


def test_null_text_has_a_null_key(spark):
    df = spark.createDataFrame([("a",), ("",), (None,)], "t string")
    keys = column(df.select(surrogate_key(df.t).alias("k")), "k")
    assert keys[2] is None and len({*keys}) == 3


def test_dimension_keys_equal_hashed_keys(spark):
    stg = staging.stg_service_requests(
        tickets(spark, ticket("A"), ticket("B", sr_type=None, owner_department=None),
                ticket("C", owner_department="Unlisted")), AS_OF)
    types = dims.dim_request_type(stg, targets(spark, ("Pothole", 3)))
    few = dims.dim_department(stg.where("owner_department = 'Roads'"), spark.createDataFrame(
        [], S.DEPARTMENTS_SCHEMA))
    looked_up = facts.fct_service_requests(stg, types, few, dims.dim_status(stg))
    hashed = facts.fct_service_requests(stg, types)
    assert sorted(looked_up.collect()) == sorted(hashed.collect())


def test_two_short_codes_do_not_multiply_facts(spark):
    stg = staging.stg_service_requests(tickets(
        spark, ticket("A", sr_short_code="P2"), ticket("B", sr_short_code="P1"),
        ticket("C", sr_type=None, sr_short_code="X")), AS_OF)
    dim = dims.dim_request_type(stg, targets(spark))
    assert [(r["request_type_name"], r["sr_short_code"]) for r in as_dicts(dim)] == [
        ("Pothole", "P1")]
    assert facts.fct_service_requests(stg, dim).count() == 3
    assert dims.dim_request_type(stg, targets(spark), by_code=True).count() == 2


def test_department_fallback(spark):
    stg = tickets(spark, ticket("A", owner_department="Roads"), ticket("B", owner_department=""),
                  ticket("C", owner_department=None))
    meta = spark.createDataFrame([("Roads", "Streets", "Works")], S.DEPARTMENTS_SCHEMA)
    got = {(r["raw_department_name"], r["department_name"], r["bureau"])
           for r in as_dicts(dims.dim_department(stg, meta))}
    assert got == {("Roads", "Streets", "Works"), ("", "", None)}


def test_calendar(spark):
    cal = {r["date_day"]: r for r in as_dicts(
        dims.dim_date(dims.fixed_bounds(spark), dims.holidays(spark)))}
    assert len(cal) == 1096 and len(dims.STATE_HOLIDAYS) == 44
    assert sum(r["is_illinois_holiday"] for r in cal.values()) == 44
    july4 = cal[date(2024, 7, 4)]
    assert (july4["day_of_week_num"], july4["day_of_week_name"], july4["month_name"],
            july4["is_weekend"], july4["is_business_day"]) == (5, "Thursday", "July", False, False)
    sunday = cal[date(2026, 3, 1)]
    assert (sunday["day_of_week_num"], sunday["is_weekend"], sunday["date_quarter"],
            sunday["day_of_year"]) == (1, True, 1, 60)
    assert dims.date_spine(dims.fixed_bounds(spark, "2026-01-01", "2026-01-01")).count() == 0


@pytest.mark.parametrize(("wkt", "polygons", "rings", "points"), [
    ("MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))", 1, 1, 4),
    ("multipolygon(((0 0,1 0,1 1,0 0),(.2 .2,-3e1 2,3 3,.2 .2)) , ((5 5, 6 5, 6 6, 5 5)))", 2, 3, 12),
    ("MULTIPOLYGON EMPTY", 0, 0, 0)])
def test_boundaries(spark, wkt, polygons, rings, points):
    df = spark.createDataFrame([(wkt,)], "t string").select(geometry.multipolygon(F.col("t")).alias("s"))
    row = df.select(F.size("s"), F.size(F.flatten("s")), F.size(geometry.points(F.col("s")))).first()
    assert tuple(row) == (polygons, rings, points)


@pytest.mark.parametrize("wkt", [
    "POINT (1 2)", "MULTIPOLYGON (((0 0, 1 x, 1 1)))", "MULTIPOLYGON (((0 0 0, 1 1)))",
    "MULTIPOLYGON ((0 0, 1 1))", "", "MULTIPOLYGON (((0 0, 1 1))"])
def test_bad_boundaries_raise(spark, wkt):
    df = spark.createDataFrame([(wkt,)], "t string")
    with pytest.raises(Exception):
        df.select(geometry.multipolygon(F.col("t"))).collect()


def test_long_boundary(spark):
    ring = ", ".join(f"{i} {i % 7}" for i in range(60_000))
    df = spark.createDataFrame([(f"MULTIPOLYGON ((({ring})))",), (None,)], "t string")
    shapes = df.select(geometry.multipolygon(F.col("t")).alias("s"))
    assert column(shapes.select(F.size(geometry.points(F.col("s"))).alias("n")), "n")[0] == 60_000
    assert column(shapes, "s")[1] is None


@pytest.mark.parametrize(("rings", "fault"), [
    ("(0 0, 1 0, 1 1, 0 0)", None), ("(0 0, 1 0, 1 1, 0 1)", "ring 1: not closed"),
    ("(0 0, 1 0, 0 0)", "ring 1: fewer than four points"),
    ("(0 0, 1 0, 1 1, 0 0), (0 0, 181 0, 1 1, 0 0)", "ring 2: a point that is not on the globe"),
    ("(0 0, 1 0, 1 -90.5, 0 0)", "ring 1: a point that is not on the globe"),
    ("(0 0, 1 0, NaN 1, 0 0)", "ring 1: a point that is not on the globe"),
    ("(0 0, Infinity 0, 1 1, 0 0)", "ring 1: a point that is not on the globe"),
    ("(0 0, 1 0, 0 0, 1 0, 0 0)", "ring 1: fewer than three different points"),
    ("(0 0, 1 1, 2 2, 0 0)", "ring 1: all points on a line"),
    ("(-87.6 41.8, -87.6 41.9, -87.7 41.9, -87.6 41.8)", None)])
def test_rings(spark, rings, fault):
    areas = spark.createDataFrame(
        [("1", "North", "N", "MULTIPOLYGON (((5 5, 6 5, 6 6, 5 5)))", "1", "1"),
         ("2", "South", "S", f"MULTIPOLYGON (((5 5, 6 5, 6 6, 5 5)), ({rings}))", "1", "1")], S.AREAS_SCHEMA)
    if fault is None:
        assert dims.dim_geography(areas).count() == 2
        assert dims.dim_geography(areas).select(F.size("area_boundary").alias("n")).agg(F.sum("n")).first()[0] == 3
    else:
        with pytest.raises(Exception, match=f"boundary of South, polygon 2, {fault}"):
            dims.dim_geography(areas).collect()


def test_orientation(spark):
    text = "MULTIPOLYGON (((0 0, 0 9, 9 9, 9 0, 0 0), (1 1, 2 1, 2 2, 1 1)), ((0 0, 4 0, 0 4, 0 0)))"
    df = spark.createDataFrame([(text,)], "t string").select(geometry.multipolygon(F.col("t")).alias("s"))
    areas = df.select(F.flatten(F.transform("s", lambda p: F.transform(p, geometry.signed_area))).alias("a"))
    assert column(areas, "a")[0] == [-162.0, 1.0, 16.0]
    turned = df.select(F.flatten(F.transform(geometry.oriented(F.col("s")), lambda p: F.transform(
        p, geometry.signed_area))).alias("a"))
    assert column(turned, "a")[0] == [162.0, -1.0, 16.0]
    assert df.select(geometry.signed_area(F.array().cast(f"array<{geometry.POINT_TYPE}>"))).first()[0] == 0


def test_number_with_commas(spark):
    df = spark.createDataFrame([("46,004,621.5",), ("12",), (None,)], "t string")
    assert column(df.select(text.number_with_commas(df.t).alias("n")), "n") == [46004621.5, 12.0, None]


@pytest.mark.parametrize(("left", "label"), [
    (-1, labels.OVERDUE), (0, labels.DUE_TODAY), (1, labels.AT_RISK), (2, labels.AT_RISK),
    (3, labels.ON_TRACK), (None, labels.ON_TRACK)])
def test_triage(spark, left, label):
    df = spark.createDataFrame([(left,)], "n bigint")
    assert df.select(labels.triage(df.n)).first()[0] == label


@pytest.mark.parametrize(("index", "label"), [
    (1.25, labels.SEVERE), (1.246, labels.UNDER), (1.10, labels.UNDER), (1.0999, labels.EQUITABLE),
    (0.9001, labels.EQUITABLE), (0.90, labels.OVER), (None, labels.EQUITABLE)])
def test_equity_label(spark, index, label):
    df = spark.createDataFrame([(index,)], "n double")
    assert df.select(labels.equity(df.n)).first()[0] == label


def sla_rows(spark, *groups):
    """groups: (area, type, department, list of days)"""
    rows = [(f"{g}-{i}", t, d, a, v, False) for g, (a, t, d, days) in enumerate(groups)
            for i, v in enumerate(days)]
    return spark.createDataFrame(
        rows, "service_request_number string, request_type_id bigint, department_id bigint, "
        "community_area_id bigint, resolution_days bigint, is_breached boolean")


def test_equity_thresholds_and_baseline(spark):
    sla = sla_rows(spark, (1, 1, 1, [4] * 10), (2, 1, 1, [1] * 9), (1, 2, 1, [0] * 10),
                   (3, None, 1, [5] * 12), (4, 3, 1, [None] * 10))
    got = {(r["community_area_id"], r["request_type_id"]): r for r in as_dicts(marts.equity(sla))}
    # nine tickets are too few to show but count in the baseline; no type, no row
    assert set(got) == {(1, 1), (1, 2), (4, 3)}
    assert got[1, 1]["citywide_avg_resolution_days"] == 49 / 19
    assert got[1, 1]["citywide_total_requests"] == 19
    assert got[1, 2]["equity_index"] is None and got[1, 2]["equity_status"] == labels.EQUITABLE
    assert got[4, 3]["area_avg_resolution_days"] is None


def test_status_uses_the_exact_index_the_board_the_rounded_one(spark):
    from ticketmill.operators import equity_board
    df = spark.createDataFrame([(1.246,)], "exact double").select(
        labels.equity(F.col("exact")).alias("equity_status"), F.round("exact", 2).alias("equity_index"))
    row = equity_board.board_frame(df).first()
    assert (row["equity_status"], row["equity_bucket"]) == (labels.UNDER, "Severely Underserved")


def test_packaged_seeds(spark, tmp_path):
    t = seeds.sla_targets(spark)
    assert t.count() == 110 and t.schema == spark.createDataFrame([], S.SLA_TARGETS_SCHEMA).schema
    assert sorted(r[0] for r in t.select("target_days").distinct().collect()) == [1, 2, 3, 5, 7, 14, 30]
    counts = dict(t.groupBy("priority").count().collect())
    assert counts == {"Medium": 43, "Low": 37, "Critical": 26, "High": 4}
    assert seeds.department_metadata(spark).count() == 14
    path = tmp_path / "t.csv"
    path.write_text('sr_type,target_days,priority,sla_target_source\n"a, ""b""",3,Low,x\n')
    assert as_dicts(seeds.sla_targets(spark, str(path)))[0]["sr_type"] == 'a, "b"'


def seeds_of(spark):
    areas = spark.createDataFrame(
        [("1", "North", "N", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)))", "1,000.5", "4")], S.AREAS_SCHEMA)
    return build.Seeds(targets(spark, ("Pothole", 3)),
                       spark.createDataFrame([("Roads", "Streets", "Works")], S.DEPARTMENTS_SCHEMA), areas)


def closed(key, day, modified=None, **more):
    return ticket(key, f"2026-01-{day:02d} 08:00:00", modified or f"2026-01-{day + 1:02d} 09:00:00",
                  closed_date=f"2026-01-{day + 1:02d} 09:00:00", current_status="Completed", **more)


def test_incremental_build(spark, tmp_path):
    root = str(tmp_path / "wh")

    def run(*rows, full=False):
        models = build.build_models(spark, root, tickets(spark, *rows), seeds_of(spark), AS_OF,
                                    full_refresh=full)
        return {n: {r[S.KEY]: r for r in as_dicts(models[n])}
                for n in ("fct_service_requests", "fct_sla_performance", "mart_operational")}

    first = [closed("A", 10), closed("B", 20), ticket("C", "2026-01-21 00:00:00")]
    got = run(*first)
    assert set(got["fct_service_requests"]) == set("ABC") and set(got["mart_operational"]) == {"C"}
    assert got["mart_operational"]["C"]["department_name"] == "Streets"
    assert got["mart_operational"]["C"]["triage_status"] == labels.OVERDUE

    # D: modified within the three-hour lookback; E: older than it; C closes; A is reopened;
    # F: completed late, but closed before the stored maximum
    d = ticket("D", "2026-01-19 00:00:00", "2026-01-21 06:30:00")
    e = ticket("E", "2026-01-19 00:00:00", "2026-01-21 05:00:00")
    a = ticket("A", "2026-01-10 08:00:00", "2026-01-25 00:00:00")
    f = closed("F", 12, "2026-01-25 00:00:00")
    second = [a, closed("B", 20), closed("C", 21), d, e, f]
    got = run(*second)
    assert set(got["fct_service_requests"]) == set("ABCDF")
    assert got["fct_service_requests"]["A"]["closed_date"] is None
    # the SLA fact keeps the reopened ticket and misses the late one, by its rule
    assert set(got["fct_sla_performance"]) == set("ABC")
    assert set(got["mart_operational"]) == {"A", "D"}
    full = run(*second, full=True)
    assert set(full["fct_service_requests"]) == set("ABCDEF")
    assert set(full["fct_sla_performance"]) == set("BCF")
    assert spark.table("dim_geography").first()["shape_area"] == 1000.5


def test_facts_read_only_what_was_committed_since(spark, tmp_path, monkeypatch):
    """Builds from the stored main table give what builds from its rows give, step by step."""
    lake = loads.Lake(str(tmp_path / "lake"))
    loads.ensure_tables(spark, lake)
    by_feed, by_rows = str(tmp_path / "feed"), str(tmp_path / "rows")
    read = []

    def merge(*rows):
        merge_into(spark, lake.main, tickets(spark, *rows))

    def run(root, source):
        models = build.build_models(spark, root, source, seeds_of(spark), AS_OF)
        return {n: sorted(map(str, models[n].drop("dbt_updated_at").collect())) for n in build.FACTS}

    def same():
        with monkeypatch.context() as m:
            m.setattr(facts, "_high_water", lambda *a: 1 / 0)  # the commit knows the maximum
            m.setattr(build, "upsert_into", lambda spark, root, rows, *a, real=build.upsert_into, **k: (
                read.append(rows.inputFiles()), real(spark, root, rows, *a, **k))[1])
            fed = run(by_feed, lake.main)
        assert fed == run(by_rows, table.read(spark, lake.main))
        return fed

    merge(closed("A", 10), closed("B", 20), ticket("C", "2026-01-21 00:00:00"), ticket("Z", "2026-02-21 00:00:00"))
    same()
    old = set(table.read(spark, lake.main).inputFiles())
    # late, in the lookback, reopened, closed, completed late; Z's file is not touched
    merge(ticket("A", "2026-01-10 08:00:00", "2026-02-25 00:00:00"), closed("C", 21, "2026-02-25 01:00:00"),
          ticket("D", "2026-01-19 00:00:00", "2026-02-20 23:30:00"), ticket("E", "2026-01-19 00:00:00"),
          closed("F", 12, "2026-02-25 00:00:00"))
    fed = same()
    assert len(fed["fct_service_requests"]) == 6 and len(fed["fct_sla_performance"]) == 3
    assert read and not old & {f for files in read for f in files}
    merge(closed("G", 25, "2026-02-25 02:00:00"))
    same()
    assert len(same()["fct_service_requests"]) == 7  # nothing new
    # a commit that was expired: the build reads the main table again
    merge(closed("H", 26, "2026-02-26 02:00:00"))
    table.expire(spark, lake.main, keep=1)
    assert len(same()["fct_service_requests"]) == 8


def test_an_emptied_fact_stays_empty(spark, tmp_path):
    lake, root = loads.Lake(str(tmp_path / "lake")), str(tmp_path / "wh")
    loads.ensure_tables(spark, lake)
    models = build.build_models(spark, root, lake.main, seeds_of(spark), AS_OF)
    assert models["fct_service_requests"].count() == 0
    merge_into(spark, lake.main, tickets(spark, closed("A", 10)))
    models = build.build_models(spark, root, lake.main, seeds_of(spark), AS_OF)
    assert models["fct_service_requests"].count() == 0  # the rule of an empty target
    models = build.build_models(spark, root, lake.main, seeds_of(spark), AS_OF, full_refresh=True)
    assert models["fct_service_requests"].count() == 1


def test_empty_target_gives_an_empty_slice(spark):
    stg = staging.stg_service_requests(tickets(spark, closed("A", 10)), AS_OF)
    nothing = tickets(spark, ticket()).limit(0)
    assert facts.modified_slice(stg, nothing).count() == 0
    assert facts.closed_slice(stg, nothing).count() == 0
    assert T("2026-01-11 09:00:00") == stg.first()["last_modified_date"]
    assert facts.modified_slice(stg, stg).count() == 1


def test_fact_table_is_partitioned_by_month_and_checked(spark, tmp_path):
    root = str(tmp_path / "wh")
    rows = tickets(spark, closed("A", 10), ticket("B", "2026-02-01 00:00:00", sr_type=None))
    rows = ingest.with_calendar_parts(rows).select(*S.TYPED_COLUMNS)
    models = build.build_models(spark, root, rows, seeds_of(spark), AS_OF)
    failed = {(r["model"], r["check_name"], r["checked"])
              for r in as_dicts(build.check_models(models)) if not r["passed"]}
    assert failed == {("stg_service_requests", "not_null", "sr_type"),
                      ("fct_service_requests", "not_null", "request_type_id")}
    assert sorted(table.snapshot(spark, f"{root}/fct_service_requests").parts) == ["2026-01", "2026-02"]


# --- published builds --------------------------------------------------------------------

def main_with(spark, tmp_path, *rows):
    lake = loads.Lake(str(tmp_path / "lake"))
    loads.ensure_tables(spark, lake)
    merge_into(spark, lake.main, tickets(spark, *rows))
    return lake.main


def content(models):
    stamps = ("dbt_updated_at", "dbt_loaded_at")
    return {n: sorted(map(str, m.drop(*stamps).collect())) for n, m in models.items()}


def test_another_session_reads_a_whole_build(spark, tmp_path):
    root, main = str(tmp_path / "wh"), main_with(spark, tmp_path, closed("A", 10), ticket("C", "2026-01-21 00:00:00"))
    with pytest.raises(FileNotFoundError):
        published.read(spark, root)
    first = content(build.build_models(spark, root, main, seeds_of(spark), AS_OF))
    other = spark.newSession()
    assert content(published.read(other, root)) == first and set(first) == {*build.SUITES, "mart_sla_performance"}
    merge_into(spark, main, tickets(spark, closed("B", 20), closed("C", 21, "2026-02-25 01:00:00")))
    assert content(published.read(other, root)) == first  # also staging, which is a view
    second = content(build.build_models(spark, root, main, seeds_of(spark), AS_OF))
    assert second != first and content(published.read(other, root)) == second
    assert content(published.read(other, root, 1)) == first


def test_a_failed_build_is_never_seen(spark, tmp_path, monkeypatch):
    root, main = str(tmp_path / "wh"), main_with(spark, tmp_path, closed("A", 10))
    first = content(build.build_models(spark, root, main, seeds_of(spark), AS_OF))
    merge_into(spark, main, tickets(spark, closed("B", 20)))
    with monkeypatch.context() as m:
        m.setattr(build.marts, "mart_sla_performance", lambda *a: 1 / 0)  # after the facts were brought up
        with pytest.raises(ZeroDivisionError):
            build.build_models(spark, root, main, seeds_of(spark), AS_OF)
    assert table.read(spark, f"{root}/fct_service_requests").count() == 2
    assert content(published.read(spark, root)) == first
    third = content(build.build_models(spark, root, main, seeds_of(spark), AS_OF))
    assert len(third["fct_service_requests"]) == 2 and content(published.read(spark, root)) == third
    assert len(table.children(spark, f"{root}/builds")) == 3
    assert published.expire(spark, root, keep=1) == 2 and content(published.read(spark, root)) == third
    with pytest.raises(FileNotFoundError):
        published.read(spark, root, 1)


def test_two_builds_do_not_take_one_number(spark, tmp_path):
    p = published.Pointer("run", [], {})
    assert published.publish(spark, str(tmp_path), p) == 1 and published.publish(spark, str(tmp_path), p) == 2
    with pytest.raises(table.CommitConflict):
        table.write_once(spark, f"{tmp_path}/published/0000000002.json", "{}")


def test_a_build_from_rows_has_no_staging_to_read_back(spark, tmp_path):
    root = str(tmp_path / "wh")
    build.build_models(spark, root, tickets(spark, closed("A", 10)), seeds_of(spark), AS_OF)
    assert "stg_service_requests" not in published.read(spark, root)
    assert published.read(spark, root)["fct_service_requests"].count() == 1


# --- checks and the documented build ------------------------------------------------------

def test_every_check_runs_once_with_one_grouping_per_key_set(spark, tmp_path):
    seed_frames = seeds_of(spark)
    models = build.build_models(spark, str(tmp_path / "wh"), tickets(spark, closed("A", 10)), seed_frames, AS_OF)
    result = build.check_models(models, seed_frames, tickets(spark, ticket("A"), ticket("A")))
    rows = as_dicts(result)
    listed = [(r["model"], r["check_name"], r["checked"]) for r in rows]
    assert len(set(listed)) == len(listed) == sum(
        len(set(s)) for s in [*build.SUITES.values(), checks.SEED_AREAS, checks.SEED_TARGETS,
                              checks.SEED_DEPARTMENTS, checks.SOURCE])
    assert {(r["model"], r["check_name"], r["failures"]) for r in rows if not r["passed"]} == {
        ("service_requests", "unique", 1), ("service_requests", "not_null", 2)} | {
        (r["model"], r["check_name"], r["failures"]) for r in rows if not r["passed"] and r["checked"].startswith("created_")}
    one = checks.run_suites({"fct": (spark.range(10).selectExpr("id as k", "id as v"), [
        checks.unique("k"), checks.unique_combination("k"), checks.not_null("k"), checks.accepted_range("v", 0, 5),
        checks.unique_combination("k", "v"), checks.unique("k")])})
    plan = one._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [k#") == 2 and one.count() == 5


def test_unique_ignores_nulls_and_a_combination_does_not(spark):
    df = spark.createDataFrame([(1,), (None,), (None,), (2,), (2,)], "k int")
    got = {r["check_name"]: r["failures"] for r in as_dicts(
        checks.run_suite(df, [checks.unique("k"), checks.unique_combination("k")]))}
    assert got == {"unique": 1, "unique_combination": 2}
    assert checks.run_suites({}).count() == 0 and checks.run_suite(df, []).columns == [
        "check_name", "checked", "failures", "passed"]


def test_documented_models(spark):
    rows = tickets(spark, closed("A", 9), closed("D", 9, duplicate=True), closed("N", 9, sr_type="Unknown"),
                   closed("U", 9, sr_type=None), ticket("O", "2026-02-20 00:00:00"),
                   ticket("P", "2026-02-27 00:00:00"), ticket("Q", "2026-02-14 00:00:00", sr_type="Unknown"),
                   ticket("R", "2026-02-16 00:00:00", sr_type=None, duplicate=True))
    stg = staging.stg_service_requests(rows, AS_OF)
    star = build.Dimensions(dims.dim_date(dims.fixed_bounds(spark), dims.holidays(spark)),
                            dims.dim_geography(seeds_of(spark).community_areas),
                            dims.dim_request_type(stg, targets(spark, ("Pothole", 3))),
                            dims.dim_department(stg, seeds_of(spark).department_metadata), dims.dim_status(stg))
    built = documented.models(stg, star, targets(spark, ("Pothole", 3)), AS_OF)
    fct = {r[S.KEY]: r for r in as_dicts(built["fct_service_requests"])}
    assert {k for k, r in fct.items() if r["is_duplicate"]} == {"D", "R"} and len(fct) == 8
    # older than three days, or than the default fourteen; closed tickets never
    assert {k for k, r in fct.items() if r["sla_at_risk"]} == {"O", "Q"}
    sla = {r[S.KEY]: r for r in as_dicts(built["fct_sla_performance"])}
    assert set(sla) == {"A", "N", "U"}
    assert {k: (r["sla_target_days"], r["sla_target_source"]) for k, r in sla.items()} == {
        "A": (3, "test"), "N": (14, "default"), "U": (14, "default")}
    # Friday to Saturday: a calendar day, no business day
    assert {(r["resolution_days"], r["business_days"]) for r in sla.values()} == {(1, 0)}
    assert sla["N"]["days_over_sla"] == -13
    failed = {(r["model"], r["check_name"], r["checked"]) for r in as_dicts(documented.check_contracts(built)) if not r["passed"]}
    assert failed == {("mart_sla_performance", "not_null", "sr_type")}
