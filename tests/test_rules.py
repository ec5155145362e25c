from __future__ import annotations

from datetime import date, timedelta

import pytest
from helpers import T, as_dicts, column, ticket, tickets
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators import checks, dims, rules, staging

END = date(2026, 1, 31)


def areas(spark):
    return spark.createDataFrame([(1, "North"), (2, "South")],
                                 "community_area_id bigint, community_area_name string")


def targets(spark):
    return spark.createDataFrame([("Pothole", 3, "High", "x")], S.SLA_TARGETS_SCHEMA)


@pytest.mark.parametrize(("created", "closed", "days"), [
    ("2026-01-05", "2026-01-05", 0), ("2026-01-09", "2026-01-12", 1),  # Friday to Monday
    ("2026-01-10", "2026-01-11", 0), ("2025-12-31", "2026-01-05", 2),  # 1 January is a holiday
    ("2026-01-12", "2026-01-09", -1), ("2026-01-05", None, None)])
def test_business_days(spark, created, closed, days):
    numbers = rules.business_day_numbers(dims.dim_date(dims.fixed_bounds(spark), dims.holidays(spark)))
    rows = tickets(spark, ticket(created=created, closed_date=closed))
    assert column(rules.with_business_days(rows, numbers), "business_days") == [days]


spans = st.lists(
    st.tuples(st.integers(1, 2), st.integers(0, 25), st.one_of(st.none(), st.integers(-2, 20)),
              st.sampled_from(["Pothole", "Tree"])), min_size=1, max_size=15)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=spans)
def test_daily_backlog_against_counting(spark, rows):
    first = date(2026, 1, 1)
    data = [(a, first + timedelta(c), None if x is None else first + timedelta(c + x), t)
            for a, c, x, t in rows]
    stg = tickets(spark, ticket("dup", str(first), community_area=1, duplicate=True), *[
        ticket(f"K{i}", str(c), closed_date=x and str(x), community_area=a, sr_type=t,
               owner_department=f"D{a}") for i, (a, c, x, t) in enumerate(data)])
    got = {(r["snapshot_date"], r["community_area"], r["sr_type"]): r
           for r in as_dicts(rules.daily_backlog(stg, targets(spark), areas(spark), END))}
    starts = {}
    for a, c, _, t in data:
        starts[a, t] = min(c, starts.get((a, t), c))
    assert len(got) == sum((END - s).days + 1 for s in starts.values())
    for (d, a, t), r in got.items():
        ages = [(d - c).days for b, c, x, u in data
                if (b, u) == (a, t) and c <= d and (x is None or x > d)]
        assert r["open_requests"] == len(ages)
        assert r["avg_days_open"] == (sum(ages) / len(ages) if ages else None)
        assert r["requests_older_than_sla"] == sum(g > (3 if t == "Pothole" else 14) for g in ages)
        assert r["total_created_today"] == sum((b, c, u) == (a, d, t) for b, c, x, u in data)
        assert (r["owner_department"], r["community_area_name"]) == (f"D{a}", ["North", "South"][a - 1])


def test_monthly_sla(spark):
    done = [("A", "2026-01-02", "2026-01-06", 1), ("B", "2026-01-02", "2026-01-03", 1),
            ("C", "2026-01-02", "2026-01-10", 2), ("D", "2026-01-30", "2026-02-01", 1)]
    rows = [ticket(k, c, closed_date=x, community_area=a, current_status="Completed")
            for k, c, x, a in done]
    rows += [ticket("E", "2026-01-02", closed_date="2026-01-20", current_status="Completed", duplicate=True),
             ticket("F", "2026-01-02", closed_date="2026-01-20", current_status="Open"),
             ticket("G", "2026-01-02", current_status="Completed")]
    stg = staging.stg_service_requests(tickets(spark, *rows), END)
    numbers = rules.business_day_numbers(dims.dim_date(dims.fixed_bounds(spark), dims.holidays(spark)))
    out = rules.monthly_sla(stg, targets(spark), areas(spark), numbers)
    got = {(str(r["period_month"]), r["community_area"]): r for r in as_dicts(out)}
    jan = got["2026-01-01", 1]
    assert (jan["total_closed"], jan["total_breached"], jan["breach_rate"]) == (2, 1, 0.5)
    assert (jan["avg_resolution_days"], jan["median_resolution_days"]) == (2.5, 2.5)
    assert jan["avg_business_days_taken"] == 1.0
    assert jan["equity_index"] == 2.5 / (13 / 3)
    assert set(got) == {("2026-01-01", 1), ("2026-01-01", 2), ("2026-02-01", 1)}
    assert checks.run_suite(out, checks.CONTRACT_MONTHLY).where(~F.col("passed")).count() == 0


def test_types_without_a_target_get_the_default(spark):
    rows = tickets(spark, *[ticket(f"T{n}", "2026-01-01", closed_date=f"2026-01-{n}", sr_type="Tree",
                                   current_status="Completed") for n in (15, 16)])
    stg = staging.stg_service_requests(rows, END)
    numbers = rules.business_day_numbers(dims.dim_date(dims.fixed_bounds(spark), dims.holidays(spark)))
    (out,) = as_dicts(rules.monthly_sla(stg, targets(spark), areas(spark), numbers))
    assert (out["total_closed"], out["total_breached"]) == (2, 1)


def test_default_target_and_risk(spark):
    stg = staging.stg_service_requests(tickets(
        spark, ticket("A", "2026-01-10"), ticket("B", "2026-01-28"), ticket("C", "2026-01-10", sr_type="Tree")), END)
    dim = dims.dim_request_type(stg, targets(spark))
    risk = dict(rules.sla_at_risk(stg, dim).select(S.KEY, "sla_at_risk").collect())
    assert risk == {"A": True, "B": False, "C": False}
    full = rules.with_default_target(dim)
    assert dict(full.select("request_type_name", "sla_target_days").collect()) == {"Pothole": 3, "Tree": 14}
    assert dict(full.select("request_type_name", "sla_target_source").collect())["Tree"] == "default"
    assert rules.sla_at_risk(stg, full).where("sla_at_risk").count() == 2


def test_duplicates(spark):
    rows = tickets(spark, *[ticket(k, duplicate=v) for k, v in (("A", True), ("B", False), ("C", None))])
    assert sorted(column(rules.without_duplicates(rows), S.KEY)) == ["B", "C"]


changes = st.lists(st.tuples(st.integers(0, 2), st.integers(0, 40), st.sampled_from("ab")), min_size=1,
                   max_size=25)


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=changes, bucket=st.sampled_from(["day", "month"]))
def test_history_against_a_loop(spark, rows, bucket):
    start = T("2026-01-25 00:00:00")
    data = [(k, start + timedelta(hours=7 * h), v, i) for i, (k, h, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, ts timestamp_ntz, v string, i int")
    got = sorted(map(tuple, rules.scd2(df, ["k"], ["v"], "ts", "i", bucket).collect()))
    want = []
    for key in {d[0] for d in data}:
        runs = []
        for _, ts, v, _ in sorted((d for d in data if d[0] == key), key=lambda d: (d[1], d[3])):
            if not runs or runs[-1][0] != v:
                runs.append((v, ts))
        ends = [ts for _, ts in runs[1:]] + [None]
        want += [(key, v, ts, end, end is None) for (v, ts), end in zip(runs, ends)]
    assert got == sorted(want)


def test_null_state_is_a_state(spark):
    df = spark.createDataFrame([(1, T("2026-01-01 00:00:00"), None), (1, T("2026-01-02 00:00:00"), None),
                                (1, T("2026-01-03 00:00:00"), "x")], "k int, ts timestamp_ntz, v string")
    got = sorted(rules.scd2(df, ["k"], ["v"], "ts").collect(), key=lambda r: r["valid_from"])
    assert [r["v"] for r in got] == [None, "x"] and [r["is_current"] for r in got] == [False, True]


def test_backlog_runs_on(spark):
    rows = tickets(spark, ticket("A", "2026-01-05"), ticket("B", "2026-01-06", closed_date="2026-01-20"),
                   ticket("C", "2026-01-13", closed_date="2026-01-14"))
    got = [tuple(r)[1:] for r in rules.backlog_change(rows).orderBy("week_start").collect()]
    assert got == [(2, 0, 2, 2), (1, 1, 0, 2), (0, 1, -1, 1)]


def test_oldest_by_area_keeps_the_unnamed_area(spark):
    df = spark.createDataFrame([("n", date(2026, 1, 2), "B", 5), ("n", date(2026, 1, 2), "A", 5),
                                (None, date(2026, 1, 9), "C", 1)],
                               "community_area_name string, created_date date, service_request_number string, "
                               "days_open bigint")
    got = {r["community_area_name"]: r["service_request_number"] for r in as_dicts(rules.oldest_by_area(df))}
    assert got == {"n": "A", None: "C"}


def test_checks(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (1, "b", None), (None, "b", 200.0), (None, None, -1.0)],
                               "k int, t string, x double")
    suite = [checks.unique("k"), checks.not_null("k"), checks.not_null("t"),
             checks.accepted_range("x", -90, 90), checks.accepted_range("x", 0),
             checks.unique_combination("k", "t"), checks.unique("t")]
    got = {(r["check_name"], r["checked"], i): (r["failures"], r["passed"])
           for i, r in enumerate(as_dicts(checks.run_suite(df, suite)))}
    assert sorted(v for k, v in got.items() if k[0] == "not_null") == [(1, False), (2, False)]
    assert sorted(v for k, v in got.items() if k[0] == "accepted_range") == [(1, False), (1, False)]
    assert [v for k, v in got.items() if k[0] == "unique"] == [(1, False), (1, False)]
    assert [v for k, v in got.items() if k[0] == "unique_combination"] == [(0, True)]


@pytest.mark.parametrize(("now", "hours", "passed"), [
    ("2026-01-16 10:30:00", 24, True), ("2026-01-16 10:30:01", 24, False), ("2026-01-15 09:00:00", -1, True)])
def test_freshness(spark, now, hours, passed):
    row = checks.freshness(tickets(spark, ticket()), now).first()
    assert (row["age_hours"], row["passed"]) == (hours, passed)
    assert not checks.freshness(tickets(spark, ticket()).limit(0), now).first()["passed"]
