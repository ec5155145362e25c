from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from helpers import as_dicts, column, ticket, tickets
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators import history

START = datetime(2026, 1, 1)


def frames(spark, rows, versions):
    """rows: (id, key, hours or None); versions: (key, hours, name)."""
    def at(h):
        return None if h is None else START + timedelta(hours=h)

    left = spark.createDataFrame([(i, k, at(h)) for i, k, h in rows], "id bigint, k string, t timestamp_ntz")
    right = spark.createDataFrame([(k, at(h), n) for k, h, n in versions], "k string, since timestamp_ntz, name string")
    return left, right


def plain(rows, versions):
    out = {}
    for i, k, h in rows:
        valid = [(v, n) for j, v, n in versions if j == k and h is not None and v <= h]
        out[i] = max(valid)[1] if valid else None
    return out


def looked_up(spark, rows, versions, bucket):
    left, right = frames(spark, rows, versions)
    made = history.as_of(left, right, ["k"], "t", "since", ["name"], bucket)
    assert made.columns == ["id", "k", "t", "name"]
    got = made.collect()
    assert len(got) == len(rows)
    return {r["id"]: r["name"] for r in got}


hours = st.integers(0, 24 * 70)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(times=st.lists(st.tuples(st.sampled_from("AB"), st.none() | hours), max_size=12),
       starts=st.sets(st.tuples(st.sampled_from("ABC"), hours), max_size=8))
def test_as_of_against_every_pair(spark, times, starts):
    rows = [(i, k, h) for i, (k, h) in enumerate(times)] + [(100, None, 5)]
    versions = [(k, h, f"{k}{h}") for k, h in sorted(starts)]
    for bucket in ("month", "day"):
        assert looked_up(spark, rows, versions, bucket) == plain(rows, versions)


def test_a_version_starts_at_its_time_and_lasts_over_empty_buckets(spark):
    versions = [("A", 10, "first"), ("A", 24 * 40, "second")]
    rows = [(0, "A", 9), (1, "A", 10), (2, "A", 24 * 30), (3, "A", 24 * 40 - 1), (4, "A", 24 * 40), (5, "A", 24 * 400)]
    for bucket in ("hour", "day", "month", "year"):
        assert looked_up(spark, rows, versions, bucket) == {
            0: None, 1: "first", 2: "first", 3: "first", 4: "second", 5: "second"}


def test_empty_sides(spark):
    assert looked_up(spark, [], [("A", 1, "x")], "day") == {}
    assert looked_up(spark, [(1, "A", 5), (1, "A", 5)], [], "day") == {1: None}


def test_a_hot_key_is_split_and_meets_no_range(spark):
    rng = random.Random(3)
    rows = [(i, "HOT", rng.randrange(24 * 60)) for i in range(6000)] + [(9000 + i, f"K{i}", 5) for i in range(40)]
    versions = [("HOT", h, f"v{h}") for h in range(0, 24 * 60, 7)]
    assert looked_up(spark, rows, versions, "day") == plain(rows, versions)
    left, right = frames(spark, rows, versions)
    made = history.as_of(left, right, ["k"], "t", "since", ["name"], "day")
    plan = made._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # no task holds more than the few days that hash to it
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    try:
        sizes = column(made.where("k = 'HOT'").groupBy(F.spark_partition_id()).count(), "count")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 6000 and max(sizes) < 6000 / 6


@pytest.fixture
def metadata(spark):
    return spark.createDataFrame([("DW - Water", "Water Works", "Utilities"), ("Parks", "Parks Dept", None)],
                                 S.DEPARTMENTS_SCHEMA)


def test_departments_that_are_renamed(spark, metadata):
    def day(key, d, name):
        return ticket(key, f"2026-01-{d:02d} 10:00:00", owner_department=name)

    log = tickets(spark, day("1", 1, "DW - Water"), day("2", 3, "DW - Water"), day("3", 3, "DW - Sewers"),
                  day("4", 3, "DW - Sewers"), day("5", 9, "DW - Sewers"), day("6", 12, "DW - Water"),
                  day("7", 12, "DW - Aqua"), day("8", 4, "Parks"), day("9", 5, None))
    periods = history.department_history(log, metadata)
    got = {(r["department_code"], str(r["valid_from"])): r for r in as_dicts(periods)}
    # on the third the new name has more tickets, on the twelfth the lower of two equals counts
    assert {k: (r["raw_department_name"], r["valid_to"], r["is_current"]) for k, r in got.items()} == {
        ("DW", "2026-01-01"): ("DW - Water", date(2026, 1, 3), False),
        ("DW", "2026-01-03"): ("DW - Sewers", date(2026, 1, 12), False),
        ("DW", "2026-01-12"): ("DW - Aqua", None, True), ("Parks", "2026-01-04"): ("Parks", None, True)}
    assert got["DW", "2026-01-01"]["department_name"] == "Water Works"
    assert got["DW", "2026-01-03"]["department_name"] == "DW - Sewers"
    assert len({r["department_version_id"] for r in got.values()}) == 4
    shown = {r[S.KEY]: r["department_name"] for r in as_dicts(history.with_department_version(log, periods))}
    assert shown == {"1": "Water Works", "2": "DW - Sewers", "3": "DW - Sewers", "4": "DW - Sewers",
                     "5": "DW - Sewers", "6": "DW - Aqua", "7": "DW - Aqua", "8": "Parks Dept", "9": None}


def test_no_department_no_history(spark, metadata):
    none = tickets(spark, ticket("1", owner_department=None))
    assert history.department_history(none, metadata).collect() == []
    empty = history.department_history(none, metadata)
    assert history.with_department_version(none, empty).first()["department_version_id"] is None
