from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from helpers import column, raw, raw_row, ticket, tickets
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators import wap
from ticketmill.plans import loads, publish
from ticketmill.sources import pages, table
from ticketmill.streaming.feed import merge_landed_pages


@pytest.mark.parametrize(("start", "end", "months", "chunks"), [
    ("2026-01-01", "2026-02-01", 1, 1), ("2026-01-01", "2026-04-01", 1, 3),
    ("2026-01-15", "2026-03-15", 1, 3), ("2026-01-01", "2026-07-01", 3, 2),
    ("2025-11-20", "2026-02-01", 2, 2), ("2026-01-01", "2026-01-01", 1, 0)])
def test_chunk_plans(spark, start, end, months, chunks):
    lo, hi = date.fromisoformat(start), date.fromisoformat(end)
    plan = loads.plan_chunks(lo, hi, months)
    assert len(plan) == chunks
    if plan:
        assert plan[0][0] == lo and plan[-1][1] == hi
        assert all(a[1] == b[0] and b[0].day == 1 for a, b in zip(plan, plan[1:]))
    bounds = spark.createDataFrame([(lo, hi)], "start date, end date")
    rows = loads.chunk_frame(bounds, months).orderBy("chunk_start").collect()
    assert [tuple(r) for r in rows] == plan
    days = spark.createDataFrame([(a,) for a, _ in plan], "d date")
    numbers = column(days.select(loads.chunk_number(days.d, lo, months).alias("n")), "n")
    assert numbers == list(range(chunks))


@pytest.fixture
def lake(spark, tmp_path):
    lake = loads.Lake(str(tmp_path / "lake"))
    loads.ensure_tables(spark, lake)
    return lake


def main_keys(spark, lake):
    return sorted(column(table.read(spark, lake.main), S.KEY))


def feed(spark):
    return raw(spark, raw_row("A", "2026-01-10T00:00:00"), raw_row("B", "2026-02-10T00:00:00"),
               raw_row("C", "2026-04-10T00:00:00"), raw_row("D", "2026-05-01T00:00:00"))


@pytest.mark.parametrize("at_once", [True, False])
def test_failed_chunk_does_not_stop_the_others(spark, lake, at_once):
    bad = raw(spark, raw_row("X", "2026-02-11T00:00:00", ward="12.0"))
    result = loads.backfill(spark, lake, feed(spark).unionByName(bad), date(2026, 1, 1),
                            date(2026, 5, 1), at_once=at_once)
    # February fails as a whole, March has no rows and is skipped, May is out of range
    assert (result.rows, result.failed) == (2, 1)
    assert result.failures[0][:2] == ("2026-02-01T00:00:00.000", "2026-03-01T00:00:00.000")
    assert main_keys(spark, lake) == ["A", "C"]


@pytest.mark.parametrize("at_once", [True, False])
def test_loading_a_year_twice_changes_nothing(spark, lake, at_once):
    def load():
        if at_once:
            return loads.yearly_load(spark, lake, feed(spark), 2026)
        year = date(2026, 1, 1), date(2027, 1, 1)
        return loads.backfill(spark, lake, feed(spark), *year, 4, at_once=False)

    assert load().rows == 4
    assert load().rows == 0
    assert main_keys(spark, lake) == ["A", "B", "C", "D"]


def test_daily_load(spark, lake):
    loads.yearly_load(spark, lake, feed(spark), 2026)
    now = datetime(2026, 6, 2)
    change = raw_row("A", "2026-01-10T00:00:00", "2026-06-01T10:00:00", status="Completed",
                     ward="9")
    new = raw_row("N", "2026-06-01T11:00:00")
    old = raw_row("O", "2026-03-01T00:00:00")
    day = raw(spark, change, new, old)
    assert loads.daily_load(spark, lake, day, now).rows == 2
    rows = {r[S.KEY]: r for r in table.read(spark, lake.main).collect()}
    assert sorted(rows) == ["A", "B", "C", "D", "N"]
    assert rows["A"]["current_status"] == "Completed" and rows["A"]["ward"] is None
    assert table.read(spark, lake.staging).count() == 0
    assert loads.daily_load(spark, lake, day, datetime(2026, 9, 1)) == loads.LoadResult()


def test_failed_audit_leaves_the_main_table_alone(spark, lake, monkeypatch):
    loads.yearly_load(spark, lake, feed(spark), 2026)
    monkeypatch.setattr(loads, "audit_passes", lambda *a: False)
    day = raw(spark, raw_row("N", "2026-06-01T11:00:00"))
    result = loads.incremental_load(spark, lake, day, datetime(2026, 6, 2))
    assert (result.rows, result.failed, result.failures[0][2]) == (0, 1, "audit failed")
    assert main_keys(spark, lake) == ["A", "B", "C", "D"]
    assert table.read(spark, lake.staging).count() == 0
    assert loads.watermark(spark, lake) is None


def test_watermark_advances_only_on_success(spark, lake, monkeypatch):
    first, second = datetime(2026, 3, 1), datetime(2026, 6, 1)
    assert loads.incremental_load(spark, lake, feed(spark), first).rows == 2
    assert loads.watermark(spark, lake) == first
    with monkeypatch.context() as m:
        m.setattr(loads, "merge_into", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loads.incremental_load(spark, lake, feed(spark), second)
    assert loads.watermark(spark, lake) == first
    assert loads.incremental_load(spark, lake, feed(spark), second).rows == 2
    assert loads.watermark(spark, lake) == second
    assert loads.incremental_load(spark, lake, feed(spark), datetime(2026, 7, 1)).rows == 0
    assert loads.watermark(spark, lake) == datetime(2026, 7, 1)


def test_landed_pages_are_taken_once(spark, lake, tmp_path):
    pages_dir, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    pages_dir.mkdir()

    def land(name, key, modified):
        (pages_dir / name).write_text(
            f'{{"sr_number":"{key}","created_date":"2026-01-10T00:00:00.000",'
            f'"last_modified_date":"{modified}","status":"{modified[:10]}"}}\n')

    def run():
        merge_landed_pages(spark, lake, str(pages_dir), checkpoint).awaitTermination(120)
        return {r[S.KEY]: r["current_status"] for r in table.read(spark, lake.main).collect()}

    land("1.json", "A", "2026-01-10T00:00:00")
    assert run() == {"A": "2026-01-10"}
    land("2.json", "A", "2026-01-12T00:00:00")
    land("3.json", "B", "2026-01-11T00:00:00")
    assert run() == {"A": "2026-01-12", "B": "2026-01-11"}
    number = table.snapshot(spark, lake.main).number
    assert run() == {"A": "2026-01-12", "B": "2026-01-11"}
    assert table.snapshot(spark, lake.main).number == number


BAD_DATES = ["2026-02-31T00:00:00", "soon", "", " 2026-02-11T00:00:00", "2026-02-11", None]


@pytest.mark.parametrize("at_once", [True, False])
def test_unreadable_dates_are_reported_and_the_rest_is_loaded(spark, lake, at_once):
    bad = [raw_row(f"X{i}", text, "2026-02-11T00:00:00") for i, text in enumerate(BAD_DATES)]
    result = loads.backfill(spark, lake, feed(spark).unionByName(raw(spark, *bad)), date(2026, 1, 1),
                            date(2026, 6, 1), at_once=at_once)
    assert (result.rows, result.failed) == (4, 1)
    assert result.failures[0][2].startswith("6 records with unreadable created_date")
    assert sorted(column(table.read(spark, lake.quarantine), "sr_number")) == [f"X{i}" for i in range(6)]
    assert main_keys(spark, lake) == ["A", "B", "C", "D"]
    # neither a clean load nor the same pages again change what is set aside
    loads.yearly_load(spark, lake, feed(spark), 2026, at_once)
    loads.backfill(spark, lake, raw(spark, *bad), date(2026, 1, 1), date(2026, 6, 1), at_once=at_once)
    assert sorted(column(table.read(spark, lake.quarantine), "sr_number")) == [f"X{i}" for i in range(6)]


def test_daily_load_sets_unreadable_changes_aside_and_reports_them(spark, lake):
    loads.backfill(spark, lake, raw(spark, raw_row("S", "soon")), date(2026, 1, 1), date(2026, 6, 1))
    rows = raw(spark, raw_row("N", "2026-06-01T11:00:00"), raw_row("M", "2026-06-01T11:00:00", "yesterday"))
    result = loads.daily_load(spark, lake, rows, datetime(2026, 6, 2))
    assert (result.rows, result.failed) == (1, 1)
    assert result.failures[0][2].startswith("1 records with unreadable last_modified_date")
    clean = loads.daily_load(spark, lake, raw(spark, raw_row("P", "2026-06-02T11:00:00")), datetime(2026, 6, 3))
    assert (clean.rows, clean.failed) == (1, 0)
    kept = {r["sr_number"]: r for r in table.read(spark, lake.quarantine).collect()}
    assert {k: r["reason"] for k, r in kept.items()} == {
        "S": "unreadable created_date", "M": "unreadable last_modified_date"}
    assert kept["S"]["created_date"] == "soon" and "2026-06-01" in kept["M"]["load"]


def test_watermark_may_pass_rejected_records_which_are_replayed(spark, lake):
    late = [raw_row("M", "2026-02-01T11:00:00", " 2026-02-01T12:00:00"), raw_row("W", "2026-02-01T11:00:00", "never"),
            raw_row("", "2026-02-01T11:00:00", "no key")]
    result = loads.incremental_load(spark, lake, feed(spark).unionByName(raw(spark, *late)), datetime(2026, 6, 1))
    assert (result.rows, result.failed) == (4, 1)
    assert loads.watermark(spark, lake) == datetime(2026, 6, 1)
    assert loads.incremental_load(spark, lake, feed(spark), datetime(2026, 7, 1)) == loads.LoadResult()

    def trimmed(bad):
        return bad.withColumn(S.VERSION, F.trim(S.VERSION))

    done = loads.replay(spark, lake, trimmed, "by hand")
    assert (done.rows, done.failed) == (1, 1) and done.failures[0][2].startswith("2 records")
    assert main_keys(spark, lake) == ["A", "B", "C", "D", "M"]
    assert sorted(column(loads.outstanding(spark, lake), "sr_number")) == ["", "W"]
    again = loads.replay(spark, lake, trimmed, "by hand")
    assert (again.rows, again.failed) == (0, 1) and table.read(spark, lake.quarantine).count() == 3


def test_a_replay_that_dies_before_its_note_is_repeated(spark, lake, monkeypatch):
    loads.backfill(spark, lake, raw(spark, raw_row("S", " 2026-02-01T11:00:00")), date(2026, 1, 1), date(2026, 6, 1))

    def trimmed(bad):
        return bad.withColumns({c: F.trim(c) for c in ("created_date", S.VERSION)})

    with monkeypatch.context() as m:
        m.setattr(loads.table, "append", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            loads.replay(spark, lake, trimmed, "first")
    assert main_keys(spark, lake) == ["S"] and loads.outstanding(spark, lake).count() == 1
    assert loads.replay(spark, lake, trimmed, "second").rows == 0
    assert loads.outstanding(spark, lake).count() == 0


def test_pages_are_read_once_per_load(spark, lake, tmp_path):
    path = str(tmp_path / "pages")
    pages.write_raw_pages(feed(spark).unionByName(raw(spark, raw_row("X", "soon"))), path)
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    landed = pages.read_raw_pages(spark, path)
    n = landed.count()
    counted = landed.withColumn("sr_type", F.udf(seen)("sr_type"))
    for at_once in (True, False):
        loads.backfill(spark, lake, counted, date(2026, 1, 1), date(2027, 1, 1), at_once=at_once)
    assert read.value == 2 * n


def test_a_bad_record_does_not_poison_the_feed(spark, lake, tmp_path):
    pages_dir, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    pages_dir.mkdir()

    def land(name, *records):
        (pages_dir / name).write_text("\n".join(json.dumps(r) for r in records))

    def run():
        merge_landed_pages(spark, lake, str(pages_dir), checkpoint).awaitTermination(120)
        return main_keys(spark, lake), sorted(column(loads.outstanding(spark, lake), "sr_number"))

    land("1.json", raw_row("A"), raw_row("B", "soon"), raw_row("C", ward="12.0"), raw_row("D", modified="x"))
    assert run() == (["A"], ["B", "C", "D"])
    land("2.json", raw_row("E", ""))
    assert run() == (["A"], ["B", "C", "D", "E"])
    land("3.json", raw_row("F"))
    assert run() == (["A", "F"], ["B", "C", "D", "E"])


def test_a_batch_that_died_is_taken_again_whole(spark, lake, tmp_path, monkeypatch):
    from ticketmill.streaming import feed as streams

    pages_dir, checkpoint = tmp_path / "pages", str(tmp_path / "checkpoint")
    pages_dir.mkdir()
    (pages_dir / "1.json").write_text("\n".join(json.dumps(r) for r in (raw_row("A"), raw_row("B", "soon"))))
    with monkeypatch.context() as m:
        m.setattr(streams, "merge_into", lambda *a: 1 / 0)
        with pytest.raises(Exception):
            merge_landed_pages(spark, lake, str(pages_dir), checkpoint).awaitTermination(120)
    assert main_keys(spark, lake) == [] and loads.outstanding(spark, lake).count() == 1
    merge_landed_pages(spark, lake, str(pages_dir), checkpoint).awaitTermination(120)
    assert main_keys(spark, lake) == ["A"] and loads.outstanding(spark, lake).count() == 1


def loaded(spark, lake, rows, at_once):
    result = loads.backfill(spark, lake, rows, date(2026, 1, 1), date(2026, 5, 1), at_once=at_once)
    stored = sorted(tuple(r) for r in table.read(spark, lake.main).select(
        S.KEY, "created_date", "ward", "current_status", S.VERSION).collect())
    return result.rows, result.failed, stored


def test_a_key_in_two_chunks_keeps_its_first_row(spark, lake):
    rows = raw(spark, raw_row("A", "2026-01-10T00:00:00", ward="1", status="Open"),
               raw_row("A", "2026-02-10T00:00:00", ward="2", status="Completed"))
    affected, _, stored = loaded(spark, lake, rows, True)
    assert affected == 2
    assert [(k, c.month, w, s, v.month) for k, c, w, s, v in stored] == [("A", 1, 1, "Completed", 2)]


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(st.sampled_from("ABC"), st.integers(1, 5), st.integers(1, 5),
                               st.sampled_from(["7", "8", "x"])), min_size=1, max_size=9))
def test_one_pass_gives_what_the_loop_gives(spark, tmp_path_factory, rows):
    # month 5 stands for an unreadable date, ward x for a field that fails its chunk
    data = [raw_row(k, "soon" if m == 5 else f"2026-0{m}-10T00:00:00", f"2026-0{v}-20T00:00:{i:02d}",
                    ward=w, status=f"S{v}") for i, (k, m, v, w) in enumerate(rows)]
    lakes = [loads.Lake(str(tmp_path_factory.mktemp("lake"))) for _ in range(2)]
    both = [loaded(spark, lake, raw(spark, *data), at_once) for lake, at_once in zip(lakes, (True, False))]
    assert both[0] == both[1]
    # and again onto what is stored, with everything one month older and the versions turned round
    data = [raw_row(k, f"2026-0{max(1, m - 1)}-10T00:00:00", f"2026-0{6 - v}-21T00:00:{i:02d}", status=f"T{v}")
            for i, (k, m, v, _) in enumerate(rows)]
    both = [loaded(spark, lake, raw(spark, *data), at_once) for lake, at_once in zip(lakes, (True, False))]
    assert both[0] == both[1]


def test_one_merge_whatever_the_chunks_of_a_key(spark, lake, monkeypatch):
    merges = []
    monkeypatch.setattr(loads, "merge_into", lambda *a, real=loads.merge_into: merges.append(1) or real(*a))
    rows = [raw_row("A", f"2026-{m:02d}-10T00:00:00", f"2026-{m:02d}-{d:02d}T00:00:00", status=f"S{m}.{d}")
            for m in range(1, 13) for d in (10, 11)]
    # older than what is stored by then, and without a version
    rows += [raw_row("B", "2026-01-10T00:00:00", "2026-09-01T00:00:00", status="new"),
             raw_row("B", "2026-02-10T00:00:00", "2026-08-01T00:00:00", status="old"),
             raw_row("B", "2026-03-10T00:00:00", "2026-10-01T00:00:00", status="newest"),
             raw_row("N", "2026-01-10T00:00:00"), raw_row("N", "2026-05-10T00:00:00", status="moved")]
    result = loads.yearly_load(spark, lake, raw(spark, *rows), 2026)
    assert len(merges) == 1 and (result.rows, result.failed) == (12 + 2 + 2, 0)
    got = {r[S.KEY]: (r["created_date"].month, r["current_status"]) for r in table.read(spark, lake.main).collect()}
    assert got == {"A": (1, "S12.11"), "B": (1, "newest"), "N": (1, "moved")}


def test_only_rows_of_repeated_keys_are_sorted_out(spark, lake):
    rows = [ticket(f"S{k}") for k in range(40)]
    rows += [ticket("T", ward=w) for w in (1, 2, 3)]  # a tie
    rows += [ticket("N", ward=4) | {S.VERSION: None}, ticket("N", ward=5) | {S.VERSION: None},
             ticket("M", ward=6) | {S.VERSION: None}, ticket("M", modified="2026-03-01 00:00:00", ward=7)]
    table.overwrite(spark, lake.staging, tickets(spark, *rows))
    source = table.read(spark, lake.staging)
    with publish._counted(spark, source, S.KEY) as (keys, bounds):
        assert (bounds["low"], bounds["high"], bounds["n"], bounds["repeated"]) == ("M", "T", 43, 3)
        single, several = publish.split_repeated(source, keys, bounds["repeated"])
        assert (single.count(), several.count()) == (40, 7)
        plan = single._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Exchange hash" not in plan and "Sort" not in plan
        both = single.unionByName(publish.as_steps(several, None).drop("_steps"))
        assert sorted(both.collect(), key=str) == sorted(wap.latest_wins(source).collect(), key=str)


def test_folding_steps(spark):
    def at(day):
        return None if day is None else datetime(2026, 1, day)

    steps = [(9, "a"), (None, "b"), (9, "c"), (12, "d"), (11, "e"), (13, "f")]
    row = {c: None for c in S.MERGE_UPDATES}
    data = [{**row, S.VERSION: at(d), "current_status": n} for d, n in steps]
    frame = spark.createDataFrame([(data,)], f"s {publish.STEPS}")
    for day, n, last in ((1, 3, "f"), (10, 2, "f"), (20, 0, None), (None, 0, None)):
        made = frame.select(publish.folded(F.lit(at(day)).cast("timestamp_ntz"), F.col("s")).alias("f")).first()["f"]
        assert (made["n"], made["last"] and made["last"]["current_status"]) == (n, last)
