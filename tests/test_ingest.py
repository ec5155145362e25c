from __future__ import annotations

from datetime import datetime

import pytest
from helpers import as_dicts, column, raw, raw_row
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import text
from ticketmill.operators import ingest
from ticketmill.sources import pages


def test_missing_columns_become_typed_nulls(spark):
    three = spark.createDataFrame(
        [("SR1", "2026-01-15T10:30:00.000", "2026-01-15T10:30:00.000")],
        "sr_number string, created_date string, last_modified_date string")
    out = ingest.typed_tickets(three)
    assert out.schema.simpleString() == S.TYPED_SCHEMA.simpleString()
    assert out.columns == list(S.TYPED_COLUMNS) and len(out.columns) == 35
    assert out.first()["closed_date"] is None


def test_key_filter_and_trim(spark):
    keys = ["SR1", "", None, "   ", "\tSR2 ", " SR3 "]
    out = ingest.typed_tickets(raw(spark, *[raw_row(k) for k in keys]))
    # keys are trimmed before the filter, so a key of blanks is dropped as well
    assert sorted(column(out, S.KEY)) == ["SR1", "SR2", "SR3"]


@pytest.mark.parametrize(("given", "expected"), [
    ("true", True), ("false", False), ("True", False), ("", False), ("1", False), (None, None)])
def test_flags(spark, given, expected):
    out = ingest.typed_tickets(raw(spark, raw_row(duplicate=given, legacy_record=given)))
    assert tuple(out.select("duplicate", "legacy_record").first()) == (expected, expected)


def test_empty_input(spark):
    out = ingest.typed_tickets(raw(spark, raw_row()).limit(0))
    assert out.count() == 0 and len(out.columns) == 35


def test_calendar_parts(spark):
    out = ingest.typed_tickets(raw(
        spark, raw_row("A", "2026-01-15T00:00:00.000"), raw_row("B", "2026-04-16T23:59:59")))
    got = {r[0]: tuple(r[1:]) for r in out.select(S.KEY, *S.CALENDAR_PARTS).collect()}
    assert got == {"A": (2026, 1, 4), "B": (2026, 4, 4)}  # both are Thursdays


@pytest.mark.parametrize(("given", "expected"), [
    ("2026-01-15T10:30:00", datetime(2026, 1, 15, 10, 30)),
    ("2026-01-15T10:30:00.5", datetime(2026, 1, 15, 10, 30, 0, 500000)),
    ("2026-01-15T10:30:00.123456", datetime(2026, 1, 15, 10, 30, 0, 123456)),
    ("", None), (None, None)])
def test_closed_date(spark, given, expected):
    out = ingest.typed_tickets(raw(spark, raw_row(closed_date=given)))
    assert out.first()["closed_date"] == expected


@pytest.mark.parametrize("bad", [
    {"created_date": "2026-01-15"}, {"created_date": "soon"}, {"created_date": ""},
    {"closed_date": "2026-13-01T00:00:00"}, {"community_area": "12.0"}, {"latitude": "north"}])
def test_bad_text_fails_the_strict_step(spark, bad):
    frame = raw(spark, raw_row() | bad)
    with pytest.raises(Exception):
        ingest.typed_tickets(frame).collect()
    lenient = ingest.lenient_tickets(frame)
    assert lenient.first()["parse_errors"] == 1
    assert lenient.columns == [*S.TYPED_COLUMNS, "parse_errors"]


def test_lenient_equals_strict_on_good_rows(spark):
    frame = raw(spark, raw_row(ward="7", community_area="", latitude="41.5", x_coordinate="",
                               closed_date="", zip_code="", origin="web", duplicate="true"))
    strict, lenient = ingest.typed_tickets(frame), ingest.lenient_tickets(frame)
    assert lenient.first()["parse_errors"] == 0
    assert strict.collect() == lenient.drop("parse_errors").collect()


def test_blanks(spark):
    blanks = {c: "" for c in (*S.BLANK_IS_NULL, "community_area", "ward", "created_hour",
                              "latitude", "x_coordinate")}
    kept = {"owner_department": "", "sr_type": "", "status": ""}
    row = ingest.typed_tickets(raw(spark, raw_row(**blanks, **kept))).first()
    assert all(row[c] is None for c in blanks)
    # these three have no blank step
    assert (row["owner_department"], row["sr_type"], row["current_status"]) == ("", "", "")


def test_trim_all_keeps_inner_blanks(spark):
    frame = spark.createDataFrame([("  a b\n",)], "t string")
    assert column(frame.select(text.trim_all(frame.t).alias("t")), "t") == ["a b"]


def test_date_range_is_half_open_for_text_with_and_without_fraction(spark):
    times = ["2026-01-31T23:59:59.999", "2026-02-01T00:00:00", "2026-02-01T00:00:00.000",
             "2026-02-28T23:59:59.9", "2026-03-01T00:00:00", "2026-03-01T00:00:00.000"]
    frame = raw(spark, *[raw_row(str(i), t) for i, t in enumerate(times)])
    out = pages.date_range(frame, "created_date", "2026-02-01T00:00:00.000",
                           "2026-03-01T00:00:00.000")
    assert sorted(column(out, "sr_number")) == ["1", "2", "3"]
    typed = ingest.typed_tickets(frame)
    same = pages.date_range(typed, "created_date", "2026-02-01T00:00:00",
                            "2026-03-01T00:00:00")
    assert sorted(column(same, S.KEY)) == ["1", "2", "3"]


def test_pages_leave_out_nulls_and_drop_unknown_fields(spark, tmp_path):
    path = str(tmp_path / "page")
    (tmp_path / "page").mkdir()
    (tmp_path / "page" / "1.json").write_text(
        '{"sr_number":"SR1","created_date":"2026-01-15T10:30:00.000","mood":"x"}\n'
        '{"sr_number":"SR2","location":{"lat":1},"ward":"3"}\n')
    rows = as_dicts(pages.read_raw_pages(spark, path), "sr_number", "created_date", "ward")
    assert sorted(r["sr_number"] for r in rows) == ["SR1", "SR2"]
    assert "mood" not in pages.read_raw_pages(spark, path).columns


def test_landed_pages_take_few_bytes_and_stay_short(spark, tmp_path):
    rows = raw(spark, *[raw_row(f"SR{i}", f"2026-01-{i % 28 + 1:02d}T10:30:00.000", ward=str(i % 50), status="Open")
                        for i in range(5000)], raw_row(None, "", status='a "b"\n\u2003'), raw_row("\tSR1\u2003"))
    path = tmp_path / "pages"
    pages.write_raw_pages(rows, str(path), page_rows=1000)
    files = [f for f in path.iterdir() if f.name.startswith("part-")]
    landed = pages.read_raw_pages(spark, str(path))
    assert sorted(landed.collect(), key=str) == sorted(rows.collect(), key=str)
    assert max(column(landed.groupBy(F.input_file_name()).count(), "count")) <= 1000
    text_bytes = sum(len(t) for t in column(landed.select(F.to_json(F.struct("*")).alias("t")), "t"))
    assert sum(f.stat().st_size for f in files) < text_bytes / 4
