from __future__ import annotations

import pytest
from helpers import as_dicts, column
from pyspark.sql import functions as F

from ticketmill.functions import labels
from ticketmill.operators import equity_board as equity
from ticketmill.operators import operations_board as board
from ticketmill.sources import export, seeds

OPS = ("service_request_number string, department_name string, priority_level string, "
       "days_open bigint, days_until_breach bigint, triage_status string, status_name string, "
       "created_date date")


def ops(spark, *rows):
    """rows: (key, department, priority, days open, days left)"""
    df = spark.createDataFrame([(k, d, p, o, left, None, "Open", None) for k, d, p, o, left in rows], OPS)
    return df.withColumn("triage_status", labels.triage(F.col("days_until_breach")))


@pytest.mark.parametrize(("days", "open_ranges", "closed_ranges"), [
    (-1, "0-3 days", "15+ days"), (0, "0-3 days", "0-3 days"), (3, "0-3 days", "0-3 days"),
    (4, "4-7 days", "4-7 days"), (7, "4-7 days", "4-7 days"), (8, "8-14 days", "8-14 days"),
    (14, "8-14 days", "8-14 days"), (15, "15+ days", "15+ days"), (None, "15+ days", "15+ days")])
def test_age_buckets(spark, days, open_ranges, closed_ranges):
    df = spark.createDataFrame([(days,)], "n bigint")
    row = df.select(labels.age_bucket(df.n), labels.age_bucket_closed(df.n)).first()
    assert tuple(row) == (open_ranges, closed_ranges)


def test_pivot_has_all_labels_and_zeroes(spark):
    mart = ops(spark, ("A", "Roads", "High", 1, -1), ("B", "Roads", "High", 1, -1), ("C", None, "Low", 1, 9))
    got = {r["department_name"]: tuple(r[c] for c in labels.TRIAGE) for r in as_dicts(board.triage_pivot(mart))}
    assert got == {"Roads": (2, 0, 0, 0), None: (0, 0, 0, 1)}


def test_orders(spark):
    mart = ops(spark, ("A", "x", "Low", 5, 1), ("B", "x", "Critical", None, None),
               ("C", "y", "High", 9, -4), ("D", "y", None, 9, -4), ("E", "z", "Medium", 0, 3))
    assert column(board.by_priority(mart), "priority_level") == [None, "Critical", "High", "Low", "Medium"]
    assert column(board.by_priority(mart, ranked=True), "priority_level") == [
        None, "Critical", "High", "Medium", "Low"]
    assert column(board.by_age_closed_ranges(mart), "age_bucket") == [
        "0-3 days", "4-7 days", "8-14 days", "15+ days"]
    assert column(board.oldest_open(mart.withColumn("request_type_name", F.lit("t")), 3),
                  "service_request_number") == ["B", "C", "D"]
    near = mart.withColumns({"request_type_name": F.lit("t"), "community_area_name": F.lit("a")})
    assert column(board.nearest_breach(near, 3), "service_request_number") == ["B", "C", "D"]
    assert column(board.triage_sums(mart), "department_name") == ["y", "x", "z"]


def test_filters(spark):
    mart = ops(spark, ("A", "x", "Low", 5, 1), ("B", "y", "High", 5, 1))
    assert board.choose(mart, department_name="All", priority_level=None).count() == 2
    assert column(board.choose(mart, department_name="y"), "service_request_number") == ["B"]
    assert board.choose_many(mart, department_name=[], priority_level=["Low", "High"]).count() == 2


def perf(spark, *rows):
    """rows: (area, type, department, total, breached, rate, days, city days, index)"""
    df = spark.createDataFrame(rows, "community_area_name string, request_type_name string, "
                               "department_name string, area_total_requests bigint, area_breached_requests bigint, "
                               "area_breach_rate double, area_avg_resolution_days double, "
                               "citywide_avg_resolution_days double, equity_index double")
    return df.withColumn("equity_status", labels.equity(F.col("equity_index")))


def test_rates_weighted_and_unweighted(spark):
    mart = perf(spark, ("a", "t", "d", 10, 10, 1.0, 2.0, 2.0, 1.0), ("b", "t", "d", 90, 0, 0.0, 4.0, 2.0, 2.0))
    assert equity.kpis(mart).first()["avg_breach_rate"] == 0.5
    assert equity.breach_rate(mart).first()[0] == 10.0
    assert equity.department_breach(mart).first()["breach_rate"] == 0.1


def test_summary_shares_and_order(spark):
    mart = perf(spark, ("a", "t", "d", 10, 1, .1, 2.0, 2.0, 0.5), ("a", "u", "d", 10, 1, .1, 4.0, 2.0, 1.3),
                ("b", "t", "d", 10, 1, .1, 4.0, 2.0, 1.4), ("c", "t", "d", 9, 1, .1, 4.0, 2.0, 1.4),
                ("c", "v", "d", 10, 1, .1, 4.0, 2.0, None))
    got = [tuple(r) for r in equity.equity_summary(mart).collect()]
    assert got == [(labels.SEVERE, 2, 50.0, 4.0), (labels.EQUITABLE, 1, 25.0, 4.0), (labels.OVER, 1, 25.0, 2.0)]
    assert equity.completion_rate(mart).first()[0] == 80.0


def test_empty_mart(spark):
    none = perf(spark)
    assert equity.breach_rate(none).first()[0] is None and equity.completion_rate(none).first()[0] is None
    assert equity.equity_summary(none).count() == 0


def test_prior_month_skips_gaps(spark):
    sla = spark.createDataFrame(
        [("2026-01-05", 2, True), ("2026-01-20", 4, False), ("2026-02-03", 5, False), ("2026-04-01", 1, False)],
        "closed_date string, resolution_days bigint, is_breached boolean").withColumn(
        "closed_date", F.to_date("closed_date"))
    got = {str(r["period_month"])[:7]: r for r in as_dicts(equity.scorecard_delta(sla))}
    assert got["2026-02"]["avg_resolution_days_delta"] == 2.0 and got["2026-02"]["breach_rate_delta"] == -0.5
    assert got["2026-01"]["completed_delta"] is None and got["2026-04"]["completed_delta"] is None


@pytest.mark.parametrize(("index", "rate", "bands"), [
    (1.26, 0.16, ("Red", "Red")), (1.25, 0.15, ("Orange", "Orange")), (1.10, 0.10, ("Orange", "Orange")),
    (1.09, 0.09, ("Yellow", "Green")), (0.90, 0.0, ("Yellow", "Green")), (0.89, None, ("Green", None))])
def test_bands(spark, index, rate, bands):
    df = spark.createDataFrame([(index, rate)], "equity_index double, area_breach_rate double")
    assert tuple(equity.with_bands(df).select("equity_band", "breach_band").first()) == bands


def test_csv_export(spark, tmp_path):
    row = ('a, "b"\nc', 1, None)
    export.write_csv(spark.createDataFrame([row], "t string, n int, x string"), str(tmp_path / "x"))
    back = seeds.read_seed(spark, str(tmp_path / "x"), "t string, n int, x string")
    assert [tuple(r) for r in back.collect()] == [row]
