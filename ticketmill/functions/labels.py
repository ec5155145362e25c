"""Label expressions: triage, age, equity and traffic-light bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The labels dashboards filter on, in rank order.
OVERDUE, DUE_TODAY, AT_RISK, ON_TRACK = TRIAGE = (
    "1 - Overdue", "2 - Due Today", "3 - At Risk", "4 - On Track",
)
PRIORITIES = ("Critical", "High", "Medium", "Low")
AGE_BUCKETS = ("0-3 days", "4-7 days", "8-14 days", "15+ days")
SEVERE, UNDER, EQUITABLE, OVER = EQUITY = (
    "Severely Underserved (25%+ Slower)",
    "Underserved (10-24% Slower)",
    "Equitable (Average)",
    "Over-served (Faster than Average)",
)
EQUITY_SHORT = ("Severely Underserved", "Underserved", "Equitable", "Over-served")

COMPLETED = "Completed"


def triage(days_left: Column) -> Column:
    """No target means no deadline, hence on track."""
    return (
        F.when(days_left < 0, OVERDUE)
        .when(days_left == 0, DUE_TODAY)
        .when(days_left <= 2, AT_RISK)
        .otherwise(ON_TRACK)
    )


def age_bucket(days: Column) -> Column:
    """Upper bounds only: a negative age is young, an unknown age is old."""
    return (
        F.when(days <= 3, AGE_BUCKETS[0])
        .when(days <= 7, AGE_BUCKETS[1])
        .when(days <= 14, AGE_BUCKETS[2])
        .otherwise(AGE_BUCKETS[3])
    )


def age_bucket_closed(days: Column) -> Column:
    """Closed ranges: negative and unknown ages both fall into the last bucket."""
    return (
        F.when(days.between(0, 3), AGE_BUCKETS[0])
        .when(days.between(4, 7), AGE_BUCKETS[1])
        .when(days.between(8, 14), AGE_BUCKETS[2])
        .otherwise(AGE_BUCKETS[3])
    )


def equity(index: Column, names: Sequence[str] = EQUITY) -> Column:
    severe, under, equitable, over = names
    return (
        F.when(index >= 1.25, severe)
        .when(index >= 1.10, under)
        .when(index <= 0.90, over)
        .otherwise(equitable)
    )


def rank_in(c: Column, ordered: Sequence[str]) -> Column:
    """1-based position of a label, null for any other value."""
    out = None
    for i, label in enumerate(ordered, 1):
        out = F.when(c == label, i) if out is None else out.when(c == label, i)
    return out.cast("bigint")


def deadline_band(days_left: Column) -> Column:
    return F.when(days_left < 0, "Red").when(days_left <= 2, "Orange").when(days_left > 2, "Green")


def triage_band(status: Column) -> Column:
    return F.when(status == OVERDUE, "Red").when(status == DUE_TODAY, "Yellow")


def equity_band(index: Column, cuts: Sequence[float] = (0.90, 1.10, 1.25)) -> Column:
    green, yellow, orange = cuts
    return (
        F.when(index > orange, "Red")
        .when(index >= yellow, "Orange")
        .when(index >= green, "Yellow")
        .when(index < green, "Green")
    )


def breach_band(rate: Column, cuts: Sequence[float] = (0.10, 0.15)) -> Column:
    low, high = cuts
    return F.when(rate > high, "Red").when(rate >= low, "Orange").when(rate < low, "Green")
