"""MULTIPOLYGON text to nested arrays, with built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT_TYPE = "struct<lon:double,lat:double>"
SHAPE_TYPE = f"array<array<array<{POINT_TYPE}>>>"

_OPEN = r"(?i)^\s*MULTIPOLYGON\s*\(\s*\(\s*\("
_CLOSE = r"\)\s*\)\s*\)\s*$"
_EMPTY = r"(?i)^\s*MULTIPOLYGON\s+EMPTY\s*$"


def _point(text: Column) -> Column:
    """Two numbers; the strict cast rejects stray brackets and words."""
    xy = F.split(F.trim(text), r"\s+")
    return F.when(
        F.size(xy) == 2,
        F.struct(xy[0].cast("double").alias("lon"), xy[1].cast("double").alias("lat")),
    ).otherwise(F.raise_error(F.concat(F.lit("not a point: "), text)).cast(POINT_TYPE))


def _ring(text: Column) -> Column:
    return F.transform(F.split(text, ","), _point)


def _polygon(text: Column) -> Column:
    return F.transform(F.split(text, r"\)\s*,\s*\("), _ring)


def multipolygon(wkt: Column) -> Column:
    """Polygons of rings of points; raises on any other text, null stays null.

    Structure is split off level by level instead of matched by one pattern: a boundary has
    thousands of points, and a repeated regex group would recurse once per point.
    """
    body = F.regexp_replace(F.regexp_replace(wkt, _OPEN, ""), _CLOSE, "")
    parsed = F.transform(F.split(body, r"\)\s*\)\s*,\s*\(\s*\("), _polygon)
    wrong = F.raise_error(F.concat(F.lit("not a MULTIPOLYGON: "), F.substring(wkt, 1, 80)))
    return (
        F.when(wkt.isNull(), F.lit(None).cast(SHAPE_TYPE))
        .when(wkt.rlike(_EMPTY), F.array().cast(SHAPE_TYPE))
        .when(wkt.rlike(_OPEN) & wkt.rlike(_CLOSE), parsed)
        .otherwise(wrong.cast(SHAPE_TYPE))
    )


def points(shape: Column) -> Column:
    """All points of a parsed shape as one flat array."""
    return F.flatten(F.flatten(shape))


# --- rings -----------------------------------------------------------------------------

def signed_area(ring: Column) -> Column:
    """Twice the area that a closed ring of degrees encloses on a plane: positive if it runs
    counter-clockwise, 0 if its points lie on a line. One pass over the ring."""
    steps = F.when(F.size(ring) > 1, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(F.array().cast("array<int>"))

    def add(total: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        # relative to the first point, so that small rings far from the origin keep their digits
        o = F.get(ring, F.lit(0))
        return total + ((a["lon"] - o["lon"]) * (b["lat"] - o["lat"])
                        - (b["lon"] - o["lon"]) * (a["lat"] - o["lat"]))

    return F.aggregate(steps, F.lit(0.0), add)


def ring_fault(ring: Column) -> Column:
    """Why a ring bounds no region, or null: four points at least, all of them finite and on the
    globe, the last one equal to the first, three of them different and not on a line."""
    def off(p: Column) -> Column:
        fine = F.coalesce((F.abs(p["lon"]) <= 180) & (F.abs(p["lat"]) <= 90), F.lit(False))
        return ~fine | F.isnan(p["lon"]) | F.isnan(p["lat"])

    return (
        F.when(F.size(ring) < 4, "fewer than four points")
        .when(F.exists(ring, off), "a point that is not on the globe")
        .when(~F.get(ring, F.lit(0)).eqNullSafe(F.element_at(ring, -1)), "not closed")
        .when(F.size(F.array_distinct(ring)) < 3, "fewer than three different points")
        .when(signed_area(ring) == 0, "all points on a line")
    )


def checked(shape: Column, name: Column) -> Column:
    """The parsed ``shape``, of rings that each bound a region; the error for another one tells the
    area's ``name``, the polygon and the ring (both from 1)."""
    def ring(r: Column, polygon: Column, place: Column) -> Column:
        where = F.concat(F.coalesce(name.cast("string"), F.lit("an area without name")), F.lit(", polygon "),
                         (polygon + 1).cast("string"), F.lit(", ring "), (place + 1).cast("string"), F.lit(": "))
        fault = ring_fault(r)
        wrong = F.raise_error(F.concat(F.lit("boundary of "), where, fault))
        return F.when(fault.isNull(), r).otherwise(wrong.cast(f"array<{POINT_TYPE}>"))

    return F.transform(shape, lambda p, i: F.transform(p, lambda r, j: ring(r, i, j)))


def oriented(shape: Column) -> Column:
    """The shape with outer rings counter-clockwise and holes clockwise, as readers of boundaries
    expect that take the region to lie on the left."""
    def turned(ring: Column, place: Column) -> Column:
        outer, left = place == 0, signed_area(ring) > 0
        return F.when(outer == left, ring).otherwise(F.reverse(ring))

    return F.transform(shape, lambda p: F.transform(p, turned))
