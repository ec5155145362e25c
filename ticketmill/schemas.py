"""Column sets and types of the ticket model."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

KEY = "service_request_number"
VERSION = "last_modified_date"

# Field names of the landed all-text records.
RAW_FIELDS = (
    "sr_number", "sr_type", "sr_short_code", "owner_department", "status", "origin",
    "created_date", "last_modified_date", "closed_date", "street_address", "city", "state",
    "zip_code", "street_number", "street_direction", "street_name", "street_type",
    "duplicate", "legacy_record", "community_area", "ward", "police_sector",
    "police_district", "police_beat", "precinct", "created_hour", "created_day_of_week",
    "x_coordinate", "y_coordinate", "latitude", "longitude", "created_department",
    "electrical_district", "electricity_grid", "parent_sr_number",
)
RENAMES = {"sr_number": KEY, "status": "current_status"}

RAW_SCHEMA = StructType([StructField(n, StringType()) for n in RAW_FIELDS])

#: A rejected record as it landed, its digest, and the load and reason that set it aside.
REJECTED_SCHEMA = StructType([*RAW_SCHEMA.fields, *(StructField(n, StringType()) for n in ("record", "load", "reason"))])
REPLAYED_SCHEMA = StructType([StructField(n, StringType()) for n in ("record", "load")])

# The typed ticket, in column order; everything else in it is text.
TYPED_COLUMNS = (
    "service_request_number", "created_date", "closed_date", "sr_type", "sr_short_code",
    "current_status", "origin", "owner_department", "created_department", "street_address",
    "zip_code", "street_number", "street_direction", "street_name", "street_type",
    "community_area", "ward", "police_sector", "police_district", "police_beat", "precinct",
    "created_year", "created_month", "created_hour", "created_day_of_week",
    "x_coordinate", "y_coordinate", "latitude", "longitude", "duplicate", "legacy_record",
    "electrical_district", "electricity_grid", "parent_sr_number", "last_modified_date",
)
TIMESTAMPS = ("created_date", "closed_date", "last_modified_date")
CALENDAR_PARTS = ("created_year", "created_month", "created_day_of_week")
INTEGERS = ("community_area", "ward", "created_hour")
DOUBLES = ("x_coordinate", "y_coordinate", "latitude", "longitude")
FLAGS = ("duplicate", "legacy_record")

# Text columns whose '' means "absent". Key, type, status and owner are not among them.
BLANK_IS_NULL = (
    "zip_code", "sr_short_code", "origin", "created_department", "street_address",
    "street_number", "street_direction", "street_name", "street_type", "police_sector",
    "police_district", "police_beat", "precinct", "electrical_district",
    "electricity_grid", "parent_sr_number",
)

# The only columns a newer version of a stored ticket may change.
MERGE_UPDATES = (
    "current_status", "closed_date", "last_modified_date", "duplicate",
    "parent_sr_number", "owner_department",
)


def _type_of(name: str) -> DataType:
    if name in TIMESTAMPS:
        return TimestampNTZType()
    if name in INTEGERS or name in CALENDAR_PARTS:
        return LongType()
    if name in DOUBLES:
        return DoubleType()
    if name in FLAGS:
        return BooleanType()
    return StringType()


TYPED_SCHEMA = StructType([StructField(n, _type_of(n)) for n in TYPED_COLUMNS])

#: The changeable columns as one value.
STEP_TYPE = StructType([TYPED_SCHEMA[c] for c in MERGE_UPDATES]).simpleString()

SLA_TARGETS_SCHEMA = "sr_type string, target_days bigint, priority string, sla_target_source string"
DEPARTMENTS_SCHEMA = "owner_department string, display_name string, bureau string"
AREAS_SCHEMA = (
    "area_number string, area_name string, side string, the_geom string, "
    "shape_area string, shape_len string"
)
