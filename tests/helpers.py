"""Small literal frames for the edge cases."""

from __future__ import annotations

from datetime import datetime

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from ticketmill import schemas as S

T = datetime.fromisoformat


def local(spark, rows: list[dict], schema):
    """Rows handed over as Arrow, which needs no Python workers."""
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=to_arrow_schema(schema)))


def raw(spark, *rows: dict):
    """All-text records; fields not given are absent (null)."""
    return local(spark, [{f: r.get(f) for f in S.RAW_SCHEMA.names} for r in rows], S.RAW_SCHEMA)


def raw_row(key="SR1", created="2026-01-15T10:30:00.000", modified=None, **more) -> dict:
    return {"sr_number": key, "created_date": created,
            "last_modified_date": modified or created, **more}


def tickets(spark, *rows: dict):
    """Typed tickets; times may be ISO text."""
    def value(r, f):
        v = r.get(f.name)
        return T(v) if f.name in S.TIMESTAMPS and isinstance(v, str) else v

    return local(spark, [{f.name: value(r, f) for f in S.TYPED_SCHEMA} for r in rows],
                 S.TYPED_SCHEMA)


def ticket(key="SR1", created="2026-01-15 10:30:00", modified=None, **more) -> dict:
    return {"service_request_number": key, "created_date": created,
            "last_modified_date": modified or created, "legacy_record": False,
            "current_status": "Open", "sr_type": "Pothole", "owner_department": "Roads",
            "community_area": 1, **more}


def as_dicts(df, *columns):
    return [r.asDict() for r in (df.select(*columns) if columns else df).collect()]


def column(df, name):
    return [r[0] for r in df.select(name).collect()]
