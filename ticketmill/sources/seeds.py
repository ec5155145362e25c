"""Reference CSVs with header and quoting; ``#`` starts a comment line."""

from __future__ import annotations

import csv
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ticketmill import schemas as S

PACKAGED = Path(__file__).resolve().parent.parent / "seeds"


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Multi-line values are allowed, since a boundary's text may be wrapped."""
    return (
        spark.read.schema(schema).option("header", True).option("quote", '"')
        .option("escape", '"').option("comment", "#").option("multiLine", True)
        .option("mode", "FAILFAST").csv(path)
    )


def sla_targets(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _seed(spark, path, "sla_targets.csv", S.SLA_TARGETS_SCHEMA)


def department_metadata(spark: SparkSession, path: str | None = None) -> DataFrame:
    return _seed(spark, path, "department_metadata.csv", S.DEPARTMENTS_SCHEMA)


def community_areas(spark: SparkSession, path: str) -> DataFrame:
    """Areas have no packaged file; their boundaries come from the city's own data."""
    return read_seed(spark, path, S.AREAS_SCHEMA)


def _seed(spark: SparkSession, path: str | None, name: str, schema: str) -> DataFrame:
    """A packaged seed is read on the driver, as executors may not have the file."""
    if path is not None:
        return read_seed(spark, path, schema)
    with (PACKAGED / name).open(encoding="utf-8", newline="") as lines:
        rows = list(csv.DictReader(line for line in lines if not line.startswith("#")))
    text = spark.createDataFrame(pa.Table.from_pylist(rows))
    wanted = [field.split() for field in schema.split(", ")]
    return text.select(*[text[column].cast(kind) for column, kind in wanted])
