"""Shared helpers: inputs with any extra columns, and tables kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.session import shared_dir

#: White space of the contracts: space and the controls from tab to carriage return.
WHITE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns. Names match exactly and by place, so extra columns, also ones
    that differ only in case or come twice, are never ambiguous."""
    placed = df.toDF(*(f"c{i}" for i in range(len(df.columns))))
    return placed.select(*(F.col(f"c{df.columns.index(n)}").alias(n) for n in names))


def add(df: DataFrame, reserved: str, **made: Column) -> DataFrame:
    """The columns of ``df`` but those starting with ``reserved`` or named in ``made``, then
    ``made``."""
    keep = [c for c in df.columns if not c.startswith(reserved) and c not in made]
    return df.select(*(df[f"`{c}`"] for c in keep), *(v.alias(k) for k, v in made.items()))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: steps that must agree see the
    same rows, lineage is cut, and a lost executor costs no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this subpackage to the Python workers, once per application. Spark's own file server
    passes the archive on, so executors need neither the sources nor a shared folder."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="run-ticketmill-")) / "ticketmill_llm.zip"
    with zipfile.ZipFile(archive, "w") as z:
        shared = ("__init__.py", "session.py", "operators/__init__.py", "operators/joins.py")
        for f in [*(top / name for name in shared), *sorted((top / "llm").glob("*.py"))]:
            z.write(f, f"{top.name}/{f.relative_to(top)}")
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
