"""Flat exports of result frames."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(frame: DataFrame, path: str) -> None:
    """CSV files with a header, one per partition of the frame; quotes are doubled."""
    frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
