"""Range layout of stored parts on an interleaved key.

A table sorted by several columns in turn helps readers that filter on the first one only. Here the
bits of all of them are interleaved (Z-order): rows near each other in every column come to lie in
one file, so each file has a narrow range in each column, and a filter on any of them leaves row
groups unread.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.sources import table

#: Bits per column, and bytes that a file of the new layout should have.
BITS, FILE_BYTES = 5, 128 * 1024 * 1024


def cut_points(rows: DataFrame, columns: Sequence[str], bits: int = BITS) -> list[list]:
    """For each column the values that cut its rows into 2 ** bits runs of like size, from one
    pass. A value that many rows hold makes several runs one."""
    shares = [k / 2**bits for k in range(1, 2**bits)]
    found = rows.agg(*[F.percentile_approx(c, shares, 1000 * 2**bits).alias(c) for c in columns]).first()
    return [sorted(set(found[c] or [])) for c in columns]


def interleaved(columns: Sequence[str], cuts: Sequence[Sequence], bits: int = BITS) -> Column:
    """The columns' runs (null: the lowest) with their bits in turn, the highest first. Where there
    are fewer runs they are spread, so that every column's first bit halves its rows."""
    z = F.lit(0).cast("bigint")
    runs = [F.floor(_passed(F.col(c), points) * (2**bits / (len(points) + 1))).cast("bigint")
            for c, points in zip(columns, cuts)]
    for bit in range(bits - 1, -1, -1):
        for run in runs:
            z = F.shiftleft(z, 1).bitwiseOR(F.shiftright(run, bit).bitwiseAND(F.lit(1).cast("bigint")))
    return z


def _passed(value: Column, points: Sequence) -> Column:
    """How many of the sorted ``points`` the value has reached, by halving; 0 for null."""
    if not points:
        return F.lit(0)
    half = len(points) // 2
    return F.when(value >= F.lit(points[half]), F.lit(half + 1) + _passed(value, points[half + 1:])).otherwise(
        _passed(value, points[:half]))


def recluster(spark: SparkSession, root: str, parts: Iterable[str] | None = None,
              columns: Sequence[str] | None = None, file_bytes: int = FILE_BYTES) -> int:
    """Write parts of a stored table anew, in files of about ``file_bytes``, each a range of (part,
    interleaved ``columns``); by default all parts, by the columns that the table is sorted by. The
    rows stay as they are. Returns the number of files.

    Meant to run apart from loads, on parts that have settled. Rows are dealt by sampled ranges, so
    a part of any size is as many tasks and files as its bytes need.
    """
    base = table.snapshot(spark, root)
    columns = list(columns or base.layout.cluster_by)
    chosen = sorted(set(base.parts) & set(base.parts if parts is None else parts))
    if not chosen:
        return 0
    rows = table.read(spark, root, chosen, snap=base)
    z = interleaved(columns, cut_points(rows, columns))
    n = max(-(-table.stored_bytes(spark, root, base, chosen) // file_bytes), 1)
    dealt = rows.withColumns({"part": base.layout.part(), "_z": z}).repartitionByRange(
        int(n), "part", "_z", F.xxhash64(*columns)).sortWithinPartitions("part", "_z", *columns)
    batch = table.write_parts(spark, root, base, dealt.drop("_z"))
    table.publish(spark, root, base, batch, replaced=chosen)
    return sum(len(table.data_files(spark, f"{root}/data/batch={batch.id}/part={p}")) for p in batch.parts)


def ranges(spark: SparkSession, root: str, columns: Sequence[str]) -> DataFrame:
    """How narrow the files are: per file and column its lowest and highest value (``low_<c>``,
    ``high_<c>``), with the file's part and number of rows."""
    rows = table.read(spark, root, with_part=True)
    bounds = reduce(list.__add__, ([F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}")] for c in columns), [])
    return rows.groupBy("part", F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), *bounds)
