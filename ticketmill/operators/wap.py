"""Audit, latest-wins deduplication and merge, as DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketmill import schemas as S


def audit(staged: DataFrame, min_rows: int = 1, required: str = "created_date") -> DataFrame:
    """One row: ``row_count``, ``null_count`` and ``passed``."""
    return staged.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(required).isNull()).alias("null_count"),
    ).withColumn("passed", (F.col("row_count") >= min_rows) & (F.col("null_count") == 0))


def audit_by(staged: DataFrame, group: str, min_rows: int = 1,
             required: str = "created_date", errors: str | None = None) -> DataFrame:
    """The same audit per group; with ``errors``, unparsed fields fail a group too."""
    bad = F.sum(errors).cast("bigint") if errors else F.lit(0).cast("bigint")
    return (
        staged.groupBy(group)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(F.col(required).isNull()).alias("null_count"),
            bad.alias("parse_errors"),
        )
        .withColumn(
            "passed",
            (F.col("row_count") >= min_rows) & (F.col("null_count") == 0)
            & (F.col("parse_errors") == 0),
        )
    )


def latest_wins(df: DataFrame, key: str | Sequence[str] = S.KEY, version: str = S.VERSION,
                tiebreak: Sequence[str] | None = None, hashed: Sequence[str] | None = None
                ) -> DataFrame:
    """One row per key, newest version first; ties are settled by ``tiebreak`` (descending).

    By default a hash of the whole row (of its columns ``hashed``) settles ties, so the result does
    not depend on how rows were distributed. ``row_number() = 1`` is kept visible to the optimizer:
    it limits each group to one row before the shuffle, so a key with a third of all rows sends
    only one row per input task.
    """
    ties = [F.xxhash64(*(hashed or df.columns))] if tiebreak is None else [F.col(c) for c in tiebreak]
    order = [c.desc_nulls_last() for c in (F.col(version), *ties)]
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def merge(target: DataFrame, source: DataFrame, key: str = S.KEY, version: str = S.VERSION,
          update_columns: Sequence[str] = S.MERGE_UPDATES) -> DataFrame:
    """The merged table plus ``action`` (insert, update, keep); both sides unique on ``key``.

    A match updates only when the source is strictly newer (a null on either side is not),
    and only ``update_columns`` move. Source rows without a match come in whole.
    """
    new = source.select(
        *[F.col(c).alias(f"_s_{c}") for c in target.columns], F.lit(True).alias("_s")
    )
    joined = target.withColumn("_t", F.lit(True)).join(
        new, F.col(key) == F.col(f"_s_{key}"), "full_outer"
    )
    action = (
        F.when(F.col("_t").isNull(), "insert")
        .when(F.col("_s") & (F.col(f"_s_{version}") > F.col(version)), "update")
        .otherwise("keep")
    )
    take_all = F.col("action") == "insert"
    take_some = take_all | (F.col("action") == "update")
    return joined.withColumn("action", action).select(
        *[
            F.when(take_some if c in update_columns else take_all, F.col(f"_s_{c}"))
            .otherwise(F.col(c)).alias(c)
            for c in target.columns
        ],
        "action",
    )


def affected(merged: DataFrame) -> DataFrame:
    """Inserted, updated and kept row counts of a merge, and the affected total."""
    n = {a: F.count_if(F.col("action") == a) for a in ("insert", "update", "keep")}
    return merged.agg(
        n["insert"].alias("inserted"), n["update"].alias("updated"), n["keep"].alias("kept"),
        (n["insert"] + n["update"]).alias("affected"),
    )


def upsert(target: DataFrame, rows: DataFrame, key: str = S.KEY) -> DataFrame:
    """``rows`` replace the target's rows of the same key, all columns, or are added."""
    return target.join(rows.select(key), key, "left_anti").unionByName(rows)
