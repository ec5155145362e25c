"""Merge and upsert into published tables, rewriting only the files that change."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.operators.joins import broadcast_if
from ticketmill.operators.wap import latest_wins
from ticketmill.session import shared_dir
from ticketmill.sources import table


@contextmanager
def written(spark: SparkSession, df: DataFrame) -> Iterator[DataFrame]:
    """``df`` as a table in the shared folder, deleted on exit.

    Cutting the lineage this way makes all later steps agree on the rows, also when an
    executor is lost in between.
    """
    path = f"{shared_dir(spark)}/ticketmill/work-{uuid.uuid4().hex}"
    try:
        table.make_folder(spark, path, until_exit=True)
        df.write.parquet(f"{path}/rows")
        yield spark.read.parquet(f"{path}/rows")
    finally:
        table.delete(spark, path)


#: Up to so many keys are looked for by value, which Bloom filters answer; ten make one condition
#: that Spark hands to the Parquet reader as values and not as a range.
FEW, AT_ONCE = 100, 10


def _hits(spark: SparkSession, root: str, keys: DataFrame, key: str, bounds: Row) -> DataFrame:
    """(key, _version, file) of the stored rows of the given keys (distinct; written).

    The keys' range goes into the scan, where stored keys are sorted and row groups outside it are
    skipped; a few keys go there one by one. A small load is broadcast, so that stored keys are
    read where they lie; a large one shuffles both key columns.
    """
    stored = table.read(spark, root)
    near = stored.where(F.col(key).between(bounds["low"], bounds["high"]))
    if bounds["n"] <= FEW:
        values = [r[0] for r in keys.select(key).collect()]
        some = [F.col(key).isin(values[k:k + AT_ONCE]) for k in range(0, len(values), AT_ONCE)]
        near = near.where(reduce(Column.__or__, some))
    version = [F.col(S.VERSION).alias("_version")] if S.VERSION in stored.columns else []
    thin = near.select(key, *version, F.col("_metadata.file_path").alias("file"))
    return thin.join(broadcast_if(keys.select(key), bounds["n"]), key, "left_semi")


@contextmanager
def _counted(spark: SparkSession, source: DataFrame, key: str) -> Iterator[tuple[DataFrame, Row]]:
    """Each key of ``source`` with its number of rows (``_n``), written; the lowest and highest key,
    and how many keys there are and have several rows. Only keys are read and shuffled."""
    with written(spark, source.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))) as keys:
        yield keys, keys.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.lit(1)).alias("n"),
                             F.count_if(F.col("_n") > 1).alias("repeated")).first()


def split_repeated(source: DataFrame, keys: DataFrame, repeated: int, key: str = S.KEY
                   ) -> tuple[DataFrame, DataFrame]:
    """The rows of keys that have one row, which need no sort or shuffle, and the others."""
    if not repeated:
        return source, source.limit(0)
    several = broadcast_if(keys.where(F.col("_n") > 1).select(key), repeated)
    return source.join(several, key, "left_anti"), source.join(several, key, "left_semi")


# --- chunks as steps -------------------------------------------------------------------

#: What a later chunk may change, and several of them in order.
STEPS = f"array<{S.STEP_TYPE}>"


def as_steps(rows: DataFrame, chunk: str | None) -> DataFrame:
    """One row per key: its newest row of the earliest chunk, and in ``_steps`` what the merges of
    its later chunks may change (its newest row of each, in order of the chunks).

    A key sends one row per chunk and input task, however many it has; only the columns that a
    merge moves travel in steps.
    """
    if chunk is None:
        newest = latest_wins(rows.select(*S.TYPED_COLUMNS))
        return newest.withColumn("_steps", F.lit(None).cast(STEPS))
    newest = latest_wins(rows, (S.KEY, chunk), hashed=S.TYPED_COLUMNS)
    whole = F.min_by(F.struct(*S.TYPED_COLUMNS), F.col(chunk))
    steps = F.array_sort(F.collect_list(F.struct(chunk, F.struct(*S.MERGE_UPDATES).alias("step"))))
    per_key = newest.groupBy(S.KEY).agg(whole.alias("_row"), steps.alias("_all"))
    later = F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda s: s["step"])
    return per_key.select("_row.*", later.alias("_steps"))


def folded(version: Column, steps: Column) -> Column:
    """What merging ``steps`` one after the other does to a row of ``version``: ``n``, how many of
    them are newer than all before, and ``last``, the last of these (null if there is none)."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), version.alias("version"),
                     F.lit(None).cast(S.STEP_TYPE).alias("last"))

    def merge(so_far: Column, step: Column) -> Column:
        applied = F.struct((so_far["n"] + 1).alias("n"), step[S.VERSION].alias("version"), step.alias("last"))
        return F.when(step[S.VERSION] > so_far["version"], applied).otherwise(so_far)

    return F.aggregate(steps, start, merge)


def _moved(rows: DataFrame, fold: str) -> DataFrame:
    """``rows`` with the changeable columns of their fold's last step, if it has one."""
    changed = F.coalesce(F.col(f"{fold}.n"), F.lit(0)) > 0
    return rows.select(*[
        F.when(changed, F.col(f"{fold}.last.{c}")).otherwise(F.col(c)).alias(c)
        if c in S.MERGE_UPDATES else F.col(c) for c in S.TYPED_COLUMNS])


# --- merge and upsert ------------------------------------------------------------------

def merge_into(spark: SparkSession, root: str, source: DataFrame,
               properties: dict[str, str] | None = None, chunk: str | None = None) -> dict[str, int]:
    """Latest-wins merge of typed tickets; returns inserted, updated and affected counts.

    ``source`` is a written (staged) table. With ``chunk``, a column that numbers its rows, the
    result is that of merging chunk after chunk: a key's chunks are folded in order, and each one
    that is newer than all before counts as an update.

    Keys alone are counted first, and only rows of keys that repeat are sorted out. Stored rows are
    read for key, version and file. If no incoming key is stored, as in a bulk load, the rows go
    straight into new files. Otherwise they are sorted into inserts, updates and rest; the files
    that hold a row to update are rewritten, and inserts are added in new ones.
    """
    base = table.snapshot(spark, root)
    with _counted(spark, source, S.KEY) as (keys, bounds):
        if not bounds["n"]:
            if properties:
                table.publish(spark, root, base, None, (), properties)
            return {"inserted": 0, "updated": 0, "affected": 0}
        single, several = split_repeated(source, keys, bounds["repeated"])
        single = single.select(*S.TYPED_COLUMNS).withColumn("_steps", F.lit(None).cast(STEPS))
        folds = written(spark, as_steps(several, chunk)) if bounds["repeated"] else nullcontext()
        with folds as steps:
            fresh = single.unionByName(steps) if steps is not None else single
            hits = _hits(spark, root, keys, S.KEY, bounds) if base.parts else None
            with (written(spark, hits) if hits is not None else nullcontext()) as found:
                known = found.count() if found is not None else 0
                if known:
                    inserted, updated, files, batch = _sort_out(spark, root, fresh, found, known)
                else:
                    own = folded(F.col(S.VERSION), F.col("_steps"))
                    batch = table.write_batch(spark, root, _moved(fresh.withColumn("_f", own), "_f"))
                    again = steps.agg(F.sum(own["n"])).first()[0] if steps is not None else 0
                    inserted, updated, files = batch.rows, again or 0, []
    if inserted or updated or properties:
        table.publish(spark, root, base, batch if inserted or updated else None, (), properties, files)
    return {"inserted": inserted, "updated": updated, "affected": inserted + updated}


def _sort_out(spark: SparkSession, root: str, fresh: DataFrame, hits: DataFrame, known: int
              ) -> tuple[int, int, list[str], table.Batch | None]:
    """Write the changes of a merge; inserts, updates, the files it replaces, and the new batch."""
    stored = F.col("file").isNotNull()
    own = F.array(F.struct(*S.MERGE_UPDATES)).cast(STEPS)
    rest = F.coalesce("_steps", F.array().cast(STEPS))
    fold = F.when(stored, folded(F.col("_version"), F.concat(own, rest))).otherwise(
        folded(F.col(S.VERSION), rest))
    marked = fresh.join(broadcast_if(hits, known), S.KEY, "left").withColumn("_f", fold).drop("_steps")
    with written(spark, marked.where(~stored | (F.col("_f.n") > 0))) as incoming:
        # one row per file that changes, and one for all inserts
        found = incoming.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.sum("_f.n").alias("n")).collect()
        files = [r["file"] for r in found if r["file"] is not None]
        inserted = sum(r["rows"] for r in found if r["file"] is None)
        updated = sum(r["n"] for r in found)
        rows = _moved(incoming.where(F.col("file").isNull()), "_f")
        if files:
            updates = incoming.where(F.col("file").isNotNull()).select(S.KEY, "_f")
            old = table.read_files(spark, root, files)
            n = sum(r["rows"] for r in found if r["file"] is not None)
            rows = _moved(old.join(broadcast_if(updates, n), S.KEY, "left"), "_f").unionByName(rows)
        batch = table.write_batch(spark, root, rows) if found else None
    return inserted, updated, files, batch


def upsert_into(spark: SparkSession, root: str, rows: DataFrame, key: str = S.KEY,
                properties: dict[str, str] | None = None) -> int:
    """Replace the stored rows of the same keys, all columns, or add new ones; the number of rows.

    A replaced row may move to another part, so the files to rewrite are those its key is stored
    in; they are rewritten without the replaced keys, and files without one stay.
    """
    base = table.snapshot(spark, root)
    with written(spark, rows.select(*base.schema.names)) as incoming:
        bounds = incoming.agg(F.min(key).alias("low"), F.max(key).alias("high"),
                              F.count(F.lit(1)).alias("n")).first()
        if not bounds["n"]:
            if properties:
                table.publish(spark, root, base, None, (), properties)
            return 0
        files = []
        if base.parts:
            hits = _hits(spark, root, incoming.select(key), key, bounds)
            files = [r["file"] for r in hits.select("file").distinct().collect()]
        fresh = incoming
        if files:
            keys = broadcast_if(incoming.select(key), bounds["n"])
            kept = table.read_files(spark, root, files).join(keys, key, "left_anti")
            fresh = kept.unionByName(incoming)
        batch = table.write_batch(spark, root, fresh)
        table.publish(spark, root, base, batch, (), properties, files)
        return bounds["n"]
