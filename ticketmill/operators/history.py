"""As-of lookups, and the history of departments that are renamed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.functions.keys import surrogate_key
from ticketmill.operators.rules import scd2

#: Fixed value: what stands between a department's code and its name.
CODE_END = " - "


def as_of(rows: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, valid_from: str,
          columns: Sequence[str], bucket: str = "month") -> DataFrame:
    """``rows`` with ``columns`` of the version valid at their time: the last one of the same keys
    that starts at or before it; null where there is none, or a key or the time is null.

    Rows and versions are put into one stream per key and time bucket (a ``date_trunc`` unit), in
    which the last version seen is carried forward. Each bucket starts with the version that the
    buckets before it end with: one edge row per key and bucket, carried forward in turn. So no row
    meets a range of versions, and a key with a third of all rows spreads over its buckets; the
    bucket does not affect the result. A key has at most one version per start.
    """
    kind = rows.schema[at].dataType
    state = F.struct(*columns)
    no_row = F.lit(None).cast(rows.schema)
    no_state = F.lit(None).cast(versions.select(*columns).schema)
    # versions come first among equals
    events = versions.select(
        *keys, F.col(valid_from).cast(kind).alias("_at"), F.lit(0).alias("_side"), no_row.alias("_row"),
        state.alias("_state")).unionByName(rows.select(
            *keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct("*").alias("_row"),
            no_state.alias("_state")))
    events = events.withColumn("_bucket", F.date_trunc(bucket, "_at"))
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_at", "_side").rowsBetween(
        Window.unboundedPreceding, 0)
    inside = events.withColumn("_seen", F.last("_state", ignorenulls=True).over(so_far)).where(
        F.col("_side") == 1)
    ends = events.groupBy(*keys, "_bucket").agg(
        F.max_by("_state", F.when(F.col("_state").isNotNull(), F.col("_at"))).alias("_end"))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "_bucket", F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    found = inside.join(carried, [*keys, "_bucket"], "left").withColumn(
        "_found", F.when(F.col("_at").isNotNull(), F.coalesce("_seen", "_carried")))
    return found.select("_row.*", *[F.col("_found").getField(c).alias(c) for c in columns])


def department_code(name: Column) -> Column:
    """What stays when a department is renamed: the text before " - ", or the whole name."""
    return F.trim(F.substring_index(name, CODE_END, 1))


def department_history(tickets: DataFrame, metadata: DataFrame) -> DataFrame:
    """A row per department and period in which its tickets carried one name, with what the seed
    knows of that name: type 2, by the days on which tickets were created.

    Tickets are first counted per code, day and name, which is all that is shuffled; on a day with
    several names the most used one counts (ties: the lower). ``valid_from`` is the first day of a
    period, ``valid_to`` the first of the next, null for the current one.
    """
    named = tickets.where("owner_department is not null and created_date is not null").select(
        department_code(F.col("owner_department")).alias("department_code"),
        F.to_date("created_date").alias("day"), F.col("owner_department").alias("raw_department_name"))
    counted = named.groupBy("department_code", "day", "raw_department_name").agg(F.count(F.lit(1)).alias("n"))
    first = F.struct(-F.col("n"), F.col("raw_department_name"))
    daily = counted.groupBy("department_code", "day").agg(
        F.min_by("raw_department_name", first).alias("raw_department_name"))
    periods = scd2(daily, ["department_code"], ["raw_department_name"], "day", bucket="year")
    seed = metadata.withColumnRenamed("owner_department", "raw_department_name")
    version = F.concat_ws("|", "department_code", F.col("valid_from").cast("string"))
    return periods.join(seed, "raw_department_name", "left").select(
        surrogate_key(version).alias("department_version_id"), "department_code", "raw_department_name",
        F.coalesce("display_name", "raw_department_name").alias("department_name"), "bureau",
        "valid_from", "valid_to", "is_current")


#: What a ticket takes from the version of its department.
VERSION_COLUMNS = ("department_version_id", "department_name", "bureau")


def with_department_version(tickets: DataFrame, history: DataFrame, at: str = "created_date",
                            bucket: str = "month") -> DataFrame:
    """Tickets with the department version valid on their day ``at``, so that those of before a
    rename show the old name."""
    coded = tickets.withColumns({"department_code": department_code(F.col("owner_department")),
                                 "_day": F.to_date(at)})
    return as_of(coded, history, ["department_code"], "_day", "valid_from", VERSION_COLUMNS, bucket).drop("_day")
