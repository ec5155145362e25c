"""Write-audit-publish loads: by calendar chunk, by year, daily, and backfill."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import dates
from ticketmill.operators import ingest, wap
from ticketmill.plans.publish import merge_into, written
from ticketmill.sources import pages, table

ISO = "%Y-%m-%dT%H:%M:%S.000"
WATERMARK = "watermark"


@dataclass(frozen=True)
class Lake:
    """Where the main and the staging table live."""

    root: str

    @property
    def main(self) -> str:
        return f"{self.root}/service_requests"

    @property
    def staging(self) -> str:
        return f"{self.root}/service_requests_staging"

    @property
    def quarantine(self) -> str:
        """Every record that a load has rejected, as it landed, with the load that met it first."""
        return f"{self.root}/service_requests_rejected"

    @property
    def replayed(self) -> str:
        """The quarantined records that have been corrected and loaded since."""
        return f"{self.root}/service_requests_replayed"


@dataclass
class LoadResult:
    rows: int = 0
    failed: int = 0
    failures: list[tuple[str, str, str]] = field(default_factory=list)

    def fail(self, low: str, high: str, why: str) -> None:
        self.failed += 1
        self.failures.append((low, high, why))


def ensure_tables(spark: SparkSession, lake: Lake, granularity: str = "month") -> None:
    """Create the main table, sorted by key inside its parts, and the unpartitioned staging
    table, where they do not exist."""
    main = table.Layout("created_date", granularity, (S.KEY,), (S.KEY,), (S.VERSION,))
    for root, layout in ((lake.main, main), (lake.staging, table.Layout(None))):
        table.create(spark, root, S.TYPED_SCHEMA, layout)
    table.create(spark, lake.quarantine, S.REJECTED_SCHEMA, table.Layout(None))
    table.create(spark, lake.replayed, S.REPLAYED_SCHEMA, table.Layout(None))


# --- chunks ----------------------------------------------------------------------------

def _next_chunk_start(day: date, months: int) -> date:
    years, month = divmod(day.year * 12 + day.month - 1 + months, 12)
    return date(years, month + 1, 1)


def plan_chunks(start: date, end: date, chunk_months: int = 1) -> list[tuple[date, date]]:
    """Half-open chunks that end on the first of a month, the last one at ``end``."""
    chunks = []
    while start < end:
        stop = min(_next_chunk_start(start, chunk_months), end)
        chunks.append((start, stop))
        start = stop
    return chunks


def chunk_frame(bounds: DataFrame, chunk_months: int = 1) -> DataFrame:
    """The same chunks as rows, from a one-row frame with ``start`` and ``end``."""
    step = F.expr(f"interval {chunk_months} months")
    first = F.trunc("start", "MM")
    firsts = F.sequence(first, F.greatest(F.date_sub("end", 1), first), step)
    return bounds.where(F.col("start") < F.col("end")).select(
        "start", "end", F.explode(firsts).alias("first")
    ).select(
        F.greatest("first", "start").alias("chunk_start"),
        F.least(F.to_date(F.col("first") + step), "end").alias("chunk_end"),
    )


def chunk_number(day: Column, start: date, chunk_months: int) -> Column:
    """0-based chunk of a date, by arithmetic on month numbers."""
    first = start.year * 12 + start.month
    return F.floor((dates.month_index(day) - first) / chunk_months).cast("int")


# --- outcomes --------------------------------------------------------------------------

def split(raw: DataFrame, accepted: Column, chunk: Column) -> DataFrame:
    """Typed tickets with ``parse_errors`` and ``_chunk``, and among them the rejected records.

    A rejected record, one for which ``accepted`` is not true, has its fields as they landed in
    ``_landed`` and no chunk; accepted ones have no ``_landed``. So one pass over the pages, written
    once, holds both outcomes, and a read of either skips the row groups of the other.
    """
    raw = ingest.with_missing_columns(raw)
    good = F.coalesce(accepted, F.lit(False))
    marked = raw.withColumns({
        "_landed": F.when(~good, F.struct(*S.RAW_FIELDS)), "_chunk": F.when(good, chunk)})
    return ingest.lenient_tickets(marked, keep=("_landed", "_chunk"), also=F.col("_landed").isNotNull())


def _ranged(raw: DataFrame, date_field: str, low: str, high: str, chunk: Column) -> DataFrame:
    """The outcomes of a load: records whose date is in range, and those whose date text cannot be
    read, which no range of dates can reach."""
    raw = ingest.with_missing_columns(raw)
    readable = pages.readable(date_field)
    return split(raw.where(pages.in_range(raw, date_field, low, high) | ~readable), readable, chunk)


def _digest() -> Column:
    """Identifies a landed record by all its fields."""
    return F.sha2(F.to_json(F.struct(*S.RAW_FIELDS), {"ignoreNullFields": "false"}), 256)


def set_aside(spark: SparkSession, lake: Lake, staged: DataFrame, load: str, reason: str) -> None:
    """Add the rejected records of an outcome split to the quarantine.

    The quarantine only ever grows. A record that it already holds, as when pages are read again,
    is not added a second time, so a load that is repeated after a failure changes nothing.
    """
    bad = staged.where(F.col("_landed").isNotNull()).select("_landed.*").withColumns({
        "record": _digest(), "load": F.lit(load), "reason": F.lit(reason)})
    known = table.read(spark, lake.quarantine).select("record")
    table.append(spark, lake.quarantine, bad.dropDuplicates(["record"]).join(known, "record", "left_anti"))


def outstanding(spark: SparkSession, lake: Lake) -> DataFrame:
    """The quarantined records that no replay has loaded yet."""
    done = table.read(spark, lake.replayed).select("record")
    return table.read(spark, lake.quarantine).join(done, "record", "left_anti")


def _label(low: str, high: str, field: str) -> str:
    return f"{low}/{high} by {field}"


def _outcome(spark: SparkSession, lake: Lake, staged: DataFrame, low: str, high: str,
             field: str) -> tuple[LoadResult, dict[int, dict]]:
    """Count the outcomes in one pass, chunk by chunk, and set the rejected records aside; what is
    to be reported of them, and the audit of every chunk with rows."""
    verdicts = {r["_chunk"]: r.asDict() for r in wap.audit_by(staged, "_chunk", errors="parse_errors").collect()}
    result = LoadResult()
    if bad := verdicts.pop(None, None):
        set_aside(spark, lake, staged, _label(low, high, field), f"unreadable {field}")
        result.fail(low, high, f"{bad['row_count']} records with unreadable {field}, in quarantine")
    return result, verdicts


# --- loads -----------------------------------------------------------------------------

def stage(spark: SparkSession, lake: Lake, accepted: DataFrame) -> int:
    """Overwrite staging; the number of rows staged."""
    return table.overwrite(spark, lake.staging, accepted.select(*S.TYPED_COLUMNS))


def audit_passes(spark: SparkSession, lake: Lake, min_rows: int = 1) -> bool:
    return wap.audit(table.read(spark, lake.staging), min_rows).first()["passed"]


def _chunk_texts(start: date, end: date, chunk_months: int) -> list[tuple[str, str]]:
    return [(f"{a}T00:00:00.000", f"{b}T00:00:00.000") for a, b in plan_chunks(start, end, chunk_months)]


def _by_chunk(raw: DataFrame, start: date, end: date, chunk_months: int, date_field: str) -> DataFrame:
    chunk = chunk_number(F.to_date(dates.try_parse_iso(F.col(date_field))), start, chunk_months)
    return _ranged(raw, date_field, f"{start}T00:00:00.000", f"{end}T00:00:00.000", chunk)


def load_chunks(spark: SparkSession, lake: Lake, raw: DataFrame, start: date, end: date,
                chunk_months: int = 1, date_field: str = "created_date") -> LoadResult:
    """One write-audit-publish cycle per chunk, in order. A chunk without rows is skipped, a
    failing one is recorded and the loop goes on. The pages are read once."""
    plan = _chunk_texts(start, end, chunk_months)
    with written(spark, _by_chunk(raw, start, end, chunk_months, date_field)) as staged:
        result, verdicts = _outcome(spark, lake, staged, f"{start}T00:00:00.000", f"{end}T00:00:00.000",
                                    date_field)
        for i in sorted(verdicts):
            try:
                if verdicts[i]["parse_errors"]:
                    raise ValueError(f"{verdicts[i]['parse_errors']} fields that do not parse")
                if stage(spark, lake, staged.where(F.col("_chunk") == i)):
                    if not audit_passes(spark, lake):
                        raise ValueError("audit failed")
                    result.rows += merge_into(spark, lake.main, table.read(spark, lake.staging))["affected"]
            except Exception as e:  # a chunk's failure must not stop the others
                result.fail(*plan[i], str(e))
    return result


def load_at_once(spark: SparkSession, lake: Lake, raw: DataFrame, start: date, end: date,
                 chunk_months: int = 1, date_field: str = "created_date") -> LoadResult:
    """All chunks in one pass over the pages and one merge, with the audit grouped by chunk.

    Chunks that hold an unparsable field or fail the audit are left out and reported. The merge
    folds the chunks of a key in their order, so it gives what :func:`load_chunks` gives, which
    merges once per chunk.
    """
    plan = _chunk_texts(start, end, chunk_months)
    low, high = f"{start}T00:00:00.000", f"{end}T00:00:00.000"
    with written(spark, _by_chunk(raw, start, end, chunk_months, date_field)) as staged:
        result, verdicts = _outcome(spark, lake, staged, low, high, date_field)
        bad = sorted(i for i, v in verdicts.items() if not v["passed"])
        for i in bad:
            result.fail(*plan[i], "audit failed")
        good = staged.where(F.col("_chunk").isNotNull() & ~F.col("_chunk").isin(bad))
        try:
            result.rows = merge_into(spark, lake.main, good, None, "_chunk")["affected"]
        except Exception as e:  # reported as a chunk's failure is
            result.fail(low, high, str(e))
    return result


def yearly_load(spark: SparkSession, lake: Lake, raw: DataFrame, year: int,
                at_once: bool = True) -> LoadResult:
    ensure_tables(spark, lake)
    load = load_at_once if at_once else load_chunks
    return load(spark, lake, raw, date(year, 1, 1), date(year + 1, 1, 1))


def backfill(spark: SparkSession, lake: Lake, raw: DataFrame, start: date, end: date,
             chunk_months: int = 1, at_once: bool = True) -> LoadResult:
    ensure_tables(spark, lake)
    load = load_at_once if at_once else load_chunks
    return load(spark, lake, raw, start, end, chunk_months)


def daily_load(spark: SparkSession, lake: Lake, raw: DataFrame, now: datetime,
               hours: int = 24) -> LoadResult:
    """Tickets modified in the ``hours`` before ``now``. No rows: nothing happens. A failed
    audit clears staging, leaves the main table alone and is reported, as are records whose
    change time cannot be read."""
    ensure_tables(spark, lake)
    since = now - timedelta(hours=hours)
    return _modified_between(spark, lake, raw, since, now)


def watermark(spark: SparkSession, lake: Lake) -> datetime | None:
    """End of the last successful incremental load."""
    snap = table.snapshot(spark, lake.main)
    text = snap.properties.get(WATERMARK) if snap else None
    return datetime.strptime(text, ISO) if text else None


def incremental_load(spark: SparkSession, lake: Lake, raw: DataFrame, now: datetime) -> LoadResult:
    """Everything modified since the last successful run. The watermark is part of the
    commit that publishes the rows, so a failed run cannot advance it. It may pass records whose
    change time cannot be read: those are reported, and wait in the quarantine for a replay."""
    ensure_tables(spark, lake)
    since = watermark(spark, lake) or datetime(1, 1, 1)
    return _modified_between(spark, lake, raw, since, now, {WATERMARK: now.strftime(ISO)})


def _modified_between(spark, lake, raw, since: datetime, until: datetime,
                      properties: dict[str, str] | None = None) -> LoadResult:
    low, high = f"{since:%Y-%m-%dT%H:%M:%S.000}".rjust(23, "0"), until.strftime(ISO)
    with written(spark, _ranged(raw, S.VERSION, low, high, F.lit(0))) as outcomes:
        result, verdicts = _outcome(spark, lake, outcomes, low, high, S.VERSION)
        if not verdicts:
            if properties:
                table.publish(spark, lake.main, table.snapshot(spark, lake.main), None, (), properties)
            return result
        stage(spark, lake, outcomes.where(F.col("_chunk") == 0))
    if verdicts[0]["parse_errors"]:
        result.fail(low, high, f"{verdicts[0]['parse_errors']} fields that do not parse")
    elif audit_passes(spark, lake):
        staged = table.read(spark, lake.staging)
        result.rows = merge_into(spark, lake.main, staged, properties)["affected"]
    else:
        result.fail(low, high, "audit failed")
    table.truncate(spark, lake.staging)
    return result


def replay(spark: SparkSession, lake: Lake, correct: Callable[[DataFrame], DataFrame], load: str) -> LoadResult:
    """Load quarantined records again after ``correct``, which gets those outstanding as they landed
    (with ``record``, ``load`` and ``reason``) and returns them, all or some, with better text.

    Records that parse now are audited and merged together, and noted as replayed by ``load``; the
    others are reported and stay outstanding. A record is noted only once its rows are published:
    a replay that dies in between merges them again, which changes nothing.
    """
    ensure_tables(spark, lake)
    fixed = ingest.with_missing_columns(correct(outstanding(spark, lake)))
    good = pages.readable("created_date") & pages.readable(S.VERSION) & (ingest.parse_errors(fixed) == 0)
    typed = ingest.lenient_tickets(fixed.withColumn("_good", good), keep=("record", "_good"),
                                   also=F.lit(True))
    result = LoadResult()
    with written(spark, typed) as staged:
        taken = staged.where(F.col("_good") & (F.coalesce(F.col(S.KEY), F.lit("")) != ""))
        left = staged.count() - taken.count()
        if left:
            result.fail(load, "", f"{left} records that still do not parse")
        if stage(spark, lake, taken):
            if not audit_passes(spark, lake):
                result.fail(load, "", "audit failed")
            else:
                result.rows = merge_into(spark, lake.main, table.read(spark, lake.staging))["affected"]
                table.append(spark, lake.replayed, taken.select("record").distinct().withColumn(
                    "load", F.lit(load)))
            table.truncate(spark, lake.staging)
    return result
