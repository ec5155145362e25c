"""Build the star schema and the marts from the main ticket table."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ticketmill import schemas as S
from ticketmill.operators import checks, dims, facts, marts, staging
from ticketmill.operators.joins import sized
from ticketmill.plans import published
from ticketmill.plans.publish import upsert_into
from ticketmill.sources import table


@dataclass(frozen=True)
class Seeds:
    sla_targets: DataFrame
    department_metadata: DataFrame
    community_areas: DataFrame


@dataclass(frozen=True)
class Dimensions:
    """Dimension frames as the facts and marts join them (see ``joins.sized``)."""

    date: DataFrame
    geography: DataFrame
    request_type: DataFrame
    department: DataFrame
    status: DataFrame


def dimension_frames(stg: DataFrame, seeds: Seeds, calendar: DataFrame,
                     holiday_dates: DataFrame) -> dict[str, DataFrame]:
    """The dimensions by name; the text ones read the distinct members only."""
    return {
        "dim_date": dims.dim_date(calendar, holiday_dates),
        "dim_geography": dims.dim_geography(seeds.community_areas),
        "dim_request_type": dims.dim_request_type(stg, sized(seeds.sla_targets)),
        "dim_department": dims.dim_department(stg, sized(seeds.department_metadata)),
        "dim_status": dims.dim_status(stg),
    }


def write_table(frame: DataFrame, path: str) -> DataFrame:
    """Write once to a new folder; the rebalance joins small outputs into few files."""
    frame.hint("rebalance").write.parquet(path)
    return frame.sparkSession.read.parquet(path)


def write_dimensions(spark: SparkSession, root: str, stg: DataFrame, seeds: Seeds,
                     calendar: DataFrame, holiday_dates: DataFrame,
                     stamp: bool = False) -> Dimensions:
    """Write the dimensions as tables and return them, measured for broadcasting.

    ``stamp`` adds the rebuild time to all but the calendar.
    """
    members = write_table(dims.members(stg), f"{root}/members")
    frames = dimension_frames(members, seeds, calendar, holiday_dates)
    if stamp:
        frames = {n: f if n == "dim_date" else dims.with_rebuild_time(f)
                  for n, f in frames.items()}
    done = {n: sized(write_table(f, f"{root}/{n}")) for n, f in frames.items()}
    return Dimensions(done["dim_date"], done["dim_geography"], done["dim_request_type"],
                      done["dim_department"], done["dim_status"])


FACTS = {
    "fct_service_requests": table.Layout(
        "created_date", "month",
        ("request_type_id", "department_id", "community_area_id", "status_id"),
        (S.KEY,), ("last_modified_date",)),
    "fct_sla_performance": table.Layout(
        "closed_date", "month", ("community_area_id", "request_type_id"), (S.KEY,), ("closed_date",)),
}
#: Property of a fact's commit: the commit of the main table that it was brought up to.
SEEN = "main_commit"


@dataclass(frozen=True)
class Feed:
    """The stored main table as of one commit, and how its rows are staged. Facts brought up from
    it read only the batches committed since their last build."""

    root: str
    main: table.Snapshot
    staged: Callable[[DataFrame], DataFrame]

    def rows(self, spark: SparkSession) -> DataFrame:
        return self.staged(table.read(spark, self.root, snap=self.main))

    def since(self, spark: SparkSession, number: str | None) -> DataFrame | None:
        """The staged rows of all files committed since ``number``; None if that is not known."""
        new = None if number is None else table.changes(spark, self.root, int(number), self.main)
        return None if new is None else self.staged(new)


def refresh_fact(spark: SparkSession, path: str, name: str, stg: DataFrame,
                 star: Dimensions, full_refresh: bool = False,
                 layout: table.Layout | None = None, stamp: bool = False,
                 feed: Feed | None = None) -> int:
    """Rebuild the fact ``name`` at ``path``, or upsert the rows changed since its stored
    maximum; the number of rows written or replaced.

    The maximum is part of the fact's commit. With ``feed`` only what was committed to the main
    table since the last build is read: each row of a slice that is not among it is in the fact
    already, because the slices of earlier builds reached at least as far back.
    """
    if name == "fct_service_requests":
        pick, since, mark, model, lookups = (
            facts.modified_slice, facts.modified_since, "last_modified_date", facts.fct_service_requests,
            (star.request_type, star.department, star.status))
    else:
        pick, since, mark, model, lookups = (
            facts.closed_slice, facts.closed_since, "closed_date", facts.fct_sla_performance,
            (star.request_type, star.department))

    def rows(tickets: DataFrame) -> DataFrame:
        fact = model(tickets, *lookups)
        return dims.with_rebuild_time(fact) if stamp else fact

    seen = {SEEN: str(feed.main.number)} if feed else {}
    base = table.snapshot(spark, path)
    if base is None or full_refresh:
        whole = rows(stg)
        table.create(spark, path, whole.schema, layout or FACTS[name])
        return table.overwrite(spark, path, whole, allow_empty=True, properties=seen)
    new = feed.since(spark, base.properties.get(SEEN)) if feed else None
    if mark in base.layout.marks:
        changed = since(stg if new is None else new, base.marks.get(mark))
    else:
        # the newest closing date lies in the newest part; a newest change may lie in any part
        parts = table.newest_part(spark, path) if pick is facts.closed_slice else None
        changed = pick(stg if new is None else new, table.read(spark, path, parts))
    return upsert_into(spark, path, rows(changed), properties=seen)


def build_models(spark: SparkSession, root: str, tickets: DataFrame | str, seeds: Seeds, as_of=None,
                 calendar: DataFrame | None = None, holiday_dates: DataFrame | None = None,
                 full_refresh: bool = False) -> dict[str, DataFrame]:
    """Seeds, dimensions, facts, marts, in that order.

    Dimensions and the SLA mart are written whole into a folder of this build, facts are
    kept up to date in place; staging and the operational mart are views. All of them become
    visible together, by one pointer (see :mod:`ticketmill.plans.published`, which reads them in
    any session), are then registered under their names, and returned by name.

    ``tickets`` may be the folder of the stored main table. All models then rest on one commit of
    it, and facts read only what was committed since they were last built.
    """
    name_of_run = uuid.uuid4().hex
    run = f"{root}/builds/{name_of_run}"

    def staged(rows: DataFrame) -> DataFrame:
        return staging.stg_service_requests(rows, as_of, audit_column=True)

    feed = Feed(tickets, table.snapshot(spark, tickets), staged) if isinstance(tickets, str) else None
    stg = feed.rows(spark) if feed else staged(tickets)
    calendar = calendar if calendar is not None else dims.fixed_bounds(spark)
    holiday_dates = holiday_dates if holiday_dates is not None else dims.holidays(spark)
    d = write_dimensions(spark, run, stg, seeds, calendar, holiday_dates, stamp=True)
    for name in FACTS:
        refresh_fact(spark, f"{root}/{name}", name, stg, d, full_refresh, stamp=True, feed=feed)
    commits = {name: table.snapshot(spark, f"{root}/{name}") for name in FACTS}
    fct, sla = (table.read(spark, f"{root}/{name}", snap=commits[name]) for name in FACTS)
    performance = write_table(
        marts.mart_sla_performance(sla, d.geography, d.request_type, d.department),
        f"{run}/mart_sla_performance")
    published.publish(spark, root, published.Pointer(
        name_of_run, [*published.DIMENSIONS, "mart_sla_performance"],
        {name: snap.number for name, snap in commits.items()},
        None if as_of is None else str(as_of), feed.root if feed else None,
        feed.main.number if feed else None))
    models = {
        "stg_service_requests": stg, "dim_date": d.date, "dim_geography": d.geography,
        "dim_request_type": d.request_type, "dim_department": d.department,
        "dim_status": d.status, "fct_service_requests": fct, "fct_sla_performance": sla,
        "mart_operational": marts.mart_operational(fct, d.geography, d.request_type, d.department,
                                                   d.status, as_of),
        "mart_sla_performance": performance,
    }
    for name, frame in models.items():
        frame.createOrReplaceTempView(name)
    return models


SUITES = {
    "stg_service_requests": checks.STAGING,
    "dim_date": checks.DIM_DATE,
    "dim_department": checks.DIM_DEPARTMENT,
    "dim_geography": checks.DIM_GEOGRAPHY,
    "dim_request_type": checks.DIM_REQUEST_TYPE,
    "dim_status": checks.DIM_STATUS,
    "fct_service_requests": checks.FACT,
    "fct_sla_performance": checks.SLA_FACT,
    "mart_operational": checks.MART_OPERATIONAL,
}


def check_models(models: dict[str, DataFrame], seeds: Seeds | None = None,
                 source: DataFrame | None = None) -> DataFrame:
    """The result of every model's suite, and of those of the seeds and the source table if given,
    with the model's name; nothing stops at a failure."""
    suites = {name: (models[name], suite) for name, suite in SUITES.items()}
    if seeds is not None:
        suites |= {"community_areas": (seeds.community_areas, checks.SEED_AREAS),
                   "sla_targets": (seeds.sla_targets, checks.SEED_TARGETS),
                   "department_metadata": (seeds.department_metadata, checks.SEED_DEPARTMENTS)}
    if source is not None:
        suites["service_requests"] = (source, checks.SOURCE)
    return checks.run_suites(suites)
