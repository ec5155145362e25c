"""Builds that become visible as a whole and can be read by any session.

A build writes its tables into a folder of its own and brings the facts up to a commit. Only then
is a pointer written, ``published/<number>.json``, that names all of it: readers take the newest
pointer, so they never see models of two builds, and a build that fails is never seen.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from ticketmill.operators import marts, staging
from ticketmill.operators.joins import sized
from ticketmill.sources import table

DIMENSIONS = ("dim_date", "dim_geography", "dim_request_type", "dim_department", "dim_status")


@dataclass(frozen=True)
class Pointer:
    """What a build consists of: its folder's name and the tables in it, the commits of the facts,
    and, for the models that are views, the day they stand for (None: the reader's own) and the
    commit of the main table under them (None: staging cannot be read back)."""

    run: str
    tables: list[str]
    facts: dict[str, int]
    as_of: str | None = None
    main: str | None = None
    main_commit: int | None = None


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(n[:-5]) for n in table.children(spark, f"{root}/published") if n.endswith(".json"))


def publish(spark: SparkSession, root: str, pointer: Pointer) -> int:
    """Make a build the one that is read; its number. A second build with that number fails."""
    number = max(_numbers(spark, root), default=0) + 1
    table.write_once(spark, f"{root}/published/{number:010d}.json", json.dumps(asdict(pointer)))
    return number


def pointer(spark: SparkSession, root: str, number: int | None = None) -> Pointer:
    """The newest build, or build ``number``."""
    numbers = _numbers(spark, root)
    if not numbers or (number is not None and number not in numbers):
        raise FileNotFoundError(f"no published build at {root}")
    text = table.read_text(spark, f"{root}/published/{number or numbers[-1]:010d}.json")
    return Pointer(**json.loads(text))


def read(spark: SparkSession, root: str, number: int | None = None) -> dict[str, DataFrame]:
    """The models of a build by name, as they were when it was published."""
    p = pointer(spark, root, number)
    models = {name: spark.read.parquet(f"{root}/builds/{p.run}/{name}") for name in p.tables}
    for name, commit in p.facts.items():
        snap = table.snapshot(spark, f"{root}/{name}", commit)
        models[name] = table.read(spark, f"{root}/{name}", snap=snap)
    return models | views(spark, p, models)


def views(spark: SparkSession, p: Pointer, models: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The models of a build that are queries over its others."""
    lookups = {name: sized(models[name]) for name in DIMENSIONS if name != "dim_date"}
    out = {"mart_operational": marts.mart_operational(
        models["fct_service_requests"], lookups["dim_geography"], lookups["dim_request_type"],
        lookups["dim_department"], lookups["dim_status"], p.as_of)}
    main = table.snapshot(spark, p.main, p.main_commit) if p.main else None
    if main is not None:
        out["stg_service_requests"] = staging.stg_service_requests(
            table.read(spark, p.main, snap=main), p.as_of, audit_column=True)
    return out


def expire(spark: SparkSession, root: str, keep: int = 3) -> int:
    """Delete builds older than the newest ``keep``, what failed builds have left, and the commits
    of the facts that no kept build needs. Not while a build is running. Returns the number of
    folders deleted."""
    numbers = _numbers(spark, root)
    kept = [pointer(spark, root, n) for n in numbers[-keep:]]
    for n in numbers[:-keep]:
        table.delete(spark, f"{root}/published/{n:010d}.json")
    dead = set(table.children(spark, f"{root}/builds")) - {p.run for p in kept}
    for run in dead:
        table.delete(spark, f"{root}/builds/{run}")
    for name in {name for p in kept for name in p.facts}:
        table.expire(spark, f"{root}/{name}", 1, min(p.facts[name] for p in kept if name in p.facts))
    return len(dead)
