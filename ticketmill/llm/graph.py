"""Connected components of a link table, by rounds of joins."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.frames import ship, written

#: Up to this many links (16 bytes each) one task joins them; more are joined by rounds.
ONE_TASK = 500_000


def _both_ways(links: DataFrame) -> DataFrame:
    return links.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        links.select(F.col("b").alias("u"), F.col("a").alias("v")))


def _united(batches):
    """Roots of all nodes of one task's links, by union-find; a root is its smallest node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
            parent[max(x, y)] = min(x, y)
    nodes = sorted(parent)
    yield pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.int64()), pa.array([root(n) for n in nodes], pa.int64())],
        names=["node", "component"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of links (a, b).

    Each round, every node hands its larger neighbours to its smallest (large star), then every
    node its smaller ones (small star); links end as stars around the smallest nodes, after a
    number of rounds that grows with the logarithm of the longest chain. A busy node is one sum
    (a minimum, combined before the shuffle) and a join whose large parts Spark splits. The rounds
    are dozens of short jobs, so a counted number of at most ONE_TASK links is joined in one task
    instead, with the same result.
    """
    links = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                    .where("a < b").distinct(), "links")
    if links.limit(ONE_TASK + 1).count() <= ONE_TASK:
        ship(links.sparkSession)
        return links.coalesce(1).mapInArrow(_united, "node bigint, component bigint")
    before = None
    while True:
        around = _both_ways(links)
        least = written(around.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("n"), F.least("u", "m").alias("m")), "least")
        links = written(around.join(least, F.col("u") == F.col("n")).where("v > u").select(
            F.col("m").alias("a"), F.col("v").alias("b")).where("a < b").distinct(), "large-star")
        # each node now joins its smaller neighbours, and itself, to the smallest of them
        least = links.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("n"), "m")
        joined = links.join(least, F.col("b") == F.col("n"))
        links = written(joined.select(F.col("m").alias("a"), F.col("a").alias("b"))
                        .where("a < b").union(least.select(F.col("m").alias("a"),
                                                           F.col("n").alias("b")))
                        .distinct(), "small-star")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
                        ).first()
        if now == before:
            break
        before = now
    centres = links.select("a").distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).union(
        centres.select("a", "a"))
