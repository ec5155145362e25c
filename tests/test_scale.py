"""Properties of the plans that matter at size."""

from __future__ import annotations

import re

import pytest
from helpers import ticket, tickets
from pyspark.sql import functions as F

from ticketmill import registry
from ticketmill.operators import facts, marts, wap
from ticketmill.operators.joins import sized
from ticketmill.samples import Bed
from ticketmill.sources import table

# Queries that only describe a plan when called; the others load tables first.
LAZY = [n for n in registry.load() if n[0] in "tdfmqvx" and n not in (
    "f07_incremental_fact", "f12_incremental_sla", "x05_watermark")]


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairwise_join(bed, name):
    plan = plan_of(registry.load()[name].run(bed))
    assert not re.search("CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("frame", ["fct", "sla", "ops"])
def test_facts_and_backlog_move_no_tickets(bed, frame):
    """Scan, lookups, projection: nothing is shuffled, filters reach the scan."""
    plan = plan_of(getattr(bed, frame))
    assert not re.search(r"(?<!Broadcast)Exchange ", plan)
    assert "SortMergeJoin" not in plan
    assert re.search(r"PushedFilters: \[[^\]]*legacy_record", plan)


def test_backlog_scan_reads_its_columns_only(bed):
    plan = plan_of(bed.ops.groupBy("department_name").count())
    scan = re.search(r"ReadSchema: struct<([^>]*)>", plan)[1]
    assert "zip_code" not in scan and "latitude" not in scan and "ward" not in scan


def test_equity_reads_the_fact_once(bed):
    plan = plan_of(marts.equity(bed.sla))
    assert len(re.findall(r"FileScan.*service_request_number", plan)) == 1
    shuffles = re.findall(r"(?<!Broadcast)Exchange hashpartitioning\(([a-z_]+)", plan)
    # printed from the top: first the window over grouped rows, then the grouping, of which
    # only partial sums move
    assert shuffles == ["request_type_id", "community_area_id"]
    assert "partial_sum(resolution_days" in plan[plan.index("Exchange hashpartitioning(community"):]


def test_lookups_beyond_the_bound_are_not_broadcast(spark):
    df = spark.range(100).withColumn("t", F.lit("x" * 50))
    big = spark.range(1000)
    for lookup, hinted in ((sized(df), True), (sized(df, max_rows=99), False),
                           (sized(df, max_bytes=1000), False)):
        logical = big.join(lookup, "id")._jdf.queryExecution().analyzed().toString()
        assert ("strategy=broadcast" in logical) is hinted


def test_unbroadcast_lookups_give_the_same_fact(spark, bed):
    few = {d: getattr(bed.dims, d) for d in ("request_type", "department", "status")}
    plain = {n: spark.createDataFrame(d.collect(), d.schema) for n, d in few.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffled = facts.fct_service_requests(
            bed.stg, plain["request_type"], plain["department"], plain["status"])
        assert "SortMergeJoin" in plan_of(shuffled)
        assert shuffled.exceptAll(bed.fct).count() == 0 and bed.fct.exceptAll(shuffled).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    """One key with a third of all rows: only one row per input task is shuffled."""
    rows = spark.range(0, 90_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("K"), "id")).alias("key"),
        F.col("id").alias("version"))
    out = wap.latest_wins(rows, "key", "version", [])
    hot = out.where("key = 'HOT'").first()
    assert hot["version"] == 89_997 and out.count() == 60_001


def test_merge_keeps_one_row_per_key(spark):
    target = tickets(spark, *[ticket(f"K{i}") for i in range(50)])
    source = tickets(spark, *[ticket("K1", modified=f"2026-03-01 00:00:{i:02d}", ward=i)
                              for i in range(60)])
    merged = wap.merge(target, wap.latest_wins(source))
    assert merged.count() == 50 and merged.where("action = 'update'").count() == 1


#: Queries that land pages, and the bytes a ticket may leave in the shared folder with them: page
#: text alone has some 500.
STORED = {"w08_yearly_load": 200, "p02_closed_date": 100, "p09_key_filter": 100, "p06_booleans": 100,
          "x05_watermark": 200, "w07_chunk_loop": 200}


@pytest.fixture(scope="module")
def quarter(spark, tmp_path_factory):
    """Beds over one and two times 20,000 orders of a quarter of 1997."""
    made = []
    for n in (20_000, 40_000):
        folder = tmp_path_factory.mktemp("orders")
        k = F.col("id")
        spark.range(n).select(
            k.alias("o_orderkey"), (k % 997).alias("o_custkey"),
            F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
            F.date_add(F.lit("1997-01-01").cast("date"), (F.xxhash64("id") % 45 + 45).cast("int"))
            .cast("timestamp_ntz").alias("o_orderdate"),
            F.element_at(F.array(*map(F.lit, ("1-URGENT", "2-HIGH", "5-LOW"))), (F.xxhash64("id") % 2 + 2).cast("int"))
            .alias("o_orderpriority")).write.parquet(f"{folder}/orders.parquet")
        spark.range(997).select(
            k.alias("c_custkey"), (k % 25).cast("int").alias("c_nationkey"),
            F.concat(F.lit("S"), (k % 5).cast("string")).alias("c_mktsegment")).write.parquet(f"{folder}/customer.parquet")
        made.append((n, str(folder)))
    return made


@pytest.mark.parametrize("name", STORED)
def test_stored_bytes_per_ticket(spark, quarter, name):
    used = []
    for n, folder in quarter:
        own = Bed(spark, folder)
        kept = registry.load()[name].run(own)
        assert kept.count() >= n
        fs, root = table._fs(spark, own.root)
        used.append(fs.getContentSummary(root).getLength())
        assert used[-1] < STORED[name] * n
    assert used[1] < 2.2 * used[0]
