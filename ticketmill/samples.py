"""The ticket model over the order tables: the data every registered query runs on.

Orders with their customers become tickets; segments become departments, nations areas.
The ticket log is written once per session as the main table, dimensions likewise, and the
queries read those tables.
"""

from __future__ import annotations

import uuid
from datetime import date
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill import schemas as S
from ticketmill.functions import dates
from ticketmill.operators import dims, facts, ingest, marts, staging, wap
from ticketmill.plans import build
from ticketmill.plans.loads import Lake
from ticketmill.session import prepare, shared_dir
from ticketmill.sources import pages, table

AS_OF = date(2001, 8, 2)

TARGETS = [("1-URGENT", 1, "Critical", "sample"), ("2-HIGH", 7, "High", "sample"),
           ("3-MEDIUM", 14, "Medium", "sample"), ("5-LOW", 30, "Low", "sample")]
DEPARTMENTS = [("AUTOMOBILE", "Automobile", "Vehicles"), ("BUILDING", "Building", "Works"),
               ("FURNITURE", "Furniture", "Works"), ("HOUSEHOLD", "Household", "Homes")]
CATEGORIES = [("1-URGENT", "Rush"), ("2-HIGH", "Rush"), ("3-MEDIUM", "Routine")]


def _text_key(order_key: Column) -> Column:
    return F.format_string("SR%09d", order_key)


def ticket_log(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders joined to customers as typed tickets; both sides shuffle on the customer key."""
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    created = F.col("o_orderdate").cast("timestamp_ntz")
    even = key % 2 == 0
    done = (status == "F") | ((status == "P") & even)
    closed_day = F.date_add(F.to_date("o_orderdate"), ((key * 7) % 31).cast("int"))
    closed = F.when(done, closed_day.cast("timestamp_ntz"))
    tickets = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        _text_key(key).alias(S.KEY),
        created.alias("created_date"),
        closed.alias("closed_date"),
        F.col("o_orderpriority").alias("sr_type"),
        F.substring("o_orderpriority", 1, 1).alias("sr_short_code"),
        F.when(status == "F", "Completed").when(status == "O", "Open")
        .when(even, "Completed - Dup").otherwise("Open - Dup").alias("current_status"),
        F.col("c_mktsegment").alias("owner_department"),
        F.col("c_nationkey").cast("bigint").alias("community_area"),
        (F.col("o_custkey") % 50 + 1).alias("ward"),
        (status == "P").alias("duplicate"),
        (key % 97 == 0).alias("legacy_record"),
        F.coalesce(closed, created).alias(S.VERSION),
    )
    tickets = ingest.with_calendar_parts(tickets)
    return ingest.exact_columns(ingest.with_missing_columns(tickets, S.TYPED_SCHEMA))


def raw_records(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """The same tickets as all-text records, with the blemishes of a real feed: padded,
    blank and missing keys, blank fields, odd flags, timestamps with and without fraction."""
    log = ticket_log(orders, customer)
    n = F.substring(S.KEY, 3, 18).cast("bigint")

    def text_time(c: str) -> Column:
        plain = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        return F.when(n % 3 == 0, plain).otherwise(dates.iso_text(F.col(c)))

    def flag(c: str) -> Column:
        return F.when(n % 13 == 0, "True").when(n % 17 != 0, F.col(c).cast("string"))

    def blank(when: Column, otherwise: Column) -> Column:
        return F.when(when, "").otherwise(otherwise)

    fields = {
        "sr_number": F.when(n % 5 == 0, F.concat(F.lit("\t"), S.KEY, F.lit("\u2003")))
        .otherwise(F.col(S.KEY)),
        "status": F.col("current_status"),
        "created_date": text_time("created_date"),
        "last_modified_date": text_time("last_modified_date"),
        "closed_date": F.when(F.col("closed_date").isNotNull(), text_time("closed_date"))
        .when(n % 2 == 0, ""),
        "duplicate": flag("duplicate"),
        "legacy_record": flag("legacy_record"),
        "community_area": blank(n % 11 == 0, F.col("community_area").cast("string")),
        "ward": F.col("ward").cast("string"),
        "created_hour": blank(n % 7 == 0, (n % 24).cast("string")),
        "created_day_of_week": F.lit("0"),
        "latitude": blank(n % 19 == 0, (41 + (n % 64) / 64).cast("string")),
        "longitude": (-87 - (n % 64) / 64).cast("string"),
        "x_coordinate": F.lit(""),
        "zip_code": blank(n % 2 == 0, F.lit("60601")),
        "origin": blank(n % 3 == 0, F.lit("phone")),
        "city": F.lit("Springfield"),
        "electricity_grid": blank(n % 4 == 0, F.lit("G1")),
        "parent_sr_number": F.when(F.col("duplicate"), _text_key(n - 1)).otherwise(""),
    }
    good = log.select(
        *[fields.get(f, F.col(f) if f in ("sr_type", "sr_short_code", "owner_department")
                     else F.lit(None).cast("string")).alias(f) for f in S.RAW_FIELDS],
        n.alias("_n"),
    )
    keyless = good.where(F.col("_n") % 101 == 0).withColumn(
        "sr_number", F.when(F.col("_n") % 2 == 0, " "))
    return good.unionByName(keyless).drop("_n")


def sample_areas(nation: DataFrame, region: DataFrame) -> DataFrame:
    """One square per nation, with areas written with thousands separators."""
    k = F.col("n_nationkey").cast("string")
    k1 = (F.col("n_nationkey") + 1).cast("string")
    square = F.concat(
        F.lit("MULTIPOLYGON ((("), k, F.lit(" 0, "), k1, F.lit(" 0, "), k1, F.lit(" 1, "),
        k, F.lit(" 1, "), k, F.lit(" 0)))"))
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("string").alias("area_number"),
        F.col("n_name").alias("area_name"), F.col("r_name").alias("side"),
        square.alias("the_geom"),
        F.format_string("%,d.5", F.col("n_nationkey") * 1000 + 1000).alias("shape_area"),
        F.format_string("%,d", F.col("n_nationkey") * 100 + 4).alias("shape_len"),
    )


class Bed:
    """The sample tables and every model over them, for one data folder and session."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = prepare(spark), sf_dir
        self.root = f"{shared_dir(spark)}/ticketmill/bed-{uuid.uuid4().hex}"
        table.make_folder(spark, self.root, until_exit=True)
        self.as_of = AS_OF

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def scratch(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex}"

    def rows(self, data: list[tuple], schema: str) -> DataFrame:
        names = [field.split()[0] for field in schema.split(", ")]
        return self.spark.createDataFrame(
            pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in data]))

    @cached_property
    def orders(self) -> DataFrame:
        return self.given("orders")

    @cached_property
    def customer(self) -> DataFrame:
        return self.given("customer")

    @cached_property
    def events(self) -> DataFrame:
        return self.given("events")

    @cached_property
    def log(self) -> DataFrame:
        """The main table, written once; one part per year suits the sample's daily rate."""
        root = f"{self.root}/service_requests"
        table.create(self.spark, root, S.TYPED_SCHEMA, table.Layout("created_date", "year"))
        table.overwrite(self.spark, root, ticket_log(self.orders, self.customer))
        return table.read(self.spark, root)

    @cached_property
    def raw_path(self) -> str:
        path = self.scratch("pages")
        pages.write_raw_pages(raw_records(self.orders, self.customer), path)
        return path

    @cached_property
    def raw(self) -> DataFrame:
        return pages.read_raw_pages(self.spark, self.raw_path)

    @cached_property
    def targets(self) -> DataFrame:
        return self.rows(TARGETS, S.SLA_TARGETS_SCHEMA)

    @cached_property
    def areas(self) -> DataFrame:
        return sample_areas(self.given("nation"), self.given("region"))

    @cached_property
    def seeds(self) -> build.Seeds:
        return build.Seeds(self.targets, self.rows(DEPARTMENTS, S.DEPARTMENTS_SCHEMA), self.areas)

    @cached_property
    def stg(self) -> DataFrame:
        return staging.stg_service_requests(self.log, AS_OF)

    @cached_property
    def bounds(self) -> DataFrame:
        """Whole years around the ticket log."""
        return self.log.agg(
            F.to_date(F.trunc(F.min("created_date"), "year")).alias("start"),
            F.add_months(F.trunc(F.max(S.VERSION), "year"), 12).alias("end"))

    @cached_property
    def holidays(self) -> DataFrame:
        """New Year, Independence Day and Christmas of the years in the log."""
        d = F.date_format("date_day", "MM-dd")
        return dims.date_spine(self.bounds).where(d.isin("01-01", "07-04", "12-25")).select(
            F.col("date_day").alias("holiday_date"))

    @cached_property
    def dims(self) -> build.Dimensions:
        return build.write_dimensions(self.spark, f"{self.root}/dims", self.stg, self.seeds,
                                      self.bounds, self.holidays)

    @cached_property
    def fct(self) -> DataFrame:
        return facts.fct_service_requests(self.stg, self.dims.request_type, self.dims.department,
                                          self.dims.status)

    @cached_property
    def sla(self) -> DataFrame:
        return facts.fct_sla_performance(self.stg, self.dims.request_type, self.dims.department)

    @cached_property
    def ops(self) -> DataFrame:
        d = self.dims
        return marts.mart_operational(self.fct, d.geography, d.request_type, d.department,
                                      d.status, AS_OF)

    @cached_property
    def perf(self) -> DataFrame:
        d = self.dims
        return marts.mart_sla_performance(self.sla, d.geography, d.request_type, d.department)

    def lake(self) -> Lake:
        """A new, empty lake."""
        return Lake(self.scratch("lake"))

    # --- the change feed: the state of a user's day, with a version per event ------------

    @cached_property
    def feed(self) -> DataFrame:
        day = F.date_format("ts", "yyyy-MM-dd")
        return self.events.withColumn(
            "state_key", F.concat(F.col("user_id").cast("string"), F.lit("/"), day))

    def feed_target(self) -> DataFrame:
        """The states stored at noon of 20 January."""
        return self._latest(F.col("ts") < "2024-01-20 12:00:00")

    def feed_source(self) -> DataFrame:
        """What is read next, from the start of that day: known, newer and new states."""
        return self._latest(F.col("ts") >= "2024-01-20 00:00:00")

    def _latest(self, condition: Column) -> DataFrame:
        return wap.latest_wins(self.feed.where(condition), "state_key", "ts", ["event_id"])


_beds: dict[tuple[str, str], Bed] = {}


def bed(spark: SparkSession, sf_dir: str) -> Bed:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _beds:
        _beds[key] = Bed(spark, key[1])
    return _beds[key]


