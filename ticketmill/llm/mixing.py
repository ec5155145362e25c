"""Mixing sources to target weights: capped water-filling, then seeded repetitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.frames import WORD, pick, written

WEIGHTS = (1, 2, 3)
EPOCHS = 3
SEED = 20260101


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _draw() -> Column:
    """A document's place in the seeded order, uniform in [0, 1): 52 bits of a digest, which
    every SQL engine computes alike."""
    digest = F.md5(F.concat_ws("|", F.lit(str(SEED)), F.col("doc_id").cast("string"), "text"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def weighted(sources: DataFrame, weights: tuple[int, ...]) -> DataFrame:
    """Sources with ``weight``: the weights repeat along the sources in code point order, null
    last. Places come from sorted ranges and the ranges' row counts, so no task sees them all."""
    order = F.col("source").asc_nulls_last()
    ranges = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = written(sources.repartitionByRange(ranges, order)
                     .withColumn("part", F.spark_partition_id()), "ranged-sources")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy("part").count().select(
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(order)) + F.col("before") - 1
    nth = (place % len(weights)).cast("int") + 1
    return ranged.join(offsets, "part").withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), nth)).drop("part", "before")


def water_fill(sources: DataFrame, epochs: int) -> DataFrame:
    """Adds ``target``. Sources whose share by weight is over ``epochs`` times their size are
    clamped there and the rest shared anew, until none is above. Each round is one sum over the
    sources; sums are of whole numbers, so reruns agree to the last bit."""
    cap = F.col("source_size") * epochs
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    level, left = (total or 0) / (weight or 1), None
    while True:
        over = F.col("weight") * F.lit(level) >= cap
        clamped, rest = sources.agg(
            F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("weight")))).first()
        if not rest or rest == left:
            break
        level, left = (total - (clamped or 0)) / rest, rest
    share = F.col("weight") * F.lit(level)
    return sources.withColumn(
        "target", F.when(share >= cap, cap.cast("double")).otherwise(share))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies`` (0 to ``epochs``).

    A source's documents are all taken floor(target / size) times; the fraction left is filled
    with documents in seeded order, up to the one in whose middle it ends. So a source misses
    its target by half a document at most. Finding that one sums square-root-many slices of the
    seeded order per source and then looks into one slice, so a hot source never meets in one
    task.

    A null source is a source of its own, in the last place. Null text has size 0; a table or
    source without words has target 0. Rows repeating both doc_id and text are taken alike.
    Columns with the names of those added are replaced; all others pass through.
    """
    slim = pick(docs, "doc_id", "text", "source")
    drawn = written(slim.select("source", n_words(F.col("text")).alias("size"),
                                _draw().alias("draw")), "draws")
    sums = drawn.groupBy("source").agg(F.sum("size").alias("source_size"),
                                       F.count(F.lit(1)).alias("n"))
    sources = written(water_fill(written(weighted(sums, weights), "sources"), epochs)
                      .withColumn("whole", F.when(F.col("source_size") > 0, F.floor(
                          F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
                      .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
                      .withColumn("slices", F.ceil(F.sqrt("n"))), "targets")
    cuts = written(_cuts(drawn, sources), "cuts")
    plan = written(sources.alias("s").join(
        cuts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
        "s.source", "source_size", "target", "whole",
        F.coalesce("cut", F.lit(-1.0)).alias("cut")), "plan")

    names, cols = docs.columns, [f"c{i}" for i in range(len(docs.columns))]
    d = docs.toDF(*cols)
    d = d.withColumns({n: F.col(cols[names.index(n)]) for n in ("doc_id", "text")})
    d = d.withColumn("size", n_words(F.col("text"))).withColumn("draw", _draw())
    both = d.join(plan, d[cols[names.index("source")]].eqNullSafe(plan["source"]))
    copies = F.col("whole") + F.when(F.col("draw") <= F.col("cut"), 1).otherwise(0)
    made = {"size": F.col("size"), "source_size": F.col("source_size"),
            "target": F.col("target"), "copies": copies.cast("bigint")}
    return both.select(*(F.col(c).alias(n) for n, c in zip(names, cols) if n not in made),
                       *(v.alias(k) for k, v in made.items()))


def _cuts(drawn: DataFrame, sources: DataFrame) -> DataFrame:
    """(source, cut): documents drawn at or below ``cut`` are taken once more."""
    keyed = sources.where(F.col("rest") > 0).select(
        F.col("source").alias("of"), "rest", "slices")
    sliced = drawn.join(keyed, F.col("source").eqNullSafe(F.col("of"))).withColumn(
        "slice", F.floor(F.col("draw") * F.col("slices")))
    upto = Window.partitionBy("of").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    ends = (
        sliced.groupBy("of", "slice").agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
        .withColumn("end", F.sum("words").over(upto))
        .where((F.col("end") - F.col("words") <= F.col("rest"))
               & (F.col("end") >= F.col("rest"))).groupBy("of").agg(
            F.min(F.struct("slice", (F.col("end") - F.col("words")).alias("start"), "rest")).alias("at"))
        .select(F.col("of").alias("hit"), "at.slice", "at.start", "at.rest")
    )
    ends = written(ends, "slice-ends")
    inside = sliced.drop("rest").join(
        ends, F.col("of").eqNullSafe(F.col("hit")) & (sliced["slice"] == ends["slice"])).select(
        "of", "draw", "size", ends["slice"], "start", "rest", "slices")
    within = Window.partitionBy("of").orderBy("draw", "size").rowsBetween(
        Window.unboundedPreceding, 0)
    middle = F.col("start") + F.sum("size").over(within) - F.col("size") / 2
    first_of_slice = F.col("slice") / F.col("slices")
    return (
        inside.withColumn("middle", middle)
        .groupBy("of").agg(
            F.max(F.when(F.col("middle") <= F.col("rest"), F.col("draw"))).alias("last"),
            F.min(first_of_slice).alias("edge"))
        # with none of the slice taken, all slices before it are
        .select(F.col("of").alias("source"),
                F.coalesce("last", F.col("edge") - F.lit(2.0**-53)).alias("cut"))
    )


def repeated(docs: DataFrame) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    again = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return mix(docs).select(*(F.col(f"`{c}`") for c in docs.columns), again.alias("again")).drop(
        "again")


def shares(docs: DataFrame) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken."""
    return mix(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"))


SQL = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         ('0x' || substr(md5(concat_ws('|', '20260101', doc_id::VARCHAR, text)), 1, 13))::BIGINT
           / 4503599627370496.0::DOUBLE AS draw
  FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), capped AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight,
         3 * source_size AS cap FROM sums
), filled AS (
  SELECT *, row_number() OVER o AS nth,
         (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM capped
  WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST),
         before AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), levelled AS (
  SELECT source, source_size, cap, weight,
         (SELECT level FROM filled WHERE weight * level < cap ORDER BY nth LIMIT 1) AS level
  FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN weight * level < cap THEN weight * level ELSE cap::DOUBLE END AS target
  FROM levelled
), placed AS (
  SELECT d.doc_id, d.size, d.draw, d.source, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.draw, d.size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT
           - d.size / 2.0::DOUBLE AS middle
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, max(draw) FILTER (WHERE middle <= target - whole * source_size)
              OVER (PARTITION BY source) AS last
  FROM placed
)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN target - whole * source_size > 0 AND draw <= last
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut
"""
