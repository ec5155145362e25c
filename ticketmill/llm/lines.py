"""Line dedup: lines that several documents share stay in one document only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.frames import WHITE, pick, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else as it is; plain ASCII takes the built-in's fast path."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def drop_shared_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with ``text`` less its shared lines, and ``n_lines`` and ``n_dropped``.

    A key of at least ``min_chars`` code points that at least ``min_docs`` documents hold loses
    its lines everywhere but in the largest doc_id that holds it (there, all of its lines stay).
    Keys are compared as 128 bits of hash.

    Null or empty text is one empty line; a text of which nothing is left becomes empty. A null
    doc_id counts as no document: it never raises a count and never is the largest. Rows that
    repeat a doc_id are one document when documents are counted, and each is cleaned by itself.
    Columns called n_lines or n_dropped are replaced; all other columns pass through.
    """
    slim = pick(docs, "doc_id", "text").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lines = (
        slim.select("doc_id", F.xxhash64("text").alias("print"),
                    F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
        .select("doc_id", "print", "pos", line_key(F.col("line")).alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select("doc_id", "print", "pos", F.xxhash64("key").alias("k1"),
                F.xxhash64(F.lit(min_chars), "key").alias("k2"))
    )
    lines = written(lines, "lines")
    shared = written(
        lines.groupBy("k1", "k2")
        .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("owner"))
        .where(F.col("n") >= min_docs).select("k1", "k2", "owner"), "shared-lines")
    gone = (
        lines.join(shared, ["k1", "k2"])
        .where(F.col("doc_id").isNull() | (F.col("doc_id") != F.col("owner")))
        .groupBy("doc_id", "print").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    )
    names = docs.columns
    at, cols = names.index, [f"c{i}" for i in range(len(names))]
    d = docs.toDF(*cols).withColumn("body", F.coalesce(cols[at("text")], F.lit("")))
    d = d.withColumn("own_print", F.xxhash64("body"))
    both = d.join(gone, d[cols[at("doc_id")]].eqNullSafe(gone["doc_id"])
                  & (d["own_print"] == gone["print"]), "left")
    both = both.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>"))).withColumn(
        "lines", F.split("body", "\n", -1))
    kept = F.when(F.size("gone") == 0, F.col("body")).otherwise(_without())
    return both.select(
        *((kept if n == "text" else F.col(c)).alias(n) for n, c in zip(names, cols)
          if n not in ("n_lines", "n_dropped")),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size("gone").cast("bigint").alias("n_dropped"))


def _without() -> Column:
    """The lines between the dropped ones, joined; one pass over either array."""
    starts = F.concat(F.array(F.lit(1)), F.transform("gone", lambda p: p + 2))
    ends = F.concat(F.col("gone"), F.array(F.size("lines")))
    runs = F.zip_with(starts, ends, lambda s, e: F.slice("lines", s, e - s + 1))
    return F.array_join(F.flatten(runs), "\n")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: line counts and the SHA-256 of what is left."""
    return drop_shared_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = """
WITH lines AS (
  SELECT doc_id, i AS pos, l[i] AS line, len(l) AS n_lines,
         translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents) d,
       generate_series(1, len(l)) AS g(i)
), shared AS (
  SELECT key, max(doc_id) AS owner FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT a.*, b.key IS NOT NULL AND a.doc_id <> b.owner AS gone
  FROM lines a LEFT JOIN shared b ON a.key = b.key
)
SELECT doc_id, max(n_lines)::BIGINT AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id
"""
