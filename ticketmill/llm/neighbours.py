"""Nearest neighbours by one-bit codes of randomly rotated vectors.

A vector's unit direction is rotated and kept as one sign bit per dimension, packed, with two
correction scalars: its length and the inner product of direction and code. From these, the inner
product of a query with any vector is estimated without bias, with an error bound; only vectors
whose bound reaches into the nearest found so far are measured exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ticketmill.llm.frames import pick, ship

NEAREST = 10
#: Vectors and queries compared in one piece of work.
VECTORS, QUERIES = 8192, 1024
#: Half width of the error bound, in standard errors of an estimate.
WIDTH = 4.0
SEED = 2


def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same on every executor."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, lengths, and inner products of directions with their codes."""
    length = np.linalg.norm(x, axis=1)
    turned = (x / length[:, None]) @ turn
    agree = np.abs(turned).sum(axis=1) / np.sqrt(x.shape[1])
    return np.packbits(turned > 0, axis=1), length, agree


def estimate(bits: np.ndarray, length: np.ndarray, agree: np.ndarray, queries: np.ndarray,
             turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (query by vector) and half widths of their bounds."""
    dims = queries.shape[1]
    turned = (queries @ turn).astype(np.float32)
    signs = np.unpackbits(bits, axis=1, count=dims).astype(np.float32) * 2 - 1
    seen = turned @ signs.T / np.float32(np.sqrt(dims))
    spread = np.sqrt(np.maximum(0, 1 - agree**2)) / agree / np.sqrt(max(dims - 1, 1))
    norm = np.linalg.norm(queries, axis=1)[:, None]
    # the small term covers rounding to single precision
    return seen * (length / agree), norm * (length * (WIDTH * spread + 1e-5))


def distance(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed dimension by dimension so that every engine agrees."""
    squares = (vectors - query) ** 2
    return np.sqrt(np.add.accumulate(squares, axis=1)[:, -1])


def nearest(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray,
            bits: np.ndarray, length: np.ndarray, agree: np.ndarray, k: int):
    """Of one block: (query, id, distance) rows, the ``k`` nearest of each query by distance,
    then id. ``ids`` ascend. Rows with the query's own id are left out."""
    inner, half = estimate(bits, length, agree, queries, rotation(queries.shape[1]))
    own = np.einsum("ij,ij->i", queries, queries)[:, None]
    low = own + length**2 - 2 * (inner + half)
    out = []
    for q in range(len(queries)):
        other = ids != query_ids[q]
        bound = np.where(other, low[q], np.inf)
        left = np.flatnonzero(other)
        first = left[np.argsort(bound[left], kind="stable")[:4 * k]]
        exact = distance(vectors[first], queries[q])
        if len(first) < len(left):
            reach = np.partition(exact, k - 1)[k - 1] ** 2
            more = left[bound[left] <= reach * (1 + 1e-9) + 1e-12]
            first = np.union1d(first, more)
            exact = distance(vectors[first], queries[q])
        best = np.lexsort((ids[first], exact))[:k]
        out.append((np.full(len(best), query_ids[q]), ids[first][best], exact[best]))
    return out


def search(vectors: DataFrame, every: int = 100, k: int = NEAREST) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (Euclidean distance, double precision).

    Queries are the rows whose vec_id is divisible by ``every``; each is held against all other
    rows, in blocks of bounded size, so busy values and copies spread like any others. Ties go to
    the smaller vec_id. Rows whose vec_id or vector is null, and vectors that are empty, zero,
    hold a null, an infinity or no number, take no part; nor do vectors whose dimension is not
    the commonest (of equals the largest). Rows that repeat a vec_id are the same vector to a
    query of that id, and otherwise candidates each. Other columns are not read.
    """
    spark = vectors.sparkSession
    ship(spark)
    slim = pick(vectors, "vec_id", "embedding").select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & (F.abs(v) < F.lit(float("inf"))))
    slim = slim.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
                      & F.exists("embedding", lambda v: v != 0))
    dims = slim.groupBy(F.size("embedding").alias("dims")).count().orderBy(
        F.desc("count"), F.desc("dims")).first()
    if dims is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    n_dims, n = dims["dims"], dims["count"]
    slim = slim.where(F.size("embedding") == n_dims)

    def with_codes(batches):
        turn = rotation(n_dims)
        for batch in batches:
            x = batch.column("embedding").flatten().to_numpy().reshape(-1, n_dims)
            if not len(x):
                continue
            bits, length, agree = encode(x, turn)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("embedding"),
                 pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(length),
                 pa.array(agree)], names=["vec_id", "embedding", "bits", "length", "agree"])

    coded = slim.mapInArrow(with_codes, "vec_id bigint, embedding array<double>, bits binary, "
                                        "length double, agree double")
    blocks = -(-n // VECTORS)
    asked = slim.where(F.col("vec_id") % every == 0)
    query_blocks = max(1, -(-asked.count() // QUERIES))
    spread = F.xxhash64("vec_id")
    left = coded.withColumn("block", F.pmod(spread, F.lit(blocks))).withColumn(
        "of", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = asked.withColumn("of", F.pmod(spread, F.lit(query_blocks))).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).select(
        F.col("of").cast("int").alias("of"), F.col("block").cast("bigint").alias("block"),
        "vec_id", "embedding")

    def compare(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        found = []
        if mine.num_rows and theirs.num_rows:
            mine = mine.sort_by("vec_id").combine_chunks()

            def matrix(t: pa.Table) -> np.ndarray:
                return t.column("embedding").combine_chunks().flatten().to_numpy().reshape(-1, n_dims)

            bits = np.frombuffer(b"".join(mine.column("bits").to_pylist()), np.uint8)
            x, q = matrix(mine), matrix(theirs)
            for at in range(0, len(q), 128):
                found += nearest(
                    x, mine.column("vec_id").to_numpy(), q[at:at + 128],
                    theirs.column("vec_id").to_numpy()[at:at + 128],
                    bits.reshape(mine.num_rows, -1), mine.column("length").to_numpy(),
                    mine.column("agree").to_numpy(), k)
        columns = [np.concatenate(c) for c in zip(*found)] if found else [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()),
                         "vec_id": pa.array(columns[1], pa.int64()),
                         "score": pa.array(columns[2], pa.float64())})

    best = left.groupBy("block", "of").cogroup(right.groupBy("block", "of")).applyInArrow(
        compare, "query_id bigint, vec_id bigint, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         sqrt(list_sum([(t[1] - t[2]) * (t[1] - t[2]) for t in list_zip(q.v, c.v)])) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 10
"""
