from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.llm import whitening

from .frames_for import rows_of


def vectors_frame(spark, rows, kind=pa.float32()):
    ids, vectors = zip(*rows) if rows else ((), ())
    return spark.createDataFrame(pa.table({
        "vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(kind)),
        "code": pa.array([9] * len(ids), pa.int64()), "n": pa.array([9] * len(ids), pa.int64()),
        "EMBEDDING": pa.array([9] * len(ids), pa.int64())}))


def plain(rows, dims):
    """x of every usable row of one length, the covariance in exact fractions, and deviations."""
    use = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in rows
           if v is not None and len(v) == dims and None not in v and all(map(math.isfinite, v))]
    fitted = sorted({tuple(x) for _, x in use})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    centred = [[Fraction(n * c - s, n) for c, s in zip(x, sums)] for x in fitted]
    cov = [[sum(row[i] * row[j] for row in centred) / n for j in range(dims)] for i in range(dims)]
    return use, n, sums, np.array([[float(c) for c in row] for row in cov])


def check(got, rows, dims, most=16):
    use, n, sums, cov = plain(rows, dims)
    values = np.sort(np.linalg.eigvalsh(cov))[::-1][:most]
    k = int((values > 1e-9 * values[0]).sum())
    assert len(got) == len(use) * k
    mean = np.array([s / n for s in sums])
    by_id = {}
    for r in got:
        by_id.setdefault((r["vec_id"], r["component"]), []).append(r)
    for i, x in use:
        dev = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        made = [by_id[i, c + 1][0] for c in range(k)]
        assert {r["deviation"] for r in made} == {dev if dev < 2**63 else None}
        assert {r["n"] for r in made} == {n}
        assert np.allclose([r["explained"] for r in made], values[:k] / np.trace(cov), rtol=1e-9)
    # the whitened values of the fit list have unit covariance and give back the eigenvalues
    first = {tuple(x): np.array([by_id[i, c + 1][0]["whitened"] for c in range(k)]) for i, x in use}
    w = np.array(list(first.values()))
    assert np.allclose(w.T @ w / n, np.eye(k), atol=1e-8) and np.allclose(w.mean(axis=0), 0, atol=1e-8)
    x = np.array(list(first), float) - mean
    axes = x.T @ w / n / np.sqrt(values[:k])  # V u / e = u
    assert np.allclose(np.linalg.norm(axes, axis=0), 1) and np.allclose(cov @ axes, axes * values[:k], atol=1e-6 * values[0])
    assert max(r["identity_error"] for r in got) < 1e-8 and len({r["identity_error"] for r in got}) == 1


def test_against_exact_fractions(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=20) * np.linspace(0.2, 2, 20)).astype(np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)]  # a busy vector counts once
    rows += [(2000, None), (2001, [None] + [1.0] * 19), (2002, [float("nan")] * 20),
             (2003, [float("inf")] + [0.0] * 19), (2004, []), (9005, rows[11][1])]
    check(rows_of(whitening.whiten(vectors_frame(spark, rows))), rows, 20)


def test_lengths_apart_few_dims_and_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    other = [(100 + i, rng.normal(size=5).tolist()) for i in range(30)]
    got = rows_of(whitening.whiten(vectors_frame(spark, rows + other + [(None, rows[0][1])])))
    nameless = [r for r in got if r["vec_id"] is None]
    assert [r["component"] for r in nameless] == [1, 2, 3]
    check([r for r in got if r["vec_id"] is not None and r["vec_id"] < 100], rows, 3)
    check([r for r in got if r["vec_id"] is not None and r["vec_id"] >= 100], other, 5)


def test_no_variance_gives_no_rows(spark):
    assert whitening.whiten(vectors_frame(spark, [])).collect() == []
    assert whitening.whiten(vectors_frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])])).collect() == []
    flat = [(i, [float(i), 1.0]) for i in range(5)]  # the second dimension never varies
    assert {r["component"] for r in rows_of(whitening.whiten(vectors_frame(spark, flat)))} == {1}


def test_far_entries_stay_exact_or_null(spark):
    rows = [(i, [float(i) * 2.0**20, float(i % 3) * 2.0**25, 0.5]) for i in range(1, 12)]
    got = rows_of(whitening.whiten(vectors_frame(spark, rows, pa.float64())))
    _, n, sums, _ = plain(rows, 3)
    want = {i: sum((n * (math.floor(64 * c) + 1_000_000) - s) ** 2 for c, s in zip(v, sums)) for i, v in rows}
    assert {r["vec_id"]: r["deviation"] for r in got} == {i: d if d < 2**63 else None for i, d in want.items()}
    beyond = whitening.whiten(vectors_frame(spark, [(1, [3e38, 1.0]), (2, [-3e38, 2.0]), (3, [0.0, 0.0])]))
    assert {r["deviation"] for r in rows_of(beyond)} == {None}


def test_codes_limbs_and_covariance():
    z = np.array([[0, -128], [127, 5], [128, 0], [-32769, 1], [2**40, -(2**61)], [0, -128]])
    codes = whitening._packed(z)
    assert [c[0] for c in codes] == [1, 1, 2, 4, 8, 1] and codes[0] == codes[5]
    back = list(whitening._unpacked(pa.record_batch([pa.array(codes, pa.binary())], names=["code"])))
    assert sorted(map(tuple, np.concatenate(back).tolist())) == sorted(map(tuple, z.tolist()))
    for v in (0, 1, -1, 2**150 + 12345, -(2**150) - 999):
        assert sum(x << (40 * i) for i, x in enumerate(whitening._limbs(v))) == v
    rng = np.random.default_rng(5)
    y = rng.integers(-50, 50, (200, 6))
    squares = whitening._squares(y).tolist()
    made = whitening.covariance(200, y.sum(axis=0).tolist(), squares)
    assert np.allclose(made, np.cov(y.T, bias=True), rtol=1e-12)
    assert whitening._squares(y * 2**40).tolist() == [s * 2**80 for s in squares]


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_sample_table(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in docs.collect()]
    check(rows_of(whitening.whiten(docs)), rows, len(rows[0][1]))
