from __future__ import annotations

import numpy as np
import pyarrow as pa

from ticketmill.llm import neighbours

from .frames_for import rows_of


def vectors_frame(spark, rows):
    ids, vectors = zip(*rows) if rows else ((), ())
    return spark.createDataFrame(pa.table({
        "vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(vectors, pa.list_(pa.float32())),
        "label": pa.array([0] * len(ids), pa.int32()), "rank": pa.array([9] * len(ids), pa.int64()),
        "bits": pa.array([9] * len(ids), pa.int64())}))


def plain(rows, every=100, k=10):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
           if i is not None and v and None not in v and len(v) == 24
           and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for q, x in sorted({i: v for i, v in use if i % every == 0}.items()):
        near = sorted((float(np.sqrt(np.add.accumulate((v - x) ** 2)[-1])), i) for i, v in use if i != q)
        out += [(q, n + 1, i, d) for n, (d, i) in enumerate(near[:k])]
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "VECTORS", 150)
    monkeypatch.setattr(neighbours, "QUERIES", 4)
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=24).tolist()) for i in range(800)]
    rows += [(1000 + i, rows[100][1]) for i in range(90)]  # ties of one busy vector
    rows += [(2000 + i, (np.array(rows[200][1]) * (1 + 1e-6 * i)).tolist()) for i in range(60)]
    rows += [(None, rows[3][1]), (3000, None), (3100, []), (3200, [0.0] * 24), (3300, [None] + [1.0] * 23),
             (3400, [float("nan")] * 24), (3500, [float("inf")] + [1.0] * 23), (3600, [1.0] * 5)]
    got = [tuple(r.values()) for r in rows_of(neighbours.search(vectors_frame(spark, rows)))]
    assert sorted(got) == plain(rows)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0] * 24), (1, [2.0] * 24), (2, [1.0] * 23 + [0.0])]
    assert sorted(tuple(r.values()) for r in rows_of(neighbours.search(vectors_frame(spark, rows)))) == plain(rows)
    assert neighbours.search(vectors_frame(spark, [(0, [1.0] * 24)])).collect() == []
    assert neighbours.search(vectors_frame(spark, [])).collect() == []


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(5000, 64)) * rng.uniform(0.5, 3, (5000, 1)), rng.normal(size=(20, 64))
    turn = neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, length, agree = neighbours.encode(x, turn)
    assert bits.shape == (5000, 8)
    inner, half = neighbours.estimate(bits, length, agree, q, turn)
    error = inner - q @ x.T
    assert abs(error.mean()) < 0.02 and (np.abs(error) <= half).mean() > 0.999
