"""Embedding whitening by polarisation covariance.

Entries become integers, so every aggregate is exact and the same on any cluster. For centred
values a and b, var(a + b) - var(a) - var(b) = 2 cov(a, b): squares of each dimension and of each
sum of two dimensions are all that is aggregated. The covariance matrix, put together from them on
the driver (its size is that of a vector squared, whatever the number of rows), goes to ``eigh``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.frames import pick, ship, written

#: Fixed values of the contract: units per one, and what is added to every entry.
UNITS, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Entries beyond this many units count as this many: what a long holds, sums of two included.
FARTHEST = 1 << 61
#: An exact total travels as this many longs of 40 bits each, the last one signed.
LIMBS, LIMB_BITS = 5, 40
LIMB_NAMES = [f"limb{i}" for i in range(LIMBS)]


@dataclass(frozen=True)
class Whitening:
    """What was learned from the vectors of one length: their number, the whole part of each
    dimension's mean (``base``) and the rest times n (``rest``), unit components in columns."""

    n: int
    base: np.ndarray
    rest: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    def whitened(self, z: np.ndarray) -> np.ndarray:
        centred = (z - self.base).astype(float) - np.array([r / self.n for r in self.rest])
        return centred @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, z: np.ndarray) -> list[int | None]:
        """Sums over dimensions of (n * x - S) ** 2, exact; None beyond a long."""
        y, rest = z - self.base, np.array(self.rest, object)
        widest = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if widest**2 * z.shape[1] < 2**63:
            return (((self.n * y - rest.astype(np.int64)) ** 2).sum(axis=1)).tolist()
        exact = ((self.n * y.astype(object) - rest) ** 2).sum(axis=1)
        return [int(v) if v < 2**63 else None for v in exact]


# --- vectors as bytes ----------------------------------------------------------------------

def _units(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, units) for each length of vector: a matrix of floor(64 * c), without the rows that
    are null, empty, or hold null or non-finite entries."""
    column = batch.column("embedding")
    column = column.cast(pa.large_list(column.type.value_type))
    offsets = np.asarray(column.offsets)
    entries = column.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.float64())
    values = entries.to_numpy(zero_copy_only=False)  # null becomes nan
    offsets = offsets - offsets[0]
    seen = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    lengths = np.diff(offsets)
    fine = np.asarray(column.is_valid()) & (lengths > 0) & (seen[offsets[1:]] == seen[offsets[:-1]])
    for dims in np.unique(lengths[fine]).tolist():
        rows = np.flatnonzero(fine & (lengths == dims))
        taken = values[offsets[rows][:, None] + np.arange(dims)]
        # a float, being a multiple of a power of two, keeps all its bits times 64
        units = np.clip(np.floor(taken * UNITS), -FARTHEST, FARTHEST)
        yield rows, units.astype(np.int64)


def _packed(z: np.ndarray) -> list[bytes]:
    """Each row as a byte that says how wide its entries are, then the entries, no wider than the
    row needs: equal rows give equal bytes."""
    out = np.empty(len(z), object)
    widest = np.maximum(z.max(axis=1), -1 - z.min(axis=1))
    before = -1
    for width in (1, 2, 4, 8):
        most = (1 << (8 * width - 1)) - 1
        rows = np.flatnonzero((widest > before) & (widest <= most))
        flat = np.ascontiguousarray(z[rows].astype(f"<i{width}")).tobytes()
        size = width * z.shape[1]
        for k, row in enumerate(rows.tolist()):
            out[row] = bytes([width]) + flat[k * size:(k + 1) * size]
        before = most
    return out.tolist()


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Matrices of units, one per length and width."""
    kinds: dict[tuple[int, int], list[bytes]] = {}
    for code in batch.column("code").to_pylist():
        kinds.setdefault((len(code), code[0]), []).append(code[1:])
    for (size, width), codes in kinds.items():
        flat = np.frombuffer(b"".join(codes), f"<i{width}")
        yield flat.reshape(len(codes), (size - 1) // width).astype(np.int64)


# --- exact totals --------------------------------------------------------------------------

def _limbs(total: int) -> list[int]:
    out = []
    for _ in range(LIMBS - 1):
        out.append(total & ((1 << LIMB_BITS) - 1))
        total >>= LIMB_BITS
    return [*out, total]


def _totals(vectors: DataFrame, per_batch) -> dict[int, list[int]]:
    """For each length of vector, the exact totals over all rows of what ``per_batch`` returns for
    a matrix of units. Tasks send one row per total, so this does not grow with the rows."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for z in _unpacked(batch):
                made = np.asarray(per_batch(z), object)
                dims = z.shape[1]
                sums[dims] = sums[dims] + made if dims in sums else made
        for dims, made in sums.items():
            limbs = [_limbs(int(v)) for v in made]
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * len(limbs), pa.int32()), pa.array(range(len(limbs)), pa.int32()),
                 *(pa.array(column, pa.int64()) for column in zip(*limbs))],
                names=["dims", "place", *LIMB_NAMES])

    schema = "dims int, place int, " + ", ".join(f"{c} bigint" for c in LIMB_NAMES)
    parts = vectors.mapInArrow(run, schema)
    found = parts.groupBy("dims", "place").agg(*(F.sum(c).alias(c) for c in LIMB_NAMES)).collect()
    out: dict[int, list[int]] = {}
    for r in sorted(found, key=lambda r: (r["dims"], r["place"])):
        total = sum(r[c] << (LIMB_BITS * i) for i, c in enumerate(LIMB_NAMES))
        out.setdefault(r["dims"], []).append(total)
    return out


def _column_sums(z: np.ndarray) -> list[int]:
    """The number of rows, then the sum of every dimension."""
    small = len(z) * int(np.abs(z).max(initial=0)) < 2**62
    return [len(z), *(z if small else z.astype(object)).sum(axis=0).tolist()]


def _squares(y: np.ndarray) -> np.ndarray:
    """Sums of squares of every dimension, then of every sum of two (0+1, 0+2, ... 1+2, ...)."""
    if 4 * len(y) * int(np.abs(y).max(initial=0)) ** 2 >= 2**62:
        y = y.astype(object)
    parts = [(y * y).sum(axis=0)]
    for i in range(y.shape[1] - 1):
        both = y[:, i + 1:] + y[:, i:i + 1]
        parts.append((both * both).sum(axis=0))
    return np.concatenate(parts).astype(object)


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix (divisor n), each entry rounded once from its exact value.

    With y the units less the whole part of their mean and R their sums, n * y - R is n times the
    centred value, and the sum of its squares is n * (n * sum(y ** 2) - R ** 2): an identity of
    integers, so nothing is lost by squaring y in the tasks and centring exactly here.
    """
    dims = len(rest)
    var = [n * squares[i] - rest[i] ** 2 for i in range(dims)]
    out = np.diag([v / n**2 for v in var])
    place = dims
    for i in range(dims):
        for j in range(i + 1, dims):
            both = n * squares[place] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - var[i] - var[j]) / (2 * n**2)
            place += 1
    return out


# --- the operator --------------------------------------------------------------------------

def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(code): each usable vector in units once, as bytes."""
    def run(batches):
        for batch in batches:
            for _, z in _units(batch):
                yield pa.RecordBatch.from_arrays([pa.array(_packed(z), pa.binary())], names=["code"])

    ship(rows.sparkSession)
    return pick(rows, "embedding").mapInArrow(run, "code binary").distinct()


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """A whitening for each length of vector in ``vectors`` (written codes). Components without
    variance, as when there are fewer vectors than dimensions, are left out."""
    counted = _totals(vectors, _column_sums)
    numbers = {dims: sums[0] for dims, sums in counted.items()}
    bases = {dims: np.array([s // sums[0] for s in sums[1:]], np.int64)
             for dims, sums in counted.items()}
    squares = _totals(vectors, lambda z: _squares(z - bases[z.shape[1]]))
    out = {}
    for dims, (n, *sums) in counted.items():
        rest = [s - n * int(b) for s, b in zip(sums, bases[dims])]
        v = covariance(n, rest, squares[dims])
        values, axes = np.linalg.eigh(v)
        falling = np.argsort(-values, kind="stable")[:components]
        falling = falling[values[falling] > dims * np.finfo(float).eps * max(values.max(), 0)]
        axes = axes[:, falling]
        if axes.size:  # either sign is right; take the one that reruns agree on
            axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
        out[dims] = Whitening(numbers[dims], bases[dims], rest, axes, values[falling],
                              float(np.trace(v)))
    return out


def identity_errors(vectors: DataFrame, models: dict[int, Whitening]) -> dict[int, float]:
    """For each length, the largest absolute entry of the whitened vectors' covariance, measured
    over all of them, minus the identity."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for z in _unpacked(batch):
                w = models[z.shape[1]].whitened(z)
                made = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
                sums[z.shape[1]] = sums.get(z.shape[1], 0) + made
        for dims, made in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * len(made), pa.int32()), pa.array(range(len(made)), pa.int32()),
                 pa.array(made, pa.float64())], names=["dims", "place", "total"])

    parts = vectors.mapInArrow(run, "dims int, place int, total double")
    found = parts.groupBy("dims", "place").agg(F.sum("total").alias("total")).collect()
    out = {}
    for dims, model in models.items():
        k = len(model.eigenvalues)
        total = {r["place"]: r["total"] for r in found if r["dims"] == dims}
        made = np.array([total[i] for i in range(len(total))]) / model.n
        mean, square = made[:k], made[k:].reshape(k, k)
        error = square - np.outer(mean, mean) - np.eye(k)
        out[dims] = float(np.abs(error).max(initial=0))
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error: a row per
    row of ``rows`` (vec_id, embedding) and component.

    Rows whose vector is null, empty, or holds null or non-finite entries are left out; a null
    vec_id is kept as it is. Repeated vectors count once in what is learned and are each returned.
    Vectors of different lengths are whitened apart, each length by its own fit. Components
    without variance give no rows, so a single vector, or none, gives an empty result. A deviation
    beyond a long is null; entries beyond 2 ** 61 units count as that. Extra columns play no part.

    The vectors in units are written once, without repetitions, and read three times: for sums,
    for squares, and for the covariance after whitening. Only totals reach the driver.
    """
    slim = pick(rows, "vec_id", "embedding")
    vectors = written(distinct_vectors(slim), "units")
    models = fit(vectors, components)
    errors = identity_errors(vectors, models)

    def run(batches):
        for batch in batches:
            ids = batch.column("vec_id")
            for at, z in _units(batch):
                model = models[z.shape[1]]
                k = len(model.eigenvalues)
                again = np.repeat(np.arange(len(z)), k)
                deviation = pa.array(model.deviations(z), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at[again])), pa.array(np.tile(np.arange(1, k + 1), len(z)), pa.int32()),
                     pa.array(np.full(len(again), model.n, np.int64)), deviation.take(pa.array(again)),
                     pa.array(model.whitened(z).ravel()),
                     pa.array(np.tile(model.eigenvalues / model.trace if k else [], len(z)), pa.float64()),
                     pa.array(np.full(len(again), errors[z.shape[1]]))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"])

    return slim.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding").mapInArrow(
        run, "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
             "explained double, identity_error double")
