"""Arrow batches inside tasks: small slices, texts as flat bytes, word and shingle hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ticketmill.llm.frames import ship

U64 = np.uint64
#: Bytes of text worked on at once; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 21


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
           ) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of at most ``most`` bytes of ``column`` (one row at least)."""
    if not batch.num_rows:
        return
    offsets = flat(batch.column(column))[1]
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, "right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text or binary column, and the n + 1 offsets of its rows; null is empty."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, ends, data = texts.buffers()
    offsets = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def per_slice(docs: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str,
              column: str = "text", most: int = SLICE_BYTES) -> DataFrame:
    """``fn`` over slices of every batch; it returns the columns of ``schema`` by name."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for part in slices(batch, column, most):
                made = fn(part)
                yield pa.RecordBatch.from_arrays(
                    [x if isinstance(x, pa.Array) else pa.array(x) for x in map(made.get, names)],
                    names=names)

    ship(docs.sparkSession)
    return docs.mapInArrow(run, schema)


# --- hashes --------------------------------------------------------------------------------

BASE = U64(0x9E3779B97F4A7C15)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


#: Primes below 2 ** 31: products of residues fit into 64 bits, and so do sums of 2 ** 33 of them.
PRIMES = (2147483647, 2147483629)


#: The longest powers so far of a base and a prime, 4 bytes each.
_powers: dict[tuple[int, int], np.ndarray] = {}
#: Longer ones are not kept: they serve a single long text.
KEPT = 1 << 22


def powers(n: int, base: int, prime: int) -> np.ndarray:
    """base ** i modulo ``prime`` for i < n."""
    out = _powers.get((base, prime), np.ones(1, np.uint32))
    while len(out) < n:
        step = U64(pow(base, len(out), prime))
        out = np.concatenate([out, (out.astype(U64) * step % U64(prime)).astype(np.uint32)])
    if len(out) <= KEPT:
        _powers[base, prime] = out
    return out[:n]


@lru_cache(maxsize=8)
def byte_codes(seed: int, prime: int) -> np.ndarray:
    """A residue for each byte, and after them a base."""
    return np.random.default_rng(seed).integers(1 << 16, prime, 257, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a 64-bit value spread over all others."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Rolling:
    """Hashes of any byte ranges of one buffer, from sums of bytes times powers of a base, modulo
    two primes: texts made to collide for any base modulo a power of two do not."""

    def __init__(self, raw: np.ndarray, seed: int = 1):
        self.parts = []
        for prime in PRIMES:
            *codes, base = byte_codes(seed, prime)
            sums = np.zeros(len(raw) + 1, U64)
            terms = np.array(codes, U64)[raw] * powers(len(raw), int(base), prime)
            np.cumsum(terms % U64(prime), out=sums[1:])
            unshift = powers(len(raw) + 1, pow(int(base), -1, prime), prime)
            self.parts.append((sums, unshift, U64(prime)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = np.zeros(len(start), U64)
        for sums, unshift, prime in self.parts:
            h = (h << U64(31)) | ((sums[end] - sums[start]) % prime * unshift[start] % prime)
        return mixed(h + (end - start).astype(U64) * BASE)


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows, and where each row's words begin (n + 1)."""
    full = np.zeros(len(raw) + 1, bool)
    full[:-1] = ~SPACE[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[offsets] = True
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = full[:-1]
    starts = np.flatnonzero(full & (~before | cut))
    ends = np.flatnonzero(before & (~full | cut))
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and where each row's words begin."""
    starts, ends, at = words(raw, offsets)
    return Rolling(raw).of(starts, ends), at


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of ``size`` words in a row; of all of them at once if there are fewer."""
    n = min(size, len(hashes))
    if not n:
        return hashes[:0]
    total = np.zeros(len(hashes) - n + 1, U64)
    for i in range(n):
        total = (total + hashes[i:len(hashes) - n + 1 + i]) * BASE
    return mixed(total + U64(n))
