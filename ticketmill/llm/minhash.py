"""MinHash near-dedup: bands of minima propose pairs, packed low bits estimate their similarity,
full shingle sets confirm it, and confirmed links become components."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import BASE, U64, flat, mixed, per_slice, shingles, word_hashes
from ticketmill.llm.batches import LOWER as LOWER_BYTES
from ticketmill.llm.frames import pick, ship, written
from ticketmill.llm.graph import components

#: 32 bands of 4 minima: a pair at similarity 0.8 shares no band once in 2 * 10 ** 7 times.
BANDS, ROWS = 32, 4
#: Low bits kept of each minimum; two to a byte.
BITS = 4
#: Members of a band's bucket compared in one piece of work, and, where loose members meet the
#: others, sent to one task (which compares BLOCK by BLOCK of them).
BLOCK, TILE = 400, 4096
#: Most bytes of a set's parities, and pairs whose parities are compared at once.
PARITY_BYTES, PARITY_PAIRS = 4096, 1 << 14
#: A shingle table up to this many documents is sent to every executor (8 bytes each).
SEND = 1_000_000
#: What a member of a tile is compared with: the right members, the left ones, or all others.
LEFT, RIGHT, BOTH = 1, 2, 3

_rng = np.random.default_rng(6)
FACTORS = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64) * U64(2) + U64(1)
SHIFTS = _rng.integers(0, 2**63, BANDS * ROWS, np.uint64)


def shingle_sets(batch: pa.RecordBatch, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text of the batch."""
    raw, offsets = flat(batch.column("text"))
    hashes, at = word_hashes(LOWER_BYTES[raw], offsets)
    return [np.unique(shingles(hashes[at[i]:at[i + 1]], size)) for i in range(batch.num_rows)]


def signature(shingle_set: np.ndarray) -> np.ndarray:
    """The least value of each of BANDS * ROWS random orders, as 32 bits."""
    least = np.full(BANDS * ROWS, 2**32 - 1, U64)
    for start in range(0, len(shingle_set), 512):
        part = shingle_set[start:start + 512, None] * FACTORS + SHIFTS
        least = np.minimum(least, (part >> U64(32)).min(axis=0))
    return least


def _band_keys(minima: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, of its minima and its number."""
    key = np.arange(BANDS, dtype=U64)
    for row in minima.reshape(BANDS, ROWS).T:
        key = mixed(key * BASE + row)
    return key


def _pack(minima: np.ndarray) -> bytes:
    low = (minima & U64(2**BITS - 1)).astype(np.uint8)
    return (low[0::2] << 4 | low[1::2]).tobytes()


def _unpack(packed: np.ndarray) -> np.ndarray:
    return np.concatenate([packed >> 4, packed & 15], axis=1)


def parities(shingle_set: np.ndarray) -> bytes:
    """One bit per class of shingles (by hash; about two classes a shingle, a power of two): whether
    the set holds an odd number of the class. Where two sets' bits differ, a shingle is in just one
    of them, so the differing bits count no more than the sets differ by: a bound, not an estimate.
    Adding up halves (xor) gives the bits of half as many classes."""
    classes = min(max(64, 1 << (2 * len(shingle_set) - 1).bit_length()), 8 * PARITY_BYTES)
    odd = np.bincount((shingle_set & U64(classes - 1)).astype(np.int64), minlength=classes) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


class Parities:
    """The parities of a tile's members, for bounds on the similarity of pairs of them."""

    def __init__(self, bits: list[bytes], n_shingles: np.ndarray):
        self.n, self.width = n_shingles, np.array([len(b) for b in bits])
        # members by width, with those of twice the width folded
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in np.unique(self.width).tolist():
            same, twice = (np.flatnonzero(self.width == w) for w in (width, 2 * width))
            flat = np.frombuffer(b"".join(bits[k] for k in same), U64).reshape(len(same), width // 8)
            wide = np.frombuffer(b"".join(bits[k] for k in twice), U64).reshape(len(twice), width // 4)
            half = width // 8
            place = np.full(len(bits), -1)
            place[same], place[twice] = np.arange(len(same)), len(same) + np.arange(len(twice))
            self.by_width[width] = place, np.concatenate([flat, wide[:, :half] ^ wide[:, half:]])

    def may_link(self, a: np.ndarray, b: np.ndarray, per_mille: int) -> np.ndarray:
        """Whether pairs of members can be as similar as that: by their sizes, then their parities."""
        total = self.n[a] + self.n[b]
        out = 1000 * np.minimum(self.n[a], self.n[b]) >= per_mille * np.maximum(self.n[a], self.n[b])
        left = np.flatnonzero(out)
        width = np.minimum(self.width[a[left]], self.width[b[left]])
        for w in np.unique(width).tolist():
            some = left[width == w]
            place, bits = self.by_width[w]
            for k in range(0, len(some), PARITY_PAIRS):
                part = some[k:k + PARITY_PAIRS]
                x, y = place[a[part]], place[b[part]]
                known = (x >= 0) & (y >= 0)  # widths further apart, as of sets far apart in size, say nothing
                differ = np.zeros(len(part), np.int64)
                differ[known] = np.bitwise_count(bits[x[known]] ^ bits[y[known]]).sum(axis=1)
                out[part] = (1000 + per_mille) * differ <= (1000 - per_mille) * total[part]
        return out


def signed(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, two sums that identify the set, band keys, packed low bits, parities."""
    def work(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch, size)
        minima = [signature(s) for s in sets]
        keys = np.concatenate([_band_keys(m) for m in minima]).view(np.int64)
        offsets = np.arange(len(sets) + 1, dtype=np.int32) * BANDS
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": np.array([len(s) for s in sets], np.int64),
            "set1": np.array([s.sum(dtype=U64) for s in sets], U64).view(np.int64),
            "set2": np.array([mixed(s).sum(dtype=U64) for s in sets], U64).view(np.int64),
            "bands": pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
            "packed": pa.array([_pack(m) for m in minima], pa.binary()),
            "odd": pa.array([parities(s) for s in sets], pa.binary()),
        }

    schema = ("doc_id bigint, n_shingles bigint, set1 bigint, set2 bigint, bands array<bigint>, "
              "packed binary, odd binary")
    return per_slice(docs, work, schema)


def estimates(packed: np.ndarray, others: np.ndarray | None = None) -> np.ndarray:
    """Similarity of all rows to ``others`` (to each other, if not given): share of equal low
    bits, less chance hits."""
    low = _unpack(packed)
    right = low if others is None else _unpack(others)
    equal = np.zeros((len(low), len(right)), np.uint16)
    for column, of_right in zip(low.T, right.T):
        equal += column[:, None] == of_right[None]
    chance = 1 / 2**BITS
    return (equal / low.shape[1] - chance) / (1 - chance)


def least_estimate(similarity: float) -> float:
    """Five standard errors below: a true link is put aside once in 3 * 10 ** 6 times."""
    n, chance = BANDS * ROWS, 1 / 2**BITS
    p = similarity + (1 - similarity) * chance
    return similarity - 5 * math.sqrt(p * (1 - p) / n) / (1 - chance)


def _forest(est: np.ndarray, group: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links of a maximum spanning forest over estimates of at least ``least``, where members
    of one ``group`` are joined already."""
    n, out = len(est), []
    inside = np.zeros(n, bool)
    while not inside.all():
        first = int(np.argmin(inside))
        new = np.flatnonzero(group == group[first])
        best, source = np.full(n, -1.0), np.zeros(n, int)
        while True:
            inside[new] = True
            for m in new:
                better = est[m] > best
                best[better], source[better] = est[m][better], m
            best[inside] = -1.0
            nearest = int(np.argmax(best))
            if best[nearest] < least:
                break
            out.append((int(source[nearest]), nearest))
            new = np.flatnonzero((group == group[nearest]) & ~inside)
    return out


def tiles(placed: DataFrame, size: int | None = None) -> DataFrame:
    """(key, block, doc_id, component, packed, side) from (key, doc_id, component, packed): what
    must be compared so that each member outside its bucket's largest component meets the whole
    bucket.

    The loose members are cut into blocks of about ``size`` (BLOCK), and so are those of the largest
    component. Each block of loose ones (LEFT) meets each of the others (RIGHT), each later block
    of loose ones (RIGHT), and itself (BOTH). So a tile has about 2 * ``size`` members at most,
    however many are loose, a member goes to as many tiles as there are blocks, and a pair is in
    one tile.
    """
    size = size or BLOCK
    counts = placed.groupBy("key", "component").count()
    main = written(counts.groupBy("key").agg(
        F.max(F.struct("count", (-F.col("component")).alias("least"))).alias("top"),
        F.sum("count").alias("members"), F.count(F.lit(1)).alias("n")).where("n > 1").select(
        "key", (-F.col("top.least")).alias("main"),
        F.ceil(F.col("top.count") / size).cast("bigint").alias("others"),
        F.ceil((F.col("members") - F.col("top.count")) / size).cast("bigint").alias("loose")), "main")
    cut = F.xxhash64("key", "doc_id")
    open_ = placed.join(main, "key").withColumn("is_loose", F.col("component") != F.col("main"))
    open_ = open_.withColumn("at", F.pmod(cut, F.when(F.col("is_loose"), F.col("loose"))
                                          .otherwise(F.col("others"))))
    at, others, loose = F.col("at"), F.col("others"), F.col("loose")

    def tile(row: Column, column: Column, side: int) -> Column:
        return F.struct((row * (others + loose) + column).alias("block"), F.lit(side).alias("side"))

    every_loose = F.sequence(F.lit(0).cast("bigint"), loose - 1)
    every_other = F.sequence(F.lit(0).cast("bigint"), others - 1)
    of_loose = F.concat(
        F.transform(every_other, lambda j: tile(at, j, LEFT)),
        F.transform(F.filter(every_loose, lambda j: j > at), lambda j: tile(at, others + j, LEFT)),
        F.transform(F.filter(every_loose, lambda i: i < at), lambda i: tile(i, others + at, RIGHT)),
        F.array(tile(at, others + at, BOTH)))
    of_main = F.transform(every_loose, lambda i: tile(i, at, RIGHT))
    return open_.select("key", "doc_id", "component", "packed", F.explode(
        F.when(F.col("is_loose"), of_loose).otherwise(of_main)).alias("tile")).select(
        "key", "tile.block", "doc_id", "component", "packed", "tile.side")


def _candidates(members: DataFrame, least: float, per_mille: int, every: bool) -> DataFrame:
    """Pairs (a, b) inside blocks of (key, block, doc_id, component, packed, side): a spanning
    forest each, or every pair of different components between LEFT and RIGHT, or inside BOTH,
    that estimate, sizes and parities (n_shingles, odd) all let pass."""
    def block_pairs(key_rows: pa.Table):
        ids = key_rows.column("doc_id").to_numpy()
        _, group = np.unique(key_rows.column("component").to_numpy(), return_inverse=True)
        if len(ids) < 2 or group.max() == 0:
            return
        packed = np.frombuffer(b"".join(key_rows.column("packed").to_pylist()), np.uint8)
        packed = packed.reshape(len(ids), -1)
        if every:
            side = key_rows.column("side").to_numpy()
            odd = Parities(key_rows.column("odd").to_pylist(), key_rows.column("n_shingles").to_numpy())
            found = []
            for left in _runs(np.flatnonzero(side != RIGHT)):
                for right in _runs(np.flatnonzero(side != LEFT)):
                    near = estimates(packed[left], packed[right]) >= least
                    a, b = np.nonzero(near & (group[left][:, None] != group[right][None]))
                    a, b = left[a], right[b]
                    use = (side[a] != BOTH) | (ids[a] < ids[b])
                    a, b = a[use], b[use]
                    may = odd.may_link(a, b, per_mille)
                    found.append((a[may], b[may]))
            a, b = (np.concatenate(x) for x in zip(*found)) if found else (ids[:0], ids[:0])
        else:
            found = np.array(_forest(estimates(packed), group, least), np.int64).reshape(-1, 2)
            a, b = found.T
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], ["a", "b"])

    def run(batches):
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = pa.concat_tables([held, table]) if held is not None else table
            keys = held.column("key").to_numpy(), held.column("block").to_numpy()
            cuts = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
            for start, end in zip([0, *cuts[:-1]], cuts):
                yield from block_pairs(held.slice(start, end - start))
            held = held.slice(cuts[-1] if len(cuts) else 0)
        if held is not None and held.num_rows:
            yield from block_pairs(held)

    ship(members.sparkSession)
    n = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        members.repartition(n, "key", "block").sortWithinPartitions("key", "block", "doc_id")
        .mapInArrow(run, "a bigint, b bigint").distinct()
    )


def _runs(places: np.ndarray) -> list[np.ndarray]:
    return [places[k:k + BLOCK] for k in range(0, len(places), BLOCK)]


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs whose full shingle sets are similar enough, judged in whole numbers."""
    per_mille = round(similarity * 1000)
    ids = written(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "ids")
    few = ids.limit(SEND + 1).count() <= SEND
    wanted = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["id"], "left_semi")

    def set_rows(batch: pa.RecordBatch) -> dict:
        sets = [s.tobytes() for s in shingle_sets(batch, size)]
        return {"doc_id": batch.column("doc_id"), "shingles": pa.array(sets, pa.binary())}

    sets = written(per_slice(wanted, set_rows, "doc_id bigint, shingles binary"), "sets")
    of_a = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("of_a"))
    of_b = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("of_b"))

    def alike(batch: pa.RecordBatch) -> dict:
        keep = []
        for x, y in zip(batch.column("of_a"), batch.column("of_b")):
            x, y = np.frombuffer(x.as_py(), U64), np.frombuffer(y.as_py(), U64)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(1000 * shared >= per_mille * (len(x) + len(y) - shared))
        chosen = batch.filter(pa.array(keep, pa.bool_()))
        return {"a": chosen.column("a"), "b": chosen.column("b")}

    both = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "of_a", "of_b")
    return per_slice(both, alike, "a bigint, b bigint", column="of_a")


def near_links(signatures: DataFrame, docs: DataFrame, size: int, similarity: float) -> DataFrame:
    """Confirmed links (a, b) that join all documents which links of ``similarity`` join.

    ``signatures`` holds one document of each different set. Buckets are split into blocks by a
    hash that differs from band to band, and each block proposes a spanning forest, so copies
    of one text are never paired each with each and a large group still hangs together over its
    bands. Members that are then outside their bucket's largest component are held against the
    whole bucket, tile by tile, so no link between components is left out. Of those pairs only the
    ones go on to be confirmed that their parities cannot rule out, which are those at or hardly
    below ``similarity``: a large group of near texts that are not linked gives next to none.
    """
    least, per_mille = least_estimate(similarity), round(similarity * 1000)
    banded = signatures.select("doc_id", "packed", F.explode("bands").alias("key"))
    sizes = written(banded.groupBy("key").count().where("count > 1"), "buckets")
    blocks = F.ceil(F.col("count") / BLOCK).cast("int")
    buckets = written(
        banded.join(sizes, "key").withColumn("blocks", blocks).withColumn(
            "block", F.pmod(F.xxhash64("key", "doc_id"), F.col("blocks")).cast("int")), "members")
    first = _candidates(
        buckets.select("key", "block", "doc_id", F.col("doc_id").alias("component"), "packed",
                       F.lit(BOTH).alias("side")), least, per_mille, False)
    first = written(first, "pairs")
    links = written(confirmed(first, docs, size, similarity), "near")
    found = components(links)
    placed = written(
        buckets.join(found, buckets["doc_id"] == found["node"], "left")
        .select("key", "doc_id", "packed",
                F.coalesce("component", "doc_id").alias("component")), "placed")
    bits = signatures.select("doc_id", "n_shingles", "odd")
    met = tiles(placed, TILE).join(bits, "doc_id")
    second = written(_candidates(met, least, per_mille, True), "pairs").join(
        first, ["a", "b"], "left_anti")
    return links.union(confirmed(written(second, "pairs"), docs, size, similarity))


def near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach) and kept (it is its
    own component_id), one row per row of ``docs``.

    A set is the distinct ``size``-word shingles of the text with A-Z lower-cased; fewer words
    make one shingle; none (null, empty or blank text) make an empty set, which links to
    nothing. Documents with equal sets are one class, stood for by its smallest doc_id, and
    only classes are compared. Rows that repeat a doc_id are one node and share its component;
    rows with a null doc_id link to nothing, have a null component_id and are kept. Other
    columns are not read. An empty table gives an empty result.
    """
    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"),
                                               F.coalesce("text", F.lit("")).alias("text"))
    every = written(signed(slim, size), "signed")
    full = every.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = written(full.groupBy("set1", "set2", "n_shingles").agg(
        F.min("doc_id").alias("head")), "classes")
    same = full.select("doc_id", "set1", "set2", "n_shingles").join(
        classes, ["set1", "set2", "n_shingles"]).where("doc_id > head").select(
        F.col("head").alias("a"), F.col("doc_id").alias("b"))
    heads = full.join(classes.select("set1", "set2", F.col("head").alias("doc_id")),
                      ["set1", "set2", "doc_id"], "left_semi")
    links = near_links(heads, slim.where(F.col("doc_id").isNotNull()), size, similarity)
    found = written(components(same.union(links)), "components")
    return every.join(found, every["doc_id"] == found["node"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")),
                   F.lit(True)).alias("kept"))


def one_of_each(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` whose document is kept by ``near_duplicates``."""
    gone = written(near_duplicates(docs, size, similarity).where(~F.col("kept")).select(
        F.col("doc_id").alias("gone")).distinct(), "gone")
    few = gone.limit(SEND + 1).count() <= SEND
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["gone"], "left_anti")


def by_four_words(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, size=4)


SQL = """
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') AS l
  FROM documents
), sets AS (
  SELECT DISTINCT doc_id, array_to_string(l[i:i + 3], ' ') AS shingle
  FROM worded, generate_series(1, greatest(len(l) - 3, 1)) AS g(i) WHERE len(l) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * c >= 80 * (p.n + q.n - c)
), ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT w.y, r.root FROM reached r JOIN ways w ON w.x = r.node
)
SELECT d.doc_id, coalesce(max(s.n), 0) AS n_shingles, min(r.root) AS component_id,
       d.doc_id = min(r.root) AS kept
FROM documents d JOIN reached r ON r.node = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
GROUP BY d.doc_id
"""
