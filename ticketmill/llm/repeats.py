"""Suffix-array dedup: bytes covered by a long string that also starts earlier are removed.

No order of all suffixes is built. Suffixes that could match are brought together by anchors
(``anchors.py``), and only inside such a group are they sorted. There, a suffix has an earlier
match of the asked length if, among the neighbours in suffix order that share that many bytes,
the previous or the next smaller position exists: the longest-previous-factor test.

1. Every run of windows that share an anchor is sent, as hashes, to the place of its anchor's
   gram. Runs with all bytes equal: all but the first are repeated whole. A gram with different
   runs asks for the first of each kind; all others need no more work.
2. Documents give the bytes of the runs asked for; the windows of a gram's runs are sorted as
   suffixes, and those with an earlier match are repeated. Grams with very many kinds of runs
   are spread over the cluster by windows' hashes instead.
3. Repeated windows are cut out of their documents.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.anchors import PLACE_BITS, runs
from ticketmill.llm.batches import U64, Rolling, flat, mixed, per_slice
from ticketmill.llm.frames import pick, ship, written

LENGTH, GRAM = 100, 28
#: Kinds of runs beyond which a gram's windows are spread by their hashes.
MANY = 64
#: Documents looked at for grams so frequent that their runs are spread from the start, and in
#: how many of these documents a gram must be for that. Either way the result is the same.
SAMPLE, FREQUENT = 20_000, 40
#: Windows sorted at once, and bytes of one text worked on at once.
SORTED, PIECE = 1 << 16, 1 << (PLACE_BITS - 1)

#: A run as sent to its gram's place; a run repeated whole or asked for, as sent to its document.
RUN = np.dtype([("gram", "u8"), ("around", "u8"), ("ord", "i8"), ("print", "i8"), ("first", "u4"),
                ("count", "u1")])
SPAN = np.dtype([("ord", "i8"), ("print", "i8"), ("first", "u4"), ("count", "u1"), ("asked", "u1"),
                 ("gram", "u8")])


def all_runs(raw: np.ndarray, offsets: np.ndarray):
    """``runs`` of the rows, first starts counted from the row's start; long rows in pieces.
    Grams are never zero."""
    if len(raw) <= PIECE:
        row, first, last, _, gram, around = runs(raw, offsets, LENGTH, GRAM)
        return row, first - offsets[row], last - first + 1, gram | U64(1), around
    found = []
    for i, (start, end) in enumerate(zip(offsets[:-1], offsets[1:])):
        for at in range(start, max(end, start + 1), PIECE - LENGTH):
            piece = raw[at:min(at + PIECE - 1, end)]
            if at == start or len(piece) >= LENGTH:
                _, first, last, _, gram, around = runs(piece, np.array([0, len(piece)]), LENGTH, GRAM)
                found.append((np.full(len(first), i), first + at - start, last - first + 1,
                              gram | U64(1), around))
    return tuple(map(np.concatenate, zip(*found)))


def _packed(records: np.ndarray) -> bytes:
    """Column by column, which compresses better than row by row."""
    return b"".join(np.ascontiguousarray(records[n]).tobytes() for n in records.dtype.names)


def _unpacked(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    sizes = [len(b) // dtype.itemsize for b in blobs]
    out = np.empty(sum(sizes), dtype)
    at = 0
    for blob, n in zip(blobs, sizes):
        start = 0
        for name in dtype.names:
            kind = dtype[name]
            out[name][at:at + n] = np.frombuffer(blob, kind, n, start)
            start += n * kind.itemsize
        at += n
    return out


def _by_place(records: np.ndarray, place: np.ndarray):
    """(place, packed records) for every place that has some."""
    order = np.argsort(place, kind="stable")
    records, place = records[order], place[order]
    cuts = np.flatnonzero(np.diff(place)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(place)]):
        if end > start:
            yield int(place[start]), _packed(records[start:end])


def _rows(found: list[tuple[int, bytes]], names: list[str]) -> pa.RecordBatch:
    places, blobs = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(places, pa.int32()), pa.array(blobs, pa.binary())],
                                      names=names)


def _frequent_grams(texts: DataFrame) -> np.ndarray:
    n = texts.count()
    part = texts.sample(min(1.0, SAMPLE / max(n, 1)), seed=4).select("text")

    def work(batch: pa.RecordBatch) -> dict:
        row, _, _, gram, _ = all_runs(*flat(batch.column("text")))
        pairs = np.unique(np.stack([row.astype(U64), gram]), axis=1)
        return {"gram": pairs[1].view(np.int64)}

    counts = per_slice(part, work, "gram bigint").groupBy("gram").count()
    rows = counts.where(F.col("count") >= FREQUENT).select("gram").collect()
    return np.sort(np.array([r[0] for r in rows], np.int64).view(U64))


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    at = np.searchsorted(listed, values)
    at[at == len(listed)] = 0
    return listed[at] == values if len(listed) else np.zeros(len(values), bool)


def _sent_runs(texts: DataFrame, frequent: np.ndarray, places: int) -> DataFrame:
    """(place, runs): runs of a text slice, of equal ones the first only; the others are known to
    be repeated and travel with their document's number, marked by a zero gram."""
    def work(batch: pa.RecordBatch) -> dict:
        row, first, count, gram, around = all_runs(*flat(batch.column("text")))
        sent = np.empty(len(row), RUN)
        sent["gram"], sent["around"], sent["first"], sent["count"] = gram, around, first, count
        for name in ("ord", "print"):
            sent[name] = batch.column(name).to_numpy()[row]
        order = np.lexsort((sent["first"], sent["ord"], around, gram))
        again = np.zeros(len(sent), bool)
        a, b = sent[order[:-1]], sent[order[1:]]
        same = (a["gram"] == b["gram"]) & (a["around"] == b["around"])
        head = np.maximum.accumulate(np.where(np.r_[True, ~same], np.arange(len(order)), 0)) \
            if len(order) else order
        heads = sent[order][head]
        own = sent[order]
        again[order] = (heads["ord"] < own["ord"]) | (heads["first"] < own["first"])
        key = np.where(_among(sent["gram"], frequent), mixed(sent["gram"] ^ sent["around"]), gram)
        key = np.where(again, mixed(sent["ord"].view(U64)), key)
        sent["gram"][again] = 0
        found = list(_by_place(sent, (mixed(key) % U64(places)).astype(np.int64)))
        return {"place": pa.array([p for p, _ in found], pa.int32()),
                "runs": pa.array([b for _, b in found], pa.binary())}

    return per_slice(texts, work, "place int, runs binary")


def _judged(sent: DataFrame, frequent: np.ndarray, places: int) -> DataFrame:
    """(home, spans): runs repeated whole (asked 0), runs whose bytes are asked for (1), and those
    asked for whose windows are to be spread (2), by the place of their document."""
    def judge(batches):
        blobs = [b for batch in batches for b in batch.column("runs").to_pylist()]
        if not blobs:
            return
        r = _unpacked(blobs, RUN)
        del blobs
        r = r[np.lexsort((r["first"], r["ord"], r["around"], r["gram"]))]
        new_gram = np.r_[True, r["gram"][1:] != r["gram"][:-1]]
        new_kind = new_gram | np.r_[True, r["around"][1:] != r["around"][:-1]]
        known = r["gram"] == 0
        head = np.maximum.accumulate(np.where(new_kind, np.arange(len(r)), 0))
        again = known | (r["ord"][head] < r["ord"]) | (r["first"][head] < r["first"])
        group = np.cumsum(new_gram) - 1
        kinds = np.bincount(group, weights=new_kind)[group]
        often = _among(r["gram"], frequent)
        asked = ~again & (often | (kinds > 1))
        use = again | asked
        spans = np.empty(int(use.sum()), SPAN)
        for name in ("ord", "print", "first", "count", "gram"):
            spans[name] = r[name][use]
        spans["asked"] = np.where(again, 0, np.where(often | (kinds > MANY), 2, 1))[use]
        spans["gram"][spans["asked"] == 0] = 0
        home = (mixed(spans["ord"].view(U64)) % U64(places)).astype(np.int64)
        yield _rows(list(_by_place(spans, home)), ["home", "spans"])

    return sent.repartition(places, "place").mapInArrow(judge, "home int, spans binary")


def _by_document(judged: DataFrame, places: int) -> DataFrame:
    """(ord, print, spans, asked): a document's repeated runs and the runs asked of it."""
    def gather(batches):
        blobs = [b for batch in batches for b in batch.column("spans").to_pylist()]
        if not blobs:
            return
        s = _unpacked(blobs, SPAN)
        s = s[np.lexsort((s["first"], s["print"], s["ord"]))]
        cuts = np.flatnonzero((np.diff(s["ord"]) != 0) | (np.diff(s["print"]) != 0)) + 1
        rows: list[tuple] = []
        for start, end in zip([0, *cuts], [*cuts, len(s)]):
            mine = s[start:end]
            whole = mine["asked"] == 0
            rows.append((mine["ord"][0], mine["print"][0], _merged(
                mine["first"][whole], mine["first"][whole] + mine["count"][whole].astype(int)
                + LENGTH - 1).tobytes(), np.unique(mine[~whole]).tobytes()))
        for at in range(0, len(rows), 5000):
            ords, prints, spans, asked = zip(*rows[at:at + 5000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ords, pa.int64()), pa.array(prints, pa.int64()),
                 pa.array(spans, pa.binary()), pa.array(asked, pa.binary())],
                names=["ord", "print", "spans", "asked"])

    return judged.repartition(places, "home").mapInArrow(
        gather, "ord bigint, print bigint, spans binary, asked binary")


def _merged(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The ranges as few as possible: (start, end) rows of 8-byte whole numbers, sorted."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order].astype(np.int64), ends[order].astype(np.int64)
    if not len(starts):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(ends)
    new = np.r_[True, starts[1:] > reach[:-1]]
    return np.stack([starts[new], reach[np.r_[new[1:], True]]], axis=1)


def _asked_bytes(joined: DataFrame) -> DataFrame:
    """(key, second, ord, print, first, body): for a gram its run's bytes; for a spread gram one
    row per window, keyed by two hashes of the window."""
    def work(batch: pa.RecordBatch) -> dict:
        raw, offsets = flat(batch.column("text"))
        asks = [np.frombuffer(a, SPAN) if a else np.zeros(0, SPAN)
                for a in batch.column("asked").to_pylist()]
        row = np.repeat(np.arange(len(asks)), [len(a) for a in asks])
        s = np.concatenate([np.zeros(0, SPAN), *asks])
        at = offsets[row] + s["first"]
        one = s["asked"] == 1
        bodies = [raw[a:a + n + LENGTH - 1].tobytes()
                  for a, n in zip(at[one].tolist(), s["count"][one].tolist())]
        many = s[~one]
        n = many["count"].astype(np.int64)
        which = np.repeat(np.arange(len(many)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        start = at[~one][which] + step
        if len(which):
            keys = [Rolling(raw, seed).of(start, start + LENGTH).view(np.int64) for seed in (1, 2)]
        else:
            keys = [np.zeros(0, np.int64)] * 2
        few = s[one]
        return {
            "key": np.concatenate([few["gram"].view(np.int64), keys[0]]),
            "second": np.concatenate([np.zeros(len(few), np.int64), keys[1] | 1]),
            "ord": np.concatenate([few["ord"], many["ord"][which]]),
            "print": np.concatenate([few["print"], many["print"][which]]),
            "first": np.concatenate([few["first"].astype(np.int64),
                                     many["first"][which].astype(np.int64) + step]),
            "body": pa.array([*bodies, *[None] * len(which)], pa.binary()),
        }

    return per_slice(joined, work, "key bigint, second bigint, ord bigint, print bigint, "
                                   "first bigint, body binary")


def earlier_match(order: np.ndarray, same: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Which suffixes have an earlier match. ``order`` lists them in suffix order, ``same`` says
    of each place in that order that it shares the asked length with the place before, and
    ``position`` ranks the suffixes by where they start."""
    group, step = np.cumsum(~same), position.max(initial=0) + 1
    # later groups lie lower, so running minima from the left start anew in each of them
    fall = position[order] - group * step
    previous = np.r_[np.iinfo(np.int64).max, np.minimum.accumulate(fall)[:-1]]
    rise = position[order] + group * step
    following = np.r_[np.minimum.accumulate(rise[::-1])[::-1][1:], np.iinfo(np.int64).max]
    out = np.zeros(len(order), bool)
    out[order] = (previous < fall) | (following < rise)
    return out


def _matched(asked: DataFrame, places: int) -> DataFrame:
    """(ord, print, start, end) of windows with an earlier match, neighbours joined."""
    def found(table: pa.Table):
        """Of whole groups of runs."""
        raw, offsets = flat(table.column("body").combine_chunks())
        ords, prints, firsts = (table.column(n).to_numpy() for n in ("ord", "print", "first"))
        n = np.diff(offsets) - LENGTH + 1
        which = np.repeat(np.arange(len(n)), n)
        step = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        at = offsets[:-1][which] + step
        suffixes = np.lib.stride_tricks.sliding_window_view(raw, LENGTH)[at]
        _, gram = np.unique(table.column("key").to_numpy(), return_inverse=True)
        keyed = np.concatenate([gram[which].astype(">u4").view(np.uint8).reshape(-1, 4), suffixes], 1)
        keyed = np.ascontiguousarray(keyed).view(f"S{LENGTH + 4}").ravel()
        order = np.argsort(keyed, kind="stable")
        same = np.r_[False, keyed[order[1:]] == keyed[order[:-1]]]
        places_ = np.stack([ords[which], firsts[which] + step])
        rank = np.lexsort(places_[::-1])
        moved = np.r_[False, (np.diff(places_[:, rank]) != 0).any(axis=0)]
        position = np.empty(len(rank), np.int64)
        position[rank] = np.cumsum(moved)
        hit = earlier_match(order, same, position)
        w, s = which[hit], firsts[which[hit]] + step[hit]
        new = np.r_[True, (np.diff(w) != 0) | (np.diff(s) != 1)][:len(w)]
        ends = s[np.r_[new[1:], True][:len(w)]] + LENGTH
        return ords[w[new]], prints[w[new]], s[new], ends

    def run(batches):
        held, last = None, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            spread = np.array(table.column("second").to_numpy() != 0)
            # windows of spread grams: sorted, so all but the first of an equal run are repeated
            w = table.filter(pa.array(spread))
            if w.num_rows:
                k1, k2, o, p, f = (w.column(c).to_numpy() for c in ("key", "second", "ord", "print", "first"))
                prior = last if last is not None else (k1[0], ~k2[0], 0, 0)
                new = np.r_[(k1[0], k2[0]) != prior[:2], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])]
                head = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
                ho, hf = (np.where(head >= 0, x[head], v) for x, v in ((o, prior[2]), (f, prior[3])))
                hit = (ho < o) | ((ho == o) & (hf < f))
                last = (k1[-1], k2[-1], ho[-1], hf[-1])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (
                    o[hit], p[hit], f[hit], f[hit] + LENGTH)], ["ord", "print", "start", "end"])
            r = table.filter(pa.array(~spread))
            held = pa.concat_tables([held, r]) if held is not None else r
            keys = held.column("key").to_numpy()
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            if len(cuts):
                yield from worked(held.slice(0, cuts[-1]))
                held = held.slice(cuts[-1])
        if held is not None and held.num_rows:
            yield from worked(held)

    def worked(table: pa.Table):
        """In portions of about SORTED windows, whole groups each."""
        keys = table.column("key").to_numpy()
        ends = np.r_[np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        sizes = np.cumsum(np.diff(flat(table.column("body").combine_chunks())[1]) - LENGTH + 1)
        start = 0
        while start < len(keys):
            done = sizes[start - 1] if start else 0
            fits = ends[(ends > start) & (sizes[ends - 1] <= done + SORTED)]
            end = int(fits[-1]) if len(fits) else int(ends[ends > start][0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in found(table.slice(start, end - start))],
                ["ord", "print", "start", "end"])
            start = end

    return asked.repartition(places, "key", "second").sortWithinPartitions(
        "key", "second", "ord", "first").mapInArrow(
        run, "ord bigint, print bigint, start bigint, end bigint")


def cut_repeats(docs: DataFrame, texts: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and with ``texts`` kept (the bytes left)
    and spans (removed byte ranges): one row per row of ``docs``.

    Removed is each byte covered by LENGTH bytes of the same document that also start earlier:
    at a smaller doc_id, or earlier in the same one. Strings are judged on the input. Null or
    empty text, and text shorter than LENGTH, loses nothing. A null doc_id comes after all
    others. Rows that repeat a doc_id count as one document: of equal strings at equal places
    of such rows none is earlier. Other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    slim = slim.withColumn("ord", F.coalesce("doc_id", F.lit(2**63 - 1))).withColumn(
        "print", F.xxhash64("text"))
    frequent = _frequent_grams(slim)
    judged = _judged(_sent_runs(slim, frequent, places), frequent, places)
    known = written(_by_document(judged, places), "spans")
    # both joins below read this one shuffle of the texts
    home = slim.repartition(places, "ord", "print")
    keys = ["ord", "print"]
    asked = _asked_bytes(home.join(known.hint("shuffle_hash"), keys, "left").select(
        "ord", "print", "text", "asked"))
    late = _matched(asked, places).groupBy(*keys).agg(
        F.collect_list(F.struct("start", "end")).alias("late"))
    late = late.select(*keys, F.col("late.start").alias("late_starts"),
                       F.col("late.end").alias("late_ends"))
    both = home.join(known.drop("asked").hint("shuffle_hash"), keys, "left").join(
        late.hint("shuffle_hash"), keys, "left")

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256",
                                                "kept", "spans")}
        raw, offsets = flat(batch.column("text"))
        for i in range(batch.num_rows):
            whole = batch.column("spans")[i].as_py() or b""
            spans = np.frombuffer(whole, np.int64).reshape(-1, 2)
            more = [np.array(batch.column(c)[i].as_py() or [], np.int64)
                    for c in ("late_starts", "late_ends")]
            spans = _merged(np.concatenate([spans[:, 0], more[0]]),
                            np.concatenate([spans[:, 1], more[1]]))
            text = raw[offsets[i]:offsets[i + 1]]
            gone = np.zeros(len(text) + 1, np.int8)
            gone[spans[:, 0]] += 1
            gone[spans[:, 1]] -= 1
            kept = text[np.cumsum(gone[:-1]) == 0].tobytes()
            out["n_bytes"].append(len(text))
            out["n_removed"].append(len(text) - len(kept))
            out["n_spans"].append(len(spans))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if texts:
                out["kept"].append(kept)
                out["spans"].append(spans.tolist())
        made = {k: pa.array(v, pa.int64()) for k, v in out.items() if k.startswith("n_")}
        made |= {"doc_id": batch.column("doc_id"), "kept_sha256": pa.array(out["kept_sha256"]),
                 "kept": pa.array(out["kept"], pa.binary()),
                 "spans": pa.array(out["spans"], pa.list_(pa.list_(pa.int64())))}
        return made

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return per_slice(both, cut, schema + (", kept binary, spans array<array<bigint>>" if texts else ""))


def digest(docs: DataFrame) -> DataFrame:
    return cut_repeats(docs, texts=False)


SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), chunks AS (
  SELECT doc_id, c * 256 AS place, substr(h, 512 * c + 1, 710) AS h
  FROM texts, generate_series(0, len(h) // 512) AS g(c)
), windows AS (
  SELECT doc_id, place + p AS p, md5(substr(h, 2 * p + 1, 200)) AS w
  FROM chunks, generate_series(0, least(255, len(h) // 2 - 100)) AS g(p)
), firsts AS (
  SELECT w, min(struct_pack(d := doc_id, p := p)) AS f FROM windows GROUP BY w HAVING count(*) > 1
), again AS (
  SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before
  FROM windows JOIN firsts USING (w) WHERE f.d <> doc_id OR f.p <> p
), runs AS (
  SELECT doc_id, p, sum((before IS NULL OR p - before > 100)::INT)
                      OVER (PARTITION BY doc_id ORDER BY p) AS run FROM again
), spans AS (
  SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM runs GROUP BY doc_id, run
), pieces AS (
  SELECT t.doc_id, h, s, e, coalesce(lag(e) OVER o, 0) AS kept_from, s AS kept_to
  FROM texts t JOIN spans USING (doc_id) WINDOW o AS (PARTITION BY t.doc_id ORDER BY s)
), cut AS (
  SELECT doc_id, sum(e - s) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * kept_from + 1, 2 * (kept_to - kept_from)), '' ORDER BY s)
           || substr(any_value(h), 2 * max(e) + 1) AS kept
  FROM pieces GROUP BY doc_id
)
SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
