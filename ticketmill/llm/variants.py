"""Spelling variants: frequent words grouped with the words one edit away, by dense tiling.

Words of a block become a padded matrix of code points. Comparing two blocks gives, for every pair
at once, the length of the common prefix and of the common suffix; two different words are one
inserted, deleted or replaced code point apart exactly if both lengths together reach the longer
word's length minus one (and their lengths differ by one at most).

Blocks are words that share what an edit leaves alone. Let M be the longer length and e the place
of the edit (the common prefix's length, M - 1 at most), and cut M into thirds a < b: for e >= b
the first b code points are shared, for e < a the last M - a, else the first a and the last M - b.
Every pair is judged in the one block that its own e names, so no link is met twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.frames import pick, ship, written
from ticketmill.operators.joins import broadcast_if

#: Code points of the shortest word, and uses of the rarest.
SHORTEST, LEAST = 6, 5
#: A word's form is used this many times as often.
RATIO = 5
#: One run in so many, by its checksum, loses a code point (contract).
SLIP = 199
#: Members of a block compared in one piece; larger blocks are cut into tiles of about this many.
#: Members of more than LINE code points count as several.
TILE, LINE = 2048, 64
#: Code points of a matrix, and of the pairs compared at once.
CELLS = 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PREFIX, SUFFIX, ENDS = 0, 1, 2


def slipped(doc_id: Column, run: Column) -> Column:
    """The run without the code point that its checksum names, if 199 divides the checksum; a run
    of a document without id stays."""
    seed = F.concat(doc_id.cast("string"), F.lit(":"), run)
    h = F.crc32(seed.cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % SLIP == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST) -> DataFrame:
    """(word, n): the words of at least ``shortest`` code points used at least ``least`` times.

    A slip shortens a run, so shorter runs can make no word and are not even taken out of the text.
    Counts are added up within every task before they are shuffled: a very common word is one row
    per task.
    """
    slim = pick(docs, "doc_id", "text")
    lower = F.translate("text", UPPER, LOWER)
    pattern = F.lit("[A-Za-zÀ-ÿ]{%d,}" % shortest)
    runs = slim.select("doc_id", F.explode(F.regexp_extract_all(lower, pattern, F.lit(0))).alias("run"))
    words = runs.select(slipped(F.col("doc_id"), F.col("run")).alias("word"))
    counted = words.where(F.char_length("word") >= shortest).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= least)


# --- blocks --------------------------------------------------------------------------------

def members(words: DataFrame) -> DataFrame:
    """(key, kind, most, word, n): six rows a word, one per kind of block for its own length as
    the longer one, and for one more. The key is 128 bits of what the block shares."""
    size = F.char_length("word")
    most = F.explode(F.array(size, size + 1)).alias("most")
    a, b = F.col("a"), F.col("b")

    def first(n: Column) -> Column:
        return F.substring(F.col("word"), F.lit(1), n)

    def last(n: Column) -> Column:
        return F.substring(F.col("word"), F.char_length("word") - n + 1, n)

    cuts = words.select("word", "n", most).select(
        "*", F.floor(F.col("most") / 3).cast("int").alias("a"),
        F.floor(F.col("most") * 2 / 3).cast("int").alias("b"))
    shared = F.array(
        F.struct(F.lit(PREFIX).alias("kind"), first(b).alias("part"), F.lit("").alias("end")),
        F.struct(F.lit(SUFFIX).alias("kind"), F.lit("").alias("part"), last(F.col("most") - a).alias("end")),
        F.struct(F.lit(ENDS).alias("kind"), first(a).alias("part"), last(F.col("most") - b).alias("end")))
    rows = cuts.select("word", "n", "most", F.explode(shared).alias("s")).select(
        "word", "n", "most", "s.kind", "s.part", "s.end")
    key = F.unhex(F.md5(F.concat_ws("\n", "kind", "most", "part", "end").cast("binary")))
    return rows.select(key.alias("key"), "kind", "most", "word", "n")


def tiles(rows: DataFrame) -> DataFrame:
    """``rows`` with (i, j), the tiles of its block that are to be compared, and the row's tile.

    A block of more than TILE members is cut by a hash of the word, and each member goes once to
    every pair of tiles that its own is in: a hot block is many pieces of equal size. Blocks of
    one member have nothing to compare and go.
    """
    weight = F.sum(F.ceil(F.col("most") / LINE))
    sizes = rows.groupBy("key").agg(weight.alias("size"))
    large = written(sizes.where(F.col("size") > TILE), "large-blocks")
    n_tiles = F.ceil(F.col("size") / TILE).cast("int")
    tile = F.when(F.col("size").isNull(), 0).otherwise(
        F.pmod(F.xxhash64("word"), n_tiles)).cast("int")
    others = F.sequence(F.lit(0), F.coalesce(n_tiles, F.lit(1)) - 1)
    dealt = rows.join(broadcast_if(large, large.count()), "key", "left").select(
        "key", "kind", "most", "word", "n", tile.alias("tile"), F.explode(others).alias("other"))
    return dealt.select("key", "kind", "most", "word", "n", "tile", F.least("tile", "other").alias("i"),
                        F.greatest("tile", "other").alias("j"))


def padded(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points in rows, filled up with zeros, and lengths."""
    width = max(map(len, words), default=0)
    flat = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le"), np.uint32)
    return flat.reshape(len(words), width), np.array([len(w) for w in words], np.int64)


def shared(left: np.ndarray, right: np.ndarray, shorter: np.ndarray) -> np.ndarray:
    """How many leading code points each row of ``left`` shares with its row of ``right``."""
    alike = left == right
    return np.where(alike.all(axis=1), shorter, np.minimum(alike.argmin(axis=1), shorter))


def _turned(codes: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each row's code points in reverse, still filled up at the end."""
    at = size[:, None] - 1 - np.arange(codes.shape[1])
    return np.where(at >= 0, np.take_along_axis(codes, np.maximum(at, 0), axis=1), 0)


class Block:
    """The members of one partition's run of rows, ready to be compared by place."""

    def __init__(self, words: list[str]):
        self.codes, self.size = padded(words)
        self.back = _turned(self.codes, self.size)

    def near(self, x: np.ndarray, y: np.ndarray, kind: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Whether the words at places ``x`` and ``y`` are one edit apart, in the block (``kind``,
        ``most``) that the place of the edit names."""
        longer, shorter = np.maximum(self.size[x], self.size[y]), np.minimum(self.size[x], self.size[y])
        prefix = shared(self.codes[x], self.codes[y], shorter)
        suffix = shared(self.back[x], self.back[y], shorter)
        edit = np.minimum(prefix, most - 1)
        named = np.where(edit >= most * 2 // 3, PREFIX, np.where(edit < most // 3, SUFFIX, ENDS))
        return ((longer == most) & (longer - shorter <= 1) & (prefix < longer)
                & (prefix + suffix >= longer - 1) & (named == kind))


def _pairs(ends: np.ndarray, tile: np.ndarray, between: np.ndarray, most: int
           ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs to compare, ``most`` at most at once (or one row against its group):
    each row with those behind it in its group, which ends before ``ends``. In groups ``between``
    two tiles, rows of the one meet rows of the other only."""
    behind = ends - np.arange(len(ends)) - 1
    sums = np.cumsum(behind)
    first = 0
    while first < len(ends):
        done = sums[first - 1] if first else 0
        last = max(int(np.searchsorted(sums, done + most, "right")), first + 1)
        many = behind[first:last]
        x = np.repeat(np.arange(first, last), many)
        y = x + np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + 1
        meet = ~between[x] | (tile[x] != tile[y])
        yield x[meet], y[meet]
        first = last


def _judged(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """The links of whole groups, found in matrices of words of like length."""
    cut = np.flatnonzero(_changes(table)) + 1
    starts, ends = np.r_[0, cut], np.r_[cut, table.num_rows]
    length = table.column("most").to_numpy()[starts]
    groups = np.flatnonzero(ends - starts > 1)
    groups = groups[np.argsort(length[groups], kind="stable")]
    while len(groups):
        cells = np.cumsum(ends[groups] - starts[groups]) * length[groups]
        taken = max(int(np.searchsorted(cells, CELLS, "right")), 1)
        some, groups = groups[:taken], groups[taken:]
        sizes = ends[some] - starts[some]
        rows = np.concatenate([np.arange(starts[g], ends[g]) for g in some])
        made = _linked(table.take(pa.array(rows)), np.repeat(np.cumsum(sizes), sizes))
        if made is not None:
            yield made


def _linked(table: pa.Table, ends: np.ndarray) -> pa.RecordBatch | None:
    words, n = table.column("word").to_pylist(), table.column("n").to_numpy()
    tile, i, j, kind, most = (table.column(c).to_numpy() for c in ("tile", "i", "j", "kind", "most"))
    block = Block(words)
    order = sorted(range(len(words)), key=lambda k: (-n[k], words[k]))
    place = np.empty(len(words), np.int64)
    place[order] = np.arange(len(words))
    count, best = np.zeros(len(words), np.int64), np.full(len(words), len(words))
    for x, y in _pairs(ends, tile, i != j, max(CELLS // block.codes.shape[1], 1)):
        hit = block.near(x, y, kind[x], most[x])
        for a, b in ((x[hit], y[hit]), (y[hit], x[hit])):
            np.add.at(count, a, 1)
            np.minimum.at(best, a, place[b])
    found = np.flatnonzero(count)
    if not len(found):
        return None
    forms = [order[k] for k in best[found]]
    return pa.RecordBatch.from_arrays(
        [pa.array([words[k] for k in found]), pa.array(count[found]),
         pa.array([-int(n[k]) for k in forms], pa.int64()), pa.array([words[k] for k in forms])],
        names=["word", "n_near", "less", "form"])


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n_near, less, form): for rows sorted by (key, i, j), the number of a word's links in a
    group and the best of them (``less`` is minus its count). Only the group that a batch ends in
    is kept for the next."""
    held: list[pa.Table] = []
    for batch in batches:
        held.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(held).combine_chunks()
        cut = np.flatnonzero(_changes(table))
        if not len(cut):  # still the same group, of two tiles at most
            held = [table]
            continue
        whole = int(cut[-1]) + 1
        held = [table.slice(whole)]
        yield from _judged(table.slice(0, whole).combine_chunks())
    if held:
        yield from _judged(pa.concat_tables(held).combine_chunks())


def _changes(table: pa.Table) -> np.ndarray:
    """Whether each row but the last is followed by another group."""
    out = np.zeros(max(table.num_rows - 1, 0), bool)
    for name in ("key", "i", "j"):
        column = table.column(name).combine_chunks()
        if name == "key":
            column = np.array(column.to_pylist(), object)
        else:
            column = column.to_numpy()
        out |= column[1:] != column[:-1]
    return out


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, form, form_n): the number of words one edit away, and the most used of them
    (ties: the smallest), for the words of ``words`` (word, n; written) that have any. Links stay
    in their task, so a task sends one row per word and group at most."""
    ship(words.sparkSession)
    dealt = tiles(members(words)).repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    parts = dealt.mapInArrow(_compared, "word string, n_near bigint, less bigint, form string")
    best = parts.groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                     F.min(F.struct("less", "form")).alias("best"))
    return best.select("word", "n_near", F.col("best.form").alias("form"),
                       (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the chain of forms (word, form) ends, for every word that has a form.

    A word's place in the chain doubles each round. A form is used RATIO times as often as its
    word, so chains are as long as the logarithm of the largest count at most. A word is the form
    of no more words than are one edit away from it, so no join key is hot.
    """
    links = forms.select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = links.join(onward, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step = written(step, "roots")
        links = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return links


def grouped(docs: DataFrame, shortest: int = SHORTEST, least: int = LEAST, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near and form_n: a row per word of the vocabulary of ``docs``.

    Null and empty texts hold no run. Runs of a document without id are counted as written.
    Repeated rows count again. Ties between forms go to the smaller word in code-point order.
    A word without a near word has n_near 0; one whose most used near word is not ``ratio`` times
    as frequent has no form and is its own root. Empty tables, or no word frequent enough, give no
    row; a run of any length is one word; extra columns play no part.
    """
    words = written(vocabulary(docs, shortest, least), "vocabulary")
    near = words.join(near_words(words), "word", "left").withColumn(
        "own", F.col("form_n") >= ratio * F.col("n"))
    near = written(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                               F.when(F.col("own"), F.col("form")).alias("form"),
                               F.when(F.col("own"), F.col("form_n")).alias("form_n")), "near-words")
    ends = roots(near.where(F.col("form").isNotNull()))
    return near.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The same rows in plain SQL: the checksum byte by byte, then words that share a spelling with one
#: code point taken out.
SQL = r"""
WITH RECURSIVE bits AS (
    SELECT i AS byte, 0 AS k, i::BIGINT AS c FROM range(256) t(i)
    UNION ALL
    SELECT byte, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
    FROM bits WHERE k < 8
), crc AS (
    SELECT list(c ORDER BY byte) AS step FROM bits WHERE k = 8
), runs AS (
    SELECT doc_id, run, count(*) AS uses FROM (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[A-Za-z\x{00C0}-\x{00FF}]{6,}')) AS run
        FROM documents) GROUP BY ALL
), coded AS (
    SELECT doc_id, run, uses, hex(encode(concat(doc_id, ':', run))) AS h
    FROM runs
), summed AS (
    SELECT doc_id, run, uses, xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2),
            lambda p: ('0x' || substr(h, p, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, step[xor(c & 255, b) + 1])), 4294967295) AS h
    FROM coded, crc
), spelled AS (
    SELECT CASE WHEN doc_id IS NOT NULL AND h % 199 = 0
                THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, uses
    FROM summed
), words AS (
    SELECT word, sum(uses)::BIGINT AS n FROM spelled WHERE length(word) >= 6
    GROUP BY word HAVING sum(uses) >= 5
), cut AS (
    SELECT word, n, p, word[:p] || word[p + 2:] AS rest
    FROM words, unnest(range(length(word))) t(p)
), links AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.p = b.p
    WHERE a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
    SELECT word, count(*) AS n_near, min({'less': -near_n, 'near': near}) AS b
    FROM links GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near,
           CASE WHEN -b.less >= 5 * n THEN b.near END AS form,
           CASE WHEN -b.less >= 5 * n THEN -b.less END AS form_n
    FROM words LEFT JOIN best USING (word)
), chain AS (
    SELECT word, word AS tip FROM formed
    UNION ALL
    SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.tip
    WHERE formed.form IS NOT NULL
)
SELECT formed.word, formed.form, last.tip AS root, formed.n, formed.n_near, formed.form_n
FROM formed JOIN chain AS last USING (word) JOIN formed e ON e.word = last.tip AND e.form IS NULL
"""
