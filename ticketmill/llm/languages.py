"""Language of texts and of the spans of mixed texts.

A word's script, by ranges of code points, leaves as candidates the languages that are written in
it. Character n-grams score the word in each of them, and the best sequence of languages (Viterbi)
over the words of a text, in which each change of language costs a penalty, labels its spans.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketmill.llm.batches import BASE, U64, mixed, per_slice
from ticketmill.llm.frames import pick, ship, written

#: Documents learned from per language, and languages learned (those with the most documents).
SAMPLE, LANGUAGES = 1_000, 256
#: Lengths of n-grams, a word's ends included, and the classes that they are hashed into.
GRAMS, CLASSES = (1, 2, 3, 4), 1 << 16
BLOCK = CLASSES // len(GRAMS)
#: Added to every class's count, so that an unseen n-gram is unlikely and not impossible.
SMOOTHING = 0.5
#: What a change of language costs, in nats; a word's score is its n-grams' mean over GRAMS.
SWITCH = 8.0
#: A script belongs to a language if it has this share of the letters the language was learned from.
SCRIPT_SHARE = 0.01
#: Letters of a word in scripts that put no spaces between words.
PIECE = 4
UNKNOWN = "und"
#: Scores of n-grams added up at once, and words from which a text goes along its path alone.
CELLS, ALONE = 1 << 22, 2_000
#: What a language that is no candidate scores, less than any n-grams give.
BARRED = np.float32(-1e6)

#: First and last code points of scripts, in order.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x0250, 0x02AF), ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF), ("syriac", 0x0700, 0x074F), ("arabic", 0x0750, 0x077F),
    ("arabic", 0x08A0, 0x08FF), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F), ("gujarati", 0x0A80, 0x0AFF), ("oriya", 0x0B00, 0x0B7F),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F), ("sinhala", 0x0D80, 0x0DFF), ("thai", 0x0E00, 0x0E7F),
    ("lao", 0x0E80, 0x0EFF), ("tibetan", 0x0F00, 0x0FFF), ("myanmar", 0x1000, 0x109F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("ethiopic", 0x1200, 0x139F),
    ("khmer", 0x1780, 0x17FF), ("mongolian", 0x1800, 0x18AF), ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF), ("georgian", 0x2D00, 0x2D2F), ("kana", 0x3040, 0x30FF),
    ("hangul", 0x3130, 0x318F), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF), ("han", 0xF900, 0xFAFF), ("latin", 0xFB00, 0xFB06),
    ("arabic", 0xFB50, 0xFDFF), ("arabic", 0xFE70, 0xFEFE), ("latin", 0xFF21, 0xFF5A),
    ("kana", 0xFF66, 0xFF9F), ("han", 0x20000, 0x323AF),
)
#: Scripts written without spaces between words.
UNSPACED = ("thai", "lao", "tibetan", "myanmar", "khmer", "kana", "han")

NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]
NEITHER, MARK = -1, len(NAMES)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every code point: its script (MARK: a mark that stands in any script; NEITHER: no letter
    and no mark), whether it is a letter, and its lower case where that is one code point."""
    script, letter = np.full(0x110000, NEITHER, np.int8), np.zeros(0x110000, bool)
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in (*range(0xD800), *range(0xE000, 0x32400)):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LM":
            script[c], letter[c] = (0 if kind == "L" else MARK), kind == "L"
            if len(small := chr(c).lower()) == 1:
                lower[c] = ord(small)
    for name, first, last in SCRIPTS:
        part = script[first:last + 1]
        part[part != NEITHER] = NAMES.index(name)
    return script, letter, lower


@dataclass
class Words:
    """The words of a batch of texts: for each its text, its first and last + 1 place in the joined
    code points, and its script; ``codes`` are lower-cased, ``offsets`` the texts' first places."""

    doc: np.ndarray
    start: np.ndarray
    end: np.ndarray
    script: np.ndarray
    codes: np.ndarray
    offsets: np.ndarray


def words(texts: list[str | None]) -> Words:
    """Maximal runs of letters of one script, with the marks on them. Runs of scripts without
    spaces are cut into pieces of PIECE letters."""
    flat = [t or "" for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in flat])]).astype(np.int64)
    codes = np.frombuffer("".join(flat).encode("utf-32-le", "surrogatepass"), np.uint32)
    scripts, letters, lower = _tables()
    script = scripts[codes]
    doc = np.repeat(np.arange(len(flat)), np.diff(offsets))
    mark = script == MARK
    if mark.any():  # a mark takes the script of what it stands on
        last = np.maximum.accumulate(np.where(mark, -1, np.arange(len(script))))
        script = np.where(mark, np.where(last >= offsets[doc], script[last], NEITHER), script)
    new = np.ones(len(codes) + 1, bool)
    new[1:-1] = (script[1:] != script[:-1]) | (doc[1:] != doc[:-1])
    edges = np.flatnonzero(new)
    start, end = edges[:-1], edges[1:]
    so_far = np.concatenate([[0], np.cumsum(letters[codes])])
    kept = (script[start] != NEITHER) & (so_far[end] > so_far[start])
    start, end = start[kept], end[kept]
    unspaced = np.isin(script[start], [NAMES.index(n) for n in UNSPACED])
    pieces = np.where(unspaced, -(-(end - start) // PIECE), 1)
    if (pieces > 1).any():
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        whole = np.repeat(end, pieces)
        start = np.repeat(start, pieces) + nth * PIECE
        end = np.where(np.repeat(pieces, pieces) > 1, np.minimum(start + PIECE, whole), whole)
    return Words(doc[start], start, end, script[start].astype(np.int64), lower[codes].astype(U64), offsets)


def grams(w: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length of n-gram, the classes of all words' n-grams in order, and how many each
    word has; both ends of a word count as a code point, but not as an n-gram of their own."""
    size = w.end - w.start + 2
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(word)) - first[word]
    left = np.repeat(size, size) - at
    inside = (at > 0) & (left > 1)
    codes = np.zeros(len(word) + max(GRAMS), U64)
    codes[:-max(GRAMS)][inside] = w.codes[(w.start[word] + at - 1)[inside]] + U64(1)
    key = np.zeros(len(word), U64)
    for n in range(1, max(GRAMS) + 1):
        key = key * BASE + codes[n - 1:len(word) + n - 1]
        if n in GRAMS:
            found = mixed(key[inside if n == 1 else left >= n] + U64(n)) & U64(BLOCK - 1)
            many = size - 2 if n == 1 else np.maximum(size - n + 1, 0)
            yield found.astype(np.int64) + BLOCK * GRAMS.index(n), many


# --- the model -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    """Languages, log shares of n-gram classes in each (CLASSES by languages), and the languages
    that each script leaves as candidates (scripts by languages)."""

    names: tuple[str, ...]
    logs: np.ndarray
    candidates: np.ndarray

    def scores(self, w: Words) -> np.ndarray:
        """Words by languages: the mean over GRAMS of the log shares of a word's n-grams. A word
        that comes several times is scored once."""
        first, again = distinct(w)
        own = Words(w.doc[first], w.start[first], w.end[first], w.script[first], w.codes, w.offsets)
        out = np.zeros((len(first), len(self.names)), np.float32)
        for classes, many in grams(own):
            ends = np.cumsum(many)
            low = 0
            while low < len(many):  # so many words at once that their n-grams' scores fit
                done = ends[low - 1] if low else 0
                high = max(int(np.searchsorted(ends, done + CELLS // len(self.names), "right")), low + 1)
                some = np.flatnonzero(many[low:high]) + low
                if len(some):
                    rows = self.logs[classes[done:ends[high - 1]]]
                    out[some] += np.add.reduceat(rows, ends[some] - many[some] - done, axis=0)
                low = high
        out /= len(GRAMS)
        # a script that no language was seen in bars none
        out[~self.candidates[own.script]] = BARRED
        return out[again]


def distinct(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct word, and for every word which of them it equals. Words are
    sorted by hash, and compared letter by letter with the first of their hash."""
    size = w.end - w.start
    if not len(size):
        return size, size
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    letters = np.repeat(w.start, size) + at
    h = np.add.reduceat((w.codes[letters] + U64(1)) * mixed(at.astype(U64)), np.cumsum(size) - size)
    _, first, again = np.unique(h, return_index=True, return_inverse=True)
    same = size[first][again] == size
    if same.all():
        same = w.codes[np.repeat(w.start[first][again], size) + at] == w.codes[letters]
    if not same.all():  # two words of one hash: every word stands for itself
        return np.arange(len(size)), np.arange(len(size))
    return first, again


def best_path(scores: np.ndarray, doc: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """The language of each word: the sequence of the greatest sum of scores less ``switch`` per
    change, for each text (words sorted by ``doc``). Ties go to the language that comes first.

    Texts of at most ALONE words advance together, longest first, so the loop is as long as the
    longest of them; longer ones go one by one. The result is the same.
    """
    out = np.zeros(len(doc), np.int64)
    if not len(doc):
        return out
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    length = np.diff(np.r_[first, len(doc)])
    for k in np.flatnonzero(length > ALONE):
        rows = slice(first[k], first[k] + length[k])
        out[rows] = _alone(scores[rows], switch)
    first, length = first[length <= ALONE], length[length <= ALONE]
    if not len(first):
        return out
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    alive = np.searchsorted(-length, -np.arange(1, length[0] + 1), "right")
    total = scores[first].astype(np.float64)
    # what a word's state came from: itself, or the best state of the word before
    stayed = np.ones(scores.shape, bool)
    leader = np.zeros(len(doc), np.int64)
    for step in range(1, length[0]):
        n = alive[step]
        before = total[:n]
        best = before.argmax(axis=1)
        most = before[np.arange(n), best][:, None] - switch
        rows = first[:n] + step
        stay = before >= most
        stayed[rows], leader[rows] = stay, best
        # the sums are kept relative to the best, so they stay small over any length
        total[:n] = np.where(stay, before, most) + scores[rows] - (most + switch)
    state = np.zeros(len(first), np.int64)
    for step in range(length[0] - 1, -1, -1):
        n = alive[step]
        ends = length[:n] == step + 1
        state[:n][ends] = total[:n][ends].argmax(axis=1)
        rows = first[:n] + step
        out[rows] = state[:n]
        state[:n] = np.where(stayed[rows, state[:n]], state[:n], leader[rows])
    return out


def _alone(scores: np.ndarray, switch: float) -> list[int]:
    """:func:`best_path` of one text."""
    total, back = scores[0].astype(float).tolist(), []
    for row in _rows(scores[1:]):
        best = max(total)
        most = best - switch
        back.append((total.index(best), [t >= most for t in total]))
        total = [(t if t >= most else most) + x - best for t, x in zip(total, row)]
    state = total.index(max(total))
    path = [state]
    for leader, stayed in reversed(back):
        state = state if stayed[state] else leader
        path.append(state)
    return path[::-1]


def _rows(scores: np.ndarray, at_once: int = 10_000) -> Iterator[list[float]]:
    for k in range(0, len(scores), at_once):
        yield from scores[k:k + at_once].astype(float).tolist()


def taught(doc_id: str) -> Column:
    """Whether a document may be learned from; one without id may."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2, F.lit(True))


def sample(docs: DataFrame, most: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """(lang, text) of at most ``most`` documents of each of the ``languages`` languages that have
    the most, the first by a hash of doc_id among those that may be learned from.

    A language's number of ids, estimated first, says below which hash about four times as many as
    needed lie, so hardly any row is shuffled. A doc_id that repeats teaches one of its texts per
    language, the smallest: neither a hot language nor a hot id makes the sample larger.
    """
    labelled = pick(docs, "doc_id", "text", "lang").where(F.col("lang").isNotNull() & taught("doc_id"))
    known = F.struct("doc_id")  # counts a null id too
    often = labelled.groupBy("lang").agg(F.approx_count_distinct(known).alias("ids")).orderBy(
        F.desc("ids"), "lang").limit(languages).select(F.col("lang").alias("of"), "ids")
    by_lang = F.col("lang") == F.col("of")
    h = F.xxhash64(F.lit(11), "doc_id")
    low = F.pmod(h, F.lit(1 << 20)) < F.lit(float(4 * most << 20)) / F.col("ids")
    ids = labelled.join(F.broadcast(often), by_lang).where(low).select("lang", "doc_id").distinct()
    order = Window.partitionBy("lang").orderBy(F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1 << 20)), "doc_id")
    chosen = ids.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= most).select(
        F.col("lang").alias("of"), F.col("doc_id").alias("id"))
    # at most ``most`` * ``languages`` ids
    mine = by_lang & F.col("doc_id").eqNullSafe(F.col("id"))
    return labelled.join(F.broadcast(chosen), mine, "left_semi").groupBy("lang", "doc_id").agg(
        F.min(F.coalesce("text", F.lit(""))).alias("text")).select("lang", "text")


def counted(texts: DataFrame) -> DataFrame:
    """(lang, kind, place, n): n-grams per class (kind 0) and letters per script (kind 1)."""
    def work(batch: pa.RecordBatch) -> dict:
        names, lang = np.unique(np.array(batch.column("lang").to_pylist(), object), return_inverse=True)
        w = words(batch.column("text").to_pylist())
        of = lang[w.doc]
        found = [(0, np.repeat(of, many) * CLASSES + classes) for classes, many in grams(w)]
        found.append((1, np.repeat(of * CLASSES + w.script, w.end - w.start)))
        out = {"lang": [], "kind": [], "place": [], "n": []}
        for kind, keys in found:
            key, n = np.unique(keys, return_counts=True)
            out["lang"] += names[key // CLASSES].tolist()
            out["kind"].append(np.full(len(key), kind, np.int32))
            out["place"].append((key % CLASSES).astype(np.int32))
            out["n"].append(n)
        return {"lang": pa.array(out["lang"], pa.string()),
                **{c: np.concatenate(out[c]) for c in ("kind", "place", "n")}}

    parts = per_slice(texts, work, "lang string, kind int, place int, n bigint")
    return parts.groupBy("lang", "kind", "place").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, most: int = SAMPLE) -> Model:
    """Learn from text and non-null lang of documents whose crc32(doc_id as text) mod 4 is not 2.

    The model has CLASSES numbers per language, whatever the input. A language whose sample holds
    no letter is learned as one that every n-gram is as likely in. Without labelled documents the
    model has no language.
    """
    texts = written(sample(docs, most), "language-sample")
    names = tuple(sorted(r[0] for r in texts.select("lang").distinct().collect()))
    table = counted(texts).toPandas()
    place = {name: k for k, name in enumerate(names)}
    of = table["lang"].map(place).to_numpy(np.int64)
    counts = np.zeros((CLASSES, len(names)))
    scripts = np.zeros((len(NAMES), len(names)))
    for kind, into in ((0, counts), (1, scripts)):
        rows = (table["kind"] == kind).to_numpy()
        into[table["place"].to_numpy()[rows], of[rows]] = table["n"].to_numpy()[rows]
    logs = np.zeros(counts.shape, np.float32)
    for k in range(len(GRAMS)):
        part = counts[k * BLOCK:(k + 1) * BLOCK]
        seen = max(int(part.any(axis=1).sum()), 1)
        logs[k * BLOCK:(k + 1) * BLOCK] = np.log(
            (part + SMOOTHING) / (part.sum(axis=0) + SMOOTHING * seen))
    candidates = scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)
    candidates[~candidates.any(axis=1)] = True
    return Model(names, logs, candidates)


# --- the operator --------------------------------------------------------------------------

def labelled(texts: list[str | None], model: Model) -> Iterator[tuple[str, float, list]]:
    """For each text its language, how sure that is (0 to 1), and its spans: (first code point,
    last + 1, language), from the first to the last letter of neighbouring words of one language.

    The language is the one whose spans have the most letters (ties: the better total of scores,
    then the first by name). The score is those spans' share of the letters, times the probability
    of the language against the others, judged by these spans' words.
    """
    w = words(texts)
    if not model.names:
        yield from ((UNKNOWN, 0.0, []) for _ in texts)
        return
    scores = model.scores(w)
    path = best_path(scores, w.doc)
    bounds = np.searchsorted(w.doc, np.arange(len(texts) + 1))
    letters = w.end - w.start
    for k, (low, high) in enumerate(zip(bounds[:-1], bounds[1:])):
        if low == high:
            yield UNKNOWN, 0.0, []
            continue
        own = path[low:high]
        share = np.bincount(own, letters[low:high], len(model.names))
        total = scores[low:high].sum(axis=0, dtype=np.float64)
        best = max(range(len(model.names)), key=lambda x: (share[x], total[x], -x))
        judged = scores[low:high][own == best].sum(axis=0, dtype=np.float64)
        odds = np.exp(np.clip(judged - judged[best], -700, 700)).sum()
        cut = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) + low
        until = np.r_[cut[1:], high] - 1
        base = int(w.offsets[k])
        spans = [(int(w.start[a]) - base, int(w.end[b]) - base, model.names[path[a]])
                 for a, b in zip(cut, until)]
        yield model.names[best], float(share[best] / share.sum() / odds), spans


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score and spans (array of start, end, lang; places are code points of the
    text), one row per row of ``docs`` (doc_id, text).

    Null, empty and letterless texts are ``und`` with score 0 and no span, as is every text if no
    language was learned. Words in a script that no learned language uses have all languages as
    candidates. Repeated rows are each labelled by themselves; extra columns play no part. Texts
    are read whole.
    """
    def work(batch: pa.RecordBatch) -> dict:
        made = list(labelled(batch.column("text").to_pylist(), model))
        flat = [s for _, _, spans in made for s in spans]
        offsets = np.concatenate([[0], np.cumsum([len(s) for _, _, s in made])]).astype(np.int32)
        starts, ends, names = zip(*flat) if flat else ((), (), ())
        spans = pa.StructArray.from_arrays(
            [pa.array(starts, pa.int32()), pa.array(ends, pa.int32()), pa.array(names, pa.string())],
            names=["start", "end", "lang"])
        return {"doc_id": batch.column("doc_id"), "lang_pred": pa.array([m[0] for m in made], pa.string()),
                "score": pa.array([m[1] for m in made], pa.float64()),
                "spans": pa.ListArray.from_arrays(pa.array(offsets), spans)}

    slim = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return per_slice(slim, work, "doc_id bigint, lang_pred string, score double, "
                                 "spans array<struct<start:int,end:int,lang:string>>")


def predicted(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and n_spans of every row of ``docs`` (doc_id, text, lang);
    see :func:`identified` for what texts give and :func:`train` for what is learned. A document
    without id is not held out. An empty table gives no rows."""
    ship(docs.sparkSession)
    made = identified(docs, train(docs))
    return made.select("doc_id", (~taught("doc_id")).alias("held_out"), "lang_pred", "score",
                       F.size("spans").alias("n_spans"))
