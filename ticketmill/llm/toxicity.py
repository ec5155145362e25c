"""Toxicity: a weighted lexicon, learned from labels, matched in folded text by Aho-Corasick."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import per_slice
from ticketmill.llm.frames import pick, ship, written

#: Labelled rows learned from, at most: so many of either label, chosen by a hash of doc_id.
SAMPLE = 4_000
#: Code points of the shortest and longest terms; a term is the start of a word.
SHORTEST, LONGEST = 4, 12
#: Uses of a term, independent of each other, that toxic texts must show at least.
VARIED = 3
#: Texts, and share of a term's toxic texts, from which equal surroundings are those of a copied
#: text: the edited copies of it are then no uses of their own.
COPIED, COPIED_SHARE = 3, 0.1
#: Documents that must show a benign use before it is an exception.
BENIGN = 3

#: Letters that look like Latin ones, and digits and signs written for letters.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
WRITTEN_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

_FOLD = str.maketrans(
    LOOKALIKES | WRITTEN_FOR | {chr(c): chr(c - 0xFEE0) for c in range(0xFF41, 0xFF5B)}
    | {c: "" for c in "​‌‍⁠﻿­"})
_WORD = re.compile(r"[^\W\d_]+")


def fold(text: str) -> str:
    """Lower case, with lookalikes and substitutions as the letters they stand for, and without
    characters that show nothing."""
    return text.lower().translate(_FOLD)


class Lexicon:
    """Terms with weights, and phrases in which a term is no match. A term matches at the start
    of a word; a phrase (whole words, single spaces) covers the matches inside it."""

    def __init__(self, terms: dict[str, float], exceptions: frozenset[str] = frozenset()):
        self.terms, self.exceptions = terms, exceptions

    def __reduce__(self):
        return Lexicon, (self.terms, self.exceptions)

    @property
    def machine(self):
        return _machine(tuple(sorted(self.terms.items())), tuple(sorted(self.exceptions)))

    def matches(self, text: str) -> list[tuple[int, str]]:
        """(start, term) in folded ``text``, longest term where several start at one place."""
        machine = self.machine
        if not len(machine):
            return []
        found: dict[int, str] = {}
        covered: list[tuple[int, int]] = []
        for end, (kind, word) in machine.iter(text):
            start = end - len(word) + 1
            if start and text[start - 1].isalpha():
                continue
            if kind and not text[end + 1:end + 2].isalpha():
                covered.append((start, end))
            elif not kind and len(word) > len(found.get(start, "")):
                found[start] = word
        return sorted((s, w) for s, w in found.items()
                      if not any(a <= s and s + len(w) - 1 <= b for a, b in covered))

    def features(self, text: str) -> tuple[float, float]:
        """Total weight, and weight per hundred words, of the matches."""
        folded = fold(text)
        weight = sum(self.terms[w] for _, w in self.matches(folded))
        return weight, 100 * weight / max(100, text.count(" ") + text.count("\n") + 1) if weight else 0.0


@lru_cache(maxsize=2)
def _machine(terms: tuple, exceptions: tuple):
    import ahocorasick

    machine = ahocorasick.Automaton()
    # the key says which kind it is, so that a phrase and a term may be spelled alike
    for word, _ in terms:
        machine.add_word(word, (0, word))
    for phrase in exceptions:
        if phrase not in machine:
            machine.add_word(phrase, (1, phrase))
    machine.make_automaton()
    return machine


def train_rows(labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """(doc_id, toxic) of at most ``most`` labelled rows of either label, the first by a hash of
    doc_id. Rows whose crc32(doc_id as text) mod 5 is 0 are held out."""
    rows = pick(labels, "doc_id", "toxic").where(F.col("toxic").isin(0, 1) & ~held_out("doc_id"))
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    order = F.xxhash64(F.lit(7), "doc_id"), F.col("doc_id")
    of = [rows.where(F.col("toxic") == v).orderBy(*order).limit(most) for v in (0, 1)]
    return of[0].union(of[1])


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def terms_of(text: str) -> dict[str, str]:
    """The terms of a text and the words on both sides of each one's first place."""
    words = ["", *_WORD.findall(fold(text)), ""]
    found: dict[str, str] = {}
    for before, word, after in zip(words, words[1:], words[2:]):
        for n in range(SHORTEST, min(LONGEST, len(word)) + 1):
            found.setdefault(word[:n], f"{before} {after}")
    return found


def _term_sets(texts: DataFrame) -> DataFrame:
    """(toxic, term, around), each term of a document once."""
    def work(batch: pa.RecordBatch) -> dict:
        labels, terms, around = [], [], []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            own = terms_of(text)
            terms += own.keys()
            around += own.values()
            labels += [toxic] * len(own)
        return {"toxic": pa.array(labels, pa.int32()), "term": pa.array(terms, pa.string()),
                "around": pa.array(around, pa.string())}

    return per_slice(texts, work, "toxic int, term string, around string")


def independent(uses: list[tuple[str, str]]) -> int:
    """Uses, given as (word before, word after) by text, that are not copies of each other. While
    one pair holds a large share of what is left, it is a copied text's: it counts once, and with
    it go the uses that share a neighbour with it, as edited copies do."""
    left, count = Counter(uses), 0
    while left:
        (before, after), n = min(left.items(), key=lambda u: (-u[1], u[0]))
        if n < COPIED or n < COPIED_SHARE * left.total():
            return count + len(left)
        count += 1
        left = Counter({u: k for u, k in left.items() if u[0] != before and u[1] != after})
    return count


def _independent(texts: DataFrame, terms: frozenset[str]) -> DataFrame:
    """(term, uses): independent uses of each of ``terms`` in the toxic texts."""
    def find(batch: pa.RecordBatch) -> dict:
        found = [(t, around) for text in batch.column("text").to_pylist()
                 for t, around in terms_of(text).items() if t in terms]
        return {"term": pa.array([t for t, _ in found], pa.string()),
                "around": pa.array([a for _, a in found], pa.string())}

    def count(batch: pa.RecordBatch) -> dict:
        uses = [independent([tuple(a.split(" ")) for a in around])
                for around in batch.column("around").to_pylist()]
        return {"term": batch.column("term"), "uses": pa.array(uses, pa.int64())}

    found = per_slice(texts.where("toxic = 1"), find, "term string, around string")
    lists = found.groupBy("term").agg(F.collect_list("around").alias("around"))
    return per_slice(lists, count, "term string, uses bigint", column="term")


def _scored(rows: list, n_toxic: int, n_clean: int, tried: int) -> list[tuple]:
    """(-likelihood ratio, -length, term, weight) of the (term, toxic, clean) that reach the bar,
    which rises with the number of terms tried."""
    total = n_toxic + n_clean
    bar = 2 * math.log(max(tried, 1)) + 1
    scored = []
    for term, toxic, clean in rows:
        both = toxic + clean
        g = 2 * sum(x * math.log(x * total / (n * both))
                    for x, n in ((toxic, n_toxic), (clean, n_clean)) if x)
        weight = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        if g >= bar and weight >= 2.5 and toxic >= VARIED:
            scored.append((-g, -len(term), term, weight))
    return scored


def _choose(rows: list, n_toxic: int, n_clean: int, tried: int) -> dict[str, float]:
    """Terms by likelihood ratio, strongest first (of equals the longer), leaving out those that
    start or extend a chosen one.

    ``rows`` are (term, independent uses in toxic texts, clean texts). Copies of a toxic text make
    all its words frequent, but add one use to each however many there are.
    """
    scored = _scored(rows, n_toxic, n_clean, tried)
    chosen: dict[str, float] = {}
    for _, _, term, weight in sorted(scored):
        if not any(t.startswith(term) or term.startswith(t) for t in chosen):
            chosen[term] = weight
    # a longer start that is nearly as frequent says the same and hits less by chance
    weights, seen = {t: w for _, _, t, w in scored}, {r[0]: r[1] for r in rows}
    out = {}
    for term in chosen:
        longer = [t for t in weights if t.startswith(term) and seen[t] >= 0.95 * seen[term]]
        best = max(sorted(longer), key=len)
        out[best] = weights[best]
    return out


def _uses(lexicon: Lexicon, texts: DataFrame) -> DataFrame:
    """(toxic, phrase): the words and word pairs in which terms are found, once per document."""
    def work(batch: pa.RecordBatch) -> dict:
        labels, phrases = [], []
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            folded, own = fold(text), set()
            for start, _ in lexicon.matches(folded):
                around = re.match(r"([^\W\d_]+)(?: ([^\W\d_]+))?", folded[start:start + 200])
                before = re.search(r"([^\W\d_]+) $", folded[max(0, start - 100):start])
                own.add(around[1])
                if around[2]:
                    own.add(f"{around[1]} {around[2]}")
                if before:
                    own.add(f"{before[1]} {around[1]}")
            phrases += own
            labels += [toxic] * len(own)
        return {"toxic": pa.array(labels, pa.int32()), "phrase": pa.array(phrases, pa.string())}

    return per_slice(texts, work, "toxic int, phrase string")


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    b = np.zeros(x.shape[1])
    ridge = np.diag([1.0] * (x.shape[1] - 1) + [1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (y - p) - ridge @ b)
        b = b + step
        if np.abs(step).max() < 1e-8:
            break
    return b


class Model:
    """A lexicon and how its matches become a probability."""

    def __init__(self, lexicon: Lexicon, coefficients: np.ndarray):
        self.lexicon, self.coefficients = lexicon, coefficients

    @staticmethod
    def shape(weight: np.ndarray, dense: np.ndarray) -> np.ndarray:
        return np.column_stack([np.log1p(weight), np.log1p(dense)])

    def scores(self, texts: list[str]) -> np.ndarray:
        raw = np.array([self.lexicon.features(t) for t in texts], float).reshape(-1, 2)
        x = self.shape(raw[:, 0], raw[:, 1])
        z = x @ self.coefficients[:-1] + self.coefficients[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model from the different texts of at most ``2 * most`` labelled rows. Without a toxic and
    a clean row among them there is nothing to learn: every score is 0 or 1 accordingly."""
    ids = train_rows(labels, most)
    slim = pick(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = written(slim.join(F.broadcast(ids), "doc_id").select("text", "toxic").distinct(),
                    "labelled")
    sizes = {r["toxic"]: r["count"] for r in texts.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Model(Lexicon({}), np.array([0.0, 0.0, 30.0 if n_toxic else -30.0]))
    toxic, clean = (F.sum((F.col("toxic") == v).cast("int")) for v in (1, 0))
    counts = written(_term_sets(texts).groupBy("term").agg(
        F.count_distinct(F.when(F.col("toxic") == 1, F.col("around"))).alias("varied"),
        toxic.alias("toxic"), clean.alias("clean")).where("toxic >= 3"), "terms")
    rows = counts.where("clean * 4 <= toxic").select("term", "varied", "clean").collect()
    tried = counts.count()
    clean_of = {r["term"]: r["clean"] for r in rows}
    hopeful = frozenset(t for _, _, t, _ in _scored([tuple(r) for r in rows], n_toxic, n_clean, tried))
    uses = _independent(texts, hopeful).collect() if hopeful else []
    terms = _choose([(r["term"], r["uses"], clean_of[r["term"]]) for r in uses], n_toxic, n_clean, tried)
    lexicon = Lexicon(terms)
    benign = _uses(lexicon, texts).groupBy("phrase").agg(
        toxic.alias("toxic"), clean.alias("clean")).where((F.col("clean") >= BENIGN) & (F.col("toxic") == 0))
    lexicon = Lexicon(terms, frozenset(r["phrase"] for r in benign.select("phrase").collect()))

    def measure(batch: pa.RecordBatch) -> dict:
        made = np.array([lexicon.features(t) for t in batch.column("text").to_pylist()])
        return {"weight": made[:, 0], "dense": made[:, 1], "toxic": batch.column("toxic")}

    rows = per_slice(texts, measure, "weight double, dense double, toxic int").toPandas()
    rows = rows.sort_values(["toxic", "weight", "dense"])  # so that reruns agree to the last bit
    x = Model.shape(rows["weight"].to_numpy(), rows["dense"].to_numpy())
    return Model(lexicon, _logistic(x, rows["toxic"].to_numpy(float)))


def toxic_score(model: Model, text: Column) -> Column:
    """Probability that the whole text is toxic; null counts as empty."""
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores(texts.tolist()), dtype="float64")

    return F.pandas_udf(score, "double")(F.coalesce(text, F.lit("")))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted (1 from 0.5 on), one row per row of ``docs``.

    Null and empty texts have no match and so the score of a text without one. A null doc_id is
    not held out. A doc_id labelled twice is toxic if any of its labels says so; labels that are
    neither 0 nor 1 teach nothing. Repeated rows are each scored by themselves. Scores rest on
    the text alone.
    """
    ship(docs.sparkSession)
    slim = pick(docs, "doc_id", "text")
    made = slim.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       toxic_score(train(docs, labels), F.col("text")).alias("score"))
    return made.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                       F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))
