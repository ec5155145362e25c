"""Quality rules as weak supervision: rules vote or abstain, EM learns how far to trust each."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import BASE, LOWER, U64, Rolling, flat, mixed, per_slice, words
from ticketmill.llm.frames import pick, written

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the be to of and that have with in a is was for on as by it from this are not or an at "
    "der die das und ist im von zu den mit ein eine nicht auf dem des sich für auch "
    "le la les de des et en un une du que est pour dans qui sur pas par avec au "
    "el los las del y que en un una por con no para se su al lo es"
).split()
SYMBOLS = "#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_stop", "n_ends", "n_lettered")


def _hashes(texts: list[str]) -> np.ndarray:
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    ends = np.cumsum([len(t.encode()) for t in texts])
    return Rolling(raw).of(np.r_[0, ends[:-1]], ends)


def _marks(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode())] = True
    return out


def features(docs: DataFrame) -> DataFrame:
    """doc_id and counts over the whole text, one row per row of ``docs``."""
    def work(batch: pa.RecordBatch) -> dict:
        raw, offsets = flat(batch.column("text"))
        n_docs = batch.num_rows
        starts, ends, at = words(raw, offsets)
        doc = np.repeat(np.arange(n_docs), np.diff(at))

        def total(flags: np.ndarray, places: np.ndarray) -> np.ndarray:
            """Flags counted between every two places."""
            sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            return sums[places[1:]] - sums[places[:-1]]

        rolling = Rolling(raw)
        hashes = rolling.of(starts, ends)
        # windows of three words within a document, told apart by document
        three = np.flatnonzero(doc[2:] == doc[:-2]) if len(doc) > 2 else np.zeros(0, int)
        own = (doc[three].astype(U64) + U64(1)) * U64(0xC2B2AE3D27D4EB4F)
        h = mixed((hashes[three] * BASE + hashes[three + 1]) * BASE + hashes[three + 2] + own)
        _, which, times = np.unique(h, return_inverse=True, return_counts=True)
        again = three[times[which] > 1]
        repeated = np.zeros(len(doc), bool)
        for step in range(3):
            repeated[again + step] = True
        # lines: cut at every newline and at every document's end
        newline = np.flatnonzero(raw == 10)
        line_start = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
        line_end = np.sort(np.concatenate([offsets[1:], newline]), kind="stable")
        per_doc = total(raw == 10, offsets) + 1
        line_doc = np.repeat(np.arange(n_docs), per_doc)
        worded = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
        line = mixed(rolling.of(line_start, line_end)
                     + (line_doc.astype(U64) + U64(1)) * U64(0xC2B2AE3D27D4EB4F))
        later = np.ones(len(line), bool)
        later[np.unique(line, return_index=True)[1]] = False
        lines_at = np.concatenate([[0], np.cumsum(per_doc)])
        stops = np.sort(_hashes(STOP_WORDS))
        lower = Rolling(LOWER[raw]).of(starts, ends)
        near = np.minimum(np.searchsorted(stops, lower), len(stops) - 1)
        letters = _marks("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
        letters[128:] = True
        seen = np.concatenate([[0], np.cumsum(letters[raw])])
        wide = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        stopped = _marks(".!?")[raw[ends - 1]] if len(ends) else np.zeros(0, bool)
        chars = np.concatenate([[0], np.cumsum(wide[ends] - wide[starts])])
        return {
            "doc_id": batch.column("doc_id"), "n_words": np.diff(at),
            "word_chars": chars[at[1:]] - chars[at[:-1]],
            "n_symbols": total(_marks(SYMBOLS)[raw], offsets),
            "n_dup_lines": total(worded & later, lines_at),
            "n_repeat_words": total(repeated, at),
            "n_lines": total(worded, lines_at),
            "n_stop": total(stops[near] == lower, at),
            "n_ends": total(stopped, at),
            "n_lettered": total(seen[ends] > seen[starts], at),
        }

    slim = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return per_slice(slim, work, "doc_id bigint, " + ", ".join(f"{n} bigint" for n in FEATURES))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(good, 1).when(bad, -1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes on a row of features: 1 good, -1 bad, 0 abstains. In whole numbers throughout."""
    n, c = F.col("n_words"), F.col
    return {
        "symbols": _vote(100 * c("n_symbols") <= 2 * n, 100 * c("n_symbols") > 10 * n),
        "word_length": _vote((c("word_chars") >= 3 * n) & (c("word_chars") <= 12 * n),
                             (2 * c("word_chars") < 5 * n) | (c("word_chars") > 20 * n)),
        "dup_lines": _vote((c("n_lines") > 1) & (20 * c("n_dup_lines") <= c("n_lines")),
                           2 * c("n_dup_lines") > c("n_lines")),
        "repeats": _vote(100 * c("n_repeat_words") <= 10 * n, 100 * c("n_repeat_words") > 40 * n),
        "length": _vote(n >= 100, n < 20),
        "stop_words": _vote(100 * c("n_stop") >= 8 * n, 100 * c("n_stop") < 2 * n),
        "sentences": _vote((100 * c("n_ends") >= 2 * n) & (100 * c("n_ends") <= 25 * n),
                           200 * c("n_ends") < n),
        "letters": _vote(100 * c("n_lettered") >= 90 * n, 100 * c("n_lettered") < 70 * n),
    }


def fit(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[float, np.ndarray]:
    """Share of good documents, and per rule the log odds for good of each vote (-1, 0, 1), by EM
    over the different vote patterns. A rule has an accuracy on good and one on bad documents, as
    most rules find little wrong with either; abstaining says nothing.

    EM starts from documents without a bad vote as mostly good. A bad vote never speaks for a
    document, nor a good one against it.
    """
    shown = np.stack([votes == v for v in (-1, 0, 1)], axis=2).astype(float)
    good = np.where((votes < 0).any(axis=1), 0.2, 0.95)
    share, odds = 0.5, np.zeros((votes.shape[1], 3))
    for _ in range(rounds):
        old = odds
        rates = []
        for part in (good, 1 - good):
            seen = (np.einsum("p,prv->rv", counts * part, shown) + 1) * [1, 0, 1]
            rates.append(seen / seen.sum(axis=1, keepdims=True))
        odds = np.zeros_like(odds)
        odds[:, ::2] = np.log(rates[0][:, ::2] / rates[1][:, ::2])
        odds[:, 0], odds[:, 2] = np.minimum(odds[:, 0], 0), np.maximum(odds[:, 2], 0)
        share = float(np.clip((counts @ good + 1) / (counts.sum() + 2), 0.01, 0.99))
        good = 1 / (1 + np.exp(-(math.log(share / (1 - share)) + np.einsum("rv,prv->p", odds, shown))))
        if np.abs(odds - old).max(initial=0) < 1e-9:
            break
    return share, odds


def judged(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and the other features, base_failed, quality (posterior probability that
    the document is good) and kept, one row per row of ``docs``.

    base_failed: fewer than 50 words, or over half of the words in three-word windows found more
    than once. kept: not base_failed and quality of at least 0.5. Null and empty text have no
    words and fail the base. Only the different vote patterns, at most 3 to the number of rules,
    reach the driver. Repeated rows count as often as they come; null doc_ids pass through; other
    columns are not read. An empty table gives an empty result.
    """
    made = written(features(docs), "features")
    named = rules()
    cast = made.select(*(v.alias(k) for k, v in named.items())).groupBy(*named).count().collect()
    votes = np.array([[r[k] for k in named] for r in cast], float).reshape(-1, len(named))
    counts = np.array([r["count"] for r in cast], float)
    order = np.lexsort(votes.T)
    share, learned = fit(votes[order], counts[order])
    odds = F.lit(math.log(share / (1 - share)))
    for vote, of in zip(named.values(), learned.tolist()):
        odds = odds + F.when(vote == -1, of[0]).when(vote == 0, of[1]).otherwise(of[2])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    quality = 1 / (1 + F.exp(-odds))
    return made.withColumn("base_failed", failed).withColumn("quality", quality).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= 0.5))


def verdicts(docs: DataFrame) -> DataFrame:
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                               "n_repeat_words", "base_failed", "kept", "quality")
