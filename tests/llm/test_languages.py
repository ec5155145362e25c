from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from ticketmill.llm import languages

from .frames_for import AWKWARD, documents, rows_of

SYLLABLES = {"aa": "ba ko ri tum sel no vi".split(), "bb": "schen gro wut fel pf acht zu".split(),
             "ru": "ка ро ми ст во де".split()}


def say(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n))


def corpus(spark, rows, extra=()):
    """(doc_id, text, lang) rows."""
    frame = documents(spark, [(i, t) for i, t, _ in rows], extra)
    table = frame.toArrow()
    place = table.column_names.index("lang")
    return spark.createDataFrame(table.set_column(place, "lang", pa.array([r[2] for r in rows], pa.string())))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    rows = [(i, say(rng, lang, rng.randint(3, 60)), lang) for i, lang in enumerate(sorted(SYLLABLES) * 60, 1000)]
    return rows


@pytest.fixture(scope="module")
def model(spark, rows):
    return languages.train(corpus(spark, rows))


def test_held_out_documents(spark, rows):
    rng = random.Random(6)
    odd = [(i, t, None) for i, t, *_ in AWKWARD] + [(900, "123 !? 漢字", "aa"), (901, "42, 43", "aa"), (902, "́̂ 7", "aa")]
    mixed = [(910, say(rng, "aa", 40) + ". " + say(rng, "bb", 10), "aa"), (911, say(rng, "bb", 5) + " " + say(rng, "ru", 30), "ru")]
    got = rows_of(languages.predicted(corpus(spark, rows + odd + mixed + rows[:1], extra=("n", "TEXT", "spans"))))
    by_id = {r["doc_id"]: r for r in got}
    assert len(got) == len(rows) + len(odd) + len(mixed) + 1
    assert all(by_id[i]["lang_pred"] == lang for i, _, lang in rows + mixed)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    assert {by_id[i]["lang_pred"] for i in (90, 91, 92, 96, 901, 902)} == {"und"} and by_id[90]["score"] == 0
    assert by_id[93]["lang_pred"] in SYLLABLES and by_id[900]["lang_pred"] in SYLLABLES
    assert by_id[910]["n_spans"] == by_id[911]["n_spans"] == 2 and by_id[911]["score"] < by_id[1002]["score"]


def test_held_out_rows_lang_and_ids_teach_nothing(spark, rows):
    other = [(i, t if not held_out(i) else t + " x", lang if not held_out(i) else "bb") for i, t, lang in rows]
    a, b = languages.train(corpus(spark, rows)), languages.train(corpus(spark, other))
    assert a.names == b.names and (a.logs == b.logs).all() and (a.candidates == b.candidates).all()


def test_spans_of_mixed_text(model):
    rng = random.Random(7)
    parts = [(lang, say(rng, lang, 12)) for lang in ("aa", "ru", "bb", "aa")]
    text = "1) " + "; ".join(t for _, t in parts) + "!"
    (lang, score, spans), = languages.labelled([text], model)
    places, at = [], 3
    for name, t in parts:
        places.append((at, at + len(t), name))
        at += len(t) + 2
    assert spans == places and lang == "aa" and 0 < score < 0.6


def test_marks_scripts_and_pieces():
    w = languages.words(["abcде éf", "́", "", "漢字漢字漢字x", None, "Ａｂ कि"])
    found = [("".join(map(chr, w.codes[a:b])), d) for a, b, d in zip(w.start, w.end, w.doc)]
    assert found == [("abc", 0), ("де", 0), ("éf", 0), ("漢字漢字", 3), ("漢字", 3), ("x", 3), ("ａｂ", 5), ("कि", 5)]
    assert len(languages.words([]).start) == len(languages.words([None, ""]).start) == 0
    classes = {n: (c, m.tolist()) for n, (c, m) in zip(languages.GRAMS, languages.grams(languages.words(["abc a"])))}
    assert {n: m for n, (c, m) in classes.items()} == {1: [3, 1], 2: [4, 2], 3: [3, 1], 4: [2, 0]}
    assert classes[1][0][0] == classes[1][0][3]  # the same letter, the same class
    assert all(len(c) == sum(m) for c, m in classes.values())


def worth(scores, path, switch):
    return sum(s[k] for s, k in zip(scores, path)) - switch * sum(a != b for a, b in zip(path, path[1:]))


@pytest.mark.parametrize("alone", [0, 2_000])
def test_best_path_against_every_path(alone, monkeypatch):
    monkeypatch.setattr(languages, "ALONE", alone)
    rng = np.random.default_rng(8)
    lengths = [1, 6, 3, 7, 2, 7]
    doc = np.repeat(np.array([0, 1, 4, 5, 8, 9]), lengths)
    scores = rng.normal(size=(len(doc), 3)).astype(np.float32) * 3
    scores[4, 0] = languages.BARRED
    made = languages.best_path(scores, doc, 2.5)
    for d in np.unique(doc):
        own = scores[doc == d].astype(float)
        best = max(itertools.product(range(3), repeat=len(own)), key=lambda p: worth(own, p, 2.5))
        assert worth(own, made[doc == d], 2.5) == pytest.approx(worth(own, best, 2.5))
    assert languages.best_path(scores[:0], doc[:0]).tolist() == []
    tied = languages.best_path(np.zeros((4, 3), np.float32), np.zeros(4, int))
    assert tied.tolist() == [0, 0, 0, 0]


def test_scores_in_parts_are_the_same(model, monkeypatch):
    rng = random.Random(9)
    w = languages.words([say(rng, lang, 30) for lang in SYLLABLES])
    whole = model.scores(w)
    monkeypatch.setattr(languages, "CELLS", 7)
    assert np.allclose(model.scores(w), whole)
    counts = {n: 0 for n in languages.GRAMS}
    word = "".join(map(chr, w.codes[w.start[0]:w.end[0]]))
    for n, (classes, many) in zip(languages.GRAMS, languages.grams(w)):
        counts[n] = model.logs[classes[:many[0]]].sum(axis=0)
        assert many[0] == (len(word) if n == 1 else max(len(word) + 3 - n, 0))
    expected = sum(counts.values()) / len(languages.GRAMS)
    assert np.allclose(whole[0][model.candidates[w.script[0]]], expected[model.candidates[w.script[0]]])


def test_repeated_words_are_scored_once_and_alike(model, monkeypatch):
    w = languages.words(["ba kori ba", None, "kori Ba x", "abba"])
    first, again = languages.distinct(w)
    assert len(first) == 4 and again[0] == again[2] == again[4] and again[1] == again[3]
    whole = model.scores(w)
    monkeypatch.setattr(languages, "mixed", lambda x: x * languages.U64(0))  # all words of one hash
    assert np.array_equal(languages.distinct(w)[0], np.arange(7))
    monkeypatch.undo()
    monkeypatch.setattr(languages, "distinct", lambda w: (np.arange(7), np.arange(7)))
    assert np.array_equal(model.scores(w), whole)


def test_scripts_narrow_and_one_script_left(model):
    latin, cyrillic = languages.NAMES.index("latin"), languages.NAMES.index("cyrillic")
    assert dict(zip(model.names, model.candidates[latin])) == {"aa": True, "bb": True, "ru": False}
    assert dict(zip(model.names, model.candidates[cyrillic])) == {"aa": False, "bb": False, "ru": True}
    assert model.candidates[languages.NAMES.index("han")].all()


def test_nothing_to_learn(spark):
    assert languages.predicted(corpus(spark, [])).collect() == []
    got = rows_of(languages.predicted(corpus(spark, [(1, "some words", None), (2, None, None)])))
    assert {(r["lang_pred"], r["score"], r["n_spans"]) for r in got} == {("und", 0.0, 0)}
    got = rows_of(languages.predicted(corpus(spark, [(5, "7", "aa"), (None, "more words", "aa")] + [(1, "words", "aa")] * 3)))
    assert sorted(r["lang_pred"] for r in got) == ["aa", "aa", "aa", "aa", "und"]


def test_sample_is_bounded_and_ids_repeat(spark, rows):
    frame = corpus(spark, rows * 3 + [(None, "x", "aa")] * 50 + [(3, "z" * 9, "aa")] * 500)
    made = rows_of(languages.sample(frame, most=20))
    assert {lang: sum(r["lang"] == lang for r in made) for lang in SYLLABLES} == {"aa": 20, "bb": 20, "ru": 20}
    assert len(rows_of(languages.sample(frame, most=20, languages=1))) == 20


def test_very_long_text(model):
    rng = random.Random(10)
    text = say(rng, "bb", 30_000) + " " + say(rng, "aa", 5_000)
    (lang, score, spans), = languages.labelled([text], model)
    assert lang == "bb" and [s[2] for s in spans] == ["bb", "aa"] and 0.8 < score < 0.95


def test_sample_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = rows_of(languages.predicted(docs))
    right = [r["lang_pred"] == langs[r["doc_id"]] for r in got if r["held_out"]]
    assert len(got) == len(langs) and len(right) > 200 and np.mean(right) >= 0.99
