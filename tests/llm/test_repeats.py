from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import repeats
from ticketmill.llm.anchors import runs

from .frames_for import AWKWARD, documents, edited, prose, rows_of


def plain(rows, length=repeats.LENGTH):
    """Every window looked up among the first places of all windows."""
    first: dict[bytes, tuple] = {}
    key = lambda doc_id: 2**63 - 1 if doc_id is None else doc_id
    for doc_id, text in rows:
        raw = (text or "").encode()
        for p in range(len(raw) - length + 1):
            at = (key(doc_id), p)
            first[raw[p:p + length]] = min(first.get(raw[p:p + length], at), at)
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for p in range(len(raw) - length + 1):
            if first[raw[p:p + length]] < (key(doc_id), p):
                gone[p:p + length] = True
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]])
        spans = int((gone[:-1] & ~np.r_[False, gone[:-2]]).sum()) if len(raw) else 0
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def sample_rows():
    base, passage = prose(1, 300), prose(2, 60)
    rng = random.Random(3)
    rows = [*AWKWARD, (5, base), (6, base), (3, base + "tail"), (4, edited(base, 4, 0.03)),
            (7, "a" * 700), (8, "ab" * 300), (9, base[40:900]), (9, base[40:900]), (9, base[10:500]),
            (10, passage + passage + "x" + passage), (11, "é" * 130), (None, base), (12, passage[:99]),
            (13, passage[:100])]
    for i in range(20, 120):  # many neighbours of one passage
        rows.append((i, prose(i, rng.randint(0, 30)) + passage + prose(-i, rng.randint(0, 30))))
    return rows


@pytest.mark.parametrize("frequent", [40, 1])
def test_against_plain_version(spark, monkeypatch, frequent):
    monkeypatch.setattr(repeats, "FREQUENT", frequent)
    rows = sample_rows()
    docs = documents(spark, rows, extra=("ord", "print", "spans", "n_bytes"))
    got = [tuple(r.values()) for r in rows_of(repeats.digest(docs))]
    assert sorted(got, key=str) == plain(rows)


def test_texts_and_spans(spark):
    text = prose(5, 80)
    got = {r["doc_id"]: r for r in rows_of(repeats.cut_repeats(documents(spark, [(1, text), (2, "!" + text)])))}
    assert bytes(got[2]["kept"]) == b"!" and got[2]["spans"] == [[1, len(text) + 1]]
    assert bytes(got[1]["kept"]) == text.encode() and got[1]["spans"] == []


def test_empty_table(spark):
    assert repeats.digest(documents(spark, [])).collect() == []


def test_long_texts_in_pieces(monkeypatch):
    raw = np.frombuffer(prose(6, 900).encode(), np.uint8)
    whole = repeats.all_runs(raw, np.array([0, len(raw)]))
    monkeypatch.setattr(repeats, "PIECE", 1000)
    cut = repeats.all_runs(raw, np.array([0, len(raw)]))
    starts = lambda r: sorted((f + k, g) for f, n, g in zip(*r[1:4]) for k in range(n))
    assert starts(whole) == starts(cut)
    assert len(starts(whole)) == len(raw) - repeats.LENGTH + 1


@settings(max_examples=60, deadline=None)
@given(st.text("ab", min_size=0, max_size=60), st.text("abc", max_size=80), st.text("abc", max_size=80))
def test_equal_windows_have_equal_anchors(middle, left, right):
    """Every window is in one run, and equal windows lie equally far from their anchor."""
    text = (left + middle * 4 + right).encode()
    raw = np.frombuffer(text, np.uint8)
    _, first, last, anchor, _, _ = runs(raw, np.array([0, len(raw)]), 20, 6)
    place = {}
    for f, e, a in zip(first, last, anchor):
        for p in range(f, e + 1):
            assert place.setdefault(text[p:p + 20], a - p) == a - p
    assert int((last - first + 1).sum()) == max(0, len(raw) - 19)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=40))
def test_previous_factor_test(items):
    suffix, position = (np.array(x) for x in zip(*items))
    order = np.argsort(suffix, kind="stable")
    same = np.r_[False, suffix[order][1:] == suffix[order][:-1]]
    got = repeats.earlier_match(order, same, position)
    want = [any(s == t and q < p for t, q in items) for s, p in items]
    assert got.tolist() == want
