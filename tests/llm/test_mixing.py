from __future__ import annotations

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from ticketmill.llm import mixing

from .frames_for import AWKWARD, documents, prose, rows_of

ROWS = [*((i, prose(i, 5 + i % 90), f"s{i % 7}" if i % 5 else "hot") for i in range(300)),
        *((a, b, None) for a, b in AWKWARD), (400, "tiny", "tiny"), (401, prose(1, 900), "Z"),
        (402, "", "wordless")]


def plain_targets(sizes: dict) -> dict:
    """Clamp and share anew, one round at a time."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(3 * sizes[s] for s in capped)
        free = sum(weight[s] for s in order if s not in capped)
        target = {s: 3 * sizes[s] if s in capped else rest * weight[s] / free for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s]}
        if not over:
            return target
        capped |= over


def test_targets_and_takes(spark):
    docs = documents(spark, ROWS, extra=("draw", "of", "weight", "rest"))
    mixed = rows_of(mixing.mix(docs))
    sizes = Counter()
    for r in mixed:
        sizes[r["source"]] += r["size"]
    want = plain_targets(dict(sizes))
    assert len(mixed) == len(ROWS)
    taken = Counter()
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]] and 0 <= r["copies"] <= 3
        assert abs(r["target"] - want[r["source"]]) < 1e-6
        taken[r["source"]] += r["size"] * r["copies"]
    largest = {s: max(r["size"] for r in mixed if r["source"] == s) for s in sizes}
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1e-6
    assert abs(sum(want.values()) - sum(sizes.values())) < 1e-6

    def key(r):
        return str((r["doc_id"], r["text"], r["copies"]))

    again = rows_of(mixing.mix(docs.repartition(7)))
    assert sorted(map(key, mixed)) == sorted(map(key, again))


def test_repeated_rows_come_out_as_often_as_taken(spark):
    docs = documents(spark, ROWS[:60])
    want = sum(r["copies"] for r in rows_of(mixing.mix(docs)))
    out = mixing.repeated(docs)
    assert out.columns == docs.columns and out.count() == want


def test_empty_and_wordless(spark):
    assert mixing.shares(documents(spark, [])).collect() == []
    assert [r["taken"] for r in rows_of(mixing.shares(documents(spark, [(1, ""), (2, None)])))] == [0, 0]


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.text("abc", max_size=3), st.integers(0, 1000), min_size=1, max_size=9))
def test_plain_targets_meet_the_total(sizes):
    target = plain_targets(sizes)
    assert abs(sum(target.values()) - sum(sizes.values())) < 1e-6
