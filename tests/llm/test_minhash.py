from __future__ import annotations

import numpy as np
import pytest

from ticketmill.llm import graph, minhash
from ticketmill.llm.batches import mixed

from .frames_for import AWKWARD, LOWER, WORDS, documents, edited, prose, rows_of


def plain(rows, size=4):
    def shingles(text):
        words = WORDS.findall((text or "").translate(LOWER))
        n = min(size, len(words))
        return frozenset(zip(*(words[i:] for i in range(n)))) if n else frozenset()

    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(((d, len(s), None if d is None else find(d), d is None or find(d) == d)
                   for d, s in sets), key=str)


def sample_rows():
    rows = [*AWKWARD, (94, "the same id with another text"), (200, "The SAME id with another text"),
            (201, "one"), (202, "ONE")]
    rows += [(300 + i, prose(i, 120)) for i in range(8)]
    centre = prose(50, 150)  # variants of one text, near it and often not near each other
    rows += [(499, centre), *((400 + i, edited(centre, i, 0.02)) for i in range(60))]
    rows += [(500 + i, prose(60, 100)) for i in range(20)]
    chain = prose(70, 200).split()
    rows += [(600 + i, " ".join(chain[8 * i:8 * i + 120])) for i in range(9)]
    return rows


def test_against_plain_version(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)  # so that a group is spread over several blocks
    rows = sample_rows()
    docs = documents(spark, rows, extra=("a", "key", "component", "node", "kept"))
    got = [tuple(r.values()) for r in rows_of(minhash.by_four_words(docs))]
    assert sorted(got, key=str) == plain(rows)


def test_unlinked_members_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rows = [(5, i, 0 if i < 40 else 1000 + i // 2, b"") for i in range(240)] + [(6, i, 0, b"") for i in range(9)]
    placed = spark.createDataFrame(rows, "key long, doc_id long, component long, packed binary")
    made = {}
    for r in rows_of(minhash.tiles(placed)):
        made.setdefault((r["key"], r["block"]), []).append((r["doc_id"], r["side"]))
    assert max(map(len, made.values())) < 4 * 16  # two blocks, cut by hash
    met = [(min(a, b), max(a, b)) for tile in made.values() for a, s in tile for b, t in tile
           if (s, t) == (minhash.LEFT, minhash.RIGHT) or s == t == minhash.BOTH and a < b]
    assert len(met) == len(set(met))
    assert set(met) == {(a, b) for a in range(240) for b in range(max(40, a + 1), 240)}


def test_near_but_unlinked_copies_of_a_template(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    monkeypatch.setattr(minhash, "TILE", 24)
    centre = prose(80, 120)
    rows = [(i, edited(centre, 900 + i, 0.035 if i % 4 else 0.02)) for i in range(120)]
    got = [tuple(r.values()) for r in rows_of(minhash.by_four_words(documents(spark, rows)))]
    assert sorted(got, key=str) == plain(rows)
    assert 1 < len({r[2] for r in got}) < 120


def test_parities_bound_the_difference(monkeypatch):
    rng = np.random.default_rng(4)
    monkeypatch.setattr(minhash, "PARITY_PAIRS", 7)
    monkeypatch.setattr(minhash, "PARITY_BYTES", 512)
    pool = mixed(rng.integers(0, 2**63, 3000, np.uint64))
    sets = [np.unique(rng.choice(pool[:k], rng.integers(1, k))) for k in (2, 3, 40, 60, 64, 70, 300, 600, 3000) for _ in range(4)]
    sets += [np.unique(np.r_[sets[-1][:-5], pool[:4]]), sets[-1]]
    odd = minhash.Parities([minhash.parities(s) for s in sets], np.array([len(s) for s in sets]))
    a, b = (x.ravel() for x in np.indices((len(sets), len(sets))))
    for per_mille in (800, 500):
        may = odd.may_link(a, b, per_mille)
        shared = np.array([len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)])
        linked = 1000 * shared >= per_mille * (odd.n[a] + odd.n[b] - shared)
        assert may[linked].all()
        assert (may & ~linked).mean() < 0.12


def test_near_copies_below_the_threshold_propose_next_to_nothing(spark, monkeypatch):
    centre = prose(90, 300)
    rows = [(i, edited(centre, 3000 + i, 0.03)) for i in range(150)]  # similar to 0.5 to 0.75
    signatures = minhash.signed(documents(spark, rows).select("doc_id", "text"), 4)
    placed = signatures.selectExpr("1L as key", "doc_id", "doc_id as component", "packed")
    met = minhash.tiles(placed, 64).join(signatures.select("doc_id", "n_shingles", "odd"), "doc_id")
    least = minhash.least_estimate(0.8)
    pairs = minhash._candidates(met, least, 800, True).count()
    loose = minhash._candidates(met, least, 1, True).count()
    assert loose > 3000 and pairs < loose / 20


def test_empty_table_and_one_of_each(spark):
    assert minhash.near_duplicates(documents(spark, [])).collect() == []
    rows = [(1, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 60)), (4, None)]
    docs = documents(spark, rows)
    out = minhash.one_of_each(docs)
    assert out.columns == docs.columns and sorted(r["doc_id"] for r in out.collect()) == [1, 3, 4]


def test_estimates_correct_for_chance():
    rng = np.random.default_rng(1)
    for share in (0.5, 0.8, 0.95):
        pool = mixed(rng.integers(0, 2**63, 4000, np.uint64))
        n = round(3000 * 2 * share / (1 + share))
        a, b = pool[:3000 - n + n], np.concatenate([pool[3000 - n:3000], pool[3000:6000 - n]])[:3000]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        packed = [np.frombuffer(minhash._pack(minhash.signature(np.unique(x))), np.uint8) for x in (a, b)]
        assert abs(minhash.estimates(np.stack(packed))[0, 1] - true) < 0.2
    assert 0.55 < minhash.least_estimate(0.8) < 0.7


@pytest.mark.parametrize("one_task", [10, 1000])
def test_components_of_long_chains_and_stars(spark, monkeypatch, one_task):
    monkeypatch.setattr(graph, "ONE_TASK", one_task)
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (202, 201)]
    got = {r["node"]: r["component"] for r in rows_of(graph.components(
        spark.createDataFrame(links, "a long, b long")))}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 201: 201, 202: 201}
