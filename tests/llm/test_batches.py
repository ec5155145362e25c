from __future__ import annotations

import numpy as np

from ticketmill.llm import batches, minhash, quality

from .frames_for import documents, rows_of


def thue_morse(n: int) -> list[int]:
    """Two texts of this kind have equal polynomial hashes modulo 2 ** 64, whatever the base."""
    return [bin(i).count("1") & 1 for i in range(n)]


ONE = "".join("ab"[b] for b in thue_morse(2048))
TWO = "".join("ba"[b] for b in thue_morse(2048))


def test_ranges_of_equal_bytes_and_no_others_agree():
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 3, 4000).astype(np.uint8)
    raw[1000:1500] = raw[3000:3500]
    rolling = batches.Rolling(raw)
    start = np.r_[np.arange(1000, 1400), np.arange(3000, 3400)]
    h = rolling.of(start, start + 100).reshape(2, -1)
    assert (h[0] == h[1]).all() and len(np.unique(h[0])) == 400
    size = rng.integers(0, 12, 3000)
    at = rng.integers(0, 3900, 3000)
    h = rolling.of(at, at + size)
    texts = [raw[a:a + n].tobytes() for a, n in zip(at, size)]
    assert len(set(texts)) == len(set(h.tolist())) == len(set(zip(texts, h.tolist())))
    assert len(batches.Rolling(raw[:0]).of(at[:0], at[:0])) == 0


def test_powers_modulo_primes():
    for prime in batches.PRIMES:
        made = batches.powers(70_000, 123_457, prime)
        assert [int(made[i]) for i in (0, 1, 2, 69_999)] == [pow(123_457, i, prime) for i in (0, 1, 2, 69_999)]


def test_texts_made_to_collide_do_not():
    both = np.frombuffer((ONE + TWO).encode(), np.uint8)
    h = [batches.Rolling(both, seed).of(np.array([0, 2048]), np.array([2048, 4096])) for seed in (1, 2, 3)]
    assert all(a != b for a, b in h)


def test_such_lines_and_words_are_told_apart(spark):
    words = " ".join(f"w{i}" for i in range(60))
    frame = documents(spark, [(1, f"{words}\n{ONE}\n{TWO}\n"), (2, f"{ONE} x {TWO} {words}"), (3, f"{TWO} x {ONE} {words}"),
                              (4, f"{ONE}"), (5, f"{TWO}")])
    rows = {r["doc_id"]: r for r in rows_of(quality.features(frame))}
    assert rows[1]["n_dup_lines"] == 0
    got = {r["doc_id"]: r["component_id"] for r in rows_of(minhash.near_duplicates(frame, 1, 0.99))}
    assert got[4] == 4 and got[5] == 5 and got[2] == got[3] == 2
