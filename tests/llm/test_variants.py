from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from ticketmill.llm import variants

from .frames_for import AWKWARD, LOWER, documents, rows_of


def plain_vocabulary(rows, shortest=6, least=5):
    n = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= shortest and c >= least}


def one_edit(a, b):
    """By definition: some single insertion, deletion or replacement."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(rows):
    n = plain_vocabulary(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out)


def got(df):
    return sorted((tuple(r.values()) for r in rows_of(df)), key=lambda r: r[0])


def words_with_slips(seed, n_docs=60):
    """Documents of few stems, with edits of their words that are rarer, and rarer edits of those."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abcdeéÿ") for _ in range(rng.randint(6, 9))) for _ in range(12)]
    pool = []
    for stem in stems:
        pool += [stem] * 150
        for _ in range(6):
            at, c = rng.randrange(len(stem)), rng.choice("abcdeß")
            once = rng.choice([stem[:at] + stem[at + 1:], stem[:at] + c + stem[at:], stem[:at] + c + stem[at + 1:]])
            pool += [once] * rng.choice([4, 6, 25])
            at = rng.randrange(len(once))
            pool += [once[:at] + "z" + once[at:]] * rng.choice([5, 1])
    rng.shuffle(pool)
    pool = [w.upper() if rng.random() < 0.1 and "ß" not in w and "ÿ" not in w else w for w in pool]
    step = len(pool) // n_docs + 1
    return [(i, rng.choice([" ", ", ", "3", "\n"]).join(pool[i * step:(i + 1) * step])) for i in range(n_docs)]


def test_against_every_pair(spark, monkeypatch):
    rows = words_with_slips(1) + AWKWARD + [(7, "repeat repeat ab " * 3), (7, "repeat repeat ab " * 3)]
    frame = documents(spark, rows, extra=("word", "n", "TEXT"))
    want = plain(rows)
    assert any(r[1] and r[2] != r[1] for r in want) and any(r[4] > 3 for r in want)  # chains, crowds
    assert got(variants.grouped(frame)) == want
    monkeypatch.setattr(variants, "TILE", 3)  # blocks cut into many tiles
    monkeypatch.setattr(variants, "CELLS", 50)
    assert got(variants.grouped(frame)) == want


def test_one_hot_block(spark, monkeypatch):
    monkeypatch.setattr(variants, "TILE", 16)
    words = [f"prefix{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "ab"]
    rows = [(k, " ".join(words)) for k in range(6)] + [(100 + k, " ".join(["prefixaaa"] * 30)) for k in range(3)]
    assert got(variants.grouped(documents(spark, rows))) == plain(rows)


def test_ties_slips_and_nothing(spark):
    assert variants.grouped(documents(spark, [])).collect() == []
    assert variants.grouped(documents(spark, [(1, None), (2, ""), (3, "short ones")])).collect() == []
    rows = [(1, "bcdefgh " * 50 + "acdefgh " * 50 + "cdefgh " * 5)]
    made = {r[0]: r for r in got(variants.grouped(documents(spark, rows)))}
    slip = {w: n for w, n in plain_vocabulary(rows).items()}
    assert set(made) == set(slip) and made["cdefgh"][1] == "acdefgh" and made["acdefgh"][4] == 2
    # a slipping run loses the code point of its checksum, in that document alone
    doc = next(d for d in range(10_000) if zlib.crc32(f"{d}:größere".encode()) % 199 == 0)
    rows = [(doc, "größere " * 5), (doc + 1, "größere " * 5), (None, "größere " * 5)]
    assert {r[0]: r[3] for r in got(variants.grouped(documents(spark, rows)))} == plain_vocabulary(rows) | {"größere": 10}


def test_prefix_and_suffix_name_each_pair_once():
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(6, 8))) for _ in range(200)})
    block = variants.Block(words)
    x, y = (a.ravel() for a in np.meshgrid(np.arange(len(words)), np.arange(len(words)), indexing="ij"))
    hits = np.zeros(len(x), int)
    for kind in (variants.PREFIX, variants.SUFFIX, variants.ENDS):
        for most in range(6, 10):
            hits += block.near(x, y, np.full(len(x), kind), np.full(len(x), most))
    assert hits.tolist() == [int(one_edit(words[a], words[b])) for a, b in zip(x, y)]


def test_long_words(spark):
    long = "ab" * 5000
    rows = [(1, " ".join([long] * 30 + [long[:700] + "x" + long[700:]] * 5))]
    assert got(variants.grouped(documents(spark, rows))) == plain(rows)
