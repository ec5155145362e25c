from __future__ import annotations

import hashlib
from collections import defaultdict

from ticketmill.llm import lines

from .frames_for import AWKWARD, LOWER, documents, prose, rows_of

SHARED = "This very line is in several documents"
ROWS = [*AWKWARD, *((i, f"{prose(i, 20)}\n{SHARED}\nown line number {i} is long enough") for i in range(6)),
        (6, f"  {SHARED.upper()}\t\n{SHARED}"), (6, f"{SHARED}\nsame id, other text, also cleaned"),
        (7, "Only twice found, so it stays put\nÀ line with ACCENTS kept apart"),
        (8, "only twice found, so it stays put\nà line with accents kept apart"),
        (9, "À line with accents kept apart"), (10, f"{SHARED}\n{SHARED}\n"), (11, "short\nshort"),
        (12, "short"), (13, "short")]


def plain(rows):
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        all_lines = (text or "").split("\n")
        ids = [[d for d in holders.get(key(x), ()) if d is not None] for x in all_lines]
        kept = [x for x, h in zip(all_lines, ids) if not (len(h) >= 3 and doc_id != max(h))]
        out.append((doc_id, len(all_lines), len(all_lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_plain_version(spark):
    docs = documents(spark, ROWS, extra=("line", "key", "gone", "pos", "n_lines", "LINES"))
    got = [tuple(r.values()) for r in rows_of(lines.digest(docs))]
    assert sorted(got, key=str) == plain(ROWS)


def test_other_columns_pass_and_empty_table(spark):
    docs = documents(spark, [], extra=("owner",))
    out = lines.drop_shared_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    assert out.collect() == []


def test_only_built_in_operators(spark):
    plan = lines.digest(documents(spark, ROWS[:3]))._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct"))
