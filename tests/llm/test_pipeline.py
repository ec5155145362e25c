"""The stages one after the other on a small corpus, each held against its own input."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

import corpus_pipeline
from ticketmill.llm import pieces, toxicity
from ticketmill.llm.frames import written

from . import test_minhash, test_mixing
from .frames_for import AWKWARD, LOWER, WORDS, documents, edited, prose, rows_of

NAMES = ["toxicity", "line_dedup", "near_dedup", "source_mix", "sentencepiece"]


def test_stages(spark, tmp_path):
    rows = [(i, prose(i, 60), f"s{i % 3}") for i in range(80)]
    rows = [(d, f"{t} plonker" if d % 4 == 0 else t, s) for d, t, s in rows]
    shared = "One and the same line in all of these"
    rows += [(100 + i, f"{prose(500 + i, 40)}\n{shared}", "s0") for i in range(4)]
    rows += [(200, "first " + prose(900, 200), "s1"), (210, prose(900, 200), "s1")]
    rows += AWKWARD
    docs = documents(spark, rows, extra=("score", "n_lines"))
    pq.write_table(pa.table({
        "doc_id": pa.array(range(80), pa.int64()), "quality": pa.array([1] * 80, pa.int32()),
        "toxic": pa.array([int(i % 4 == 0) for i in range(80)], pa.int32())}), tmp_path / "labels.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "sentencepiece":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
        ids[name] = rows_of(docs)
    toxic = {i for i in range(80) if i % 4 == 0}
    assert {r["doc_id"] for r in ids["toxicity"]} == {r[0] for r in rows} - toxic
    cleaned = {r["doc_id"]: r["text"] for r in ids["line_dedup"]}
    assert all((shared in cleaned[100 + i]) == (i == 3) for i in range(4))
    kept = {r["doc_id"] for r in ids["near_dedup"]}
    assert {200, 210} & kept == {200} and {r["doc_id"] for r in ids["toxicity"]} - kept == {210}
    assert {r["doc_id"] for r in ids["source_mix"]} <= kept
    assert len(ids["sentencepiece"]) == len(ids["source_mix"])
    assert all(r["n_tokens"] == len(r["ids"]) and r["ids"][-1] == 2 for r in ids["sentencepiece"])


def test_toxic_documents_go_and_all_others_stay(spark):
    model = toxicity.Model(toxicity.Lexicon({"plonker": 6.0}), np.array([1.0, 1.0, -3.0]))
    assert (model.scores(["you plonker", "clean", ""]) >= 0.5).tolist() == [True, False, False]


# --- each stage against a plain version of it, on what the stage before it kept ------------

def labels_file(folder, rows):
    pq.write_table(pa.table({
        "doc_id": pa.array([r[0] for r in rows], pa.int64()), "quality": pa.array([1] * len(rows), pa.int32()),
        "toxic": pa.array([r[1] for r in rows], pa.int32())}), folder / "labels.parquet")


def by_id(rows):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in rows)


def cleaned(rows):
    """The texts that line dedup leaves, by the rule."""
    def key(line):
        return line.strip(" \t\n\x0b\f\r").translate(LOWER)

    holders = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20 and doc_id is not None:
                holders.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        kept = [x for x in (text or "").split("\n")
                if len(holders.get(key(x), ())) < 3 or doc_id == max(holders[key(x)])]
        out.append((doc_id, "\n".join(kept)))
    return out


def test_stages_against_plain_versions(spark, tmp_path):
    import public_tokenizers
    import sentencepiece

    rows = [(i, prose(i, 60) + (" plonker" if i % 4 == 0 else ""), f"s{i % 3}") for i in range(80)]
    shared = "One and the same line in all of these"
    rows += [(100 + i, f"{prose(500 + i, 40)}\n{shared}\n{shared}", "s0") for i in range(5)]
    rows += [(200 + i, edited(prose(900, 150), i, 0.012), "s1") for i in range(25)] + [(230, prose(900, 150), None)]
    rows += AWKWARD + [(91, "a second row of one id")]
    labels_file(tmp_path, [(i, int(i % 4 == 0)) for i in range(80)])
    docs, frames = documents(spark, rows, extra=("score", "n_lines", "kept", "TEXT")), {}
    for name, stage in corpus_pipeline.STAGES:
        before = rows_of(docs)
        docs = written(stage(spark, docs, str(tmp_path)), f"test-{name}")
        frames[name] = before, rows_of(docs)

    before, after = frames["toxicity"]
    model = toxicity.train(documents(spark, rows), spark.read.parquet(str(tmp_path / "labels.parquet")))
    clean = [r for r in before if model.scores([r["text"] or ""])[0] < 0.5]
    assert by_id(after) == by_id(clean) and len(clean) < len(before)

    before, after = frames["line_dedup"]
    want = cleaned([(r["doc_id"], r["text"]) for r in before])
    assert by_id(after) == sorted((d if d is not None else -1, t) for d, t in want)
    assert all(r["n_chars"] == len(r["text"]) for r in after) and sum(shared in r["text"] for r in after) == 1

    before, after = frames["near_dedup"]
    verdict = test_minhash.plain([(r["doc_id"], r["text"]) for r in before], size=5)
    kept = {d for d, _, _, keep in verdict if keep}
    assert by_id(after) == by_id([r for r in before if r["doc_id"] in kept]) and 0 < len(after) < len(before)

    before, after = frames["source_mix"]
    sizes = Counter()
    for r in before:
        sizes[r["source"]] += len(WORDS.findall(r["text"] or ""))
    targets, taken, largest = test_mixing.plain_targets(dict(sizes)), Counter(), Counter()
    for r in before:
        largest[r["source"]] = max(largest[r["source"]], len(WORDS.findall(r["text"] or "")))
    for r in after:
        taken[r["source"]] += len(WORDS.findall(r["text"] or ""))
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 + 1e-6 for s in sizes)
    assert set(by_id(after)) <= set(by_id(before)) and max(Counter(by_id(after)).values()) <= 3

    before, after = frames["sentencepiece"]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted(str((r["doc_id"], list(r["ids"]))) for r in after) == sorted(
        str((r["doc_id"], library.encode(r["text"] or "", add_eos=True))) for r in before)


def test_run_on_nothing_and_on_little(spark, tmp_path):
    def run(rows, labelled):
        labels_file(tmp_path, labelled)
        pq.write_table(documents(spark, rows, extra=("score", "gone")).toArrow(), tmp_path / "documents.parquet")
        return rows_of(corpus_pipeline.run(spark, str(tmp_path)))

    assert run([], []) == []
    assert run([], [(1, 1)]) == []
    got = run([(1, None), (2, ""), (3, "some words"), (3, "some words"), (None, "no id")], [])
    # nothing was learned to be toxic, an id's rows are one node, and small sources may be taken again
    assert {r["doc_id"] for r in got} <= {1, 2, 3, None} and {3, None} <= {r["doc_id"] for r in got}
    assert all(r["n_tokens"] == len(r["ids"]) for r in got)
    long = "word " * 60_000
    assert {r["n_tokens"] for r in run([(1, long), (2, "x")], [(7, 0)]) if r["doc_id"] == 1} == {
        len(pieces.model(None).encode([long])[0])}
