from __future__ import annotations

import hashlib

import numpy as np
import pytest

from ticketmill.llm import pieces

from .frames_for import AWKWARD, documents, prose, rows_of


def test_encoding_matches_the_library(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rows = [*AWKWARD, (1, prose(1, 400)), (1, "a  b▁c </s> <0x0A>  "), (2, "x" * 50_000),
            (3, "😀 é日本 " * 300)]
    got = rows_of(pieces.encode(documents(spark, rows, extra=("ids", "n_tokens"))))
    assert len(got) == len(rows)
    want = {}
    for doc_id, text in rows:
        ids = library.encode(text or "", add_eos=True)
        want.setdefault(doc_id, []).append((text or "", ids, library.decode(ids)))
    for r in got:
        text, ids, decoded = next(w for w in want[r["doc_id"]] if w[1] == r["ids"])
        raw = text.encode()
        assert r["decoded"] == decoded and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()
        # the pieces' bytes, one after the other, are the text
        assert b"".join(raw[s:e] for s, e in zip(r["starts"], r["ends"])) == raw
        assert r["n_covered"] == len(raw)


def compiled(replacements: dict[bytes, bytes]) -> bytes:
    """A compiled character map for keys of one byte after another, laid out by hand: every node
    has a block of 256 units of its own."""
    texts, place = b"", {}
    for new in replacements.values():
        place.setdefault(new, len(texts))
        texts += new + b"\0" if len(texts) == place[new] else b""
    prefixes = sorted({k[:i] for k in replacements for i in range(len(k) + 1)}, key=len)
    block = {p: 256 * (i + 1) for i, p in enumerate(prefixes)}
    at, units = {b"": 0}, np.zeros(256 * (len(prefixes) + 2), np.uint32)
    for p in prefixes:
        if p:
            at[p] = block[p[:-1]] ^ p[-1]
    for p in prefixes:
        leaf = 0x100 if p in replacements else 0
        units[at[p]] = ((at[p] ^ block[p]) << 10) | leaf | (p[-1] if p else 0)
        if leaf:
            units[block[p]] = 0x80000000 | place[replacements[p]]
    blob = units.astype("<u4").tobytes()
    return len(blob).to_bytes(4, "little") + blob + texts


MAP = {b"\xc2\xbd": b"1/2", b"ab": b"c", b"abcd": b"X", b"z": b""}


def test_compiled_map_is_read_back():
    assert pieces.character_map(compiled(MAP)) == MAP
    assert pieces.character_map(b"") == {}


@pytest.mark.parametrize("raw, text, places", [
    (b"abcd", b"\xe2\x96\x81X", [0, 0, 0, 0, 4]),
    (b"abce", b"\xe2\x96\x81cce", [0, 0, 0, 0, 2, 3, 4]),
    (b"1\xc2\xbdz2", b"\xe2\x96\x8111/22", [0, 0, 0, 0, 1, 1, 1, 4, 5]),
    (b"", b"", [0]),
])
def test_longest_prefix_wins_and_places_are_kept(raw, text, places):
    made, got = pieces.Normaliser(MAP)(raw)
    assert made == text and got.tolist() == places


def test_empty_table(spark):
    assert pieces.digest(documents(spark, [])).collect() == []
