"""SentencePiece encoding that keeps every piece's place in the original bytes, and decoding.

Normalising walks the text once: at each place the longest source string of the model's compiled
character map is replaced, everything else stands, spaces become the model's space mark, and a
leading mark is added. Each byte made remembers the source byte it came from, so the byte range
of every piece in the normalised text is projected to the original bytes.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import per_slice
from ticketmill.llm.frames import pick

MODEL = "piece_bpe_32k.model"
MARK = "▁".encode()
#: Bytes of text whose ids are held as Python objects at one time.
BATCH_BYTES = 1 << 18


def character_map(blob: bytes) -> dict[bytes, bytes]:
    """The replacements in a compiled character map: a little-endian length, a double-array
    trie of that many bytes, then the null-ended replacements its leaves point to."""
    if not blob:
        return {}
    size = int.from_bytes(blob[:4], "little")
    units, texts = np.frombuffer(blob[4:4 + size], "<u4").tolist(), blob[4 + size:]
    found: dict[bytes, bytes] = {}

    def child(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    waiting = [(child(units[0]), b"")]
    while waiting:
        node, prefix = waiting.pop()
        for byte in range(1, 256):
            at = node ^ byte
            if at >= len(units) or units[at] & 0x800000FF != byte:
                continue
            unit, key = units[at], prefix + bytes([byte])
            below = at ^ child(unit)
            if unit & 0x100:
                start = units[below] & 0x7FFFFFFF
                found[key] = texts[start:texts.index(b"\0", start)]
            waiting.append((below, key))
    return found


class Normaliser:
    def __init__(self, replacements: dict[bytes, bytes], dummy_prefix: bool = True):
        self.replacements = replacements
        self.prefix = MARK if dummy_prefix else b""
        self.longest = max(map(len, replacements), default=0)
        firsts = b"".join(re.escape(bytes([b])) for b in sorted({k[0] for k in replacements}))
        self.starts = re.compile(b"[" + firsts + b"]") if firsts else None

    def _replaced(self, raw: bytes) -> list[tuple[int, int, bytes]]:
        """(start, end, new bytes) of every longest match, from left to right."""
        out, at = [], 0
        while self.starts and (hit := self.starts.search(raw, at)):
            at = hit.start()
            for n in range(min(self.longest, len(raw) - at), 0, -1):
                if (new := self.replacements.get(raw[at:at + n])) is not None:
                    out.append((at, at + n, new))
                    at += n
                    break
            else:
                at += 1
                while at < len(raw) and raw[at] & 0xC0 == 0x80:  # to the next code point
                    at += 1
        return out

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The normalised bytes, and for each of them (and the end) its place in ``raw``."""
        if not raw:
            return b"", np.zeros(1, np.int32)
        made, places, at = [], [], 0
        for start, end, new in [*self._replaced(raw), (len(raw), len(raw), b"")]:
            made += [raw[at:start], new]
            places += [np.arange(at, start, dtype=np.int32), np.full(len(new), start, np.int32)]
            at = end
        text, place = b"".join(made), np.concatenate(places)
        spaces = np.frombuffer(text, np.uint8) == 0x20
        place = np.repeat(place, np.where(spaces, len(MARK), 1))
        place = np.concatenate([np.zeros(len(self.prefix), np.int32), place,
                                np.full(1, len(raw), np.int32)])
        return self.prefix + text.replace(b" ", MARK), place


class Pieces:
    """A model in a task: ids with their byte ranges."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.remove_extra_whitespaces or not proto.trainer_spec.byte_fallback:
            raise ValueError("models that collapse spaces or have no byte pieces aren't supported")
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.normalise = Normaliser(character_map(spec.precompiled_charsmap), spec.add_dummy_prefix)
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        size = {kinds.CONTROL: 0, kinds.BYTE: 1}
        self.sizes = np.array([size.get(p.type, len(p.piece.encode())) for p in proto.pieces],
                              np.int64)
        self.decimal = [str(i) for i in range(len(proto.pieces))]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, add_eos=True, num_threads=1)

    def spans(self, raw: bytes, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each id's bytes in ``raw``; the end id is empty, at the end."""
        ends = np.cumsum(self.sizes[ids])
        normal, place = self.normalise(raw)
        if ends[-1] != len(normal):
            raise ValueError("pieces and normalised text differ in length")
        return place[np.concatenate([[0], ends[:-1]])], place[ends]


@lru_cache(maxsize=2)
def model(path: str | None) -> Pieces:
    """The model at ``path``, or the default vocabulary as installed on this executor."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    return Pieces(path)


def encode(docs: DataFrame, path: str | None = None,
           parts: tuple[str, ...] = ("ids", "starts", "ends", "decoded")) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by a space),
    decoded_sha256 (of the text that the ids decode to), n_covered (bytes of the text inside
    some piece), and of ``parts`` those named: ids, starts and ends (byte range of each piece in the
    UTF-8 text) and decoded.

    ``path`` names a model file that every executor can read. Null or empty text is the end id
    alone. Texts are encoded whole, one by one, so their length never changes the result. Ties,
    repeated rows and null doc_ids need no rule: each row stands for itself. Other columns are
    not read. Raises ValueError for models whose normaliser also collapses spaces.
    """
    schema = ("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, "
              "n_covered bigint")
    schema += "".join(f", {p} {'string' if p == 'decoded' else 'array<int>'}" for p in parts)

    def work(batch: pa.RecordBatch) -> dict:
        pieces = model(path)
        texts = batch.column("text").to_pylist()
        out: dict[str, list] = {k: [] for k in (
            "n_tokens", "ids_sha256", "decoded_sha256", "n_covered", "ids", "starts", "ends",
            "decoded")}
        all_ids = pieces.encode(texts)
        for text, ids, decoded in zip(texts, all_ids, pieces.model.decode(all_ids)):
            starts, ends = pieces.spans(text.encode(), ids)
            out["n_tokens"].append(len(ids))
            joined = " ".join([pieces.decimal[i] for i in ids])
            out["ids_sha256"].append(hashlib.sha256(joined.encode()).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
            out["n_covered"].append(int((ends - starts).sum()))
            for name, part in (("ids", ids), ("starts", starts), ("ends", ends),
                               ("decoded", decoded)):
                if name in parts:
                    out[name].append(part)
        made = {"doc_id": batch.column("doc_id"), **{
            k: pa.array(v, pa.int64() if k.startswith("n_") else pa.string())
            for k, v in out.items() if k not in ("ids", "starts", "ends")}}
        for k in ("ids", "starts", "ends"):
            counts = np.cumsum([0, *map(len, out[k])]).astype(np.int32)
            values = np.concatenate([np.zeros(0, np.int32), *(np.asarray(x, np.int32) for x in out[k])])
            made[k] = pa.ListArray.from_arrays(pa.array(counts), pa.array(values))
        return made

    slim = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"))
    return per_slice(slim, work, schema, most=BATCH_BYTES)


def digest(docs: DataFrame) -> DataFrame:
    return encode(docs, parts=())
