"""Anchors: places in a text, chosen by content alone, so that equal strings share them.

A window is any ``length`` bytes of one document. Its anchor is the place of the least ``gram``
hash inside it (the first one, if several are least), so equal windows have their anchor at the
same distance from their start. Neighbouring windows mostly share an anchor; a run is a maximal
range of window starts that do.
"""

from __future__ import annotations

import numpy as np

from ticketmill.llm.batches import U64, Rolling

#: Low bits of a sort key that hold the place; texts worked on at once are shorter than this.
PLACE_BITS = 26


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, from running minima of blocks both ways."""
    n = len(values)
    top = np.iinfo(values.dtype).max
    padded = np.full(-(-n // width) * width, top, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def runs(raw: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Per run: row, first and last window start, anchor (all as places in ``raw``), the hash of
    its gram, and the hash of all bytes its windows cover together with the anchor's place."""
    none = np.zeros(0, np.int64)
    if len(raw) < length:
        return none, none, none, none, none.view(U64), none.view(U64)
    rolling = Rolling(raw)
    at = np.arange(len(raw) - gram + 1)
    grams = rolling.of(at, at + gram)
    keys = (grams >> U64(PLACE_BITS) << U64(PLACE_BITS)) | at.astype(U64)
    anchor = (sliding_min(keys, length - gram + 1) & U64((1 << PLACE_BITS) - 1)).astype(np.int64)
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)[:len(anchor)]
    inside = np.arange(len(anchor)) + length <= offsets[1:][row]
    new = np.ones(len(anchor) + 1, bool)
    new[1:-1] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
    cuts = np.flatnonzero(new)
    first, last = cuts[:-1], cuts[1:] - 1
    keep = inside[first]
    first, last = first[keep], last[keep]
    a = anchor[first]
    around = rolling.of(first, last + length) ^ ((a - first).astype(U64) * U64(0xC2B2AE3D27D4EB4F))
    return row[first], first, last, a, grams[a], around
