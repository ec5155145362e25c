"""Licence scans: a trained classifier of paragraphs, confirmed against licence templates."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketmill.llm.batches import BASE, U64, Rolling, flat, mixed, per_slice, words
from ticketmill.llm.frames import pick

#: Wording by which licence families are known, one paragraph or notice each.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "This project is licensed under the terms of the MIT license, see the LICENSE file.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
        "In no event shall the authors or copyright holders be liable for any claim, damages or "
        "other liability, whether in an action of contract, tort or otherwise, arising from, out of "
        "or in connection with the Software or the use or other dealings in the Software.",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Released under the Apache 2.0 license.",
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, "
        "either express or implied.",
        "See the License for the specific language governing permissions and limitations under the "
        "License.",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "Distributed under the GNU GPL version 2.",
        "Licensed under the GPLv3.",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms "
        "of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this "
        "program.",
    ),
    "BSD": (
        "Released under the BSD license.",
        "Licensed under the 3-Clause BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    "ISC": (
        "Released under the ISC license.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    "CC0": (
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights "
        "to this work under CC0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, "
        "either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
    ),
}
#: Titles, and the identifiers that SPDX lines name. Each word of them counts.
TITLES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "Apache-2.0": ("Apache License", "Apache License 2.0", "Apache License, Version 2.0"),
    "GPL": ("GNU General Public License", "GNU GPL", "GNU GPL v3", "GPL v3", "GPL v2"),
    "LGPL": ("GNU Lesser General Public License", "GNU LGPL", "GNU LGPL v3"),
    "AGPL": ("GNU Affero General Public License", "GNU AGPL", "GNU AGPL v3"),
    "BSD": ("BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "The BSD License",
            "New BSD License", "Simplified BSD License"),
    "MPL-2.0": ("Mozilla Public License", "Mozilla Public License Version 2.0", "MPL 2.0"),
    "ISC": ("ISC License", "The ISC License"),
    "CC0": ("CC0 1.0 Universal", "Creative Commons CC0 1.0"),
    "CC-BY": ("CC BY 4.0", "CC BY 3.0"),
    "CC-BY-SA": ("CC BY-SA 4.0", "CC BY-SA 3.0"),
    "CC-BY-NC": ("CC BY-NC 4.0", "CC BY-NC 3.0"),
    "Unlicense": ("The Unlicense",),
}
SPDX: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT",), "Apache-2.0": ("Apache-2.0",), "ISC": ("ISC",), "MPL-2.0": ("MPL-2.0",),
    "GPL": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"),
    "LGPL": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "AGPL": ("AGPL-3.0-only", "AGPL-3.0-or-later"), "BSD": ("BSD-2-Clause", "BSD-3-Clause"),
    "CC0": ("CC0-1.0",), "CC-BY": ("CC-BY-4.0", "CC-BY-3.0"), "Unlicense": ("Unlicense",),
    "CC-BY-SA": ("CC-BY-SA-4.0", "CC-BY-SA-3.0"), "CC-BY-NC": ("CC-BY-NC-4.0", "CC-BY-NC-3.0"),
}
SPDX_LINE = "SPDX-License-Identifier:"
#: Wording about licences that grants none; taught as unknown.
OTHER = (
    "All rights reserved.", "See the license agreement for details.",
    "A licence is required to drive a car.", "The driver's license was renewed by the office.",
    "This product is licensed to the buyer under a commercial agreement.",
    "Public notice of the general version of the terms.", "He was released under the new law.",
    "The work of the Massachusetts institute was free of charge to any person.",
    "Copyright holders may license their work under the terms they choose.",
    "Please read the terms of service before use.", "The software is provided for a fee.",
    f"{SPDX_LINE} EPL-2.0", f"{SPDX_LINE} LicenseRef-Proprietary", f"{SPDX_LINE} Zlib",
    "License", "Licence terms", "License Agreement", "Driver License", "Public License",
)
UNKNOWN = "unknown"
FAMILIES = (UNKNOWN, *TEMPLATES)
#: Slots of the hashed features, and documents whose paragraphs are taught as unknown, at most.
SLOTS, BACKGROUND = 1 << 13, 1_000
#: Least probability of a family, and least share of a template's word triples that a paragraph
#: must hold, or of a paragraph's that the template must hold.
SURE, ALIKE = 0.5, 0.5

# lower case; all but letters, digits and newlines is space
FOLDED = np.full(256, 0x20, np.uint8)
for _b in [*range(48, 58), *range(97, 123), *range(128, 256), 10]:
    FOLDED[_b] = _b
FOLDED[65:91] = np.arange(97, 123)


class Paragraphs:
    """The lines of all rows of a batch that hold a word: features and places."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        self.raw = raw
        folded = FOLDED[raw]
        newline = np.flatnonzero(raw == 10)
        start = np.sort(np.concatenate([offsets[:-1], newline + 1]), kind="stable")
        end = np.sort(np.concatenate([offsets[1:], newline]), kind="stable")
        row = np.repeat(np.arange(len(offsets) - 1), np.concatenate(
            [[0], np.cumsum(raw == 10)])[offsets[1:]] - np.concatenate(
            [[0], np.cumsum(raw == 10)])[offsets[:-1]] + 1)
        w_start, w_end, _ = words(folded, offsets)
        first, last = np.searchsorted(w_start, start), np.searchsorted(w_start, end)
        full = last > first
        self.row, self.start, self.end = row[full], start[full], end[full]
        self.first, self.last = first[full], last[full]
        self.hashes = Rolling(folded).of(w_start, w_end)

    def slots(self) -> tuple[np.ndarray, np.ndarray]:
        """Feature slots of single words and of pairs inside a paragraph (-1: none), by word."""
        h = self.hashes
        pairs = np.full(len(h), -1, np.int64)
        if len(h) > 1:
            pairs[:-1] = (mixed(h[:-1] * BASE + h[1:]) % U64(SLOTS)).astype(np.int64)
        pairs[self.last - 1] = -1
        return (mixed(h + U64(1)) % U64(SLOTS)).astype(np.int64), pairs

    def triples(self, i: int) -> set[int]:
        h = self.hashes[self.first[i]:self.last[i]]
        n = min(3, len(h))
        return {tuple(h[k:k + n].tolist()) for k in range(len(h) - n + 1)}


def _of_texts(texts: list[str]) -> Paragraphs:
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return Paragraphs(raw, np.cumsum([0, *(len(t.encode()) for t in texts)]))


class Classifier:
    """Multinomial logistic regression over averaged one- and two-word features, with a
    temperature fitted on held-out paragraphs so that its probabilities can be trusted."""

    def __init__(self, weights: np.ndarray, temperature: float = 1.0):
        self.weights, self.temperature = weights, temperature

    def probabilities(self, p: Paragraphs) -> np.ndarray:
        one, two = p.slots()
        # row SLOTS is the intercept; the last row is zero and stands for "no pair"
        gathered = self.weights[one] + self.weights[two]
        count = 2.0 * (p.last - p.first) - 1
        total = np.add.reduceat(gathered, p.first, axis=0) if len(p.first) else gathered[:0]
        z = (total / np.sqrt(count)[:, None] + self.weights[-2]) / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True)) if len(z) else z
        return z / z.sum(axis=1, keepdims=True)


def _dense(p: Paragraphs) -> np.ndarray:
    one, two = p.slots()
    x = np.zeros((len(p.first), SLOTS + 1), np.float32)
    for i, (a, b) in enumerate(zip(p.first, p.last)):
        slots = np.concatenate([one[a:b], two[a:b - 1]])
        np.add.at(x[i], slots, 1 / np.sqrt(len(slots)))
        x[i, SLOTS] = 1
    return x


def _short() -> dict[str, list[str]]:
    """Titles, and lines with an SPDX identifier, of each family."""
    return {f: [*TITLES[f], *(f"{SPDX_LINE} {x}" for x in SPDX[f])] for f in TEMPLATES}


def _examples(background: list[str]) -> tuple[list[str], np.ndarray]:
    """Templates and their seeded variants (words lost, cut ends, words of the corpus around),
    the background, and mixed-up wording that must stay unknown."""
    rng = np.random.default_rng(9)
    plain = [w for t in background[:400] for w in t.split()] or ["and", "of", "with"]
    texts, labels = [], []

    def put(text: str, label: str) -> None:
        texts.append(text.replace("\n", " ") or "-")
        labels.append(FAMILIES.index(label))

    for family, templates in TEMPLATES.items():
        for t in templates:
            words_ = t.split()
            for k in range(24):
                kept = [w for w in words_ if k < 6 or rng.random() > 0.08]
                extra = [str(x) for x in rng.choice(plain, rng.integers(0, 9))] if k % 2 else []
                put(" ".join(extra + kept if k % 4 == 1 else kept + extra), family)
    for family, own in _short().items():
        for t in own:
            for k in range(12):
                extra = [str(x) for x in rng.choice(plain, k % 3)]
                put(" ".join([*extra, t] if k % 2 else [t, *extra]), family)
    vocabulary = [w for ts in TEMPLATES.values() for t in ts for w in t.split()]
    for t in OTHER:
        for _ in range(8):
            put(t + " " + " ".join(map(str, rng.choice(plain, rng.integers(0, 9)))), UNKNOWN)
    for _ in range(150):
        put(" ".join(map(str, rng.permutation(np.concatenate([
            rng.choice(vocabulary, 3), rng.choice(plain, 12)])))), UNKNOWN)
    for t in background:
        put(t, UNKNOWN)
    return texts, np.array(labels)


def fit(background: list[str], rounds: int = 150) -> Classifier:
    """Full-batch gradient descent with momentum; every fifth example is held out and only
    decides the temperature."""
    texts, y = _examples(background)
    x = _dense(_of_texts([t + "\n" for t in texts]))
    used = np.flatnonzero((x[:, :SLOTS] != 0).any(axis=0))
    part = np.concatenate([used, [SLOTS]])
    xs = x[:, part]
    held = np.arange(len(y)) % 5 == 4
    share = 1 / np.maximum(1, np.bincount(y[~held], minlength=len(FAMILIES)))
    weight = share[y[~held]] / len(FAMILIES)
    w = np.zeros((len(part), len(FAMILIES)), np.float32)
    speed = np.zeros_like(w)
    a, truth = xs[~held], np.eye(len(FAMILIES), dtype=np.float32)[y[~held]]
    for _ in range(rounds):
        z = a @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        grad = a.T @ ((p - truth) * weight[:, None].astype(np.float32)) + 1e-5 * w
        speed = 0.9 * speed - 20.0 * grad
        w += speed
    full = np.zeros((SLOTS + 2, len(FAMILIES)), np.float32)
    full[used], full[SLOTS] = w[:-1], w[-1]
    z = xs[held] @ w

    def loss(t: float) -> float:
        s = z / t - (z / t).max(axis=1, keepdims=True)
        return float(-(s[np.arange(len(s)), y[held]] - np.log(np.exp(s).sum(axis=1))).mean())

    return Classifier(full, min((0.25 * 1.25**i for i in range(16)), key=loss))


@lru_cache(maxsize=1)
def _template_triples() -> dict[str, list[set]]:
    """Word triples of each template; the one word or pair of a shorter one."""
    prefix = _of_texts([SPDX_LINE + "\n"]).triples(0)  # found before any identifier: confirms none
    out = {}
    for family, templates in TEMPLATES.items():
        p = _of_texts([t + "\n" for t in [*templates, *_short()[family]]])
        out[family] = [p.triples(i) - prefix for i in range(len(p.first))]
    return out


def _alike(triples: set, family: str) -> float:
    """Share of the smaller side that the other holds. A paragraph of one or two words is held
    against titles of as many words only, as it has no triple."""
    n = len(next(iter(triples)))
    return max((len(triples & t) / min(len(t), len(triples)) for t in _template_triples()[family]
                if len(next(iter(t))) == n), default=0.0)


def background(docs: DataFrame, most: int = BACKGROUND) -> list[str]:
    """Paragraphs that name no licence or copyright: of ``most`` documents, three times ``most``
    paragraphs, each the first by a hash."""
    slim = pick(docs, "doc_id", "text")
    ids = slim.select("doc_id").orderBy(F.xxhash64(F.lit(9), "doc_id"), "doc_id").limit(most)
    lines = slim.join(F.broadcast(ids.distinct()), "doc_id").select(
        F.explode(F.split("text", "\n")).alias("line")).where(
        F.col("line").rlike(r"\w") & ~F.lower("line").rlike("licen[cs]|copyright|public domain"))
    return [r[0] for r in lines.orderBy(F.xxhash64(F.lit(9), "line"), "line").limit(
        3 * most).collect()]


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, families (array, sorted), best (probability of the surest one, null
    without any) and licences (array of family, start and end byte of the paragraph,
    probability and likeness), one row per row of ``docs``.

    A paragraph is a line that holds a word. It is put to a family if the classifier is sure and
    a template of that family confirms it; else it is unknown and not listed. Null, empty and
    wordless texts have no paragraphs. Whole texts are scanned; repeated rows and null doc_ids
    stand for themselves; other columns are not read. Texts of at most BACKGROUND documents teach
    the unknown class.
    """
    slim = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    classifier = fit(background(docs))

    def work(batch: pa.RecordBatch) -> dict:
        raw, offsets = flat(batch.column("text"))
        p = Paragraphs(raw, offsets)
        probability = classifier.probabilities(p)
        named = probability.argmax(axis=1) if len(probability) else np.zeros(0, int)
        found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        for i in np.flatnonzero((named > 0) & (probability.max(axis=1, initial=0) >= SURE)):
            family, row = FAMILIES[named[i]], int(p.row[i])
            like = _alike(p.triples(i), family)
            if like >= ALIKE:
                found[row].append({
                    "family": family, "start": int(p.start[i] - offsets[row]),
                    "end": int(p.end[i] - offsets[row]),
                    "probability": float(probability[i, named[i]]), "likeness": float(like)})
        kind = pa.struct([("family", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                          ("probability", pa.float64()), ("likeness", pa.float64())])
        return {
            "doc_id": batch.column("doc_id"),
            "n_paragraphs": np.bincount(p.row, minlength=batch.num_rows).astype(np.int64),
            "families": pa.array([sorted({x["family"] for x in f}) for f in found],
                                 pa.list_(pa.string())),
            "best": pa.array([max((x["probability"] for x in f), default=None) for f in found],
                             pa.float64()),
            "licences": pa.array(found, pa.list_(kind)),
        }

    return per_slice(slim, work, "doc_id bigint, n_paragraphs bigint, families array<string>, "
                                 "best double, licences array<struct<family:string,start:bigint,"
                                 "end:bigint,probability:double,likeness:double>>")
