"""Licence scan: a trained paragraph classifier, confirmed against templates.

A text's units are its lines, and its paragraphs of several lines joined (a
blank line ends a paragraph), as licence texts are mostly wrapped. Case,
punctuation and comment marks are taken off. Units of many words are taken in
overlapping windows of two sizes (WINDOWS), for notices and for names inside
other text, so no text is cut off; a window's first BEFORE words are seen by the
classifier, as a negation may stand there, but not compared with templates,
unless the unit begins there. A sparse logistic
regression over hashed word n-grams (one to three words) names a licence family
or ``unknown``. It is trained on the names, identifiers and notices below in
customary and in negated wording, against a bounded sample of the corpus' own
lines as the unknown class (of the SAMPLE_DOCS texts of smallest id hash as many
as fit into SAMPLE_CHARS characters together, whole). Its probabilities are
calibrated by temperature on wordings, names and notices that it was not trained
on, so that the unknown class answers for wordings that are new to it.

A window counts where the classifier finds unknown less likely than not. Then,
by falling probability, those of its families count (down to LEAST) that a
template confirms: a template's word pairs are found again in the unit, all of a
short one's (fewer than SHORT), CONFIRM of a longer one's. Templates confirm
predictions; they make none. A confirmed unit's score is its family's calibrated
probability; a text's families are those of its units, with the largest score.

A name alone inside a long line of other prose is a small part of its window and
may stay unknown; on a line or in a paragraph of its own it is found.

Defined cases: null, empty and blank texts have no paragraph and no licence;
rows are independent, null and repeated ids are kept; families of equal
probability go by name; an empty corpus trains on templates alone, an empty
table gives an empty table; further columns are left behind. A text is held
whole by one worker.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxatlas.llm import text as tx
from rxatlas.llm.common import bounded_sample, columns

U = np.uint64
#: Customary names, identifiers and notices of licences, by family.
NAMES = {
    "agpl": ["GNU Affero General Public License", "GNU AGPL", "AGPLv3", "Affero General Public License version 3"],
    "all-rights-reserved": [],
    "apache": ["Apache License, Version 2.0", "Apache License", "Apache 2.0 license", "Apache Software License"],
    "artistic": ["Artistic License 2.0", "Artistic License", "Perl Artistic License"],
    "boost": ["Boost Software License, Version 1.0", "Boost Software License", "Boost License"],
    "bsd": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "New BSD License", "Simplified BSD License", "Modified BSD License", "3-clause BSD license"],
    "cc-by": ["CC BY 4.0", "CC BY 3.0", "CC-BY license", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution License"],
    "cc-by-nc": ["CC BY-NC 4.0", "CC BY-NC 3.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                 "Creative Commons Attribution-NonCommercial License"],
    "cc-by-sa": ["CC BY-SA 4.0", "CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
                 "Creative Commons Attribution-ShareAlike License"],
    "eclipse": ["Eclipse Public License", "Eclipse Public License 2.0", "Eclipse Public License v1.0"],
    "gpl": ["GNU General Public License", "GNU GPL", "GPLv3", "GPLv2", "GNU General Public License, version 3", "GNU General Public License version 2", "GPL license"],
    "isc": ["ISC License", "ISC licence"],
    "lgpl": ["GNU Lesser General Public License", "GNU LGPL", "LGPLv3", "LGPLv2.1", "GNU Library General Public License",
             "GNU Lesser General Public License, version 2.1"],
    "mit": ["MIT License", "MIT licence", "MIT/Expat license", "Expat License", "X11 License"],
    "mpl": ["Mozilla Public License", "Mozilla Public License, v. 2.0", "MPL 2.0", "Mozilla Public License Version 2.0"],
    "public-domain": ["CC0 1.0 Universal", "Creative Commons Zero", "CC0 license", "Unlicense"],
    "zlib": ["zlib License", "zlib/libpng License"],
}
IDENTIFIERS = {
    "agpl": ["AGPL-3.0-only", "AGPL-3.0-or-later"], "apache": ["Apache-2.0"], "artistic": ["Artistic-2.0"], "boost": ["BSL-1.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"], "cc-by": ["CC-BY-4.0"], "cc-by-nc": ["CC-BY-NC-4.0"], "cc-by-sa": ["CC-BY-SA-4.0"],
    "eclipse": ["EPL-1.0", "EPL-2.0"], "gpl": ["GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"], "isc": ["ISC"],
    "lgpl": ["LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"], "mit": ["MIT"], "mpl": ["MPL-1.1", "MPL-2.0"],
    "public-domain": ["CC0-1.0", "Unlicense"], "zlib": ["Zlib"],
}
NOTICES = {
    "agpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "all-rights-reserved": ["All rights reserved.", "Copyright (c) 2020 The Authors. All rights reserved.", "Copyright 2019 by the author, all rights reserved worldwide."],
    "apache": ["you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"],
    "artistic": ["This library is free software; you can redistribute it and/or modify it under the same terms as Perl itself."],
    "boost": ["Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license",
              "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "eclipse": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License",
                "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE"],
    "gpl": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "You should have received a copy of the GNU General Public License along with this program."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"],
    "lgpl": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/"],
    "public-domain": ["This work has been released into the public domain.", "This is free and unencumbered software released into the public domain.",
                      "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software",
             "Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software."],
}
#: Wordings around a name, around an identifier, and negated ones. Every HELD-th wording, name and notice calibrates.
WORDINGS = ["{}", "Licensed under the {}.", "Released under the {}.", "distributed under the {}", "licensed under the terms of the {}", "This work is licensed under the {}",
            "released under the terms of the {}", "This program is licensed under the {}, version 3.", "The {}", "License: {}", "made available under the {}", "Licensed under {}.",
            "is published under the {}", "This library is licensed under the {}", "subject to the terms of the {}", "this file is covered by the {}", "distributed under the terms and conditions of the {}",
            "the source code is available under {}", "you can use it under the {}", "see the {} for details", "available under the {} or a commercial license"]
ID_WORDINGS = ["SPDX-License-Identifier: {}", "License: {}", "license = \"{}\"", "Licensed under {}", "released under {}", "# SPDX-License-Identifier: {}", "SPDX-License-Identifier: {} OR Proprietary",
               "License identifier {}"]
NEGATED = [f"{n} {v} under the {{}}" for n in ("not", "is NOT", "was never", "no longer", "isn't", "cannot be") for v in ("licensed", "released", "distributed", "available", "published")]
NEGATED += ["this file is not covered by the {}", "incompatible with the {}", "unlike the {}, ours", "instead of the {}", "we decided against the {}", "the {} was rejected by the board",
            "not under the {}", "does not fall under the {}", "neither the {} nor any other license applies", "without the {}"]
#: Common words of the texts around a licence.
COMMON = "the of and to in a is was that it for on with as by at from this be are or an not you we they have has had but which their all one been were when there can more if no out so up into".split()
HELD = 5
UNKNOWN = "unknown"
FAMILIES = sorted(NAMES)
#: Words of a window and from one to the next.
WINDOWS = ((48, 24), (20, 8))
BEFORE, PIECE = 4, 20
FEATURE_BITS, GRAMS = 17, 3
SAMPLE_DOCS, SAMPLE_CHARS, VARIANTS, MOST_UNKNOWN = 300, 1_500_000, 2, 8000
#: Share of a long template's pairs, pairs from which one is long, and the least probability of a confirmed family.
CONFIRM, SHORT, LEAST = 0.75, 10, 0.2
MARKS = re.compile(r"[^\w\n]+|_+")
BLANK_LINE = re.compile(r"\n[\s_]*\n")


def plain(text: str) -> str:
    """Words and line ends alone; case is the hash's affair."""
    return MARKS.sub(" ", text)


def unit_texts(text: str) -> tuple[int, list[str]]:
    """The number of paragraphs (lines that hold a word), and the units: each
    such line, and each paragraph of several lines as one."""
    clean = plain(text)
    lines = [x for x in clean.split("\n") if x and not x.isspace()]
    joined = [p for p in BLANK_LINE.split(clean) if "\n" in p.strip()] if len(lines) > 1 else []
    return len(lines), lines + joined


def units(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    """Word hashes, windows as (begin, end, begin of what templates see) in
    them, where each text's windows begin, and its number of paragraphs."""
    split = [unit_texts(t) for t in texts]
    h, ptr = tx.words(pa.array([u for _, x in split for u in x], pa.large_string()))
    size = np.diff(ptr)
    found = []
    for window, stride in WINDOWS:
        many = np.where(size > 0, np.maximum(1, -(-(size - window) // stride) + 1), 0)
        if window < WINDOWS[0][0]:
            many[size <= window] = 0  # seen whole already
        own = np.repeat(np.arange(len(size)), many)
        k = np.arange(len(own)) - np.repeat(np.cumsum(many) - many, many)
        begin = ptr[own] + k * stride
        found.append(np.stack([begin, np.minimum(begin + window, ptr[own + 1]), begin + BEFORE * (k > 0), own], 1))
    at = np.concatenate(found)
    at = at[np.lexsort((at[:, 1], at[:, 0], at[:, 3]))]
    first = np.concatenate(([0], np.cumsum([len(x) for _, x in split]))).astype(np.int64)
    return h, at[:, :3], np.searchsorted(at[:, 3], first), [n for n, _ in split]


def features(h: np.ndarray) -> list[np.ndarray]:
    """Hashed n-grams that begin at each word."""
    out, run = [], tx.mix(h)
    for k in range(GRAMS):
        if k:
            nxt = np.zeros_like(h)
            nxt[:len(h) - k] = h[k:]
            run = tx.combine(run, nxt)
        out.append((run >> U(64 - FEATURE_BITS)).astype(np.int64))
    return out


def marks_of(h: np.ndarray) -> set[int]:
    """What templates are compared by: a sequence's word pairs; a single word is itself."""
    return set(tx.combine(h[:-1], h[1:]).tolist()) if len(h) > 1 else set(h.tolist())


def template_texts() -> dict[str, list[str]]:
    """Families' templates: names, identifiers beside a word that makes them one, and notices in pieces a window holds."""
    out = {}
    for f in FAMILIES:
        texts = list(NAMES[f])
        for i in IDENTIFIERS.get(f, []):
            texts += [f"License Identifier {i}", f"License {i}", f"under {i}"] if " " not in plain(i).strip() else [i]
        for n in NOTICES[f]:
            words = plain(n).split()
            texts += [" ".join(words[s:s + PIECE]) for s in range(0, max(1, len(words) - PIECE // 2), PIECE)]
        out[f] = texts
    return out


class Model:
    """Weights float32[GRAMS, 2**FEATURE_BITS, classes], bias and temperature; the last class is unknown."""

    def __init__(self, weights, bias, temperature):
        self.weights, self.bias, self.temperature = weights, bias, temperature
        self.templates = {f: [marks_of(tx.words(pa.array([plain(t)]))[0]) for t in x] for f, x in template_texts().items()}

    def logits(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Of the units ``at``: sums over their n-grams, by running sums."""
        out = np.empty((len(at), len(self.bias)))
        for s in range(0, len(at), 2000):
            part = at[s:s + 2000]
            low, high = part[:, 0].min(), part[:, 1].max()
            x = h[low:min(len(h), high + GRAMS)]
            for k, f in enumerate(features(x)):
                run = np.zeros((len(x) + 1, len(self.bias)))
                np.cumsum(self.weights[k][f], axis=0, out=run[1:], dtype=np.float64)
                begin = part[:, 0] - low
                end = np.maximum(begin, part[:, 1] - low - k)
                add = run[end] - run[begin]
                out[s:s + 2000] = add if k == 0 else out[s:s + 2000] + add
        return out / np.sqrt(np.maximum(at[:, 1] - at[:, 0], 1))[:, None] + self.bias

    def probabilities(self, h, at) -> np.ndarray:
        z = self.logits(h, at) / self.temperature
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def confirmed(self, family: str, own: set[int]) -> bool:
        return any(len(own & t) >= (len(t) if len(t) < SHORT else CONFIRM * len(t)) for t in self.templates[family])

    def scan(self, texts: list[str]):
        """(paragraphs, confirmed families, units without a confirmed one) of each text."""
        h, at, ptr, paragraphs = units(texts)
        found = [(n, {}, 0) for n in paragraphs]
        if len(at):
            p = self.probabilities(h, at)
            for u in np.flatnonzero(p[:, -1] < 0.5).tolist():
                doc = int(np.searchsorted(ptr, u, "right")) - 1
                words = h[at[u, 2]:at[u, 1]]
                own = marks_of(words) | set(words.tolist())
                ranked = sorted((-x, f) for x, f in zip(p[u].tolist(), FAMILIES) if x >= LEAST)
                good = {f: -x for x, f in ranked if self.confirmed(f, own)}
                n, families, other = found[doc]
                for f, x in good.items():
                    families[f] = max(families.get(f, 0.0), x)
                found[doc] = n, families, other + (not good)
        return found


def wordings() -> tuple[list[str], list[int], list[bool]]:
    """Training texts of the families and of their negations: text, class, and whether it calibrates."""
    texts, label, held = [], [], []

    def add(text, k, out):
        texts.append(text)
        label.append(k)
        held.append(out)

    for k, f in enumerate(FAMILIES):
        for frames, names in ((WORDINGS, NAMES[f]), (ID_WORDINGS, IDENTIFIERS.get(f, []))):
            for j, w in enumerate(frames):
                for i, n in enumerate(names):
                    # a wording that calibrates is new with every name, a name that does is new in every wording
                    add(w.format(n), k, j % HELD == HELD - 1 or (len(names) >= HELD and i % HELD == HELD - 1))
        for n in NOTICES[f]:
            words = plain(n).split()
            for s in range(0, max(1, len(words) - PIECE // 2), PIECE // 2):
                add(" ".join(words[s:s + 2 * PIECE]), k, False)
        for j, w in enumerate(NEGATED):
            for i, n in enumerate(NAMES[f]):
                if i == j % len(NAMES[f]) or j % 3 == i % 3:
                    add(w.format(n), len(FAMILIES), j % HELD == HELD - 1)
    return texts, label, held


def train(corpus: list[str]) -> Model:
    """Softmax regression on licence wordings against the corpus' lines."""
    rng = np.random.RandomState(10)
    lines = [x for t in corpus for x in unit_texts(t)[1]]
    own = Model(None, None, None).templates
    known = {f: [t for t in x if len(t) > 1] for f, x in own.items()}
    h, ptr = tx.words(pa.array(lines, pa.large_string()))
    every = np.array(sorted(set().union(*[t for x in known.values() for t in x])), U)
    pair = tx.combine(h[:-1], h[1:]) if len(h) > 1 else np.zeros(0, U)
    hit = np.zeros(len(h) + 1, np.int64)
    if len(pair):
        np.cumsum(np.isin(pair, every), out=hit[1:len(pair) + 1])
        hit[len(pair) + 1:] = hit[len(pair)]
    hits = hit[np.maximum(ptr[1:] - 1, ptr[:-1])] - hit[ptr[:-1]]
    unlabelled = [x for x, n in zip(lines, hits) if n < 2]  # lines that may hold a licence teach nothing
    filler = [w for p in unlabelled[:400] for w in p.split()] or ["of", "and", "the", "text"]
    base, base_label, base_held = wordings()
    texts, label, held = [], [], []

    def pad(n):  # words of the corpus and common words, the more of either by chance
        common = rng.rand()
        return [COMMON[rng.randint(len(COMMON))] if rng.rand() < common else filler[rng.randint(len(filler))] for _ in range(n)]

    for t, k, out in zip(base, base_label, base_held):
        for v in range(VARIANTS + 1):
            words = plain(t).split()
            if v and len(words) < WINDOWS[1][0]:  # inside other text, up to a short window
                n = WINDOWS[1][0] - len(words)
                left = rng.randint(0, n + 1)
                words = [*pad(left), *words, *pad(rng.randint(0, n - left + 1))]
            texts.append(" ".join(words))
            label.append(k)
            held.append(out)
    words = [w for f in FAMILIES for t in template_texts()[f] for w in plain(t).split()]
    for k in range(1500):  # licence words out of order are no licence
        texts.append(" ".join([words[rng.randint(len(words))] if rng.rand() < 0.4 * (k % 2) else x for x in pad(rng.randint(1, 20))]))
        label.append(len(FAMILIES))
        held.append(k % HELD == 0)
    for k, p in enumerate(unlabelled):
        texts.append(" ".join(p.split()))
        label.append(len(FAMILIES))
        held.append(k % HELD == 0)
    h, at, ptr, _ = units(texts)
    own = np.repeat(np.arange(len(texts)), np.diff(ptr))
    plain_from = len(texts) - len(unlabelled)
    extra = np.flatnonzero(own >= plain_from)
    gone = rng.permutation(extra)[MOST_UNKNOWN:]  # so many windows of the corpus teach what unknown is
    at, own = np.delete(at, gone, 0), np.delete(own, gone)
    y, held = np.array(label)[own], np.array(held)[own]
    classes = len(FAMILIES) + 1
    f = features(h)
    rows, cols = [], []
    for k in range(GRAMS):
        size = np.maximum(0, at[:, 1] - at[:, 0] - k)
        of = np.repeat(np.arange(len(at)), size)
        pos = at[of, 0] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)
        rows.append(of)
        cols.append(f[k][pos] + k * (1 << FEATURE_BITS))
    rows, cols = np.concatenate(rows), np.concatenate(cols)
    scale = 1 / np.sqrt(np.maximum(at[:, 1] - at[:, 0], 1))[:, None]  # the value of each of a unit's n-grams
    order = np.argsort(rows, kind="stable")
    rows, cols = rows[order], cols[order]
    used, col, seen = np.unique(cols, return_inverse=True, return_counts=True)
    keep = seen[col] > 1  # n-grams seen once say nothing about other texts
    rows, cols = rows[keep], cols[keep]
    used, col = np.unique(cols, return_inverse=True)
    full_rows, row_starts = np.unique(rows, return_index=True)
    by_col = np.argsort(col, kind="stable")
    col_rows, col_starts = rows[by_col], np.searchsorted(col[by_col], np.arange(len(used)))
    weight = (1 / np.bincount(y, minlength=classes).clip(1))[y] * ~held
    weight[y == classes - 1] *= classes  # unknown stands for everything else
    weight /= weight.sum()
    w, b = np.zeros((classes, len(used))), np.zeros(classes)
    gw, gb = np.full(w.shape, 1e-8), np.full(classes, 1e-8)
    hot = np.eye(classes)[y]

    def logits():
        z = np.zeros((len(at), classes))
        for c in range(classes):
            z[full_rows, c] = np.add.reduceat(w[c][col], row_starts)
        return z * scale + b

    for _ in range(60):  # full-batch steps scaled by each weight's own gradients
        z = logits()
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        g = (p - hot) * weight[:, None]
        part = np.ascontiguousarray((g * scale).T)
        d = np.stack([np.add.reduceat(x[col_rows], col_starts) for x in part]) + 1e-6 * w
        gw += d * d
        gb += g.sum(0) ** 2
        w -= 0.5 * d / np.sqrt(gw)
        b -= 0.1 * g.sum(0) / np.sqrt(gb)
    z, best = logits()[held], (np.inf, 1.0)
    share = (1 / np.bincount(y[held], minlength=classes).clip(1))[y[held]]
    share[y[held] == classes - 1] *= classes
    for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0) if held.any() else ():
        q = z / t
        loss = -(share * (q[np.arange(len(q)), y[held]] - q.max(1) - np.log(np.exp(q - q.max(1, keepdims=True)).sum(1)))).mean()
        best = min(best, (loss, t))
    full = np.zeros((GRAMS << FEATURE_BITS, classes), np.float32)
    full[used] = w.T
    return Model(full.reshape(GRAMS, 1 << FEATURE_BITS, classes), b, best[1])


def learn(docs: DataFrame) -> Model:
    """The model, with the unknown class from ``docs`` (doc_id, text)."""
    rows = docs.where("text is not null").select("doc_id", F.length("text").alias("size"))
    few, room = [], SAMPLE_CHARS
    for r in bounded_sample(rows, "doc_id", SAMPLE_DOCS).collect():
        if r["size"] <= room:
            few.append((r.doc_id,))
            room -= r["size"]
    few = docs.sparkSession.createDataFrame(few, "doc_id long").distinct()  # at most SAMPLE_DOCS ids
    got = docs.join(F.broadcast(few), "doc_id", "left_semi").select("doc_id", "text").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return train([x or "" for x in got.column("text").to_pylist()])


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_paragraphs, licences, licence, score, n_unconfirmed) for every
    row of ``docs`` (doc_id, text): all families found, sorted and comma-joined,
    the most probable of them (null if none) and its probability."""
    d = columns(docs, doc_id="long", text="string")
    sent = d.sparkSession.sparkContext.broadcast(learn(d))  # 30 MB, whatever the input

    def run(batches):
        for b in batches:
            for s in range(0, b.num_rows, 100):
                part = b.slice(s, 100)
                found = sent.value.scan([t or "" for t in part.column("text").to_pylist()])
                best = [min(f, key=lambda x: (-f[x], x)) if f else None for _, f, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([n for n, _, _ in found], pa.int64()), pa.array([",".join(sorted(f)) for _, f, _ in found], pa.string()),
                     pa.array(best, pa.string()), pa.array([f[k] if k else 0.0 for (_, f, _), k in zip(found, best)], pa.float64()),
                     pa.array([o for _, _, o in found], pa.int64())],
                    names=["doc_id", "n_paragraphs", "licences", "licence", "score", "n_unconfirmed"])

    return d.mapInArrow(run, "doc_id long, n_paragraphs long, licences string, licence string, score double, n_unconfirmed long")
