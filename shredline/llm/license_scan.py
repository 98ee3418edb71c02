"""Licence scan of paragraphs by a trained classifier that templates confirm.

A paragraph is a line, or a notice that is wrapped over lines of a run without a blank line: the stretch of at most
``STRETCH`` times a notice's words that has most of its 2-grams. Its words are lower-cased and
stripped of edge punctuation, which takes comment marks too, and its features are the word 1-, 2- and 3-grams that the templates have.
Templates are the notices that licences publish, and what people write with their names and identifiers, made by rule from ``NAMES`` and
``FORMS``.

Multinomial logistic regression over sparse rows with an L2 penalty knows the licence families and an unknown class. A family's training rows
keep at least ``KEPT`` of a template's words, among other words; unknown rows keep at most ``LOST`` of them, mix words of several
templates, or are lines of the documents themselves, at most ``PROSE_LINES`` of them (the lowest of as many residues of a hash) that have less than
``ALIKE`` of every template's 2-grams. A held-out part of such rows calibrates one temperature for the probabilities. A prediction
of a family stands if its probability is at least ``THRESHOLD``, the paragraph has at least ``SIMILARITY`` of the word 2-grams of one of the
family's templates, which is reported, and no other family's template is nearer.

One narrow pass over the documents besides the one that samples lines; the model has the size of the templates.

Defined cases: null and empty texts and blank lines give no rows; a paragraph gives one row at most, for its likeliest
family, and a wrapped one the number of its first line; a line without words is blank; of paragraphs that overlap the one with
more of its template counts; a
probability or similarity that equals its threshold counts; repeated paragraphs and rows are each reported; lines of any length are read whole,
but only lines of at most ``LONGEST`` characters are learned from; no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shingle_hashes, slices, small_batches, table, texts
from .decontamination import PlainWords

# Names and identifiers of licences.
NAMES = {
    "mit": (["MIT License"], ["MIT"]),
    "apache-2.0": (["Apache License 2.0", "Apache License, Version 2.0"], ["Apache-2.0"]),
    "gpl": (["GNU General Public License", "GNU General Public License, version 3", "GNU GPL"], ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPLv2", "GPLv3"]),
    "lgpl": (["GNU Lesser General Public License", "GNU Lesser General Public License, version 3", "GNU LGPL"], ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "LGPLv3"]),
    "agpl": (["GNU Affero General Public License", "GNU Affero General Public License, version 3", "GNU AGPL"], ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "AGPLv3"]),
    "gfdl": (["GNU Free Documentation License"], ["GFDL-1.3", "GFDL-1.3-or-later"]),
    "bsd": (["BSD License", "BSD 3-Clause License", "BSD 2-Clause License", "New BSD License"], ["BSD", "BSD-2-Clause", "BSD-3-Clause"]),
    "isc": (["ISC License"], ["ISC"]),
    "zlib": (["zlib License"], ["Zlib"]),
    "mpl-2.0": (["Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"], ["MPL-2.0"]),
    "epl": (["Eclipse Public License 2.0", "Eclipse Public License v1.0", "EPL 2.0"], ["EPL-1.0", "EPL-2.0"]),
    "cddl": (["Common Development and Distribution License"], ["CDDL-1.0", "CDDL-1.1"]),
    "artistic": (["Artistic License 2.0", "Artistic License"], ["Artistic-2.0"]),
    "bsl-1.0": (["Boost Software License 1.0", "Boost Software License, Version 1.0"], ["BSL-1.0"]),
    "busl": (["Business Source License 1.1"], ["BUSL-1.1"]),
    "unlicense": (["Unlicense"], ["Unlicense"]),
    "wtfpl": (["Do What The Fuck You Want To Public License"], ["WTFPL"]),
    "ofl": (["SIL Open Font License, Version 1.1"], ["OFL-1.1"]),
    "ms-pl": (["Microsoft Public License"], ["MS-PL"]),
    "psf": (["Python Software Foundation License"], ["PSF-2.0", "Python-2.0"]),
    "cc-by": (["Creative Commons Attribution 4.0 International License", "CC BY 4.0"], ["CC-BY-4.0", "CC-BY-3.0"]),
    "cc-by-sa": (["Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC BY-SA 3.0"], ["CC-BY-SA-4.0", "CC-BY-SA-3.0"]),
    "cc-by-nd": (["Creative Commons Attribution-NoDerivatives 4.0 International License", "CC BY-ND 4.0"], ["CC-BY-ND-4.0"]),
    "cc-by-nc": (["Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0"], ["CC-BY-NC-4.0"]),
    "cc-by-nc-sa": (["Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "CC BY-NC-SA 4.0"], ["CC-BY-NC-SA-4.0"]),
    "cc-by-nc-nd": (["Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License", "CC BY-NC-ND 4.0"], ["CC-BY-NC-ND-4.0"]),
    "cc0": (["CC0 1.0 Universal"], ["CC0-1.0"]),
}
# Notices as their licences publish them.
PUBLISHED = {
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT",
    ],
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "gpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "agpl": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "gfdl": ["Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "zlib": ["This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "cddl": ["The contents of this file are subject to the terms of the Common Development and Distribution License"],
    "artistic": ["This is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0"],
    "bsl-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "wtfpl": ["Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed."],
    "ofl": ["This Font Software is licensed under the SIL Open Font License, Version 1.1."],
    "cc0": ["This work is dedicated to the public domain under CC0 1.0 Universal."],
    "all-rights-reserved": ["All rights reserved."],
}
#: What is written with a name, and with an identifier.
FORMS = (["Licensed under the {}.", "Released under the {}.", "This work is licensed under the {}.", "This work is licensed under a {}.", "License: {}"], ["SPDX-License-Identifier: {}", "License: {}", "Licensed under {}."])


def templates() -> dict[str, list[str]]:
    """The templates of each family, without repeats."""
    out = {family: list(texts) for family, texts in PUBLISHED.items()}
    for family, (names, ids) in NAMES.items():
        made = [form.format(x) for forms, xs in zip(FORMS, (names, ids)) for x in xs for form in forms]
        made += [form.format(x) for x in names if x.startswith("CC ") for form in ("{}", "Licensed under {}.")]
        out.setdefault(family, [])
        out[family] += [t for t in dict.fromkeys(made) if t not in out[family]]
    return out


NOTICES = templates()
FAMILIES = ["unknown", *NOTICES]
KEPT, LOST, ROWS = 0.8, 0.3, 8
#: Lines of the documents that are learned from as unknown, their most characters, and the share of a template's 2-grams from which they are not.
PROSE_LINES, LONGEST, ALIKE = 2048, 2000, 0.5
THRESHOLD, SIMILARITY, PENALTY = 0.5, 0.7, 1e-5
STRETCH = 2
FOUND = "doc_id long, paragraph int, family string, probability double, similarity double, notice string"


def word_grams(words: np.ndarray) -> np.ndarray:
    """Hashes of the 1-, 2- and 3-grams; those of different lengths differ."""
    return np.concatenate([shingle_hashes(words, k) if len(words) >= k else np.empty(0, np.uint64) for k in (1, 2, 3)])


def training_rows(rng: np.random.Generator, notices: list[tuple[int, np.ndarray]], rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Word arrays and their classes by the rule of the module's description; families of few templates have more rows of each."""
    every = np.concatenate([w for _, w in notices])
    templates_of = np.bincount([f for f, _ in notices])
    out, classes = [], []
    for family, words in notices:
        for k in range(max(rows, -(-8 * rows // templates_of[family]))):
            other = rng.choice(every, rng.integers(0, 6))
            if k % 4 != 3:
                kept = words[np.sort(rng.choice(len(words), max(1, int(np.ceil(len(words) * rng.uniform(KEPT, 1)))), replace=False))]
                out.append(np.concatenate([other, kept]) if k % 2 else np.concatenate([kept, other]))
                classes.append(family)
            elif k % 8 == 3:
                out.append(np.concatenate([other, words[: int(len(words) * rng.uniform(0, LOST))]]))
                classes.append(0)
            else:
                out.append(rng.choice(every, rng.integers(1, 20)))
                classes.append(0)
    return out, np.array(classes)


class SparseRows:
    """Rows that have features or have them not, by row and by feature."""

    def __init__(self, rows: list[np.ndarray], features: int):
        self.sizes, self.features = np.array([len(r) for r in rows]), features
        self.cols = np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64)
        row = np.repeat(np.arange(len(rows)), self.sizes)
        order = np.argsort(self.cols, kind="stable")
        self.by_col = row[order]
        self.present, self.starts = np.unique(self.cols[order], return_index=True)
        self.begin = np.cumsum(self.sizes) - self.sizes

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.sizes), w.shape[1]), w.dtype)
        some = np.flatnonzero(self.sizes)
        if len(some):
            out[some] = np.add.reduceat(w[self.cols], self.begin[some])
        return out

    def transposed_dot(self, e: np.ndarray) -> np.ndarray:
        out = np.zeros((self.features, e.shape[1]), e.dtype)
        if len(self.present):
            out[self.present] = np.add.reduceat(e[self.by_col], self.starts)
        return out


class Model:
    """``prose`` are lines of documents, most of which are no notices."""

    def __init__(self, prose: list[str] = ()) -> None:
        plain, rng = PlainWords(), np.random.default_rng(7)
        self.notices = [(FAMILIES.index(f), plain.text(t.encode()), t) for f, ts in NOTICES.items() for t in ts]
        self.grams = np.unique(np.concatenate([word_grams(w) for _, w, _ in self.notices]))
        self.pairs = [np.unique(shingle_hashes(w, 2)) for _, w, _ in self.notices]
        self.every_pair = np.unique(np.concatenate(self.pairs))
        self.has = np.stack([np.isin(self.every_pair, p) for p in self.pairs])
        self.sizes = self.has.sum(1)
        self.pair_flags = np.zeros(1 << 20, bool)
        self.pair_flags[self.every_pair >> np.uint64(44)] = True
        self.flags = np.zeros(1 << 20, bool)
        self.flags[self.grams >> np.uint64(44)] = True
        short = [(f, w) for f, w, _ in self.notices]
        unlike = [w for w in (plain.text(x.encode()) for x in prose) if len(w) and self.similarities(w).max() < ALIKE]
        rows, classes = training_rows(rng, short, ROWS)
        held, self.held_classes = training_rows(rng, short, max(1, ROWS // 4))
        cut = len(unlike) * 3 // 4
        x, y = self.matrix(rows + unlike[:cut]), np.concatenate([classes, np.zeros(cut, int)])
        self.held, self.held_classes = self.matrix(held + unlike[cut:]), np.concatenate([self.held_classes, np.zeros(len(unlike) - cut, int)])
        weights = self.fit(x, y)
        scores = self.held.dot(weights[:-1]) + weights[-1]
        losses = {t: -np.log(self.softmax(scores / t)[np.arange(len(scores)), self.held_classes] + 1e-12).mean() for t in np.linspace(0.2, 4, 39)}
        self.weights = weights / min(losses, key=losses.get)

    def similarities(self, words: np.ndarray) -> np.ndarray:
        """The share of each template's 2-grams that a text has."""
        return self.has[:, np.isin(self.every_pair, shingle_hashes(words, 2))].sum(1) / self.sizes

    def matrix(self, rows: list[np.ndarray]) -> SparseRows:
        out = []
        for words in rows:
            g = np.unique(word_grams(words))
            at = np.searchsorted(self.grams, g).clip(max=len(self.grams) - 1)
            out.append(at[self.grams[at] == g])
        return SparseRows(out, len(self.grams))

    @staticmethod
    def softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def fit(self, x: SparseRows, y: np.ndarray, steps: int = 1000, tolerance: float = 3e-3) -> np.ndarray:
        """Accelerated gradient steps on the penalised mean log loss until the gradient is ``tolerance`` of the first; the last row is
        the intercept. A step that overshoots restarts the acceleration."""
        w = v = np.zeros((x.features + 1, len(FAMILIES)), np.float32)
        target = np.eye(len(FAMILIES), dtype=np.float32)[y]
        rate = 8.0 / float(x.sizes.mean() + 1)
        first, k = None, 0
        for _ in range(steps):
            e = (self.softmax(x.dot(v[:-1]) + v[-1]) - target) / len(y)
            gradient = np.concatenate([x.transposed_dot(e), e.sum(0, keepdims=True)]) + PENALTY * v
            size = float(np.linalg.norm(gradient))
            first = size if first is None else first
            if size <= tolerance * first:
                break
            new = v - rate * gradient
            k = 0 if float((gradient * (new - w)).sum()) > 0 else k + 1
            v, w = new + k / (k + 3) * (new - w), new
        return w

    def __call__(self, lines: list[np.ndarray]) -> list[tuple[int, str, float, float, str]]:
        """(line, family, probability, similarity, notice) of the lines that are a notice."""
        sizes = np.array([len(x) for x in lines])
        flat = np.concatenate([*lines, np.empty(0, np.uint64)])
        line = np.repeat(np.arange(len(lines)), sizes)
        hits = []
        for k in (1, 2, 3):
            if len(flat) < k:
                break
            g = shingle_hashes(flat, k)
            maybe = np.flatnonzero(self.flags[g >> np.uint64(44)] & (line[: len(g)] == line[k - 1 :]))
            at = np.searchsorted(self.grams, g[maybe]).clip(max=len(self.grams) - 1)
            same = self.grams[at] == g[maybe]
            hits.append(line[maybe[same]] * len(self.grams) + at[same])
        hit = np.unique(np.concatenate([*hits, np.empty(0, np.int64)]).astype(np.int64))
        where, gram = hit // len(self.grams), hit % len(self.grams)
        found, back = np.unique(where, return_inverse=True)
        if not len(found):
            return []
        z = self.weights[-1] + np.add.reduceat(self.weights[gram], np.searchsorted(back, np.arange(len(found))))
        p = self.softmax(z)
        best = p.argmax(1)
        out = []
        for i in np.flatnonzero((best > 0) & (p[np.arange(len(p)), best] >= THRESHOLD)):
            alike = self.similarities(lines[found[i]])
            mine = [(alike[k], -k) for k, (f, _, _) in enumerate(self.notices) if f == best[i]]
            similarity, k = max(mine)
            if similarity >= SIMILARITY and similarity >= alike.max():
                out.append((int(found[i]), FAMILIES[best[i]], float(p[i, best[i]]), float(similarity), self.notices[-k][2]))
        return out

    def paragraphs(self, lines: list[np.ndarray], docs: np.ndarray) -> list[tuple[int, str, float, float, str]]:
        """As for lines, also of the notices that are wrapped over lines of a document, which count as their first line. Of lines and
        stretches that overlap the one with more 2-grams of its template counts."""
        alone = self(lines)
        sizes = np.array([len(x) for x in lines])
        used = np.flatnonzero(sizes)
        flat = np.concatenate([*(lines[i] for i in used), np.empty(0, np.uint64)])
        if len(flat) < 2:
            return alone
        runs = np.cumsum(np.concatenate([[True], (docs[1:] != docs[:-1]) | (sizes[1:] == 0) | (sizes[:-1] == 0)]))
        line = np.repeat(used, sizes[used])
        start = np.cumsum(sizes) - sizes
        run = runs[line]
        g = shingle_hashes(flat, 2)
        at = np.flatnonzero(self.pair_flags[g >> np.uint64(44)] & (run[:-1] == run[1:]))
        pair = np.searchsorted(self.every_pair, g[at]).clip(max=len(self.every_pair) - 1)
        same = self.every_pair[pair] == g[at]
        at, pair = at[same], pair[same]
        distinct = np.unique(run[at] * len(self.every_pair) + pair)
        of, pair_of = distinct // len(self.every_pair), distinct % len(self.every_pair)
        which, begin = np.unique(of, return_index=True)
        near_run, near_notice = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(0, len(which), 4096):  # runs of lines by templates, a piece at a time
            first = begin[k : k + 4096]
            end = begin[k + 4096] if k + 4096 < len(begin) else len(of)
            counts = np.add.reduceat(self.has.T[pair_of[first[0] : end]].astype(np.int32), first - first[0])
            r, n = np.nonzero(counts >= SIMILARITY * self.sizes)
            near_run.append(which[k + r])
            near_notice.append(n)
        near_run, near_notice = np.concatenate(near_run), np.concatenate(near_notice)
        spans = set()
        for k in np.unique(near_notice):
            mine = np.flatnonzero(self.has[k][pair] & np.isin(run[at], near_run[near_notice == k]))
            spans |= set(self.stretches(at[mine], pair[mine], run[at[mine]], STRETCH * len(self.notices[k][1]), SIMILARITY * self.sizes[k]))
        spans = sorted((a, b) for a, b in spans if line[a] != line[b])
        texts_ = {t: n for (_, _, t), n in zip(self.notices, self.sizes)}
        rows = [(*row, int(start[row[0]]), int(start[row[0]] + sizes[row[0]] - 1)) for row in alone]
        rows += [(int(line[spans[i][0]]), *rest, *spans[i]) for i, *rest in (self([flat[a : b + 1] for a, b in spans]) if spans else [])]
        busy, out = np.zeros(len(flat), bool), []
        for at_line, family, p, similarity, notice, a, b in sorted(rows, key=lambda r: (-r[3] * texts_[r[4]], -r[3], r[6] - r[5], -r[2], r[5])):
            if not busy[a : b + 1].any():
                busy[a : b + 1] = True
                out.append((at_line, family, p, similarity, notice))
        return out

    @staticmethod
    def stretches(at: np.ndarray, pair: np.ndarray, run: np.ndarray, most: int, least: float) -> list[tuple[int, int]]:
        """First and last word of stretches of at most ``most`` words with ``least`` distinct 2-grams, the fullest first, apart."""
        at, pair, run = at.tolist(), pair.tolist(), run.tolist()
        inside: dict[int, int] = {}
        left, found = 0, []
        for i in range(len(at)):
            inside[pair[i]] = inside.get(pair[i], 0) + 1
            while run[left] != run[i] or at[i] + 2 - at[left] > most or inside[pair[left]] > 1:
                inside[pair[left]] -= 1
                if not inside[pair[left]]:
                    del inside[pair[left]]
                left += 1
            if len(inside) >= least:
                found.append((-len(inside), at[i] + 1 - at[left], at[left], at[i] + 1))
        busy, out = set(), []
        for *_, a, b in sorted(found):
            if a not in busy and b not in busy and busy.isdisjoint(range(a, b + 1)):
                busy.update(range(a, b + 1))
                out.append((a, b))
        return out


def license_paragraphs(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per paragraph that is a licence notice: doc_id, paragraph (from 0), family, probability, similarity, notice."""
    small_batches(spark)
    line = docs.select(F.explode(F.split("text", "\n")).alias("line")).where(F.length("line").between(20, LONGEST)).select(F.xxhash64("line").alias("h"), "line")
    # a line for each residue of the hash: tasks keep at most PROSE_LINES, and so many come to the driver
    of = line.groupBy(F.pmod("h", F.lit(PROSE_LINES)).alias("k")).agg(F.min(F.struct("h", "line")).alias("x"))
    shared = spark.sparkContext.broadcast(Model([r.line for r in of.orderBy("k").select("x.line").collect()]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, plain = shared.value, PlainWords()
        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            places, lines, docs = [], [], []
            for row, (i, t) in enumerate(zip(ids, texts(batch))):
                for k, x in enumerate(t.split(b"\n")):
                    places.append((i, k))
                    lines.append(plain.text(x))
                    docs.append(row)
            found = model.paragraphs(lines, np.array(docs, np.int64))
            rows = [(*places[at], *rest) for at, *rest in found]
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string())
                names = ["doc_id", "paragraph", "family", "probability", "similarity", "notice"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_paragraphs(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op4_license_scan": op4_license_scan}
ORACLES: dict[str, str] = {}
