"""Licence scans: a trained paragraph classifier, confirmed by templates.

Every line of a text with a word is a paragraph.  Its features are hashed single words and word
pairs, each counted once or more and scaled to unit length; a multinomial logistic regression
(Spark ML) gives the probabilities of the licence families, of ``none`` (no licence) and of
``unknown`` (a licence notice of no known family).

Training data is bounded: ``variants`` notices per template (words dropped, words of the corpus
before and after), as many unknown notices (the words that only one family uses replaced by
corpus words), and ``most_plain`` plain paragraphs, those with the least hash of all paragraphs
of the whole corpus without a cue word.  A fifth is held out; on it a temperature is fitted
that makes the probabilities right on average, and the least probability is set at which at
most ``false_accepts`` of the unknown and plain ones would pass as a family.  What falls below
it is unknown.

A family is confirmed if one of its templates has at least ``confirm`` of its word pairs in the
paragraph.  Besides, every text is compared with the templates wherever their word pairs occur, whatever
its lines: a stretch of about a template's length without an empty line in it that holds ``confirm`` of the pairs is a
confirmed notice, though it is wrapped over lines or stands within a long one.  Of stretches that
overlap the most alike one stays (ties: the longer template, then the first family); lines judged on their own within it
are part of it.  It also has to hold as many of the pairs that no other family has, and the classifier has to put it nearer to
its family than to any other.

Nulls and texts without words have no paragraphs.  Very long texts are scanned in pieces at line
ends, long lines whole.  Repeated rows are scanned each; an empty table gives no rows.  With
fewer plain paragraphs than asked for, all are used.  Extra columns are not read.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD, dropped, mixed, saved, utf8_buffer
from tessera.llm.ngram_join import word_hashes

# ---- FIXED VALUES: notices by family ---------------------------------------------------------
TEMPLATES = {
    "mit": ["Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction",
            "Licensed under the MIT license"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "You may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"],
    "lgpl": ["Licensed under the GNU Lesser General Public License",
             "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
             "General Public License"],
    "agpl": ["Licensed under the GNU Affero General Public License, version 3",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "bsd": ["Licensed under the BSD 3-Clause License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted", "Released under the ISC License"],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "Licensed under CC BY 4.0."],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
                 "Licensed under CC BY-SA 4.0."],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "Licensed under CC BY-NC 4.0."],
    "cc0": ["To the extent possible under law, the author has waived all copyright and related rights to this work.",
            "This work is in the public domain.", "Dedicated to the public domain under CC0 1.0."],
    "proprietary": ["All rights reserved.", "No part of this publication may be reproduced without the prior written "
                    "permission of the publisher."],
}
CUES = "licen[sc]|copyright|rights reserved|permission|permitted|public domain|redistribut|creative commons|warrant"
FAMILIES = sorted(TEMPLATES)
CLASSES = [*FAMILIES, "none", "unknown"]

FEATURES = 1 << 15
_SPACES = " \t\n\x0b\f\r"
_WORD, _LINE = re.compile(f"[^{_SPACES}]+"), re.compile("[^\n]*\n?")
_PAIR = mixed(np.array([11, 13], dtype=np.uint64)) | np.uint64(1)


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, paragraph) of every word and word pair of the paragraphs in ``data``."""
    h, at = word_hashes(data, off)
    of = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pair = np.flatnonzero(of[1:] == of[:-1]) if len(of) else np.zeros(0, np.int64)
    two = mixed(h[pair] * _PAIR[0] + h[pair + 1] * _PAIR[1])
    f = np.concatenate([h, two]) & np.uint64(FEATURES - 1)
    return f.astype(np.int64), np.concatenate([of, of[pair]])


def counts_of(paragraphs: list[str]) -> list[dict[int, float]]:
    """Sparse unit vectors of a bounded list of paragraphs."""
    data, off = utf8_buffer(pa.array([p.replace("\n", " ") for p in paragraphs], pa.string()))
    f, of = features(data, off)
    out: list[dict[int, float]] = [{} for _ in paragraphs]
    for i, k in zip(of.tolist(), f.tolist()):
        out[i][k] = out[i].get(k, 0.0) + 1.0
    for v in out:
        size = sum(x * x for x in v.values()) ** 0.5
        for k in v:
            v[k] /= size
    return out


def sparse_rows(paragraphs: list[str], step: int = 500) -> list[tuple[np.ndarray, np.ndarray]]:
    """The same as (features, values), features in order."""
    out = []
    for i in range(0, len(paragraphs), step):
        for v in counts_of(paragraphs[i: i + step]):
            k = np.array(sorted(v), np.int32)
            out.append((k, np.array([v[x] for x in k.tolist()])))
    return out


def word_pairs(text: str) -> set[tuple[str, str]]:
    """Pairs of neighbouring words, in lower case and without outer punctuation."""
    words = [w for w in (x.strip(".,;:()\"'") for x in text.lower().split()) if w]
    return set(zip(["", *words], words)) if len(words) < 2 else set(zip(words, words[1:]))


_PUNCTUATION = ".,;:()\"'"
_TEMPLATES: list[tuple] = []


def templates() -> list[tuple]:
    """(family, words, word pairs, those that no other family has, sorted hashes of the pairs as they stand) of every
    template of three pairs or more."""
    if not _TEMPLATES:
        for family in FAMILIES:
            for t in TEMPLATES[family]:
                if len(word_pairs(t)) >= 3:
                    h, _ = word_hashes(*utf8_buffer(pa.array([t])))
                    others = set().union(*[word_pairs(x) for f, own in TEMPLATES.items() if f != family for x in own])
                    _TEMPLATES.append((family, len(t.split()), word_pairs(t), word_pairs(t) - others, np.unique(_pair_hashes(h))))
    return _TEMPLATES


def _pair_hashes(h: np.ndarray) -> np.ndarray:
    return mixed(h[:-1] * _PAIR[0] + h[1:] * _PAIR[1])


def stretches(text: str, confirm: float) -> list[tuple[int, int, str, float]]:
    """(first byte, end, family, similarity) of the stretches of a text that hold a template."""
    words, at, block = [], [], []
    gap = 0
    for k, line in enumerate(_LINE.finditer(text)):
        if not line[0].strip(_SPACES):
            gap += 1
        for m in _WORD.finditer(line[0]):
            w = m[0].lower().strip(_PUNCTUATION)
            if w:
                words.append(w)
                at.append((line.start() + m.start(), line.start() + m.end()))
                block.append(gap)
    pairs = list(zip(words, words[1:]))
    found = []
    for family, size, wanted, distinct, _ in templates():
        hits = [i for i, x in enumerate(pairs) if x in wanted and block[i] == block[i + 1]]
        most, best, lo = size + size // 4, [], 0
        held: dict = {}
        for k, i in enumerate(hits):  # the hits within `most` words that end here, all in one block
            held[pairs[i]] = held.get(pairs[i], 0) + 1
            # too far back, in another block, or said again further on
            while i - hits[lo] > most or block[hits[lo]] != block[i] or held[pairs[hits[lo]]] > 1:
                held[pairs[hits[lo]]] -= 1
                if not held[pairs[hits[lo]]]:
                    del held[pairs[hits[lo]]]
                lo += 1
            if len(held) >= confirm * len(wanted) and sum(x in held for x in distinct) >= confirm * len(distinct):
                best.append((len(held) / len(wanted), hits[lo], i + 1))
        found += [(-alike, -size, family, a, b) for alike, a, b in best]
    taken: list[tuple[int, int]] = []
    out = []
    for less, _, family, a, b in sorted(found, key=lambda x: (x[0], x[1], x[2], x[4] - x[3], x[3])):
        if all(b < lo or a > hi for lo, hi in taken):
            taken.append((a, b))
            out.append((at[a][0], at[b][1], family, -less))
    return sorted(out)


@dataclass
class Scanner:
    weights: np.ndarray  # FEATURES x classes
    intercepts: np.ndarray
    temperature: float
    least: float
    confirm: float = 0.8

    def probabilities(self, margins: np.ndarray) -> np.ndarray:
        z = margins / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def similarity(self, family: str, paragraph: str) -> float:
        own = word_pairs(paragraph)
        return max(len(t & own) / len(t) for t in map(word_pairs, TEMPLATES[family]))

    def margins(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(paragraphs with words, their margins)."""
        f, of = features(data, off)
        n = len(off) - 1
        key = of * FEATURES + f
        key.sort()
        new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, np.int64)
        k = np.diff(np.append(new, len(key))).astype(np.float64)
        f, of = key[new] % FEATURES, key[new] // FEATURES
        size = np.sqrt(np.bincount(of, k * k, minlength=n))
        some = np.flatnonzero(size)
        if not len(some):
            return some, np.zeros((0, len(CLASSES)))
        total = np.add.reduceat(self.weights[f] * k[:, None].astype(np.float32), np.searchsorted(of, some), axis=0)
        return some, total.astype(np.float64) / size[some, None] + self.intercepts

    def scan(self, column, most: int = 1 << 20):
        """(text, paragraph text, class, probability, similarity) of every paragraph that is not
        plain, and the number of paragraphs per text."""
        data, off = utf8_buffer(column)
        n = len(off) - 1
        counts, found = np.zeros(n, np.int64), []
        line = np.concatenate([off, np.flatnonzero(data == 10) + 1])
        line = np.unique(line)
        none, unknown = CLASSES.index("none"), CLASSES.index("unknown")
        first = 0
        while first < len(line) - 1:
            last = min(len(line) - 1, max(first + 1, int(np.searchsorted(line, line[first] + most, side="right")) - 1))
            part, at = data[line[first]: line[last]], line[first: last + 1] - line[first]
            some, margins = self.margins(part, at)
            text = np.searchsorted(off, line[first + some], side="right") - 1
            counts += np.bincount(text, minlength=n)
            p = self.probabilities(margins) if len(some) else margins
            best = p.argmax(axis=1) if len(some) else some
            for j in np.flatnonzero(best != none):
                a = some[j]
                paragraph = part[at[a]: at[a + 1]].tobytes().decode("utf-8", "replace").rstrip("\n")
                k = int(best[j])
                prob = float(p[j, k])
                family = CLASSES[k] if prob >= self.least or k == unknown else "unknown"
                alike = self.similarity(family, paragraph) if family != "unknown" else 0.0
                start = int(line[first] + at[a] - off[int(text[j])])
                found.append((int(text[j]), paragraph, family, prob, alike, start, start + len(paragraph.encode())))
            first = last
        return counts, self.with_stretches(column, data, off, found, most)

    def with_stretches(self, column, data: np.ndarray, off: np.ndarray, found: list[tuple], most: int) -> list[tuple]:
        """``found`` (with places in bytes) and the stretches of texts that hold a template; without places."""
        lines: dict[int, list[tuple]] = {}
        for x in found:
            lines.setdefault(x[0], []).append(x)
        n, first = len(off) - 1, 0
        while first < n:
            last = min(n, max(first + 1, int(np.searchsorted(off, off[first] + most, side="right")) - 1))
            h, wo = word_hashes(data[off[first]: off[last]], off[first: last + 1] - off[first])
            pairs = _pair_hashes(h)
            likely = set()
            for *_, known in templates():
                place = np.searchsorted(known, pairs)
                hit = np.flatnonzero(known[np.minimum(place, len(known) - 1)] == pairs)
                of = np.searchsorted(wo, hit, side="right") - 1
                different = np.unique(of * len(known) + place[hit])
                enough = np.bincount(different // len(known), minlength=last - first) * 2 >= len(known)
                likely.update((np.flatnonzero(enough) + first).tolist())
            for i in sorted(likely):
                text = column[i].as_py()
                for a, b, family, alike in stretches(text, self.confirm):
                    own = text[a:b]
                    a, b = len(text[:a].encode("utf-8", "surrogatepass")), len(text[:b].encode("utf-8", "surrogatepass"))
                    held = lines.setdefault(i, [])
                    if any(x[4] >= self.confirm and x[5] < b and a < x[6] for x in held):
                        continue  # a line that is confirmed on its own
                    flat = own.replace("\n", " ")
                    _, margins = self.margins(*utf8_buffer(pa.array([flat])))
                    p = self.probabilities(margins)[0]
                    if FAMILIES[int(p[:len(FAMILIES)].argmax())] != family:
                        continue  # half a notice may be near another family's template
                    p = float(p[CLASSES.index(family)])
                    lines[i] = [x for x in held if not (a <= x[5] and x[6] <= b)] + [(i, own, family, p, alike, a, b)]
            first = last
        return [x[:5] for i in sorted(lines) for x in sorted(lines[i], key=lambda x: x[5])]


# ---- training --------------------------------------------------------------------------------

def plain_paragraphs(docs: DataFrame, text: str, most: int) -> list[str]:
    """The ``most`` paragraphs without a cue word that have the least hashes of the corpus."""
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("p"))
    lines = lines.where(F.col("p").rlike(WORD) & ~F.col("p").rlike(f"(?i){CUES}")).select("p", F.xxhash64("p").alias("h"))
    least = lines.select("h").distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]
    if least is None:
        return []
    return [r["p"] for r in lines.where(F.col("h") <= least).distinct().orderBy("h", "p").collect()]


def training_rows(plain: list[str], variants: int, seed: int) -> list[tuple[str, int, bool]]:
    """(paragraph, class, held out) for a bounded set of made and sampled paragraphs."""
    rng = random.Random(seed)
    vocabulary = sorted({w for p in plain[:2000] for w in p.split()[:200]}) or ["x"]
    uses: dict[str, set[str]] = {}
    for family, texts in TEMPLATES.items():
        for w in " ".join(texts).split():
            uses.setdefault(w.lower(), set()).add(family)

    def words(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    rows = []
    for family in FAMILIES:
        for t in TEMPLATES[family]:
            own = t.split()
            for i in range(variants):
                held = i % 5 == 4
                body = own if i % 4 == 0 and not held else [w for w in own if rng.random() > 0.08] or own
                around = (words(1 + rng.randrange(7)), words(1 + rng.randrange(7))) if i % 4 > 1 or held else ([], [])
                rows.append((" ".join([*around[0], *body, *around[1]]), CLASSES.index(family), held))
                if len(own) > 3:
                    other = [rng.choice(vocabulary) if len(uses[w.lower()]) == 1 else w for w in own]
                    if sum(a == b for a, b in zip(own, other)) < 0.8 * len(own):
                        rows.append((" ".join(other), CLASSES.index("unknown"), held))
    rows += [(p, CLASSES.index("none"), i % 5 == 4) for i, p in enumerate(plain)]
    fitted = {text for text, _, held in rows if not held}
    return [row for row in rows if not row[2] or row[0] not in fitted]  # nothing held out was seen in the fit


def trained(docs: DataFrame, text: str = "text", variants: int = 40, most_plain: int = 3000, false_accepts: float = 0.01,
            confirm: float = 0.8, seed: int = 9) -> Scanner:
    """A scanner fitted on a bounded sample (see the module's text for the bounds)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    spark = docs.sparkSession
    rows = training_rows(plain_paragraphs(docs, text, most_plain), variants, seed)
    labels = np.array([c for _, c, _ in rows])
    away = np.array([held for *_, held in rows])
    vectors = sparse_rows([r[0] for r in rows])
    # features that no fitted row has keep the weight 0 under the penalty, so they are left out of the fit
    used = np.unique(np.concatenate([f for (f, _), held in zip(vectors, away) if not held]))
    frame = spark.createDataFrame([(float(c), Vectors.sparse(len(used), np.searchsorted(used, f), x))
                                   for c, (f, x), held in zip(labels.tolist(), vectors, away) if not held], ["label", "features"])
    del rows
    frame = saved(frame.coalesce(1), "licence-fit")  # every iteration reads a table, not rows that the driver holds
    model = LogisticRegression(family="multinomial", regParam=2e-4, maxIter=60, standardization=False).fit(frame)
    weights = np.zeros((FEATURES, len(CLASSES)), np.float32)
    intercepts = np.full(len(CLASSES), -1e3)
    n = model.numClasses
    weights[used, :n] = model.coefficientMatrix.toArray().T
    intercepts[:n] = model.interceptVector.toArray()
    dropped(frame)
    held = [(c, v) for c, v, h in zip(labels.tolist(), vectors, away) if h]
    margins = np.array([x @ weights[f].astype(np.float64) + intercepts for _, (f, x) in held])
    labels = np.array([c for c, _ in held])
    scanner = Scanner(weights, intercepts, 1.0, 0.0, confirm)
    losses = []
    for t in np.geomspace(0.2, 5.0, 49):
        scanner.temperature = float(t)
        p = scanner.probabilities(margins)[np.arange(len(labels)), labels]
        losses.append((-float(np.log(np.maximum(p, 1e-12)).mean()), float(t)))
    scanner.temperature = min(losses)[1]
    p = scanner.probabilities(margins)[:, :len(FAMILIES)].max(axis=1)
    others = np.sort(p[labels >= len(FAMILIES)])[::-1]
    allowed = int(false_accepts * len(others))
    scanner.least = max(0.5, float(others[allowed]) + 1e-9) if len(others) > allowed else 0.5
    return scanner


RESULT = ("doc_id long, n_paragraphs long, notices array<struct<paragraph: string, family: string, probability: double, "
          "similarity: double, confirmed: boolean>>")


def scanned(docs: DataFrame, scanner: Scanner, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id, n_paragraphs, notices (every paragraph that is not plain)."""
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    kind = pa.list_(pa.struct([("paragraph", pa.string()), ("family", pa.string()), ("probability", pa.float64()),
                               ("similarity", pa.float64()), ("confirmed", pa.bool_())]))

    def scan(batches):
        s = shared.value
        for batch in batches:
            counts, found = s.scan(batch.column("text"))
            of: list[list] = [[] for _ in counts]
            for i, paragraph, family, prob, alike in found:
                of[i].append({"paragraph": paragraph, "family": family, "probability": prob, "similarity": alike,
                              "confirmed": alike >= s.confirm})
            yield pa.record_batch([batch.column("doc_id"), pa.array(counts), pa.array(of, kind)],
                                  ["doc_id", "n_paragraphs", "notices"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(scan, RESULT)
