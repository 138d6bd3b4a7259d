"""Operator 1, licence scans: a trained paragraph classifier in Spark expressions.

A paragraph is a line of a text; runs of neighbouring lines with words are
read joined as well, since notices are wrapped.  Features are its distinct word 1- and
2-grams; the classes are licence families and ``unknown``.  The model is a
sparse multinomial logistic regression, trained here on a bounded set of
labelled paragraphs: variants of the families' notices (``VARIANTS`` of each),
and as unknown ones everyday sentences and ``BACKGROUND`` paragraphs of the
corpus, taken evenly by hash.  A temperature fitted on held-out variants
calibrates its probabilities; the threshold under which a paragraph is unknown
is the lowest that lets no held-out unknown paragraph through.

Scanning is one pass without a shuffle: paragraphs that hold no word of any
feature are unknown by the model itself (all their weights are zero), so only
the others are scored.  The prediction is confirmed by comparing the
paragraph with the family's notices: the share of a notice's word 3-grams that
the paragraph contains.  A run that contains such a share of any notice is
judged in windows of its words that overlap by the longest notice, so every
notice lies whole in one of them; a family that a window confirms and no line
of the run did is found once for the run, at its first line.

Defined results: null and empty texts have no paragraphs; lines without a word
are none; equal lines count each; repeated rows and null ids pass through;
extra columns are ignored; an empty table gives no rows (the model is then
trained without background).
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let, table
from .quality import STOP_WORDS

UNKNOWN = "unknown"
VARIANTS = 60
BACKGROUND = 600
HELD_OUT = 5  # every fifth labelled paragraph
CONFIRMED = 0.5
OFTEN = 0.02  # of the background lines
EPOCHS, RATE, L1 = 400, 0.5, 2e-4
_SEED = 7

# Notices by which texts name their licence, by family.
NOTICES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "This software is released under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction.",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Distributed under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "Licensed under the GNU GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "You can redistribute this library under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "public-domain": [
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright 2020 Example Company. All rights reserved.",
        "This material is confidential and proprietary and may not be reproduced without written permission.",
    ],
}

# Sentences that use licence words and name no licence.
EVERYDAY = [
    "She renewed her driver's license last week.",
    "The museum is open to the public on Sundays.",
    "He reserved a table for four under the name of Miller.",
    "The general went to the library to return a free copy of the book.",
    "Human rights were discussed at the international conference.",
    "The version of the story that he told was short.",
    "Permission to enter the building was denied without a reason.",
    "The company distributed its work across three cities.",
    "Common sense and creative writing are taught here.",
    "The commercial was shown at eight and again at ten.",
    "The clause in the contract was read out twice.",
    "A foundation for young artists was created in May.",
]

WORD = r"[^a-z0-9.\-]+"
LINE_WITH_WORD = r"[\p{L}\p{N}]"
RUN_BREAK = r"\n[^\p{L}\p{N}]*\n"  # lines without a word
_SEPARATOR = re.compile(WORD)


def words_of_line(line: str) -> list[str]:
    """The same words as ``line_words``, for training on the driver."""
    return [w for w in (x.strip(".-") for x in _SEPARATOR.split(line.lower())) if w]


def line_words(line: Column) -> Column:
    cleaned = F.transform(F.split(F.lower(line), WORD), lambda w: F.btrim(w, F.lit(".-")))
    return F.filter(cleaned, lambda w: w != "")


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


def _variants(notice: str, rng: np.random.Generator, filler: list[str], n: int) -> list[str]:
    """The notice, and copies with words dropped, its end cut, or everyday text around it."""
    words, out = notice.split(" "), [notice]
    while len(out) < n:
        kept = [w for w in words if rng.random() > 0.08] or words
        if len(kept) > 6 and rng.random() < 0.3:
            kept = kept[: int(rng.integers(max(4, len(kept) // 2), len(kept) + 1))]
        text = " ".join(kept)
        if rng.random() < 0.4:
            other = filler[int(rng.integers(len(filler)))].split(" ")
            cut = int(rng.integers(1, len(other) + 1))
            text = f"{' '.join(other[:cut])} {text}" if rng.random() < 0.5 else f"{text} {' '.join(other[:cut])}"
        out.append(text)
    return out


class Model:
    """Classes, vocabulary, weights, bias, temperature and threshold."""

    def __init__(self, background: list[str], variants: int = VARIANTS):
        rng = np.random.default_rng(_SEED)
        filler = EVERYDAY + [b for b in background if b]
        self.classes = [*NOTICES, UNKNOWN]
        rows = [(v, k) for k, name in enumerate(NOTICES) for n in NOTICES[name]
                for v in _variants(n, rng, filler, max(1, variants // len(NOTICES[name])))]
        none = len(self.classes) - 1
        templates = {tuple(words_of_line(n)) for ns in NOTICES.values() for n in ns}
        grams = {g for t in templates for g in _three(list(t))}
        # background lines that hold a piece of a notice are no sure negatives
        rows += [(t, none) for t in EVERYDAY * 8]
        rows += [(t, none) for t in background if not grams & set(_three(words_of_line(t)))]
        sets = [_grams(words_of_line(t)) for t, _ in rows]
        wanted = {g for t in templates for g in _grams(list(t))}
        # features: the notices' grams with a word that plain lines seldom use;
        # ``anchors`` holds such a word of each, without which no feature occurs
        plain = [set(words_of_line(t)) for t in background]
        often = {*STOP_WORDS, *(w for t in templates for w in t if sum(w in p for p in plain) > OFTEN * len(plain))}
        rare = {g: [w for w in g.split(" ") if w not in often] for g in wanted}
        self.vocabulary = sorted(g for g in wanted if rare[g])
        self.anchors = sorted({rare[g][0] for g in self.vocabulary})
        at = {g: i for i, g in enumerate(self.vocabulary)}
        x = np.zeros((len(rows), len(at)))
        for r, s in enumerate(sets):
            x[r, [at[g] for g in s if g in at]] = 1
        y = np.array([k for _, k in rows])
        held = np.arange(len(rows)) % HELD_OUT == 0
        self.weights, self.bias = _train(x[~held], y[~held], len(self.classes))
        logits = x[held] @ self.weights + self.bias
        grid = np.geomspace(0.25, 4, 33)
        self.temperature = float(min(grid, key=lambda t: _loss(logits / t, y[held])))
        p = _softmax(logits / self.temperature)
        best, found = p[:, :-1].max(axis=1), y[held] == none
        self.threshold = float(max(0.5, best[found].max(initial=0.0) + 1e-3))
        said = np.where(best >= self.threshold, p[:, :-1].argmax(axis=1), none)
        self.held_out_accuracy = float((said == y[held]).mean())


def _three(words: list[str]) -> list[str]:
    n = min(3, len(words))
    return [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] if words else []


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def _train(x: np.ndarray, y: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Proximal gradient steps: the L1 term sets most weights to exactly zero."""
    w, b, target = np.zeros((x.shape[1], classes)), np.zeros(classes), np.eye(classes)[y]
    share = 1 / np.maximum(np.bincount(y, minlength=classes), 1)[y]
    share = (share / share.sum())[:, None]
    for _ in range(EPOCHS):
        g = (_softmax(x @ w + b) - target) * share * classes
        w -= RATE * (x.T @ g)
        w = np.sign(w) * np.maximum(np.abs(w) - RATE * L1, 0)
        b -= RATE * g.sum(axis=0)
    return w, b


def background_lines(docs: DataFrame, bound: int = BACKGROUND) -> list[str]:
    """At most ``bound`` lines of the corpus: the first line with a word of the
    texts whose ids come first by hash."""
    line = F.filter(F.split("text", "\n"), lambda x: x.rlike("[a-z]"))
    picked = (docs.filter("text is not null").select(F.xxhash64("doc_id", F.lit(_SEED)).alias("h"), F.get(line, 0).alias("line"))
              .filter("line is not null").orderBy("h", "line").limit(bound))
    return [r["line"] for r in picked.collect()]


def _table(value, kind: str) -> Column:
    """A constant table as one literal."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _joined(w: Column, n: int) -> Column:
    """The word n-grams of a line; all its words where they are fewer."""
    at = F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1)))
    return F.transform(at, lambda i: F.array_join(F.slice(w, i, n), " "))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (doc_id, text) with ``n_paragraphs`` and ``found``: for every
    paragraph that is not unknown its index, family, probability and whether a
    notice confirms it."""
    families = model.classes[:-1]
    weights = _table(np.vstack([model.weights, model.bias]).round(6).tolist(), "array<array<double>>")
    grams = _table(model.vocabulary, "array<string>")
    names = _table(families, "array<string>")
    notices = _table([[sorted(set(_three(words_of_line(n)))) for n in NOTICES[f]] for f in families], "array<array<array<string>>>")

    def probabilities(w: Column) -> Column:
        own = F.array_intersect(F.array_union(w, _joined(w, 2)), grams)
        row = lambda g: F.element_at(weights, F.array_position(grams, g).cast("int"))
        logits = F.aggregate(own, F.element_at(weights, -1), lambda a, g: F.zip_with(a, row(g), lambda x, y: x + y))
        scaled = let(logits, lambda z: let(F.array_max(z), lambda top: F.transform(z, lambda x: F.exp((x - top) / model.temperature))))
        return let(scaled, lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, x: a + x), lambda total: F.transform(e, lambda x: x / total)))

    def verdict(w: Column, p: Column, index: Column) -> Column:
        known = F.slice(p, 1, len(families))
        k = F.array_position(known, F.array_max(known)).cast("int")
        threes = let(_joined(w, 3), lambda t: F.array_max(
            F.transform(F.element_at(notices, k), lambda n: F.size(F.array_intersect(n, t)) / F.size(n))))
        return F.struct(index.alias("paragraph"), F.element_at(names, k).alias("family"),
                        F.array_max(known).alias("probability"), (threes >= CONFIRMED).alias("confirmed"))

    lines_of = lambda t: F.filter(F.split(t, "\n"), lambda x: x.rlike(LINE_WITH_WORD))
    text = F.coalesce("text", F.lit(""))
    runs = F.transform(F.filter(F.split(text, RUN_BREAK), lambda r: r.rlike(LINE_WITH_WORD)),
                       lambda r: F.struct(r.alias("r"), F.size(lines_of(r)).alias("n")))
    cut = docs.select("doc_id", lines_of(text).alias("lines"), runs.alias("runs")).withColumn("n_paragraphs", F.size("lines").cast("long"))
    # a line without an anchor has no feature: the bias alone says unknown
    anchors = _table(model.anchors, "array<string>")
    worded = F.transform("lines", lambda x, i: F.struct(i.alias("i"), line_words(x).alias("w")))
    before = lambda k: F.aggregate(F.slice("runs", F.lit(1), k), F.lit(0), lambda s, r: s + r["n"])
    joined = F.filter(F.transform("runs", lambda r, k: F.when(r["n"] > 1, F.struct(k.alias("k"), r["n"].alias("n"), line_words(r["r"]).alias("w")))),
                      lambda s: s.isNotNull() & F.arrays_overlap(s["w"], anchors))
    every = _table(sorted({g for ns in NOTICES.values() for n in ns for g in _three(words_of_line(n))}), "array<string>")
    holds = lambda w: let(F.array_intersect(every, _joined(w, 3)), lambda own: F.exists(F.flatten(notices), lambda n: (
        F.size(F.array_intersect(n, own)) >= F.size(n) * CONFIRMED)))
    screened = cut.select("doc_id", "n_paragraphs", F.filter(worded, lambda s: F.arrays_overlap(s["w"], anchors)).alias("worth"),
                          F.transform(F.filter(joined, lambda s: holds(s["w"])), lambda s: F.struct(
                              before(s["k"]).alias("i"), s["n"].alias("n"), s["w"].alias("w"))).alias("wrapped"))
    sure = lambda judged: F.filter(judged, lambda r: r["probability"] >= model.threshold)
    judged = F.transform("worth", lambda s: let(probabilities(s["w"]), lambda p: verdict(s["w"], p, s["i"])))
    single = screened.select("doc_id", "n_paragraphs", "wrapped", sure(judged).alias("lines"))

    longest = max(len(words_of_line(n)) for ns in NOTICES.values() for n in ns)
    stride = (longest + 1) // 2

    def of_run(s: Column) -> Column:
        at = F.sequence(F.lit(0), F.floor((F.size(s["w"]) - 1) / stride).cast("int"))
        windows = F.transform(at, lambda k: F.slice(s["w"], k * stride + 1, F.lit(longest + stride)))
        told = sure(F.transform(windows, lambda w: let(probabilities(w), lambda p: verdict(w, p, s["i"]))))
        new = F.filter(told, lambda r: r["confirmed"] & ~F.exists("lines", lambda x: (
            x["confirmed"] & (x["family"] == r["family"]) & (x["paragraph"] >= s["i"]) & (x["paragraph"] < s["i"] + s["n"]))))
        # the surest window of each family
        return let(new, lambda v: F.filter(v, lambda r, i: ~F.exists(F.transform(v, lambda x, j: F.struct(x.alias("x"), j.alias("j"))), lambda o: (
            (o["x"]["family"] == r["family"]) & ((o["x"]["probability"] > r["probability"])
                                                 | ((o["x"]["probability"] == r["probability"]) & (o["j"] < i)))))))

    return single.select("doc_id", "n_paragraphs", F.concat("lines", F.flatten(F.transform("wrapped", of_run))).alias("found"))


def licences(docs: DataFrame, background: int = BACKGROUND) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_paragraphs, n_licence (paragraphs
    that name a licence, and runs with a wrapped notice), n_confirmed, families (sorted, comma-joined, of the
    confirmed ones), family and probability of the surest paragraph."""
    docs = docs.select("doc_id", "text")
    model = Model(background_lines(docs, background))
    sure = F.filter("found", lambda r: r["confirmed"])
    top = F.element_at(F.sort_array(F.transform("found", lambda r: F.struct(
        r["confirmed"].alias("c"), r["probability"].alias("p"), r["family"].alias("f"))), asc=False), 1)
    return (scan(docs, model).withColumn("top", F.when(F.size("found") > 0, top))
            .select("doc_id", "n_paragraphs", F.size("found").cast("long").alias("n_licence"),
                    F.size(sure).cast("long").alias("n_confirmed"),
                    F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda r: r["family"]))), ",").alias("families"),
                    F.coalesce(F.col("top")["f"], F.lit(UNKNOWN)).alias("family"),
                    F.col("top")["p"].alias("probability")))


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence families named in the paragraphs of all documents."""
    return licences(table(spark, sf_dir, "documents"))


QUERIES = {"op1_license_scan": op1_license_scan}
ORACLES: dict = {}
