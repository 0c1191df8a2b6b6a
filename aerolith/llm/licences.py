"""Licence notices in documents, by a trained paragraph classifier.

A paragraph is a line of the text, or several of a block of lines without a gap, where a notice is wrapped: the lines
on which the word pairs of a template lie are judged together, and a notice found so stands for the parts of it that
single lines show. Comment marks are no words. A paragraph's features are one to three consecutive words, from a list made
of the templates below; n-grams that ordinary paragraphs of the corpus contain too are left out, and each n-gram has at
least one word that is a feature by itself. Logistic regression with one weight vector per class tells
the licence families and `none` apart.

Training examples are the templates, with words left out and ordinary words put around them, against a bounded sample of
`SAMPLE_PARAGRAPHS` paragraphs of the corpus that name no licence and share few word pairs with any template, and sentences that use the words otherwise. A part of
the examples is set aside to calibrate the probabilities (temperature of the softmax).

A paragraph that is unlikely to be `none` belongs to the likeliest family if that is likely enough and a template of the
family confirms it: most of the template's word pairs are in the paragraph. Otherwise its family is `unknown`.
A paragraph without any feature is `none`; no paragraph is left unread.

Null text has no paragraphs. Repeated documents are reported one by one. An empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from aerolith.llm.common import column, ship_package, whole_row

# Usual notices of each family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "agpl": (
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-or-later",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Released under the Apache 2.0 License.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc0": (
        "Released into the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0",
        "SPDX-License-Identifier: CC0-1.0",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-nd": (
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GPL, version 2 or later.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "proprietary": (
        "All rights reserved. No part of this publication may be reproduced without the prior written permission of the publisher",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited",
    ),
}
# Sentences with the same words that license nothing.
ORDINARY = (
    "He lost his driving license and had to take the test again",
    "A licensed plumber must sign the form",
    "The city gave the bar a new license to sell wine",
    "The general public may visit the library on Sundays",
    "The Apache people lived in the south west of the country",
    "She studied at MIT and later at another university",
    "The terms of the contract were hard to read",
    "The work was published by the foundation under a new title",
    "Version 3 of the program is faster",
    "The permission of the owner is needed before you copy the key",
    "All seats are reserved for members",
    "Common creatures and creative people share the commons",
)
NONE, UNKNOWN = "none", "unknown"
SAMPLE_DOCUMENTS = 1_000
SAMPLE_PARAGRAPHS = 3_000
VARIANTS = 60  # examples made of each template
SEED = 13
COMMON_SHARE = 0.002  # an n-gram in more of the ordinary paragraphs than this is no feature
CALIBRATION_SHARE = 0.25
STEPS, RATE, PENALTY = 300, 2.0, 1e-4
NONE_LIMIT = 0.5  # a paragraph less likely than this to be none is a notice
FAMILY_LIMIT = 0.5
TEMPLATE_SHARE = 0.6
LIKE_TEMPLATE = 0.3  # share of word pairs from which a paragraph is no ordinary one
WINDOW = 1.5  # words of a wrapped notice, as a multiple of its template's
COMMENT = re.compile(r"^\s*(?:dnl|rem)(?=\s|$)", re.IGNORECASE)
WORD = re.compile(r"[^\W_]+")
NAMES_LICENCE = r"(?i)licen[sc]|copyright|redistribut|public domain|creative commons|all rights reserved|spdx"


def words_of(paragraph: str) -> list[str]:
    return WORD.findall(paragraph.lower())


def grams_of(words: list[str]) -> list[str]:
    return [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def pairs_of(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


TEMPLATE_PAIRS = {family: [pairs_of(words_of(t)) for t in texts] for family, texts in TEMPLATES.items()}


PAIR_OWNERS: dict[tuple[str, str], list[tuple[str, int]]] = {}
for _family, _templates in TEMPLATE_PAIRS.items():
    for _number, _pairs in enumerate(_templates):
        for _pair in _pairs:
            PAIR_OWNERS.setdefault(_pair, []).append((_family, _number))


def windows(words: list[str]) -> list[tuple[int, int]]:
    """Stretches (first word, word after the last) that hold most word pairs of a template."""
    places: dict[tuple[str, int], list[tuple[int, tuple[str, str]]]] = {}
    for place, pair in enumerate(zip(words, words[1:], strict=False)):
        for owner in PAIR_OWNERS.get(pair, ()):
            places.setdefault(owner, []).append((place, pair))
    found = []
    for (family, number), own in places.items():
        size = len(TEMPLATE_PAIRS[family][number])
        held: Counter = Counter()
        low, best = 0, None  # the fullest stretch, then the shortest
        for place, pair in own:
            if best and own[low][0] > best[3]:
                found.append((best[2], best[3] + 2))
                best = None
            held[pair] += 1
            while place - own[low][0] > WINDOW * size or held[own[low][1]] > 1:
                held[own[low][1]] -= 1
                if not held[own[low][1]]:
                    del held[own[low][1]]
                low += 1
            if len(held) >= TEMPLATE_SHARE * size:
                rank = (len(held), own[low][0] - place, own[low][0], place)
                best = rank if best is None or rank[:2] > best[:2] else best
        if best:
            found.append((best[2], best[3] + 2))
    return found


def like_template(words: list[str]) -> bool:
    """Whether a paragraph has many word pairs of a template, or is a part of one."""
    pairs = pairs_of(words)
    for template in (t for ts in TEMPLATE_PAIRS.values() for t in ts):
        common = len(pairs & template)
        if common > 1 and common >= LIKE_TEMPLATE * len(template):
            return True
        if common > 2 and common >= LIKE_TEMPLATE * len(pairs):
            return True
    return False


def softmax(scores: np.ndarray) -> np.ndarray:
    powers = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return powers / powers.sum(axis=-1, keepdims=True)


@dataclass
class LicenceModel:
    classes: list[str]
    features: dict[str, int]
    weights: np.ndarray  # features + 1 (bias) x classes
    temperature: float

    def __post_init__(self):
        self.signals = frozenset(g for g in self.features if " " not in g)
        self.none = self.classes.index(NONE)

    def probabilities(self, words: list[str]) -> np.ndarray:
        found = {self.features[g] for g in grams_of(words) if g in self.features}
        return softmax((self.weights[sorted(found)].sum(axis=0) + self.weights[-1]) / self.temperature)

    def judge(self, paragraph: str) -> tuple[str, float, float] | None:
        """Family, its probability and the share of its best template; None for ordinary paragraphs."""
        return self.judge_words(words_of(paragraph))

    def judge_words(self, words: list[str]) -> tuple[str, float, float] | None:
        if self.signals.isdisjoint(words):
            return None
        chances = self.probabilities(words)
        if chances[self.none] >= NONE_LIMIT:
            return None
        chances[self.none] = 0.0
        best = int(chances.argmax())
        family, chance = self.classes[best], float(chances[best])
        pairs = pairs_of(words)
        share = max(len(pairs & t) / len(t) for t in TEMPLATE_PAIRS[family])
        if chance < FAMILY_LIMIT or share < TEMPLATE_SHARE:
            family = UNKNOWN
        return family, chance, share

    def notices(self, text: str) -> tuple[int, list[dict]]:
        """Number of lines that are not blank, and all notices by their first line."""
        lines = text.split("\n")
        ends = np.cumsum([len(line) + 1 for line in lines]) - 1
        split = [words_of(COMMENT.sub(" ", line)) for line in lines]
        alone = {i: verdict for i, words in enumerate(split) if words and (verdict := self.judge_words(words))}
        found = [(first, last, *verdict) for first, last, verdict in self._wrapped(split, alone)]
        found += [(i, i, *verdict) for i, verdict in alone.items()]
        keys = ("place", "start", "end", "family", "probability", "template_share")
        rows = [
            dict(zip(keys, (first, int(ends[first]) - len(lines[first]), int(ends[last]), *verdict), strict=True))
            for first, last, *verdict in sorted(found)
        ]
        return sum(bool(line.strip()) for line in lines), rows

    def _wrapped(self, split: list[list[str]], alone: dict) -> list[tuple[int, int, tuple]]:
        """Notices over several lines: first, last, verdict. Their parts are taken out of `alone`."""
        options, first = [], 0
        while first < len(split):
            after = first
            while after < len(split) and split[after]:
                after += 1
            block = [(word, i) for i in range(first, after) for word in split[i]]
            if after - first > 1 and not self.signals.isdisjoint(word for word, _ in block):
                words = [word for word, _ in block]
                for low, high in set(windows(words)):
                    a, b = block[low][1], block[high - 1][1]
                    verdict = self.judge_words(words[low:high]) if a < b else None
                    if verdict and verdict[0] != UNKNOWN:
                        options.append((verdict[2], verdict[1], high - low, a, b, verdict))
            first = after + 1
        taken: list[tuple[int, int, tuple]] = []
        # Fuller templates first, then longer ones; a line belongs to one wrapped notice.
        for *_, a, b, verdict in sorted(options, key=lambda o: (-o[0], -o[2], -o[1], o[3])):
            whole = any(i in alone and alone[i][0] not in (UNKNOWN, verdict[0]) for i in range(a, b + 1))
            if not whole and all(b < x or y < a for x, y, _ in taken):
                taken.append((a, b, verdict))
        for a, b, _ in taken:
            for i in range(a, b + 1):
                alone.pop(i, None)
        return taken


def _examples(ordinary: list[list[str]]) -> tuple[list[list[str]], list[str]]:
    """Word lists and classes; variants of templates have words left out and ordinary words around."""
    draw = random.Random(SEED)
    filler = [words for words in ordinary if words] or [["x"]]
    texts, labels = [], []
    for family, templates in TEMPLATES.items():
        for template in templates:
            words = words_of(template)
            for variant in range(VARIANTS):
                kept = [w for w in words if not variant or draw.random() > 0.08] or words
                before = draw.choice(filler)[: draw.randint(0, 12)] if variant % 3 == 1 else []
                after = draw.choice(filler)[: draw.randint(0, 12)] if variant % 3 == 2 else []
                texts.append(before + kept + after)
                labels.append(family)
    texts += ordinary
    labels += [NONE] * len(ordinary)
    for sentence in ORDINARY:
        texts += [words_of(sentence)] * 20
        labels += [NONE] * 20
    return texts, labels


def fit(ordinary: list[str]) -> LicenceModel:
    """From ordinary paragraphs of the corpus, of which there is a bounded number."""
    plain = [words for words in map(words_of, ordinary) if not like_template(words)]
    seen = Counter(g for words in plain for g in set(grams_of(words)))
    limit = max(COMMON_SHARE * len(plain), 1)  # one line alone makes nothing common
    grams = Counter(g for ts in TEMPLATES.values() for t in ts for g in set(grams_of(words_of(t))))
    rare = {g for g in grams if seen[g] <= limit}
    signals = {g for g in rare if " " not in g and (len(g) > 2 or g in ("cc", "by", "nc", "sa", "nd")) and not g.isdigit()}
    # A paragraph without signals has no feature at all, so it need not be looked at further.
    usable = sorted(g for g in rare if not signals.isdisjoint(g.split(" ")))
    features = {g: i for i, g in enumerate(usable)}
    classes = [*sorted(TEMPLATES), NONE]
    texts, labels = _examples(plain)
    inputs = np.zeros((len(texts), len(features) + 1), np.float32)
    inputs[:, -1] = 1.0
    for row, words in enumerate(texts):
        inputs[row, [features[g] for g in set(grams_of(words)) if g in features]] = 1.0
    target = np.array([classes.index(x) for x in labels])
    aside = np.random.default_rng(SEED).random(len(texts)) < CALIBRATION_SHARE
    own, truth = inputs[~aside], np.eye(len(classes), dtype=np.float32)[target[~aside]]
    weights = np.zeros((inputs.shape[1], len(classes)), np.float32)
    speed = np.zeros_like(weights)
    balance = (1.0 / np.bincount(target[~aside], minlength=len(classes)).clip(1))[target[~aside]]
    balance = (balance / balance.sum()).astype(np.float32)[:, None]
    for _ in range(STEPS):  # gradient descent with momentum
        slope = own.T @ ((softmax(own @ weights) - truth) * balance) + PENALTY * weights
        speed = 0.9 * speed - RATE * slope
        weights += speed
    scores = inputs[aside] @ weights
    place = np.arange(aside.sum()), target[aside]
    temperatures = np.geomspace(0.1, 10, 60)
    losses = [-np.log(softmax(scores / t)[place] + 1e-12).mean() for t in temperatures]
    best = float(temperatures[int(np.argmin(losses))]) if aside.any() else 1.0
    return LicenceModel(classes, features, weights.astype(np.float64), best)


def ordinary_sample(docs: DataFrame, text: str = "text", key: str = "doc_id") -> list[str]:
    """At most `SAMPLE_PARAGRAPHS` paragraphs that name no licence, of `SAMPLE_DOCUMENTS` chosen by hash."""
    ranked = docs.filter(F.length(column(text)) > 0).select(
        F.xxhash64(column(key).cast("string"), column(text), F.lit(SEED)).alias("rank"),
        column(text).alias("text"),
    )
    # The bound is found on ranks alone, so that only the texts that are wanted move.
    last = ranked.select("rank").orderBy("rank").limit(SAMPLE_DOCUMENTS).agg(F.max("rank")).first()[0]
    chosen = ranked.filter(F.col("rank") <= F.lit(last)) if last is not None else ranked.limit(0)
    lines = chosen.select("rank", F.explode(F.split("text", "\n")).alias("line"))
    ship_package(docs.sparkSession)

    @F.pandas_udf(BooleanType())
    def ordinary(lines: pd.Series) -> pd.Series:
        return pd.Series([not like_template(words_of(line)) for line in lines], dtype=bool)

    plain = lines.filter(~F.col("line").rlike(NAMES_LICENCE) & (F.length("line") > 0)).filter(ordinary("line"))
    order = (F.xxhash64("rank", "line"), F.col("line"))
    return [r["line"] for r in plain.orderBy(*order).limit(SAMPLE_PARAGRAPHS).collect()]


def paragraphs(docs: DataFrame, model: LicenceModel, text: str = "text") -> DataFrame:
    """`doc` (each row as it was) with `notices`: place, start, end, family, probability, template_share."""
    ship_package(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of the size of the templates

    @F.pandas_udf(
        "n_paragraphs long, notices array<struct<place:long,start:long,end:long,family:string,"
        "probability:double,template_share:double>>"
    )
    def notices(texts: pd.Series) -> pd.DataFrame:
        rows = [sent.value.notices(text or "") for text in texts]
        return pd.DataFrame(rows, columns=["n_paragraphs", "notices"])

    return docs.select(whole_row(docs).alias("doc"), notices(column(text)).alias("scan")).select(
        "doc", "scan.n_paragraphs", "scan.notices"
    )


def report(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_paragraphs, n_notices, families (sorted, comma-joined), best_probability."""
    found = paragraphs(docs.select("doc_id", "text"), fit(ordinary_sample(docs)))
    families = F.array_sort(F.array_distinct(F.transform("notices", lambda n: n["family"])))
    return found.select(
        "doc.doc_id",
        "n_paragraphs",
        F.size("notices").cast("long").alias("n_notices"),
        F.array_join(families, ",").alias("families"),
        F.array_max(F.transform("notices", lambda n: n["probability"])).alias("best_probability"),
    )
