"""Licence scan with a trained paragraph classifier, in DataFrame functions only.

A paragraph is a run of lines that hold a letter or digit; comment marks do not count.  Its
units are its lines and, where it has several or long ones, windows of ``WINDOW`` words, each
half over the next, so that wrapped notices are seen whole.  A unit is scored by a sparse
multinomial logistic regression (L1) over indicators of words and word pairs, fitted on
notices composed from licence names and common wordings, on notices of licences that have no
family here (class ``other``), and on paragraphs that are none: fixed sentences and a bounded
sample of the corpus' own lines.  The threshold below which a prediction counts as unknown is
calibrated on wordings that the fit has not seen.  A prediction is confirmed when the unit's
words and word pairs cover enough of one of the family's templates and no negation stands
before the licence.  A paragraph has one finding per family, its best.

Only units with an essential word are scored: without one, no family's weights can reach the
threshold, so this loses nothing, whatever the corpus.  Which words are essential follows
from the weights; words that are common in the corpus are left out as far as the bound goes.

Scoring is one narrow pass without shuffle or join.  Null and empty texts have no finding;
rows with the same id are scanned each; a tie of probabilities goes to the first family.
Columns beside key and text play no part, so clashing names do no harm.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import stored

CORPUS_LINES = 400  # lines of the corpus that the fit sees
UNKNOWN = "unknown"
OTHER = "other"  # a licence of no family below; it has no template and is never confirmed
WINDOW = 48  # words
COVER = 0.6
SHELVES = 256

# Licence families with the names and identifiers in use, and a sentence of each text.
FAMILIES = {
    "agpl": ["GNU Affero General Public License, version 3", "AGPL-3.0-only", "AGPL-3.0-or-later", "GNU AGPL", "GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 license", "Apache Software License", "you may not use this file except in compliance with the Apache License"],
    "bsd": ["BSD License", "BSD-3-Clause", "BSD-2-Clause", "3-clause BSD license", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"],
    "cc-by": ["CC BY 4.0", "Creative Commons Attribution 4.0 International License", "CC-BY-4.0", "Creative Commons Attribution License"],
    "cc-by-nc": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "CC-BY-NC-4.0", "CC BY-NC-SA 4.0", "CC BY-NC-ND 4.0"],
    "cc-by-sa": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0", "CC BY-SA 3.0"],
    "cc0": ["CC0 1.0 Universal Public Domain Dedication", "CC0-1.0", "CC0 license", "dedicated to the public domain under CC0"],
    "epl": ["Eclipse Public License, version 2.0", "EPL-2.0", "EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"],
    "eupl": ["European Union Public Licence, version 1.2", "EUPL-1.2", "EUPL v1.2", "Licensed under the EUPL"],
    "gpl": ["GNU General Public License, version 3", "GNU General Public License, version 2", "GPL-3.0-or-later", "GPL-2.0-only", "GPLv3", "GNU General Public License as published by the Free Software Foundation"],
    "isc": ["ISC License", "SPDX-License-Identifier: ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "lgpl": ["GNU Lesser General Public License, version 3", "LGPL-2.1-or-later", "LGPL-3.0-only", "GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["MIT License", "SPDX-License-Identifier: MIT", "the MIT license", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "mpl": ["Mozilla Public License, version 2.0", "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "unlicense": ["The Unlicense", "SPDX-License-Identifier: Unlicense", "This is free and unencumbered software released into the public domain"],
    "zlib": ["zlib License", "SPDX-License-Identifier: Zlib", "zlib/libpng license", "This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"],
}
OTHERS = [
    "Example Public License, version 1.0", "Acme Software License Agreement", "proprietary license", "custom license", "license in the file LICENSE", "terms of the license agreement",
    "Northwind Community License 2.1", "LicenseRef-Commercial", "commercial licence of the publisher", "Example Open Source License", "licence of the city archive", "evaluation license",
    "Harbour Public License", "Harbour Public License, version 9", "Example Source License, version 2.0", "Lake Free License", "Example Documentation License",
]
WORDINGS = [
    "Licensed under {}.", "Licensed under the {}.", "Released under the {}.", "This work is licensed under {}.", "This work is licensed under the {}.",
    "SPDX-License-Identifier: {}", "{}", "This program is distributed under the terms of the {}.", "Distributed under {}. See the license file for details.",
    "The source code is available under the {}.", "License: {}", "Published under the {}, without warranty of any kind.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the {}; either version 3 of the License, or (at your option) any later version.",
    "Copyright (c) 2020 the authors. All rights reserved. {}. See the file COPYING for a copy of the license.",
    "This file is part of a library. You may use it in compliance with the {}; a copy is in the source tree, and it comes without warranty.",
]
UNSEEN = ["Made available under the {}.", "You may use this text under the terms of {}.", "All files here are covered by the {}."]
NO_LICENCE = [
    "A licence is needed to drive this vehicle.", "The fishing license costs ten dollars a year.", "She renewed her licence in the spring.", "Copyright notices were sent to the shop.",
    "All rights reserved.", "Copyright 2020 the authors.", "The warranty covers parts and work for two years.", "Permission to enter the building was refused.", "The general public was invited to the opening.",
    "He studied at MIT before moving abroad.", "The Apache helicopter landed at noon.", "Mozilla held a public meeting in version two of the hall.", "The public domain of the town is well kept.",
    "Redistribution of land was on the agenda.", "He lost his driving license and his permission to travel.", "The license plate was unreadable.", "This file has no license.",
    "The software is available for a fee.", "Free software was shown at the fair.", "They granted a license to sell drinks.", "Under the terms of the contract, work starts in May.",
    "Er kam mit dem Zug nach Hause.", "Das Haus mit dem Garten ist alt.", "Sie sprach mit der Frau.", "Mit dem Geld kaufte er Brot.", "Die Stadt mit ihren Kirchen und Parks.",
    "Wir fahren mit allen Kindern.", "Kaffee mit Milch, Tee ohne Zucker.", "mit und ohne Hilfe", "Isc and bsd are three letters each.", "An apache dance was shown.",
]
CUES = (
    "licen[sc]|copyright|warrant|permission|redistribut|public domain|creative commons|spdx|source code form|affero|"
    "\\b(?:[al]?gpl|bsd|mpl|apache|cc0|cc[ -]by)(?:\\b|v?[0-9])"
)
NEGATED = rf"(?i)\b(?:not|never|neither|isn't|nor)\s+(?:\S+\s+){{0,5}}?\W*(?:licen[sc]|(?:{'|'.join(sorted(FAMILIES))})\b)"
GRAM_TYPE = "array<struct<label: int, words: string, held: boolean>>"


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), "[^\\p{L}\\p{N}]+")


def grams(text: Column) -> Column:
    """Distinct words and word pairs of a text, lower-cased."""
    words = F.filter(words_of(text), lambda w: w != "")
    pairs = F.zip_with(words, F.slice(words, 2, 2_000_000_000), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, F.filter(pairs, lambda p: F.contains(p, F.lit(" ")))))


def examples(spark: SparkSession) -> DataFrame:
    """Composed notices by family, those for calibration marked ``held``, and fixed others."""
    rows = [
        {"label": label, "words": wording.format(name), "held": held}
        for label, family in enumerate(sorted(FAMILIES)) for name in FAMILIES[family]
        for held, wordings in ((False, WORDINGS), (True, UNSEEN)) for wording in wordings
    ]
    rows += [
        {"label": len(FAMILIES), "words": wording.format(name), "held": i % 4 == 3}
        for i, name in enumerate(OTHERS) for wording in (*WORDINGS, *UNSEEN)
    ]
    rows += [{"label": len(FAMILIES) + 1, "words": text, "held": i % 4 == 3} for i, text in enumerate(NO_LICENCE)]
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), GRAM_TYPE)))


def lines_of(text: Column) -> Column:
    return F.split(text, "\\R")


def corpus_lines(docs: DataFrame, text: str) -> DataFrame:
    """A bounded sample of the corpus as class unknown: lines without a cue, smallest hashes first."""
    lines = docs.select(F.explode(lines_of(F.col(text).cast("string"))).alias("words")).where(
        (F.length("words") > 20) & (F.pmod(F.xxhash64("words"), F.lit(16)) == 0) & ~F.lower("words").rlike(CUES)
    )
    chosen = lines.orderBy(F.xxhash64("words"), "words").limit(CORPUS_LINES)
    return chosen.select(F.lit(len(FAMILIES) + 1).alias("label"), "words", (F.pmod(F.xxhash64("words"), F.lit(4)) == 0).alias("held"))


def train(docs: DataFrame, text: str = "text") -> dict:
    """Vocabulary, weights, biases, the calibrated threshold and the essential words; size
    bounded by the examples, which are stored, so that the corpus is read once."""
    spark = docs.sparkSession
    rows = examples(spark).unionByName(corpus_lines(docs, text)).select(F.col("label").cast("double").alias("label"), "held", grams(F.col("words")).alias("grams"))
    rows = stored(rows.coalesce(1), "licence-examples")
    counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True, minDF=2, vocabSize=4096).fit(rows)
    vectors = counted.transform(rows)
    fit = LogisticRegression(family="multinomial", elasticNetParam=1.0, regParam=0.0008, maxIter=60).fit(vectors.where("NOT held"))
    weights, biases = fit.coefficientMatrix.toArray(), fit.interceptVector.toArray()
    texts = F.from_json(F.lit(json.dumps([FAMILIES[f] for f in sorted(FAMILIES)] + [[], []])), "array<array<string>>")
    model = {
        "templates": spark.range(1).select(F.transform(texts, lambda ts: F.transform(ts, grams))).first()[0],
        "grams": {g: [round(float(x), 4) for x in weights[:, i]] for i, g in enumerate(counted.vocabulary) if weights[:, i].any()},
        "bias": [round(float(x), 4) for x in biases], "threshold": 0.0,
    }
    # Half way between what unseen notices get for their own family and what others get for any.
    held = rows.where("held").withColumn("p", probabilities(F.col("grams"), model))
    own = F.element_at("p", F.col("label").cast("int") + 1)
    low, high = held.agg(
        F.percentile(F.when(F.col("label") < len(FAMILIES), own), F.lit(0.05)),
        F.percentile(F.when(F.col("label") == len(FAMILIES) + 1, F.array_max(F.slice("p", 1, len(FAMILIES) + 1))), F.lit(0.95)),
    ).first()
    model["threshold"] = min(0.9, max(0.3, ((low or 0.5) + (high or 0.5)) / 2))
    words = sorted({w for g in model["grams"] for w in g.split()})
    seen = rows.where(F.col("label") == len(FAMILIES) + 1).select(F.explode("grams").alias("w")).where(F.col("w").isin(words))
    model["essential"] = essential_words(model, {r["w"]: r["count"] for r in seen.groupBy("w").count().collect()})
    return model


def essential_words(model: dict, frequency: dict[str, int]) -> list[str]:
    """Words of which a unit needs one to get any class but unknown.

    A class can only win with a probability of at least the threshold ``t``, so its score must
    exceed that of unknown by ``log(t / (1 - t))``.  Words leave the set, the most frequent
    first, while the bias and all positive margins of the grams without an essential word
    stay below that for every class.
    """
    t, bias = model["threshold"], model["bias"]
    room = [math.log(t / (1 - t)) - (b - bias[-1]) - 1e-6 for b in bias[:-1]]
    margins = {g: [max(0.0, x - w[-1]) for x in w[:-1]] for g, w in model["grams"].items()}
    kept = {w for g in margins for w in g.split()}
    if min(room) <= 0:  # the biases alone suffice: every unit is scored
        return []
    for word in sorted(kept, key=lambda w: (-frequency.get(w, 0), w)):
        free = [m for g, m in margins.items() if not any(w in kept and w != word for w in g.split())]
        if all(sum(column) < r for column, r in zip(zip(*free), room)):
            kept.discard(word)
    return sorted(kept)


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: an expression named twice is computed
    twice, and once per element inside another's lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def probabilities(found: Column, model: dict) -> Column:
    """Class probabilities of a paragraph's grams, in label order."""
    size = len(model["bias"])
    parts: list[dict] = [{} for _ in range(SHELVES)]  # short maps, as a map is searched from its start
    for g, w in model["grams"].items():
        parts[xxhash.xxh64_intdigest(g.encode(), 42) % SHELVES][g] = w
    shelves = F.from_json(F.lit(json.dumps(parts)), "array<map<string, array<double>>>")
    zero = F.array(*[F.lit(0.0)] * size)
    total = F.aggregate(
        found, F.array(*map(F.lit, model["bias"])), lambda acc, g: F.zip_with(acc, F.coalesce(F.try_element_at(F.element_at(shelves, (F.pmod(F.xxhash64(g), F.lit(SHELVES)) + 1).cast("int")), g), zero), lambda a, b: a + b)
    )
    odds = bound(total, lambda t: bound(F.array_max(t), lambda top: F.transform(t, lambda x: F.exp(x - top))))
    return bound(odds, lambda o: bound(F.aggregate(o, F.lit(0.0), lambda a, b: a + b), lambda whole: F.transform(o, lambda x: x / whole)))


def finding(paragraph: Column, unit: Column, model: dict) -> Column:
    """Prediction for one unit: family, whether confirmed, cover by its best template, probability."""
    names = F.array(*[F.lit(f) for f in sorted(FAMILIES)], F.lit(OTHER), F.lit(UNKNOWN))
    texts = F.from_json(F.lit(json.dumps(model["templates"])), "array<array<array<string>>>")

    def of(own: Column, p: Column) -> Column:
        best = F.array_max(p)  # of few classes
        at = F.array_position(p, best).cast("int")
        cover = F.coalesce(F.array_max(F.transform(F.element_at(texts, at), lambda t: F.size(F.array_intersect(t, own)) / F.size(t))), F.lit(0.0))
        family = F.when(best < model["threshold"], F.lit(UNKNOWN)).otherwise(F.element_at(names, at))
        return F.struct(
            paragraph.alias("paragraph"), family.alias("family"), ((cover >= COVER) & ~unit.rlike(NEGATED)).alias("confirmed"),
            cover.alias("cover"), best.alias("probability"),
        )

    return bound(grams(unit), lambda own: bound(probabilities(own, model), lambda p: of(own, p)))


def units(body: Column) -> Column:
    """Lines and windows of a text's paragraphs, each with the number of its paragraph from 0."""
    lines = F.transform(lines_of(body), lambda line: F.when(line.rlike("[\\p{L}\\p{N}]"), line).otherwise(""))
    paragraphs = F.filter(F.split(F.array_join(lines, "\n"), "\n{2,}"), lambda p: F.trim(F.translate(p, "\n", " ")) != "")

    def unit(i: Column, text: Column) -> Column:
        return F.struct(i.alias("paragraph"), text.alias("unit"))

    def windows(i: Column, words: Column, several: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - WINDOW // 2 - 1, F.lit(0)), F.lit(WINDOW // 2))
        all_starts = F.when(several | (F.size(words) > WINDOW), starts).otherwise(F.array().cast("array<int>"))
        return F.transform(all_starts, lambda s: unit(i, F.array_join(F.slice(words, s + 1, WINDOW), " ")))

    def of(paragraph: Column, i: Column) -> Column:
        words = F.split(F.trim(F.translate(paragraph, "\n\t", "  ")), " +")
        short = F.filter(F.split(paragraph, "\n"), lambda line: F.size(F.split(line, "[ \t]+")) <= WINDOW)
        return F.concat(F.transform(short, lambda line: unit(i, line)), bound(words, lambda ws: windows(i, ws, F.contains(paragraph, F.lit("\n")))))

    return F.flatten(F.transform(paragraphs, of))


def scan(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text", prune: bool = True) -> DataFrame:
    """``key``, ``families`` (confirmed, ascending), ``n_unconfirmed`` and ``findings``: for
    each paragraph and family predicted in it the paragraph's number from 0, family, whether
    confirmed, cover and probability.  ``prune=False`` scores all units, with the same result."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    essential = F.array(*map(F.lit, model["essential"]))

    def may_win(c: Column) -> Column:
        return F.arrays_overlap(words_of(c), essential) if prune and model["essential"] else F.lit(True)

    asked = F.filter(F.when(may_win(body), units(body)).otherwise(F.array().cast("array<struct<paragraph: int, unit: string>>")), lambda u: may_win(u["unit"]))
    found = docs.select(F.col(key).alias(key), asked.alias("asked")).select(
        key, F.array_sort(F.filter(F.transform("asked", lambda u: finding(u["paragraph"], u["unit"], model)), lambda f: f["family"] != UNKNOWN)).alias("all")
    )
    # Sorted by paragraph and family, the best of each is the last.
    following = lambda i: F.get(F.col("all"), i + 1)
    best = F.filter("all", lambda f, i: ~(following(i)["paragraph"].eqNullSafe(f["paragraph"]) & following(i)["family"].eqNullSafe(f["family"])))
    found = found.select(key, best.alias("findings"))
    sure = F.filter("findings", lambda f: f["confirmed"])
    return found.select(
        key, F.array_sort(F.array_distinct(F.transform(sure, lambda f: f["family"]))).alias("families"),
        (F.size("findings") - F.size(sure)).alias("n_unconfirmed"), "findings",
    )
