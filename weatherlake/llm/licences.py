"""Licence scan: a trained paragraph classifier, confirmed by templates.

Every paragraph (line) is classified by multinomial logistic regression on the
presence of word unigrams and bigrams, into licence families or ``unknown``.
The vocabulary holds n-grams of licence statements only, so paragraphs without
any need no score: they are unknown.  The model is trained on statements made
from the templates below, shortened copies of them, near misses, and a bounded
sample of paragraphs of the documents (whole ones); a temperature fitted on held-out
frames, notices and paragraphs calibrates its probabilities.  A prediction is then compared with the
templates of its family and confirmed if enough words agree.

The scan itself uses DataFrame functions only.  A paragraph is scored within
its row: its n-grams are looked up in a table of weights that goes with the
plan (bounded by the templates' words) and summed, so only the predictions are
shuffled.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weatherlake.llm.shared import smallest_by_hash, table

UNKNOWN = "unknown"
SAMPLE = 2000  # paragraphs of the documents used as examples of unknown text

# Names by which licences are known, by family.
NAMES = {
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPL-3.0", "AGPLv3", "Affero General Public License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache-2.0", "Apache 2.0 License", "Apache Software License 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause", "Simplified BSD License", "two-clause BSD license"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause", "New BSD License", "three-clause BSD license"),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0 International License", "CC BY 4.0", "CC-BY-4.0"),
    "CC-BY-NC-4.0": ("Creative Commons Attribution-NonCommercial 4.0 International License", "CC BY-NC 4.0", "CC-BY-NC-4.0"),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC BY-SA 4.0", "CC-BY-SA-4.0"),
    "CC0-1.0": ("Creative Commons Zero 1.0 Universal", "CC0 1.0", "CC0-1.0", "CC0 public domain dedication"),
    "GPL-2.0": ("GNU General Public License, version 2", "GPL-2.0", "GPLv2", "GNU GPL version 2"),
    "GPL-3.0": ("GNU General Public License, version 3", "GPL-3.0", "GPLv3", "GNU GPL version 3"),
    "ISC": ("ISC License", "ISC license terms"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPL-3.0", "LGPLv3", "Lesser General Public License"),
    "MIT": ("MIT License", "MIT", "Expat License", "MIT license terms"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL-2.0", "MPL 2.0", "Mozilla Public License 2.0"),
    "Unlicense": ("The Unlicense", "Unlicense"),
}
# Sentences that licence notices of a family contain.
NOTICES = {
    "Apache-2.0": ("You may not use this file except in compliance with the License. You may obtain a copy of the License at apache org licenses LICENSE 2.0",
                   "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "MIT": ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    "BSD-2-Clause": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following two conditions are met",),
    "BSD-3-Clause": ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",),
    "GPL-2.0": ("You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 2 of the License",),
    "GPL-3.0": ("You can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",),
    "LGPL-3.0": ("You can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License",),
    "AGPL-3.0": ("You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License",),
    "MPL-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, you can obtain one at mozilla org MPL 2.0",),
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",),
    "Unlicense": ("This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",),
    "CC0-1.0": ("To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",),
}
FRAMES = ("{}", "Released under the {}.", "Licensed under {}.", "Licensed under the {}.", "This work is licensed under the {}.",
          "Distributed under the terms of the {}.", "SPDX-License-Identifier: {}", "This project is available under the {}.",
          "See the {} for details.", "License: {}", "Code is covered by the {}")
NEAR_MISSES = ("Licensed under our own terms.", "Released under the old bridge.", "This work is based on earlier work.", "All rights reserved.",
               "License plates must be renewed by version 3 of the form.", "He studied at MIT and worked in the public sector.",
               "The Apache helicopter was released in the second version.", "The general public was free to copy the notes.",
               "Permission is required to enter the building.", "A driving license is issued without restriction.", "Terms of use apply.",
               "The software was distributed in 2.0 million copies.", "Attribution of the painting is not certain.", "See the manual for details.",
               "The creative commons room is open to members.", "Copyright 2020 the authors.", "This file is part of the collection.",
               "Either version of the story is fine.", "The foundation published its free report.", "BSD is a common abbreviation.",
               "Redistribution of wealth and use of land are debated.", "The mozilla was seen in the zoo.", "Written permission is not needed.")


def _words(text: str) -> list[str]:
    return "".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split()


def _grams(words: list[str]) -> set[str]:
    return {*words, *(f"{a} {b}" for a, b in zip(words[:-1], words[1:], strict=True))}


def templates() -> list[tuple[str, str]]:
    """(family, statement) for every name in every frame, and the notices."""
    out = [(f, frame.format(n)) for f, names in NAMES.items() for n in names for frame in FRAMES]
    return out + [(f, t) for f, texts in NOTICES.items() for t in texts]


def _examples() -> list[tuple[str, str, bool]]:
    """Templates and copies that lack every k-th word, and the halves of
    notices: family, text, and whether calibration holds it out.  Whole frames
    and whole notices with all that is made of them are held out together."""
    out = []
    for f, names in NAMES.items():
        out += [(f, frame.format(n), k in (2, 7)) for n in names for k, frame in enumerate(FRAMES)]
    out += [(f, text + " Thanks to everyone who helped.", held) for f, text, held in out[:: 7]]
    for k, (f, text) in enumerate((f, t) for f, texts in NOTICES.items() for t in texts):
        words, held = text.split(), k % 4 == 2
        out.append((f, text, held))
        out += [(f, " ".join(w for i, w in enumerate(words) if i % n != n // 2), held) for n in (3, 5, 7)]
        out += [(f, " ".join(words[:len(words) // 2]), held), (f, " ".join(words[len(words) // 2:]), held)]
    return out + [(UNKNOWN, t, k % 5 == 2) for k, t in enumerate(NEAR_MISSES) for _ in range(3)]


def example_grams() -> list[str]:
    """The n-grams of all examples: what the classifier can look at."""
    return sorted({g for _, t, _ in _examples() for g in _grams(_words(t))})


def fit_licence_model(background: list[list[str]], rounds: int = 300, decay: float = 2e-4) -> dict:
    """Weights per n-gram and class, biases and temperature.  ``background``:
    of paragraphs that are no licence statement, those n-grams that
    ``example_grams`` has."""
    examples = [(f, _grams(_words(t)), held) for f, t, held in _examples()]
    examples += [(UNKNOWN, set(grams), k % 5 == 2) for k, grams in enumerate(background)]
    classes = [*sorted(NAMES), UNKNOWN]
    common: dict[str, int] = {}
    for grams in background:
        for g in set(grams):
            common[g] = common.get(g, 0) + 1
    often = {g for g, n in common.items() if n > 0.02 * max(len(background), 50)}
    vocabulary = sorted(set(example_grams()) - often)
    place = {g: i for i, g in enumerate(vocabulary)}
    x = np.zeros((len(examples), len(vocabulary)))
    for r, (_, grams, _) in enumerate(examples):
        x[r, [place[g] for g in grams if g in place]] = 1
    y = np.array([classes.index(f) for f, _, _ in examples])
    weight = 1.0 / np.bincount(y, minlength=len(classes))[y] * np.where(y == len(classes) - 1, 6.0, 1.0)
    weight /= weight.sum()
    target = np.eye(len(classes))[y]

    def fit(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w, b = np.zeros((x.shape[1], len(classes))), np.zeros(len(classes))
        m, v = np.zeros((x.shape[1] + 1, len(classes))), np.zeros((x.shape[1] + 1, len(classes)))
        for step in range(1, rounds + 1):
            error = (target[rows] - _softmax(x[rows] @ w + b)) * weight[rows, None]
            grad = np.vstack([x[rows].T @ error - decay * w, error.sum(0)])
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
            move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
            w, b = w + move[:-1], b + move[-1]
        return w, b

    held = np.array([h for _, _, h in examples])
    w, b = fit(np.flatnonzero(~held))
    z = x[held] @ w + b
    loss = {t: -(np.log(_softmax(z / t)[np.arange(held.sum()), y[held]] + 1e-12) * weight[held]).sum()
            for t in (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)}
    w, b = fit(np.arange(len(examples)))
    return {"classes": classes, "vocabulary": vocabulary, "weights": w, "bias": b, "temperature": min(loss, key=loss.get)}


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _inline(spark: SparkSession, rows: list[dict], kind: str) -> DataFrame:
    """A small table from a JSON literal."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")).alias("r")).select("r.*")


def _word_array(line: str) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.col(line)), "[^a-z0-9]+", " ")), " ")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """With a column that is computed once per row: a filter on it stays above,
    where an ordinary column would be computed again in the filter."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def _weights(spark: SparkSession, model: dict) -> tuple[list[int], Callable[[Column], Column]]:
    """The hashes of the vocabulary, and a function that gives the weights
    (an array, by class) of such a hash, found among the few of its bucket."""
    grams = _inline(spark, [{"at": k, "ws": g.split(" ")} for k, g in enumerate(model["vocabulary"])], "at int, ws array<string>")
    hashes = [r.h for r in grams.select("at", F.xxhash64(F.get("ws", F.lit(0)), F.get("ws", F.lit(1))).alias("h")).orderBy("at").collect()]
    buckets = 1 << len(hashes).bit_length()
    table: list[list[dict]] = [[] for _ in range(buckets)]
    for h, row in zip(hashes, model["weights"], strict=True):
        table[h % buckets].append({"h": h, "w": [round(float(v), 6) for v in row]})
    found = F.from_json(F.lit(json.dumps(table)), "array<array<struct<h: bigint, w: array<double>>>>")  # constant: read once

    def of(gram: Column) -> Column:
        few = F.get(found, F.pmod(gram, F.lit(buckets)).cast("int"))
        return F.get(few["w"], (F.array_position(few["h"], gram) - 1).cast("int"))

    return hashes, of


def _paragraphs(docs: DataFrame, id: str, text: str) -> DataFrame:
    return (docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), F.posexplode(F.split(text, "\n")).alias("paragraph", "line"))
            .filter(F.trim("line") != ""))


def scan_licences(docs: DataFrame, *, id: str = "doc_id", text: str = "text", least: float = 0.5, overlap: float = 0.6) -> DataFrame:
    """Paragraphs that state a licence.

    Columns: ``doc_id``, ``paragraph`` (line number from 0), ``line``,
    ``family``, ``probability`` (at least ``least``; all others are unknown
    and have no row), ``similarity`` (Dice overlap of the words with the best
    template of the family) and ``confirmed`` (similarity at least
    ``overlap``, or at least four template words that make up 80 % of the
    line).  Null and empty texts have no paragraphs; rows that repeat id and
    text are reported once; a null id is reported like any other; equal
    probabilities go to the first family in alphabetical order; an empty table
    gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    paragraphs = _paragraphs(docs, id, text)
    others = paragraphs.select("line").filter(~F.lower("line").rlike("licen[cs]|copyright|warrant|redistribut|public domain|spdx|gpl"))
    # whole paragraphs, but only what the classifier can look at: bounded however long they are
    seen = _inline(spark, [{"seen": example_grams()}], "seen array<string>").scalar()
    words = _word_array("line")
    both = F.transform(F.arrays_zip(words.alias("a"), F.slice(words, 2, 1 << 30).alias("b")), lambda p: F.concat_ws(" ", p["a"], p["b"]))
    sample = smallest_by_hash(others, F.xxhash64("line"), SAMPLE, "line")
    background = [r.grams for r in sample.select(F.array_intersect(F.concat(words, both), seen).alias("grams")).collect()]
    model = fit_licence_model(background)
    classes = model["classes"]
    vocabulary, weights = _weights(spark, model)

    pair = F.arrays_zip(F.col("ws").alias("a"), F.slice(F.col("ws"), 2, 1 << 30).alias("b"))
    grams = F.concat(F.transform("ws", lambda w: F.xxhash64(w)), F.transform(pair, lambda p: F.xxhash64(p["a"], p["b"])))
    hits = F.array_distinct(F.filter(grams, lambda g: g.isin(vocabulary)))
    keys = ["id", "version", "paragraph", "line"]
    spoken = _once(paragraphs.withColumn("ws", _word_array("line")), "hits", hits).filter(F.size("hits") > 0).select(*keys, "hits")
    bias = F.array(*[F.lit(float(v)) for v in model["bias"]])
    z = F.aggregate("hits", F.array_repeat(F.lit(0.0), len(classes)), lambda s, g: F.zip_with(s, weights(g), lambda x, y: x + y),
                    lambda s: F.zip_with(s, bias, lambda x, y: (x + y) / float(model["temperature"])))
    scored = _once(spoken, "z", z).withColumn("top", F.array_max("z"))
    scored = scored.select(
        *keys, F.array(*[F.lit(c) for c in classes])[F.array_position("z", F.col("top")).cast("int") - 1].alias("family"),
        (1 / F.aggregate("z", F.lit(0.0), lambda s, v: s + F.exp(v - F.col("top")))).alias("probability"))
    scored = scored.filter((F.col("family") != UNKNOWN) & (F.col("probability") >= least)).dropDuplicates(keys)

    known = _inline(spark, [{"family": f, "words": sorted(set(_words(t)))} for f, t in templates()], "family string, words array<string>")
    known = known.groupBy("family").agg(F.collect_list("words").alias("templates"))  # a few dozen of each family
    own = F.array_distinct(_word_array("line"))
    compared = scored.join(F.broadcast(known), "family").withColumn("own", own)
    similarity = F.array_max(F.transform("templates", lambda t: 2.0 * F.size(F.array_intersect(t, "own")) / (F.size(t) + F.size("own"))))
    inside = F.exists("templates", lambda t: (F.size(F.array_intersect(t, "own")) >= 4)
                      & (F.size(F.array_intersect(t, "own")) >= 0.8 * F.size("own")))
    return compared.select(F.col("id").alias("doc_id"), "paragraph", "line", "family", "probability", similarity.alias("similarity"),
                           ((similarity >= overlap) | inside).alias("confirmed"))


def op10_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents"))
