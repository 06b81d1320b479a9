import math

import numpy as np
import pytest

from helpers import documents, rng, words
from weatherlake.llm import quality
from weatherlake.llm.language import BUCKETS, fit_language_model, identify_language, is_held_out, presence
from weatherlake.llm.licences import _grams, _words, fit_licence_model, scan_licences
from weatherlake.llm.textarrays import buffers

import pyarrow as pa

ALPHABETS = {"aa": "an er the in".split(), "bb": "que la ou eau".split(), "cc": "ung sch ein ge".split()}


def in_language(r, lang, n):
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    r = rng(1)
    rows = [(k, in_language(r, lang, 40), lang) for k, lang in enumerate(list(ALPHABETS) * 40)] + [(999, None, "aa"), (998, "x", None)]
    return fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_language_held_out(spark, model):
    r = rng(2)
    rows = [(k, in_language(r, lang, r.randint(3, 60)).upper() + " 123 $$$") for k, lang in enumerate(list(ALPHABETS) * 30)]
    got = {x.doc_id: x.lang_pred for x in identify_language(documents(spark, rows), model).collect()}
    assert np.mean([got[k] == list(ALPHABETS)[k % 3] for k in got]) >= 0.97


def test_language_edge_cases(spark, model):
    long = in_language(rng(3), "bb", 100000)
    rows = [(1, None), (2, ""), (3, "12 !! ..."), (4, long), (4, long), (None, "the an"), (5, "中文字"), (6, "→ ∑")]
    df = documents(spark, rows).selectExpr("*", "'x' as lang_pred", "1 as bits")
    got = identify_language(df, model)
    assert got.columns == ["doc_id", "text", "bits", "lang_pred", "score"]
    found = {x.doc_id: (x.lang_pred, x.score) for x in got.collect()}
    assert found[1] == found[2] == found[3] == found[6] == ("und", 0.0) and found[4][0] == "bb" and found[None][0] == "aa"
    assert found[5][0] in ALPHABETS and 0 <= found[5][1] < 0.36
    assert identify_language(documents(spark, []), model).count() == 0
    nothing = fit_language_model(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert [x.lang_pred for x in identify_language(documents(spark, [(1, "the")]), nothing).collect()] == ["und"]


def test_presence_is_that_of_each_text_alone():
    texts = ["Abc é", "", "c", "abcabc"]
    data, at = buffers(pa.array(texts))
    x = presence(data, at)
    assert x.shape == (4, BUCKETS) and x[1].sum() == 0
    for k, t in enumerate(texts):
        assert np.array_equal(x[k:k + 1], presence(*buffers(pa.array([t]))))
    assert np.array_equal(presence(*buffers(pa.array(["ÉA"]))), presence(*buffers(pa.array(["éa"]))))


def test_held_out(spark):
    import zlib
    rows = spark.range(50).select("id", is_held_out("id").alias("h"), is_held_out("id", 5, 0).alias("g")).collect()
    assert all(x.h == (zlib.crc32(str(x.id).encode()) % 4 == 2) and x.g == (zlib.crc32(str(x.id).encode()) % 5 == 0) for x in rows)


def test_chain_marginals_by_enumeration():
    import itertools
    r = np.random.default_rng(0)
    gain, pair = r.normal(size=(5, 3)), r.normal(size=(2, 2))
    mask = np.arange(5)[:, None] < np.array([5, 3, 1])
    gain = np.where(mask, gain, 0)
    good, z, moves = quality.chain_marginals(gain, mask, pair)
    total = np.zeros((2, 2))
    for row, n in enumerate((5, 3, 1)):
        paths = {p: sum(gain[t, row] * p[t] for t in range(n)) + sum(pair[p[t], p[t + 1]] for t in range(n - 1))
                 for p in itertools.product((0, 1), repeat=n)}
        norm = np.logaddexp.reduce(list(paths.values()))
        assert np.isclose(norm, z[row])
        for t in range(n):
            assert np.isclose(sum(np.exp(s - norm) for p, s in paths.items() if p[t]), good[t, row])
        for p, s in paths.items():
            for t in range(n - 1):
                total[p[t], p[t + 1]] += np.exp(s - norm)
    assert np.allclose(total, moves)


def test_quality_held_out_and_edge_cases(spark):
    r = rng(4)
    rows, labels = [], []
    for k in range(400):
        good = k % 3 > 0
        lines = [" ".join(words(r, r.randint(3, 15))) + "." for _ in range(r.randint(1, 6))]
        rows.append((k, "\n".join(lines if good else [x.replace(" ", "### ") for x in lines])))
        labels.append((k, int(good)))
    docs, marks = documents(spark, rows), spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, quality int")
    model = quality.fit_quality_model(docs, marks.filter("doc_id % 5 <> 0 or doc_id is null"))
    extra = [(1000, None), (1001, ""), (1002, "\n \n"), (1003, rows[1][1] * 3000), (1003, rows[1][1] * 3000), (None, "fine text here.")]
    df = documents(spark, rows[::5] + extra).selectExpr("*", "'s' as score", "1 as label", "2 as x")
    got = quality.score_quality(df, model)
    assert got.columns == ["doc_id", "text", "label", "x", "score", "predicted", "line_good"]
    found = {x.doc_id: x for x in got.collect()}
    assert np.mean([found[k].predicted == labels[k][1] for k in range(0, 400, 5)]) >= 0.95
    assert found[1000].score == found[1001].score == found[1002].score == model.prior and found[1001].line_good == []
    assert all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) for x in found.values())
    flat = quality.fit_quality_model(docs, marks.filter("quality = 1"))
    assert [x.score for x in quality.score_quality(documents(spark, rows[:2]), flat).collect()] == [pytest.approx(0.9999)] * 2
    assert quality.score_quality(documents(spark, []), model).count() == 0


def test_licences(spark):
    body = "Some text about weather.\n\n{}\nThe end, with permission to stay."
    said = {1: ("Released under the MIT License.", "MIT"), 2: ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
            3: ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"), 4: ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
            5: ("you may redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software "
                "Foundation; either version 3 of the License, or any later version", "GPL-3.0")}
    rows = [(k, body.format(t)) for k, (t, _) in said.items()]
    rows += [(10, "A driving license is needed.\nLicensed under our own terms.\nApache helicopters"), (11, None), (12, ""), (13, "\n\n"),
             (14, "word " * 100000 + "\nMIT License"), (14, "word " * 100000 + "\nMIT License"), (None, "SPDX-License-Identifier: MIT")]
    got = scan_licences(documents(spark, rows).selectExpr("*", "'f' as family", "1 as gram", "2 as line")).collect()
    assert {(x.doc_id, x.paragraph, x.family) for x in got if x.confirmed} == (
        {(k, 2, f) for k, (_, f) in said.items()} | {(14, 1, "MIT"), (None, 0, "MIT")})
    assert len(got) == len({(x.doc_id, x.paragraph) for x in got}) and all(0.5 <= x.probability <= 1 for x in got)
    assert scan_licences(documents(spark, [])).count() == 0


def test_licences_are_scored_without_shuffling_paragraphs(spark):
    lines = ["Released under the MIT License.", "License: Apache-2.0", "See the ISC License for details, MIT and MIT again", "The GNU GPL version 2, a license"]
    rows = [(k % 3, "\n".join(lines[k:] + lines[:k])) for k in (0, 1, 2, 3, 0)] + [(None, lines[0]), (None, lines[0])]  # no other paragraphs: no background
    found = scan_licences(documents(spark, rows), least=0.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(id") == 1  # the predictions; n-grams and scores stay within their row
    model = fit_licence_model([])

    def probabilities(line):
        hits = {g: model["weights"][k].round(6) for k, g in enumerate(model["vocabulary"]) if g in _grams(_words(line))}
        z = (sum(hits.values()) + model["bias"]) / model["temperature"]
        return dict(zip(model["classes"], np.exp(z - z.max()) / np.exp(z - z.max()).sum(), strict=True))

    got = found.collect()
    assert len(got) == 4 * 4 + 1 == len({(x.doc_id, x.paragraph, x.line) for x in got})
    for x in got:
        p = probabilities(x.line)
        assert x.family == max(p, key=p.get) and x.probability == pytest.approx(p[x.family])


def test_repeated_ids_stay_within_the_sample(spark):
    r = rng(12)
    rows = [(7, in_language(r, "aa", 10) if k % 2 else "x", "aa") for k in range(20_000)] + [(k, in_language(r, "bb", 20), "bb") for k in range(100, 140)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_language_model(df, per_language=30)
    assert model.languages == ("aa", "bb")
    assert [x.lang_pred for x in identify_language(documents(spark, [(1, in_language(r, "bb", 30))]), model).collect()] == ["bb"]
    docs = documents(spark, [(7, f"line {k}.") for k in range(20_000)] + [(k, "b### a###") for k in range(100, 140)])
    fitted = quality.fit_quality_model(docs, spark.createDataFrame([(7, 1)] + [(k, 0) for k in range(100, 140)], "doc_id long, quality int"), train_docs=10)
    assert 0 <= fitted.prior <= 0.5


def test_against_the_exact_kernel(spark, model):
    """Nystroem scores against kernel ridge regression on all training texts."""
    r = rng(21)
    train = [(in_language(r, lang, 30), k) for k, lang in enumerate(ALPHABETS) for _ in range(40)]
    test = [(in_language(r, lang, 20), k) for k, lang in enumerate(ALPHABETS) for _ in range(20)]

    def kernel(a, b):
        x, y = (presence(*buffers(pa.array([t for t, _ in s]))).astype(float) for s in (a, b))
        return (x @ y.T) / np.sqrt(np.outer(x.sum(1), y.sum(1)))

    target = np.where(np.array([k for _, k in train])[:, None] == np.arange(3), 1.0, -1.0)
    exact = kernel(test, train) @ np.linalg.solve(kernel(train, train) + 1e-3 * np.eye(len(train)), target)
    rows = [(k, t, list(ALPHABETS)[c]) for k, (t, c) in enumerate(train)]
    fitted = fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = identify_language(documents(spark, [(k, t) for k, (t, _) in enumerate(test)]), fitted).orderBy("doc_id").collect()
    assert np.mean([fitted.languages.index(g.lang_pred) == e for g, e in zip(got, exact.argmax(1))]) >= 0.97


def test_document_quality_is_the_weighted_mean_of_its_lines(spark):
    """The document's score from marginals by enumeration, on short documents."""
    import itertools
    r = rng(31)
    rows = [(k, "\n".join(" ".join(words(r, r.randint(2, 9))) + (" ###" if (k + j) % 3 else ".") for j in range(r.randint(1, 4)))) for k in range(60)]
    model = quality.fit_quality_model(documents(spark, rows), spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id long, quality int"))
    for (_, text), got in zip(rows[:15], quality.score_quality(documents(spark, rows[:15]), model).orderBy("doc_id").collect()):
        data, offsets = buffers(pa.array([text]))
        x, length, _ = quality.line_features(data, offsets)
        gain = x @ model.weights
        paths = {p: sum(gain[t] * p[t] for t in range(len(x))) + sum(model.pair[p[t], p[t + 1]] for t in range(len(x) - 1))
                 for p in itertools.product((0, 1), repeat=len(x))}
        norm = np.logaddexp.reduce(list(paths.values()))
        marginal = [sum(np.exp(s - norm) for p, s in paths.items() if p[t]) for t in range(len(x))]
        assert np.allclose(got.line_good, marginal, atol=2e-3)
        raw = min(max(float(np.dot(marginal, length) / length.sum()), 1e-4), 1 - 1e-4)
        logit = math.log(raw / (1 - raw))
        assert abs(got.score - 1 / (1 + math.exp(-(model.slope * logit + model.shift)))) < 0.02
