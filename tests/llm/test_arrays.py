import math

import numpy as np
import pytest

from helpers import documents, rng, words
from weatherlake.llm import pieces as P
from weatherlake.llm.neighbours import nearest_neighbours
from weatherlake.llm.sharding import place, shard_documents


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


@pytest.mark.parametrize("dim", [1, 7, 64])
def test_neighbours_against_brute_force(spark, dim):
    r = np.random.default_rng(dim)
    x = (r.normal(size=(700, dim)) * r.lognormal(sigma=2, size=(700, 1))).astype(np.float32)
    x[100:160] = x[99]  # ties
    x[5] = 0
    rows = [(k, [float(v) for v in row]) for k, row in enumerate(x)]
    got = sorted(tuple(t) for t in nearest_neighbours(vectors(spark, rows), "vec_id % 20 = 0", 9).collect())
    want = []
    for q in range(0, 700, 20):
        scores = []
        for c in range(700):
            if c != q and c != 5:
                s = 0.0
                for a, b in zip(x[q].astype(float), x[c].astype(float)):
                    s += a * b
                scores.append((-s, c))
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(sorted(scores)[:9])]
    assert got == sorted(want)


def test_neighbours_edge_cases(spark):
    rows = [(0, [1.0, 2.0]), (20, [0.5, 0.5]), (1, None), (2, []), (3, [math.nan, 1.0]), (4, [math.inf, 1.0]), (5, [None, 1.0]), (6, [0.0, 0.0]),
            (7, [1.0, 1.0]), (7, [1.0, 1.0]), (8, [1.0, 2.0, 3.0]), (None, [9.0, 9.0])]
    got = sorted(tuple(x) for x in nearest_neighbours(vectors(spark, rows).selectExpr("*", "1 as dim", "2 as g", "3 as kind"), "vec_id % 20 = 0", 3).collect())
    assert got == [(0, 1, 7, 3.0), (0, 2, 7, 3.0), (0, 3, 20, 1.5), (20, 1, 0, 1.5), (20, 2, 7, 1.0), (20, 3, 7, 1.0)]
    assert nearest_neighbours(vectors(spark, []), "vec_id % 20 = 0").count() == 0
    assert nearest_neighbours(vectors(spark, [(0, [1.0])]), "vec_id % 20 = 0").count() == 0


def test_shards(spark):
    r = rng(1)
    rows = [(k, " ".join(words(r, r.randint(1, 80)))) for k in range(1500)] + [(2000 + k, "the copy of many") for k in range(700)]
    rows += [(5000, None), (5001, ""), (None, "x"), (1, rows[1][1])]
    got = shard_documents(documents(spark, rows).selectExpr("*", "1 as shard", "2 as piece", "3 as size"), 8).collect()
    assert len(got) == len(rows)
    by = {s: [x for x in got if x.shard == s] for s in range(8)}
    assert all(sorted(x.slot for x in xs) == list(range(len(xs))) for xs in by.values())
    size = [sum(x.size for x in xs) for xs in by.values()]
    assert max(size) - min(size) <= 64
    for m in ([sum(x.tokens for x in xs) for xs in by.values()], [len(xs) for xs in by.values()]):
        assert max(m) <= 1.15 * sum(m) / 8
    import zlib
    texts = dict(rows)
    assert all(x.size == 16 + len((texts[x.doc_id] or "").encode()) and x.text_crc32 == zlib.crc32((texts[x.doc_id] or "").encode()) for x in got)
    assert len({x.shard for x in got if x.doc_id == 1}) == 1 and len({x.shard for x in got if x.doc_id and 2000 <= x.doc_id < 2700}) > 1
    assert shard_documents(documents(spark, []), 8).count() == 0
    again = shard_documents(documents(spark, rows[::-1]), 8).collect()
    assert sorted(map(str, again)) == sorted(map(str, shard_documents(documents(spark, rows), 8).collect()))


def test_groups_that_fit_stay_whole(spark):
    r = rng(3)
    texts = [" ".join(words(r, r.randint(5, 40))) for _ in range(300)]
    rows = [(k, texts[min(r.randrange(300), r.randrange(300))]) for k in range(1000)]
    got = shard_documents(documents(spark, rows), 10).collect()
    of = dict(rows)
    shards = {}
    for x in got:
        shards.setdefault(of[x.doc_id], set()).add(x.shard)
    assert all(len(s) == 1 for s in shards.values())
    size = [sum(x.size for x in got if x.shard == s) for s in range(10)]
    assert max(size) <= 1.05 * sum(size) / 10


def test_placing_against_a_plain_version(monkeypatch):
    from weatherlake.llm import sharding
    r = np.random.default_rng(5)
    levelled = []
    for shards in (2, 3, 7):
        v = np.round(r.uniform(1, 50, size=(60, 3)))
        left = [[1.0, 1.0, 1.0] for _ in range(shards)]
        size = [[x / (v[:, m].sum() / shards) for m, x in enumerate(row)] for row in v]
        want = [0] * len(v)
        for i in sorted(range(len(v)), key=lambda i: -max(size[i])):
            dots = [sum(c * x for c, x in zip(left[s], size[i])) for s in range(shards)]
            want[i] = dots.index(max(dots))
            left[want[i]] = [c - x for c, x in zip(left[want[i]], size[i])]
        levelled.append((place(v, shards), v, shards))
        with monkeypatch.context() as m:
            m.setattr(sharding, "_level", lambda *a: None)
            assert place(v, shards).tolist() == want
    # levelling only narrows the gap of the first measure
    for s, v, shards in levelled:
        load = np.bincount(s, v[:, 0], shards)
        assert load.max() - load.min() <= 0.05 * load.mean()


def test_placing_prefers_the_largest_dot_product():
    v = np.array([[10.0, 1, 1], [1, 10, 1], [10, 1, 1], [1, 10, 1]])
    s = place(v, 2)
    assert np.bincount(s).tolist() == [2, 2] and s[0] != s[2] and s[1] != s[3]
    assert place(np.zeros((0, 3)), 3).tolist() == []


@pytest.fixture(scope="module")
def vocabulary():
    return P.Vocabulary.load(P.MODEL, 5.0)


def all_paths(vocabulary, text):
    names = {vocabulary.pieces[i]: int(i) for i in np.flatnonzero(vocabulary.plain)}

    def rec(s):
        if not s:
            yield ()
        for n in range(1, len(s) + 1):
            if s[:n] in names:
                for rest in rec(s[n:]):
                    yield (names[s[:n]], *rest)

    paths = list(rec(b" " + text.encode()))
    w = np.array([vocabulary.log_prob[list(p)].sum() for p in paths])
    return dict(zip(paths, w - np.logaddexp.reduce(w)))


def test_samples_follow_gumbel_top_k(vocabulary):
    for text in ("the in", "thorre"):
        paths = all_paths(vocabulary, text)
        n, k = 3000, 3
        s = P.Sampler(vocabulary, k, 0)
        out = s.sample(*s.prepared([text] * n), np.arange(n).astype(np.uint64))
        first, seen = dict.fromkeys(paths, 0), dict.fromkeys(paths, 0)
        total = 0.0
        for found in out:
            ids = [tuple(x[0].tolist()) for x in found]
            assert len(set(ids)) == k and [x[2] for x in found] == sorted((x[2] for x in found), reverse=True)
            assert all(np.isclose(paths[i], x[1]) for i, x in zip(ids, found))
            first[ids[0]] += 1
            for i in ids:
                seen[i] += 1
            total += sum(np.exp(x[1] - x[3]) for x in found)
        assert abs(total / n - 1) < 0.05  # inclusion scores weight the samples to one
        p = np.exp(list(paths.values()))
        assert np.abs(np.array(list(first.values())) / n - p).sum() / 2 < 0.05
        g = np.log(p) + np.random.default_rng(0).gumbel(size=(20000, len(p)))
        expected = np.bincount(np.argsort(-g, 1)[:, :k].ravel(), minlength=len(p)) / 20000
        assert np.abs(np.array(list(seen.values())) / n - expected).max() < 0.05


def test_all_paths_when_k_is_large(vocabulary):
    paths = all_paths(vocabulary, "a, b")
    s = P.Sampler(vocabulary, 50, 0)
    found = s.sample(*s.prepared(["a, b"]), np.array([3], np.uint64))[0]
    assert {tuple(x[0].tolist()) for x in found} == set(paths) and all(x[3] == 0.0 for x in found)


def test_round_trip_and_edge_cases(spark):
    odd = ["  two  blanks ", "tab\tand\nlines\r\n", "naïve é中文🙂 ͸", "", None, "x", "mark ▁ here", " " * 40, "\x00\x7f",
           " ".join(words(rng(1), 30000))]
    rows = [*enumerate(odd), (0, odd[0]), (None, "null key")]
    df = documents(spark, rows).selectExpr("*", "1 as samples", "2 as ids")
    out = P.sample_segmentations(df, k=3)
    assert out.columns == ["doc_id", "text", "ids", "samples", "round_trip"]
    got = out.collect()
    for x in got:
        if x.text is None:
            assert x.samples is None and x.round_trip is None
            continue
        assert x.round_trip and len({tuple(s.ids) for s in x.samples}) == len(x.samples) >= 1
    assert [len(x.samples) for x in got if x.text == ""] == [1] and len({str(x.samples) for x in got if x.doc_id == 0}) == 1
    flat = out.selectExpr("doc_id", "text", "explode(samples.ids) as ids")
    for x in P.decode_pieces(flat).collect():
        assert x.decoded == x.text.replace("▁", " ")
    again = {x.doc_id: str(x.samples) for x in P.sample_segmentations(documents(spark, rows[::-1]), k=3).collect()}
    assert again == {x.doc_id: str(x.samples) for x in got}
    assert P.sample_segmentations(documents(spark, [])).count() == 0
