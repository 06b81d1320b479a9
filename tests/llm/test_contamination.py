from helpers import documents, rng, words
import pytest

from weatherlake.llm import contamination
from weatherlake.llm.contamination import MASKS, MIN_TOKENS, best_run, find_contamination, short_masks

import numpy as np


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def brute(docs, bench, least=5):
    """All diagonals of all pairs."""
    import re
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for d, t in docs:
        x = tok(t)
        for i, b in bench:
            y = tok(b)
            if len(y) < least:
                continue
            for shift in range(-len(y) + 1, len(x)):
                a, e = max(0, -shift), min(len(y), len(x) - shift)
                equal = np.array([y[k] == x[k + shift] for k in range(a, e)])
                s, f, _ = best_run(equal)
                # a long run, or the whole item, with four fifths equal
                if f - s >= MIN_TOKENS or len(equal) == len(y) and equal.mean() >= 0.8:
                    out.add((d, i))
    return out


def test_against_brute_force(spark):
    r = rng(1)
    bench = [(k, " ".join(words(r, n))) for k, n in enumerate([40, 40, 30, 20, 14, 13, 12, 8, 5, 4, 1])]
    docs = []
    for k in range(60):
        host = words(r, 60)
        _, b = bench[k % len(bench)]
        passage = b.split()
        for _ in range(k % 3):  # substitutions, well apart
            passage[r.randrange(len(passage))] = "zzz"
        at = r.randrange(60)
        part = passage if k % 4 else passage[:len(passage) // 2]
        docs.append((k, " ".join([*host[:at], *part, *host[at:]]).replace(" ", ", ", 3).title()))
    got = {(x.doc_id, x.item_id) for x in find_contamination(documents(spark, docs), items(spark, bench)).collect()}
    want = brute(docs, bench)
    assert got <= want
    assert len(want - got) <= 0.03 * len(want)  # a seed can miss where substitutions are dense
    assert len(want) > 20


def test_clean_documents_stay_clean(spark):
    r = rng(2)
    docs = [(k, " ".join(words(r, 200))) for k in range(40)]
    bench = [(k, " ".join(words(r, 30))) for k in range(20)]
    assert find_contamination(documents(spark, docs), items(spark, bench)).count() == 0


def test_edge_cases(spark):
    r = rng(3)
    passage = " ".join(words(r, 25))
    long = " ".join([*words(r, 20000), passage, *words(r, 20000)])
    docs = documents(spark, [(1, long), (1, long), (2, None), (3, ""), (None, passage), (4, passage + " " + passage), (5, "!!!")])
    bench = items(spark, [(7, passage), (7, passage), (8, None), (9, ""), (None, passage), (10, "a b")])
    got = find_contamination(docs.selectExpr("*", "1 as item_id", "2 as key", "3 as hits"), bench.selectExpr("*", "4 as id", "5 as doc_id"))
    rows = sorted(got.collect())
    assert [(x.doc_id, x.item_id, x.overlap_tokens, x.equal_tokens, x.item_tokens) for x in rows] == [(1, 7, 25, 25, 25), (4, 7, 25, 25, 25)]
    assert rows[0].doc_start == 20000 and rows[0].doc_end == 20025 and rows[0].item_start == 0
    assert find_contamination(documents(spark, []), bench).count() == 0
    assert find_contamination(docs, items(spark, [])).count() == 0


def test_best_run():
    assert best_run(np.array([True] * 5 + [False] + [True] * 6)) == (0, 12, 11)
    assert best_run(np.array([False, True, False, False])) == (1, 2, 1)
    assert best_run(np.zeros(3, bool))[2] == 0


def test_every_position_is_ignored_by_a_mask():
    for masks in (MASKS, *(short_masks(n) for n in range(5, 9))):
        assert all(any(m[k] == "0" for m in masks) for k in range(len(masks[0])))


@pytest.mark.parametrize("n", range(5, 19))
def test_one_replaced_word_at_any_position(spark, n):
    r = rng(100 + n)
    item = words(r, n)
    docs = []
    for k in range(n):
        passage = list(item)
        passage[k] = "zzz"
        docs.append((k, " ".join([*words(r, 12), *passage, *words(r, 12)])))
    docs.append((n, " ".join([*words(r, 20), *item])))
    found = {x.doc_id: x for x in find_contamination(documents(spark, docs), items(spark, [(1, " ".join(item))])).collect()}
    assert set(found) == set(range(n + 1))
    assert found[n].equal_tokens == found[n].overlap_tokens == n


def test_items_below_the_least_length(spark):
    docs = documents(spark, [(1, "some words before a b c and after"), (2, "nothing here")])
    bench = items(spark, [(1, "A B c"), (2, "")])
    assert find_contamination(docs, bench).count() == 0
    assert [x.doc_id for x in find_contamination(docs, bench, least_tokens=3).collect()] == [1]


def test_a_document_with_most_of_the_benchmark(spark, monkeypatch):
    monkeypatch.setattr(contamination, "UNIT", 8)
    r = rng(8)
    bench = [(k, " ".join(words(r, 20))) for k in range(60)]
    whole = " ".join(t for _, t in bench)
    found = find_contamination(documents(spark, [(1, f"{whole} {whole}"), (2, bench[3][1])]), items(spark, bench)).collect()
    assert {(x.doc_id, x.item_id) for x in found} == {(1, k) for k in range(60)} | {(2, 3)} and len(found) == 61
    assert all(x.doc_start == 20 * x.item_id for x in found if x.doc_id == 1)  # the first of two equal places
