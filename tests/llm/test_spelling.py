"""Spelling variants against a comparison of all pairs."""

import re
import zlib
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st

from helpers import documents, rng, words

from weatherlake.llm import spelling
from weatherlake.llm.spelling import count_words, group_variants, with_slips


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, vs in near.items():
        if vs:
            best = min(vs, key=lambda v: (-counts[v], v))
            if counts[best] >= 2 * counts[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()}


def run(spark, counts):
    out = group_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def edited(r, w):
    i, c = r.randrange(len(w)), r.choice("abßéz")
    return r.choice([w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:]])


def test_against_all_pairs(spark):
    r = rng(3)
    base = [w for w in set(words(r, 150)) if len(w) > 2]
    counts = {w: r.randint(1, 50) for w in base}
    for w in base:
        for _ in range(3):
            v = edited(r, w)
            if v:
                counts.setdefault(v, r.randint(1, 50))
    assert run(spark, counts) == brute(counts)


def test_tiles_give_the_same(spark, monkeypatch):
    # one beginning holds most words, so its block is cut into many tiles
    monkeypatch.setattr(spelling, "TILE", 16)
    monkeypatch.setattr(spelling, "TOGETHER", 24)
    r = rng(4)
    counts = {"over" + w: r.randint(1, 99) for w in ["".join(r.choice("abcd") for _ in range(4)) for _ in range(200)]}
    assert run(spark, counts) == brute(counts)


@settings(max_examples=15, deadline=None)
@given(st.dictionaries(st.text("abé", min_size=1, max_size=6), st.integers(1, 20), min_size=1, max_size=40))
def test_short_words_of_few_letters(spark, counts):
    assert run(spark, counts) == brute(counts)


def test_chains_of_forms_end_at_the_root(spark):
    counts = {"a" * k + "b" * (20 - k): 2 ** k for k in range(18)}
    assert run(spark, counts) == brute(counts)
    assert {x[2] for x in run(spark, counts)} == {"a" * 17 + "b" * 3}


def test_nulls_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([("hello", 2), ("hello", 3), ("hallo", 1), (None, 5), ("hullo", None), ("other", 0)], "word string, n long")
    assert {tuple(r) for r in group_variants(frame).collect()} == {("hello", None, "hello", 5, 1, None), ("hallo", "hello", "hello", 1, 1, 5)}
    assert group_variants(frame.limit(0)).collect() == []
    with pytest.raises(ValueError):
        group_variants(frame, ratio=1.5)


def python_words(rows, every=97):
    found = Counter()
    for doc, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            if h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            found[w] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


@pytest.mark.parametrize("every", [2, 97])
def test_words_of_texts(spark, every):
    r = rng(5)
    vocabulary = words(r, 60) + ["Éclair", "ÉCLAIR", "naïve", "Straße", "a×b÷c", "éèêëé"]
    rows = [(k, " ".join(r.choice(vocabulary) + r.choice(["", ".", "'s", "3", "\u0100", "\U0001f600"]) for _ in range(80))) for k in range(40)]
    rows += [(900, None), (901, ""), (902, "hello" * 30000 + " hello, hello HELLO"), (None, "hello hello hello"), (5, rows[5][1])]
    docs = documents(spark, rows).selectExpr("doc_id", "text", "1 as word", "2 as run", "3 as n", "4 as doc")
    assert {r.word: r.n for r in count_words(docs, seen_as=with_slips(every)).collect()} == python_words(rows, every)
    assert count_words(docs.limit(0)).collect() == []


def test_query(spark, tmp_path):
    r = rng(6)
    vocabulary = [w for w in words(r, 80) if len(w) >= 4]
    rows = [(k, " ".join(r.choice(vocabulary) for _ in range(200))) for k in range(60)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(x) for x in spelling.op13_variants(spark, str(tmp_path)).collect()}
    assert got == brute(python_words(rows)) and any(x[1] for x in got)
