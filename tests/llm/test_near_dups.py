import re

import pytest

from pyspark.sql import functions as F

from helpers import documents, rng, words
from weatherlake.llm.near_dups import SKETCHED, TABLES, _sketcher, first_meeting, near_duplicates


def brute(rows, size, share=80):
    sets = {}
    for i, t in rows:
        w = [x.encode() for x in re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))]
        sets[i] = {tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 0))} or ({tuple(w)} if w else set())
    label = {i: i for i in sets}
    ids = sorted(sets)
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= share * len(sets[a] | sets[b])
             and sets[b]]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return {(i, len(sets[i]), label[i], label[i] == i) for i in ids}


def edited(r, w, n):
    w = list(w)
    for k in r.sample(range(len(w)), n):
        w[k] = "x" + str(r.randint(0, 10**6))
    return w


@pytest.mark.parametrize("size", [2, 5])
def test_against_brute_force(spark, size):
    r = rng(size)
    rows, i = [], 0
    for _ in range(25):
        base = words(r, r.randint(1, 120))
        for _ in range(r.randint(1, 6)):
            rows.append((i, " ".join(edited(r, base, r.randint(0, max(0, len(base) // 25))))))
            i += 1
    hub = words(r, 100)  # a chain: every step is near the one before, the ends are far apart
    for _ in range(30):
        rows.append((i, " ".join(hub)))
        hub = edited(r, hub, 2)
        i += 1
    rows += [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "One"), (i + 4, "one"), (i + 5, "one two"), (i + 6, "One\ttwo")]
    got = {tuple(x) for x in near_duplicates(documents(spark, rows), size=size).collect()}
    assert got == brute(rows, size)


def test_edge_cases(spark):
    long = " ".join(words(rng(3), 60000))
    rows = [(1, long), (2, long.upper()), (2, long.upper()), (None, long), (None, "alone here"), (5, "")]
    df = documents(spark, rows).selectExpr("*", "1 as component_id", "'x' as cid", "2 as hub")
    got = sorted((tuple(x) for x in near_duplicates(df).collect()), key=str)
    n = got[0][1]
    assert got == sorted([(1, n, 1, True), (2, n, 1, False), (2, n, 1, False), (None, n, 1, False), (None, 1, None, True), (5, 0, 5, True)], key=str)
    assert near_duplicates(documents(spark, [])).count() == 0


def test_components_of_chains_and_hubs(spark):
    from weatherlake.llm.components import connected_components
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, k) for k in range(1001, 1100)] + [(7, 7), (1050, 200)]
    got = {tuple(x) for x in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {(k, 0) for k in range(1, 61)} | {(k, 200) for k in range(1000, 1100)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_every_pair_that_shares_tables_meets_at_one(spark):
    r = rng(11)
    rows = []
    for k in range(1500):
        base = words(r, 60)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(edited(r, base, 3)))]
    made = documents(spark, rows).mapInArrow(_sketcher(2), SKETCHED)
    side = made.select(F.floor(F.col("id") / 2).alias("pair"), (F.col("id") % 2).alias("second"), F.struct(*[c for c in made.columns if c != "id"]).alias("info"))
    pairs = side.filter("second = 0").select("pair", F.col("info").alias("p")).join(side.filter("second = 1").select("pair", F.col("info").alias("q")), "pair")
    places = [F.when((F.col("p.a")[i] == F.col("q.a")[i]) & (F.col("p.b")[j] == F.col("q.b")[j]), i * TABLES + j) for i in range(TABLES) for j in range(TABLES)]
    shared = pairs.select("pair", "p", "q", F.explode(F.array_compact(F.array(*places))).alias("place")).cache()
    assert shared.select("pair").distinct().count() > 1400
    met = shared.filter(first_meeting("p", "q", "place")).groupBy("pair").count().collect()
    assert len(met) == shared.select("pair").distinct().count() and {x["count"] for x in met} == {1}


def test_only_table_keys_of_shared_halves_are_made(spark, monkeypatch):
    from weatherlake.llm import near_dups
    r = rng(13)
    rows = [(k, " ".join(words(r, 50))) for k in range(300)]  # nobody's duplicates
    for k in range(10):
        base = words(r, 60)
        rows += [(1000 + 2 * k, " ".join(base)), (1001 + 2 * k, " ".join(edited(r, base, 2)))]
    given, whole = [], near_dups.linked_groups
    monkeypatch.setattr(near_dups, "linked_groups", lambda keys, *more: given.append(keys) or whole(keys, *more))
    got = {tuple(x) for x in near_duplicates(documents(spark, rows), size=2).collect()}
    assert got == brute(rows, 2)
    assert int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
    made = documents(spark, rows).mapInArrow(_sketcher(2), SKETCHED).select("cid", F.posexplode("a").alias("i", "x"), "b")
    every = made.select("cid", "i", "x", F.posexplode("b").alias("j", "y")).select(
        F.xxhash64("x", "y").alias("key"), (F.col("i") * TABLES + F.col("j")).alias("place"), F.col("cid").alias("node"))
    shared = every.join(every.groupBy("key").count().filter("count > 1"), "key", "left_semi")
    assert shared.count() > 100 and shared.exceptAll(given[0].select("key", "place", "node")).isEmpty()
    assert given[0].count() < every.count() / 4
