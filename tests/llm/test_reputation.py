"""URL filter: rules by examples, propagation against dense matrices, the query against its SQL."""

import duckdb
import numpy as np
import pytest

from helpers import rng

from weatherlake.llm.reputation import DAMPING, RULES, SQL, Rule, host_links, judge_pages, op11_reputation, propagate


def judged(spark, rows, rules=RULES, **more):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r for r in judge_pages(pages, rules, **more).collect()}


def test_rules_and_parts(spark):
    urls = ["http://a.example.org/es/1", "http://EXAMPLE.org/en/12?x", "https://b.org/", "http://b.org", "x://com/fr/", "http://www.com/de/#t",
            "http://acom/de/", None, "no scheme/de/", "http://b.com/DE/", "http://b.org?u=://com/de/", "https://a.net/x#://c.com/de/", "", "a://b://c/de/",
            "HTTP://ÄB.Com/de/ü%20?"]
    got = judged(spark, [(k, u, None) for k, u in enumerate(urls)])
    want = [("a.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "/en/12", "example.org/en/1", "block"),
            ("b.org", "/", "org/", "allow"), ("b.org", "", None, "allow"), ("com", "/fr/", "com/fr/", "allow"), ("www.com", "/de/", "com/de/", "block"),
            ("acom", "/de/", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow"), ("b.com", "/DE/", None, "allow"),
            ("b.org", "", None, "allow"), ("a.net", "/x", None, "allow"), ("", "", None, "allow"), ("b:", "//c/de/", None, "allow"),
            ("Äb.com", "/de/ü%20", "com/de/", "block")]
    assert [(got[k].host, got[k].path, got[k].rule, got[k].verdict) for k in range(len(urls))] == want


def test_longest_rule_wins_and_ties_block(spark):
    rules = [Rule("allow", "org/"), Rule("block", "b.org/a"), Rule("allow", "b.org/ab"), Rule("allow", "c.org/x"), Rule("block", "c.org/x")]
    got = judged(spark, [(1, "http://b.org/abc", None), (2, "http://b.org/a", None), (3, "http://b.org/", None), (4, "http://c.org/x", None)], rules)
    assert [got[k].verdict for k in (1, 2, 3, 4)] == ["allow", "block", "allow", "block"]
    assert judged(spark, [(1, "http://b.org/", "x")], [])[1].verdict == "allow"
    for bad in (("maybe", "org/"), ("allow", "/x")):
        with pytest.raises(ValueError):
            Rule(*bad)


def test_links(spark):
    html = """<a href="https://B.com/x">b</a><A HREF = '//c.com'>c</A><a href=http://d.com:80>d</a><a href="/own">o</a>
    <a href="https://a.com/y">a</a><a href="https://b.com/z">b</a><a href="mailto:x@e.com">m</a><a href="ftp://f.com/">f</a>"""
    pages = spark.createDataFrame([("http://a.com/1", html), ("http://a.com/2", "<a href=//b.com>"), (None, html), ("http://e.com", None), ("http://f.com/", "")],
                                  "url string, html string")
    assert {tuple(r) for r in host_links(pages).collect()} == {("a.com", "b.com", 2), ("a.com", "c.com", 1), ("a.com", "d.com:80", 1)}


def dense(edges, seeds, hosts, damping, rounds):
    at = {h: k for k, h in enumerate(hosts)}
    m = np.zeros((len(hosts), len(hosts)))
    for a, b, n in edges:
        m[at[a], at[b]] += n
    out = np.divide(m, m.sum(1, keepdims=True), out=np.zeros_like(m), where=m.sum(1, keepdims=True) > 0)
    back = np.divide(m.T, m.T.sum(1, keepdims=True), out=np.zeros_like(m), where=m.T.sum(1, keepdims=True) > 0)
    scores = []
    for k, p in enumerate((out, back)):
        s = np.array([seeds.get(h, (0, 0))[k] for h in hosts])
        x = (1 - damping) * s
        for _ in range(rounds):
            x = (1 - damping) * s + damping * (x @ p)
        scores.append(x)
    return {h: (scores[0][k], scores[1][k]) for h, k in at.items()}


def test_propagation_against_matrices(spark):
    r = rng(11)
    hosts = [f"h{k}" for k in range(25)]
    edges = {(a, b): r.randint(1, 9) for a, b in ((r.choice(hosts), r.choice(hosts[:8])) for _ in range(80)) if a != b}
    edges = [(a, b, n) for (a, b), n in edges.items()]
    seeds = {h: (r.random(), r.random() if k % 2 else 0.0) for k, h in enumerate(hosts[:6])}
    got = {x.host: (x.trust, x.distrust) for x in propagate(
        spark.createDataFrame(edges, "src string, dst string, n long"),
        spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"), rounds=200, tolerance=1e-13).collect()}
    want = dense(edges, seeds, hosts, DAMPING, 300)
    assert all(np.allclose(got.get(h, (0, 0)), s, atol=1e-9) for h, s in want.items())


def pages(seed=2, n=400):
    r = rng(seed)
    hosts = [f"h{k}.{t}" for k in range(12) for t in ("net", "com", "example.org", "org")]
    rows = []
    for k in range(n):
        links = "".join(f"<a href='https://{r.choice(hosts)}/x{r.randint(0, 3)}'>" for _ in range(r.randint(0, 3)))
        rows.append((k, f"http://{r.choice(hosts)}/{r.choice(['de', 'fr', 'es', 'en'])}/{r.randint(1, 20)}", links))
    for k in range(30):  # a host with blocked pages only, and a host that links to it
        rows.append((1000 + k, f"http://bad.com/de/{k}", ""))
        rows.append((2000 + k, f"https://farm.net/{k}", "<a href='http://bad.com/de/1'>" if k % 2 else "<a href='/own'>"))
    return rows + [(n, None, "<a href='http://h1.net/'>"), (n + 1, "http://h1.net/", None), (n + 2, "x", "")]


def test_method_blocks_who_links_to_blocked_hosts(spark):
    bad = [(k, f"http://spam.com/de/{k}", "<a href=http://spam.com/>") for k in range(3)]
    rows = bad + [(10, "http://farm.net/", "<a href=//spam.com/de/1>"), (11, "http://friend.net/", ""), (12, "http://x.org/", "<a href=//friend.net/a>"),
                  (13, "http://lone.net/", "<a href='/x'>"), (14, "http://spam.com/en/", None)]
    got = judged(spark, rows)
    assert got[10].verdict == "block" and got[14].verdict == "block" and got[10].rule is None
    assert [got[k].verdict for k in (11, 12, 13)] == ["allow"] * 3
    assert got[11].trust > 0 and got[13].trust == got[13].distrust == 0
    assert judged(spark, rows, threshold=1e12, least=1e9)[10].verdict == "allow"


def test_query_matches_sql(spark, tmp_path):
    spark.createDataFrame(pages(), "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(map(str, map(tuple, op11_reputation(spark, str(tmp_path)).collect())))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    rel = con.sql(SQL)
    want = sorted(map(str, rel.project("page_id, host, path, rule, verdict").fetchall()))
    assert got == want
    free = [x for x in got if ", None, " in x]
    assert any("'block'" in x for x in free) and any("'allow'" in x for x in free)


def test_repeats_empty_tables_and_clashing_names(spark):
    rows = pages(3, 30)
    frame = spark.createDataFrame(rows + rows[:5] + [(None, "http://h1.net/a", None)], "page_id long, url string, html string")
    clash = frame.selectExpr("*", "1 as host", "2 as _id", "3 as trust", "4 as r", "5 as rule")
    out = judge_pages(clash, RULES)
    assert out.columns == ["page_id", "host", "path", "rule", "verdict", "trust", "distrust"] and out.count() == len(rows) + 6
    assert judge_pages(clash.limit(0), RULES).collect() == []
    long = judged(spark, [(1, "http://a.net/" + "x" * 300_000, "<a href=" * 50_000 + "href= \n" * 50_000)])
    assert long[1].verdict == "allow" and len(long[1].path) == 300_001
