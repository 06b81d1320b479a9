import json

import pytest

from helpers import rng, words
from weatherlake.llm.dom import blocks, fingerprint, parse
from weatherlake.llm.extraction import Wrapper, extract_main_text, main_text, matching, merge, shape


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def prose(seed, n=3):
    r = rng(seed)
    return [" ".join(words(r, 25)).capitalize() + "." for _ in range(n)]


def semantic(k):
    p = prose(k)
    return (f"""<!doctype html><html><head><title>T{k} &amp; t</title><style>p{{x:y}}</style><script>var a="</p><article>";</script></head>
<body class="with-sidebar"><header class="top"><h1>The Site</h1><form><input name=q></form></header><nav><ul><li>Home<li>News {k}</ul></nav>
<div class="cookie-notice">We use cookies {k}</div><aside>Side {k}</aside>
<main><article id="post-{k}"><header><h1>Title&nbsp;{k} &eacute;&#233;&#x4e2d;</h1></header><p>{p[0]}<p>{p[1]} <b>bold</b>
 <i>text</i><br>after<div class="ad">Buy {k}</div><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{p[2]}
<div class="share-buttons">Share</div><section id="comments"><h2>Comments</h2><article class="comment">Nice {k}</article></section></article></main>
<footer>&copy; site {k}</footer></body></html>""",
            "\n".join([f"Title {k} éé中", p[0], f"{p[1]} bold text after", "one", "two", "a", "b", p[2]]))


def plain(k):
    p = prose(100 + k)
    return (f"<html><body><div id=top>Site name <a href=/>Home</a></div><div class=box><div class=motto>Always the same words here</div>"
            f"<div class=text><h2>Head {k}</h2>{''.join(f'<p>{x}</p>' for x in p)}</div></div><div id=bottom>Imprint and terms</div></body></html>",
            "\n".join([f"Head {k}", *p]))


@pytest.mark.parametrize("make", [semantic, plain])
def test_main_text(spark, make):
    made = {k: make(k) for k in range(12)}
    rows = [(k, f"https://User@WWW.host.example:80/{k}", h) for k, (h, _) in made.items()]
    for limit in (1 << 20, -1):  # wrappers broadcast, and shuffled
        got = {x.page_id: (x.text, x.n_chars) for x in extract_main_text(pages(spark, rows), broadcast_bytes=limit).collect()}
        assert got == {k: (t, len(t)) for k, (_, t) in made.items()}


def test_one_page_of_a_host_and_copies(spark):
    h, t = semantic(1)
    rows = [(1, "http://a.example/1", h), (2, "http://b.example/1", h), (3, "http://b.example/2", h), (4, "http://b.example/3", h), (5, "http://b.example/4", h)]
    assert {x.text for x in extract_main_text(pages(spark, rows)).collect()} == {t}


def test_edge_cases(spark):
    long = "<article>" + "".join(f"<p>{' '.join(words(rng(k), 50))}</p>" for k in range(2000)) + "</article>"
    broken = ["<", "<p", "<p class='x", "</p></div>", "<!-- never closed", "<script>never closed <p>x", "a < b && c > d &lt; &unknown; &amp", "<b><p>x</b>y"]
    rows = [(1, None, None), (2, "not a url", ""), (3, "http://x.example/", long), (3, "http://x.example/", long), (None, "http://y.example", "<p>a</p>")]
    rows += [(10 + k, "http://z.example/", h) for k, h in enumerate(broken)]
    got = extract_main_text(pages(spark, rows).selectExpr("*", "'t' as text", "1 as _hosts", "2 as wrapper", "3 as host"))
    assert got.columns == ["page_id", "url", "_hosts", "wrapper", "host", "text", "n_chars"]
    found = sorted(((x.page_id, x.text) for x in got.collect()), key=str)
    by = dict(found)
    assert len(found) == len(rows) and by[1] == by[2] == "" and by[None] == "a" and by[3].count("\n") == 1999
    assert by[16] == "a < b && c > d < &unknown; &" and by[17].replace("\n", " ") == "x y" or by[17] == "xy"
    assert extract_main_text(pages(spark, [])).count() == 0


def test_tree_matching_and_merging():
    a, b = (parse(f"<body><div><p>{x}</p><p>2</p></div><ul><li>m</li></ul>{y}</body>") for x, y in (("1", ""), ("3", "<h2>n</h2>")))
    for t in (a, b):
        fingerprint(t)
    assert matching(shape(a), shape(b)) == matching(shape(b), shape(a)) == 6
    assert matching(shape(a), shape(a)) == 6 and matching(shape(b), shape(b)) == 7
    w = Wrapper.of(a)
    w.add(Wrapper.of(b))
    div, ul, h2 = w.tree[4][0][4]
    assert div[1] == 0 and ul[1] != 0 and h2[2] == 1  # varies, constant, on one page only
    assert Wrapper.loads(w.dumps()).tree == w.tree


def test_blocks_of_nested_lists():
    assert blocks(parse("<ul><li>a<ul><li>b</ul><li>c</ul><dl><dt>d<dd>e</dl>f"), lambda n: False) == list("abcdef")


def test_copies_of_a_page_are_one_page(spark):
    made = {}
    for k, own in enumerate(("gallery", "recipe", "answer", "poem")):
        body, text = plain(k)
        made[k] = body.replace("<div class=text>", f"<div class=text><div class={own}>The only {own}</div>"), f"The only {own}\n{text}"
    rows = [(k, f"http://host.example/{k}", made[k % 4][0]) for k in range(16)]
    for parts in (1, 7):
        got = {x.page_id: x.text for x in extract_main_text(pages(spark, rows).repartition(parts)).collect()}
        assert got == {k: made[k % 4][1] for k in range(16)}


@pytest.mark.parametrize("order", [1, -1])
def test_a_late_or_rare_notice_is_template(order):
    def wrapper(k):
        page = parse(f"<body><div class=top>The site</div>{'<div class=box>Moved house</div>' if k >= 396 else ''}<div class=text>{k} {prose(k, 1)[0]}</div></body>")
        fingerprint(page)
        return page, Wrapper.of(page)
    page, whole = wrapper(0 if order > 0 else 399)
    for k in list(range(400))[::order][1:]:
        whole.add(wrapper(k)[1])
    last, _ = wrapper(399)
    box = last.elements()[0].elements()[1]
    assert whole.tree[2] == 400 and f"{box.print}" in whole.summary()


def test_merging_leaves_out_no_node_and_aligns_shared_ones():
    def kids(keys):
        return [[k, 1, 1, 0, []] for k in keys]
    a, b = (["div", 1, 1, 0, kids(x)] for x in ("apbqc", "ubvc"))
    got = [(k[0], k[2]) for k in merge(a, b)[4]]
    assert sorted(got) == [("a", 1), ("b", 2), ("c", 2), ("p", 1), ("q", 1), ("u", 1), ("v", 1)]
    assert [k for k, n in got if n == 2] == ["b", "c"] and matching(a, b) == 3


@pytest.mark.parametrize("name", ["layout with-sidebar", "content no-comments", "long-form", "side-by-side", "post share-enabled"])
@pytest.mark.parametrize("tag", ["main", "article", "div"])
def test_a_marked_container_of_the_text(name, tag):
    made = []
    for k in range(4):
        p = prose(200 + k)
        page = parse(f"<body><div id=top>Site name</div><div class='{name}'><{tag}><p>{p[0]}<p>{p[1]}</{tag}></div><div class=comments>Nice {k}</div></body>")
        fingerprint(page)
        made.append((page, f"{p[0]}\n{p[1]}"))
    whole = Wrapper.of(made[0][0])
    for page, _ in made[1:]:
        whole.add(Wrapper.of(page))
    template, path = json.loads(whole.summary())
    assert [main_text(page, frozenset(template), path) for page, _ in made] == [t for _, t in made]


def test_deep_and_unclosed_pages(spark):
    deep = "<article><h1>Head</h1>" + "<div>" * 50_000 + "<p>inner</p>" + "</div>" * 50_000 + "<p>after</p></article>"
    unclosed = "<article>" + "<font>" * 50_000 + "words <p>more</p></article>"
    tags = "<article><p>text</p>" + "<a " * 200_000
    quotes = "<article><p>text</p>" + "<a href=\"" * 100_000 + "><p>tail</p></article>"
    rows = [(k, "http://deep.example/", h) for k, h in enumerate([deep, unclosed, tags, quotes])]
    got = {x.page_id: x.text for x in extract_main_text(pages(spark, rows)).collect()}
    assert got[0] == "Head\ninner\nafter" and got[1] == "words\nmore" and got[2].startswith("text") and got[3].startswith("text")


def test_ids_of_their_own_do_not_grow_the_wrapper():
    trees = []
    for k in range(300):
        page = parse("<body>" + "".join(f"<section id='slug-{chr(97 + k % 26)}{chr(97 + k // 26)}-{j}x'><p>{' '.join(words(rng(k * 9 + j), 5))}</p></section>"
                                        for j in range(5)) + "</body>")
        fingerprint(page)
        trees.append(Wrapper.of(page))
    sizes = []
    for t in trees[1:]:
        trees[0].add(t)
        sizes.append(len(trees[0].dumps()))
    assert sizes[-1] < sizes[0] + 200


def test_names_that_clash(spark):
    h, t = semantic(1)
    frame = pages(spark, [(1, "http://a.example/1", h)]).selectExpr("*", "'h' as _host", "'w' as _wrapper")
    assert [(x._host, x._wrapper, x.text) for x in extract_main_text(frame).collect()] == [("h", "w", t)]


def plain_matching(a, b):
    """The largest order-preserving matching of two trees, by trying all subsets of pairs."""
    if a[0] != b[0]:
        return 0

    def best(i, j):
        if i == len(a[4]) or j == len(b[4]):
            return 0
        w = plain_matching(a[4][i], b[4][j])
        return max(best(i + 1, j), best(i, j + 1), w + best(i + 1, j + 1) if w else 0)
    return 1 + best(0, 0)


def test_matching_against_all_alignments():
    r = rng(77)

    def tree(depth):
        return [r.choice("ab"), r.randint(0, 2), 1, 1, [tree(depth - 1) for _ in range(r.randint(0, 3))] if depth else []]

    def size(t):
        return 1 + sum(size(k) for k in t[4])
    for _ in range(200):
        a, b = tree(3), tree(3)
        a[0] = b[0] = "r"
        assert matching(a, b) == plain_matching(a, b)
        # a merge holds every node of both, the matched ones once
        assert size(merge(a, b)) == size(a) + size(b) - matching(a, b)
