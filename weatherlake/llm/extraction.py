"""Main text of web pages by wrapper induction.

Pages of one host mostly come from one template.  Their DOM trees (runs of
like siblings folded into one node) are aligned by simple tree matching and
merged into a wrapper: nodes whose text is the same on all pages are template,
nodes whose text varies are slots.  The wrapper says where the main text of
the host's pages is: in the region (article, main, or else the container of
most of the varying text) and there in everything that is neither template nor
marked as menu, header, footer, sidebar, notice, advert, form or comment.

Copies of a page are dropped first, by host and fingerprint, so the wrapper
counts different pages only.  Wrappers are then merged per partition, per host
and salt, and per host, so a host with a third of all pages sends one wrapper
per partition and its pages are never brought together.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from weatherlake.llm.dom import INLINE, RAW, Node, blocks, fingerprint, parse
from weatherlake.llm.shared import cut, extended, fresh, modest_batches, table, tidy

SALTS = 64
SURE = 3  # different pages that must agree before constant text counts as template
BROADCAST_BYTES = 16 << 20

_NEVER = frozenset("nav footer aside form button select input option datalist dialog menu object embed canvas svg audio video "
                   "map head fieldset".split())
_MARKS = frozenset("ad ads advert advertisement adverts advertising adsense banner sponsor sponsored promo promotion cookie cookies consent "
                   "gdpr notice notices popup modal overlay newsletter subscribe subscription signup login nav navbar navigation menu menubar "
                   "breadcrumb breadcrumbs sidebar side aside widget widgets footer masthead topbar comment comments commentlist disqus "
                   "respond reply replies discussion share sharing social related recommended recommendations pagination pager "
                   "toolbar skip alert form search".split())
_ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog menu menubar form toolbar".split())
_TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_REGIONS = frozenset(("article", "main"))
# within the main text these are text even where all pages share them
_TEXTUAL = frozenset("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tr td th pre blockquote figure figcaption".split())


def _names(node: Node) -> set[str]:
    a = node.attrs
    text = f"{a.get('class', '')} {a.get('id', '')}" if a else ""
    return {w.lower() for w in _TOKENS.findall(text)} if text.strip() else set()


def marked(node: Node, inside: bool, names: bool = True) -> bool:
    """Whether tag, role, class or id (these two only with ``names``) set the
    subtree apart from the main text.  ``inside`` the region a header belongs
    to the article."""
    if node.tag in _NEVER:
        return True
    if node.tag == "header":
        return not inside
    a = node.attrs
    if not a:
        return False
    if "hidden" in a or a.get("aria-hidden") == "true" or a.get("role") in _ROLES or "display:none" in a.get("style", "").replace(" ", ""):
        return True
    if not names:
        return False
    found = _names(node)
    return bool(found & _MARKS) or not inside and "header" in found


def _key(node: Node) -> str:
    """Tag and class names.  Of the id only what ``marked`` reads counts: an
    id may be a page's own, and nodes would then never be alike."""
    names = sorted({w.lower() for w in _TOKENS.findall(node.attrs.get("class", ""))} | (_names(node) & (_MARKS | {"header"})) if node.attrs else ())
    return node.tag + ("." + ".".join(names) if names else "") + ("@main" if node.attrs.get("role") == "main" else "")


# A wrapper node is [key, print (0: varies), pages, text length, children].


def shape(node: Node) -> list:
    """The wrapper of one page: block elements only, runs of like siblings folded."""
    mass, kids = 0, []
    for c in node.children:
        if c.__class__ is not Node:
            mass += len(c)
        elif c.tag in INLINE:
            mass += shape(c)[3]
        elif c.tag not in RAW and c.tag != "head":
            k = shape(c)
            if kids and kids[-1][0] == k[0]:
                kids[-1] = _fold(kids[-1], k)
            else:
                kids.append(k)
    return [_key(node), node.print, 1, mass + sum(k[3] for k in kids), kids]


def _fold(a: list, b: list) -> list:
    """Two like siblings of one page: one node that stands for the run."""
    return [a[0], hash_pair(a[1], b[1]), 1, a[3] + b[3], _align(a[4], b[4], 1)]


def hash_pair(a: int, b: int) -> int:
    return ((a * 0x9E3779B97F4A7C15 + b) & (2**63 - 1)) | 1


def matching(a: list, b: list) -> int:
    """Simple tree matching: the size of the largest order-preserving matching."""
    if a[0] != b[0]:
        return 0
    if not a[4] or not b[4]:
        return 1
    i, j = _shared(a[4], b[4])
    return 1 + _table([a[4][k] for k in i], [b[4][k] for k in j])[-1][-1]


def _shared(xs: list, ys: list) -> tuple[list[int], list[int]]:
    """Places of the nodes whose key the other list has; all others match
    nothing, so they need no place in the table."""
    both = {x[0] for x in xs} & {y[0] for y in ys}
    return [k for k, x in enumerate(xs) if x[0] in both], [k for k, y in enumerate(ys) if y[0] in both]


def _table(xs: list, ys: list) -> list[list[int]]:
    m = [[0] * (len(ys) + 1)]
    for x in xs:
        above, row = m[-1], [0]
        for j, y in enumerate(ys):
            w = matching(x, y)
            row.append(max(above[j + 1], row[j], above[j] + w if w else 0))
        m.append(row)
    return m


def _align(xs: list, ys: list, pages: int = 0) -> list:
    """Children of two nodes as one list: matched ones merged, others kept in order."""
    if [x[0] for x in xs] == [y[0] for y in ys]:
        return [merge(x, y, pages) for x, y in zip(xs, ys, strict=True)]
    xi, yj = _shared(xs, ys)
    m, pairs = _table([xs[k] for k in xi], [ys[k] for k in yj]), []
    i, j = len(xi), len(yj)
    while i or j:
        w = matching(xs[xi[i - 1]], ys[yj[j - 1]]) if i and j else 0
        if w and m[i][j] == m[i - 1][j - 1] + w:
            pairs.append((xi[i - 1], yj[j - 1]))
            i, j = i - 1, j - 1
        elif i and (not j or m[i][j] == m[i - 1][j]):
            i -= 1
        else:
            j -= 1
    out, i, j = [], 0, 0
    for x, y in reversed(pairs):
        out += [*ys[j:y], *xs[i:x], merge(xs[x], ys[y], pages)]
        i, j = x + 1, y + 1
    return [*out, *ys[j:], *xs[i:]]


def merge(a: list, b: list, pages: int = 0) -> list:
    """The wrapper of two wrappers.  Rare nodes stay: one that few pages had
    so far may be template, at every number of pages by the same rule."""
    return [a[0], a[1] if a[1] == b[1] else 0, pages or a[2] + b[2], a[3] + b[3], _align(a[4], b[4], pages)]


class Wrapper:
    """What a host's different pages have in common, as a wrapper tree."""

    def __init__(self, tree: list):
        self.tree = tree

    @staticmethod
    def of(page: Node) -> Wrapper:
        return Wrapper(shape(page))

    def add(self, other: Wrapper) -> None:
        self.tree = merge(self.tree, other.tree)

    def dumps(self) -> str:
        return json.dumps(self.tree, separators=(",", ":"))

    @staticmethod
    def loads(text: str) -> Wrapper:
        return Wrapper(json.loads(text))

    def summary(self) -> str:
        """What extraction needs: fingerprints of template nodes, and the path
        of keys to the container of most of the varying text."""
        template: list[int] = []
        if self.tree[2] >= SURE:
            _collect(self.tree, template)
        path, node = [], self.tree
        # names that take out nearly all that varies do not mean what they say
        names = 10 * _varying(node) >= _varying(node, False)
        while True:
            total = _varying(node, names)
            best = max(node[4], key=lambda k: _varying(k, names), default=None)
            if best is None or not total or _varying(best, names) < 0.6 * total or best[0].split(".")[0] in _TEXTUAL:
                return json.dumps([sorted(set(template)), path], separators=(",", ":"))
            path.append(best[0])
            node = best


def _collect(node: list, out: list[int]) -> None:
    """Constant nodes, as high in the tree as possible."""
    for k in node[4]:
        if k[1] and k[2] >= SURE and k[0].split(".")[0] not in _TEXTUAL:
            out.append(k[1])
        else:
            _collect(k, out)


def _varying(node: list, marks: bool = True) -> int:
    tag, *names = node[0].removesuffix("@main").split(".")
    if node[1] and node[2] >= SURE or tag in _NEVER or tag == "header" or marks and set(names) & _MARKS:
        return 0
    return sum(_varying(k, marks) for k in node[4]) if node[4] else node[3]


def _descendants(node: Node) -> Iterator[Node]:
    for c in node.elements():
        if c.tag not in RAW:
            yield c
            yield from _descendants(c)


def _regions(node: Node, names: bool = True) -> Iterator[Node]:
    """Articles and mains that are not within a marked part."""
    for c in node.elements():
        if c.tag in RAW or (c.tag not in ("html", "body") and marked(c, False, names)):
            continue
        if c.tag in _REGIONS or c.attrs.get("role") == "main":
            yield c
        yield from _regions(c, names)


def _length(node: Node) -> int:
    return sum(len(b) for b in blocks(node, lambda c: marked(c, True)))


def region(page: Node, path: list[str]) -> Node:
    """The part of a page that holds its main text."""
    found = list(_regions(page))
    if not found:  # within containers that class or id marks: a main, or an article with most of the text
        loose = [r for r in _regions(page, False) if not marked(r, True)]
        half = sum(len(b) for b in blocks(page, lambda c: marked(c, True, False))) / 2 if loose else 0
        found = [r for r in loose if r.tag != "article" or _length(r) > half]
    articles = [r for r in found if r.tag == "article"]
    mains = [r for r in found if r.tag != "article"]
    if len(articles) == 1:
        return articles[0]
    if mains:
        return max(mains, key=_length)
    if articles:
        outer = [a for a in articles if not any(a is not b and a in _descendants(b) for b in articles)]
        return max(outer, key=_length)
    node = page
    for key in path:
        inner = [c for c in node.elements() if _key(c) == key]
        if not inner:
            break
        node = max(inner, key=_length) if len(inner) > 1 else inner[0]
    return node


def main_text(page: Node, template: frozenset[int], path: list[str]) -> str:
    """The main text of a parsed and fingerprinted page."""
    part = region(page, path)
    inside = part.tag in _REGIONS or part.attrs.get("role") == "main"

    def dropped(c: Node, names: bool = True) -> bool:
        if c.tag in ("html", "body"):
            return False
        return marked(c, inside, names) or c.print in template and c.tag not in _TEXTUAL and c.tag not in _REGIONS

    # a page that class and id names would leave without any text is taken without them
    return "\n".join(blocks(part, dropped) or blocks(part, lambda c: dropped(c, False)))


def host_of(url: str) -> Column:
    """The lower-case host of a URL, empty where there is none."""
    return F.coalesce(F.regexp_extract(F.lower(F.col(url)), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit(""))


def _shapes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, html) -> host, page print and wrapper of every page; copies
    within a task go here already, so a hot one is one row per task."""
    seen: set[tuple] = set()
    for batch in batches:
        rows = []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            root = parse(page)
            fingerprint(root)
            wrapper = Wrapper.of(root).dumps()
            copy = (host, root.print, hash(wrapper))
            if copy not in seen:
                if len(seen) > 100_000:  # later ones go after the shuffle
                    seen.clear()
                seen.add(copy)
                rows.append((host, root.print, wrapper))
        kinds = (("host", pa.string()), ("print", pa.int64()), ("wrapper", pa.string()))
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(kinds)], names=[n for n, _ in kinds])


def _different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host and print -> the first of each as host, wrapper."""
    last = None
    for batch in batches:
        keep = []
        for k, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if key != last:
                keep.append(k)
            last = key
        take = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take)], names=["host", "wrapper"])


def _induce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host and print -> one wrapper per host and partition."""
    yield from _combine(False)(_different(batches))


def _combine(summarise: bool) -> Callable:
    """Wrappers sorted by host -> one per host."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        host, wrapper = None, None

        def out(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array(
                [r[1].summary() if summarise else r[1].dumps() for r in rows], pa.string())], names=["host", "wrapper"])

        for batch in batches:
            done = []
            for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if h == host:
                    wrapper.add(Wrapper.loads(text))
                    continue
                if wrapper is not None:
                    done.append((host, wrapper))
                host, wrapper = h, Wrapper.loads(text)
            if done:
                yield out(done)
        if wrapper is not None:
            yield out([(host, wrapper)])
    return run


def induce_wrappers(pages: DataFrame) -> DataFrame:
    """``pages``: host, html.  One row per host: host, wrapper (a summary as JSON)."""
    schema = "host string, wrapper string"
    shapes = pages.filter("html is not null").select("host", "html").mapInArrow(tidy(_shapes), "host string, print long, wrapper string")
    parts = shapes.repartition("host", "print").sortWithinPartitions("host", "print", "wrapper").mapInArrow(tidy(_induce), schema)
    salted = (parts.withColumn("salt", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS))).repartition("host", "salt")
              .sortWithinPartitions("host", "salt").select("host", "wrapper").mapInArrow(tidy(_combine(False)), schema))
    return salted.repartition("host").sortWithinPartitions("host", "wrapper").mapInArrow(tidy(_combine(True)), schema)


def _extract(html_at: int, wrapper_at: int, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[frozenset[int], list[str]]] = {}
        for batch in batches:
            texts = []
            for page, wrapper in zip(batch.column(html_at).to_pylist(), batch.column(wrapper_at).to_pylist(), strict=True):
                if not page:
                    texts.append("")
                    continue
                if wrapper not in known:
                    if len(known) > 1000:
                        known.clear()
                    template, path = json.loads(wrapper) if wrapper else ([], [])
                    known[wrapper] = frozenset(template), path
                root = parse(page)
                if known[wrapper][0]:
                    fingerprint(root)
                texts.append(main_text(root, *known[wrapper]))
            kept = [c for k, c in enumerate(batch.columns) if k not in (html_at, wrapper_at)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=names)
    return run


def extract_main_text(pages: DataFrame, *, url: str = "url", html: str = "html",
                      broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (its code points) in place of ``html``.

    Blocks of the main text are in page order, joined by one \\n; white space
    within a block is one blank.  Null and empty html give the empty text.  A
    null or malformed url is of the host "" like all others of the kind.
    Repeated pages count once in the wrapper.  All rows and other columns are
    kept; input columns with one of the two new names are replaced.

    Wrapper summaries are joined by host: broadcast while all of them together
    have at most ``broadcast_bytes``, shuffled beyond that.
    """
    pages = pages.drop("text", "n_chars")
    own_host, own_wrapper = fresh(pages, "_host", "_wrapper")
    named = pages.withColumn(own_host, host_of(url))
    wrappers = cut(induce_wrappers(named.select(F.col(own_host).alias("host"), F.col(html).alias("html"))))
    small = wrappers.agg(F.sum(F.octet_length("wrapper") + F.octet_length("host"))).first()[0] or 0
    side = wrappers.select(F.col("host").alias(own_host), F.col("wrapper").alias(own_wrapper))
    side = F.broadcast(side) if small <= broadcast_bytes else side
    kept = [f for f in pages.schema.fields if f.name != html]
    rows = named.join(side, own_host, "left").select(*[f.name for f in kept], html, own_wrapper)
    schema = extended(StructType(kept), "text string, n_chars long")
    return rows.mapInArrow(tidy(_extract(len(kept), len(kept) + 1, [*[f.name for f in kept], "text", "n_chars"])), schema)


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    modest_batches(spark)
    return extract_main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
