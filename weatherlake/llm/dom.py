"""A small, forgiving HTML parser and the block texts of a subtree.

``parse`` gives a tree of ``Node``; text stays in place between the elements.
Enough of the rules of HTML is kept for pages as they are found: void and raw
text elements, end tags that are left out, end tags that match nothing,
comments, and attributes with or without quotes.

Elements nested deeper than ``DEPTH`` stand beside their parent instead of in
it, as in browsers, so the tree can be walked by recursion; their text keeps
its place.  The time is linear in the page: a tag that never ends is looked
for once, and a page with many of them is read by a rule without quotes.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import xxhash

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
# a start tag on the left closes an open element on the right, unless one of the stops is further in
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
                      "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split())
_CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
           "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"), "body": ("head",)}
_STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",)}
_OPEN = re.compile(r"<[!?/a-zA-Z]")
_COMMENT = r"<!--.*?(?:-->|\Z)|<[!?][^<>]*+>"
_TOKEN = re.compile(_COMMENT + r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']|"[^"]*+"|'[^']*+')*+)>""", re.S)
_PLAIN = re.compile(_COMMENT + r"""|<(/?)([a-zA-Z][^\s/<>]*+)([^<>]*+)>""", re.S)
DEPTH = 200
UNENDED = 64  # tags without an end that are looked for with quotes
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")


class Node:
    __slots__ = ("tag", "attrs", "children", "print")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs = tag, attrs
        self.children: list[Node | str] = []
        self.print = 0  # fingerprint of the subtree's text, see ``fingerprint``

    def elements(self) -> list[Node]:
        return [c for c in self.children if c.__class__ is Node]


def _attributes(text: str) -> dict[str, str]:
    if not text or text.isspace():
        return {}
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in reversed(_ATTRIBUTE.findall(text))}


def _tokens(page: str) -> Iterator[tuple[int, re.Match]]:
    """Tags and comments in order, each with the place where the text before
    it starts.  The caller may send the place from which to go on."""
    at = text = 0
    last, unended, token = page.rfind(">"), 0, _TOKEN
    while True:
        opened = _OPEN.search(page, at)
        if opened is None or opened.start() > last and not page.startswith("<!--", opened.start()):
            yield text, None
            return
        m = token.match(page, opened.start())
        if m is None:  # text that looks like a tag
            at = opened.start() + 1
            unended += 1
            if unended > UNENDED:
                token = _PLAIN
            continue
        further = yield text, m
        at = text = further or m.end()


def parse(page: str) -> Node:
    root = Node("#root", {})
    stack, low = [root], None
    opened: Counter[str] = Counter()
    tokens = _tokens(page)
    go_on = None
    while True:
        start, m = tokens.send(go_on)
        go_on = None
        stop = len(page) if m is None else m.start()
        if stop > start:
            stack[-1].children.append(html.unescape(page[start:stop]))
        if m is None:
            return root
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if opened[tag]:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        _cut(stack, k, opened)
                        break
            elif tag == "br":
                stack[-1].children.append(Node("br", {}))
            continue
        if tag in _CLOSES_P:
            _close(stack, ("p",), ("table", "td", "th", "button", "li", "div", "article", "section", "body"), opened)
        elif tag in _CLOSES:
            _close(stack, _CLOSES[tag], _STOPS.get(tag, ("table",)), opened)
        node = Node(tag, _attributes(m[3]))
        stack[-1].children.append(node)
        if tag in VOID or m[3].endswith("/") and tag not in RAW and tag in ("svg", "path"):
            continue
        at = m.end()
        if tag in RAW:
            low = page.lower() if low is None else low
            end = low.find("</" + tag, at)
            if len(low) != len(page):  # a letter that grows in lower case: look without the copy
                found = re.compile("</" + tag, re.I).search(page, at)
                end = found.start() if found else -1
            stop = len(page) if end < 0 else end
            node.children.append(page[at:stop])
            close = page.find(">", stop)
            go_on = len(page) if end < 0 or close < 0 else close + 1
            continue
        if len(stack) > DEPTH:  # what is in it goes on beside it
            beside = Node(tag, {})
            beside.children = stack[-1].children
            node = beside
        stack.append(node)
        opened[tag] += 1


def _cut(stack: list[Node], k: int, opened: Counter[str]) -> None:
    for n in stack[k:]:
        opened[n.tag] -= 1
    del stack[k:]


def _close(stack: list[Node], tags: tuple[str, ...], stops: tuple[str, ...], opened: Counter[str]) -> None:
    """Close the outermost open element with one of the tags that no stop encloses."""
    if not any(opened[t] for t in tags):
        return
    found = 0
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag in tags:
            found = k
        elif stack[k].tag in stops:
            break
    if found:
        _cut(stack, found, opened)


def fingerprint(node: Node) -> int:
    """Sets ``print`` throughout the subtree: equal texts in equal places give equal values."""
    parts = []
    for c in node.children:
        if c.__class__ is Node:
            if c.tag not in RAW:
                parts.append(str(fingerprint(c)))
        else:
            parts.append(" ".join(c.split()))
    node.print = xxhash.xxh64_intdigest("\x1f".join(parts)) >> 1 | 1
    return node.print


def blocks(node: Node, dropped) -> list[str]:
    """The texts of the blocks under a node, in page order, without subtrees
    for which ``dropped(child)`` holds; white space runs become one blank."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append(text)
        run.clear()

    def walk(n: Node) -> None:
        for c in n.children:
            if c.__class__ is not Node:
                run.append(c)
            elif c.tag == "br":
                run.append(" ")
            elif c.tag in RAW or dropped(c):
                continue
            elif c.tag in INLINE:
                walk(c)
            else:
                flush()
                walk(c)
                flush()

    walk(node)
    flush()
    return out
