"""Main-text extraction by gradient-boosted trees over DOM nodes, decoded along the hierarchy.

A tolerant parser builds the node tree. Each node gets features: its tag, tokens of its class, id and role
attributes (its own and its ancestors'), depth, place among its siblings, and densities of its subtree. Trees,
trained on generated pages of many layouts whose articles are known, give the probability that a node's subtree
holds article text. Decoding chooses the likeliest labelling in which a dropped node drops all below it and a kept
one keeps something below it, so an ancestor and a descendant never contradict each other.
"""

from __future__ import annotations

import bisect
import functools
import html
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import slices, table
from strandline.llm.trees import Boosted

OPENING = re.compile(r"<(?:[!?]|(/?)([a-zA-Z][^\s/>]*))")
#: Within a tag: its end, or the quote that begins a value.
INSIDE = re.compile(r"""[>]|=\s*(["'])""")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
TOKEN = re.compile(r"[a-z]+")
#: Fixed by HTML: elements without content, those whose content is no page text, blocks, and what a block's start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title xmp noembed noframes".split())
HIDDEN = frozenset("head select option button datalist object svg canvas audio video map".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup "
    "html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th"}, {"table"}), "option": ({"option"}, {"select"}),
}
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))


class Node:
    __slots__ = ("tag", "parent", "depth", "tokens", "children", "own", "last")

    def __init__(self, tag: str, parent: int, depth: int, tokens: frozenset[str]):
        self.tag, self.parent, self.depth, self.tokens = tag, parent, depth, tokens
        self.children: list[int] = []
        self.own = 0  # text characters directly below it
        self.last = 0  # end of its subtree in document order


def tags(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, "/" or "", lower-case name, attributes) of each tag, and of comments and the like with an empty name.

    One pass: no part is looked at more than twice, whatever the page holds. A tag or comment that the page's end cuts off goes
    to the end. Once a quoted value has no end before the page's, quotes no longer count. A tag's name is its first letters
    up to a blank, a slash or the end. What the caller sends back is where to go on.
    """
    at, quotes = 0, True
    while m := OPENING.search(source, at):
        if m[2] is None:
            comment = source.startswith("<!--", m.start())
            end = source.find("-->" if comment else ">", m.end())
            end = len(source) if end < 0 else end + (3 if comment else 1)
            at = (yield m.start(), end, "", "", "") or end
            continue
        k, end = m.end(), -1
        while quotes and (x := INSIDE.search(source, k)):
            if not x[1]:
                end = x.start()
                break
            if (k := source.find(x[1], x.end()) + 1) == 0:
                break
        if end < 0:
            quotes = False
            end = source.find(">", m.end())
        if end < 0:
            at = (yield m.start(), len(source), "", "", "") or len(source)
        else:
            at = (yield m.start(), end + 1, m[1], m[2].lower(), source[m.end() : end]) or end + 1


def parse(source: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in document order, 0 the root, and the text runs as (node, decoded text). Time is linear in the page's length."""
    nodes = [Node("#root", -1, 0, frozenset())]
    runs: list[tuple[int, str]] = []
    stack, hidden, done = [0], 0, 0
    where: dict[str, list[int]] = {}  # places in the stack, by tag
    open_blocks: list[int] = []

    def text(piece: str) -> None:
        if piece and not hidden:
            runs.append((stack[-1], html.unescape(piece) if "&" in piece else piece))

    def close(k: int) -> None:
        nonlocal hidden
        for x in reversed(stack[max(k, 1) :]):
            tag = nodes[x].tag
            nodes[x].last = len(nodes)
            hidden -= tag in HIDDEN
            where[tag].pop()
            if tag in BLOCK:
                open_blocks.pop()
        del stack[max(k, 1) :]

    scan, go = tags(source), None
    while True:
        try:
            start, end, slash, name, attributes = scan.send(go)
        except StopIteration:
            break
        text(source[done:start])
        done, go = end, None
        if not name:
            continue
        if slash:
            if where.get(name):
                close(where[name][-1])
            continue
        if name in RAW:
            shut = re.compile(rf"</{re.escape(name)}\s*/?>", re.I).search(source, end)
            done = go = shut.end() if shut else len(source)
            continue
        if name in VOID:
            if name in ("br", "hr", "img"):
                text(" ")
            continue
        if name in CLOSES:
            shuts, until = CLOSES[name]
            low = max((where[t][-1] for t in until if where.get(t)), default=0)
            if (k := min((p[bisect.bisect_right(p, low)] for t in shuts if (p := where.get(t)) and p[-1] > low), default=0)) > 0:
                close(k)
        if name in BLOCK and open_blocks:  # an open paragraph or heading ends here
            tag = nodes[stack[open_blocks[-1]]].tag
            if tag == "p" or tag in HEADINGS and name in HEADINGS:
                close(open_blocks[-1])
        if name == "body" and (hidden or where.get("body")):
            close(where["head"][0] if where.get("head") else len(stack))
        tokens = frozenset(t for a in ATTRIBUTE.findall(attributes) for t in TOKEN.findall(a[1].lower())) if "=" in attributes else frozenset()
        nodes.append(Node(name, stack[-1], len(stack), tokens))
        nodes[stack[-1]].children.append(len(nodes) - 1)
        if attributes.endswith("/") and name not in BLOCK:
            nodes[-1].last = len(nodes)
            continue
        hidden += name in HIDDEN
        where.setdefault(name, []).append(len(stack))
        if name in BLOCK:
            open_blocks.append(len(stack))
        stack.append(len(nodes) - 1)
    tail = source[done:]
    text(tail[:-2] if tail.endswith("</") else tail)
    close(1)
    nodes[0].last = len(nodes)
    return nodes, runs


#: Tokens of class, id and role attributes that say what a node is, by kind.
KINDS = {
    "article": "article content post entry story main body text prose blog news page chapter copy",
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs toc tabs pager pagination skip topbar toolbar",
    "edge": "header head banner masthead footer foot bottom colophon copyright legal imprint",
    "side": "sidebar side aside rail widget widgets related recommended recommendations more popular trending teaser complementary secondary tags",
    "advert": "ad ads adv advert advertisement sponsor sponsored promo promotion dfp outbrain taboola",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay dialog banner message privacy",
    "form": "form search login signup subscribe subscription newsletter register contact contactinfo",
    "comment": "comment comments reply replies respond discussion disqus feedback thread",
    "share": "share sharing social follow like tweet author byline meta date",
}
TOKEN_KIND: dict[str, list[int]] = {}
for _k, _words in enumerate(KINDS.values()):
    for _w in _words.split():
        TOKEN_KIND.setdefault(_w, []).append(_k)
TAG_KIND = {
    t: k
    for k, tags in enumerate(("article", "main", "section", "div", "p", "h1", "h2 h3 h4 h5 h6", "nav", "header", "footer", "aside", "form fieldset label input", "ul ol dl menu", "li dt dd", "a", "table tbody thead tr td th", "blockquote pre figure figcaption", "span b i em strong small u font", "body html #root"))
    for t in tags.split()
}
N_TAGS, N_KINDS = max(TAG_KIND.values()) + 2, len(KINDS)
#: Tags that by themselves say that all below is, or isn't, the article; inherited like token kinds.
TAG_TOKENS = {"article": 0, "main": 0, "nav": 1, "menu": 1, "header": 2, "footer": 2, "aside": 3, "form": 6, "dialog": 5}
MARKS = ".!?,;:"


def features(nodes: list[Node], runs: list[tuple[int, str]]) -> np.ndarray:
    """One row for each node."""
    n = len(nodes)
    parent = np.array([x.parent for x in nodes])
    last = np.array([x.last for x in nodes])
    own, links, marks, words = (np.zeros(n + 1) for _ in range(4))
    linked = [False] * n
    for k, x in enumerate(nodes):
        linked[k] = x.tag == "a" or k > 0 and linked[x.parent]
    for k, t in runs:
        size = len(t.strip())
        own[k + 1] += size
        words[k + 1] += t.count(" ") + 1 if size else 0
        marks[k + 1] += sum(map(t.count, MARKS))
        if linked[k]:
            links[k + 1] += size
    tag = np.array([TAG_KIND.get(x.tag, N_TAGS - 1) for x in nodes])
    sums = []
    for v in (own, links, marks, words, np.append(0, tag == 4), np.append(0, tag == 14), np.append(0, np.ones(n))):
        total = np.cumsum(v)
        sums.append(total[last] - total[np.arange(n)])
    text, link, mark, word, paragraphs, anchors, below = sums
    kinds = np.zeros((n, N_KINDS))
    for k, x in enumerate(nodes):
        for t in x.tokens:
            for kind in TOKEN_KIND.get(t, ()):
                kinds[k, kind] = 1
        if x.tag in TAG_TOKENS:
            kinds[k, TAG_TOKENS[x.tag]] = 1
    above, telling = np.zeros((n, N_KINDS)), kinds.any(1).tolist()
    for k, x in enumerate(nodes):
        if k and telling[x.parent]:  # the parent or something above it has a kind
            above[k] = np.maximum(above[x.parent] * 0.999, kinds[x.parent])
            telling[k] = True
    up = np.maximum(parent, 0)
    siblings, place, alike, near = np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n)
    if n > 1:
        of = parent[1:]
        count = np.bincount(of, minlength=n)
        siblings[1:] = count[of]
        by = np.argsort(of, kind="stable")
        place[by + 1] = np.arange(n - 1) - (np.cumsum(count) - count)[of[by]]
        _, same, often = np.unique(of * N_TAGS + tag[1:], return_inverse=True, return_counts=True)
        alike[1:] = often[same] / siblings[1:]
        place[1:] /= siblings[1:]
        np.maximum.at(near, of, text[1:])
        near = np.where(np.arange(n) > 0, near[up], 0)
    whole = max(text[0], 1.0)
    columns = [
        (tag[:, None] == np.arange(N_TAGS)), kinds, above, (tag[up][:, None] == np.arange(N_TAGS))[:, [0, 1, 2, 3, 7, 8, 9, 10, 11, 18]],
        np.stack([
            np.array([x.depth for x in nodes]), np.log1p(siblings), place, alike, np.log1p(text), text / whole, link / np.maximum(text, 1), np.log1p(text / below), mark / np.maximum(word, 1),
            np.log1p(word), np.log1p(paragraphs), np.log1p(anchors), np.log1p(below), text[up] / whole, link[up] / np.maximum(text[up], 1), np.log1p(near), text / np.maximum(text[up], 1), np.log1p(own[1:]),
            np.cumsum(own)[:-1] / whole,
        ], 1),
    ]
    return np.concatenate(columns, 1).astype(np.float32)


def decode(nodes: list[Node], runs: list[tuple[int, str]], odds: np.ndarray) -> list[bool]:
    """For each node whether it is kept: the likeliest labelling without contradictions."""
    n = len(nodes)
    log_in, log_out = -np.logaddexp(0, -odds), -np.logaddexp(0, odds)
    has_text = np.zeros(n + 1)
    own = [False] * n
    for k, t in runs:
        if t.strip():
            own[k] = True
            has_text[k + 1] += 1
    total = np.cumsum(has_text)
    any_text = [total[x.last] > total[k] for k, x in enumerate(nodes)]
    gain = np.zeros(n).tolist()  # of keeping a node over dropping it, at best
    lead = (log_in - log_out).tolist()
    for k in range(n - 1, -1, -1):
        x = nodes[k]
        if not any_text[k]:
            gain[k] = -1e9
            continue
        below = [gain[c] for c in x.children]
        kept = sum(g for g in below if g > 0)
        if not own[k] and kept == 0:
            kept = max(below, default=-1e9)  # a kept node keeps something
        gain[k] = lead[k] + kept
    keep = [False] * n
    keep[0] = gain[0] > 0
    for k, x in enumerate(nodes):
        if keep[k] and x.children:
            good = [c for c in x.children if gain[c] > 0]
            if not good and not own[k]:
                good = [max(x.children, key=gain.__getitem__)]
            for c in good:
                keep[c] = True
    return keep


def blocks(nodes: list[Node], runs: list[tuple[int, str]], keep: list[bool] | None = None) -> list[str]:
    """Text of the kept nodes by block: runs of one block with no other block between them, white space turned into single spaces."""
    out: list[str] = []
    last, held = -1, []
    block_of = list(range(len(nodes)))
    for k, x in enumerate(nodes):
        if k and x.tag not in BLOCK:
            block_of[k] = block_of[x.parent]

    def flush() -> None:
        if held and (t := " ".join("".join(held).split())):
            out.append(t)
        held.clear()

    seen = 0
    for k, t in runs:
        b = block_of[k]
        crossed = any(nodes[x].tag in BLOCK for x in range(seen + 1, k + 1)) if k > seen else False
        if b != last or crossed:
            flush()
        last, seen = b, max(seen, k)
        if keep is None or keep[k]:
            held.append(t)
    flush()
    return out


def extract(sources: list[str], model: Boosted, part: int = 8192) -> list[str]:
    """The main text of each page; pages are scored together until they have ``part`` nodes."""
    out, held, size = [], [], 0

    def flush() -> None:
        odds, at = model.score(np.concatenate([x for _, _, x in held])) if held else [], 0
        for nodes, runs, x in held:
            out.append("\n".join(blocks(nodes, runs, decode(nodes, runs, odds[at : at + len(x)]))))
            at += len(x)
        held.clear()

    for s in sources:
        nodes, runs = parse(s)
        held.append((nodes, runs, features(nodes, runs)))
        size += len(nodes)
        if size >= part:
            flush()
            size = 0
    flush()
    return out


# -- training pages ------------------------------------------------------------------------------------


class Maker:
    """Pages of many layouts. Article text carries a mark, which is taken out after parsing and gives the labels."""

    MARK = "\ue000"

    def __init__(self, seed: int, part: int | None = 0):
        """``part``: of each kind's names every second one, from the first (0, for training) or the second (1); None: names that no list knows."""
        self.r, self.part = random.Random(seed), part
        letters = self.r.choice(["etaoinshrdlu", "easrnidtulocé", "enisratdhuößä", "кноаиетсрв", "aeiounrstlk"])
        self.words = ["".join(self.r.choices(letters, k=self.r.randint(1, 10))) for _ in range(300)]

    def phrase(self, low: int, high: int) -> str:
        return " ".join(self.r.choices(self.words, k=self.r.randint(low, high)))

    def prose(self, low: int = 1, high: int = 90) -> str:
        said = []
        for _ in range(self.r.choice([1, 1, 2, 3, 5])):
            said.append(self.phrase(low, max(low, high // 3)).capitalize() + self.r.choice(".....?!"))
        return " ".join(said)

    def tag(self, name: str, kind: str, inner: str, bare: float = 0.25) -> str:
        """An element of a kind; some have no telling attribute, or one that no list knows."""
        attribute = ""
        if self.r.random() > bare and kind:
            token = self.r.choice(KINDS[kind].split()[self.part :: 2]) if self.part is not None else "x" + self.r.choice("bcdfgk") * 4
            extra = self.r.choice(["", "", " box", "-wrapper", " clearfix", "-1", " col-md-8"])
            attribute = f' {self.r.choice(["class", "class", "id"])}="{token}{extra}"'
        elif self.r.random() < 0.3:
            attribute = f' class="{self.r.choice(["x1", "row", "container", "wrap", "inner", "css-1ab"])}"'
        shut = "" if self.r.random() < 0.02 else f"</{name}>"
        return f"<{name}{attribute}>{inner}{shut}"

    def links(self, low: int, high: int, wrap: bool = True) -> str:
        items = [f'<a href="/{self.r.choice(self.words)}">{self.phrase(1, 4)}</a>' for _ in range(self.r.randint(low, high))]
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>" if wrap and self.r.random() < 0.7 else self.r.choice([" ", " | ", "&middot;"]).join(items)

    def paragraph(self) -> str:
        m, r = self.MARK, self.r
        text = m + self.prose()
        if r.random() < 0.2:
            text += f' <a href="#">{m}{self.phrase(1, 4)}</a> {m}{self.phrase(1, 8)}.'
        if r.random() < 0.2:
            text = r.choice(["<b>{}</b>", "<b>{}", "<em>{}</em>", "<span>{}</span>", "<b>{}<br>"]).format(text)
        return f"<p>{text}" + ("</p>" if r.random() < 0.9 else "")

    def article(self) -> str:
        r, m, out = self.r, self.MARK, []
        if r.random() < 0.8:
            title = f"<h1>{m}{self.phrase(2, 12)}</h1>"
            out.append(f"<header>{title}</header>" if r.random() < 0.1 else title)
        for _ in range(r.choice([1, 1, 2, 3, 4, 5, 7, 10, 15, 25])):
            kind = r.random()
            if kind < 0.78:
                out.append(self.paragraph())
            elif kind < 0.86:
                out.append(f"<h{r.randint(2, 4)}>{m}{self.phrase(1, 6)}</h2>" if r.random() < 0.1 else f"<h2>{m}{self.phrase(1, 6)}</h2>")
            elif kind < 0.91:
                name = r.choice(["ul", "ol"])
                out.append(f"<{name}>" + "".join(f"<li>{m}{self.phrase(2, 20)}</li>" for _ in range(r.randint(2, 6))) + f"</{name}>")
            elif kind < 0.94:
                out.append(f"<blockquote>{self.paragraph()}</blockquote>")
            elif kind < 0.96:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{m}{self.phrase(1, 3)}</td>" for _ in range(3)) + "</tr>" for _ in range(r.randint(2, 4))) + "</table>")
            elif kind < 0.98:
                out.append(f"<pre>{m}{self.prose()}</pre>")
            else:
                out.append(self.aside())
        return "".join(out)

    def aside(self) -> str:
        """Something that is no article text, inside or beside it."""
        r = self.r
        return r.choice([
            lambda: self.tag(r.choice(["div", "aside", "section"]), "advert", r.choice([self.prose(1, 40), f"<p>{self.prose(1, 30)}</p>", self.links(1, 3)]), 0.0),
            lambda: self.tag(r.choice(["div", "section"]), "notice", f"<p>{self.prose(3, 30)}</p>" + r.choice(["", "<button>ok</button>", self.links(1, 2, False)]), 0.0),
            lambda: self.tag("aside", "side", f"<h3>{self.phrase(1, 4)}</h3>" + r.choice([self.links(2, 8), f"<p>{self.prose()}</p>"])),
            lambda: self.tag("div", "side", f"<h3>{self.phrase(1, 4)}</h3>" + r.choice([self.links(2, 8), f"<p>{self.prose()}</p>"]), 0.0),
            lambda: self.tag("form", "form", f"<label>{self.phrase(1, 5)}</label><input name=q>" + r.choice(["", f"<p>{self.prose(2, 20)}</p>"])),
            lambda: self.tag("div", "share", self.links(1, 5), 0.0),
        ])()

    def comments(self) -> str:
        r = self.r
        one = lambda: self.tag(r.choice(["div", "li", "article"]), "comment", r.choice([f"<b>{self.phrase(1, 2)}</b><p>{self.prose()}</p>", f"<p>{self.prose()}</p>", self.prose()]), 0.3)
        return self.tag(r.choice(["section", "div", "ol"]), "comment", r.choice(["", f"<h2>{self.phrase(1, 3)}</h2>"]) + "".join(one() for _ in range(r.randint(1, 8))), 0.0)

    def page(self) -> str:
        r, out = self.r, []
        top = [
            lambda: self.tag("header", "edge", r.choice(["", f"<h1>{self.phrase(1, 3)}</h1>"]) + r.choice(["", f"<p>{self.phrase(2, 8)}</p>"]) + self.links(0, 6)),
            lambda: self.tag("nav", "menu", self.links(2, 12)),
            lambda: self.tag("div", "menu", self.links(2, 12), 0.1),
            lambda: self.tag("div", "edge", self.phrase(1, 6) + self.links(1, 5), 0.0),
            lambda: self.tag("div", r.choice(["advert", "notice"]), self.prose(1, 30), 0.0),
            self.aside,
            self.aside,
        ]
        for f in r.sample(top, r.randint(0, 5)):
            out.append(f())
        inner = self.article()
        if r.random() < 0.25:
            inner += self.comments()
        shape = r.random()
        main = (
            f"<article>{inner}</article>" if shape < 0.4 else self.tag("article", "article", inner) if shape < 0.5 else self.tag("main", "article", inner) if shape < 0.6
            else self.tag("div", "article", inner, 0.15) if shape < 0.85 else self.tag("main", "article", f"<article>{inner}</article>") if shape < 0.95 else inner
        )
        beside = [self.aside() for _ in range(r.choice([0, 0, 0, 1, 2]))] + ([self.comments()] if r.random() < 0.25 else [])
        middle = main + "".join(beside) if r.random() < 0.8 else "".join(beside[:1]) + main + "".join(beside[1:])
        out.append(f'<div class="{r.choice(["wrap", "container", "layout", "page"])}">{middle}</div>' if r.random() < 0.4 else middle)
        for _ in range(r.choice([0, 1, 1, 1])):
            line = f"&copy; {self.phrase(1, 3)} " + r.choice(["", self.prose(1, 20), self.links(1, 5)])
            out.append(self.tag("footer", "edge", line) if r.random() < 0.8 else self.tag("div", "edge", line, 0.0))
        if r.random() < 0.2:
            out.append(self.aside())
        page = f"<!DOCTYPE html><html><head><title>{self.phrase(1, 9)}</title><style>p{{}}</style></head><body>" + "".join(out)
        return page + ("</body></html>" if r.random() < 0.85 else "")

    def labelled(self) -> tuple[list[Node], list[tuple[int, str]], np.ndarray]:
        """A parsed page without the marks, and whether each node's subtree has article text."""
        nodes, runs = parse(self.page())
        good = np.zeros(len(nodes) + 1)
        for k, t in runs:
            good[k + 1] += self.MARK in t
        total = np.cumsum(good)
        return nodes, [(k, t.replace(self.MARK, "")) for k, t in runs], np.array([total[x.last] > total[k] for k, x in enumerate(nodes)], dtype=float)


@functools.lru_cache(maxsize=2)
def train(pages: int = 900, seed: int = 5, trees: int = 90) -> Boosted:
    """From generated pages only, a fifth of them with names that say nothing; the same for every corpus."""
    made = [Maker(seed * 100_003 + k, None if k % 5 == 4 else 0).labelled() for k in range(pages)]
    x, y = [], []
    for nodes, runs, label in made:
        rows = features(nodes, runs)
        filled = np.expm1(rows[:, -15]) > 0.5  # log1p(text): nodes without text have no label
        x.append(rows[filled])
        y.append(label[filled])
    return Boosted.fit(np.concatenate(x), np.concatenate(y), trees=trees)


def main_texts(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = (), model: Boosted | None = None) -> DataFrame:
    """One row for each page: id, the columns of ``keep``, ``text`` (the main text, empty if there is none) and ``n_chars``.

    Null and empty pages have empty texts. Pages of any length and nesting are read whole, in time linear in their length.
    Repeated rows stay, with null ids as well; other columns are ignored. An empty table gives no rows.
    """
    model = model or train()
    rows = pages.select(F.col(id_col), *keep, F.coalesce(F.col(html_col), F.lit("")).alias("source of page"))
    n = 1 + len(keep)
    schema = rows.drop("source of page").withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema
    names = [f.name for f in schema]

    def run(batches):
        for some in slices(batches, 256):
            texts = extract(some.column(n).to_pylist(), model)
            yield pa.RecordBatch.from_arrays([*(some.column(i) for i in range(n)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names)

    return rows.mapInArrow(run, schema)


def op8_html(spark, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"), keep=("url",))
