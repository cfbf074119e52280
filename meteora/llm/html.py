"""Main-text extraction by gradient-boosted trees over DOM nodes.

A page is parsed into its block elements.  Each has features: its tag, depth,
attribute tokens, the text, links, tags and punctuation of its subtree, and how it
stands among its siblings.  Trees, boosted in numpy on binned features, give the log odds
that a node belongs to the article.  Decoding is hierarchical: a node is kept only
if its parent is, and the choice of all nodes together with the highest sum of
log odds wins, by dynamic programming from the leaves up.

There are no labelled pages, so the trees learn from pages made out of a bounded sample
of the table (``SAMPLE_PAGES``): a page's own paragraphs in many layouts, with menus,
headers, footers, sidebars, notices, adverts, forms and reader comments put around and
into them.  Whether a node is boilerplate is known there.

Text: character references are decoded, white space inside a block becomes one space, blocks follow in page order
with one newline between.  Null html counts as empty; a page without text gives an empty text.  Broken markup is read as
browsers mostly do: unclosed elements end with their parent, stray end tags are ignored, a tag that never ends is text.
Whole pages are read, in time proportional to their length; repeated rows are each extracted; an empty table
gives an empty result.  Other columns are not returned.
"""

from __future__ import annotations

import html as entities
import random
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meteora.llm.common import with_text_columns

#: Pages the trees learn from at most, and the longest of them.
SAMPLE_PAGES = 240
SAMPLE_CHARS = 60_000
SLICE_BYTES = 1 << 20

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
                   "h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul").split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NO_TEXT = RAW | frozenset("head template button select option optgroup datalist object audio video canvas svg math noscript map".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "legend", "summary", "figcaption"}
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
# Words in class, id and role attributes that often name a part of a page.
OUTSIDE = frozenset(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb "
                     "breadcrumbs sidebar side aside widget footer foot header masthead topbar cookie cookies consent notice alert popup modal overlay "
                     "comment comments commentlist reply replies disqus discussion share sharing social related recommended newsletter subscribe signup "
                     "login form search pagination pager copyright legal toolbar tags meta toc skip contentinfo complementary").split())
INSIDE = frozenset("article content entry post story body text main page-content articlebody".split())
TAGS = ["div", "p", "article", "section", "main", "nav", "header", "footer", "aside", "form", "ul", "ol", "li", "h1", "h2", "h3", "h4", "table", "tr", "td",
        "blockquote", "pre", "figure", "figcaption", "body"]

_NAME_END = re.compile(r"[\s/>]")
_ATTRIBUTE_END = re.compile("[>\"']")
_QUOTE = re.compile("[\"']")
_NAMED = re.compile(r"(?:\b(class|id|role|data-part)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))", re.I)
_WORD = re.compile(r"[a-z]+")


@dataclass
class Node:
    tag: str
    parent: int
    depth: int
    names: frozenset = frozenset()
    part: str = ""
    children: list[int] = field(default_factory=list)
    # of the subtree, with what the children hold
    chars: int = 0
    link_chars: int = 0
    stops: int = 0
    blocks: int = 0
    tags: int = 0
    longest: int = 0


class _Next:
    """The next match of a pattern; asked again before that match, it needs no search."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page, self.start, self.found = pattern, page, 0, -1

    def at(self, place: int) -> int:
        if not self.start <= place <= self.found:
            m = self.pattern.search(self.page, place)
            self.start, self.found = place, m.start() if m else len(self.page)
        return self.found


class _Tokens:
    """The tags, comments and declarations of a page, in time proportional to its length.

    What begins like a tag but never ends is text.  Such a start is not read to the end of the page twice: the next
    ends are kept, and so are the quotes from which no end is reached.
    """

    def __init__(self, page: str):
        self.page, self.limit = page, len(page)
        self.name_end, self.special, self.quote = (_Next(p, page) for p in (_NAME_END, _ATTRIBUTE_END, _QUOTE))
        self.hopeless: set[int] = set()
        self.no_more = self.limit + 1  # from here on there is no >

    def _end(self, at: int) -> int:
        """The place of the > that ends a tag whose attributes begin at ``at``; -1 for none."""
        opened = []
        while True:
            here = self.special.at(at)
            if here >= self.limit or here in self.hopeless:
                break
            if self.page[here] == ">":
                return here
            opened.append(here)
            close = self.page.find(self.page[here], here + 1)
            if close < 0:
                break
            at = close + 1
        self.hopeless.update(opened)
        return -1

    def next(self, at: int) -> tuple[int, int, bool, str | None, str] | None:
        """(start, end, is an end tag, name or None, attributes) of the first token from ``at`` on."""
        page = self.page
        while True:
            start = page.find("<", at)
            if start < 0:
                return None
            at = start + 1
            if page.startswith("<!--", start):
                end = page.find("-->", start + 4)
                return start, end + 3 if end >= 0 else self.limit, False, None, ""
            if page[at: at + 1] in ("!", "?") and at < self.limit:
                end = page.find(">", at) if at < self.no_more else -1
                if end >= 0:
                    return start, end + 1, False, None, ""
                self.no_more = min(self.no_more, at)
                continue
            closing = page.startswith("/", at)
            head = at + closing
            if not (page[head: head + 1].isascii() and page[head: head + 1].isalpha()):
                continue
            stop = self.name_end.at(head)
            end = self._end(stop)
            if end < 0 and self.quote.at(head) < stop:  # the name ran into a quoted value
                stop = self.quote.at(head)
                end = self._end(stop)
            if end >= 0:
                return start, end + 1, closing, page[head:stop], page[stop:end]


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The block elements, parents first, and the texts of blocks in page order: (node, text)."""
    nodes = [Node("#", -1, 0)]
    texts: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("#", 0)]  # open elements, and the block each is in
    own: list[str] = []
    linked = silent = links = 0
    names_open: Counter[str] = Counter()

    def push(name: str, block: int) -> None:
        nonlocal links
        stack.append((name, block))
        names_open[name] += 1
        links += name == "a"

    def end_block() -> None:
        nonlocal linked
        text = " ".join("".join(own).split())
        own.clear()
        if text:
            n, at = len(text), stack[-1][1]
            texts.append((at, text))
            node = nodes[at]
            node.chars += n
            node.link_chars += min(linked, n)
            node.stops += sum(map(text.count, ".!?,;:"))
            node.blocks += 1
            node.longest = max(node.longest, n)
        linked = 0

    def pop(to: int) -> None:
        nonlocal silent, links
        while len(stack) > to:
            name = stack[-1][0]
            names_open[name] -= 1
            links -= name == "a"
            if name in BLOCK:
                end_block()
            elif name in NO_TEXT:
                silent -= 1
            stack.pop()

    def say(piece: str) -> None:
        nonlocal linked
        if silent or not piece:
            return
        piece = entities.unescape(piece) if "&" in piece else piece
        own.append(piece)
        if links:
            linked += len(piece)

    at, limit, tokens = 0, len(page), _Tokens(page)
    while at < limit:
        token = tokens.next(at)
        if token is None:
            say(page[at:])
            break
        start, end, closing, name, attribute_text = token
        say(page[at:start])
        at = end
        if name is None:
            continue
        name = name.lower()
        nodes[stack[-1][1]].tags += 1
        if closing:
            if not names_open[name]:
                continue
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    pop(i)
                    break
            continue
        if name in VOID:
            if name == "br":
                own.append(" ")
            elif name == "hr":
                end_block()
            continue
        if name in CLOSES_P and names_open["p"]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p":
                    pop(i)
                    break
                if stack[i][0] in BLOCK:
                    break
        if name in ENDS and any(names_open[x] for x in ENDS[name][0]):
            closes, within = ENDS[name]
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in within:
                    break
                if stack[i][0] in closes:
                    pop(i)
                    if name != "tr":
                        break
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = close.start() if close else limit
            push(name, stack[-1][1])
            silent += 1
            continue
        block = stack[-1][1]
        if name in BLOCK:
            end_block()
            attributes = {k.lower(): a or b or c for k, a, b, c in _NAMED.findall(attribute_text)} if attribute_text else {}
            part = attributes.pop("data-part", "")
            names = frozenset(w for v in attributes.values() for w in _WORD.findall(v.lower()))
            nodes.append(Node(name, block, nodes[block].depth + 1, names, part))
            nodes[block].children.append(len(nodes) - 1)
            block = len(nodes) - 1
        elif name in NO_TEXT:
            silent += 1
        push(name, block)
    end_block()
    pop(1)
    for i in range(len(nodes) - 1, 0, -1):  # children come after their parents
        n, up = nodes[i], nodes[nodes[i].parent]
        up.chars += n.chars
        up.link_chars += n.link_chars
        up.stops += n.stops
        up.blocks += n.blocks
        up.tags += n.tags
        up.longest = max(up.longest, n.longest)
    return nodes, texts


N_FEATURES = 25


def features(nodes: list[Node]) -> np.ndarray:
    """One row per node."""
    out = np.zeros((len(nodes), N_FEATURES), np.float32)
    page = max(nodes[0].chars, 1)
    outside = [0] * len(nodes)  # named as boilerplate: in the node or above it
    before = 0
    places = [0] * len(nodes)  # among the siblings
    for n in nodes:
        for place, c in enumerate(n.children):
            places[c] = place
    for i, n in enumerate(nodes):
        up = nodes[n.parent] if i else n
        here = len(n.names & OUTSIDE)
        outside[i] = here + (outside[n.parent] if i else 0)
        siblings = up.children if i else [0]
        place = places[i]
        previous = nodes[siblings[place - 1]].chars if i and 0 < place else -1
        following = nodes[siblings[place + 1]].chars if i and place + 1 < len(siblings) else -1
        like = sum(nodes[s].tag == n.tag for s in siblings[max(0, place - 8): place + 9])
        most = max((nodes[c].chars for c in n.children), default=0)
        paragraphs = sum(nodes[c].tag == "p" for c in n.children)
        c = max(n.chars, 1)
        out[i] = (TAGS.index(n.tag) if n.tag in TAGS else -1, TAGS.index(up.tag) if up.tag in TAGS else -1, n.depth, np.log1p(n.chars), n.chars / page,
                  n.chars / max(up.chars, 1), n.link_chars / c, n.stops / c, n.blocks, n.chars / max(n.blocks, 1), n.tags * 10 / c, np.log1p(n.longest),
                  len(n.children), place, len(siblings) - place, like, np.log1p(max(previous, 0)) if previous >= 0 else -1,
                  np.log1p(max(following, 0)) if following >= 0 else -1, most / c, paragraphs, here, outside[i] - here, len(n.names & INSIDE),
                  len(up.names & INSIDE), before / len(nodes))
        before += 1
    return out


@dataclass
class Trees:
    """Boosted trees of depth 3 on binned features: log odds that a node is kept."""

    edges: list[np.ndarray]
    base: float
    splits: np.ndarray  # (trees, 7, 2): feature and bin of the inner nodes
    leaves: np.ndarray  # (trees, 8)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)], axis=1) if len(x) else np.zeros(x.shape, np.int64)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.bins(x), np.arange(len(x))
        out = np.full(len(x), self.base)
        for split, leaf in zip(self.splits, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(3):
                at = 2 * at + 1 + (b[rows, split[at, 0]] > split[at, 1])
            out += leaf[at - 7]
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 50, rate: float = 0.3, n_bins: int = 32) -> Trees:
    """Second-order boosting on the logistic loss; ties take the first split."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, n_bins)[1:-1])) if len(x) else np.zeros(0) for j in range(x.shape[1])]
    share = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
    model = Trees(edges, float(np.log(share / (1 - share))), np.zeros((0, 7, 2), np.int64), np.zeros((0, 8)))
    if len(set(y.tolist())) < 2:
        return model
    b = model.bins(x)
    raw, splits, leaves = np.full(len(y), model.base), [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, p * (1 - p)
        at, split, leaf = np.zeros(len(y), np.int64), np.zeros((7, 2), np.int64), np.zeros(8)
        for node in range(7):
            mine = np.nonzero(at == node)[0]
            best, split[node] = 0.0, (0, n_bins)
            if len(mine) >= 10:
                gs, hs = g[mine].sum(), h[mine].sum()
                for j in range(x.shape[1]):
                    gl = np.cumsum(np.bincount(b[mine, j], g[mine], n_bins))
                    hl = np.cumsum(np.bincount(b[mine, j], h[mine], n_bins))
                    gain = gl ** 2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs ** 2 / (hs + 1)
                    k = int(gain.argmax())
                    if gain[k] > best + 1e-9:
                        best, split[node] = gain[k], (j, k)
            at[mine] = 2 * node + 1 + (b[mine, split[node, 0]] > split[node, 1])
        for k in range(8):
            mine = at == 7 + k
            leaf[k] = rate * g[mine].sum() / (h[mine].sum() + 1)
        raw += leaf[at - 7]
        splits.append(split)
        leaves.append(leaf)
    model.splits, model.leaves = np.array(splits), np.array(leaves)
    return model


def decode(nodes: list[Node], odds: np.ndarray) -> list[bool]:
    """Kept nodes: the choice with the highest sum of log odds in which a kept node's parent is kept."""
    gain = np.clip(odds, -8, 8).tolist()
    for i in range(len(nodes) - 1, -1, -1):
        n = nodes[i]
        # the outermost elements hold everything and decide nothing
        gain[i] = (0.0 if n.tag in ("#", "html", "body") else gain[i]) + sum(max(0.0, gain[c]) for c in n.children)
    keep = [False] * len(nodes)
    for i, n in enumerate(nodes):
        keep[i] = n.tag in ("#", "html", "body") and (i == 0 or keep[n.parent]) or i > 0 and keep[n.parent] and gain[i] > 0
    return keep


_LAYOUTS = ["article", "main", "section", "div", 'div class="content"', 'div id="post-body"', 'div class="entry"', 'section class="story"', 'div class="text"']
_PARTS = {
    "nav": ["nav", 'div class="menu"', 'ul class="navbar"', 'div id="nav"', 'div class="breadcrumbs"', "div"],
    "header": ["header", 'div class="masthead"', 'div id="header"', 'div class="topbar"'],
    "footer": ["footer", 'div class="footer"', 'div id="foot"', 'div class="copyright"', "div"],
    "aside": ["aside", 'div class="sidebar"', 'div class="widget related"', 'section class="recommended"'],
    "notice": ['div class="cookie"', 'div class="notice"', 'section class="consent banner"', 'div class="alert"', 'p class="notice"'],
    "ad": ['div class="ad"', 'div class="advert"', 'aside class="sponsored"', 'div class="promo"', 'p class="ad"'],
    "form": ["form", 'form class="newsletter"', 'div class="subscribe form"'],
    "comments": ['section class="comments"', 'div id="comments"', 'ol class="commentlist"', 'div class="discussion"'],
}


def made_page(paragraphs: list[str], rng: random.Random) -> str:
    """A page out of an article's paragraphs, its boilerplate marked in ``data-part``."""
    words = " ".join(paragraphs).split() or ["text"]
    some = lambda low, high: entities.escape(" ".join(rng.choice(words) for _ in range(rng.randint(low, high))))

    def part(kind: str) -> str:
        opening = rng.choice(_PARTS[kind])
        tag, _, rest = opening.partition(" ")
        links = lambda n: "".join(f'<li><a href="#">{some(1, 3)}</a></li>' for _ in range(n))
        inner = {
            "nav": lambda: f"<ul>{links(rng.randint(3, 9))}</ul>" if tag != "ul" else links(rng.randint(3, 9)),
            "header": lambda: f"<div>{some(1, 4)}</div><p>{some(2, 9)}</p>",
            "footer": lambda: f"&copy; {some(1, 14)}" + f"<ul>{links(rng.randint(1, 4))}</ul>" * rng.randint(0, 1),
            "aside": lambda: f"<h3>{some(1, 4)}</h3>" + (f"<ul>{links(rng.randint(2, 7))}</ul>" if rng.random() < 0.6 else f"<p>{some(5, 40)}.</p>"),
            "notice": lambda: some(5, 30) if rng.random() < 0.6 else f"<p>{some(5, 30)}.</p>",
            "ad": lambda: some(2, 25),
            "form": lambda: f"<label>{some(1, 4)}</label><input name='q'><p>{some(2, 12)}</p>",
            "comments": lambda: f"<h3>{some(1, 3)}</h3>" * rng.randint(0, 1) + "".join(
                f"<{u}><p>{some(1, 3)}</p><p>{some(4, 50)}.</p></{u}>" for u in [rng.choice(["div", "li", "article"])] for _ in range(rng.randint(1, 6))),
        }[kind]()
        return f"<{tag}{' ' * bool(rest)}{rest} data-part='out'>{inner}</{tag}>"

    body = [f"<h1>{some(2, 9)}</h1>"] * rng.randint(0, 1)
    for p in paragraphs:
        kind = rng.random()
        text = entities.escape(p)
        body.append(f"<h2>{some(1, 6)}</h2><p>{text}</p>" if kind < 0.06 else f"<blockquote>{text}</blockquote>" if kind < 0.1 else f"<div>{text}</div>" if kind < 0.14 else
                    f"<ul><li>{text}</li><li>{some(2, 15)}.</li></ul>" if kind < 0.18 else f"<table><tr><td>{text}</td><td>{some(1, 6)}</td></tr></table>" if kind < 0.2 else
                    f"<p>{text} <a href='#'>{some(1, 4)}</a></p>" if kind < 0.3 else f"<p>{text}</p>")
        if rng.random() < 0.06:
            body.append(part(rng.choice(["ad", "notice", "form", "aside"])))
    layout = rng.choice(_LAYOUTS)
    tag = layout.partition(" ")[0]
    article = f"<{layout}>{''.join(body)}</{tag}>"
    if rng.random() < 0.3:
        article = f"<div{rng.choice(['', ' class=wrap', ' id=container'])}>{article}{part('aside') if rng.random() < 0.5 else ''}</div>"
    top = [part(k) for k in ("nav", "header", "notice", "ad") if rng.random() < 0.5]
    bottom = [part(k) for k in ("comments", "aside", "ad", "form", "footer") if rng.random() < 0.5]
    rng.shuffle(top)
    return f"<html><head><title>x</title></head><body>{''.join(top)}{article}{''.join(bottom)}</body></html>"


def fit(pages: DataFrame, sample_pages: int = SAMPLE_PAGES, sample_chars: int = SAMPLE_CHARS, layouts: int = 6) -> Trees:
    """Trees from a bounded sample of the pages, in the order of a hash of the text.  Pages of
    over ``sample_chars`` fill it up if the others do not, shortest first and whole: the
    first, and then those that fit in ``sample_pages * sample_chars`` bytes together."""
    able = pages.select("html").where("html is not null").select(
        "html", F.xxhash64("html").alias("__h"), F.greatest(F.length("html") - sample_chars, F.lit(0)).alias("__over"), F.octet_length("html").alias("__bytes"))
    # the hashes are chosen first: tasks send numbers to one place, not pages
    first = able.select("__over", "__h", "__bytes").distinct().orderBy("__over", "__h", "__bytes").limit(sample_pages).collect()
    chosen, used = [], 0  # bytes of long pages
    for r in first:
        before, used = used, used + (r["__bytes"] if r["__over"] else 0)
        if not r["__over"] or not before or used <= sample_pages * sample_chars:
            chosen.append(r["__h"])
    got = able.where(F.col("__h").isin(chosen)).dropDuplicates(["__h"]).orderBy("__over", "__h").collect()
    rng, x, y = random.Random(5), [], []
    for row in got:
        nodes, texts = parse(row["html"])
        paragraphs = [t for at, t in texts if nodes[at].tag == "p"] or [t for _, t in texts]
        for _ in range(layouts):
            some = paragraphs[: rng.choice([1, 2, 4, 8, 30])]
            made, _ = parse(made_page(some, rng))
            out = [False] * len(made)
            for i, n in enumerate(made):
                out[i] = bool(n.part) or i > 0 and out[n.parent]
            use = [i for i, n in enumerate(made) if n.chars and n.tag not in ("#", "html", "body")]
            x.append(features(made)[use])
            y += [0.0 if out[i] else 1.0 for i in use]
    return boost(np.concatenate(x) if x else np.zeros((0, N_FEATURES), np.float32), np.array(y))


def extract(page: str, model: Trees) -> str:
    """The main text of one page."""
    nodes, texts = parse(page)
    if not texts:
        return ""
    keep = decode(nodes, model.log_odds(features(nodes)))
    return "\n".join(t for at, t in texts if keep[at])


def with_main_text(pages: DataFrame, model: Trees) -> DataFrame:
    """``pages`` without ``html`` and with ``text`` and ``n_chars``."""
    def make():
        def f(texts):
            parsed = [parse(p) for p in texts.to_pylist()]
            odds = model.log_odds(np.concatenate([features(n) for n, _ in parsed])) if parsed else np.zeros(0)
            out, at = [], 0
            for nodes, found in parsed:
                keep = decode(nodes, odds[at: at + len(nodes)])
                at += len(nodes)
                out.append("\n".join(t for i, t in found if keep[i]))
            return [pa.array(out, pa.string()), np.fromiter(map(len, out), np.int64, len(out))]
        return f
    return with_text_columns(pages, [("text", "string"), ("n_chars", "bigint")], make, text="html", keep_text=False, slice_bytes=SLICE_BYTES)
