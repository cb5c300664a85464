"""Main-text extraction by gradient-boosted trees over DOM-node features.

A page becomes a tree of block elements; inline elements dissolve into the text
runs of the block around them.  Each node has features of its subtree (text
length, link and punctuation density, paragraphs, form controls), its tag, the
tokens of its class, id and role attributes, its depth, siblings, position and
ancestors.  Boosted trees, trained in numpy, give the probability that a node
holds main text.

Decoding is hierarchical: a node may only be kept if its parent is, and dropping
a node drops all below it.  Among these consistent choices the one of highest
likelihood is found bottom-up; each node counts with the logarithm of its text.
So no paragraph is torn out of a dropped sidebar and no advert stays because the
article around it does.

Training pages come from the pages themselves: the texts of a bounded sample are
laid out anew, by a fixed seed, with containers and boilerplate of many kinds,
tags and attribute tokens, so that each node's label is known by construction.

Text rules: character references are decoded; white space inside a block becomes
one space; blocks are trimmed and joined in page order by one space.

Defined cases: null and empty html, and pages without main text, give the empty
text; unclosed and stray tags, comments, scripts and quotes are read leniently;
plain text without tags is one block; very long pages are parsed whole; repeated
rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts, sample_by_hash

#: Bounds of what is fitted on: sampled pages (whole ones), layouts of each page.
FIT_PAGES, FIT_LAYOUTS = 150, 12
TREES, TREE_DEPTH, LEARNING_RATE, BINS = 80, 5, 0.25, 32

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is never text of a page.
HIDDEN = frozenset("head title noscript template svg math iframe object audio video canvas select datalist dialog map".split())
#: What may stand in a head; those with content of their own, which is no text of the page.
HEAD = frozenset("head html title meta link style script base basefont bgsound noscript noframes template".split())
HEAD_CONTENT = frozenset("title noscript template".split())
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer
form h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol p pre section summary table tbody td textarea tfoot th thead tr ul ins""".split())
#: What an opening tag closes implicitly, if it is open within the nearest of the stopping elements.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
CLOSE_P = BLOCK - frozenset("button caption td th tr tbody thead tfoot label legend ins body html".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|xmp|noembed|noframes)\b[^>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S | re.I)
_ATTR = re.compile(r"(?:^|\s)(?:class|id|role)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
_PUNCT = re.compile(r"[.,;:!?]")

#: Attribute tokens by what they usually mark.
TOKENS = {
    "menu": "nav navbar navigation menu menubar breadcrumb breadcrumbs crumbs tabs pager pagination toc skip links".split(),
    "header": "header masthead topbar branding brand logo banner tagline hero".split(),
    "footer": "footer foot copyright colophon legal contentinfo bottom imprint".split(),
    "sidebar": "sidebar aside side related widget widgets recommended recommendations trending popular complementary rail teaser more also".split(),
    "notice": "cookie cookies consent notice alert popup modal overlay gdpr privacy paywall disclaimer warning toast message announcement".split(),
    "advert": "ad ads advert adverts advertisement advertising sponsored sponsor promo promotion promoted adsense dfp commercial affiliate outbrain taboola".split(),
    "form": "form search login signin signup register newsletter subscribe subscription contact feedback poll survey".split(),
    "comments": "comment comments commentlist replies reply responses respond disqus discussion reviews review thread guestbook".split(),
    "share": "share sharing social follow tweet likes tools toolbar print".split(),
    "main": "article content post entry main story body text prose page single blog articlebody maincontent entrycontent".split(),
}
GROUPS = tuple(TOKENS)
_ALL_GROUPS = (1 << len(GROUPS)) - 1
_GROUP_OF = {t: i for i, g in enumerate(GROUPS) for t in TOKENS[g]}

TAG_GROUPS = ("nav", "header", "footer", "aside", "form", "article", "main", "section", "div", "p", "title", "heading", "list", "item", "table",
              "quote", "run", "body", "control", "other")
_TAG_OF = {t: TAG_GROUPS.index(g) for g, names in {
    "nav": "nav menu", "header": "header hgroup", "footer": "footer", "aside": "aside", "form": "form fieldset", "article": "article", "main": "main",
    "section": "section", "div": "div center address details ins", "p": "p", "title": "h1 h2", "heading": "h3 h4 h5 h6", "list": "ul ol dl",
    "item": "li dd dt", "table": "table tbody thead tfoot tr td th caption", "quote": "blockquote pre figure figcaption", "run": "#run",
    "body": "body html #root", "control": "button label legend textarea summary"}.items() for t in names.split()}
#: Ancestor tags that are features of what is below them.
ABOVE = ("nav", "header", "footer", "aside", "form", "article", "main")
N_NUMBERS = 20
N_FEATURES = N_NUMBERS + len(TAG_GROUPS) + 2 * len(GROUPS) + len(ABOVE)


class Node:
    __slots__ = ("tag", "groups", "parent", "children", "text", "chars", "link_chars", "links", "elements", "paragraphs", "controls", "punct", "words", "at", "y")

    def __init__(self, tag: str, groups: int, parent: "Node | None"):
        self.tag, self.groups, self.parent = tag, groups, parent
        self.children: list[Node] = []
        self.text = ""
        self.chars = self.link_chars = self.links = self.elements = self.paragraphs = self.controls = self.punct = self.words = 0
        self.at = 0
        self.y = -1


_groups_seen: dict[str, int] = {}


def attribute_groups(attrs: str) -> int:
    """Bit set of the token groups that occur in class, id and role."""
    if not attrs or attrs.isspace():
        return 0
    found = _ATTR.findall(attrs)
    if not found:
        return 0
    key = " ".join(a or b or c for a, b, c in found)
    bits = _groups_seen.get(key)
    if bits is None:
        bits = 0
        whole = key.lower().split()
        for token in (*_SPLIT.split(_CAMEL.sub(r"\1 \2", key).lower()), *whole):
            if (g := _GROUP_OF.get(token)) is not None:
                bits |= 1 << g
        if len(_groups_seen) < 100_000:
            _groups_seen[key] = bits
    return bits


def parse(page: str | None) -> Node:
    """Tree of block elements; text runs between them are ``#run`` leaves."""
    root = Node("#root", 0, None)
    stack: list[Node] = [root]
    inline: list[str] = []  # open inline elements
    runs: list[str] = []
    opens: dict[str, int] = {}  # how many elements of a name are open
    state = {"hidden": 0, "link": 0, "controls": 0, "links": 0, "inlines": 0}
    run_link = 0

    def flush() -> None:
        nonlocal run_link
        text = " ".join(html_lib.unescape("".join(runs)).split()) if runs else ""
        top = stack[-1]
        if text:
            node = Node("#run", 0, top)
            node.text, node.chars, node.link_chars = text, len(text), min(run_link, len(text))
            node.links, node.controls, node.elements = state["links"], state["controls"], state["inlines"]
            node.punct, node.words = len(_PUNCT.findall(text)), text.count(" ") + 1
            top.children.append(node)
        elif state["controls"]:
            top.controls += state["controls"]
        runs.clear()
        run_link = state["links"] = state["controls"] = state["inlines"] = 0

    def pop_to(i: int) -> None:
        flush()
        for node in stack[i:]:
            opens[node.tag] -= 1
        del stack[i:]
        state["link"] = 0

    def opened(tags: tuple, stops: tuple) -> int:
        if not any(opens.get(t) for t in tags):
            return 0  # spares a walk up a deep stack
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in stops:
                return 0
        return 0

    page = page or ""
    at, hidden_tag = 0, ""
    within, depth = "", 0  # the head's open element with content
    inside: list[str] = []  # blocks opened within the hidden element
    last_end: dict[str, int] = {}  # where the last end tag of a name stands

    def ends_later(name: str, pos: int) -> bool:
        if name not in last_end:
            found = [m.start() for m in re.finditer(rf"</{re.escape(name)}[\s/>]", page, re.I)]
            last_end[name] = found[-1] if found else -1
        return last_end[name] >= pos

    def out_of_hidden(name: str, closing: bool) -> bool:
        """A block tag that a hidden element without end tag can't contain: the end tag of an element around it,
        or, if no end tag of its own follows at all, the next block."""
        if name not in BLOCK or hidden_tag == "head":
            return False
        if not closing:
            inside.append(name)
            return not ends_later(hidden_tag, at)
        if name in inside:
            while inside.pop() != name:
                pass
            return False
        return bool(opens.get(name))

    def in_head() -> bool:
        return state["hidden"] > 0 and hidden_tag == "head" and not within

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            if in_head() and not piece.isspace():
                state["hidden"] = 0  # text ends a head
            if not state["hidden"]:
                runs.append(piece)
                if state["link"]:
                    run_link += len(piece)
        at = m.end()
        name = m.group(3) or m.group(6)
        if name is None:
            continue
        name = name.lower()
        closing = (m.group(2) or m.group(5)) == "/"
        if in_head() and not closing and name not in HEAD:
            state["hidden"] = 0  # the end tag of a head is optional
        if state["hidden"] and out_of_hidden(name, closing):
            state["hidden"] = 0
        if state["hidden"]:
            if hidden_tag == "head" and name in HEAD_CONTENT:
                if not within and not closing and not (m.group(4) or m.group(7) or "").endswith("/"):
                    within, depth = name, 1
                elif name == within and (closing or name == "template"):
                    depth += -1 if closing else 1
                    within = within if depth else ""
            elif name == hidden_tag:
                state["hidden"] += -1 if closing else 1
            elif hidden_tag == "head" and name == "body":
                state["hidden"] = 0
            if state["hidden"] or name != "body" or closing:
                continue
        if name in BLOCK:
            if closing:
                if name == "p" and not opened(("p",), ()):
                    flush()  # stands for an empty paragraph
                    continue
                if i := opened((name,), ()):
                    if name not in ("body", "html"):
                        pop_to(i)
            else:
                if name in CLOSE_P and (i := opened(("p",), ("button", "td", "th", "caption"))):
                    pop_to(i)
                if name in CLOSES and (i := opened(CLOSES[name], STOPS[name])):
                    pop_to(i)
                flush()
                if name == "hr":
                    continue
                if name in ("html", "body") and opened((name,), ()):
                    continue
                node = Node(name, attribute_groups(m.group(4) or m.group(7) or ""), stack[-1])
                node.controls = int(name in ("button", "textarea"))
                stack[-1].children.append(node)
                stack.append(node)
                opens[name] = opens.get(name, 0) + 1
        elif name == "a":
            state["link"] = 0 if closing else 1
            if not closing:
                state["links"] += 1
        elif name in HIDDEN:
            if not closing:
                attrs = m.group(4) or m.group(7) or ""
                if not attrs.endswith("/"):
                    state["hidden"], hidden_tag, within = 1, name, ""
                    inside.clear()
                if name == "select":
                    state["controls"] += 1
        elif name in VOID:
            if name == "br":
                runs.append(" ")
            elif name == "input":
                state["controls"] += 1
        elif not closing:
            state["inlines"] += 1
    if at < len(page) and (not state["hidden"] or in_head()):
        rest = page[at:]
        cut = re.search(r"<[/a-zA-Z!?][^<>]*\Z", rest)  # a tag that the page's end cuts off is no text
        runs.append(rest[:cut.start()] if cut else rest)
    flush()
    return root


def nodes_of(root: Node) -> list[Node]:
    """All nodes in page order; sums of each subtree are filled in.

    A block whose only child is a run takes it over, so a paragraph is one node.
    """
    order, todo = [], [root]
    while todo:
        n = todo.pop()
        if len(n.children) == 1 and n.children[0].tag == "#run" and n.tag != "#root":
            r = n.children[0]
            n.text, n.chars, n.link_chars, n.links = r.text, r.chars, r.link_chars, r.links
            n.elements, n.punct, n.words = r.elements, r.punct, r.words
            n.controls += r.controls
            n.children = []
        order.append(n)
        todo.extend(reversed(n.children))
    at = 0
    for n in order:
        n.at = at
        if n.text:
            at += n.chars
    for n in reversed(order):
        n.paragraphs += int(n.tag == "p" and n.chars > 0)
        if (p := n.parent) is not None:
            p.chars += n.chars
            p.link_chars += n.link_chars
            p.links += n.links
            p.elements += n.elements + (n.tag != "#run")
            p.paragraphs += n.paragraphs
            p.controls += n.controls
            p.punct += n.punct
            p.words += n.words
    return order


_LOG = [math.log1p(i) for i in range(4096)]


def log1p(x: int) -> float:
    return _LOG[x] if x < 4096 else math.log1p(x)


def features(order: list[Node]) -> np.ndarray:
    out = np.zeros((len(order), N_FEATURES), dtype=np.float32)
    total = max(1, order[0].chars)
    above: dict[int, tuple[int, int, int]] = {}  # id(node) -> (depth, ancestor groups, ancestor tags) handed to its children
    rows, cols = [], []
    numbers = []
    place: dict[int, tuple[int, int, int, int]] = {}
    for k, n in enumerate(order):
        depth, groups, tags = above[id(n.parent)] if n.parent is not None else (0, 0, 0)
        own = n.groups & _ALL_GROUPS
        if n.children:
            mine = ABOVE.index(n.tag) if n.tag in ABOVE else -1
            above[id(n)] = (depth + 1, groups | own, tags | (1 << mine if mine >= 0 else 0))
            kids = n.children
            for i, c in enumerate(kids):
                place[id(c)] = (i, len(kids), kids[i - 1].chars if i else 0, kids[i + 1].chars if i + 1 < len(kids) else 0)
        i, count, before, after = place.get(id(n), (0, 1, 0, 0))
        chars = n.chars
        parent = n.parent.chars if n.parent is not None else chars
        numbers.append((
            depth, i, count, i / count, log1p(chars), chars / total, n.link_chars / chars if chars else 0.0, chars / (n.elements + 1),
            n.punct / n.words if n.words else 0.0, log1p(n.elements), log1p(n.paragraphs), chars / parent if parent else 0.0,
            log1p(before), log1p(after), n.at / total, log1p(n.controls), log1p(n.links), chars / n.paragraphs if n.paragraphs else 0.0,
            log1p(n.words), len(n.children)))
        rows.append(k)
        cols.append(N_NUMBERS + _TAG_OF.get(n.tag, len(TAG_GROUPS) - 1))
        first = N_NUMBERS + len(TAG_GROUPS)
        for bits in (own, groups, tags):
            j = first
            while bits:
                if bits & 1:
                    rows.append(k)
                    cols.append(j)
                bits >>= 1
                j += 1
            first += len(GROUPS)
    out[:, :N_NUMBERS] = numbers
    out[rows, cols] = 1
    return out


# --- gradient boosting -----------------------------------------------------------------------------------------------


@dataclass
class Boosted:
    """Trees of fixed depth: at each inner node a feature and a threshold, at each leaf a value."""

    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    leaf: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    base: float = 0.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base, dtype=np.float32)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(TREE_DEPTH):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            z += leaf[at - len(f)]
        return z


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Boosted:
    """Histogram gradient boosting with logistic loss."""
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    inner = (1 << TREE_DEPTH) - 1
    share = float((weight * y).sum() / weight.sum())
    base = math.log(max(share, 1e-3) / max(1 - share, 1e-3))
    z = np.full(len(y), base)
    trees = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-z))
        g, h = weight * (p - y), weight * p * (1 - p)
        feature, threshold = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf, dtype=np.float32)
        at = np.zeros(len(y), dtype=np.int64)
        for depth in range(TREE_DEPTH):
            first = (1 << depth) - 1
            local = at - first
            size = 1 << depth
            best = np.full(size, 1e-6)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                width = len(c) + 1
                key = local * width + binned[:, j]
                gs = np.bincount(key, weights=g, minlength=size * width).reshape(size, width)
                hs = np.bincount(key, weights=h, minlength=size * width).reshape(size, width)
                gl, hl = np.cumsum(gs, axis=1)[:, :-1], np.cumsum(hs, axis=1)[:, :-1]
                ga, ha = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                gain = gl ** 2 / (hl + 1) + (ga - gl) ** 2 / (ha - hl + 1) - ga ** 2 / (ha + 1)
                k = gain.argmax(axis=1)
                top = gain[np.arange(size), k]
                better = top > best
                best[better] = top[better]
                feature[first:first + size][better] = j
                threshold[first:first + size][better] = c[k[better]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[at]] > threshold[at])
        slot = at - inner
        gs, hs = np.bincount(slot, weights=g, minlength=inner + 1), np.bincount(slot, weights=h, minlength=inner + 1)
        leaf = -LEARNING_RATE * gs / (hs + 1)
        z += leaf[slot]
        trees.append((feature, threshold, leaf.astype(np.float32)))
    return Boosted(np.stack([t[0] for t in trees]), np.stack([t[1] for t in trees]), np.stack([t[2] for t in trees]), base)


# --- decoding --------------------------------------------------------------------------------------------------------


def decode(order: list[Node], logits: np.ndarray) -> list[Node]:
    """The nodes kept: of all choices in which a kept node's parent is kept, the likeliest."""
    z = np.clip(logits, -12, 12)
    keep_cost, drop_cost = np.log1p(np.exp(-z)), np.log1p(np.exp(z))
    number = {id(n): k for k, n in enumerate(order)}
    best_keep, drop_all = [0.0] * len(order), [0.0] * len(order)
    for k in range(len(order) - 1, -1, -1):
        n = order[k]
        w = 1.0 + log1p(n.chars) if n.chars else 0.0
        keep, drop = w * float(keep_cost[k]), w * float(drop_cost[k])
        for c in n.children:
            j = number[id(c)]
            keep += min(best_keep[j], drop_all[j])
            drop += drop_all[j]
        best_keep[k], drop_all[k] = keep, drop
    kept, open_ = [], {id(order[0])} if best_keep[0] <= drop_all[0] else set()
    for k, n in enumerate(order):
        if k == 0 or (id(n.parent) in open_ and best_keep[k] <= drop_all[k]):
            if id(order[0]) in open_:
                open_.add(id(n))
                kept.append(n)
    return kept


def extract_all(pages: list[str | None], model: Boosted) -> list[str]:
    orders = [nodes_of(parse(p)) for p in pages]
    if not orders:
        return []
    logits = model.logit(np.concatenate([features(o) for o in orders]))
    out, at = [], 0
    for o in orders:
        out.append(" ".join(n.text for n in decode(o, logits[at:at + len(o)]) if n.text))
        at += len(o)
    return out


# --- training pages --------------------------------------------------------------------------------------------------


def sentences(pages: list[str]) -> tuple[list[str], list[str]]:
    """(paragraphs, short texts) of the sampled pages, markup removed."""
    long, short = [], []
    for p in pages:
        for n in nodes_of(parse(p)):
            if n.text:
                (long if n.chars >= 120 else short).append(n.text)
    return long or ["Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."], short or ["Lorem ipsum."]


class Layout:
    """Writes one training page; elements that carry main text are marked with ``data-y``."""

    TAGS = {"menu": ("nav", "div", "ul", "header", "section"), "header": ("header", "div"), "footer": ("footer", "div", "section"),
            "sidebar": ("aside", "div", "section"), "notice": ("div", "section", "p", "aside"), "advert": ("div", "aside", "ins", "section", "p"),
            "form": ("form", "div", "section"), "comments": ("section", "div", "ol", "ul"), "share": ("div", "ul", "section")}

    def __init__(self, rng: np.random.Generator, long: list[str], short: list[str]):
        self.rng, self.long, self.short = rng, long, short

    def pick(self, values):
        return values[int(self.rng.integers(len(values)))]

    def chance(self, p: float) -> bool:
        return bool(self.rng.random() < p)

    def words(self, lo: int, hi: int) -> str:
        text = self.pick(self.short if self.chance(0.5) else self.long).split()
        n = int(self.rng.integers(lo, hi + 1))
        start = int(self.rng.integers(max(1, len(text) - n + 1)))
        return html_lib.escape(" ".join(text[start:start + n]) or "x")

    def paragraph(self) -> str:
        return html_lib.escape(self.pick(self.long) if self.chance(0.75) else self.pick(self.short))

    def links(self, lo: int, hi: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 4)}</a>' for i in range(int(self.rng.integers(lo, hi + 1)))]
        return f"<ul>{''.join(f'<li>{a}</li>' for a in items)}</ul>" if self.chance(0.7) else " | ".join(items)

    def attrs(self, kind: str, p: float) -> str:
        if not self.chance(p):
            return ""
        token = self.pick(TOKENS[kind])
        if self.chance(0.3):
            token = f"{self.pick(('site', 'page', 'block', 'js', 'top', 'c'))}-{token}"
        return f' {self.pick(("class", "id", "class"))}="{token}"'

    def boilerplate(self, kind: str) -> str:
        tag = self.pick(self.TAGS[kind])
        semantic = tag in ("nav", "header", "footer", "aside", "form")
        attrs = self.attrs(kind, 0.45 if semantic else 0.97)
        if kind == "menu":
            body = self.links(3, 12)
        elif kind == "header":
            body = f"<div>{self.words(1, 5)}</div>" + (self.links(2, 6) if self.chance(0.5) else "") + (f"<p>{self.words(3, 12)}</p>" if self.chance(0.4) else "")
            if self.chance(0.3):
                body = f"<h1>{self.words(1, 4)}</h1>" + body
        elif kind == "footer":
            body = self.pick((f"&copy; {self.words(1, 3)} &middot; {self.words(3, 12)}", f"<p>&copy; {self.words(2, 20)}</p>" + self.links(2, 6),
                              f"<p>{self.words(5, 40)}</p>"))
        elif kind == "sidebar":
            body = f"<{(h := self.pick(('h2', 'h3', 'h4')))}>{self.words(1, 4)}</{h}>" + (self.links(2, 8) if self.chance(0.6) else "".join(f"<p>{self.paragraph()}</p>" for _ in range(int(self.rng.integers(1, 4)))))
        elif kind in ("notice", "advert"):
            inner = self.words(3, 40)
            body = inner if tag == "p" or self.chance(0.5) else f"<p>{inner}</p>" + (f'<a href="/x">{self.words(1, 3)}</a>' if self.chance(0.4) else "")
        elif kind == "form":
            body = f"<label>{self.words(1, 6)}</label><input type=text name=q>" + (f"<p>{self.words(3, 20)}</p>" if self.chance(0.6) else "") + f"<button>{self.words(1, 2)}</button>"
        elif kind == "comments":
            unit = "li" if tag in ("ol", "ul") else self.pick(("div", "article", "section"))
            own = self.attrs("comments", 0.6)
            each = [f"<{unit}{own}>" + (f"<b>{self.words(1, 2)}</b> " if self.chance(0.5) else "") + f"<p>{self.paragraph()}</p></{unit}>" for _ in range(int(self.rng.integers(1, 6)))]
            body = (f"<h3>{self.words(1, 3)}</h3>" if tag not in ("ol", "ul") and self.chance(0.6) else "") + "".join(each)
        else:
            body = self.links(2, 6)
        return f"<{tag}{attrs}>{body}</{tag}>"

    def article(self) -> str:
        blocks = []
        if self.chance(0.85):
            title = f"<h1 data-y>{self.words(3, 12)}</h1>"
            blocks.append(f"<header data-y>{title}</header>" if self.chance(0.15) else title)
        for _ in range(int(self.rng.choice((1, 2, 3, 5, 8, 12, 20)))):
            roll = self.rng.random()
            if roll < 0.74:
                blocks.append(f"<p data-y>{self.paragraph()}" + ("" if self.chance(0.3) else "</p>"))
            elif roll < 0.80:
                blocks.append(f"<p data-y><b>{self.words(3, 20)}.<br>")
            elif roll < 0.86:
                blocks.append(f"<{(h := self.pick(('h2', 'h3')))} data-y>{self.words(2, 8)}</{h}>")
            elif roll < 0.90:
                blocks.append("<ul data-y>" + "".join(f"<li data-y>{self.words(3, 25)}</li>" for _ in range(3)) + "</ul>")
            elif roll < 0.94:
                blocks.append(f"<blockquote data-y><p data-y>{self.paragraph()}</p></blockquote>")
            else:
                blocks.append(f'<p data-y>{self.words(4, 20)} <a href="/y">{self.words(1, 4)}</a> {self.words(4, 20)}.</p>')
        for kind, p in (("advert", 0.25), ("sidebar", 0.12), ("form", 0.12), ("share", 0.12), ("comments", 0.12), ("notice", 0.08)):
            if self.chance(p):
                blocks.insert(int(self.rng.integers(1, len(blocks) + 1)) if kind != "comments" else len(blocks), "</p>" + self.boilerplate(kind))
        body = "".join(blocks)
        roll = self.rng.random()
        if roll < 0.5:
            out = f"<article data-y{self.attrs('main', 0.3)}>{body}</article>"
        elif roll < 0.65:
            out = f"<main data-y>{body}</main>"
        elif roll < 0.9:
            out = f"<{(t := self.pick(('div', 'section')))} data-y{self.attrs('main', 0.9)}>{body}</{t}>"
        else:
            return body
        return f"<div data-y>{out}</div>" if self.chance(0.25) else f"<main data-y>{out}</main>" if self.chance(0.1) else out

    def page(self) -> str:
        before = [self.boilerplate(k) for k, p in (("menu", 0.8), ("header", 0.5), ("notice", 0.3), ("advert", 0.5), ("form", 0.2), ("sidebar", 0.2)) if self.chance(p)]
        after = [self.boilerplate(k) for k, p in (("sidebar", 0.35), ("comments", 0.4), ("share", 0.2), ("form", 0.25), ("advert", 0.25), ("notice", 0.2), ("menu", 0.15), ("footer", 0.85)) if self.chance(p)]
        if self.chance(0.3):
            self.rng.shuffle(before)
        inner = "".join(before) + self.article() + "</p>" + "".join(after)
        if self.chance(0.25):
            inner = f'<div data-y id="{self.pick(("wrapper", "container", "page", "root"))}">{inner}</div>'
        return f"<html data-y><head><title>{self.words(2, 6)}</title></head><body data-y>{inner}</body></html>"


#: A token that only training pages have; its bit lies beyond those of GROUPS.
_MARK_ID = "YMARKY"
_GROUP_OF[_MARK_ID.lower()] = len(GROUPS)


def labelled_nodes(page: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of a page written by Layout."""
    order = nodes_of(parse(page))
    # With the marks turned into ids the same page gives the same tree, so labels align by position.
    marked = nodes_of(parse_marked(page))
    y = np.array([1.0 if n.y == 1 else 0.0 for n in marked])
    return features(order), y


def parse_marked(page: str) -> Node:
    root = parse(page.replace(" data-y", f' data-y id="{_MARK_ID}"'))
    todo = [root]
    while todo:
        n = todo.pop()
        n.y = 1 if n.tag == "#root" or n.groups >> len(GROUPS) & 1 else n.parent.y if n.tag == "#run" else 0
        todo.extend(n.children)
    return root


def fit(pages: list[str], layouts: int = FIT_LAYOUTS, seed: int = 17) -> Boosted:
    rng = np.random.default_rng(seed)
    long, short = sentences(pages)
    writer = Layout(rng, long, short)
    xs, ys = [], []
    for _ in range(max(200, len(pages) * layouts)):
        x, y = labelled_nodes(writer.page())
        xs.append(x)
        ys.append(y)
    x, y = np.concatenate(xs), np.concatenate(ys)
    return boost(x, y, np.log1p(np.expm1(x[:, 4])) + 1.0)


def train(pages: DataFrame, rows: int = FIT_PAGES) -> Boosted:
    """Fit on layouts of the whole texts of at most ``rows`` pages, chosen by a hash of page_id among the narrow column."""
    ids = pages.select("page_id", F.lit(1).alias("all")).where("page_id is not null").dropDuplicates()
    chosen = sample_by_hash(ids, "page_id", "all", rows).select("page_id")
    got = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id").select("page_id", "html").collect()
    return fit([r["html"] or "" for r in sorted(got, key=lambda r: (r["page_id"], r["html"] or ""))])


def extract_main_text(pages: DataFrame, model: Boosted, column: str = "text") -> DataFrame:
    """``pages`` with the main text of each row's whole html (a column of that name is replaced)."""
    return map_texts(pages, "html", {column: "string"}, lambda: lambda texts: [extract_all(texts, model)])
