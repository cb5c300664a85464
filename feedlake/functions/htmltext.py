"""Visible text of the main container with the standard library HTML parser.

Small per-row helper used by ``extract.extract_body(method="parser")`` through
an Arrow-batched ``mapInPandas``: it follows real element nesting (nested
``<article>``, unclosed tags) and decodes every character reference, which
the regex chain in :mod:`feedlake.functions.html` does not.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

# Elements without content, and elements whose text is not
# part of the visible text.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
        "track", "wbr"}
HIDDEN = {"script", "style", "template"}
_WS = re.compile(r"\s+")


class _Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("#root", {}, None)
        self.cur = self.root
        self.hidden = 0

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.cur)
        self.cur.children.append(node)
        if tag not in VOID:
            self.cur = node
            if tag in HIDDEN:
                self.hidden += 1

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(_Node(tag, dict(attrs), self.cur))

    def handle_endtag(self, tag):
        node = self.cur
        while node is not None and node.tag != tag:
            node = node.parent
        if node is None or node is self.root:
            return  # stray end tag
        while self.cur is not node.parent:
            if self.cur.tag in HIDDEN:
                self.hidden -= 1
            self.cur = self.cur.parent

    def handle_data(self, data):
        if not self.hidden and self.cur.tag not in HIDDEN:
            self.cur.children.append(data)


def _find(node, pred):
    stack = [node]
    while stack:
        n = stack.pop()
        if isinstance(n, _Node):
            if pred(n):
                return n
            stack.extend(reversed(n.children))
    return None


def _texts(node):
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        if isinstance(n, str):
            s = n.strip()
            if s:
                out.append(s)
        elif n.tag not in HIDDEN:
            stack.extend(reversed(n.children))
    return out


def body_text(html: str | None) -> str | None:
    """Text of the first article, else main, else post-content element,
    else the whole page; text nodes stripped and joined by one space."""
    if html is None:
        return None
    b = _TreeBuilder()
    b.feed(html)
    b.close()
    node = None
    for pred in (lambda n: n.tag == "article", lambda n: n.tag == "main",
                 lambda n: n.attrs.get("data-testid") == "post-content"):
        node = _find(b.root, pred)
        if node is not None:
            break
    text = " ".join(_texts(node if node is not None else b.root))
    return _WS.sub(" ", text).strip()
