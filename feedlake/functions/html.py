"""HTML Column functions used by the extraction jobs (B14, C1-C3 pieces).

The page text is processed with JVM regular expressions in this order:
drop comments and script/style/template blocks, pick the container, turn
every tag into a space, decode character references, collapse whitespace.  Tags are matched only when ``<`` is followed by a letter, as an
HTML tokenizer does.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col, let
from .text import clean_whitespace

# Markers of an anti-bot challenge page.
CHALLENGE_MARKERS = [
    "just a moment",
    "cf-browser-verification",
    "challenge-platform",
    "checking your browser",
    "cloudflare",
]

# A start tag's attributes: a quoted value may hold ">".  Where quotes don't
# pair up, the tag ends at the first ">".
_ATTRS = r"""(?:(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>)"""

NON_TEXT_BLOCKS_RE = (
    r"(?is)<!--.*?(?:-->|$)"
    r"|<script\b[^>]*>.*?(?:</script\s*>|$)"
    r"|<style\b[^>]*>.*?(?:</style\s*>|$)"
    r"|<template\b[^>]*>.*?(?:</template\s*>|$)"
)
DECLARATION_RE = r"(?s)<[!?][^>]*>"
TAG_RE = r"(?s)</?[A-Za-z]" + _ATTRS

POST_CONTENT_OPEN_RE = r"""(?is)<([A-Za-z][A-Za-z0-9]*)\b[^>]*\sdata-testid\s*=\s*["']?post-content["']?[^>]*>"""

ANCHOR_RE = r"(?is)<a\b" + _ATTRS + r".*?</a\s*>"
ANCHOR_OPEN_RE = r"(?is)^<a\b" + _ATTRS
META_RE = r"(?is)<meta\b" + _ATTRS
LINK_TAG_RE = r"(?is)<link\b" + _ATTRS
TIME_TAG_RE = r"(?is)<time\b" + _ATTRS
TITLE_RE = r"(?is)<title\b[^>]*>(.*?)</title\s*>"

REFERENCE_RE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


COMMON_REFERENCES = (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\u00a0"))


@lru_cache(maxsize=2)
def _named_references(frequent: bool) -> str:
    """Named character references that end in a semicolon, from the standard
    library's tables, as one text: separator, reference, characters.  The
    frequent ones are those of HTML 4 up to Latin-1; the others are the rest."""
    from html.entities import html5, name2codepoint
    chosen = {n for n, c in name2codepoint.items() if c < 256}
    return "".join(f"{_SEP}&{name}{text}" for name, text in sorted(html5.items())
                   if name.endswith(";") and (name[:-1] in chosen) == frequent) + _SEP


_SEP = "\x01"


def _named(ref: Column) -> Column:
    """Characters of a named reference, or the reference itself.  A text search,
    in the short table first: a map literal of all names would slow down
    planning wherever it is used, and is searched from its start as well."""
    def look_up(frequent: bool) -> Column:
        table = F.lit(_named_references(frequent))
        at = F.instr(table, F.concat(F.lit(_SEP), ref))
        return F.when(at > 0, F.substring_index(F.substr(table, at + F.char_length(ref) + 1), _SEP, 1))

    return F.coalesce(look_up(True), look_up(False), ref)


# Numbers 128 to 159 mean the characters of this code page, where it has any.
_C1 = "".join(chr(c) for c in range(128, 160))
_C1_TEXT = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))


def unescape(c) -> Column:
    """Decode character references, named, decimal and hexadecimal, in one
    pass (so ``&amp;lt;`` becomes ``&lt;``); unknown names stay as they are.

    A text without ``&`` is returned as it is.
    """
    return let(as_col(c), lambda x: F.when(~F.contains(x, F.lit("&")), x).otherwise(_decode_all(x)))


def _decode_all(x: Column) -> Column:
    between = F.split(x, REFERENCE_RE, -1)
    refs = F.regexp_extract_all(x, F.lit(REFERENCE_RE), 0)
    def one(r: Column) -> Column:
        out = F.when(F.startswith(r, F.lit("&#")), _numeric(r))
        for ref, ch in COMMON_REFERENCES:  # the others are searched for
            out = out.when(r == ref, F.lit(ch))
        return out.otherwise(_named(r))

    decoded = F.transform(refs, one)
    # between has one piece more than there are references
    return F.array_join(F.zip_with(between, decoded, lambda t, d: F.concat(t, F.coalesce(d, F.lit("")))), "")


def _numeric(ref: Column) -> Column:
    digits = F.substr(ref, F.lit(3), F.char_length(ref) - 3)
    number = F.when(F.lower(F.substring(digits, 1, 1)) == "x", F.conv(F.substr(digits, F.lit(2)), 16, 10)) \
        .otherwise(digits).cast("long")
    bad = (number == 0) | (number > 0x10FFFF) | number.between(0xD800, 0xDFFF)
    code = F.when(bad, F.lit(0xFFFD)).otherwise(number)
    return F.translate(F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"), _C1, _C1_TEXT)


def strip_non_text(c) -> Column:
    """Remove comments, declarations and script/style/template blocks."""
    return F.regexp_replace(F.regexp_replace(as_col(c), NON_TEXT_BLOCKS_RE, " "), DECLARATION_RE, " ")


def fragment_text(c) -> Column:
    """Visible text of an HTML fragment whose non-text blocks are already gone:
    text nodes stripped and joined by one space."""
    return clean_whitespace(unescape(F.regexp_replace(as_col(c), TAG_RE, " ")))


def attr(tag, name: str) -> Column:
    """Value of attribute ``name`` inside one start tag ('' when absent)."""
    pat = (r"(?is)\s" + name +
           r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))""")
    t = as_col(tag)
    return unescape(F.concat(F.regexp_extract(t, pat, 1), F.regexp_extract(t, pat, 2),
                             F.regexp_extract(t, pat, 3)))


def _first_tag_attr(tags: Column, match_attr: str, match_value: str, value_attr: str) -> Column:
    """Attribute of the first tag whose ``match_attr`` equals ``match_value``
    (NULL when that first tag has a blank value, like the reference)."""
    hit = F.get(F.filter(tags, lambda t: attr(t, match_attr) == match_value), 0)
    return F.nullif(clean_whitespace(attr(hit, value_attr)), F.lit(""))


def canonical_link(html) -> Column:
    tags = F.regexp_extract_all(as_col(html), F.lit(LINK_TAG_RE), 0)
    return _first_tag_attr(tags, "rel", "canonical", "href")


def time_datetime(html) -> Column:
    """``time[datetime]@datetime`` of the first time tag carrying it."""
    tags = F.regexp_extract_all(as_col(html), F.lit(TIME_TAG_RE), 0)
    hit = F.get(F.filter(tags, lambda t: t.rlike(r"(?is)\sdatetime\b")), 0)
    return F.nullif(clean_whitespace(attr(hit, "datetime")), F.lit(""))


def title_text(html) -> Column:
    """Text of the first ``<title>``; NULL when missing or blank."""
    inner = F.regexp_extract(as_col(html), TITLE_RE, 1)
    return F.nullif(clean_whitespace(unescape(F.regexp_replace(inner, TAG_RE, ""))), F.lit(""))


def body_text(clean_html) -> Column:
    """Text of the first ``<article>``, else ``<main>``, else the
    ``data-testid=post-content`` element, else the whole page.

    ``clean_html`` must already have gone through :func:`strip_non_text`.
    """
    h = as_col(clean_html)
    has_article = h.rlike(r"(?is)<article\b")
    has_main = h.rlike(r"(?is)<main\b")
    pc_tag = F.regexp_extract(h, POST_CONTENT_OPEN_RE, 1)
    container = (
        F.when(has_article, _inner(h, "article"))
        .when(has_main, _inner(h, "main"))
        .when(pc_tag != "", _post_content_inner(h, pc_tag))
        .otherwise(h)
    )
    return fragment_text(container)


def _inner(h: Column, tag: str) -> Column:
    """Content of the first ``tag`` element up to its own close tag, elements
    of the same name inside it included; to the end if it is never closed."""
    opening = rf"(?is)<{tag}\b" + _ATTRS
    after = F.element_at(F.split(h, opening, 2), 2)  # limit 2: the element's start tag only

    def upto_close(pieces: Column) -> Column:
        # The close tag after piece i ends the element when the pieces so far opened i more of them.
        opens = F.transform(pieces, lambda p: F.size(F.regexp_extract_all(p, F.lit(opening), 0)))
        ends = F.transform(opens, lambda _, i: F.aggregate(F.slice(opens, 1, i + 1), F.lit(0), lambda n, k: n + k) == i)
        last = F.array_position(ends, True)
        return F.when(last > 0, F.array_join(F.slice(pieces, 1, last.cast("int")), " ")).otherwise(F.array_join(pieces, " "))

    return let(F.split(after, rf"(?is)</{tag}\s*>", -1), upto_close)


def _post_content_inner(h: Column, tag: Column) -> Column:
    """Content after the post-content start tag up to the first close tag of
    the same name (nesting of that tag name is not tracked on this path)."""
    open_tag = F.regexp_extract(h, POST_CONTENT_OPEN_RE, 0)
    after = F.substring(h, F.instr(h, open_tag) + F.char_length(open_tag), 1 << 30)
    close_at = F.instr(F.lower(after), F.concat(F.lit("</"), F.lower(tag)))
    return F.when(close_at > 0, F.substring(after, 1, close_at - 1)).otherwise(after)


def is_challenge_page(html) -> Column:
    """Any challenge marker in the lower-cased page."""
    low = F.lower(as_col(html))
    out = F.lit(False)
    for m in CHALLENGE_MARKERS:
        out = out | low.contains(m)
    return out


def anchors(clean_html) -> Column:
    """All ``<a ...>...</a>`` elements in document order."""
    return F.regexp_extract_all(as_col(clean_html), F.lit(ANCHOR_RE), 0)


def anchor_href(anchor) -> Column:
    """``href`` of an anchor; NULL when the attribute is absent."""
    a = as_col(anchor)
    start = F.regexp_extract(a, ANCHOR_OPEN_RE, 0)
    present = start.rlike(r"(?is)\shref\b")
    return F.when(present, attr(start, "href"))


def anchor_text(anchor) -> Column:
    """Visible text of an anchor (text nodes joined by one space)."""
    a = as_col(anchor)
    return fragment_text(F.regexp_replace(F.regexp_replace(a, ANCHOR_OPEN_RE, ""), r"(?is)</a\s*>$", ""))
