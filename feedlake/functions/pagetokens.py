"""A page as one array of tokens, from a single scan of its HTML.

One regular expression finds comments, script/style/template blocks,
declarations and tags.  Every token carries the tag's name (with a leading slash
for an end tag), the tag itself and the text up to the next one, so metadata, body and
links are look-ups in one array instead of further scans of the page:

* an element ends at its own end tag, elements of the same name inside it
  included; without one it ends with the page;
* an anchor ends at the next end tag of an anchor, or where the next anchor
  starts (its end tag is implied there);
* character references are decoded with and without semicolon, where HTML allows it.

Expressions are written as SQL text: parsing one string takes a fraction of the
time that assembling the same tree call by call does, and lambda variables keep
intermediate values bound once.
"""

from __future__ import annotations

from functools import lru_cache
from html.entities import html5
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from .sqlfns import lit
from .text import WS_RUN

# Quotes are written as \x22 and \x27, so that the patterns can stand in SQL text.
_ATTRS = r"(?:(?:[^>\x22\x27]++|\x22[^\x22]*+\x22|\x27[^\x27]*+\x27)*+>|[^>]*+>)"
# Every alternative starts after the one "<", so that text between tags is passed over by a single comparison a character.
TOKEN_RE = (
    r"(?is)<(?:!--.*?(?:-->|$)"
    r"|(script|style|template)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|/?[a-z]" + _ATTRS +
    r"|[!?][^>]*>)"
)
NAME_RE = r"^<(/?[A-Za-z][^\s/>]*)"

_LEGACY = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: References without semicolon that HTML still decodes, longest first.
LEGACY_RE = "|".join(_LEGACY)
REFERENCE_RE = rf"&(?:#[0-9]{{1,7}};?|#[xX][0-9A-Fa-f]{{1,6}};?|[A-Za-z][A-Za-z0-9]{{1,31}};|(?:{LEGACY_RE}))"

_SEP, _TAG_END, _FIELD = "\\u0001", "\\u0002", "\\u0003"


#: Named references are dealt over so many short lists, so that a look-up reads some of the names instead of all.
_LISTS = 512


@lru_cache(maxsize=1)
def _named_references() -> str:
    """SQL array of texts; a reference is in the one at its CRC-32 modulo ``_LISTS``, as separator, reference, field mark, characters.

    Spark folds the split into one array literal when it plans the query.
    """
    lists = [""] * _LISTS
    for name, text in sorted(html5.items()):
        lists[crc32(f"&{name}".encode()) % _LISTS] += f"\x01&{name}\x03{text}"
    return f"split({lit(chr(2).join(lists))}, '{_TAG_END}')"


# Numbers 128 to 159 mean the characters of this code page, where it has any.
_C1 = "".join(chr(c) for c in range(128, 160))
_C1_TEXT = "".join(bytes([c]).decode("cp1252", "ignore") or chr(c) for c in range(128, 160))


def _look_up(ref: str) -> str:
    """Characters of a reference, or NULL: a search in a short text, as a map literal of all names would slow down planning."""
    found = f"if(at > 0, substring_index(substr(l, at + char_length({ref}) + 2), '{_SEP}', 1), NULL)"
    return (f"transform(array(get({_named_references()}, cast(crc32({ref}) % {_LISTS} AS int))), l -> "
            f"transform(array(instr(l, concat('{_SEP}', {ref}, '{_FIELD}'))), at -> {found})[0])[0]")


def unescape_sql(text: str) -> str:
    """SQL text that decodes the character references of ``text`` in one pass; unknown names stay as they are."""
    number = (r"transform(array(rtrim(';', substr(r, 3))), d -> "
              "cast(if(lower(left(d, 1)) = 'x', conv(substr(d, 2), 16, 10), d) AS bigint))[0]")
    code = (f"transform(array({number}), n -> if(n = 0 OR n > 1114111 OR n BETWEEN 55296 AND 57343, 65533, n))[0]")
    numeric = f"translate(decode(unhex(lpad(hex({code}), 8, '0')), 'UTF-32'), {lit(_C1)}, {lit(_C1_TEXT)})"
    # An unknown name may begin with one that needs no semicolon.
    prefix = f"regexp_extract(r, {lit('^&(?:' + LEGACY_RE + ')')}, 0)"
    partly = f"transform(array({prefix}), p -> if(p = '', r, concat({_look_up('p')}, substr(r, char_length(p) + 1))))[0]"
    one = (f"CASE WHEN startswith(r, '&#') THEN {numeric} WHEN r = '&amp;' THEN '&' WHEN r = '&lt;' THEN '<' WHEN r = '&gt;' THEN '>' "
           f"WHEN r = '&quot;' THEN '\"' WHEN r = '&nbsp;' THEN '\\u00a0' ELSE coalesce({_look_up('r')}, {partly}) END")
    return (f"transform(array({text}), u -> if(NOT contains(u, '&'), u, array_join(zip_with("
            f"split(u, {lit(REFERENCE_RE)}, -1), transform(regexp_extract_all(u, {lit(REFERENCE_RE)}, 0), r -> {one}), "
            f"(t, d) -> concat(t, coalesce(d, ''))), '')))[0]")


def tokens(html: str) -> Column:
    """array<struct<name, raw, text>> of an HTML column; the first token is the text before the first tag."""
    plain = f"regexp_replace({html}, '[{_SEP}{_TAG_END}{_FIELD}]', '')"
    marked = f"regexp_replace({plain}, {lit(TOKEN_RE)}, '{_SEP}$0{_TAG_END}')"
    piece = (f"if(contains(p, '{_TAG_END}'), named_struct('raw', substring_index(p, '{_TAG_END}', 1), 'text', substring_index(p, '{_TAG_END}', -1)), "
             "named_struct('raw', '', 'text', p))")
    return F.expr(f"transform(transform(split({marked}, '{_SEP}'), p -> {piece}), "
                  f"k -> named_struct('name', lower(regexp_extract(k.raw, {lit(NAME_RE)}, 1)), 'raw', k.raw, 'text', k.text))")


def attr_sql(raw: str, name: str) -> str:
    """The attribute's value as written, without quotes; '' when absent."""
    pattern = rf"(?is)\s{name}\s*=\s*(\x22[^\x22]*\x22|\x27[^\x27]*\x27|[^\s\x22\x27=<>`]+)"
    return f"regexp_replace(regexp_extract({raw}, {lit(pattern)}, 1), {lit(r'^[\x22\x27]|[\x22\x27]$')}, '')"


HEAD_ATTRS = ("name", "property", "content", "rel", "href", "datetime")


def head_tags(tok: str) -> Column:
    """array<struct<tag, has_datetime, v>> of the meta, link and time tags; ``v`` holds the decoded ``HEAD_ATTRS``."""
    joined = f"concat_ws('{_FIELD}', {', '.join(attr_sql('k.raw', a) for a in HEAD_ATTRS)})"
    return F.expr(f"transform(filter({tok}, k -> k.name IN ('meta', 'link', 'time')), k -> named_struct('tag', k.name, "
                  f"'has_datetime', k.raw RLIKE {lit(r'(?is)\sdatetime\b')}, 'v', split({unescape_sql(joined)}, '{_FIELD}')))")


def first_value(tags: str, where: str, attr: str) -> Column:
    """Attribute of the first of the head tags for which ``where`` (on ``k``) holds; NULL when it is blank."""
    value = f"get(filter({tags}, k -> {where}), 0).v[{HEAD_ATTRS.index(attr)}]"
    return F.expr(f"nullif(trim(regexp_replace({value}, {lit(WS_RUN)}, ' ')), '')")


def meta(tags: str, key: str, value: str) -> Column:
    return first_value(tags, f"k.tag = 'meta' AND k.v[{HEAD_ATTRS.index(key)}] = '{value}'", "content")


def _element(tok: str, open_at: str, name: str) -> str:
    """Tokens from the start tag at position ``open_at`` (from 1) to its own end tag, or to the end."""
    # (position, +1 or -1) of the tags of that name from there on; the element ends where they add up to 0.
    tags = (f"filter(transform({tok}, (k, i) -> named_struct('i', i + 1, 'd', CASE WHEN k.name = {name} THEN 1 "
            f"WHEN k.name = concat('/', {name}) THEN -1 ELSE 0 END)), x -> x.d <> 0 AND x.i >= {open_at})")
    end = (f"aggregate({tags}, named_struct('d', 0, 'stop', 0), (a, x) -> named_struct('d', a.d + x.d, "
           "'stop', if(a.stop = 0 AND a.d + x.d = 0, x.i, a.stop)), a -> a.stop)")
    return f"transform(array({end}), e -> slice({tok}, {open_at}, if(e = 0, size({tok}), e - {open_at})))[0]"


def body(tok: str) -> Column:
    """Text of the first article, else main, else the ``data-testid=post-content`` element, else the page."""
    names = f"transform({tok}, k -> k.name)"
    post = (f"array_position(transform({tok}, k -> k.name <> '' AND NOT startswith(k.name, '/') AND contains(k.raw, 'post-content') "
            f"AND {attr_sql('k.raw', 'data-testid')} = 'post-content'), true)")
    found = (f"transform(array(named_struct('a', array_position({names}, 'article'), 'm', array_position({names}, 'main'))), "
             f"w -> CASE WHEN w.a > 0 THEN named_struct('at', w.a, 'name', 'article') WHEN w.m > 0 THEN named_struct('at', w.m, 'name', 'main') "
             f"ELSE transform(array({post}), q -> if(q > 0, named_struct('at', q, 'name', {tok}[cast(q AS int) - 1].name), NULL))[0] END)[0]")
    inner = f"transform(array({found}), f -> if(f IS NULL, {tok}, {_element(tok, 'cast(f.at AS int)', 'f.name')}))[0]"
    return F.expr(_clean(f"array_join(transform({inner}, k -> k.text), ' ')"))


def title(tok: str) -> Column:
    """Text of the first title element that is closed; NULL when missing or blank."""
    at = f"array_position(transform({tok}, k -> k.name), 'title')"
    stop = f"array_position(transform({tok}, k -> k.name), '/title')"
    inner = f"transform(array(named_struct('a', cast({at} AS int), 'z', cast({stop} AS int))), w -> " \
            f"if(w.a > 0 AND w.z > w.a, array_join(transform(slice({tok}, w.a, w.z - w.a), k -> k.text), ''), ''))[0]"
    return F.expr(f"nullif({_clean(inner)}, '')")


def _clean(text: str) -> str:
    return f"trim(regexp_replace({unescape_sql(text)}, {lit(WS_RUN)}, ' '))"


def anchors(tok: str) -> Column:
    """array<struct<pos, href, text>> of all anchors in document order; href is NULL when absent."""
    marks = (f"transform(array(filter(transform({tok}, (k, i) -> named_struct('i', i + 1, 'name', k.name, 'raw', k.raw)), "
             "k -> k.name IN ('a', '/a'))), m -> filter(transform(m, (k, i) -> named_struct('i', k.i, 'name', k.name, 'raw', k.raw, "
             "'stop', get(m, i + 1).i)), k -> k.name = 'a'))[0]")
    text = f"array_join(transform(slice({tok}, k.i, coalesce(k.stop, size({tok}) + 1) - k.i), t -> t.text), ' ')"
    both = f"split({unescape_sql(f'''concat({attr_sql('k.raw', 'href')}, '{_FIELD}', {text})''')}, '{_FIELD}', 2)"
    return F.expr(f"transform({marks}, (k, i) -> transform(array({both}), b -> named_struct('pos', i, "
                  f"'href', if(k.raw RLIKE {lit(r'(?is)\shref\b')}, b[0], NULL), "
                  f"'text', trim(regexp_replace(b[1], {lit(WS_RUN)}, ' '))))[0])")
