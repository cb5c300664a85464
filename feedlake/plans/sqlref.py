"""DuckDB SQL text for the correctness oracles.

Each helper returns an SQL expression (RE2 regular expressions, DuckDB list
lambdas) that states the same rule as the matching Spark Column function,
written independently for DuckDB.  Values used several times are bound once
with ``list_transform([value], lambda v: ...)[1]``.
"""

from __future__ import annotations

import itertools

_ids = itertools.count()

WS = (r"[\t\n\x0b\x0c\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
      r"\x{202f}\x{205f}\x{3000}]")
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
URL_RE = r"^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
USES_NETLOC = ["", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp",
               "snews", "prospero", "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git",
               "git+ssh", "ws", "wss", "itms-services"]
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"),
    ("&#x27;", "'"), ("&#34;", '"'), ("&#60;", "<"), ("&#62;", ">"), ("&nbsp;", " "),
    ("&#160;", " "), ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"),
    ("&middot;", "·"), ("&bull;", "•"), ("&hellip;", "…"), ("&mdash;", "—"),
    ("&ndash;", "–"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"),
    ("&rdquo;", "”"), ("&laquo;", "«"), ("&raquo;", "»"), ("&deg;", "°"),
    ("&euro;", "€"), ("&pound;", "£"), ("&yen;", "¥"), ("&cent;", "¢"),
    ("&sect;", "§"), ("&para;", "¶"), ("&times;", "×"), ("&divide;", "÷"),
    ("&#38;", "&"), ("&amp;", "&"),
]
NON_TEXT = (r"(?is)<!--.*?(?:-->|$)|<script\b[^>]*>.*?(?:</script\s*>|$)|<style\b[^>]*>.*?(?:</style\s*>|$)"
            r"|<template\b[^>]*>.*?(?:</template\s*>|$)")
DECL = r"(?s)<[!?][^>]*>"
TAG = r"(?s)</?[A-Za-z][^>]*>"
ANCHOR = r"(?is)<a\b[^>]*>.*?</a\s*>"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def v() -> str:
    return f"v{next(_ids)}"


def let(value: str, body) -> str:
    name = v()
    return f"list_transform([{value}], lambda {name}: {body(name)})[1]"


def clean(x: str) -> str:
    return f"trim(regexp_replace({x}, {q(WS + '+')}, ' ', 'g'))"


def nclean(x: str) -> str:
    return f"nullif({clean(x)}, '')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + WS + '+|' + WS + '+$')}, '', 'g')"


def trim_text(x: str, n: int) -> str:
    return let(clean(x), lambda c: (
        f"CASE WHEN length({c}) <= {n} THEN {c} "
        f"ELSE trim(regexp_replace(substring({c}, 1, {n}), ' [^ ]*$', '')) END"))


def first_sentences(x: str, k: int = 3) -> str:
    marked = f"regexp_replace({clean(x)}, '([.!?]) ', {q(chr(92) + '1' + chr(1))}, 'g')"
    return f"trim(array_to_string(list_slice(string_split({marked}, chr(1)), 1, {k}), ' '))"


def bullets(x: str) -> str:
    def body(t):
        ln = v()
        lines = f"list_filter(regexp_split_to_array({t}, {q(LINE_BREAK)}), lambda {ln}: {strip(ln)} <> '')"
        cl = v()
        dash = f"regexp_replace({cl}, {q('^[- ]+|[- ]+$')}, '', 'g')"
        cleaned = f"list_transform({lines}, lambda {cl}: {strip(dash)})"
        s1, s2 = v(), v()
        sentences = (f"list_filter(list_transform(list_slice(string_split({t}, '. '), 1, 3), lambda {s1}: {strip(s1)}), "
                     f"lambda {s2}: {s2} <> '')")
        return (f"CASE WHEN {t} IS NULL THEN []::VARCHAR[] WHEN len({lines}) > 1 THEN list_slice({cleaned}, 1, 3) "
                f"ELSE {sentences} END")
    return let(x, body)


def key_takeaway_from(bullets_sql: str, text: str) -> str:
    return f"coalesce({bullets_sql}[1], nullif({strip(text)}, ''))"


def topic_tags(x: str) -> str:
    def body(kw):
        p, f = v(), v()
        return (f"CASE WHEN coalesce({kw}, '') = '' THEN []::VARCHAR[] ELSE "
                f"list_filter(list_transform(string_split({kw}, ','), lambda {p}: {clean(p)}), lambda {f}: {f} <> '') END")
    return let(clean(x), body)


def prepare(u: str) -> str:
    return (f"regexp_replace(regexp_replace({u}, {q('^[\\x00-\\x20' + WS[1:-1] + ']+|' + WS + '+$')}, '', 'g'), "
            f"'[\\t\\r\\n]', '', 'g')")


def url_struct(u: str) -> str:
    return let(prepare(u), lambda s: (
        f"struct_pack(s := lower(regexp_extract({s}, {q(URL_RE)}, 1)), n := regexp_extract({s}, {q(URL_RE)}, 2), "
        f"p := regexp_replace(regexp_extract({s}, {q(URL_RE)}, 3), ';[^/]*$', ''))"))


def unsplit(s: str, n: str, p: str) -> str:
    netloc_schemes = ", ".join(q(x) for x in USES_NETLOC)
    return (f"(CASE WHEN {s} <> '' THEN {s} || ':' ELSE '' END) || "
            f"(CASE WHEN {n} <> '' OR starts_with({p}, '//') OR ({s} <> '' AND {s} IN ({netloc_schemes}) "
            f"AND starts_with({p}, '/')) THEN '//' ELSE '' END) || {n} || "
            f"(CASE WHEN {n} <> '' AND NOT starts_with({p}, '/') THEN '/' ELSE '' END) || {p}")


def normalize_url(u: str) -> str:
    def body(st):
        return let(f"regexp_replace(regexp_replace({st}.p, '/+$', ''), '^$', '/')",
                   lambda p: unsplit(f"{st}.s", f"lower({st}.n)", p))
    return f"CASE WHEN {u} IS NULL THEN NULL ELSE {let(url_struct(u), body)} END"


def url_host(u: str) -> str:
    return f"lower({url_struct(u)}.n)"


def resolve_simple(base: str, href: str) -> str:
    """Link resolution for hrefs without dot segments (enough for the data)."""
    def body(b):
        h = f"{b}.h"
        bs = f"{b}.bp"
        return (f"CASE WHEN {h} = '' THEN {normalize_url(f'{b}.b')} "
                f"WHEN regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') THEN {normalize_url(h)} "
                f"WHEN starts_with({h}, '//') THEN {normalize_url(f'{bs}.s || {q(':')} || {h}')} "
                f"WHEN starts_with({h}, '/') THEN {normalize_url(f'{bs}.s || {q('://')} || {bs}.n || {h}')} "
                f"WHEN starts_with({h}, '?') OR starts_with({h}, '#') THEN {normalize_url(f'{b}.b')} "
                f"ELSE {normalize_url(f'{bs}.s || {q('://')} || {bs}.n || regexp_replace({bs}.p, {q('[^/]*$')}, {q('')}) || {h}')} END")
    return let(f"struct_pack(b := {base}, h := {strip(href)}, bp := {url_struct(base)})", body)


def unescape(x: str) -> str:
    out = x
    for ent, ch in ENTITIES:
        out = f"replace({out}, {q(ent)}, {q(ch)})"
    return out


def strip_non_text(h: str) -> str:
    return f"regexp_replace(regexp_replace({h}, {q(NON_TEXT)}, ' ', 'g'), {q(DECL)}, ' ', 'g')"


def fragment_text(x: str) -> str:
    return clean(unescape(f"regexp_replace({x}, {q(TAG)}, ' ', 'g')"))


def body_text(clean_html: str) -> str:
    def body(c):
        return (f"CASE WHEN regexp_matches({c}, {q('(?is)<article' + chr(92) + 'b')}) "
                f"THEN regexp_extract({c}, {q('(?is)<article' + chr(92) + 'b[^>]*>(.*?)(?:</article' + chr(92) + 's*>|$)')}, 1) "
                f"WHEN regexp_matches({c}, {q('(?is)<main' + chr(92) + 'b')}) "
                f"THEN regexp_extract({c}, {q('(?is)<main' + chr(92) + 'b[^>]*>(.*?)(?:</main' + chr(92) + 's*>|$)')}, 1) "
                f"ELSE {c} END")
    return fragment_text(let(clean_html, body))


def title_text(clean_html: str) -> str:
    inner = f"regexp_extract({clean_html}, {q(r'(?is)<title\b[^>]*>(.*?)</title\s*>')}, 1)"
    no_tags = f"regexp_replace({inner}, {q(TAG)}, '', 'g')"
    return f"nullif({clean(unescape(no_tags))}, '')"


def attr(tag: str, name: str) -> str:
    pat = r"(?is)\s" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+))"""
    return unescape(f"(regexp_extract({tag}, {q(pat)}, 1) || regexp_extract({tag}, {q(pat)}, 2) || "
                    f"regexp_extract({tag}, {q(pat)}, 3))")


def short_id(x: str) -> str:
    return f"substring(sha256({x}), 1, 16)"


def error_type(m: str) -> str:
    low = f"lower({m})"
    return (f"CASE WHEN coalesce({m}, '') = '' THEN NULL "
            f"WHEN contains({low}, 'failed to resolve') OR contains({low}, 'name resolution') THEN 'dns_failure' "
            f"WHEN contains({low}, '403') OR contains({low}, 'forbidden') THEN 'http_403' "
            f"WHEN contains({low}, 'timeout') THEN 'timeout' "
            f"WHEN contains({low}, 'parse') THEN 'parse_failure' "
            f"WHEN contains({low}, 'http') OR contains({low}, 'httpsconnectionpool') "
            f"OR contains({low}, 'max retries exceeded') THEN 'http_failure' "
            f"ELSE 'unknown_error' END")


def arr_text(x: str) -> str:
    """Lists are compared as text: elements joined by ' | ' (NULL stays NULL)."""
    return f"array_to_string({x}, ' | ')"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


EXCLUDED_PATH_PREFIXES = ["/publish", "/api", "/account", "/signin", "/subscribe", "/search", "/feed"]
EXCLUDED_EXACT_PATHS = ["/", "/archive", "/about", "/reads"]
EXCLUDED_URL_PARTS = ["/likes", "/notes", "/podcast", "#", "?output="]


def _inlist(xs) -> str:
    return ", ".join(q(x) for x in xs)


def is_article_url(u: str) -> str:
    def body(st):
        lp, lu = f"lower({st}.p)", f"lower({u})"
        prefix = " OR ".join(f"starts_with({lp}, {q(x)})" for x in EXCLUDED_PATH_PREFIXES)
        parts = " OR ".join(f"contains({lu}, {q(x)})" for x in EXCLUDED_URL_PARTS)
        return (f"CASE WHEN NOT ({st}.s IN ('http', 'https') AND {st}.n <> '') THEN false "
                f"WHEN {lp} IN ({_inlist(EXCLUDED_EXACT_PATHS)}) THEN false WHEN {prefix} THEN false "
                f"WHEN {parts} THEN false WHEN contains({lp}, '/p/') THEN true "
                f"ELSE (length({lp}) - length(replace({lp}, '/', '')) >= 2 "
                f"AND length(regexp_extract({lp}, '[^/]*$', 0)) > 1) END")
    return f"CASE WHEN {u} IS NULL THEN NULL ELSE {let(url_struct(u), body)} END"


def is_publication_url(u: str, host: str) -> str:
    def body(st):
        lp = f"lower({st}.p)"
        same = f"(lower({st}.n) = lower({host}))"
        prefix = " OR ".join(f"starts_with({lp}, {q(x)})" for x in EXCLUDED_PATH_PREFIXES)
        return (f"CASE WHEN NOT ({st}.s IN ('http', 'https') AND {st}.n <> '') THEN false "
                f"WHEN contains({lp}, '/p/') THEN false WHEN {same} AND NOT contains({lp}, '/@') THEN false "
                f"WHEN {same} AND {lp} IN ({_inlist(EXCLUDED_EXACT_PATHS)}) THEN false "
                f"WHEN {prefix} THEN false ELSE true END")
    return f"CASE WHEN {u} IS NULL THEN NULL ELSE {let(url_struct(u), body)} END"


def anchors_cte(source: str, seq: str, base: str, html: str) -> str:
    """One row per anchor with an href: seq, pos, base, href, anchor_text."""
    a_re = q(ANCHOR)
    start_re = q(r"(?is)^<a\b[^>]*>")
    inner_re = q(r"(?is)^<a\b[^>]*>(.*)</a\s*>$")
    return f"""
    (SELECT {seq} AS seq, pos, base, href, anchor_text FROM (
      SELECT seq0 AS {seq}, pos, base,
             CASE WHEN regexp_matches(st, '(?is)\\shref\\b') THEN {strip(attr('st', 'href'))} END AS href,
             {fragment_text(f"regexp_extract(anchor, {inner_re}, 1)")} AS anchor_text
      FROM (SELECT seq0, base, anchor, pos, regexp_extract(anchor, {start_re}, 0) AS st FROM (
        SELECT seq0, base, unnest(arr) AS anchor, unnest(range(len(arr))) AS pos FROM (
          SELECT {seq} AS seq0, {base} AS base, regexp_extract_all({strip_non_text(html)}, {a_re}, 0) AS arr
          FROM {source}))))
     WHERE href IS NOT NULL)"""
