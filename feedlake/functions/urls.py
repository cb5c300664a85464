"""URL Column functions.

URLs are split with one RFC-3986 regex instead of ``parse_url`` (which
returns NULL or fails on spaces and underscores).  Every rule here works on
plain strings with Spark built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col, let
from .text import WS_CLASS

# Scheme / authority / path split (query and fragment dropped).
URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"

# Schemes that carry an authority part and schemes that resolve
# relative references (the standard library's URL tables).
USES_NETLOC = [
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
    "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
    "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
]
USES_RELATIVE = [
    "", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https",
    "shttp", "mms", "prospero", "rtsp", "rtsps", "rtspu", "sftp", "svn",
    "svn+ssh", "ws", "wss",
]

# Link-candidate rules.
EXCLUDED_PATH_PREFIXES = ["/publish", "/api", "/account", "/signin", "/subscribe", "/search", "/feed"]
EXCLUDED_EXACT_PATHS = ["/", "/archive", "/about", "/reads"]
EXCLUDED_URL_PARTS = ["/likes", "/notes", "/podcast", "#", "?output="]


def _prepare(c) -> Column:
    """Strip surrounding whitespace / C0 controls and delete tab, CR, LF."""
    s = F.regexp_replace(as_col(c), "^[\\x00-\\x20" + WS_CLASS[1:-1] + "]+|" + WS_CLASS + "+$", "")
    return F.regexp_replace(s, "[\\t\\r\\n]", "")


def _strip_params(path: Column) -> Column:
    return F.regexp_replace(path, ";[^/]*$", "")


def _parts_struct(prepared: Column) -> Column:
    """struct(s: scheme lower-cased, n: netloc as written, p: path without params)."""
    return let(prepared, lambda s: F.struct(
        F.lower(F.regexp_extract(s, URL_RE, 1)).alias("s"),
        F.regexp_extract(s, URL_RE, 2).alias("n"),
        _strip_params(F.regexp_extract(s, URL_RE, 3)).alias("p"),
    ))


def url_parts(c) -> tuple[Column, Column, Column]:
    """(scheme lower-cased, netloc as written, path without ``;params``)."""
    st = _parts_struct(_prepare(c))
    return st["s"], st["n"], st["p"]


def _unsplit(scheme: Column, netloc: Column, path: Column) -> Column:
    """Rebuild ``scheme:`` + ``//netloc`` + path like the standard unsplit."""
    slash2 = (netloc != "") | path.startswith("//") | (
        (scheme != "") & scheme.isin(USES_NETLOC) & path.startswith("/"))
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        F.when(slash2, F.lit("//")).otherwise(F.lit("")),
        netloc,
        F.when((netloc != "") & ~path.startswith("/"), F.lit("/")).otherwise(F.lit("")),
        path,
    )


def _norm_struct(v: Column) -> Column:
    p = F.regexp_replace(F.regexp_replace(v["p"], "/+$", ""), "^$", "/")
    return let(p, lambda pp: _unsplit(v["s"], F.lower(v["n"]), pp))


def normalize_url(c) -> Column:
    """B1: lower-case scheme and host, drop params/query/fragment, strip
    trailing slashes, empty path -> ``/``.  Built as the session SQL function
    ``feedlake_normalize_url`` (same rule as :func:`_norm_struct`)."""
    from .sqlfns import call
    return call("feedlake_normalize_url", _normalize_cols, as_col(c))


def _normalize_cols(col: Column) -> Column:
    return F.when(col.isNull(), F.lit(None).cast("string")).otherwise(
        let(_parts_struct(_prepare(col)), _norm_struct))


def url_host(c) -> Column:
    """Lower-cased netloc."""
    return F.lower(url_parts(c)[1])


def url_path(c) -> Column:
    """Path component (params removed), case kept."""
    return url_parts(c)[2]


def is_http_url(c) -> Column:
    """Scheme http/https and a non-empty netloc."""
    return let(_parts_struct(_prepare(c)), lambda v: v["s"].isin("http", "https") & (v["n"] != ""))


def _strip_trailing_slashes(c) -> Column:
    return F.regexp_replace(as_col(c), "/+$", "")


def default_feed_url(c) -> Column:
    """``<url without trailing slashes>/feed``."""
    return F.concat(_strip_trailing_slashes(c), F.lit("/feed"))


def reads_url(c) -> Column:
    """``<profile without trailing slashes>/reads``."""
    return F.concat(_strip_trailing_slashes(c), F.lit("/reads"))


def _any_prefix(path: Column, prefixes) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | path.startswith(p)
    return out


def _any_contains(s: Column, parts) -> Column:
    out = F.lit(False)
    for p in parts:
        out = out | s.contains(p)
    return out


def is_article_url(c) -> Column:
    """Candidate article link (rules applied in the reference order)."""
    url = as_col(c)

    def body(v):
        p = v["lp"]
        n_slashes = F.char_length(p) - F.char_length(F.replace(p, F.lit("/"), F.lit("")))
        last_seg = F.substring_index(p, "/", -1)
        return (
            F.when(~(v["s"].isin("http", "https") & (v["n"] != "")), False)
            .when(p.isin(EXCLUDED_EXACT_PATHS), False)
            .when(_any_prefix(p, EXCLUDED_PATH_PREFIXES), False)
            .when(_any_contains(v["lu"], EXCLUDED_URL_PARTS), False)
            .when(p.contains("/p/"), True)
            .otherwise((n_slashes >= 2) & (F.char_length(last_seg) > 1))
        )

    parts = _parts_struct(_prepare(url))
    bound = let(parts, lambda st: F.struct(st["s"].alias("s"), st["n"].alias("n"),
                                           F.lower(st["p"]).alias("lp"), F.lower(url).alias("lu")))
    return F.when(url.isNull(), F.lit(None).cast("boolean")).otherwise(let(bound, body))


def is_publication_url(c, profile_host) -> Column:
    """Candidate publication link relative to the profile's host."""
    url = as_col(c)
    host = F.lower(as_col(profile_host))

    def body(v):
        p = v["lp"]
        same = F.lower(v["n"]) == v["host"]
        return (
            F.when(~(v["s"].isin("http", "https") & (v["n"] != "")), False)
            .when(p.contains("/p/"), False)
            .when(same & ~p.contains("/@"), False)
            .when(same & p.isin(EXCLUDED_EXACT_PATHS), False)
            .when(_any_prefix(p, EXCLUDED_PATH_PREFIXES), False)
            .otherwise(True)
        )

    parts = _parts_struct(_prepare(url))
    bound = let(parts, lambda st: F.struct(st["s"].alias("s"), st["n"].alias("n"),
                                           F.lower(st["p"]).alias("lp"), host.alias("host")))
    return F.when(url.isNull(), F.lit(None).cast("boolean")).otherwise(let(bound, body))


def _remove_dot_segments(segments: Column) -> Column:
    """Resolve ``.`` and ``..`` in a list of path segments."""
    def body(segs):
        resolved = F.aggregate(
            segs,
            F.array().cast("array<string>"),
            lambda acc, seg: (
                F.when(seg == "..", F.when(F.size(acc) > 0, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
                .when(seg == ".", acc)
                .otherwise(F.concat(acc, F.array(seg)))
            ),
        )
        return F.when(F.element_at(segs, -1).isin(".", ".."),
                      F.concat(resolved, F.array(F.lit("")))).otherwise(resolved)
    return let(segments, body)


def _merge_paths(base_path: Column, href_path: Column) -> Column:
    """Joined path of a relative reference (before dot-segment removal)."""
    def body(v):
        bd, hs = v["bd"], v["hs"]
        merged = F.concat(bd, hs)
        return let(merged, lambda m: F.when(F.size(m) > 2, F.concat(
            F.slice(m, 1, 1),
            F.filter(F.slice(m, 2, F.size(m) - 2), lambda x: x != ""),
            F.slice(m, -1, 1),
        )).otherwise(m))
    base_split = let(F.split(base_path, "/"), lambda a: F.when(
        F.element_at(a, -1) != "", F.slice(a, 1, F.size(a) - 1)).otherwise(a))
    return let(F.struct(base_split.alias("bd"), F.split(href_path, "/").alias("hs")), body)


def resolve_url(base, href) -> Column:
    """Normalised absolute URL of ``href`` relative to ``base``.

    Same outcome as resolving with the standard URL join and then applying
    :func:`normalize_url` (query, fragment and params never survive).
    """
    b_raw = as_col(base)
    h_raw = as_col(href)

    def body(v):
        b, h = v["b"], v["h"]
        bp, hp = v["bp"], v["hp"]
        scheme = F.when(hp["s"] != "", hp["s"]).otherwise(bp["s"])
        netloc_scheme = scheme.isin(USES_NETLOC)
        netloc = F.when(netloc_scheme, bp["n"]).otherwise(hp["n"])
        segments = F.when(hp["p"].startswith("/"), F.split(hp["p"], "/")).otherwise(
            _merge_paths(bp["p"], hp["p"]))
        joined = F.regexp_replace(F.array_join(_remove_dot_segments(segments), "/"), "^$", "/")
        absolute = (
            F.when(h == "", b)
            .when((scheme != bp["s"]) | ~scheme.isin(USES_RELATIVE), h)
            .when(netloc_scheme & (hp["n"] != ""),
                  F.when(hp["s"] != "", h).otherwise(F.concat(scheme, F.lit(":"), h)))
            .when(hp["p"] == "", b)
            .otherwise(_unsplit(scheme, netloc, joined))
        )
        return normalize_url(absolute)

    prepared = F.struct(_prepare(b_raw).alias("b"), _prepare(h_raw).alias("h"))
    bound = let(prepared, lambda p: F.struct(
        p["b"].alias("b"), p["h"].alias("h"),
        _parts_struct(p["b"]).alias("bp"), _parts_struct(p["h"]).alias("hp")))
    return F.when(b_raw.isNull() | h_raw.isNull(), F.lit(None).cast("string")).otherwise(let(bound, body))
