"""Session SQL functions for the most used Column rules.

Spark inlines a SQL function (``CREATE TEMPORARY FUNCTION ... RETURN expr``)
into the plan, so it runs exactly like the built-in expression it stands for,
JVM-side.  (Bodies that bind a value with ``transform`` are evaluated by Spark's
interpreter for higher-order functions, not in generated code.)  Calling it from Python is one call instead
of the hundreds needed to assemble the same expression tree with the Column
API, which keeps per-query planning time small.  Each body binds its
argument once (``transform(array(x), v -> ...)[0]``) so an expensive
argument is never evaluated twice.  Functions are registered lazily, once
per session.
"""

from __future__ import annotations

import re
import threading

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from .text import WS_CLASS, WS_RUN

URL_RE = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)"
USES_NETLOC = [
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
    "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
    "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
]


def lit(s: str) -> str:
    """Spark SQL string literal for ``s``."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


_PREPARE = (f"regexp_replace(regexp_replace(u, {lit('^[\\x00-\\x20' + WS_CLASS[1:-1] + ']+|' + WS_CLASS + '+$')}, ''),"
            f" {lit('[\\t\\r\\n]')}, '')")
_NETLOC_SCHEMES = ", ".join(lit(x) for x in USES_NETLOC)
_NORMALIZE = f"""
CASE WHEN u IS NULL THEN NULL ELSE transform(array({_PREPARE}), s ->
  transform(array(named_struct(
      's', lower(regexp_extract(s, {lit(URL_RE)}, 1)),
      'n', lower(regexp_extract(s, {lit(URL_RE)}, 2)),
      'p', regexp_replace(regexp_replace(regexp_replace(regexp_extract(s, {lit(URL_RE)}, 3),
                          ';[^/]*$', ''), '/+$', ''), '^$', '/'))), v ->
    concat(CASE WHEN v.s <> '' THEN concat(v.s, ':') ELSE '' END,
           CASE WHEN v.n <> '' OR startswith(v.p, '//')
                     OR (v.s <> '' AND v.s IN ({_NETLOC_SCHEMES}) AND startswith(v.p, '/'))
                THEN '//' ELSE '' END,
           v.n,
           CASE WHEN v.n <> '' AND NOT startswith(v.p, '/') THEN '/' ELSE '' END,
           v.p))[0])[0] END"""

DEFINITIONS = {
    "feedlake_clean_ws": ("s STRING", f"trim(regexp_replace(s, {lit(WS_RUN)}, ' '))"),
    "feedlake_strip_ws": ("s STRING", f"regexp_replace(s, {lit('^' + WS_CLASS + '+|' + WS_CLASS + '+$')}, '')"),
    "feedlake_normalize_url": ("u STRING", _NORMALIZE),
}

_lock = threading.Lock()
_registered: set[int] = set()


def ensure_registered(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is None:
        raise RuntimeError("an active SparkSession is needed to build feedlake Column functions")
    key = spark._jsparkSession.hashCode()
    if key in _registered:
        return
    with _lock:
        if key in _registered:
            return
        for name, (params, body) in DEFINITIONS.items():
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS STRING RETURN {body}")
        _registered.add(key)


# PySpark names higher-order-function lambda variables x_N / y_N / z_N.
_LAMBDA_VAR = re.compile(r"(?<![\w`'])[xyz]_\d+(?![\w`'])")


def _inside_lambda(c: Column) -> bool:
    return bool(_LAMBDA_VAR.search(c._jc.toString()))


def call(name: str, fallback, *cols: Column) -> Column:
    """``name(cols)`` as the session SQL function; inside a higher-order
    function lambda (where a SQL function cannot see lambda variables) the
    same rule is built with the Column API by ``fallback``."""
    if any(_inside_lambda(c) for c in cols):
        return fallback(*cols)
    ensure_registered()
    return F.call_function(name, *cols)
