"""Text Column functions.

All functions take and return ``Column`` objects built only from Spark SQL
built-ins, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col

# The whitespace set of Python's ``str.split()`` / ``re \s``
# (29 code points), written as Java regex character classes.  Beyond Latin-1 one
# range check rules out other characters before the single ones are compared.
_WS_LATIN = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
_WS_WIDE = r"[\u1680-\u3000&&[\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]]"
WS_CLASS = rf"[\x20{_WS_LATIN}{_WS_WIDE}]"
#: Runs that collapsing changes: all but a single space, which is most of a text's whitespace.
WS_RUN = rf"[{_WS_LATIN}{_WS_WIDE}]{WS_CLASS}*|\x20{WS_CLASS}+"

# Line boundaries of Python's ``str.splitlines()``.
LINE_BREAK_RE = r"\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"

# Reference defaults.
NO_SUMMARY = "No summary available."
UNTITLED_PROMPT_TITLE = "Untitled article"


def clean_whitespace(c) -> Column:
    """B2: collapse every whitespace run to one space and trim.

    After the collapse only single U+0020 spaces remain, so plain trim is
    exact.  Built as the session SQL function ``feedlake_clean_ws``."""
    from .sqlfns import call
    return call("feedlake_clean_ws", _clean_cols, as_col(c))


def _clean_cols(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS_RUN, " "))


def normalize_text(c) -> Column:
    """B2: ``clean_whitespace`` with blank mapped to NULL."""
    return F.nullif(clean_whitespace(c), F.lit(""))


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace only."""
    from .sqlfns import call
    return call("feedlake_strip_ws", _strip_cols, as_col(c))


def _strip_cols(c: Column) -> Column:
    return F.regexp_replace(c, "^" + WS_CLASS + "+|" + WS_CLASS + "+$", "")


def trim_text(c, max_chars: int) -> Column:
    """Clean; when longer than ``max_chars`` code points cut there and
    drop the trailing partial word (a prefix without spaces is kept)."""
    cleaned = clean_whitespace(c)
    cut = F.substring(cleaned, 1, max_chars)
    return (
        F.when(F.char_length(cleaned) <= max_chars, cleaned)
        .otherwise(F.trim(F.regexp_replace(cut, " [^ ]*$", "")))
    )


def first_sentences(c, limit: int = 3) -> Column:
    """The first ``limit`` sentences, split after ``.!?`` + whitespace."""
    cleaned = clean_whitespace(c)
    parts = F.split(cleaned, r"(?<=[.!?]) ")
    return F.trim(F.array_join(F.slice(parts, 1, limit), " "))


def bullets(c) -> Column:
    """Up to three bullet strings from a summary text.

    More than one non-blank line: each line stripped of ``-``/space, then
    whitespace; first three.  Otherwise split on ``". "``, take three, strip,
    drop blanks.
    """
    text = as_col(c)
    lines = F.filter(F.split(text, LINE_BREAK_RE), lambda x: strip_ws(x) != "")
    cleaned_lines = F.transform(
        lines, lambda x: strip_ws(F.regexp_replace(x, r"^[- ]+|[- ]+$", ""))
    )
    sentences = F.filter(
        F.transform(F.slice(F.split(text, r"\. "), 1, 3), lambda x: strip_ws(x)),
        lambda x: x != "",
    )
    return (
        F.when(text.isNull(), F.array().cast("array<string>"))
        .when(F.size(lines) > 1, F.slice(cleaned_lines, 1, 3))
        .otherwise(sentences)
    )


def key_takeaway(c) -> Column:
    """First bullet, else the stripped text, else NULL."""
    return F.coalesce(F.get(bullets(c), 0), F.nullif(strip_ws(c), F.lit("")))


def content_hash(c) -> Column:
    """SHA-256 hex digest of the UTF-8 text."""
    return F.sha2(as_col(c), 256)


def short_id(c) -> Column:
    """16-hex-character id (prefix of the SHA-256 of the value)."""
    return F.substring(F.sha2(as_col(c), 256), 1, 16)


def topic_tags(c) -> Column:
    """Comma-separated keywords -> cleaned, non-blank parts in order."""
    kw = clean_whitespace(c)
    parts = F.filter(F.transform(F.split(kw, ","), clean_whitespace), lambda x: x != "")
    return F.when(F.coalesce(kw, F.lit("")) == "", F.array().cast("array<string>")).otherwise(parts)


def first_non_blank(*cols) -> Column:
    """First value that is neither NULL nor the empty string."""
    return F.coalesce(*[F.nullif(as_col(c), F.lit("")) for c in cols])


def summary_prompt(title, text, length: str = "medium") -> Column:
    """The model prompt for one article."""
    t = F.coalesce(F.nullif(as_col(title), F.lit("")), F.lit(UNTITLED_PROMPT_TITLE))
    return F.concat(
        F.lit(f"Summarize the following article in a {length} format. "
              "Return plain text only.\n\nTitle: "),
        t,
        F.lit("\n\nArticle:\n"),
        as_col(text),
    )
