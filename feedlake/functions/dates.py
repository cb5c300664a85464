"""Date Column functions.

Run clocks are passed in as literals (``run_ts``) so every job is
deterministic; nothing reads the wall clock inside a plan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._common import as_col

# RFC 2822 zone names and their offsets in minutes.
ZONE_OFFSETS_MIN = {
    "UT": 0, "UTC": 0, "GMT": 0, "Z": 0,
    "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360,
    "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

RFC2822_RE = (
    r"^\s*(?:[A-Za-z]+,?\s+)?(\d{1,2})\s+([A-Za-z]{3})\s+(\d{2,4})\s+"
    r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s+([A-Za-z]+|[+-]\d{4}))?\s*$"
)


def iso_seconds(ts) -> Column:
    """Timestamp -> ``YYYY-MM-DDTHH:MM:SS+00:00`` (UTC session clock)."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def iso_z(ts) -> Column:
    """Timestamp -> ``YYYY-MM-DDTHH:MM:SSZ``."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def run_date(ts, tz: str = "UTC") -> Column:
    """Run date ``YYYY-MM-DD`` of a UTC timestamp in zone ``tz``."""
    return F.date_format(F.from_utc_timestamp(as_col(ts), tz), "yyyy-MM-dd")


def run_id(ts, tz: str = "UTC") -> Column:
    """Daily run id ``YYYYMMDDTHHMMSS`` in zone ``tz``."""
    return F.date_format(F.from_utc_timestamp(as_col(ts), tz), "yyyyMMdd'T'HHmmss")


def state_run_id(ts) -> Column:
    """Health-state run id (ISO seconds with ``Z``)."""
    return iso_z(ts)


def _rfc_parts(s: Column):
    g = [F.regexp_extract(s, RFC2822_RE, i) for i in range(1, 8)]
    return g


def _offset_minutes(zone: Column) -> Column:
    """Offset in minutes; NULL for a naive value (no zone, unknown name, -0000)."""
    z = F.upper(zone)
    named = F.lit(None).cast("int")
    for name, mins in ZONE_OFFSETS_MIN.items():
        named = F.when(z == name, F.lit(mins)).otherwise(named)
    num = F.when(z.rlike(r"^[+-]\d{4}$"),
                 (F.when(F.substring(z, 1, 1) == "-", -1).otherwise(1)) *
                 (F.substring(z, 2, 2).cast("int") * 60 + F.substring(z, 4, 2).cast("int")))
    mins = F.when(z.rlike(r"^[+-]\d{4}$"), num).otherwise(named)
    return F.when(z == "-0000", F.lit(None).cast("int")).otherwise(mins)


def _fmt_offset(mins: Column) -> Column:
    a = F.abs(mins)
    return F.when(mins.isNull(), F.lit("")).otherwise(F.concat(
        F.when(mins < 0, F.lit("-")).otherwise(F.lit("+")),
        F.lpad((F.floor(a / 60)).cast("string"), 2, "0"), F.lit(":"),
        F.lpad((a % 60).cast("string"), 2, "0")))


def _rfc_local(s: Column):
    d, mon, y, hh, mm, ss, zone = _rfc_parts(s)
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(mon))
    yi = y.cast("int")
    year = F.when(F.char_length(y) <= 2, F.when(yi > 68, yi + 1900).otherwise(yi + 2000)).otherwise(yi)
    sec = F.when(ss == "", F.lit("0")).otherwise(ss)
    local_txt = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), month.cast("string"), d)
    local_txt = F.concat(local_txt, F.lit(" "), hh, F.lit(":"), mm, F.lit(":"), sec)
    local_ts = F.when((d != "") & (month > 0),
                      F.try_to_timestamp(local_txt, F.lit("y-M-d H:m:s")))
    return local_ts, zone


def parse_feed_date(c) -> Column:
    """RFC 2822 text -> ISO 8601 text with the original offset.

    A value that does not parse is returned unchanged (ISO dates in Atom
    feeds stay raw).  A value without zone, an unknown zone name or ``-0000``
    gives an ISO text without offset.
    """
    s = as_col(c)
    local_ts, zone = _rfc_local(s)
    mins = _offset_minutes(zone)
    iso = F.concat(F.date_format(local_ts, "yyyy-MM-dd'T'HH:mm:ss"), _fmt_offset(mins))
    return F.when(local_ts.isNotNull(), iso).otherwise(s)
