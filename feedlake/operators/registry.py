"""Publication registry: upserts, expiry, check folding.

The registry is a DataFrame keyed by ``publication_url``.  Every upsert is one
full outer join between the current registry and the changes reduced to one
row per key (``max(struct(seq, value))`` keeps the last non-empty value in
change order and aggregates partially before the shuffle).  Insertion order
is carried as (``inserted_at``, ``seq``) so ranking ties keep it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.status import error_type
from ..functions.text import short_id
from ..functions.urls import default_feed_url, normalize_url
from ..session import cut_lineage

REGISTRY_SCHEMA = T.StructType([
    T.StructField("publication_url", T.StringType(), False),
    T.StructField("publication_id", T.StringType()),
    T.StructField("publication_name", T.StringType()),
    T.StructField("rss_url", T.StringType()),
    T.StructField("discovered_from_profile", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen_on_reads", T.TimestampType()),
    T.StructField("last_checked", T.TimestampType()),
    T.StructField("last_attempted_check", T.TimestampType()),
    T.StructField("last_successful_check", T.TimestampType()),
    T.StructField("monitor_status", T.StringType()),
    T.StructField("monitor_method", T.StringType()),
    T.StructField("expiry_after_days", T.IntegerType()),
    T.StructField("is_active", T.BooleanType()),
    T.StructField("last_error_type", T.StringType()),
    T.StructField("last_error_message", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("inserted_at", T.TimestampType()),
    T.StructField("seq", T.LongType()),
])
REGISTRY_COLUMNS = [f.name for f in REGISTRY_SCHEMA.fields]

# Reference defaults.
DEFAULT_EXPIRY_DAYS = 30
DEFAULT_MONITOR_STATUS = "pending"
DEFAULT_MONITOR_METHOD = "rss"
HEALTH_COLUMNS = ["name", "url", "monitor_status", "last_successful_check", "last_attempted_check",
                  "last_error_type", "last_error_message"]


def empty_registry(spark) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def with_registry_defaults(df: DataFrame, expiry_days: int = DEFAULT_EXPIRY_DAYS) -> DataFrame:
    """Older state gets its missing values: a defaulted column that is
    absent, or NULL in a row written before the column existed, takes the
    default; other absent columns are NULL."""
    defaults = {
        "monitor_status": F.lit(DEFAULT_MONITOR_STATUS), "monitor_method": F.lit(DEFAULT_MONITOR_METHOD),
        "expiry_after_days": F.lit(expiry_days), "is_active": F.lit(True),
    }
    columns = []
    for field in REGISTRY_SCHEMA.fields:
        value = F.col(field.name).cast(field.dataType) if field.name in df.columns else F.lit(None).cast(field.dataType)
        if field.name in defaults:
            value = F.coalesce(value, defaults[field.name].cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns)


def _ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def expire(registry: DataFrame, now, default_expiry: int = DEFAULT_EXPIRY_DAYS) -> DataFrame:
    """Deactivate rows whose whole days since last seen exceed their
    expiry (strict).  Whole days = floor(elapsed seconds / 86400)."""
    now_c = _ts(now)
    age_days = F.floor((F.unix_micros(now_c) - F.unix_micros(F.col("last_seen_on_reads"))) / 86_400_000_000)
    expired = F.col("last_seen_on_reads").isNotNull() & (
        age_days > F.coalesce(F.col("expiry_after_days"), F.lit(default_expiry)))
    return registry.withColumn("is_active", F.when(expired, F.lit(False)).otherwise(F.col("is_active")))


def active(registry: DataFrame) -> DataFrame:
    """Rows with ``is_active`` (missing counts as active)."""
    return registry.where(F.coalesce(F.col("is_active"), F.lit(True)))


def top_publications(registry: DataFrame, now, k: int | None = 20,
                     default_expiry: int = DEFAULT_EXPIRY_DAYS) -> DataFrame:
    """active publications by last seen (newest first, ties in insertion
    order), first ``k``.  Plans as TakeOrderedAndProject; ``k=None`` keeps
    every active publication (unordered)."""
    act = active(expire(registry, now, default_expiry))
    if k is None:
        return act
    return act.orderBy(F.col("last_seen_on_reads").desc_nulls_last(), F.col("inserted_at").asc(),
                       F.col("seq").asc()).limit(k)


def _last_nonblank(value: Column, order: Column) -> Column:
    return F.max(F.when(F.coalesce(value, F.lit("")) != "", F.struct(order.alias("o"), value.alias("v"))))["v"]


def _reduce_changes(changes: DataFrame, seq_col: str) -> DataFrame:
    seq = F.col(seq_col)
    return (changes.withColumn("_url", normalize_url(F.col("publication_url")))
            .groupBy("_url").agg(
                _last_nonblank(F.col("publication_name"), seq).alias("_name"),
                _last_nonblank(F.col("rss_url"), seq).alias("_rss"),
                F.max(F.struct(seq.alias("o"), F.col("discovered_from_profile").alias("v")))["v"].alias("_profile_last"),
                _last_nonblank(F.col("discovered_from_profile"), seq).alias("_profile_nb"),
                F.min(seq).alias("_first_seq"),
            ))


def _upsert(registry: DataFrame, changes: DataFrame, seen_at, *, mark_seen: bool, keep_error_message: bool,
            profile_fallback: bool, default_expiry: int, seq_col: str) -> DataFrame:
    seen = _ts(seen_at)
    red = _reduce_changes(changes, seq_col)
    r = registry.alias("r")
    j = r.join(red, F.col("r.publication_url") == red["_url"], "full_outer")
    exists = F.col("r.publication_url").isNotNull()
    found = F.col("_url").isNotNull()
    url = F.coalesce(F.col("r.publication_url"), F.col("_url"))

    def keep(c: str) -> Column:
        return F.col(f"r.{c}")

    profile = (F.coalesce(F.col("_profile_nb"), F.nullif(keep("discovered_from_profile"), F.lit("")), url)
               if profile_fallback else F.col("_profile_last"))
    if mark_seen:
        last_seen = seen
    else:
        last_seen = F.when(keep("last_seen_on_reads").isNull(), seen).otherwise(keep("last_seen_on_reads"))
    cols = {
        "publication_url": url,
        "publication_id": F.when(exists, keep("publication_id")).otherwise(short_id(url)),
        "publication_name": F.coalesce(F.col("_name"), F.nullif(keep("publication_name"), F.lit("")), url),
        "rss_url": F.coalesce(F.col("_rss"), F.nullif(keep("rss_url"), F.lit("")), default_feed_url(url)),
        "discovered_from_profile": profile,
        "first_seen": F.when(exists, keep("first_seen")).otherwise(seen),
        "last_seen_on_reads": last_seen,
        "last_checked": keep("last_checked"),
        "last_attempted_check": keep("last_attempted_check"),
        "last_successful_check": keep("last_successful_check"),
        "monitor_status": F.when(exists, keep("monitor_status")).otherwise(F.lit(DEFAULT_MONITOR_STATUS)),
        "monitor_method": F.when(exists, keep("monitor_method")).otherwise(F.lit(DEFAULT_MONITOR_METHOD)),
        "expiry_after_days": F.when(exists, keep("expiry_after_days")).otherwise(F.lit(default_expiry)),
        "is_active": F.lit(True),
        "last_error_type": keep("last_error_type"),
        "last_error_message": keep("last_error_message") if keep_error_message else F.lit(None).cast("string"),
        "error_message": F.lit(None).cast("string"),
        "inserted_at": F.when(exists, keep("inserted_at")).otherwise(seen),
        "seq": F.when(exists, keep("seq")).otherwise(F.col("_first_seq")),
    }
    updated = {k: F.when(found, v).otherwise(keep(k)) if k != "publication_url" else v for k, v in cols.items()}
    out = j.select(*[updated[c].cast(REGISTRY_SCHEMA[c].dataType).alias(c) for c in REGISTRY_COLUMNS])
    return out


def upsert_from_reads(registry: DataFrame, found: DataFrame, seen_at, default_expiry: int = DEFAULT_EXPIRY_DAYS,
                      seq_col: str = "seq") -> DataFrame:
    """G1: apply publications found on reads pages.

    New rows get id, defaults and ``active``.  Existing rows keep id,
    first_seen, check fields, last_error_type and expiry; name / feed URL take
    the new non-empty value, else the old, else the URL / default feed;
    profile is overwritten; last_seen moves to ``seen_at``; last_error_message
    and error_message are cleared.
    """
    return _upsert(registry, found, seen_at, mark_seen=True, keep_error_message=False,
                   profile_fallback=False, default_expiry=default_expiry, seq_col=seq_col)


def upsert_publication(registry: DataFrame, rows: DataFrame, seen_at, mark_seen: bool = False,
                       default_expiry: int = DEFAULT_EXPIRY_DAYS, seq_col: str = "seq") -> DataFrame:
    """Like G1, but last_seen moves only with ``mark_seen`` or when empty,
    the profile falls back to the old one then the URL, and
    last_error_message is kept."""
    return _upsert(registry, rows, seen_at, mark_seen=mark_seen, keep_error_message=True,
                   profile_fallback=True, default_expiry=default_expiry, seq_col=seq_col)


def seed_rows(seeds: DataFrame, default_profile: str) -> DataFrame:
    """A3 rows -> upsert rows: URL alias, name alias, profile fallback;
    seeds without a URL are dropped."""
    def opt(c: str) -> Column:
        return F.col(c) if c in seeds.columns else F.lit(None).cast("string")
    url = F.coalesce(F.nullif(opt("publication_url"), F.lit("")), F.nullif(opt("url"), F.lit("")))
    return seeds.select(
        F.col("seq"),
        url.alias("publication_url"),
        F.coalesce(F.nullif(opt("publication_name"), F.lit("")), F.nullif(opt("name"), F.lit("")), F.lit(""))
        .alias("publication_name"),
        opt("rss_url").alias("rss_url"),
        F.coalesce(F.nullif(opt("discovered_from_profile"), F.lit("")), F.lit(default_profile))
        .alias("discovered_from_profile"),
    ).where(F.col("publication_url").isNotNull())


def import_publications(registry: DataFrame, seeds: DataFrame, default_profile: str, seen_at,
                        default_expiry: int = DEFAULT_EXPIRY_DAYS) -> tuple[DataFrame, DataFrame]:
    """Seed rows through G2 with mark_seen=false -> (registry, imported)."""
    rows = seed_rows(seeds, default_profile)
    return upsert_publication(registry, rows, seen_at, mark_seen=False, default_expiry=default_expiry), rows


def mark_checked(registry: DataFrame, checks: DataFrame) -> DataFrame:
    """Fold check results (publication_url, checked_at, success,
    monitor_method, error_message, error_type, seq) into the registry.

    The last check per publication sets last_checked / last_attempted, the
    method, ok/error status and the error fields (cleared on success);
    last_successful_check comes from the last success; any success
    re-activates.  Checks for unknown publications are ignored.
    """
    return apply_checks(registry, check_fold(checks))


def check_fold(checks: DataFrame, *more: str) -> DataFrame:
    """One row per publication (and per value of ``more``): its last check, the time of its last success, whether any succeeded."""
    c = checks.withColumn("_url", normalize_url(F.col("publication_url")))
    order = F.struct(F.col("checked_at").alias("t"), F.col("seq").alias("s"))
    return c.groupBy("_url", *more).agg(
        F.max(F.struct(order.alias("o"), F.col("checked_at").alias("checked_at"), F.col("success").alias("success"),
                       F.col("monitor_method").alias("method"), F.col("error_message").alias("msg"),
                       F.col("error_type").alias("etype"))).alias("_last"),
        F.max(F.when(F.col("success"), order))["t"].alias("_last_ok"),
        F.max(F.col("success").cast("int")).alias("_any_ok"),
    )


def merge_folds(folds: DataFrame) -> DataFrame:
    """Folds of several days as one: all three are maxima."""
    return folds.groupBy("_url").agg(*[F.max(c).alias(c) for c in ("_last", "_last_ok", "_any_ok")])


def apply_checks(registry: DataFrame, agg: DataFrame) -> DataFrame:
    """The registry after the folded checks."""
    r = registry.alias("r")
    j = r.join(agg, F.col("r.publication_url") == agg["_url"], "left")
    hit = F.col("_url").isNotNull()
    last = F.col("_last")
    ok = last["success"]
    changed = {
        "last_checked": last["checked_at"],
        "last_attempted_check": last["checked_at"],
        "monitor_method": last["method"],
        "monitor_status": F.when(ok, F.lit("ok")).otherwise(F.lit("error")),
        "error_message": F.when(ok, F.lit(None)).otherwise(last["msg"]),
        "last_error_type": F.when(ok, F.lit(None)).otherwise(last["etype"]),
        "last_error_message": F.when(ok, F.lit(None)).otherwise(last["msg"]),
        "last_successful_check": F.coalesce(F.col("_last_ok"), F.col("r.last_successful_check")),
        "is_active": F.when(F.col("_any_ok") == 1, F.lit(True)).otherwise(F.col("r.is_active")),
    }
    return j.select(*[
        (F.when(hit, changed[c]).otherwise(F.col(f"r.{c}")) if c in changed else F.col(f"r.{c}"))
        .cast(REGISTRY_SCHEMA[c].dataType).alias(c)
        for c in REGISTRY_COLUMNS])


def check_rows(results: DataFrame, checked_at) -> DataFrame:
    """Monitor results (publication_url, success, monitor_method, error_message, seq)
    -> check rows with the classified error type (B11)."""
    return results.select(
        "publication_url", _ts(checked_at).alias("checked_at"), "success",
        F.when(F.col("success"), F.col("monitor_method")).otherwise(F.lit(DEFAULT_MONITOR_METHOD)).alias("monitor_method"),
        F.when(F.col("success"), F.lit(None).cast("string")).otherwise(F.col("error_message")).alias("error_message"),
        F.when(F.col("success"), F.lit(None).cast("string")).otherwise(error_type(F.col("error_message"))).alias("error_type"),
        "seq")


def recent_posts(pubs: DataFrame, feed_items: DataFrame, feed_status: DataFrame,
                 home_items: DataFrame | None = None, home_status: DataFrame | None = None,
                 rss_enabled: bool = True, html_fallback_enabled: bool = True,
                 materialize: bool = False) -> tuple[DataFrame, DataFrame]:
    """Per monitored publication pick feed rows (when the feed parsed, even
    with zero rows), else home-page rows, else nothing with method
    ``disabled``.  Returns (items, results) where results has one row per
    publication: success, monitor_method, error_message.  ``materialize``
    checkpoints the narrow results, which the items and the registry both read,
    so that feeds are not parsed again for each of them.
    """
    p = pubs.select("publication_url", "seq")
    fs = feed_status.select(F.col("publication_url").alias("_f_url"), "feed_ok", "feed_error")
    j = p.join(fs, p["publication_url"] == fs["_f_url"], "left")
    if home_status is not None:
        hs = home_status.select(F.col("publication_url").alias("_h_url"), "home_ok", "home_error")
        j = j.join(hs, j["publication_url"] == hs["_h_url"], "left")
    else:
        j = j.withColumn("home_ok", F.lit(False)).withColumn("home_error", F.lit("no home page fetched"))
    feed_ok = F.coalesce(F.col("feed_ok"), F.lit(False))
    feed_err = F.coalesce(F.col("feed_error"), F.lit("no feed fetched"))
    home_ok = F.coalesce(F.col("home_ok"), F.lit(False))
    home_err = F.coalesce(F.col("home_error"), F.lit("no home page fetched"))
    if rss_enabled and html_fallback_enabled:
        method = F.when(feed_ok, "rss").otherwise("html_fallback")
        success = feed_ok | home_ok
        err = F.when(feed_ok, None).when(home_ok, None).otherwise(home_err)
    elif rss_enabled:
        method, success, err = F.lit("rss"), feed_ok, F.when(feed_ok, None).otherwise(feed_err)
    elif html_fallback_enabled:
        method, success, err = F.lit("html_fallback"), home_ok, F.when(home_ok, None).otherwise(home_err)
    else:
        method, success, err = F.lit("disabled"), F.lit(True), F.lit(None)
    results = j.select("publication_url", "seq", success.alias("success"), method.alias("monitor_method"),
                       err.cast("string").alias("error_message"))
    if materialize:
        results = cut_lineage(results)
    use_feed = results.where(F.col("success") & (F.col("monitor_method") == "rss")).select("publication_url")
    items = feed_items.join(use_feed.withColumnRenamed("publication_url", "source_url"), "source_url", "left_semi")
    if home_items is not None:
        use_home = results.where(F.col("success") & (F.col("monitor_method") == "html_fallback")) \
            .select(F.col("publication_url").alias("source_url"))
        items = items.unionByName(home_items.join(use_home, "source_url", "left_semi"), allowMissingColumns=True)
    return items, results


def health_snapshot(registry: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """7-column health view, plus an optional extra source row."""
    snap = registry.select(
        F.col("publication_name").alias("name"), F.col("publication_url").alias("url"), "monitor_status",
        "last_successful_check",
        F.coalesce(F.col("last_attempted_check"), F.col("last_checked")).alias("last_attempted_check"),
        "last_error_type", "last_error_message")
    if extra is not None:
        snap = snap.unionByName(extra.select(*HEALTH_COLUMNS))
    return snap
