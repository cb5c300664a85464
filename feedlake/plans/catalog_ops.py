"""Registered queries, part 2: registry, monitoring, outputs, health, state,
streaming and the flagship digest (see :mod:`feedlake.plans.catalog`)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as fl
from ..operators import dedupe, extract, health, outputs, registry, state, summarize
from ..operators.seen import SeenSet
from ..session import cut_lineage
from ..sources import commits, io
from . import inputs as I
from . import sqlref as S
from .catalog import (_DIRECT_SQL, _BROKEN, _CANON_ROWS_SQL, _FEED_ITEMS_SQL, _PUB_URL, _RANKED, _RESP_SQL, _arr,
                      _canonical_ok_sql, _checks_sql, _doc_articles_sql, _page_articles_sql,
                      _page_canonical_rows, _t, _ts, register)

# ============================================================ G / D5-D7 / F1: registry

_REG_TS = ["first_seen", "last_seen_on_reads", "last_checked", "last_attempted_check", "last_successful_check",
           "inserted_at"]
_REG_SQL_TYPES = {"expiry_after_days": "INTEGER", "is_active": "BOOLEAN", "seq": "BIGINT"}


def _reg_out(df: DataFrame) -> DataFrame:
    return df.select(*[(_ts(F.col(c)).alias(c) if c in _REG_TS else F.col(c)) for c in registry.REGISTRY_COLUMNS])


def _reg_out_sql(src: str) -> str:
    cols = ", ".join(f"{S.ts_text(c)} AS {c}" if c in _REG_TS else c for c in registry.REGISTRY_COLUMNS)
    return f"SELECT {cols} FROM {src}"


def _msg_sql(value: str, uid: str) -> str:
    host = f"'pub' || CAST({uid} AS VARCHAR) || '.example.com'"
    return (f"CASE WHEN {value} < 10 THEN 'Failed to resolve ''' || {host} || ''' ([Errno -2] Name or service not known)' "
            f"WHEN {value} < 20 THEN '403 Client Error: Forbidden for url: https://' || {host} || '/feed' "
            f"WHEN {value} < 30 THEN 'HTTPSConnectionPool(host=''' || {host} || ''', port=443): Read timed out. (read timeout=20)' "
            f"WHEN {value} < 40 THEN 'XML parse error: not well-formed (invalid token): line 1, column 0' "
            f"WHEN {value} < 60 THEN 'HTTPSConnectionPool(host=''' || {host} || ''', port=443): Max retries exceeded with url: /feed' "
            f"WHEN {value} < 100 THEN 'The read operation timed out' ELSE 'Connection reset by peer' END")


def _reg_sql(before: str | None = None) -> str:
    cond = f" AND ts < TIMESTAMP '{before}'" if before else ""
    url = "'https://pub' || CAST(v.user_id AS VARCHAR) || '.example.com/'"
    msg = _msg_sql("e.value", "v.user_id")
    return f"""
    (SELECT {url} AS publication_url, {S.short_id(url)} AS publication_id,
            'Publication ' || CAST(v.user_id AS VARCHAR) AS publication_name, {url} || 'feed' AS rss_url,
            '{I.SOURCE_PROFILE}' AS discovered_from_profile, v.first_seen, v.last_seen AS last_seen_on_reads,
            NULL::TIMESTAMP AS last_checked, NULL::TIMESTAMP AS last_attempted_check,
            NULL::TIMESTAMP AS last_successful_check,
            CASE WHEN e.user_id IS NOT NULL THEN 'error' ELSE 'pending' END AS monitor_status, 'rss' AS monitor_method,
            v.expiry AS expiry_after_days, true AS is_active,
            CASE WHEN e.user_id IS NOT NULL THEN {S.error_type(msg)} END AS last_error_type,
            CASE WHEN e.user_id IS NOT NULL THEN {msg} END AS last_error_message,
            CASE WHEN e.user_id IS NOT NULL THEN {msg} END AS error_message,
            v.first_seen AS inserted_at, CAST(v.user_id AS BIGINT) AS seq
     FROM (SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, CAST(floor(min(value)) AS INTEGER) AS expiry
           FROM events WHERE event_type = 'view'{cond} GROUP BY user_id) v
     LEFT JOIN (SELECT user_id, value FROM (
                  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
                  FROM events WHERE event_type = 'error'{cond}) WHERE r = 1) e ON v.user_id = e.user_id)"""


def _upsert_sql(reg: str, red: str, seen_ts: str, *, mark_seen: bool, keep_err: bool, profile_fallback: bool,
                expiry: int = registry.DEFAULT_EXPIRY_DAYS) -> str:
    """Full outer join of a registry and reduced changes (_url, _name, _rss,
    _profile_last, _profile_nb, _first_seq) with the G1 / G2 column rules."""
    seen = f"TIMESTAMP '{seen_ts}'"
    url = "coalesce(r.publication_url, c._url)"
    ex = "r.publication_url IS NOT NULL"
    profile = (f"coalesce(c._profile_nb, nullif(r.discovered_from_profile, ''), {url})" if profile_fallback
               else "c._profile_last")
    last_seen = seen if mark_seen else f"CASE WHEN r.last_seen_on_reads IS NULL THEN {seen} ELSE r.last_seen_on_reads END"
    rules = {
        "publication_id": f"CASE WHEN {ex} THEN r.publication_id ELSE {S.short_id(url)} END",
        "publication_name": f"coalesce(c._name, nullif(r.publication_name, ''), {url})",
        "rss_url": f"coalesce(c._rss, nullif(r.rss_url, ''), regexp_replace({url}, '/+$', '') || '/feed')",
        "discovered_from_profile": profile,
        "first_seen": f"CASE WHEN {ex} THEN r.first_seen ELSE {seen} END",
        "last_seen_on_reads": last_seen,
        "monitor_status": f"CASE WHEN {ex} THEN r.monitor_status ELSE 'pending' END",
        "monitor_method": f"CASE WHEN {ex} THEN r.monitor_method ELSE 'rss' END",
        "expiry_after_days": f"CASE WHEN {ex} THEN r.expiry_after_days ELSE {expiry} END",
        "is_active": "true",
        "last_error_message": "r.last_error_message" if keep_err else "NULL",
        "error_message": "NULL",
        "inserted_at": f"CASE WHEN {ex} THEN r.inserted_at ELSE {seen} END",
        "seq": f"CASE WHEN {ex} THEN r.seq ELSE c._first_seq END",
    }
    cols = []
    for c in registry.REGISTRY_COLUMNS:
        if c == "publication_url":
            cols.append(f"{url} AS {c}")
        elif c in rules:
            cols.append(f"CASE WHEN c._url IS NOT NULL THEN {rules[c]} ELSE r.{c} END AS {c}")
        else:
            cols.append(f"r.{c} AS {c}")
    return f"(SELECT {', '.join(cols)} FROM {reg} r FULL OUTER JOIN {red} c ON r.publication_url = c._url)"


def _registry_expire_spark(spark, sf):
    reg = registry.expire(I.registry_from_events(_t(spark, sf, "events")), I.RUN_TS)
    return reg.select("publication_url", _ts(F.col("last_seen_on_reads")).alias("last_seen"),
                      "expiry_after_days", "is_active")


_EXPIRED = (f"floor((epoch_us(TIMESTAMP '{I.RUN_TS}') - epoch_us(last_seen_on_reads)) / 86400000000) "
            f"> expiry_after_days")

register("registry_expire", f"""
SELECT publication_url, {S.ts_text('last_seen_on_reads')} AS last_seen, expiry_after_days,
       CASE WHEN last_seen_on_reads IS NOT NULL AND {_EXPIRED} THEN false ELSE is_active END AS is_active
FROM {_reg_sql()}""")(_registry_expire_spark)

register("top_publications", f"""
SELECT publication_url, {S.ts_text('last_seen_on_reads')} AS last_seen FROM {_reg_sql()}
WHERE NOT (last_seen_on_reads IS NOT NULL AND {_EXPIRED})
ORDER BY last_seen_on_reads DESC, inserted_at, seq LIMIT 20""")(
    lambda spark, sf: registry.top_publications(I.registry_from_events(_t(spark, sf, "events")), I.RUN_TS, 20).select(
        "publication_url", _ts(F.col("last_seen_on_reads")).alias("last_seen")))


def _upsert_from_reads_spark(spark, sf):
    ev = _t(spark, sf, "events")
    reg = I.registry_from_events(ev, before=I.SPLIT_TS)
    return _reg_out(registry.upsert_from_reads(reg, I.found_publications(ev, I.SPLIT_TS), I.RUN_TS))


_FOUND_RED = f"""
(SELECT _url, arg_max(name, event_id) AS _name, arg_max(rss, event_id) FILTER (WHERE rss IS NOT NULL) AS _rss,
        '{I.SOURCE_PROFILE}' AS _profile_last, '{I.SOURCE_PROFILE}' AS _profile_nb, min(event_id) AS _first_seq
 FROM (SELECT event_id, 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/' AS _url,
              'Publication ' || CAST(user_id AS VARCHAR) || ' #' || CAST(event_id AS VARCHAR) AS name,
              CASE WHEN value > 100 THEN 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/rss' END AS rss
       FROM events WHERE event_type = 'view' AND ts >= TIMESTAMP '{I.SPLIT_TS}')
 GROUP BY _url)"""

register("upsert_from_reads", _reg_out_sql(_upsert_sql(_reg_sql(I.SPLIT_TS), _FOUND_RED, I.RUN_TS, mark_seen=True,
                                                       keep_err=False, profile_fallback=False)))(
    _upsert_from_reads_spark)


def _import_seeds_spark(spark, sf):
    pages = _t(spark, sf, "pages").withColumn("host", fl.url_host("url"))
    old = pages.where(F.col("url").contains("?")).select(
        F.col("page_id").alias("seq"), F.concat(F.lit("https://"), F.col("host")).alias("publication_url"),
        F.concat(F.lit("Old "), F.col("host")).alias("publication_name"), F.lit(None).cast("string").alias("rss_url"),
        F.lit("https://old.example.com/@x").alias("discovered_from_profile"))
    reg = registry.upsert_from_reads(registry.empty_registry(spark), old, I.PRIOR_TS)
    https = F.col("url").startswith("https://")
    seeds = pages.select(
        F.col("page_id").alias("seq"),
        F.when(https, F.concat(F.lit("https://"), F.col("host"), F.lit("/"))).alias("publication_url"),
        F.when(~https, F.concat(F.lit("http://"), F.col("host"))).alias("url"),
        F.when(https, F.col("host")).alias("publication_name"), F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("rss_url"), F.lit(None).cast("string").alias("discovered_from_profile"))
    new_reg, _ = registry.import_publications(reg, seeds, I.SOURCE_PROFILE, I.RUN_TS)
    return _reg_out(new_reg)


_HOST = S.url_host("url")
_OLD_RED = f"""
(SELECT _url, arg_max(name, seq) AS _name, NULL::VARCHAR AS _rss, 'https://old.example.com/@x' AS _profile_last,
        'https://old.example.com/@x' AS _profile_nb, min(seq) AS _first_seq
 FROM (SELECT page_id AS seq, {S.normalize_url(f"'https://' || {_HOST}")} AS _url, 'Old ' || {_HOST} AS name
       FROM pages WHERE contains(url, '?'))
 GROUP BY _url)"""
_EMPTY_REG = "(SELECT " + ", ".join(
    f"NULL::{'TIMESTAMP' if c in _REG_TS else _REG_SQL_TYPES.get(c, 'VARCHAR')} AS {c}"
    for c in registry.REGISTRY_COLUMNS) + " WHERE false)"
_SEED_RED = f"""
(SELECT _url, max(CASE WHEN name <> '' THEN struct_pack(o := seq, v := name) END).v AS _name, NULL::VARCHAR AS _rss,
        '{I.SOURCE_PROFILE}' AS _profile_last, '{I.SOURCE_PROFILE}' AS _profile_nb, min(seq) AS _first_seq
 FROM (SELECT page_id AS seq,
              {S.normalize_url(f"CASE WHEN starts_with(url, 'https://') THEN 'https://' || {_HOST} || '/' ELSE 'http://' || {_HOST} END")} AS _url,
              CASE WHEN starts_with(url, 'https://') THEN {_HOST} ELSE '' END AS name
       FROM pages)
 GROUP BY _url)"""
_OLD_REG = _upsert_sql(_EMPTY_REG, _OLD_RED, I.PRIOR_TS, mark_seen=True, keep_err=False, profile_fallback=False)

register("import_seeds", _reg_out_sql(_upsert_sql(_OLD_REG, _SEED_RED, I.RUN_TS, mark_seen=False, keep_err=True,
                                                  profile_fallback=True)))(_import_seeds_spark)


def _mark_checked_spark(spark, sf):
    ev = _t(spark, sf, "events")
    return registry.mark_checked(I.registry_from_events(ev), I.source_check_rows(ev))


_MARKED_SQL = f"""
(WITH c AS (SELECT target AS _url, checked_at, seq, ok, error FROM {_checks_sql()} WHERE kind = 'source'),
 last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY _url ORDER BY checked_at DESC, seq DESC) AS r FROM c)
          WHERE r = 1),
 agg AS (SELECT _url, max(checked_at) FILTER (WHERE ok) AS last_ok, bool_or(ok) AS any_ok FROM c GROUP BY _url)
 SELECT r.publication_url, r.publication_id, r.publication_name, r.rss_url, r.discovered_from_profile, r.first_seen,
        r.last_seen_on_reads,
        CASE WHEN l._url IS NULL THEN r.last_checked ELSE l.checked_at END AS last_checked,
        CASE WHEN l._url IS NULL THEN r.last_attempted_check ELSE l.checked_at END AS last_attempted_check,
        CASE WHEN l._url IS NULL THEN r.last_successful_check ELSE coalesce(a.last_ok, r.last_successful_check) END
          AS last_successful_check,
        CASE WHEN l._url IS NULL THEN r.monitor_status WHEN l.ok THEN 'ok' ELSE 'error' END AS monitor_status,
        CASE WHEN l._url IS NULL THEN r.monitor_method ELSE 'rss' END AS monitor_method,
        r.expiry_after_days,
        CASE WHEN l._url IS NOT NULL AND a.any_ok THEN true ELSE r.is_active END AS is_active,
        CASE WHEN l._url IS NULL THEN r.last_error_type WHEN l.ok THEN NULL ELSE {S.error_type('l.error')} END
          AS last_error_type,
        CASE WHEN l._url IS NULL THEN r.last_error_message WHEN l.ok THEN NULL ELSE l.error END AS last_error_message,
        CASE WHEN l._url IS NULL THEN r.error_message WHEN l.ok THEN NULL ELSE l.error END AS error_message,
        r.inserted_at, r.seq
 FROM {_reg_sql()} r LEFT JOIN last l ON r.publication_url = l._url LEFT JOIN agg a ON r.publication_url = a._url)"""

register("mark_checked", _reg_out_sql(_MARKED_SQL))(lambda spark, sf: _reg_out(_mark_checked_spark(spark, sf)))

register("health_snapshot", f"""
SELECT publication_name AS name, publication_url AS url, monitor_status,
       {S.ts_text('last_successful_check')} AS last_successful_check,
       {S.ts_text('coalesce(last_attempted_check, last_checked)')} AS last_attempted_check,
       last_error_type, last_error_message
FROM {_MARKED_SQL}""")(
    lambda spark, sf: registry.health_snapshot(_mark_checked_spark(spark, sf)).select(
        "name", "url", "monitor_status", _ts(F.col("last_successful_check")).alias("last_successful_check"),
        _ts(F.col("last_attempted_check")).alias("last_attempted_check"), "last_error_type", "last_error_message"))


def _reads_source_spark(spark, sf):
    rows = health.reads_source_row(I.checks(_t(spark, sf, "events")), "reads.example.com", I.SOURCE_PROFILE)
    return rows.select("run_id", "name", "url", "monitor_status",
                       _ts(F.col("last_successful_check")).alias("last_successful_check"),
                       _ts(F.col("last_attempted_check")).alias("last_attempted_check"),
                       "last_error_type", "last_error_message")


register("reads_source_rows", f"""
WITH c AS (SELECT * FROM {_checks_sql()}),
pre AS (SELECT run_id, CASE WHEN bool_or(kind = 'dns' AND NOT ok) THEN 'preflight_dns'
                            WHEN bool_or(kind = 'http' AND NOT ok) THEN 'preflight_http' END AS stage,
               min(checked_at) AS started FROM c GROUP BY run_id),
dns AS (SELECT run_id, arg_min(error, seq) AS err FROM c
        WHERE kind = 'dns' AND NOT ok AND contains(target, 'reads.example.com') GROUP BY run_id),
http AS (SELECT run_id, arg_min(status_code, seq) AS code, arg_min(coalesce(error, '~'), seq) AS err FROM c
         WHERE kind = 'http' AND NOT ok AND contains(target, 'reads.example.com') GROUP BY run_id)
SELECT pre.run_id, 'Reads profile' AS name, '{I.SOURCE_PROFILE}' AS url,
       CASE WHEN stage IS NULL THEN 'ok' ELSE 'error' END AS monitor_status,
       CASE WHEN stage IS NULL THEN {S.ts_text('started')} END AS last_successful_check,
       {S.ts_text('started')} AS last_attempted_check,
       CASE WHEN stage = 'preflight_dns' THEN 'dns_failure'
            WHEN stage = 'preflight_http' THEN CASE WHEN http.code = 403 THEN 'http_403' ELSE 'http_failure' END END
         AS last_error_type,
       CASE WHEN stage = 'preflight_dns' THEN dns.err
            WHEN stage = 'preflight_http' THEN coalesce(nullif(http.err, '~'),
                 CASE WHEN http.run_id IS NOT NULL THEN 'HTTP ' || CAST(http.code AS VARCHAR) END) END AS last_error_message
FROM pre LEFT JOIN dns ON pre.run_id = dns.run_id LEFT JOIN http ON pre.run_id = http.run_id""")(_reads_source_spark)


# --- D7 / F2: monitoring with feed -> home page fallback

HOME_ERROR = "403 Client Error: Forbidden"


def _monitor_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    feeds = I.feeds(pages)
    items, status = extract.parse_feeds(feeds, 5, I.RUN_ISO)
    homes = I.homepages(pages)
    home_items = extract.homepage_posts(homes, 5, I.RUN_ISO)
    # Every other home page can't be fetched; where the feed is malformed, too, monitoring fails.
    home_ok = F.substring_index("publication_url", "/", -1).cast("long") % 2 == 1
    home_status = homes.select("publication_url", home_ok.alias("home_ok"), F.when(~home_ok, F.lit(HOME_ERROR)).alias("home_error"))
    return registry.recent_posts(feeds.select("publication_url", "seq"), items.drop("seq"), status, home_items,
                                 home_status)


register("recent_posts", f"""
SELECT source_url, pos, article_url, title_hint, discovered_via FROM {_FEED_ITEMS_SQL}
UNION ALL
SELECT {_PUB_URL}, CAST(3 * rk AS INTEGER), 'https://' || host || '/p/post-' || CAST(page_id AS VARCHAR),
       'Post ' || CAST(page_id AS VARCHAR), 'publication_html'
FROM {_RANKED} WHERE rk < 5 AND {_BROKEN} AND chunk % 2 = 1""")(
    lambda spark, sf: _monitor_spark(spark, sf)[0].select("source_url", "pos", "article_url", "title_hint",
                                                          "discovered_via"))

register("monitor_results", f"""
SELECT DISTINCT {_PUB_URL} AS publication_url, NOT ({_BROKEN} AND chunk % 2 = 0) AS success,
       CASE WHEN {_BROKEN} THEN 'html_fallback' ELSE 'rss' END AS monitor_method,
       CASE WHEN {_BROKEN} AND chunk % 2 = 0 THEN '{HOME_ERROR}' END AS error_message
FROM {_RANKED}""")(
    lambda spark, sf: _monitor_spark(spark, sf)[1].select("publication_url", "success", "monitor_method",
                                                          "error_message"))

_ALL_FEED_ITEMS_SQL = _FEED_ITEMS_SQL.replace("rk < 5", "rk < 50")


def _top_posts_spark(spark, sf):
    """F2 by publication name: all chunks of a host are one publication, hot ones included."""
    items = extract.parse_feeds(I.feeds(_t(spark, sf, "pages")), 50, I.RUN_ISO)[0]
    top = state.top_posts(items.withColumn("place", F.struct("seq", "pos")), 3, group_col="source_label", order_col="place")
    return top.select("source_label", "seq", "pos", "article_url")


register("top_posts", f"""
SELECT source_label, seq, pos, article_url FROM (
  SELECT *, row_number() OVER (PARTITION BY source_label ORDER BY seq, pos) AS r FROM {_ALL_FEED_ITEMS_SQL}) WHERE r <= 3""")(_top_posts_spark)


# ============================================================ H / E: outputs and health

PAGE_SEQ_OFFSET = 10 ** 12


def _batch_articles(spark, sf):
    """Canonical rows of documents (run date = published day, summaries from
    responses) and of pages (run date = the run, some failed; ``seq`` moved
    past the documents)."""
    docs = summarize.summarize(I.doc_articles(_t(spark, sf, "documents")),
                               I.responses(_t(spark, sf, "conversations")), key="seq", created_at=I.RUN_ISO)
    doc_rows = extract.build_canonical(docs, I.SOURCE_PROFILE, I.RUN_DATE).withColumn(
        "run_date", F.substring("published_at", 1, 10))
    page_rows = _page_canonical_rows(spark, sf).withColumn("seq", F.col("seq") + F.lit(PAGE_SEQ_OFFSET))
    return doc_rows.unionByName(page_rows)


_DOC_RESP = (f"(SELECT a.*, {S.strip('r.output_text')} AS _resp FROM {_doc_articles_sql()} a "
             f"LEFT JOIN {_RESP_SQL} r ON a.seq = r.conv_id)")
_BATCH_SQL = f"""
(SELECT * REPLACE (substring(published_at, 1, 10) AS run_date) FROM {_canonical_ok_sql(_DOC_RESP, '_resp')}
 UNION ALL
 SELECT * REPLACE (seq + {PAGE_SEQ_OFFSET} AS seq) FROM {_CANON_ROWS_SQL})"""

register("digest", f"""
SELECT article_id, title, canonical_url, publication, published_at, summary_short,
       {S.arr_text('summary_bullets')} AS summary_bullets, key_takeaway, processing_status, 'current' AS data_freshness
FROM {_BATCH_SQL} WHERE processing_status IN ('completed', 'partial')""")(
    lambda spark, sf: outputs.digest(fl.with_freshness(outputs.publishable(_batch_articles(spark, sf)), "current"))
    .withColumn("summary_bullets", _arr(F.col("summary_bullets"))))

register("dashboard_feed", f"""
SELECT article_id AS id, title, canonical_url AS url, publication, author, summary_short AS summary, summary_status,
       scraped_at, processing_status, {S.arr_text('topic_tags')} AS topic_tags, 'current' AS data_freshness
FROM {_BATCH_SQL}""")(
    lambda spark, sf: outputs.dashboard_feed(fl.with_freshness(_batch_articles(spark, sf), "current"))
    .withColumn("topic_tags", _arr(F.col("topic_tags"))))

register("daily_batch_header", f"""
SELECT '1.0' AS schema_version, run_date AS run_id, run_date, '{I.SOURCE_PROFILE}' AS source_profile,
       '{I.RUN_ISO}' AS generated_at, count(*) AS article_count,
       CASE WHEN bool_or(processing_status = 'failed_extraction') THEN 'completed_with_errors' ELSE 'completed' END
         AS status
FROM {_BATCH_SQL} GROUP BY run_date""")(
    lambda spark, sf: outputs.daily_batch_header(_batch_articles(spark, sf), None, I.SOURCE_PROFILE, I.RUN_ISO))

register("article_count", f"SELECT run_date, count(*) AS article_count FROM {_BATCH_SQL} GROUP BY run_date")(
    lambda spark, sf: outputs.article_count(_batch_articles(spark, sf)))


def _markdown_spark(spark, sf):
    runs = _t(spark, sf, "events").select(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd").alias("run_date"))
    return outputs.markdown_blocks(_batch_articles(spark, sf), runs.distinct()).select(*outputs.MARKDOWN_COLUMNS)


def _md_block_sql() -> str:
    title = f"coalesce({S.nclean("coalesce(title, '')")}, 'Untitled Article')"
    link = "coalesce(nullif(canonical_url, ''), nullif(article_url, ''), '#')"
    summary = f"coalesce({S.nclean("coalesce(summary_short, '')")}, 'No summary available.')"
    b1, b2, b3 = S.v(), S.v(), S.v()
    blts = (f"list_filter(list_transform(coalesce(summary_bullets, []::VARCHAR[]), lambda {b1}: {S.clean(b1)}), "
            f"lambda {b2}: {b2} <> '')")
    bl = S.let(blts, lambda x: f"CASE WHEN len({x}) > 0 THEN [''] || list_transform({x}, lambda {b3}: '- ' || {b3}) "
                               f"ELSE []::VARCHAR[] END")
    kt = S.let(S.clean("coalesce(key_takeaway, '')"),
               lambda k: f"CASE WHEN {k} <> '' THEN ['', '**Key takeaway:** ' || {k}] ELSE []::VARCHAR[] END")
    return f"array_to_string(['', '### [' || {title} || '](' || {link} || ')', '', {summary}] || {bl} || {kt}, chr(10))"


def _markdown_sql(batch: str, more_runs: str = "", intro: str = "") -> str:
    intro_sql = f" || chr(10) || chr(10) || {S.q(intro)}" if intro else ""
    return f"""
WITH g0 AS (SELECT *, coalesce({S.nclean("coalesce(publication, '')")}, 'Unknown Publication') AS group_name
            FROM {batch} WHERE processing_status IN ('completed', 'partial')),
grp AS (SELECT run_date, group_name, min(seq) AS group_seq FROM g0 GROUP BY run_date, group_name),
fst AS (SELECT run_date, min(struct_pack(l := lower(group_name), s := group_seq)) AS f FROM grp GROUP BY run_date),
grp2 AS (SELECT grp.*, (lower(grp.group_name) = fst.f.l AND grp.group_seq = fst.f.s) AS group_first
         FROM grp JOIN fst ON grp.run_date = fst.run_date),
art AS (SELECT g0.*, grp2.group_seq, grp2.group_first FROM g0 JOIN grp2
        ON g0.run_date = grp2.run_date AND g0.group_name = grp2.group_name),
runs AS (SELECT DISTINCT run_date FROM art {more_runs})
SELECT run_date, 0 AS section, '' AS group_lower, 0::BIGINT AS group_seq, 0 AS row_kind, '' AS sort_published,
       '' AS sort_scraped, 0::BIGINT AS seq, '# Daily Digest - ' || run_date{intro_sql} AS text FROM runs
UNION ALL
SELECT run_date, 1, '', 0::BIGINT, 0, '', '', 0::BIGINT,
       chr(10) || 'No completed or partial articles were available for this run.'
FROM runs WHERE run_date NOT IN (SELECT run_date FROM art)
UNION ALL
SELECT run_date, 1, lower(group_name), group_seq, 0, '', '', 0::BIGINT,
       CASE WHEN group_first THEN chr(10) ELSE chr(10) || chr(10) END || '## ' || group_name FROM grp2
UNION ALL
SELECT run_date, 1, lower(group_name), group_seq, 1, coalesce(nullif(published_at, ''), ''),
       coalesce(nullif(scraped_at, ''), ''), seq, {_md_block_sql()} FROM art"""


register("markdown_digest", _markdown_sql(_BATCH_SQL, "UNION SELECT DISTINCT strftime(ts, '%Y-%m-%d') FROM events"))(_markdown_spark)


def _rendered_spark(spark, sf):
    """K3: the batches of all run dates written as files (H1), validated, read back (A5) and rendered."""
    from ..plans.jobs import render_digest
    from ..session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/render-{uuid.uuid4().hex[:8]}"
    arts = cut_lineage(_batch_articles(spark, sf))  # for the header and the articles
    io.write_daily_batch(outputs.daily_batch_header(arts, None, I.SOURCE_PROFILE, I.RUN_ISO), arts, f"{base}/batch")
    return render_digest(spark, f"{base}/batch", f"{base}/digest").select(*outputs.MARKDOWN_COLUMNS)


register("rendered_digest", _markdown_sql(f"(SELECT * FROM {_BATCH_SQL})", intro=outputs.DEFAULT_INTRO))(_rendered_spark)

def _manifest_spark(spark, sf):
    """A run per published day: English documents count as direct links, the
    first document of each URL is selected, blank ones fail, and documents
    known by hash or URL are dropped after the fetch."""
    docs = _t(spark, sf, "documents")
    arts = I.doc_articles(docs).withColumn("run_date", F.substring("published_at", 1, 10))
    direct = arts.where(F.col("lang") == "en").select("run_date")
    selected = dedupe.first_by_key(arts.select("run_date", "canonical_url", "seq", "content_hash", "fetch_status"),
                                   ["run_date", "canonical_url"], ["seq"])
    fetched = selected.where(F.col("fetch_status") == "fetched")
    kept = dedupe.filter_unseen(fetched, I.doc_seen(docs))
    failed = selected.where(F.col("fetch_status") != "fetched")
    return health.run_manifest(direct, selected, fetched, kept, failed, by="run_date")


_MANIFEST_SQL = f"""
(WITH a AS (SELECT *, substring(published_at, 1, 10) AS run_date FROM {_doc_articles_sql()}),
sel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_date, canonical_url ORDER BY seq) AS r FROM a) WHERE r = 1),
kept AS (SELECT * FROM sel WHERE body_text <> ''
         AND canonical_url NOT IN (SELECT canonical_url FROM a WHERE lang = 'es')
         AND content_hash NOT IN (SELECT content_hash FROM a WHERE lang IN ('es', 'de')))
SELECT run_date,
       (SELECT count(*) FROM a WHERE a.run_date = d.run_date AND lang = 'en') AS reads_discovered,
       (SELECT count(*) FROM sel WHERE sel.run_date = d.run_date) AS articles_selected,
       (SELECT count(*) FROM sel WHERE sel.run_date = d.run_date AND body_text <> '') AS articles_fetched,
       (SELECT count(*) FROM kept WHERE kept.run_date = d.run_date) AS summaries_created,
       (SELECT count(*) FROM sel WHERE sel.run_date = d.run_date AND body_text = '') AS error_count,
       CASE WHEN (SELECT count(*) FROM sel WHERE sel.run_date = d.run_date AND body_text = '') > 0
            THEN 'completed_with_errors' ELSE 'completed' END AS status
FROM (SELECT DISTINCT run_date FROM a) d)"""

register("run_manifest", f"SELECT * FROM {_MANIFEST_SQL}")(_manifest_spark)

register("check_counts", f"""
SELECT run_id, count(*) AS source_checks_attempted, count(*) FILTER (WHERE ok) AS source_checks_succeeded,
       count(*) FILTER (WHERE NOT ok) AS source_checks_failed
FROM {_checks_sql()} WHERE kind = 'source' GROUP BY run_id""")(
    lambda spark, sf: health.check_counts(I.checks(_t(spark, sf, "events"))))

_PRE_SQL = f"""
(SELECT run_id, CASE WHEN stage IS NULL THEN 'ok' ELSE 'degraded' END AS core_status, stage AS failure_stage FROM (
   SELECT run_id, CASE WHEN bool_or(kind = 'dns' AND NOT ok) THEN 'preflight_dns'
                       WHEN bool_or(kind = 'http' AND NOT ok) THEN 'preflight_http' END AS stage
   FROM {_checks_sql()} GROUP BY run_id))"""

register("preflight_status", f"SELECT * FROM {_PRE_SQL}")(
    lambda spark, sf: health.preflight_status(I.checks(_t(spark, sf, "events"))))

# Runs that an unexpected error ended: those with a check of such a number.
CRASH_EVERY = 3331

_RUN_HEALTH_SQL = f"""
(SELECT p.run_id,
        CASE WHEN x.run_id IS NOT NULL THEN 'failed'
             WHEN p.core_status = 'degraded' OR coalesce(c.ok_n, 0) = 0 THEN 'degraded' ELSE 'healthy' END AS run_status,
        CASE WHEN x.run_id IS NOT NULL THEN 'internal' WHEN p.core_status = 'degraded' THEN p.failure_stage
             WHEN coalesce(c.ok_n, 0) = 0 THEN 'discovery' END AS failure_stage,
        CASE WHEN p.core_status = 'degraded' THEN 0 ELSE coalesce(c.n, 0) END AS source_checks_attempted,
        CASE WHEN p.core_status = 'degraded' THEN 0 ELSE coalesce(c.ok_n, 0) END AS source_checks_succeeded,
        CASE WHEN p.core_status = 'degraded' THEN 0 ELSE coalesce(c.bad_n, 0) END AS source_checks_failed,
        CASE WHEN p.failure_stage = 'preflight_dns' THEN 'DNS resolution failed for required external domains.'
             WHEN p.core_status = 'degraded' THEN 'Preflight checks failed.'
             WHEN x.run_id IS NULL AND coalesce(c.ok_n, 0) = 0 THEN 'No sources could be checked successfully.' ELSE '' END AS warnings
 FROM {_PRE_SQL} p LEFT JOIN (
   SELECT run_id, count(*) AS n, count(*) FILTER (WHERE ok) AS ok_n, count(*) FILTER (WHERE NOT ok) AS bad_n
   FROM {_checks_sql()} WHERE kind = 'source' GROUP BY run_id) c ON p.run_id = c.run_id
 LEFT JOIN (SELECT DISTINCT run_id FROM {_checks_sql()} WHERE seq % {CRASH_EVERY} = 0) x ON p.run_id = x.run_id)"""


def _run_health_spark(spark, sf):
    checks = I.checks(_t(spark, sf, "events"))
    crashed = checks.where(F.col("seq") % CRASH_EVERY == 0).select("run_id", F.lit("ValueError").alias("error"))
    return health.run_status(checks, internal=crashed).withColumn("warnings", _arr(F.col("warnings")))


register("run_health", f"SELECT * FROM {_RUN_HEALTH_SQL}")(_run_health_spark)


def _display_runs(spark, sf):
    chk = I.checks(_t(spark, sf, "events")).withColumn("run_id", F.date_format("checked_at", "yyyy-MM-dd"))
    st = health.run_status(chk).join(chk.groupBy("run_id").agg(F.min("checked_at").alias("started_at")), "run_id")
    return st.select("run_id", "run_status", "started_at", F.lit(I.SOURCE_PROFILE).alias("source_profile"))


def _display_choice_spark(spark, sf):
    counts = _batch_articles(spark, sf).groupBy(F.col("run_date").alias("run_id")).agg(F.count(F.lit(1)).alias("article_count"))
    choice = health.display_choice(_display_runs(spark, sf), counts)
    return choice.select(F.col("run_id").alias("shown_for_run"), "run_status", "article_count", "display_run_id",
                         "data_freshness", "banner_message", "promoted")


def _display_spark(spark, sf):
    """Rows of the latest run of each kind: healthy or degraded, with rows of its own or without."""
    arts = _batch_articles(spark, sf).withColumn("run_id", F.col("run_date"))
    runs = _display_runs(spark, sf)
    counts = arts.groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))
    latest = runs.join(counts, "run_id", "left").groupBy("run_status", F.col("n").isNull().alias("empty")).agg(
        F.max(F.struct("started_at", "run_id")).alias("l")).select("l.run_id")
    shown = health.display_payload(runs, arts, shown=latest)
    return shown.select("shown_for_run", "run_status", "display_run_id", "data_freshness", "banner_message",
                        "article_id", "seq")


_DISPLAY_SQL = f"""
WITH chk AS (SELECT * REPLACE (strftime(checked_at, '%Y-%m-%d') AS run_id) FROM {_checks_sql()}),
pre AS (SELECT run_id, bool_or(kind IN ('dns', 'http') AND NOT ok) AS pre_bad,
               count(*) FILTER (WHERE kind = 'source' AND ok) AS ok_n, min(checked_at) AS started_at
        FROM chk GROUP BY run_id),
runs AS (SELECT run_id, CASE WHEN pre_bad OR ok_n = 0 THEN 'degraded' ELSE 'healthy' END AS run_status, started_at
         FROM pre),
arts AS (SELECT *, run_date AS run_id FROM {_BATCH_SQL}),
cnt AS (SELECT run_id, count(*) AS n FROM arts GROUP BY run_id),
ch AS (SELECT r.*, coalesce(c.n, 0) AS article_count,
              last_value(CASE WHEN r.run_status = 'healthy' THEN r.run_id END IGNORE NULLS)
                OVER (ORDER BY r.started_at, r.run_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_healthy
       FROM runs r LEFT JOIN cnt c ON r.run_id = c.run_id),
disp AS (SELECT run_id AS shown_for_run, run_status, article_count,
                CASE WHEN run_status = 'degraded' AND article_count = 0 THEN last_healthy ELSE run_id END
                  AS display_run_id,
                CASE WHEN run_status = 'degraded' AND article_count = 0 THEN 'last_successful_fallback'
                     ELSE 'current' END AS data_freshness,
                CASE WHEN run_status = 'degraded' AND article_count = 0
                     THEN 'Current monitoring run degraded. Displaying last successful dataset.' END AS banner_message,
                run_status = 'healthy' AS promoted, started_at
         FROM ch)"""

register("display_choice", f"""{_DISPLAY_SQL}
SELECT shown_for_run, run_status, article_count, display_run_id, data_freshness, banner_message, promoted
FROM disp""")(_display_choice_spark)

register("display_payload", f"""{_DISPLAY_SQL}
SELECT d.shown_for_run, d.run_status, d.display_run_id, d.data_freshness, d.banner_message, a.article_id, a.seq
FROM disp d JOIN arts a ON d.display_run_id = a.run_id
WHERE (d.started_at, d.shown_for_run) IN (
  SELECT max((started_at, shown_for_run)) FROM disp GROUP BY run_status, article_count > 0)""")(_display_spark)


# ============================================================ G5-G7: state

def _remember_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    seen = state.remember(I.page_seen(pages), I.page_articles(pages))
    return seen.select("canonical_url", "article_id", "content_hash", _ts(F.col("first_seen")).alias("first_seen"),
                       _ts(F.col("last_seen")).alias("last_seen"))


register("remember_seen", f"""
WITH a AS (SELECT * FROM {_page_articles_sql()}),
old AS (SELECT canonical_url, article_id, content_hash FROM {_page_articles_sql("WHERE starts_with(url, 'http://')")}),
new AS (SELECT canonical_url, arg_max(article_id, seq) AS article_id, arg_max(content_hash, seq) AS content_hash
        FROM a GROUP BY canonical_url)
SELECT coalesce(o.canonical_url, n.canonical_url) AS canonical_url,
       CASE WHEN n.canonical_url IS NOT NULL THEN n.article_id ELSE o.article_id END AS article_id,
       CASE WHEN n.canonical_url IS NOT NULL THEN n.content_hash ELSE o.content_hash END AS content_hash,
       CASE WHEN o.canonical_url IS NOT NULL THEN '{I.PRIOR_TS}' ELSE '2024-01-31 06:00:00' END AS first_seen,
       CASE WHEN n.canonical_url IS NOT NULL THEN '2024-01-31 06:00:00' ELSE '{I.PRIOR_TS}' END AS last_seen
FROM old o FULL OUTER JOIN new n ON o.canonical_url = n.canonical_url""")(_remember_spark)


_INDEX_ARRAYS = ("summary_bullets", "topic_tags")
_INDEX_COLUMNS = [*extract.CANONICAL_COLUMNS, "seq"]


def _merge_index_spark(spark, sf):
    """All 23 columns of the document and the page rows; the arrays as text."""
    rows = cut_lineage(_batch_articles(spark, sf).select(*_INDEX_COLUMNS))  # both halves read it
    old = rows.where(F.col("run_date") < "2024-01-15").withColumn("first_run_date", F.col("run_date")) \
        .withColumn("first_seq", F.col("seq"))
    new = rows.where(F.col("run_date") >= "2024-01-10")
    out = state.merge_index(old, new, I.RUN_DATE)
    return out.select(*[_arr(F.col(c)).alias(c) if c in _INDEX_ARRAYS else F.col(c) for c in out.columns])


_INDEX_SQL_COLUMNS = ", ".join(f"{S.arr_text('l.' + c)} AS {c}" if c in _INDEX_ARRAYS else f"l.{c}" for c in _INDEX_COLUMNS)

register("merge_index", f"""
WITH rows AS (SELECT * FROM {_BATCH_SQL}),
u AS (SELECT *, 0 AS v, run_date AS first_run_date, seq AS first_seq FROM rows WHERE run_date < '2024-01-15'
      UNION ALL SELECT *, 1, '{I.RUN_DATE}', seq FROM rows WHERE run_date >= '2024-01-10'),
last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY v DESC, seq DESC) AS r FROM u)
         WHERE r = 1),
pos AS (SELECT article_id, min(struct_pack(d := first_run_date, s := first_seq)) AS p FROM u GROUP BY article_id)
SELECT {_INDEX_SQL_COLUMNS}, pos.p.d AS first_run_date, pos.p.s AS first_seq
FROM last l JOIN pos ON l.article_id = pos.article_id""")(_merge_index_spark)


def _checkpoints_spark(spark, sf):
    man = _manifest_spark(spark, sf)
    return state.checkpoints(man.withColumn("dry_run", F.col("run_date") > "2024-01-27"))


register("checkpoints", f"""
SELECT max(run_date) AS last_successful_run_date, max(run_date) AS last_reads_scrape_date
FROM {_MANIFEST_SQL} WHERE NOT (run_date > '2024-01-27')""")(_checkpoints_spark)


def _blocked_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    listing = I.listing_pages(pages)
    raw = pages.select((F.col("page_id") + F.lit(PAGE_SEQ_OFFSET)).alias("page_id"), "url", "html")
    return health.discovery_blocked(listing.select("page_id", "url", "html").unionByName(raw))


register("discovery_blocked", f"""
SELECT DISTINCT first_id AS seq, false AS snapshot_taken, false AS discovery_blocked FROM {_RANKED}
UNION ALL
SELECT page_id + {PAGE_SEQ_OFFSET}, true, true FROM pages""")(_blocked_spark)


# ============================================================ L1: streaming

def _incremental_spark(spark, sf):
    from ..session import ensure_checkpoint_dir
    from ..streaming.incremental import incremental_urls
    base = ensure_checkpoint_dir(spark)
    run = f"{base}/incremental-urls-{uuid.uuid4().hex[:8]}"
    # As a glob, the table may be one file or a folder of part files: a stream takes a plain path only as a folder.
    q = incremental_urls(spark, f"{sf}/{{pages.parquet}}", f"{run}/checkpoint", f"{run}/out")
    q.awaitTermination()
    return spark.read.parquet(f"{run}/out").select("canonical_url")


register("incremental_urls", f"SELECT DISTINCT {S.normalize_url('url')} AS canonical_url FROM pages")(
    _incremental_spark)


# ============================================================ flagship: pages -> digest

def _flagship_digest_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    arts = dedupe.dedupe_first(I.page_articles(pages), seen=I.page_seen(pages))
    summ = summarize.summarize(arts, created_at=I.RUN_ISO)
    canon = extract.build_canonical(summ, I.SOURCE_PROFILE, I.RUN_DATE)
    return outputs.digest(fl.with_freshness(outputs.publishable(canon), "current")).withColumn(
        "summary_bullets", _arr(F.col("summary_bullets")))


register("flagship_digest", f"""
WITH RECURSIVE seen AS (SELECT canonical_url, content_hash
                        FROM {_page_articles_sql("WHERE starts_with(url, 'http://')")}),
a AS (SELECT * FROM {_page_articles_sql()}
      WHERE canonical_url NOT IN (SELECT canonical_url FROM seen)
        AND content_hash NOT IN (SELECT content_hash FROM seen)),
d AS (SELECT seq, canonical_url AS u, content_hash AS h, row_number() OVER (ORDER BY seq) AS rn FROM a),
walk(rn, seq, kept, urls, hashes) AS (
  SELECT 0::BIGINT, NULL::BIGINT, false, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT d.rn, d.seq, NOT (list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h)),
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.urls ELSE list_append(w.urls, d.u) END,
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.hashes
              ELSE list_append(w.hashes, d.h) END
  FROM walk w JOIN d ON d.rn = w.rn + 1),
k AS (SELECT * FROM a WHERE seq IN (SELECT seq FROM walk WHERE kept)),
c AS (SELECT * FROM {_canonical_ok_sql('k')})
SELECT article_id, title, canonical_url, publication, published_at, summary_short,
       {S.arr_text('summary_bullets')} AS summary_bullets, key_takeaway, processing_status, 'current' AS data_freshness
FROM c WHERE processing_status IN ('completed', 'partial')""")(_flagship_digest_spark)


# ============================================================ C2 general path (parser)

register("page_body_parsed", f"""
SELECT page_id, coalesce({S.nclean(S.body_text(S.strip_non_text('html')))}, '') AS body_text FROM pages""")(
    lambda spark, sf: extract.extract_body(_t(spark, sf, "pages").select("page_id", "html"), method="parser")
    .select("page_id", F.coalesce(fl.normalize_text("body_text"), F.lit("")).alias("body_text")))


# ============================================================ K1: one daily run (rows-only check)

def _run_inputs(spark, sf):
    pages = _t(spark, sf, "pages")
    fetched = pages.select(fl.normalize_url("url").alias("url"), "html", F.lit(None).cast("string").alias("error"), "page_id")
    fetched = dedupe.first_by_key(fetched, ["url"], ["page_id"]).drop("page_id")
    return pages, fetched


_CANON_SCALARS = [c for c in extract.CANONICAL_COLUMNS if c not in ("summary_bullets", "topic_tags")]


def _canonical_out(df):
    return df.select(*_CANON_SCALARS, F.to_json("seq").alias("run_order"), _arr(F.col("summary_bullets")).alias("summary_bullets"))


def _feed_registry(spark, sf, pages):
    feeds = I.feeds(pages)
    first_seen = F.timestamp_seconds(F.lit(I.EPOCH_2024) + F.col("seq") * 3600)
    return feeds, registry.with_registry_defaults(feeds.select(
        "publication_url", F.col("publication_name"), F.lit(I.SOURCE_PROFILE).alias("discovered_from_profile"),
        first_seen.alias("first_seen"), first_seen.alias("last_seen_on_reads"), first_seen.alias("inserted_at"),
        "seq", fl.short_id("publication_url").alias("publication_id"),
        fl.default_feed_url("publication_url").alias("rss_url")))


def _run_config(mode, run_ts=I.RUN_TS):
    from ..plans.jobs import RunConfig
    return RunConfig(run_ts=run_ts, source_profile=I.SOURCE_PROFILE, discovery_mode=mode,
                     article_fetch_limit=None, max_publications_per_run=None)


def _daily_run_spark(spark, sf):
    """K1 over derived inputs: registry = one publication per feed, monitored
    by feed (home page on malformed feeds); every selected item is fetched
    from ``pages`` (first page per normalised URL); limits set so the whole
    input is processed."""
    from ..plans.jobs import run_daily
    pages, fetched = _run_inputs(spark, sf)
    feeds, reg = _feed_registry(spark, sf, pages)
    out = run_daily(spark, _run_config("registry_only"), reads_pages=None, fetched=fetched, feeds=feeds,
                    homepages=I.homepages(pages), responses=None, reg=reg, seen=I.page_seen(pages))
    return _canonical_out(out["canonical"])


def _daily_run_live_spark(spark, sf):
    """K1 in live_reads mode: the listing pages' direct links; the authors
    found there have no feed or home page, so monitoring them yields nothing."""
    from ..plans.jobs import run_daily
    pages, fetched = _run_inputs(spark, sf)
    out = run_daily(spark, _run_config("live_reads"), reads_pages=I.listing_pages(pages).select("page_id", "url", "html"),
                    fetched=fetched, feeds=I.feeds(pages), homepages=None, responses=None,
                    reg=registry.empty_registry(spark), seen=I.page_seen(pages))
    return _canonical_out(out["canonical"])


def _daily_run_seeded_spark(spark, sf):
    """K1 in manual_seed mode: an empty registry is filled from a seed list of all feeds' publications."""
    from ..plans.jobs import run_daily
    pages, fetched = _run_inputs(spark, sf)
    feeds = I.feeds(pages)
    none = F.lit(None).cast("string")
    seeds = feeds.select("seq", "publication_url", none.alias("url"), "publication_name", none.alias("name"), none.alias("rss_url"),
                         none.alias("discovered_from_profile"))
    out = run_daily(spark, _run_config("manual_seed"), reads_pages=None, fetched=fetched, feeds=feeds, homepages=I.homepages(pages),
                    responses=None, reg=registry.empty_registry(spark), seen=I.page_seen(pages), seeds=seeds)
    return _canonical_out(out["canonical"])


def _displayed_spark(spark, sf):
    """K4 twice: a healthy run is persisted and published; the next day's
    preflight fails, and what consumers are shown is the first day's dataset."""
    from ..plans import jobs
    from ..session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/display-{uuid.uuid4().hex[:8]}"
    pages, fetched = _run_inputs(spark, sf)
    feeds, reg = _feed_registry(spark, sf, pages)
    inputs = dict(reads_pages=None, fetched=fetched, feeds=feeds, homepages=I.homepages(pages), responses=None)
    check = spark.range(1).select(F.col("id").alias("seq"), F.lit("dns").alias("kind"), F.lit("reads.example.com").alias("target"),
                                  F.lit(True).alias("ok"), F.lit(None).cast("int").alias("status_code"), F.lit(None).cast("string").alias("error"))
    jobs.run_with_health(spark, _run_config("registry_only"), check, base=base, reg=reg, seen=I.page_seen(pages), **inputs)
    next_day = _run_config("registry_only", "2024-02-01 06:00:00")
    out = jobs.run_with_health(spark, next_day, check.withColumn("ok", F.lit(False)), base=base, **inputs)
    status = out["run_status"].first()  # the run's one status row
    return out["displayed"].select("article_id", "canonical_url", "processing_status", "title", "run_date", "data_freshness", "banner_message",
                                   F.lit(status.run_status).alias("run_status"), F.lit(status.failure_stage).alias("failure_stage"))


_MONITORED_ITEMS = f"""
      (SELECT seq, pos, source_url, article_url, title_hint, source_label, discovered_via FROM {_FEED_ITEMS_SQL}
       UNION ALL
       SELECT first_id, CAST(3 * rk AS INTEGER), {_PUB_URL}, 'https://' || host || '/p/post-' || CAST(page_id AS VARCHAR),
              'Post ' || CAST(page_id AS VARCHAR), host, 'publication_html'
       FROM {_RANKED} WHERE rk < 5 AND {_BROKEN})"""


def _daily_run_sql(live: bool = False, seeded: bool = False) -> str:
    if seeded:  # all publications were last seen and inserted by the run itself
        items, rank, order = _MONITORED_ITEMS, "seq, pos", "pub_seq, pos"
        keys = ("1", "'-1706680800000000'", "'1706680800000000'", "CAST(seq AS VARCHAR)")
    elif live:
        items, rank, order = _DIRECT_SQL, "seq, pos", "pub_seq, pos"
        keys = ("0", "CAST(seq AS VARCHAR)", "'0'", "'0'")
    else:
        items, rank, order = _MONITORED_ITEMS, "seq DESC, pos", "pub_seq DESC, pos"
        keys = ("1", "CAST((-((1704067200 + seq * 3600) * 1000000)) AS VARCHAR)", "CAST(((1704067200 + seq * 3600) * 1000000) AS VARCHAR)",
                "CAST(seq AS VARCHAR)")
    seen_sql = _page_articles_sql("WHERE starts_with(url, 'http://')")
    return f"""
WITH RECURSIVE it AS (
  SELECT *, {S.normalize_url('article_url')} AS cu,
         '{{"source_rank":{keys[0]},"k1":' || {keys[1]} || ',"k2":' || {keys[2]} || ',"k3":'
           || {keys[3]} || ',"pos":' || CAST(pos AS VARCHAR) || '}}' AS run_order
  FROM {items}),
first_it AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cu ORDER BY {rank}) AS r0 FROM it)
             WHERE r0 = 1),
seen AS (SELECT canonical_url, content_hash FROM {seen_sql}),
fresh AS (SELECT * FROM first_it WHERE cu NOT IN (SELECT canonical_url FROM seen)),
pg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url ORDER BY seq) AS r2
                      FROM {_page_articles_sql()}) WHERE r2 = 1),
art AS (SELECT f.seq AS pub_seq, f.pos, f.run_order, {S.short_id('f.cu')} AS article_id, f.source_url,
               f.cu AS original_url, f.cu AS canonical_url, coalesce(p.title, f.title_hint) AS title,
               NULL::VARCHAR AS subtitle, NULL::VARCHAR AS author, NULL::VARCHAR AS publication,
               NULL::VARCHAR AS published_at, NULL::VARCHAR AS description, p.body_text, p.content_hash,
               p.fetch_status, '{I.RUN_ISO}' AS fetched_at, []::VARCHAR[] AS topic_tags, f.source_label,
               f.discovered_via
        FROM fresh f JOIN pg p ON f.cu = p.canonical_url
        WHERE p.content_hash NOT IN (SELECT content_hash FROM seen)),
d AS (SELECT run_order, canonical_url AS u, content_hash AS h,
             row_number() OVER (ORDER BY {order}) AS rn FROM art),
walk(rn, run_order, kept, urls, hashes) AS (
  SELECT 0::BIGINT, NULL::VARCHAR, false, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT d.rn, d.run_order, NOT (list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h)),
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.urls ELSE list_append(w.urls, d.u) END,
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.hashes
              ELSE list_append(w.hashes, d.h) END
  FROM walk w JOIN d ON d.rn = w.rn + 1),
k AS (SELECT *, run_order AS seq FROM art WHERE run_order IN (SELECT run_order FROM walk WHERE kept)),
ok AS (SELECT * FROM {_canonical_ok_sql('k')})
SELECT {', '.join(_CANON_SCALARS)},
       seq AS run_order, {S.arr_text('summary_bullets')} AS summary_bullets FROM ok
UNION ALL
SELECT {S.short_id('cu')}, '{I.SOURCE_PROFILE}', source_label, cu, cu, title_hint, NULL, NULL, NULL, NULL, '', NULL,
       NULL, '{I.RUN_ISO}', '{I.RUN_DATE}', 'failed_extraction', 'not_started', NULL, NULL, 'page was not fetched',
       discovered_via, run_order, ''
FROM fresh WHERE cu NOT IN (SELECT canonical_url FROM pg)"""


register("daily_run", _daily_run_sql())(_daily_run_spark)
register("daily_run_seeded", _daily_run_sql(seeded=True))(_daily_run_seeded_spark)
register("daily_run_live", _daily_run_sql(live=True))(_daily_run_live_spark)
register("displayed_after_degraded_run", f"""
SELECT article_id, canonical_url, processing_status, title, run_date, 'last_successful_fallback' AS data_freshness,
       'Current monitoring run degraded. Displaying last successful dataset.' AS banner_message,
       'degraded' AS run_status, 'preflight_dns' AS failure_stage
FROM ({_daily_run_sql()})""")(_displayed_spark)


# ============================================================ L1 in two batches, G8

SPLIT_PAGE = 120


def _stream_arrivals(spark, name, arrivals, **options):
    """Land each arrival and run the stream over it; the state after the last one."""
    from ..session import ensure_checkpoint_dir
    from ..streaming.incremental import incremental_articles
    run = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"
    for part in arrivals:
        part.write.mode("append").parquet(f"{run}/in")
        incremental_articles(spark, f"{run}/in", f"{run}/checkpoint", f"{run}/base", I.RUN_ISO, file_glob="*.parquet", **options).awaitTermination()
    return commits.current(spark, f"{run}/base")


def _incremental_articles_spark(spark, sf):
    """The foreachBatch stream over two arrivals of pages; equal to one pass in page order."""
    pages = _t(spark, sf, "pages").withColumn("error", F.lit(None).cast("string"))
    state_after = _stream_arrivals(spark, "incremental-articles", [
        pages.where(F.col("page_id") < SPLIT_PAGE), pages.where(F.col("page_id") >= SPLIT_PAGE)])
    return state_after.read("articles").select("seq", "article_id", "canonical_url", "title", "content_hash", "summary_status")


register("incremental_articles", f"""
WITH RECURSIVE a AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY canonical_url, seq < {SPLIT_PAGE} ORDER BY seq) AS r
                 FROM {_page_articles_sql()}) WHERE r = 1),
d AS (SELECT seq, canonical_url AS u, content_hash AS h, row_number() OVER (ORDER BY seq) AS rn FROM a),
walk(rn, seq, kept, urls, hashes) AS (
  SELECT 0::BIGINT, NULL::BIGINT, false, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT d.rn, d.seq, NOT (list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h)),
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.urls ELSE list_append(w.urls, d.u) END,
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.hashes
              ELSE list_append(w.hashes, d.h) END
  FROM walk w JOIN d ON d.rn = w.rn + 1)
SELECT seq, article_id, canonical_url, title, content_hash, 'fallback' AS summary_status
FROM a WHERE seq IN (SELECT seq FROM walk WHERE kept)""")(_incremental_articles_spark)


def _incremental_retries_spark(spark, sf):
    """Three arrivals: fetches of URLs with a query or a fragment fail at first; those with a query
    succeed when they are fetched again, of those with a fragment only the https ones, on the third try."""
    pages = _t(spark, sf, "pages")
    query, fragment = F.col("url").contains("?"), F.col("url").contains("#")
    bad = F.when(fragment, F.lit("Read timed out. (read timeout=20)")).when(query, F.lit("403 Client Error: Forbidden"))

    def arrival(rows, error):
        return rows.select("page_id", "url", F.when(error.isNull(), F.col("html")).alias("html"), error.alias("error"))

    secure = F.when(~F.col("url").startswith("https://"), F.lit("Connection reset by peer"))
    after = _stream_arrivals(spark, "incremental-retries", [
        arrival(pages, bad), arrival(pages.where(query | fragment), F.when(fragment, bad)), arrival(pages.where(fragment), secure)])
    articles = after.read("articles").select(
        "seq", "canonical_url", "content_hash", F.lit("article").alias("kind"), F.lit(None).cast("int").alias("attempts"), F.lit(None).cast("string").alias("error"))
    return articles.unionByName(after.read("retry").select(
        F.lit(None).cast("long").alias("seq"), "canonical_url", F.lit(None).cast("string").alias("content_hash"), "kind", "attempts", "error"))


_ARRIVALS_SQL = """
  SELECT 1 AS arrival, page_id, url, CASE WHEN contains(url, '#') THEN 'Read timed out. (read timeout=20)'
         WHEN contains(url, '?') THEN '403 Client Error: Forbidden' END AS error FROM pages
  UNION ALL SELECT 2, page_id, url, CASE WHEN contains(url, '#') THEN 'Read timed out. (read timeout=20)' END FROM pages
  WHERE contains(url, '#') OR contains(url, '?')
  UNION ALL SELECT 3, page_id, url, CASE WHEN NOT starts_with(url, 'https://') THEN 'Connection reset by peer' END FROM pages WHERE contains(url, '#')"""

register("incremental_retries", f"""
WITH RECURSIVE arr AS ({_ARRIVALS_SQL}),
pa AS (SELECT * FROM {_page_articles_sql()}),
a AS (SELECT * FROM (SELECT pa.*, arr.arrival, row_number() OVER (PARTITION BY arr.arrival, pa.canonical_url ORDER BY pa.seq) AS r
                     FROM arr JOIN pa ON pa.seq = arr.page_id WHERE arr.error IS NULL) WHERE r = 1),
d AS (SELECT arrival, seq, canonical_url AS u, content_hash AS h, row_number() OVER (ORDER BY arrival, seq) AS rn FROM a),
walk(rn, arrival, seq, kept, urls, hashes) AS (
  SELECT 0::BIGINT, NULL::INTEGER, NULL::BIGINT, false, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT d.rn, d.arrival, d.seq, NOT (list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h)),
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.urls ELSE list_append(w.urls, d.u) END,
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.hashes
              ELSE list_append(w.hashes, d.h) END
  FROM walk w JOIN d ON d.rn = w.rn + 1),
u AS (SELECT arr.*, pa.canonical_url FROM arr JOIN pa ON pa.seq = arr.page_id),
t AS (SELECT canonical_url, arrival, bool_or(error IS NULL) AS settled, count(*) AS failures, arg_max(error, page_id) AS error
      FROM u GROUP BY canonical_url, arrival),
last_ok AS (SELECT canonical_url, max(arrival) FILTER (WHERE settled) AS ok FROM t GROUP BY canonical_url),
q AS (SELECT t.canonical_url, sum(failures)::INTEGER AS attempts, arg_max(error, arrival) AS error
      FROM t JOIN last_ok l ON l.canonical_url = t.canonical_url WHERE l.ok IS NULL OR t.arrival > l.ok GROUP BY t.canonical_url)
SELECT seq, canonical_url, content_hash, 'article' AS kind, NULL::INTEGER AS attempts, NULL::VARCHAR AS error
FROM a WHERE (arrival, seq) IN (SELECT (arrival, seq) FROM walk WHERE kept)
UNION ALL
SELECT NULL, canonical_url, NULL, CASE WHEN attempts < 3 THEN 'retry' ELSE 'given_up' END, attempts, error FROM q""")(_incremental_retries_spark)


def _repeated_run_spark(spark, sf):
    """K1 twice: the first attempt breaks off after all its writes, before its commit; repeated, it gives what an unbroken run gives.

    Read back through the commit: articles of the day, how often the run is in the history, seen-set and index.
    """
    from ..plans import jobs
    from ..session import ensure_checkpoint_dir
    base = f"{ensure_checkpoint_dir(spark)}/repeated-{uuid.uuid4().hex[:8]}"
    cfg = _run_config("registry_only")
    pages, fetched = _run_inputs(spark, sf)
    feeds, reg = _feed_registry(spark, sf, pages)
    first = commits.begin(spark, base, "earlier")
    SeenSet(first, buckets=8).replace(I.page_seen(pages))
    first.write("state/registry", reg)
    first.commit()
    inputs = dict(reads_pages=None, fetched=fetched, feeds=feeds, homepages=I.homepages(pages), responses=None)
    for attempt in range(2):
        tx = commits.begin(spark, base, cfg.state_run_id)
        out = jobs.run_daily(spark, cfg, reg=jobs.load_registry(spark, base, cfg, tx), seen=SeenSet(tx), **inputs)
        jobs.persist_run(spark, cfg, out, base, tx=tx)
        if attempt:
            tx.commit()
    now = commits.current(spark, base)
    runs = now.read("runs/manifests").select(F.lit("run").alias("kind"), F.col("run_id").alias("name"), F.col("summaries_created").cast("string").alias("value"))
    rows = now.read("processed/articles").select(F.col("processing_status").alias("kind"), F.col("canonical_url").alias("name"), F.col("title").alias("value"))
    seen = SeenSet(now).rows().select(F.lit("seen").alias("kind"), F.col("canonical_url").alias("name"), F.col("content_hash").alias("value"))
    index = now.read("processed/index").select(F.lit("index").alias("kind"), F.col("article_id").alias("name"), F.col("first_run_date").alias("value"))
    return runs.unionByName(rows).unionByName(seen).unionByName(index)


register("repeated_run", f"""
WITH r AS ({_daily_run_sql()})
SELECT 'run' AS kind, '{I.RUN_DATE.replace('-', '')}T060000' AS name, CAST(count(*) AS VARCHAR) AS value FROM r WHERE processing_status <> 'failed_extraction'
UNION ALL SELECT processing_status, canonical_url, title FROM r
UNION ALL SELECT 'index', article_id, '{I.RUN_DATE}' FROM r
UNION ALL SELECT 'seen', canonical_url, content_hash FROM r WHERE processing_status <> 'failed_extraction'
UNION ALL SELECT 'seen', canonical_url, content_hash FROM {_page_articles_sql("WHERE starts_with(url, 'http://')")}""")(_repeated_run_spark)


def _registry_defaults_spark(spark, sf):
    """State written before four columns existed, half of it rewritten since with NULLs in them."""
    old = I.registry_from_events(_t(spark, sf, "events"))
    gone = ("monitor_status", "monitor_method", "expiry_after_days", "is_active")
    old = old.withColumns({c: F.when(F.col("seq") % 2 == 0, F.col(c)) for c in gone[:3]}).drop("is_active")
    out = registry.with_registry_defaults(old, 45)
    return out.select("publication_url", "seq", *gone, F.col("last_checked").isNull().alias("never_checked"))


register("registry_defaults", f"""
WITH e AS (SELECT * FROM events),
v AS (SELECT user_id, CAST(floor(min(value)) AS INTEGER) AS expiry FROM e WHERE event_type = 'view' GROUP BY user_id),
x AS (SELECT DISTINCT user_id FROM e WHERE event_type = 'error')
SELECT 'https://pub' || CAST(v.user_id AS VARCHAR) || '.example.com/' AS publication_url, CAST(v.user_id AS BIGINT) AS seq,
       CASE WHEN v.user_id % 2 = 0 AND x.user_id IS NOT NULL THEN 'error' ELSE 'pending' END AS monitor_status,
       'rss' AS monitor_method, CASE WHEN v.user_id % 2 = 0 THEN expiry ELSE 45 END AS expiry_after_days,
       true AS is_active, true AS never_checked
FROM v LEFT JOIN x ON v.user_id = x.user_id""")(_registry_defaults_spark)
