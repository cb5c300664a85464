"""Registered queries: a Spark plan and a DuckDB oracle per operator.

Every query reads the driver tables (or tables Spark derives from them, see
:mod:`feedlake.plans.inputs`) in full.  List columns are returned as text
(``' | '``-joined) and timestamps as ``YYYY-MM-DD HH:MM:SS`` text so both
engines hash them the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fl
from ..operators import dedupe, extract, state, summarize
from . import inputs as I
from . import sqlref as S

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _t(spark, sf, name):
    return I.table(spark, sf, name)


def _arr(c):
    return F.array_join(c, " | ")


def _ts(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


# ============================================================ B: functions

_N = S.normalize_url("url")

register("url_normalize", f"""
SELECT page_id, {_N} AS url_norm, {S.url_host('url')} AS host,
       ({S.url_struct('url')}.s IN ('http', 'https') AND {S.url_struct('url')}.n <> '') AS is_http,
       regexp_replace({_N}, '/+$', '') || '/feed' AS feed_url,
       regexp_replace({_N}, '/+$', '') || '/reads' AS reads_url,
       {S.short_id(_N)} AS url_id
FROM pages""")(
    lambda spark, sf: _t(spark, sf, "pages").select(
        "page_id", fl.normalize_url("url").alias("url_norm"), fl.url_host("url").alias("host"),
        fl.is_http_url("url").alias("is_http"), fl.default_feed_url(fl.normalize_url("url")).alias("feed_url"),
        fl.reads_url(fl.normalize_url("url")).alias("reads_url"), fl.short_id(fl.normalize_url("url")).alias("url_id")))


register("text_clean", f"""
SELECT doc_id, {S.clean('text')} AS cleaned, {S.nclean('text')} IS NULL AS is_blank,
       {S.trim_text('text', 200)} AS trimmed, {S.first_sentences('text', 3)} AS lead,
       sha256({S.clean('text')}) AS body_hash
FROM documents""")(
    lambda spark, sf: _t(spark, sf, "documents").select(
        "doc_id", fl.clean_whitespace("text").alias("cleaned"), fl.normalize_text("text").isNull().alias("is_blank"),
        fl.trim_text("text", 200).alias("trimmed"), fl.first_sentences("text", 3).alias("lead"),
        fl.content_hash(fl.clean_whitespace("text")).alias("body_hash")))


def _doc_articles_sql() -> str:
    url = ("'https://' || source || '.example.com/p/' || lang || '-' || "
           "CAST(CAST(floor(n_chars / 1000) AS BIGINT) AS VARCHAR)")
    fl_ = "split_part(text, chr(10), 1)"
    day = "lpad(CAST(least(28, 1 + CAST(floor(n_chars / 500) AS BIGINT)) AS VARCHAR), 2, '0')"
    body = f"coalesce({S.nclean('text')}, '')"
    return f"""
    (SELECT doc_id AS seq, {S.short_id(url)} AS article_id, 'https://' || source || '.example.com' AS source_url,
            {url} AS original_url, {url} AS canonical_url, {S.nclean(fl_)} AS title, NULL::VARCHAR AS subtitle,
            lang AS author, source AS publication, '2024-01-' || {day} || 'T12:00:00Z' AS published_at,
            NULL::VARCHAR AS description, {body} AS body_text, sha256({body}) AS content_hash,
            CASE WHEN {body} <> '' THEN 'fetched' ELSE 'partial' END AS fetch_status,
            '{I.RUN_ISO}' AS fetched_at, {S.topic_tags(f"replace({fl_}, ' | ', ',')")} AS topic_tags,
            source AS source_label, 'publication_rss' AS discovered_via, lang
     FROM documents)"""


def _summary_sql(src_table: str, resp_col: str | None) -> str:
    """I1 over an article CTE; ``resp_col`` holds the stripped response."""
    src = S.trim_text("body_text", 12000)
    fallback = f"coalesce(nullif({S.first_sentences(src, 3)}, ''), 'No summary available.')"
    if resp_col:
        status = (f"CASE WHEN {resp_col} IS NULL THEN 'fallback' WHEN {resp_col} = '' THEN 'empty_response' "
                  f"ELSE 'completed' END")
    else:
        status = "'fallback'"
    return f"""
    (SELECT *, {S.bullets('summary_short')} AS _b FROM (
      SELECT *, CASE WHEN summary_status = 'completed' THEN {resp_col or 'NULL'} ELSE {fallback} END AS summary_short
      FROM (SELECT *, {status} AS summary_status FROM {src_table})))"""


register("summary_fallback", f"""
SELECT seq, summary_status, summary_short, {S.arr_text('_b')} AS summary_bullets,
       {S.key_takeaway_from('_b', 'summary_short')} AS key_takeaway
FROM {_summary_sql(_doc_articles_sql(), None)}""")(
    lambda spark, sf: summarize.summarize(I.doc_articles(_t(spark, sf, "documents"))).select(
        "seq", "summary_status", "summary_short", _arr(F.col("summary_bullets")).alias("summary_bullets"),
        "key_takeaway"))


_RESP_SQL = ("(SELECT conv_id, arg_max(text, turn) AS output_text FROM conversations "
             "WHERE role = 'assistant' GROUP BY conv_id)")

register("summaries_with_responses", f"""
SELECT seq, summary_status, summary_short, {S.arr_text('_b')} AS summary_bullets,
       {S.key_takeaway_from('_b', 'summary_short')} AS key_takeaway
FROM {_summary_sql(f"(SELECT a.*, {S.strip('r.output_text')} AS _resp FROM {_doc_articles_sql()} a "
                   f"LEFT JOIN {_RESP_SQL} r ON a.seq = r.conv_id)", '_resp')}""")(
    lambda spark, sf: summarize.summarize(
        I.doc_articles(_t(spark, sf, "documents")), I.responses(_t(spark, sf, "conversations")), key="seq").select(
        "seq", "summary_status", "summary_short", _arr(F.col("summary_bullets")).alias("summary_bullets"),
        "key_takeaway"))


register("summary_prompts", f"""
SELECT seq, 'Summarize the following article in a medium format. Return plain text only.' || chr(10) || chr(10)
       || 'Title: ' || coalesce(nullif(title, ''), 'Untitled article') || chr(10) || chr(10) || 'Article:' || chr(10)
       || {S.trim_text('body_text', 12000)} AS prompt
FROM {_doc_articles_sql()}""")(
    lambda spark, sf: summarize.prompts(I.doc_articles(_t(spark, sf, "documents")), key="seq"))


register("topic_tags", f"""
SELECT doc_id, {S.arr_text(S.topic_tags("regexp_replace(text, '[.!?\\n]', ',', 'g')"))} AS tags FROM documents""")(
    lambda spark, sf: _t(spark, sf, "documents").select(
        "doc_id", _arr(fl.topic_tags(F.regexp_replace("text", r"[.!?\n]", ","))).alias("tags")))


def _checks_sql() -> str:
    host = "'pub' || CAST(user_id AS VARCHAR) || '.example.com'"
    msg = (f"CASE WHEN value < 10 THEN 'Failed to resolve ''' || {host} || ''' ([Errno -2] Name or service not known)' "
           f"WHEN value < 20 THEN '403 Client Error: Forbidden for url: https://' || {host} || '/feed' "
           f"WHEN value < 30 THEN 'HTTPSConnectionPool(host=''' || {host} || ''', port=443): Read timed out. (read timeout=20)' "
           f"WHEN value < 40 THEN 'XML parse error: not well-formed (invalid token): line 1, column 0' "
           f"WHEN value < 60 THEN 'HTTPSConnectionPool(host=''' || {host} || ''', port=443): Max retries exceeded with url: /feed' "
           f"WHEN value < 100 THEN 'The read operation timed out' ELSE 'Connection reset by peer' END")
    return f"""
    (SELECT strftime(ts, '%Y%m%d') AS run_id, event_id AS seq, kind,
            CASE WHEN kind = 'source' THEN 'https://pub' || CAST(user_id AS VARCHAR) || '.example.com/'
                 ELSE 'https://reads.example.com/feed' END AS target, ok,
            CAST(CASE WHEN kind = 'http' THEN CASE WHEN value < 400 THEN 200 WHEN value < 450 THEN 503 ELSE 403 END END AS INTEGER)
              AS status_code,
            CASE WHEN ok THEN NULL WHEN kind = 'dns' THEN 'Temporary failure in name resolution'
                 WHEN kind = 'http' THEN NULL ELSE {msg} END AS error,
            ts AS checked_at, user_id, value, event_type
     FROM (SELECT *, CASE WHEN kind = 'source' THEN event_type <> 'error'
                                ELSE value < 400 AND NOT (kind = 'dns' AND event_id % 997 = 0) END AS ok FROM
           (SELECT *, CASE event_type WHEN 'signup' THEN 'dns' WHEN 'click' THEN 'http' ELSE 'source' END AS kind
            FROM events)))"""


register("error_types", f"""
SELECT seq, error, {S.error_type('error')} AS error_type FROM {_checks_sql()} WHERE kind = 'source'""")(
    lambda spark, sf: I.checks(_t(spark, sf, "events")).where(F.col("kind") == "source").select(
        "seq", "error", fl.error_type("error").alias("error_type")))


# The pages hold no marker, so every seventh gets one in turn.
_MARKERS = ["Just a Moment", "cf-browser-verification", "Challenge-Platform", "checking your browser", "CLOUDFLARE"]


def _challenge_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    marker = F.element_at(F.array(*[F.lit(m) for m in _MARKERS]), (F.col("page_id") % len(_MARKERS) + 1).cast("int"))
    html = F.when(F.col("page_id") % 7 == 0, F.concat("html", F.lit("<p>"), marker)).otherwise(F.col("html"))
    return pages.select("page_id", fl.is_challenge_page(html).alias("is_challenge"))


register("challenge_pages", """
SELECT page_id, page_id % 7 = 0 AS is_challenge FROM pages""")(_challenge_spark)


_ZONE_SUFFIX = {"purchase": (" +0530", "+05:30"), "click": (" EST", "-05:00"), "view": (" GMT", "+00:00"),
                "signup": (" -0000", "")}


def _feed_dates_spark(spark, sf):
    e = _t(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    suffix = F.lit(None).cast("string")
    for et, (sfx, _) in _ZONE_SUFFIX.items():
        suffix = F.when(F.col("event_type") == et, F.lit(sfx)).otherwise(suffix)
    raw = F.when(F.col("event_type") == "error", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.concat(F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss"), suffix))
    return e.select("event_id", raw.alias("raw"), fl.parse_feed_date(raw).alias("parsed"),
                    fl.run_date("ts").alias("run_date"), fl.run_id("ts").alias("run_id"),
                    fl.state_run_id("ts").alias("state_run_id"))


_sfx_raw = " ".join(f"WHEN '{et}' THEN '{a}'" for et, (a, _) in _ZONE_SUFFIX.items())
_sfx_iso = " ".join(f"WHEN '{et}' THEN '{b}'" for et, (_, b) in _ZONE_SUFFIX.items())
register("feed_dates", f"""
SELECT event_id,
  CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
       ELSE strftime(ts, '%a, %d %b %Y %H:%M:%S') || CASE event_type {_sfx_raw} END END AS raw,
  CASE WHEN event_type = 'error' THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE event_type {_sfx_iso} END END AS parsed,
  strftime(ts, '%Y-%m-%d') AS run_date, strftime(ts, '%Y%m%dT%H%M%S') AS run_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS state_run_id
FROM events""")(_feed_dates_spark)


# ============================================================ C: extraction

def _page_articles_sql(where: str = "") -> str:
    c = S.strip_non_text("html")
    return f"""
    (SELECT seq, {S.short_id('canonical_url')} AS article_id, '{I.SOURCE_PROFILE}/reads' AS source_url,
            canonical_url AS original_url, canonical_url, title, NULL::VARCHAR AS subtitle, NULL::VARCHAR AS author,
            NULL::VARCHAR AS publication, NULL::VARCHAR AS published_at, NULL::VARCHAR AS description,
            body_text, sha256(body_text) AS content_hash,
            CASE WHEN body_text <> '' THEN 'fetched' ELSE 'partial' END AS fetch_status, '{I.RUN_ISO}' AS fetched_at,
            []::VARCHAR[] AS topic_tags, 'Reads' AS source_label, 'reads_direct' AS discovered_via, url
     FROM (SELECT page_id AS seq, url, {S.normalize_url('url')} AS canonical_url,
                  {S.title_text('c')} AS title, coalesce({S.nclean(S.body_text('c'))}, '') AS body_text
           FROM (SELECT page_id, url, {c} AS c FROM pages {where})))"""


_ARTICLE_OUT = ["seq", "article_id", "original_url", "canonical_url", "title", "subtitle", "author", "publication",
                "published_at", "body_text", "content_hash", "fetch_status"]

register("page_extract", f"""
SELECT {', '.join(_ARTICLE_OUT)}, {S.arr_text('topic_tags')} AS topic_tags FROM {_page_articles_sql()}""")(
    lambda spark, sf: I.page_articles(_t(spark, sf, "pages")).select(
        *_ARTICLE_OUT, _arr(F.col("topic_tags")).alias("topic_tags")))


def _doc_html(documents: DataFrame) -> DataFrame:
    def esc(c):
        return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                                   F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    def refs(c):  # some characters as decimal, hexadecimal and named references
        out = esc(c)
        for ch, ref in (("é", "&#233;"), ("ü", "&uuml;"), ("ñ", "&#xF1;"), ("ß", "&szlig;"), ("|", "&vert;")):
            out = F.replace(out, F.lit(ch), F.lit(ref))
        return out
    first = F.substring_index(F.col("text"), "\n", 1)
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), esc(first), F.lit("</title>"),
        F.lit('<meta charset="utf-8"><meta name="author" content="'), esc(F.col("lang")), F.lit('">'),
        F.lit("<meta property='og:site_name' content='"), F.col("source"), F.lit("'>"),
        F.lit('<meta data-x="a > b" content="'), refs(first), F.lit('" name="description">'),
        F.lit('<meta name="keywords" content="'), F.col("lang"), F.lit(", "), F.col("source"), F.lit(',, news">'),
        F.lit('<link rel="canonical" href="https://'), F.col("source"), F.lit(".example.com/p/"),
        F.col("doc_id").cast("string"), F.lit('/?utm_source=feed">'),
        F.lit('<meta property="article:published_time" content="2024-01-15T08:00:00Z">'),
        F.lit("</head><body><nav><a href=\"/\">Home</a></nav><!-- <article>not this</article> -->"),
        F.lit('<article title="x > y"><h1>'), refs(first), F.lit("</h1><article><p title='>'>"), refs(F.col("text")),
        F.lit("</p></article><p></p></article><p>after</p>"),
        F.lit("<footer>&copy; feed</footer></body></html>"))
    return documents.select(F.col("doc_id"), F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/x/"),
                                                     F.col("doc_id").cast("string")).alias("url"), html.alias("html"))


def _doc_page_metadata(spark, sf):
    m = extract.extract_metadata(_doc_html(_t(spark, sf, "documents")))
    return m.select(
        "doc_id", fl.normalize_url("canonical_raw").alias("canonical_url"),
        fl.normalize_text("title_raw").alias("title"), fl.normalize_text("description_raw").alias("description"),
        fl.normalize_text("subtitle_raw").alias("subtitle"), fl.normalize_text("author_raw").alias("author"),
        fl.normalize_text("publication_raw").alias("publication"),
        fl.normalize_text("published_raw").alias("published_at"),
        F.coalesce(fl.normalize_text("body_raw"), F.lit("")).alias("body_text"),
        _arr(F.col("topic_tags")).alias("topic_tags"))


_fl = "split_part(text, chr(10), 1)"
register("doc_page_metadata", f"""
SELECT doc_id, 'https://' || lower(source) || '.example.com/p/' || CAST(doc_id AS VARCHAR) AS canonical_url,
       {S.nclean(_fl)} AS title, {S.nclean(_fl)} AS description, {S.nclean(_fl)} AS subtitle,
       {S.nclean('lang')} AS author, {S.nclean('source')} AS publication, '2024-01-15T08:00:00Z' AS published_at,
       coalesce({S.nclean(f"{_fl} || ' ' || text")}, '') AS body_text,
       lang || ' | ' || source || ' | news' AS topic_tags
FROM documents""")(_doc_page_metadata)


def _page_links_spark(spark, sf):
    links = extract.extract_links(_t(spark, sf, "pages"))
    return links.select("seq", "pos", "href", "anchor_text", "link_url",
                        fl.is_article_url("link_url").alias("is_article"),
                        fl.is_publication_url("link_url", fl.url_host("source_url")).alias("is_publication"))


register("page_links", f"""
SELECT seq, pos, href, anchor_text, link_url, {S.is_article_url('link_url')} AS is_article,
       {S.is_publication_url('link_url', S.url_host('base'))} AS is_publication
FROM (SELECT *, CASE WHEN href <> '' THEN {S.resolve_simple('base', 'href')} END AS link_url
      FROM {S.anchors_cte('pages', 'page_id', 'url', 'html')})""")(_page_links_spark)



# --- pages grouped into rendered documents (listing pages, home pages, feeds)

_RANKED = f"""
(SELECT page_id, url, host, chunk,
        row_number() OVER (PARTITION BY host, chunk ORDER BY page_id) - 1 AS rk,
        min(page_id) OVER (PARTITION BY host, chunk) AS first_id
 FROM (SELECT page_id, url, {S.url_host('url')} AS host, CAST(floor(page_id / 50) AS BIGINT) AS chunk FROM pages))"""
_LISTING_URL = "'https://' || host || '/@' || replace(host, '.', '-') || '/reads?page=' || CAST(chunk AS VARCHAR)"
_PUB_URL = "'https://' || host || '/archive/' || CAST(chunk AS VARCHAR)"
_BROKEN = "(contains(host, 'spam') OR contains(host, 'cheap'))"

_DIRECT_SQL = f"""
(SELECT first_id AS seq, pos, source_url, article_url, '{I.RUN_ISO}' AS discovered_at, title_hint,
        NULL::VARCHAR AS source_label, 'reads_direct' AS discovered_via
 FROM (SELECT *, row_number() OVER (PARTITION BY first_id, article_url ORDER BY pos) AS r
       FROM (SELECT first_id, CAST(4 * rk AS INTEGER) AS pos, {_LISTING_URL} AS source_url,
                    {S.normalize_url('url')} AS article_url, 'Post ' || CAST(page_id AS VARCHAR) AS title_hint
             FROM {_RANKED})
       WHERE {S.is_article_url('article_url')})
 WHERE r = 1)"""


def _direct_spark(spark, sf):
    return extract.direct_articles(I.listing_pages(_t(spark, sf, "pages")), I.RUN_ISO)


register("direct_articles", f"SELECT * FROM {_DIRECT_SQL}")(_direct_spark)


_PUBS_SQL = f"""
(SELECT seq, pos, {S.short_id('publication_url')} AS publication_id, publication_name, publication_url,
        regexp_replace(publication_url, '/+$', '') || '/feed' AS rss_url, discovered_from_profile,
        '{I.RUN_ISO}' AS first_seen, '{I.RUN_ISO}' AS last_seen_on_reads
 FROM (SELECT *, row_number() OVER (PARTITION BY seq, publication_url ORDER BY pos) AS r FROM (
   SELECT first_id AS seq, CAST(4 * rk + 1 AS INTEGER) AS pos, 'Author ' || CAST(page_id AS VARCHAR) AS publication_name,
          'https://' || host || '/@author' || CAST(page_id AS VARCHAR) AS publication_url,
          {_LISTING_URL} AS discovered_from_profile FROM {_RANKED}
   UNION ALL
   SELECT first_id, CAST(4 * rk + 2 AS INTEGER), 'top', {S.normalize_url(_LISTING_URL)}, {_LISTING_URL}
   FROM {_RANKED}))
 WHERE r = 1)"""

register("discovered_publications", f"SELECT * FROM {_PUBS_SQL}")(
    lambda spark, sf: extract.discovered_publications(I.listing_pages(_t(spark, sf, "pages")), I.RUN_ISO))


register("homepage_posts", f"""
SELECT CAST(3 * rk AS INTEGER) AS pos, {_PUB_URL} AS source_url,
       'https://' || host || '/p/post-' || CAST(page_id AS VARCHAR) AS article_url, '{I.RUN_ISO}' AS discovered_at,
       'Post ' || CAST(page_id AS VARCHAR) AS title_hint, host AS source_label, 'publication_html' AS discovered_via
FROM {_RANKED} WHERE rk < 5""")(
    lambda spark, sf: extract.homepage_posts(I.homepages(_t(spark, sf, "pages")), 5, I.RUN_ISO))


_FEED_TS = "(TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id))"
_FEED_ITEMS_SQL = f"""
(SELECT first_id AS seq, CAST(rk AS INTEGER) AS pos, {_PUB_URL} AS source_url, {S.normalize_url('url')} AS article_url,
        CASE WHEN starts_with(host, 'blog.') THEN strftime({_FEED_TS}, '%Y-%m-%dT%H:%M:%SZ')
             ELSE strftime({_FEED_TS}, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS discovered_at,
        'Post ' || CAST(page_id AS VARCHAR) AS title_hint, host AS source_label, 'publication_rss' AS discovered_via
 FROM {_RANKED} WHERE rk < 5 AND NOT contains(url, '#') AND NOT {_BROKEN})"""

register("feed_items", f"SELECT * FROM {_FEED_ITEMS_SQL}")(
    lambda spark, sf: extract.parse_feeds(I.feeds(_t(spark, sf, "pages")), 5, I.RUN_ISO)[0])

register("feed_status", f"""
SELECT DISTINCT {_PUB_URL} AS publication_url, NOT {_BROKEN} AS feed_ok,
       CASE WHEN {_BROKEN} THEN 'XML parse error: feed is not well-formed' END AS feed_error
FROM {_RANKED}""")(
    lambda spark, sf: extract.parse_feeds(I.feeds(_t(spark, sf, "pages")), 5, I.RUN_ISO)[1])


# --- C9 / C10: canonical rows of the page articles (fetch fails on spam hosts)

def _fetched_pages(pages: DataFrame) -> DataFrame:
    host = fl.url_host("url")
    broken = host.contains("spam") | host.contains("cheap")
    return pages.select("url", "html", F.when(broken, F.concat(F.lit("403 Client Error: Forbidden for url: "),
                                                              F.col("url"))).alias("error"))


_CANON_OUT = [c for c in extract.CANONICAL_COLUMNS if c not in ("summary_bullets", "topic_tags")] + ["seq"]


def _page_canonical_rows(spark, sf):
    pages = _t(spark, sf, "pages")
    items = I.page_read_items(pages)
    fetched = _fetched_pages(pages)
    arts = extract.build_articles(items, fetched.where(F.col("error").isNull()), I.RUN_ISO)
    summ = summarize.summarize(arts, created_at=I.RUN_ISO)
    ok = extract.build_canonical(summ, I.SOURCE_PROFILE, I.RUN_DATE)
    failed = extract.build_failed(items.join(fetched.where(F.col("error").isNotNull())
                                             .select(F.col("url").alias("article_url"), "error"), "article_url"),
                                  I.SOURCE_PROFILE, I.RUN_DATE, I.RUN_ISO)
    return ok.unionByName(failed)


def _canonical_spark(spark, sf):
    return _page_canonical_rows(spark, sf).select(
        *_CANON_OUT, _arr(F.col("summary_bullets")).alias("summary_bullets"),
        _arr(F.col("topic_tags")).alias("topic_tags"))


def _canonical_ok_sql(articles_sql: str, resp: str | None = None) -> str:
    return f"""
    (SELECT article_id, '{I.SOURCE_PROFILE}' AS source_profile, source_label, original_url AS article_url,
            canonical_url, title, coalesce(subtitle, description) AS subtitle, author, publication, published_at,
            body_text, summary_short, _b AS summary_bullets, {S.key_takeaway_from('_b', 'summary_short')} AS key_takeaway,
            topic_tags, fetched_at AS scraped_at, '{I.RUN_DATE}' AS run_date,
            CASE WHEN fetch_status = 'fetched' THEN 'completed' ELSE fetch_status END AS processing_status,
            summary_status, NULL::VARCHAR AS summary_model, content_hash, NULL::VARCHAR AS error_message,
            discovered_via, seq
     FROM {_summary_sql(articles_sql, resp)})"""


_CANON_ROWS_SQL = f"""
(
  SELECT * FROM {_canonical_ok_sql(_page_articles_sql(f"WHERE NOT (contains({S.url_host('url')}, 'spam') OR contains({S.url_host('url')}, 'cheap'))"))}
  UNION ALL
  SELECT {S.short_id(S.normalize_url('url'))}, '{I.SOURCE_PROFILE}', 'Reads', {S.normalize_url('url')},
         {S.normalize_url('url')}, NULL, NULL, NULL, NULL, NULL, '', NULL, []::VARCHAR[], NULL, []::VARCHAR[],
         '{I.RUN_ISO}', '{I.RUN_DATE}', 'failed_extraction', 'not_started', NULL, NULL,
         '403 Client Error: Forbidden for url: ' || url, 'reads_direct', page_id
  FROM pages WHERE contains({S.url_host('url')}, 'spam') OR contains({S.url_host('url')}, 'cheap'))"""

_CANON_SQL = f"""
SELECT {', '.join(_CANON_OUT)}, {S.arr_text('summary_bullets')} AS summary_bullets, {S.arr_text('topic_tags')} AS topic_tags
FROM {_CANON_ROWS_SQL}"""

register("canonical_articles", _CANON_SQL)(_canonical_spark)


# ============================================================ D: dedupe

def _filter_new_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    cands = I.page_read_items(pages).withColumn("canonical_url", fl.normalize_url("article_url"))
    return dedupe.filter_new(cands, I.page_seen(pages)).select("seq", "canonical_url")


_FRESH_SQL = f"""
(SELECT page_id AS seq, {S.normalize_url('url')} AS canonical_url FROM pages
 WHERE {S.normalize_url('url')} NOT IN (SELECT {S.normalize_url('url')} FROM pages WHERE starts_with(url, 'http://')))"""

register("filter_new", f"SELECT * FROM {_FRESH_SQL}")(_filter_new_spark)

register("select_batch", f"SELECT * FROM {_FRESH_SQL} ORDER BY seq LIMIT 10")(
    lambda spark, sf: state.select_batch(_filter_new_spark(spark, sf), 10, ["seq"]))


def _filter_unseen_spark(spark, sf):
    docs = _t(spark, sf, "documents")
    return dedupe.filter_unseen(I.doc_articles(docs), I.doc_seen(docs)).select("seq", "canonical_url", "content_hash")


register("filter_unseen", f"""
WITH a AS (SELECT * FROM {_doc_articles_sql()})
SELECT seq, canonical_url, content_hash FROM a
WHERE canonical_url NOT IN (SELECT canonical_url FROM a WHERE lang = 'es')
  AND content_hash NOT IN (SELECT content_hash FROM a WHERE lang IN ('es', 'de'))""")(_filter_unseen_spark)


def _merge_items_spark(spark, sf):
    pages = _t(spark, sf, "pages")
    direct = extract.direct_articles(I.listing_pages(pages), I.RUN_ISO).select(*extract.READ_ITEM_COLUMNS)
    monitored = extract.parse_feeds(I.feeds(pages), 5, I.RUN_ISO)[0].select(*extract.READ_ITEM_COLUMNS)
    merged = dedupe.merge_items(direct, monitored)
    return merged.select("article_url", "source_rank", "seq", "pos", "source_url", "discovered_via")


register("merge_items", f"""
SELECT article_url, source_rank, seq, pos, source_url, discovered_via FROM (
  SELECT *, row_number() OVER (PARTITION BY {S.normalize_url('article_url')} ORDER BY source_rank, seq, pos) AS r
  FROM (SELECT *, 0 AS source_rank FROM {_DIRECT_SQL} UNION ALL SELECT *, 1 FROM {_FEED_ITEMS_SQL}))
WHERE r = 1""")(_merge_items_spark)


register("dedupe_first", f"""
WITH RECURSIVE d AS (
  SELECT seq, canonical_url AS u, content_hash AS h, row_number() OVER (ORDER BY seq) AS rn
  FROM {_doc_articles_sql()}),
walk(rn, seq, kept, urls, hashes) AS (
  SELECT 0::BIGINT, NULL::BIGINT, false, []::VARCHAR[], []::VARCHAR[]
  UNION ALL
  SELECT d.rn, d.seq, NOT (list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h)),
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.urls ELSE list_append(w.urls, d.u) END,
         CASE WHEN list_contains(w.urls, d.u) OR list_contains(w.hashes, d.h) THEN w.hashes ELSE list_append(w.hashes, d.h) END
  FROM walk w JOIN d ON d.rn = w.rn + 1)
SELECT w.seq, d.u AS canonical_url, d.h AS content_hash FROM walk w JOIN d ON d.seq = w.seq WHERE w.kept""")(
    lambda spark, sf: dedupe.dedupe_first(I.doc_articles(_t(spark, sf, "documents"))).select(
        "seq", "canonical_url", "content_hash"))


