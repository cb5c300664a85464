"""Extraction jobs (C1-C10): pages, links, feeds -> articles.

Everything per page (metadata, body, links) is computed inside the page's own
row: links are de-duplicated and ranked with array functions before they are
exploded, so link discovery needs no shuffle at all.  The only shuffles are
the joins between read items and fetched pages (C8) and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import pagetokens as P
from ..functions._common import let
from ..functions.dates import parse_feed_date
from ..functions.status import fetch_status
from ..functions.text import clean_whitespace, content_hash, normalize_text, short_id, strip_ws, topic_tags
from ..functions.urls import (default_feed_url, is_article_url, is_publication_url, normalize_url,
                              resolve_url, url_host)

READ_ITEM_COLUMNS = ["seq", "pos", "source_url", "article_url", "discovered_at", "title_hint",
                     "source_label", "discovered_via"]

# Feed namespace and discovery channels.
ATOM_NS = "http://www.w3.org/2005/Atom"
VIA_READS = "reads_direct"
VIA_RSS = "publication_rss"
VIA_HTML = "publication_html"


# --------------------------------------------------------------------------
# Metadata and body of fetched pages
# --------------------------------------------------------------------------

def with_tokens(pages: DataFrame, html_col: str) -> DataFrame:
    """``pages`` with the page's tokens (one scan of the HTML) in place of the HTML."""
    return pages.withColumn("_tok", P.tokens(f"`{html_col}`"))


def extract_metadata(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """C1 + C2: add canonical_url (raw), title, description, subtitle, author,
    publication, published_at, body_text, topic_tags to every page row.

    ``html`` is scanned once; its tokens are staged in a projection of their own
    so the optimizer keeps them as one computed column, and everything else is
    looked up in them.
    """
    staged = with_tokens(pages, html_col).withColumn("_head", P.head_tags("_tok"))
    description = F.coalesce(P.meta("_head", "name", "description"), P.meta("_head", "property", "og:description"))
    out = staged.select(
        "*",
        F.coalesce(P.first_value("_head", "k.tag = 'link' AND k.v[3] = 'canonical'", "href"), F.col(url_col)).alias("canonical_raw"),
        F.coalesce(P.meta("_head", "property", "og:title"), P.meta("_head", "name", "twitter:title"),
                   P.title("_tok")).alias("title_raw"),
        description.alias("description_raw"),
        F.coalesce(P.meta("_head", "name", "twitter:description"), description).alias("subtitle_raw"),
        F.coalesce(P.meta("_head", "name", "author"), P.meta("_head", "property", "article:author")).alias("author_raw"),
        P.meta("_head", "property", "og:site_name").alias("publication_raw"),
        F.coalesce(P.meta("_head", "property", "article:published_time"),
                   P.first_value("_head", "k.tag = 'time' AND k.has_datetime", "datetime")).alias("published_raw"),
        P.body("_tok").alias("body_raw"),
        topic_tags(P.meta("_head", "name", "keywords")).alias("topic_tags"),
    )
    return out.drop("_tok", "_head")


def extract_body(pages: DataFrame, html_col: str = "html", out_col: str = "body_text",
                 method: str = "regex") -> DataFrame:
    """C2 alone: visible text of the main container.

    ``method="regex"`` stays in JVM built-ins (whole-stage codegen);
    ``method="parser"`` runs the standard library HTML parser per row in an
    Arrow-batched ``mapInPandas`` (exact element nesting, every character
    reference) -- the general path for pages the regex chain cannot read.
    """
    if method == "regex":
        return with_tokens(pages, html_col).withColumn(out_col, P.body("_tok")).drop("_tok")
    if method != "parser":
        raise ValueError(f"unknown method: {method}")
    from pyspark.sql import types as T

    from ..functions.htmltext import body_text as parse_body

    out_schema = T.StructType([*pages.schema.fields, T.StructField(out_col, T.StringType())])

    def run(batches):
        for pdf in batches:
            pdf[out_col] = [parse_body(h) for h in pdf[html_col]]
            yield pdf

    return pages.mapInPandas(run, out_schema)


def quarantine_challenges(pages: DataFrame, html_col: str = "html") -> tuple[DataFrame, DataFrame]:
    """B14 as a job: (clean pages, challenge pages) split right after the scan."""
    flag = H.is_challenge_page(F.col(html_col))
    return pages.where(~flag), pages.where(flag)


# --------------------------------------------------------------------------
# links
# --------------------------------------------------------------------------

def _page_links(tok: str, base: Column) -> Column:
    """array<struct<pos, href, text, url>> of all anchors with an href."""
    with_href = F.filter(P.anchors(tok), lambda x: x["href"].isNotNull())
    return F.transform(with_href, lambda x: F.struct(
        x["pos"].alias("pos"), strip_ws(x["href"]).alias("href"), x["text"].alias("text"),
        F.when(strip_ws(x["href"]) != "", resolve_url(base, strip_ws(x["href"]))).alias("url")))


def _first_per_url(links: Column) -> Column:
    """Keep the first occurrence (lowest pos) of every url, ordered by pos.

    Sort-based (n log n) inside the row; no shuffle.
    """
    by_url = F.array_sort(F.transform(links, lambda x: F.struct(
        x["url"].alias("url"), x["pos"].alias("pos"), x["href"].alias("href"), x["text"].alias("text"))))
    firsts = let(by_url, lambda s: F.filter(
        s, lambda x, i: (i == 0) | (F.get(s, i - 1)["url"] != x["url"])))
    return F.array_sort(F.transform(firsts, lambda x: F.struct(
        x["pos"].alias("pos"), x["url"].alias("url"), x["href"].alias("href"), x["text"].alias("text"))))


def extract_links(pages: DataFrame, base_col: str = "url", html_col: str = "html",
                  seq_col: str = "page_id") -> DataFrame:
    """Every ``a[href]`` in document order with anchor text, resolved
    against the page URL and normalised (one row per anchor)."""
    staged = with_tokens(pages, html_col).select(F.col(seq_col).alias("seq"), F.col(base_col).alias("source_url"), "_tok")
    exploded = staged.select("seq", "source_url", F.explode(_page_links("_tok", F.col("source_url"))).alias("l"))
    return exploded.select("seq", F.col("l.pos").alias("pos"), "source_url", F.col("l.href").alias("href"),
                           F.col("l.text").alias("anchor_text"), F.col("l.url").alias("link_url"))


def _with_links(pages: DataFrame, base_col: str, html_col: str) -> DataFrame:
    """``pages`` with the links of each page as ``_links``."""
    return with_tokens(pages, html_col).withColumn("_links", _page_links("_tok", F.col(base_col))).drop("_tok")


def direct_articles(pages: DataFrame, discovered_at: str, source_label: str | None = None,
                    base_col: str = "url", html_col: str = "html", seq_col: str = "page_id") -> DataFrame:
    """C4: candidate article links of reads pages -> ``read_items``.

    Drops blank and ``#...`` hrefs, keeps B12 candidates, first occurrence per
    URL within a page wins; title hint is the anchor text or NULL.
    """
    cands = _article_links(F.col("_links"))
    rows = _with_links(pages, base_col, html_col).select(F.col(seq_col).alias("seq"), F.col(base_col).alias("source_url"),
                        F.explode(_first_per_url(cands)).alias("l"))
    return rows.select(
        "seq", F.col("l.pos").alias("pos"), "source_url", F.col("l.url").alias("article_url"),
        F.lit(discovered_at).alias("discovered_at"),
        F.nullif(F.col("l.text"), F.lit("")).alias("title_hint"),
        F.lit(source_label).cast("string").alias("source_label"),
        F.lit(VIA_READS).alias("discovered_via"))


def _article_links(links: Column) -> Column:
    return F.filter(links, lambda x: (x["href"] != "") & ~x["href"].startswith("#") & is_article_url(x["url"]))


def _publication_links(links: Column, profile_host: Column) -> Column:
    return F.filter(links, lambda x: (x["href"] != "") & is_publication_url(x["url"], profile_host))


def link_counts(pages: DataFrame, base_col: str = "url", html_col: str = "html", seq_col: str = "page_id") -> DataFrame:
    """Per page: seq, is_challenge, and how many links C4 and C5 would take (before first-per-URL)."""
    staged = _with_links(pages, base_col, html_col).select(
        F.col(seq_col).alias("seq"), F.col(base_col).alias("_base"), H.is_challenge_page(F.col(html_col)).alias("is_challenge"), "_links")
    return staged.select("seq", "is_challenge", F.size(_article_links(F.col("_links"))).alias("direct_links"),
                         F.size(_publication_links(F.col("_links"), url_host(F.col("_base")))).alias("publication_links"))


def discovered_publications(pages: DataFrame, discovered_at: str, base_col: str = "url",
                            html_col: str = "html", seq_col: str = "page_id") -> DataFrame:
    """Candidate publication links of a profile's reads page.

    Fragment-only hrefs are not skipped here (they resolve to the page itself
    and are then judged by the same-host ``/@`` rule).
    """
    profile_host = url_host(F.col(base_col))
    cands = _publication_links(F.col("_links"), profile_host)
    rows = _with_links(pages, base_col, html_col).select(F.col(seq_col).alias("seq"), F.col(base_col).alias("discovered_from_profile"),
                        F.explode(_first_per_url(cands)).alias("l"))
    url = F.col("l.url")
    return rows.select(
        "seq", F.col("l.pos").alias("pos"),
        short_id(url).alias("publication_id"),
        F.coalesce(F.nullif(F.col("l.text"), F.lit("")), url).alias("publication_name"),
        url.alias("publication_url"),
        default_feed_url(url).alias("rss_url"),
        "discovered_from_profile",
        F.lit(discovered_at).alias("first_seen"),
        F.lit(discovered_at).alias("last_seen_on_reads"),
    )


def homepage_posts(homepages: DataFrame, limit: int, discovered_at: str,
                   url_col: str = "publication_url", name_col: str = "publication_name",
                   html_col: str = "html") -> DataFrame:
    """First ``limit`` distinct ``/p/`` links of each publication homepage."""
    cands = F.filter(F.col("_links"), lambda x: (x["href"] != "") & x["url"].contains("/p/"))
    rows = _with_links(homepages, url_col, html_col).select(F.col(url_col).alias("source_url"), F.col(name_col).alias("source_label"),
                            F.explode(F.slice(_first_per_url(cands), 1, limit)).alias("l"))
    return rows.select(
        F.col("l.pos").alias("pos"), "source_url", F.col("l.url").alias("article_url"),
        F.lit(discovered_at).alias("discovered_at"),
        F.nullif(F.col("l.text"), F.lit("")).alias("title_hint"),
        "source_label", F.lit(VIA_HTML).alias("discovered_via"))


# --------------------------------------------------------------------------
# RSS / Atom feeds
# --------------------------------------------------------------------------

_LINK_T = "array<struct<_href:string,_VALUE:string>>"
_ENTRY_T = f"struct<title:string,link:{_LINK_T},pubDate:string,published:string>"
FEED_SCHEMA = f"struct<channel:array<struct<item:array<{_ENTRY_T}>>>,entry:array<{_ENTRY_T}>,_corrupt_record:string>"
# Entries count only in a document whose root is bound to the Atom namespace.
ATOM_ROOT_RE = rf"""(?s)^\s*(?:<\?.*?\?>\s*|<!--.*?-->\s*)*<(?:[\w.-]+:)?feed\b[^>]*\sxmlns(?::[\w.-]+)?\s*=\s*["']{ATOM_NS}["']"""


def _entry_link(links: Column) -> Column:
    """First link child with a non-empty href, else its non-empty text."""
    picked = F.transform(links, lambda l: F.coalesce(
        F.nullif(strip_ws(l["_href"]), F.lit("")), F.nullif(strip_ws(l["_VALUE"]), F.lit(""))))
    return F.get(F.filter(picked, lambda v: v.isNotNull()), 0)


def parse_feeds(feeds: DataFrame, limit: int, now_iso: str, xml_col: str = "xml",
                url_col: str = "publication_url", name_col: str = "publication_name") -> tuple[DataFrame, DataFrame]:
    """(items, status) from fetched feed documents.

    RSS ``item`` elements are used, or Atom ``entry`` elements when there is no
    item at all.  Elements are matched by local name, whatever their prefix, and
    the items of all channels count.  The first ``limit`` entries are taken and only then are
    link-less ones dropped.  ``status`` has one row per feed: ``feed_ok`` is
    false for malformed XML (an error row for the monitor, D7).
    """
    parsed = feeds.withColumn("_x", F.from_xml(F.col(xml_col), FEED_SCHEMA,
                                               {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "ignoreNamespace": "true"}))
    none = F.array().cast(f"array<{_ENTRY_T}>")
    items = F.flatten(F.transform(F.coalesce(F.col("_x.channel"), F.array().cast(f"array<struct<item:array<{_ENTRY_T}>>>")),
                                  lambda c: F.coalesce(c["item"], none)))
    entries = F.when(F.size(items) > 0, items).when(F.col(xml_col).rlike(ATOM_ROOT_RE), F.col("_x.entry"))
    ok = F.col(xml_col).isNotNull() & F.col("_x._corrupt_record").isNull() & F.col("_x").isNotNull()
    parsed = parsed.withColumn("feed_ok", ok).withColumn("_entries", F.coalesce(entries, F.array()))

    status = parsed.select(url_col, "feed_ok",
                           F.when(~F.col("feed_ok"), F.lit("XML parse error: feed is not well-formed"))
                           .alias("feed_error"))
    keep = [c for c in ("seq",) if c in feeds.columns]
    exploded = parsed.where("feed_ok").select(
        *keep, url_col, name_col, F.posexplode(F.slice(F.col("_entries"), 1, limit)).alias("pos", "e"))
    link = _entry_link(F.coalesce(F.col("e.link"), F.array()))
    title = F.nullif(strip_ws(F.col("e.title")), F.lit(""))
    raw_date = F.coalesce(F.nullif(strip_ws(F.col("e.pubDate")), F.lit("")),
                          F.nullif(strip_ws(F.col("e.published")), F.lit("")), F.lit(now_iso))
    out = exploded.select(
        *keep, "pos", F.col(url_col).alias("source_url"), link.alias("_link"),
        parse_feed_date(raw_date).alias("discovered_at"), title.alias("title_hint"),
        F.col(name_col).alias("source_label"),
    ).where(F.col("_link").isNotNull())
    out = out.select(*keep, "pos", "source_url", normalize_url(F.col("_link")).alias("article_url"),
                     "discovered_at", "title_hint", "source_label", F.lit(VIA_RSS).alias("discovered_via"))
    return out, status


# --------------------------------------------------------------------------
# Article records
# --------------------------------------------------------------------------

def page_fields(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The article fields that depend on the page alone, beside its URL (``_fetched_url``): no join, one scan of the HTML."""
    meta = extract_metadata(pages.select(F.col(url_col).alias("_fetched_url"), F.col(html_col).alias("_html")), "_fetched_url", "_html")
    canonical = normalize_url(F.coalesce(F.nullif(F.col("canonical_raw"), F.lit("")), F.col("_fetched_url")))
    staged = meta.withColumn("canonical_url", canonical).withColumn("body_text", F.coalesce(normalize_text(F.col("body_raw")), F.lit("")))
    return staged.select(
        "_fetched_url",
        short_id(F.col("canonical_url")).alias("article_id"),
        normalize_url(F.col("_fetched_url")).alias("original_url"),
        "canonical_url",
        normalize_text(F.col("title_raw")).alias("page_title"),
        F.coalesce(normalize_text(F.col("subtitle_raw")), normalize_text(F.col("description_raw"))).alias("subtitle"),
        normalize_text(F.col("author_raw")).alias("author"),
        normalize_text(F.col("publication_raw")).alias("publication"),
        normalize_text(F.col("published_raw")).alias("published_at"),
        normalize_text(F.col("description_raw")).alias("description"),
        "body_text",
        content_hash(F.col("body_text")).alias("content_hash"),
        fetch_status(F.col("body_text")).alias("fetch_status"),
        F.coalesce(F.col("topic_tags"), F.array().cast("array<string>")).alias("topic_tags"),
    )


def build_articles(read_items: DataFrame, fetched: DataFrame, fetched_at: str,
                   fetched_url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Article records of read items whose page was fetched.

    ``fetched`` holds (url, html); it is joined on the item's article URL.  Of
    several fetches of one URL one counts: the smallest in the order of its
    extracted fields.  Items without a fetched page are not returned (see
    :func:`build_failed`).

    Pages that no item names are dropped first, then fields are extracted where
    the page lies; HTML never crosses an exchange.
    """
    named = read_items.select(F.col("article_url").alias("_named")).distinct()
    pages = fetched.join(named, fetched[fetched_url_col] == F.col("_named"), "left_semi")
    fields = page_fields(pages, fetched_url_col, html_col)
    rest = [c for c in fields.columns if c != "_fetched_url"]
    fields = fields.groupBy("_fetched_url").agg(F.min(F.struct(*rest)).alias("_f")).select("_fetched_url", "_f.*")
    joined = read_items.join(fields, read_items["article_url"] == fields["_fetched_url"], "inner")
    return joined.select(
        "seq", "article_id", "source_url", "original_url", "canonical_url",
        F.coalesce("page_title", "title_hint").alias("title"), "subtitle", "author", "publication", "published_at", "description", "body_text",
        "content_hash", "fetch_status", F.lit(fetched_at).alias("fetched_at"), "topic_tags", "source_label", "discovered_via",
    )


CANONICAL_COLUMNS = [
    "article_id", "source_profile", "source_label", "article_url", "canonical_url", "title",
    "subtitle", "author", "publication", "published_at", "body_text", "summary_short",
    "summary_bullets", "key_takeaway", "topic_tags", "scraped_at", "run_date",
    "processing_status", "summary_status", "summary_model", "content_hash", "error_message",
    "discovered_via",
]


def build_canonical(summarized: DataFrame, source_profile: str, run_date: str) -> DataFrame:
    """The 23-column fact row of summarised articles (plus ``seq``).

    ``summarized`` is the output of I1 (articles with their summary columns),
    so this is a projection, not a join.
    """
    return summarized.select(
        "article_id", F.lit(source_profile).alias("source_profile"), "source_label",
        F.col("original_url").alias("article_url"), "canonical_url", "title",
        F.coalesce(F.col("subtitle"), F.col("description")).alias("subtitle"),
        "author", "publication", "published_at", "body_text", "summary_short",
        "summary_bullets", "key_takeaway", "topic_tags",
        F.col("fetched_at").alias("scraped_at"), F.lit(run_date).alias("run_date"),
        F.when(F.col("fetch_status") == "fetched", F.lit("completed")).otherwise(F.col("fetch_status"))
        .alias("processing_status"),
        "summary_status", F.col("model").alias("summary_model"), "content_hash",
        F.lit(None).cast("string").alias("error_message"), "discovered_via", "seq",
    )


def build_failed(failed_items: DataFrame, source_profile: str, run_date: str, scraped_at: str,
                 error_col: str = "error") -> DataFrame:
    """Canonical rows for items whose fetch or extraction failed."""
    url = normalize_url(F.col("article_url"))
    return failed_items.select(
        short_id(url).alias("article_id"), F.lit(source_profile).alias("source_profile"),
        "source_label", url.alias("article_url"), url.alias("canonical_url"),
        F.col("title_hint").alias("title"),
        *[F.lit(None).cast("string").alias(c) for c in ("subtitle", "author", "publication", "published_at")],
        F.lit("").alias("body_text"), F.lit(None).cast("string").alias("summary_short"),
        F.array().cast("array<string>").alias("summary_bullets"),
        F.lit(None).cast("string").alias("key_takeaway"),
        F.array().cast("array<string>").alias("topic_tags"),
        F.lit(scraped_at).alias("scraped_at"), F.lit(run_date).alias("run_date"),
        F.lit("failed_extraction").alias("processing_status"), F.lit("not_started").alias("summary_status"),
        F.lit(None).cast("string").alias("summary_model"), F.lit(None).cast("string").alias("content_hash"),
        F.col(error_col).cast("string").alias("error_message"), "discovered_via", "seq",
    )
