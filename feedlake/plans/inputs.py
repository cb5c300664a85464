"""Input tables derived from the driver tables with Spark.

The engine's inputs (read items, seen-sets, reads/listing pages, home pages,
feeds, check results, registry, model responses) are all computed from
``pages``, ``documents``, ``events`` and ``conversations`` so that every
query's work grows with those tables.  Rendered documents (listing pages,
home pages, feeds) hold at most :data:`CHUNK` source rows each
(``floor(page_id / CHUNK)``), so no host -- however hot -- is gathered into
one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.status import error_type, fetch_status
from ..functions.text import content_hash, normalize_text, short_id, topic_tags
from ..functions.urls import url_host
from ..operators.extract import build_articles, page_fields
from ..sources.io import spread

# The run clock and profile the derived inputs use.
RUN_TS = "2024-01-31 06:00:00"
RUN_ISO = "2024-01-31T06:00:00+00:00"
RUN_DATE = "2024-01-31"
PRIOR_TS = "2024-01-15 00:00:00"
SPLIT_TS = "2024-01-25 00:00:00"
SOURCE_PROFILE = "https://reads.example.com/@feedlake"
EPOCH_2024 = 1704067200  # 2024-01-01T00:00:00Z
CHUNK = 50


# Id column of each driver table (the partitioning key for :func:`spread`).
TABLE_KEYS = {"pages": "page_id", "documents": "doc_id", "events": "event_id", "conversations": "conv_id"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a driver table.

    ``spark.feedlake.scanPartitions`` (unset unless a session asks for it, as
    the bench does for its single-file inputs) spreads the rows over that many
    partitions; the plan never depends on the input's size.  The run clocks
    are UTC literals, so the session clock is pinned to UTC.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    key, n = TABLE_KEYS.get(name), spark.conf.get("spark.feedlake.scanPartitions", None)
    return spread(df, int(n), key) if key and n else df


def _xml_escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


# ---------------------------------------------------------------- pages ---

def page_read_items(pages: DataFrame) -> DataFrame:
    """Every fetched page as a read item found on the profile's reads page."""
    return pages.select(
        F.col("page_id").alias("seq"), F.lit(0).alias("pos"), F.lit(SOURCE_PROFILE + "/reads").alias("source_url"),
        F.col("url").alias("article_url"), F.lit(RUN_ISO).alias("discovered_at"),
        F.lit(None).cast("string").alias("title_hint"), F.lit("Reads").alias("source_label"),
        F.lit("reads_direct").alias("discovered_via"))


def page_articles(pages: DataFrame) -> DataFrame:
    """C8 over all pages (read items joined to their fetched HTML)."""
    return build_articles(page_read_items(pages), pages.select("url", "html"), RUN_ISO)


def page_seen(pages: DataFrame) -> DataFrame:
    """Prior seen-set: pages fetched over plain http in an earlier run."""
    arts = page_fields(pages.where(F.col("url").startswith("http://")))
    return arts.select("canonical_url", "article_id", "content_hash",
                       F.lit(PRIOR_TS).cast("timestamp").alias("first_seen"),
                       F.lit(PRIOR_TS).cast("timestamp").alias("last_seen"))


def _page_host(pages: DataFrame) -> DataFrame:
    return pages.withColumn("host", url_host(F.col("url"))).withColumn("chunk", F.floor(F.col("page_id") / CHUNK))


def listing_pages(pages: DataFrame) -> DataFrame:
    """Reads pages: per (host, chunk) a page linking every article of the
    chunk, the author profile, a fragment link and an excluded path."""
    p = _page_host(pages)
    anchor = F.concat(
        F.lit('<li><a title="older > newer" href="'), _xml_escape(F.col("url")), F.lit('">Post '), F.col("page_id").cast("string"),
        F.lit('</a> by <a href="/@author'), F.col("page_id").cast("string"), F.lit('">Author '),
        F.col("page_id").cast("string"), F.lit('</a> <a href="#top">top</a> <a href="/about">about</a></li>'))
    g = p.groupBy("host", "chunk").agg(
        F.min("page_id").alias("page_id"),
        F.array_sort(F.collect_list(F.struct("page_id", anchor.alias("a")))).alias("items"))
    url = F.concat(F.lit("https://"), F.col("host"), F.lit("/@"), F.replace(F.col("host"), F.lit("."), F.lit("-")),
                   F.lit("/reads?page="), F.col("chunk").cast("string"))
    html = F.concat(F.lit("<html><head><title>Reads</title></head><body><main><ul>"),
                    F.array_join(F.transform(F.col("items"), lambda x: x["a"]), ""),
                    F.lit("</ul></main></body></html>"))
    return g.select("page_id", url.alias("url"), html.alias("html"), "host", "chunk")


def homepages(pages: DataFrame) -> DataFrame:
    """Publication home pages: per (host, chunk) two ``/p/`` links per page
    (one repeated) plus navigation links."""
    p = _page_host(pages)
    slug = F.concat(F.lit("/p/post-"), F.col("page_id").cast("string"))
    anchor = F.concat(F.lit('<a href="'), slug, F.lit('">Post '), F.col("page_id").cast("string"),
                      F.lit('</a><a href="/archive">Archive</a><a href="'), slug, F.lit('/?ref=home">again</a>'))
    g = p.groupBy("host", "chunk").agg(F.min("page_id").alias("seq"),
                                       F.array_sort(F.collect_list(F.struct("page_id", anchor.alias("a")))).alias("items"))
    pub_url = F.concat(F.lit("https://"), F.col("host"), F.lit("/archive/"), F.col("chunk").cast("string"))
    html = F.concat(F.lit("<html><body><main>"), F.array_join(F.transform(F.col("items"), lambda x: x["a"]), ""),
                    F.lit("</main></body></html>"))
    return g.select("seq", pub_url.alias("publication_url"), F.col("host").alias("publication_name"),
                    html.alias("html"))


def feeds(pages: DataFrame) -> DataFrame:
    """Feeds per (host, chunk): Atom for ``blog.`` hosts (every other chunk with
    a prefix on all elements), RSS otherwise (every other chunk in a second
    channel, every third item with a prefixed Atom link); a page URL with a fragment gives a link-less entry; hosts containing
    ``spam`` or ``cheap`` serve a document without its closing tags (malformed)."""
    p = _page_host(pages)
    ts = F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("page_id") * 3600)
    atom = F.col("host").startswith("blog.")
    has_frag = F.col("url").contains("#")
    title = F.concat(F.lit("Post "), F.col("page_id").cast("string"))
    rss_item = F.concat(
        F.lit("<item><title>"), title, F.lit("</title>"),
        F.when(has_frag, F.lit(""))
        .when(F.col("page_id") % 3 == 0, F.concat(F.lit('<atom:link rel="alternate" href="'), _xml_escape(F.col("url")), F.lit('"/>')))
        .otherwise(F.concat(F.lit("<link>"), _xml_escape(F.col("url")), F.lit("</link>"))),
        F.lit("<pubDate>"), F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"), F.lit("</pubDate></item>"))
    atom_entry = F.concat(
        F.lit("<entry><title>"), title, F.lit("</title>"),
        F.when(has_frag, F.lit("")).otherwise(F.concat(F.lit('<link rel="alternate" href="'),
                                                       _xml_escape(F.col("url")), F.lit('"/>'))),
        F.lit("<published>"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</published></entry>"))
    p = p.withColumn("entry", F.when(atom, atom_entry).otherwise(rss_item))
    g = p.groupBy("host", "chunk").agg(F.min("page_id").alias("seq"),
                                       F.array_sort(F.collect_list(F.struct("page_id", "entry"))).alias("items"))
    body = F.array_join(F.transform(F.col("items"), lambda x: x["entry"]), "")
    is_atom = F.col("host").startswith("blog.")
    broken = F.col("host").contains("spam") | F.col("host").contains("cheap")
    odd = F.col("chunk") % 2 == 1
    close = lambda text: F.when(broken, F.lit("")).otherwise(F.lit(text))
    plain = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom"><title>'), F.col("host"), F.lit("</title>"), body, close("</feed>"))
    prefixed = F.concat(F.lit('<a:feed xmlns:a="http://www.w3.org/2005/Atom"><a:title>'), F.col("host"), F.lit("</a:title>"),
                        F.regexp_replace(body, "<(/?)(entry|title|link|published)", "<$1a:$2"), close("</a:feed>"))
    rss = F.concat(F.lit('<?xml version="1.0"?><rss version="2.0" xmlns:atom="http://www.w3.org/2005/Atom"><channel><title>'), F.col("host"),
                   F.lit("</title>"), F.when(odd, F.lit("</channel><channel>")).otherwise(F.lit("")), body, close("</channel></rss>"))
    doc = F.when(is_atom & odd, prefixed).when(is_atom, plain).otherwise(rss)
    pub_url = F.concat(F.lit("https://"), F.col("host"), F.lit("/archive/"), F.col("chunk").cast("string"))
    return g.select("seq", pub_url.alias("publication_url"), F.col("host").alias("publication_name"),
                    doc.alias("xml"))


# ------------------------------------------------------------ documents ---

def doc_articles(documents: DataFrame) -> DataFrame:
    """Article records for documents (one per doc; URLs collide by
    source/lang/size bucket, texts collide on copies)."""
    url = F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com/p/"), F.col("lang"), F.lit("-"),
                   F.floor(F.col("n_chars") / 1000).cast("string"))
    first_line = F.substring_index(F.col("text"), "\n", 1)
    day = F.least(F.lit(28), 1 + F.floor(F.col("n_chars") / 500))
    staged = documents.select(
        F.col("doc_id").alias("seq"), url.alias("canonical_url"), "source", "lang", "text", first_line.alias("_fl"),
        F.concat(F.lit("2024-01-"), F.lpad(day.cast("string"), 2, "0"), F.lit("T12:00:00Z")).alias("published_at"))
    staged = staged.withColumn("body_text", F.coalesce(normalize_text(F.col("text")), F.lit("")))
    return staged.select(
        "seq", short_id(F.col("canonical_url")).alias("article_id"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example.com")).alias("source_url"),
        F.col("canonical_url").alias("original_url"), "canonical_url",
        normalize_text(F.col("_fl")).alias("title"), F.lit(None).cast("string").alias("subtitle"),
        F.col("lang").alias("author"), F.col("source").alias("publication"), "published_at",
        F.lit(None).cast("string").alias("description"), "body_text",
        content_hash(F.col("body_text")).alias("content_hash"), fetch_status(F.col("body_text")).alias("fetch_status"),
        F.lit(RUN_ISO).alias("fetched_at"),
        topic_tags(F.replace(F.col("_fl"), F.lit(" | "), F.lit(","))).alias("topic_tags"),
        F.col("source").alias("source_label"), F.lit("publication_rss").alias("discovered_via"), "lang")


def doc_seen(documents: DataFrame) -> DataFrame:
    """Prior seen-set: Spanish documents under their own URL and German
    documents archived under another URL (so only their hash can match)."""
    arts = doc_articles(documents)
    own = arts.where(F.col("lang") == "es").select("canonical_url", "article_id", "content_hash")
    moved = arts.where(F.col("lang") == "de").select(
        F.concat(F.lit("https://archive.example.com/"), F.col("seq").cast("string")).alias("canonical_url"),
        "article_id", "content_hash")
    return own.unionByName(moved).select(
        "*", F.lit(PRIOR_TS).cast("timestamp").alias("first_seen"), F.lit(PRIOR_TS).cast("timestamp").alias("last_seen"))


def responses(conversations: DataFrame) -> DataFrame:
    """Model responses: the last assistant turn of each conversation, keyed
    by ``seq`` = conv_id (= doc_id)."""
    a = conversations.where(F.col("role") == "assistant")
    return a.groupBy("conv_id").agg(F.max_by("text", "turn").alias("output_text")).select(
        F.col("conv_id").alias("seq"), "output_text")


# --------------------------------------------------------------- events ---

def _pub_url(user_id: Column) -> Column:
    """Normalised publication URL (a bare host keeps its ``/`` path)."""
    return F.concat(F.lit("https://pub"), user_id.cast("string"), F.lit(".example.com/"))


def check_message(value: Column, user_id: Column) -> Column:
    host = F.concat(F.lit("pub"), user_id.cast("string"), F.lit(".example.com"))
    return (F.when(value < 10, F.concat(F.lit("Failed to resolve '"), host, F.lit("' ([Errno -2] Name or service not known)")))
            .when(value < 20, F.concat(F.lit("403 Client Error: Forbidden for url: https://"), host, F.lit("/feed")))
            .when(value < 30, F.concat(F.lit("HTTPSConnectionPool(host='"), host,
                                       F.lit("', port=443): Read timed out. (read timeout=20)")))
            .when(value < 40, F.lit("XML parse error: not well-formed (invalid token): line 1, column 0"))
            .when(value < 60, F.concat(F.lit("HTTPSConnectionPool(host='"), host,
                                       F.lit("', port=443): Max retries exceeded with url: /feed")))
            .when(value < 100, F.lit("The read operation timed out"))
            .otherwise(F.lit("Connection reset by peer")))


def checks(events: DataFrame) -> DataFrame:
    """Check results per day: signup -> dns, click -> http, others -> source;
    source checks fail on error events, dns/http checks on values >= 400, one dns
    check in 997 in any case."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.when(F.col("event_type") == "signup", "dns").when(F.col("event_type") == "click", "http").otherwise("source")
    e = e.withColumn("kind", kind)
    ok = F.when(F.col("kind") == "source", F.col("event_type") != "error") \
        .otherwise((F.col("value") < 400) & ((F.col("kind") != "dns") | (F.col("event_id") % 997 != 0)))
    e = e.withColumn("ok", ok)
    code = F.when(F.col("kind") == "http", F.when(F.col("value") < 400, 200).when(F.col("value") < 450, 503).otherwise(403))
    err = (F.when(F.col("ok"), F.lit(None).cast("string"))
           .when(F.col("kind") == "dns", F.lit("Temporary failure in name resolution"))
           .when(F.col("kind") == "http", F.lit(None).cast("string"))
           .otherwise(check_message(F.col("value"), F.col("user_id"))))
    return e.select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"), F.col("event_id").alias("seq"), "kind",
        F.when(F.col("kind") == "source", _pub_url(F.col("user_id")))
        .otherwise(F.lit("https://reads.example.com/feed")).alias("target"),
        "ok", code.cast("int").alias("status_code"), err.alias("error"), F.col("ts").alias("checked_at"), "user_id")


def registry_from_events(events: DataFrame, before: str | None = None) -> DataFrame:
    """Registry rows of publications seen on reads (view events), with the
    last error of each publication; expiry = floor of the smallest value."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if before:
        e = e.where(F.col("ts") < F.lit(before).cast("timestamp"))
    views = e.where(F.col("event_type") == "view").groupBy("user_id").agg(
        F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"),
        F.floor(F.min("value")).cast("int").alias("expiry"))
    errs = e.where(F.col("event_type") == "error").groupBy("user_id").agg(
        F.max(F.struct("ts", "event_id", "value")).alias("_e"))
    j = views.join(errs, "user_id", "left")
    msg = check_message(F.col("_e.value"), F.col("user_id"))
    url = _pub_url(F.col("user_id"))
    return j.select(
        url.alias("publication_url"), short_id(url).alias("publication_id"),
        F.concat(F.lit("Publication "), F.col("user_id").cast("string")).alias("publication_name"),
        F.concat(url, F.lit("feed")).alias("rss_url"), F.lit(SOURCE_PROFILE).alias("discovered_from_profile"),
        "first_seen", F.col("last_seen").alias("last_seen_on_reads"),
        F.lit(None).cast("timestamp").alias("last_checked"), F.lit(None).cast("timestamp").alias("last_attempted_check"),
        F.lit(None).cast("timestamp").alias("last_successful_check"),
        F.when(F.col("_e").isNotNull(), F.lit("error")).otherwise(F.lit("pending")).alias("monitor_status"),
        F.lit("rss").alias("monitor_method"), F.col("expiry").alias("expiry_after_days"), F.lit(True).alias("is_active"),
        F.when(F.col("_e").isNotNull(), error_type(msg)).alias("last_error_type"),
        F.when(F.col("_e").isNotNull(), msg).alias("last_error_message"),
        F.when(F.col("_e").isNotNull(), msg).alias("error_message"),
        F.col("first_seen").alias("inserted_at"), F.col("user_id").cast("long").alias("seq"))


def found_publications(events: DataFrame, since: str) -> DataFrame:
    """Publications found on reads pages from ``since`` on: one row per view
    event, later rows rename the publication; large values carry a feed URL."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).where(
        (F.col("event_type") == "view") & (F.col("ts") >= F.lit(since).cast("timestamp")))
    url = _pub_url(F.col("user_id"))
    return e.select(
        F.col("event_id").alias("seq"), url.alias("publication_url"),
        F.concat(F.lit("Publication "), F.col("user_id").cast("string"), F.lit(" #"), F.col("event_id").cast("string"))
        .alias("publication_name"),
        F.when(F.col("value") > 100, F.concat(url, F.lit("rss"))).alias("rss_url"),
        F.lit(SOURCE_PROFILE).alias("discovered_from_profile"))


def source_check_rows(events: DataFrame) -> DataFrame:
    """G4 input: every source check as a monitor result."""
    c = checks(events).where(F.col("kind") == "source")
    return c.select(F.col("target").alias("publication_url"), "checked_at", F.col("ok").alias("success"),
                    F.lit("rss").alias("monitor_method"), F.col("error").alias("error_message"),
                    error_type(F.col("error")).alias("error_type"), "seq")
