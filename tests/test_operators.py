"""Operator semantics on small literal inputs (cases listed in FIXTURES.md)."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from feedlake.operators import dedupe, extract, health, outputs, registry, state, summarize

ARTICLE_HTML = """<!DOCTYPE html>
<html lang="en"><head>
  <title>Rates Outlook</title>
  <meta name="description" content="  A quick look at where rates may go.  " />
  <meta name="keywords" content="rates, , bonds ,outlook" />
  <meta content="Ada Writer" name="author" />
  <meta property='og:site_name' content='Bond Letters' />
  <meta property="article:published_time" content="2026-03-10T12:00:00Z" />
  <link rel="canonical" href="HTTPS://News.Example.com/p/rates-outlook/?utm_source=x" />
  <script>var s = "</article>";</script>
</head><body>
  <nav><a href="/about">About</a></nav>
  <!-- <article>hidden</article> -->
  <article>
    <p>Yields fell &amp; curves flattened.</p>
    <p>Investors <b>waited</b> for the next meeting.</p>
  </article>
</body></html>"""


def _items(spark, rows):
    return spark.createDataFrame(rows, "seq long, pos int, source_url string, article_url string, "
                                       "discovered_at string, title_hint string, source_label string, "
                                       "discovered_via string")


# --------------------------------------------------------------- C1/C2/C8

def test_article_extraction(spark):
    items = _items(spark, [(1, 0, "https://reads.example.com/@me/reads", "https://news.example.com/x?y=1",
                            "2026-03-11T00:00:00+00:00", "Hint", "Reads", "reads_direct")])
    fetched = spark.createDataFrame([("https://news.example.com/x?y=1", ARTICLE_HTML)], "url string, html string")
    row = extract.build_articles(items, fetched, "2026-03-11T00:00:00+00:00").first()
    assert row.canonical_url == "https://news.example.com/p/rates-outlook"
    assert row.title == "Rates Outlook"
    assert row.subtitle == "A quick look at where rates may go."
    assert row.author == "Ada Writer"
    assert row.publication == "Bond Letters"
    assert row.published_at == "2026-03-10T12:00:00Z"
    assert list(row.topic_tags) == ["rates", "bonds", "outlook"]
    assert row.body_text == "Yields fell & curves flattened. Investors waited for the next meeting."
    assert len(row.article_id) == 16
    assert row.fetch_status == "fetched"
    assert row.original_url == "https://news.example.com/x"


def test_body_falls_back_to_main_then_page(spark):
    df = spark.createDataFrame([(1, "<main><p>in main</p></main><p>out</p>"), (2, "<p>whole</p> page"),
                                (3, '<div data-testid="post-content"><p>post</p></div><p>x</p>')],
                               "id int, html string")
    got = {r.id: r.body_text for r in extract.extract_body(df).collect()}
    assert got == {1: "in main", 2: "whole page", 3: "post"}


# --------------------------------------------------------------- C4/C5

READS_HTML = """<html><body><main>
<a href="https://one.example.net/p/first-post?utm_source=feed">First</a>
<a href="https://one.example.net/p/first-post">First again</a>
<a href="/about">About</a>
<a href="/p/local-post">Local</a>
<a href="#top">Top</a>
<a href="https://two.example.com/">Two Pub</a>
<a href="https://reads.example.com/@someone">Someone</a>
</main></body></html>"""


def test_direct_articles_and_publications(spark):
    pages = spark.createDataFrame([(7, "https://reads.example.com/@me/reads", READS_HTML)],
                                  "page_id long, url string, html string")
    direct = [(r.article_url, r.title_hint) for r in
              extract.direct_articles(pages, "t").orderBy("pos").collect()]
    assert direct == [("https://one.example.net/p/first-post", "First"),
                      ("https://reads.example.com/p/local-post", "Local")]
    pubs = [(r.publication_url, r.publication_name, r.rss_url) for r in
            extract.discovered_publications(pages, "t").orderBy("pos").collect()]
    assert pubs == [("https://reads.example.com/@me/reads", "Top", "https://reads.example.com/@me/reads/feed"),
                    ("https://two.example.com/", "Two Pub", "https://two.example.com/feed"),
                    ("https://reads.example.com/@someone", "Someone", "https://reads.example.com/@someone/feed")]


def test_challenge_quarantine(spark):
    pages = spark.createDataFrame([(1, "u", "<title>Just a moment...</title>"), (2, "v", "<p>ok</p>")],
                                  "page_id long, url string, html string")
    clean, quarantine = extract.quarantine_challenges(pages)
    assert [r.page_id for r in clean.collect()] == [2]
    assert [r.page_id for r in quarantine.collect()] == [1]


# --------------------------------------------------------------- C7

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>Notes</title>
<item><title>Fed Holds</title><link>https://notes.example.com/p/fed-holds</link>
<pubDate>Tue, 10 Mar 2026 12:00:00 GMT</pubDate></item>
<item><title>No link</title><pubDate>Mon, 09 Mar 2026 12:00:00 GMT</pubDate></item>
<item><title>Third</title><link>https://notes.example.com/p/third</link></item>
</channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>A</title>
<entry><title>Atom One</title><link rel="alternate" href="https://a.example.com/p/one/"/>
<published>2026-03-10T12:00:00Z</published></entry></feed>"""


def test_parse_feeds(spark):
    feeds = spark.createDataFrame(
        [("https://notes.example.com", "Notes", RSS), ("https://a.example.com", "A", ATOM),
         ("https://bad.example.com", "Bad", "<rss><channel><item>"),
         ("https://empty.example.com", "Empty", "<rss><channel><title>x</title></channel></rss>")],
        "publication_url string, publication_name string, xml string")
    items, status = extract.parse_feeds(feeds, 2, "2026-03-11T00:00:00+00:00")
    got = sorted((r.source_url, r.article_url, r.discovered_at, r.title_hint, r.discovered_via) for r in items.collect())
    # Cut to 2 entries first, then drop the link-less one: only one RSS row remains.
    assert got == [
        ("https://a.example.com", "https://a.example.com/p/one", "2026-03-10T12:00:00Z", "Atom One", "publication_rss"),
        ("https://notes.example.com", "https://notes.example.com/p/fed-holds", "2026-03-10T12:00:00+00:00",
         "Fed Holds", "publication_rss")]
    ok = {r.publication_url: r.feed_ok for r in status.collect()}
    assert ok == {"https://notes.example.com": True, "https://a.example.com": True,
                  "https://bad.example.com": False, "https://empty.example.com": True}


# --------------------------------------------------------------- D1-D4

def _seq_fold(rows):
    urls, hashes, kept = set(), set(), []
    for seq, u, h in rows:
        if u in urls or (h is not None and h in hashes):
            continue
        kept.append(seq)
        urls.add(u)
        if h is not None:
            hashes.add(h)
    return kept


def test_dedupe_first_cases(spark):
    cases = [
        ([(1, "u1", "h1"), (2, "u1", "h2"), (3, "u3", "h2")], [1, 3]),
        ([(1, "u1", "h1"), (2, "u2", "h1"), (3, "u2", "h3")], [1, 3]),
        ([(1, "u1", "e"), (2, "u2", "e"), (3, "u3", "x")], [1, 3]),
    ]
    for rows, want in cases:
        df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string")
        assert sorted(r.seq for r in dedupe.dedupe_first(df).collect()) == want


def test_dedupe_first_matches_sequential_rule(spark):
    rng = random.Random(7)
    rows = [(i, f"u{rng.randint(0, 60)}", f"h{rng.randint(0, 60)}" if rng.random() > 0.05 else None)
            for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string")
    want = _seq_fold(rows)
    for bound in (None, 0, 30):  # one task, rounds only, and both
        assert sorted(r.seq for r in dedupe.dedupe_first(df, component_pairs=bound).collect()) == want, bound


def test_dedupe_first_splits_components(spark):
    """Many small components and one long chain: the small ones are settled apart, the chain in rounds."""
    small = [(10 * i + j, f"u{i}-{j // 2}", f"h{i}-{(j + 1) // 2}") for i in range(30) for j in range(6)]
    chain = [(1000 + i, f"u{(i + 1) // 2}", f"h{i // 2}") for i in range(40)]
    random.Random(5).shuffle(small)
    df = spark.createDataFrame(small + chain, "seq long, canonical_url string, content_hash string")
    want = _seq_fold(sorted(small + chain))
    for bound in (0, 6, 20, 39):
        assert sorted(r.seq for r in dedupe.dedupe_first(df, component_pairs=bound).collect()) == want, bound


def _count_checkpoints(monkeypatch):
    calls = []
    real = dedupe.cut_lineage
    monkeypatch.setattr(dedupe, "cut_lineage", lambda df: calls.append(1) or real(df))
    return calls


def test_dedupe_first_settles_groups_without_rounds(spark, monkeypatch):
    """Copies under one URL, and one text (the empty one, say) under many URLs, need no round."""
    calls = _count_checkpoints(monkeypatch)
    rows = [(i, f"u{i % 7}", f"h{i}") for i in range(70)] + [(100 + i, f"v{i}", "empty") for i in range(50)] + [(200 + i, "w", "hw") for i in range(20)]
    df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string")
    assert sorted(r.seq for r in dedupe.dedupe_first(df).collect()) == _seq_fold(rows)
    assert len(calls) == 3  # the input, the pairs and what is undecided: nothing


def test_dedupe_first_long_chain(spark, monkeypatch):
    """Each pair conflicts with the next by URL or by hash in turn: every second one stays."""
    calls = _count_checkpoints(monkeypatch)
    rows = [(i, f"u{(i + 1) // 2}", f"h{i // 2}") for i in range(10_000)]
    df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string").repartition(8)
    assert sorted(r.seq for r in dedupe.dedupe_first(df).collect()) == _seq_fold(rows) == list(range(0, 10_000, 2))
    assert len(calls) <= 5


def test_dedupe_first_against_seen(spark):
    rng = random.Random(3)
    rows = [(i, f"u{rng.randint(0, 40)}", f"h{rng.randint(0, 40)}") for i in range(200)]
    seen = spark.createDataFrame([(f"u{i}", f"h{i + 50}") for i in range(5)] + [("other", "h7")], "canonical_url string, content_hash string")
    df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string").withColumn("body", F.lit("x"))
    left = [r for r in rows if r[1] not in {f"u{i}" for i in range(5)} and r[2] != "h7"]
    assert sorted(r.seq for r in dedupe.dedupe_first(df, seen=seen).collect()) == _seq_fold(left)
    by_url = [(s, u, None) for s, u, _ in rows if u not in {f"u{i}" for i in range(5)}]
    assert sorted(r.seq for r in dedupe.dedupe_first(df, seen=seen, by_hash=False).collect()) == _seq_fold(by_url)


def test_dedupe_first_with_repeated_order(spark):
    rows = [(1, "u", "h"), (1, "u", "h"), (1, "u", "g"), (1, "v", "g"), (2, None, None), (2, None, None), (3, None, "h")]
    df = spark.createDataFrame(rows, "seq long, canonical_url string, content_hash string")
    got = sorted(((r.seq, r.canonical_url, r.content_hash) for r in dedupe.dedupe_first(df).collect()), key=repr)
    # (1, u, g) goes first and blocks u and g; the dropped (1, u, h) does not block h
    assert got == sorted([(1, "u", "g"), (2, None, None), (3, None, "h")], key=repr)


def test_filters_against_seen(spark):
    seen = spark.createDataFrame([("https://a.com/x", "id", "h1")], "canonical_url string, article_id string, "
                                                                   "content_hash string")
    cands = spark.createDataFrame([(1, "https://a.com/x", None), (2, "https://a.com/y", None)],
                                  "seq long, canonical_url string, article_url string")
    assert [r.seq for r in dedupe.filter_new(cands, seen).collect()] == [2]
    assert dedupe.filter_new(cands, seen, skip_existing=False).count() == 2
    arts = spark.createDataFrame([(1, "https://a.com/z", "h1"), (2, "https://a.com/w", "h2"),
                                  (3, "https://a.com/v", None)], "seq long, canonical_url string, content_hash string")
    assert sorted(r.seq for r in dedupe.filter_unseen(arts, seen).collect()) == [2, 3]
    assert sorted(r.seq for r in dedupe.filter_unseen(arts, seen, by_hash=False).collect()) == [1, 2, 3]


def test_merge_items_first_wins(spark):
    direct = _items(spark, [(1, 0, "s", "https://a.com/p/x/", "t", None, None, "reads_direct")])
    monitored = _items(spark, [(0, 0, "f", "https://a.com/p/x", "t", None, "Pub", "publication_rss"),
                               (0, 1, "f", "https://a.com/p/y", "t", None, "Pub", "publication_rss")])
    got = sorted((r.article_url, r.discovered_via) for r in dedupe.merge_items(direct, monitored).collect())
    assert got == [("https://a.com/p/x/", "reads_direct"), ("https://a.com/p/y", "publication_rss")]


# --------------------------------------------------------------- registry

def _reg(spark, rows):
    return registry.with_registry_defaults(spark.createDataFrame(rows, "publication_url string, "
                                                                       "last_seen_on_reads timestamp, "
                                                                       "expiry_after_days int"))


def test_expiry_rules(spark):
    import datetime as dt
    seen = dt.datetime(2026, 3, 1)
    reg = _reg(spark, [("https://a/", seen, 7), ("https://b/", None, 7),
                       ("https://c/", seen - dt.timedelta(seconds=1), 7)])
    on_5th = {r.publication_url: r.is_active for r in registry.expire(reg, "2026-03-05 00:00:00").collect()}
    on_20th = {r.publication_url: r.is_active for r in registry.expire(reg, "2026-03-20 00:00:00").collect()}
    exactly = {r.publication_url: r.is_active for r in registry.expire(reg, "2026-03-08 23:59:58").collect()}
    assert on_5th == {"https://a/": True, "https://b/": True, "https://c/": True}
    assert on_20th == {"https://a/": False, "https://b/": True, "https://c/": False}
    # 7 days 23:59:58 (a) and 7 days 23:59:59 (c) are both 7 whole days: active.
    assert exactly == {"https://a/": True, "https://b/": True, "https://c/": True}


def test_upserts_keep_and_clear_fields(spark):
    base = registry.empty_registry(spark)
    found = spark.createDataFrame([(1, "https://marketnotes.example.net/?x=1", "Market Notes", None, "p")],
                                  "seq long, publication_url string, publication_name string, rss_url string, "
                                  "discovered_from_profile string")
    reg = registry.upsert_from_reads(base, found, "2026-03-01 00:00:00")
    r = reg.first()
    assert r.publication_url == "https://marketnotes.example.net/"
    assert r.rss_url == "https://marketnotes.example.net/feed"
    assert r.monitor_status == "pending" and r.is_active
    checks = spark.createDataFrame([("https://marketnotes.example.net/", "2026-03-02 00:00:00", False, "rss",
                                     "403 Client Error: Forbidden", "http_403", 1)],
                                   "publication_url string, checked_at string, success boolean, monitor_method string,"
                                   " error_message string, error_type string, seq long") \
        .withColumn("checked_at", F.col("checked_at").cast("timestamp"))
    failed = registry.mark_checked(reg, checks).first()
    assert failed.monitor_status == "error" and failed.last_error_type == "http_403"
    assert failed.last_error_message == "403 Client Error: Forbidden" and failed.last_successful_check is None
    marked = registry.mark_checked(reg, checks)
    g2 = registry.upsert_publication(marked, found.withColumn("publication_name", F.lit("")), "2026-03-03 00:00:00")
    r2 = g2.first()
    assert r2.last_error_type == "http_403" and r2.last_error_message == "403 Client Error: Forbidden"
    assert r2.publication_name == "Market Notes"
    assert str(r2.last_seen_on_reads).startswith("2026-03-01")
    g1 = registry.upsert_from_reads(marked, found, "2026-03-04 00:00:00").first()
    assert g1.last_error_type == "http_403" and g1.last_error_message is None
    assert str(g1.last_seen_on_reads).startswith("2026-03-04")


def test_seed_aliases(spark):
    seeds = spark.createDataFrame([(0, None, "https://a.example.com/?ref=1", None, "A", None, None),
                                   (1, None, None, "Nameless", None, None, None)],
                                  "seq long, publication_url string, url string, publication_name string, "
                                  "name string, rss_url string, discovered_from_profile string")
    reg, rows = registry.import_publications(registry.empty_registry(spark), seeds, "https://p", "2026-03-01 00:00:00")
    assert rows.count() == 1
    r = reg.first()
    assert (r.publication_url, r.publication_name, r.discovered_from_profile) == ("https://a.example.com/", "A",
                                                                                  "https://p")


def test_recent_posts_fallback(spark):
    pubs = spark.createDataFrame([("p1", 1), ("p2", 2), ("p3", 3)], "publication_url string, seq long")
    feed_items = spark.createDataFrame([("p1", 0, "https://x/p/1")], "source_url string, pos int, article_url string")
    status = spark.createDataFrame([("p1", True, None), ("p2", True, None), ("p3", False, "parse error")],
                                   "publication_url string, feed_ok boolean, feed_error string")
    home = spark.createDataFrame([("p2", 0, "https://x/p/h2"), ("p3", 0, "https://x/p/h3")],
                                 "source_url string, pos int, article_url string")
    home_status = spark.createDataFrame([("p2", True, None), ("p3", True, None)],
                                        "publication_url string, home_ok boolean, home_error string")
    items, results = registry.recent_posts(pubs, feed_items, status, home, home_status)
    assert sorted(r.article_url for r in items.collect()) == ["https://x/p/1", "https://x/p/h3"]
    res = {r.publication_url: (r.success, r.monitor_method) for r in results.collect()}
    assert res == {"p1": (True, "rss"), "p2": (True, "rss"), "p3": (True, "html_fallback")}
    _, off = registry.recent_posts(pubs, feed_items, status, None, None, rss_enabled=False,
                                   html_fallback_enabled=False)
    assert {r.monitor_method for r in off.collect()} == {"disabled"}
    _, no_fb = registry.recent_posts(pubs, feed_items, status, None, None, html_fallback_enabled=False)
    assert {r.publication_url: r.success for r in no_fb.collect()}["p3"] is False


# --------------------------------------------------------------- I1

def test_summaries(spark):
    arts = spark.createDataFrame([("a", "One. Two! Three? Four."), ("b", "x"), ("c", ""), ("d", "y")],
                                 "article_id string, body_text string")
    resp = spark.createDataFrame([("a", "- first\n- second\n- third\n- fourth"), ("b", "   ")],
                                 "article_id string, output_text string")
    got = {r.article_id: r for r in summarize.summarize(arts, resp).collect()}
    assert got["a"].summary_status == "completed" and list(got["a"].summary_bullets) == ["first", "second", "third"]
    assert got["a"].key_takeaway == "first"
    assert got["b"].summary_status == "empty_response" and got["b"].summary_short == "x"
    assert got["c"].summary_status == "fallback" and got["c"].summary_short == "No summary available."
    assert got["d"].summary_status == "fallback"
    off = {r.article_id: r for r in summarize.summarize(arts, resp, enabled=False, include_bullets=False).collect()}
    assert off["a"].summary_status == "disabled" and list(off["a"].summary_bullets) == []
    assert off["a"].summary_short == "One. Two! Three?" and off["a"].key_takeaway == "One"


# --------------------------------------------------------------- H4 / A11

EXPECTED_DIGEST = """\
# Daily Digest - 2026-03-11

## Macro Notes

### [Newer](https://m/p/n)

S3

**Key takeaway:** k

### [Fed](https://m/p/fed)

Short.

- a
- b
- c

**Key takeaway:** a


## macro notes

### [Later](https://m/p/l)

S2


## Unknown Publication

### [Untitled Article](#)

No summary available.

- x
"""
EXPECTED_EMPTY = """\
# Daily Digest - 2026-03-12

No completed or partial articles were available for this run.
"""


def test_markdown_document(spark, tmp_path):
    rows = [
        dict(seq=0, run_date="2026-03-11", publication="Macro Notes", title="Fed", canonical_url="https://m/p/fed",
             published_at="2026-03-10T12:00:00Z", scraped_at="s", summary_short="Short.", summary_bullets=["a", "b", "c"],
             key_takeaway="a", processing_status="completed"),
        dict(seq=1, run_date="2026-03-11", publication=None, title=None, canonical_url=None, published_at=None,
             scraped_at="s", summary_short=None, summary_bullets=["x", " "], key_takeaway=None,
             processing_status="partial"),
        dict(seq=2, run_date="2026-03-11", publication="Blocked", title="Nope", canonical_url="https://b/p/n",
             published_at=None, scraped_at="s", summary_short=None, summary_bullets=[], key_takeaway=None,
             processing_status="failed_extraction"),
        dict(seq=3, run_date="2026-03-11", publication="macro notes", title="Later", canonical_url="https://m/p/l",
             published_at="2026-03-11T00:00:00Z", scraped_at="s", summary_short="S2", summary_bullets=[],
             key_takeaway="", processing_status="completed"),
        dict(seq=4, run_date="2026-03-11", publication="Macro Notes", title="Newer", canonical_url="https://m/p/n",
             published_at="2026-03-12T00:00:00Z", scraped_at="s", summary_short="S3", summary_bullets=[],
             key_takeaway="k", processing_status="completed"),
    ]
    schema = ("seq long, run_date string, publication string, title string, canonical_url string, "
              "published_at string, scraped_at string, summary_short string, summary_bullets array<string>, "
              "key_takeaway string, processing_status string")
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in schema.split(", ")) for r in rows], schema)
    runs = spark.createDataFrame([("2026-03-11",), ("2026-03-12",)], "run_date string")
    blocks = outputs.markdown_blocks(df, runs)
    ordered = blocks.orderBy(*outputs.markdown_sort_order()).collect()
    for run_date, want in (("2026-03-11", EXPECTED_DIGEST), ("2026-03-12", EXPECTED_EMPTY)):
        text = "\n".join(r.text for r in ordered if r.run_date == run_date) + "\n"
        assert text == want
    from feedlake.sources import io
    io.write_markdown(blocks, str(tmp_path / "md"))
    files = sorted((tmp_path / "md" / "run_date=2026-03-12").glob("part-*"))
    assert "".join(f.read_text() for f in files) == EXPECTED_EMPTY


# --------------------------------------------------------------- F6 / G6

def test_display_fallback(spark):
    runs = spark.createDataFrame([
        ("r0", "2026-03-01 00:00:00", "degraded"),   # no earlier healthy run: empty fallback
        ("r1", "2026-03-02 00:00:00", "healthy"),
        ("r2", "2026-03-03 00:00:00", "degraded"),   # empty -> r1's rows
        ("r3", "2026-03-04 00:00:00", "degraded"),   # has rows -> current
        ("r4", "2026-03-05 00:00:00", "healthy"),    # empty, still promoted
        ("r5", "2026-03-06 00:00:00", "degraded"),   # -> r4 (empty)
        ("r6", "2026-03-07 00:00:00", "failed"),     # failed -> current
    ], "run_id string, started_at string, run_status string").withColumn("source_profile", F.lit("p"))
    arts = spark.createDataFrame([("r1", "a1"), ("r1", "a2"), ("r3", "a3")], "run_id string, article_id string")
    counts = arts.groupBy("run_id").agg(F.count(F.lit(1)).alias("article_count"))
    choice = {r.run_id: (r.display_run_id, r.data_freshness, r.banner_message is not None)
              for r in health.display_choice(runs, counts).collect()}
    assert choice["r0"] == (None, "last_successful_fallback", True)
    assert choice["r2"] == ("r1", "last_successful_fallback", True)
    assert choice["r3"] == ("r3", "current", False)
    assert choice["r5"] == ("r4", "last_successful_fallback", True)
    assert choice["r6"] == ("r6", "current", False)
    shown = health.display_payload(runs, arts, shown=runs)
    assert {r.shown_for_run for r in health.display_payload(runs, arts).collect()} == set()  # r6, the latest, is empty
    assert sorted(r.article_id for r in shown.where("shown_for_run = 'r2'").collect()) == ["a1", "a2"]
    assert shown.where("shown_for_run = 'r5'").count() == 0


def test_merge_index_keeps_position(spark):
    index = spark.createDataFrame([("a", 0, "old-a", "2026-03-01", 0), ("b", 1, "old-b", "2026-03-01", 1)],
                                  "article_id string, seq long, title string, first_run_date string, first_seq long")
    batch = spark.createDataFrame([("c", 0, "new-c"), ("a", 1, "new-a")], "article_id string, seq long, title string")
    got = state.merge_index(index, batch, "2026-03-02").orderBy("first_run_date", "first_seq").collect()
    assert [(r.article_id, r.title) for r in got] == [("a", "new-a"), ("b", "old-b"), ("c", "new-c")]


def test_parser_body_path(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    regex = extract.extract_body(pages, out_col="a")
    both = extract.extract_body(regex, out_col="b", method="parser")
    assert both.where("a <> b").count() == 0
    nested = spark.createDataFrame([(1, "<article><p>a<article><p>b</p></article><p>c &#8212; d</article>x")],
                                   "id int, html string")
    row = extract.extract_body(nested, method="parser").first()
    assert row.body_text == "a b c — d"
