"""Registered queries, part 3: what readers and writers give back (A1-A4, A11, K2) and the errors of a run."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import extract, health, outputs, partials, registry
from ..session import cut_lineage, ensure_checkpoint_dir
from ..sources import commits, io
from . import inputs as I
from .catalog import _CANON_ROWS_SQL, _FEED_ITEMS_SQL, _PUB_URL, _RANKED, ORACLES, _page_articles_sql, _page_canonical_rows, _t, register
from .catalog_ops import _BATCH_SQL, _batch_articles, _markdown_sql, _reg_out, _run_config


def _folder(spark, name):
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


# ---------------------------------------------------------------- A1, A2: landed pages and feeds

def _landed_pages_spark(spark, sf):
    """A1: pages landed in a folder, read with the fixed schema; their fields by C1 and C2."""
    path = _folder(spark, "landed-pages")
    _t(spark, sf, "pages").withColumn("fetched_by", F.lit("crawler")).write.parquet(path)
    return extract.page_fields(io.read_pages(spark, path)).select("canonical_url", F.col("page_title").alias("title"), "content_hash", "fetch_status")


register("landed_pages", f"SELECT canonical_url, title, content_hash, fetch_status FROM {_page_articles_sql()}")(_landed_pages_spark)


def _landed_feeds_spark(spark, sf):
    """A2: feed documents landed in a folder, read with the fixed schema and parsed."""
    path = _folder(spark, "landed-feeds")
    I.feeds(_t(spark, sf, "pages")).write.parquet(path)
    items, _ = extract.parse_feeds(io.read_feeds(spark, path), 5, I.RUN_ISO)
    return items.select("pos", "source_url", "article_url", "title_hint", "source_label", "discovered_via")


register("landed_feeds", f"SELECT pos, source_url, article_url, title_hint, source_label, discovered_via FROM {_FEED_ITEMS_SQL}")(_landed_feeds_spark)


# ---------------------------------------------------------------- A4: state written by older versions

def _state_read_back_spark(spark, sf):
    """A4: a registry whose files differ in their columns, as older versions wrote them, read as one (G8 adds the defaults)."""
    path = _folder(spark, "older-state")
    old = I.registry_from_events(_t(spark, sf, "events"))
    gone = ("monitor_status", "monitor_method", "expiry_after_days", "is_active")
    old.where("seq % 2 = 1").drop(*gone).write.parquet(path)
    old.where("seq % 2 = 0").drop("is_active").write.mode("append").parquet(path)
    read = io.read_state(spark, path, registry.empty_registry(spark).schema)
    out = registry.with_registry_defaults(read, 45)
    return out.select("publication_url", "seq", *gone, F.col("last_checked").isNull().alias("never_checked"))


register("state_read_back", ORACLES["registry_defaults"])(_state_read_back_spark)


# ---------------------------------------------------------------- A3, K2: seed files

def _seed_files_spark(spark, sf):
    """K2: seed documents (JSON, many publications each) read (A3) and imported into the registry of a commit, twice."""
    from .jobs import import_seeds
    base = _folder(spark, "seed-files")
    feeds = I.feeds(_t(spark, sf, "pages"))
    docs = feeds.groupBy(F.floor(F.col("seq") / (20 * I.CHUNK)).alias("doc")).agg(
        F.collect_list(F.struct(F.col("publication_name").alias("name"), F.concat("publication_url", F.lit("?utm_source=seed")).alias("url"))).alias("publications"))
    docs.select(F.to_json(F.struct("publications"))).write.option("maxRecordsPerFile", 1).text(f"{base}/seeds")
    for _ in range(2):  # importing is an upsert: the second time changes nothing
        import_seeds(spark, f"{base}/seeds", base, _run_config("manual_seed"))
    reg = commits.current(spark, base).read("state/registry")
    return reg.select("publication_url", "publication_name", "rss_url", "discovered_from_profile", "monitor_status", "expiry_after_days", "is_active")


register("seed_files", f"""
SELECT DISTINCT {_PUB_URL} AS publication_url, host AS publication_name, {_PUB_URL} || '/feed' AS rss_url,
       '{I.SOURCE_PROFILE}' AS discovered_from_profile, 'pending' AS monitor_status, 30 AS expiry_after_days, true AS is_active
FROM {_RANKED}""")(_seed_files_spark)


# ---------------------------------------------------------------- A11: digest files

def _digest_files_spark(spark, sf):
    """The Markdown files of all run dates, read back line by line."""
    path = _folder(spark, "digest-files")
    arts = cut_lineage(_batch_articles(spark, sf))  # for the groups and for the rows
    io.write_markdown(outputs.markdown_blocks(arts, arts.select("run_date").distinct(), intro=outputs.DEFAULT_INTRO), path)
    return spark.read.schema("value string, run_date string").text(path).select("run_date", F.col("value").alias("line"))


register("digest_files", f"""
SELECT run_date, unnest(string_split(text, chr(10))) AS line
FROM ({_markdown_sql(f"(SELECT * FROM {_BATCH_SQL})", "UNION SELECT DISTINCT run_date FROM " + _BATCH_SQL, intro=outputs.DEFAULT_INTRO)})""")(_digest_files_spark)


# ---------------------------------------------------------------- E1: errors of a run

def _run_errors_spark(spark, sf):
    """One row for each item of the run that failed."""
    rows = _page_canonical_rows(spark, sf).withColumn("run_id", F.col("run_date"))
    return health.run_errors(rows)


register("run_errors", f"""
SELECT run_date AS run_id, seq, concat_ws(': ', article_url, error_message) AS error
FROM {_CANON_ROWS_SQL} WHERE processing_status = 'failed_extraction'""")(_run_errors_spark)


# ---------------------------------------------------------------- E2, E5, G4 from daily partials

def _recorded_days(spark, sf, name):
    """Daily partials of all checks, recorded in three commits; the third one records its days a second time."""
    base = _folder(spark, name)
    events = _t(spark, sf, "events")
    day = lambda df: df.withColumn("day", F.date_format("checked_at", "yyyy-MM-dd"))
    runs, publications = day(I.checks(events)), day(I.source_check_rows(events))
    for n, days in enumerate(("day < '2024-01-11'", "day >= '2024-01-11' and day < '2024-01-21'", "day >= '2024-01-21'", "day >= '2024-01-21'")):
        tx = commits.begin(spark, base, f"days-{min(n, 2)}")
        partials.record_days(tx, runs.where(days), publications.where(days))
        state = tx.commit()
    return events, state


def _run_checks_spark(spark, sf):
    """E2 and E5 of all runs, merged from the partials of their days."""
    merged = partials.runs(_recorded_days(spark, sf, "run-partials")[1])
    return partials.preflight_status(merged).join(partials.check_counts(merged), "run_id", "left")


register("run_checks_merged", f"""
SELECT * FROM ({ORACLES['preflight_status']}) LEFT JOIN ({ORACLES['check_counts']}) USING (run_id)""")(_run_checks_spark)


def _mark_checked_merged_spark(spark, sf):
    """G4 from the partials of all days."""
    events, state = _recorded_days(spark, sf, "publication-partials")
    return _reg_out(partials.mark_checked(I.registry_from_events(events), state))


register("mark_checked_merged", ORACLES["mark_checked"])(_mark_checked_merged_spark)
