"""Output builders.

Flat tables are the primary outputs.  The Markdown digest is produced as
ordered text blocks -- one row for the header, one per publication heading
and one per article -- with explicit sort keys; the writer (A11) range-sorts
them, so no run or publication is ever gathered into one string in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.status import PUBLISHABLE_STATUSES, with_freshness
from ..functions.text import clean_whitespace

# Output column sets and texts.
SCHEMA_VERSION = "1.0"
DIGEST_COLUMNS = ["article_id", "title", "canonical_url", "publication", "published_at", "summary_short",
                  "summary_bullets", "key_takeaway", "processing_status", "data_freshness"]
FEED_COLUMNS = [("article_id", "id"), ("title", "title"), ("canonical_url", "url"), ("publication", "publication"),
                ("author", "author"), ("summary_short", "summary"), ("summary_status", "summary_status"),
                ("scraped_at", "scraped_at"), ("processing_status", "processing_status"),
                ("topic_tags", "topic_tags"), ("data_freshness", "data_freshness")]
UNKNOWN_PUBLICATION = "Unknown Publication"
UNTITLED_ARTICLE = "Untitled Article"
NO_SUMMARY = "No summary available."
EMPTY_DIGEST_LINE = "No completed or partial articles were available for this run."
DEFAULT_TITLE = "# Daily Digest - {run_date}"
DEFAULT_INTRO = "Generated from public Reads activity."
FALLBACK_BANNER = "Current monitoring run degraded. Displaying last successful dataset."


def _opt(df: DataFrame, c: str, dtype: str = "string") -> Column:
    return F.col(c) if c in df.columns else F.lit(None).cast(dtype)


def publishable(df: DataFrame) -> DataFrame:
    """Rows with processing_status completed or partial."""
    return df.where(F.col("processing_status").isin(PUBLISHABLE_STATUSES))


def digest(articles: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """H2: the 10-column digest item view (plus ``keep`` columns)."""
    return articles.select(*keep, *[_opt(articles, c, "array<string>" if c == "summary_bullets" else "string")
                                    .alias(c) for c in DIGEST_COLUMNS])


def dashboard_feed(articles: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """H3: the 11-column dashboard feed (renamed id / url / summary)."""
    return articles.select(*keep, *[_opt(articles, src, "array<string>" if src == "topic_tags" else "string")
                                    .alias(dst) for src, dst in FEED_COLUMNS])


def article_count(articles: DataFrame, by: str = "run_date") -> DataFrame:
    """Article count per batch."""
    return articles.groupBy(by).agg(F.count(F.lit(1)).alias("article_count"))


def daily_batch_header(articles: DataFrame, runs: DataFrame | None = None, source_profile: str = "",
                       generated_at: str | None = None) -> DataFrame:
    """H1: one header row per run date (schema_version, run_id, run_date,
    source_profile, generated_at, article_count, status).

    ``status`` is ``completed_with_errors`` when any article failed.  The
    article rows themselves stay a flat table (see ``io.write_daily_batch``).
    """
    agg = articles.groupBy("run_date").agg(
        F.count(F.lit(1)).alias("article_count"),
        F.max((F.col("processing_status") == "failed_extraction").cast("int")).alias("_err"))
    if runs is not None:
        agg = runs.select("run_date", "run_id").join(agg, "run_date", "left")
    else:
        agg = agg.withColumn("run_id", F.col("run_date"))
    return agg.select(
        F.lit(SCHEMA_VERSION).alias("schema_version"), "run_id", "run_date",
        F.lit(source_profile).alias("source_profile"), F.lit(generated_at).cast("string").alias("generated_at"),
        F.coalesce(F.col("article_count"), F.lit(0)).alias("article_count"),
        F.when(F.coalesce(F.col("_err"), F.lit(0)) > 0, F.lit("completed_with_errors"))
        .otherwise(F.lit("completed")).alias("status"))


def articles_payload(articles: DataFrame, run_id: str | Column, run_status: str | Column,
                     freshness: str = "current") -> DataFrame:
    """H5: run id and status on every article, plus the freshness stamp."""
    rid = run_id if isinstance(run_id, Column) else F.lit(run_id)
    rst = run_status if isinstance(run_status, Column) else F.lit(run_status)
    return with_freshness(articles, freshness).withColumn("payload_run_id", rid).withColumn("payload_run_status", rst)


# --------------------------------------------------------------------------
# Grouped Markdown digest
# --------------------------------------------------------------------------

def group_key(publication) -> Column:
    """Cleaned publication name, blank -> ``Unknown Publication``."""
    return F.coalesce(F.nullif(clean_whitespace(F.coalesce(publication, F.lit(""))), F.lit("")),
                      F.lit(UNKNOWN_PUBLICATION))


def _article_block(df: DataFrame) -> Column:
    title = F.coalesce(F.nullif(clean_whitespace(F.coalesce(F.col("title"), F.lit(""))), F.lit("")),
                       F.lit(UNTITLED_ARTICLE))
    link = F.coalesce(F.nullif(F.col("canonical_url"), F.lit("")), F.nullif(_opt(df, "article_url"), F.lit("")),
                      F.lit("#"))
    summary = F.coalesce(F.nullif(clean_whitespace(F.coalesce(F.col("summary_short"), F.lit(""))), F.lit("")),
                         F.lit(NO_SUMMARY))
    blts = F.filter(F.transform(F.coalesce(F.col("summary_bullets"), F.array().cast("array<string>")),
                                clean_whitespace), lambda x: x != "")
    kt = clean_whitespace(F.coalesce(F.col("key_takeaway"), F.lit("")))
    bullet_lines = F.when(F.size(blts) > 0, F.concat(F.array(F.lit("")),
                                                     F.transform(blts, lambda b: F.concat(F.lit("- "), b))))
    kt_lines = F.when(kt != "", F.array(F.lit(""), F.concat(F.lit("**Key takeaway:** "), kt)))
    return F.concat_ws("\n", F.lit(""), F.concat(F.lit("### ["), title, F.lit("]("), link, F.lit(")")),
                       F.lit(""), summary, F.coalesce(bullet_lines, F.array().cast("array<string>")),
                       F.coalesce(kt_lines, F.array().cast("array<string>")))


MARKDOWN_COLUMNS = ["run_date", "section", "group_lower", "group_seq", "row_kind", "sort_published",
                    "sort_scraped", "seq", "text"]


def markdown_blocks(articles: DataFrame, runs: DataFrame | None = None, title: str = DEFAULT_TITLE,
                    intro: str = "", materialize: bool = True) -> DataFrame:
    """H4: the Markdown digest as ordered text blocks.

    Writing the ``text`` column in (run_date, section, group_lower, group_seq,
    row_kind, sort_published desc, sort_scraped desc, seq) order, one line
    per row, gives ``"\\n".join(lines).rstrip() + "\\n"`` of the digest.
    ``runs`` (run_date) adds header rows for runs without publishable rows.

    Each article block is rendered once into a narrow table; with
    ``materialize`` that table is checkpointed, so the upstream plan is not
    recomputed for the group, header and block branches that read it.
    Group ranks come from aggregates (partial aggregation, skew-safe).
    """
    pub = publishable(articles).withColumn("group_name", group_key(F.col("publication")))
    arts = pub.select(
        "run_date", "group_name", F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.nullif(F.col("published_at"), F.lit("")), F.lit("")).alias("sort_published"),
        F.coalesce(F.nullif(F.col("scraped_at"), F.lit("")), F.lit("")).alias("sort_scraped"),
        _article_block(pub).alias("text"))
    if materialize:
        from ..session import cut_lineage
        arts = cut_lineage(arts)
    groups = arts.groupBy("run_date", "group_name").agg(F.min("seq").alias("group_seq"))
    first = groups.groupBy("run_date").agg(
        F.min(F.struct(F.lower("group_name").alias("l"), F.col("group_seq").alias("s"))).alias("_first"))
    groups = (groups.join(first, "run_date")
              .withColumn("group_first", (F.lower("group_name") == F.col("_first.l"))
                          & (F.col("group_seq") == F.col("_first.s"))).drop("_first")
              .withColumn("group_lower", F.lower("group_name")))
    run_dates = arts.select("run_date").distinct()
    if runs is not None:
        run_dates = run_dates.unionByName(runs.select("run_date")).distinct()
    head_text = F.replace(F.lit(title), F.lit("{run_date}"), F.col("run_date"))
    if intro:
        head_text = F.concat(head_text, F.lit("\n\n" + intro))
    zero = F.lit(0).cast("long")
    header = run_dates.select("run_date", F.lit(0).alias("section"), F.lit("").alias("group_lower"),
                              zero.alias("group_seq"), F.lit(0).alias("row_kind"),
                              F.lit("").alias("sort_published"), F.lit("").alias("sort_scraped"),
                              zero.alias("seq"), head_text.alias("text"))
    empty_runs = run_dates.join(groups.select("run_date").distinct(), "run_date", "left_anti")
    empty = empty_runs.select("run_date", F.lit(1).alias("section"), F.lit("").alias("group_lower"),
                              zero.alias("group_seq"), F.lit(0).alias("row_kind"),
                              F.lit("").alias("sort_published"), F.lit("").alias("sort_scraped"),
                              zero.alias("seq"), F.lit("\n" + EMPTY_DIGEST_LINE).alias("text"))
    heading = groups.select(
        "run_date", F.lit(1).alias("section"), "group_lower", "group_seq", F.lit(0).alias("row_kind"),
        F.lit("").alias("sort_published"), F.lit("").alias("sort_scraped"), zero.alias("seq"),
        F.concat(F.when(F.col("group_first"), F.lit("\n")).otherwise(F.lit("\n\n")), F.lit("## "),
                 F.col("group_name")).alias("text"))
    blocks = arts.join(groups.select("run_date", "group_name", "group_lower", "group_seq"),
                       ["run_date", "group_name"]).select(
        "run_date", F.lit(1).alias("section"), "group_lower", "group_seq", F.lit(1).alias("row_kind"),
        "sort_published", "sort_scraped", "seq", "text")
    return header.unionByName(empty).unionByName(heading).unionByName(blocks)


def markdown_sort_order() -> list[Column]:
    return [F.col("run_date").asc(), F.col("section").asc(), F.col("group_lower").asc(), F.col("group_seq").asc(),
            F.col("row_kind").asc(), F.col("sort_published").desc(), F.col("sort_scraped").desc(),
            F.col("seq").asc()]
