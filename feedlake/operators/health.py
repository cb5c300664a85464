"""Run health, fallback display and run history.

Check results arrive as a table (``checks``: run_id, seq, kind dns/http/source,
target, ok, status_code, error, checked_at).  Per-run roll-ups are grouped
aggregates with partial aggregation; the run history is one row per run and
per source profile, the only place a window spans many rows in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .extract import link_counts
from .outputs import FALLBACK_BANNER, dashboard_feed, digest

# Warnings and stage names.
WARN_DNS = "DNS resolution failed for required external domains."
WARN_PREFLIGHT = "Preflight checks failed."
WARN_NO_SOURCES = "No sources could be checked successfully."


def check_counts(checks: DataFrame, by: str = "run_id") -> DataFrame:
    """Attempted / succeeded / failed source checks per run."""
    src = checks.where(F.col("kind") == "source")
    return src.groupBy(by).agg(
        F.count(F.lit(1)).alias("source_checks_attempted"),
        F.count_if(F.col("ok")).alias("source_checks_succeeded"),
        F.count_if(~F.col("ok")).alias("source_checks_failed"))


def _failed(kind: str) -> Column:
    return F.max(((F.col("kind") == kind) & ~F.col("ok")).cast("int"))


def _stage() -> Column:
    return F.when(F.col("_dns_fail") == 1, F.lit("preflight_dns")).when(F.col("_http_fail") == 1, F.lit("preflight_http"))


def preflight_status(checks: DataFrame, by: str = "run_id") -> DataFrame:
    """E5: any DNS failure -> degraded/preflight_dns; else any HTTP failure
    -> degraded/preflight_http; else ok."""
    return preflight_from_flags(checks.groupBy(by).agg(_failed("dns").alias("_dns_fail"), _failed("http").alias("_http_fail")), by)


def preflight_from_flags(flags: DataFrame, by: str = "run_id") -> DataFrame:
    """Status and stage from the two flags of each run."""
    return flags.select(by, F.when(_stage().isNotNull(), F.lit("degraded")).otherwise(F.lit("ok")).alias("core_status"),
                      _stage().alias("failure_stage"))


def discovery_status(succeeded, failed) -> tuple[Column, Column]:
    """succeeded = 0 and failed > 0 -> (degraded, discovery)."""
    bad = (succeeded == 0) & (failed > 0)
    return (F.when(bad, F.lit("degraded")).otherwise(F.lit("ok")),
            F.when(bad, F.lit("discovery")))


def final_status(internal_error, degraded) -> Column:
    """Internal error -> failed; degraded -> degraded; else healthy."""
    return (F.when(internal_error, F.lit("failed")).when(degraded, F.lit("degraded"))
            .otherwise(F.lit("healthy")))


def run_status(checks: DataFrame, by: str = "run_id", internal: DataFrame | None = None) -> DataFrame:
    """E5 -> E6 -> E7 per run, with the caller's rule that a run where no
    source check succeeded is degraded too (even with zero checks).

    ``internal`` (``by``, error) names runs that an unexpected error ended:
    they are ``failed`` at stage ``internal``, whatever their checks say.  One
    aggregation gives the preflight stage and the counts.
    """
    source = F.col("kind") == "source"
    j = checks.groupBy(by).agg(
        _failed("dns").alias("_dns_fail"), _failed("http").alias("_http_fail"),
        F.count_if(source).alias("source_checks_attempted"),
        F.count_if(source & F.col("ok")).alias("source_checks_succeeded"),
        F.count_if(source & ~F.col("ok")).alias("source_checks_failed"))
    j = j.withColumn("failure_stage", _stage()) \
        .withColumn("core_status", F.when(F.col("failure_stage").isNotNull(), F.lit("degraded")).otherwise(F.lit("ok")))
    if internal is not None:
        errors = internal.groupBy(by).agg(F.min("error").alias("_error"), F.lit(True).alias("_internal"))
        j = j.join(errors, by, "full_outer").na.fill(0, ["source_checks_attempted", "source_checks_succeeded", "source_checks_failed"])
    else:
        j = j.withColumn("_error", F.lit(None).cast("string")).withColumn("_internal", F.lit(False))
    crashed = F.coalesce(F.col("_internal"), F.lit(False))
    pre_bad = F.coalesce(F.col("core_status") == "degraded", F.lit(False))
    disc_state, disc_stage = discovery_status(F.col("source_checks_succeeded"), F.col("source_checks_failed"))
    disc_bad = (disc_state == "degraded") | (F.col("source_checks_succeeded") == 0)
    degraded = pre_bad | disc_bad
    warnings = (F.when(crashed & ~pre_bad, F.array().cast("array<string>"))
                .when(F.col("failure_stage") == "preflight_dns", F.array(F.lit(WARN_DNS)))
                .when(pre_bad, F.array(F.lit(WARN_PREFLIGHT)))
                .when(disc_bad, F.array(F.lit(WARN_NO_SOURCES)))
                .otherwise(F.array().cast("array<string>")))
    # Preflight failures stop the run before discovery: counters stay 0.
    zero_if_pre = lambda c: F.when(pre_bad, F.lit(0)).otherwise(F.col(c)).cast("long")
    return j.select(
        by,
        final_status(crashed, degraded).alias("run_status"),
        F.when(crashed, F.lit("internal")).when(pre_bad, F.col("failure_stage")).when(disc_bad, F.coalesce(disc_stage, F.lit("discovery")))
        .alias("failure_stage"),
        zero_if_pre("source_checks_attempted").alias("source_checks_attempted"),
        zero_if_pre("source_checks_succeeded").alias("source_checks_succeeded"),
        zero_if_pre("source_checks_failed").alias("source_checks_failed"),
        warnings.alias("warnings"))


def run_manifest(direct: DataFrame, selected: DataFrame, fetched: DataFrame, summaries: DataFrame,
                 failed: DataFrame, by: str = "run_id") -> DataFrame:
    """Counters per run, each from the step that it counts.

    ``direct``: direct links as discovered, before merge, filter and limit;
    ``selected``: candidates after them; ``fetched``: pages fetched, duplicates
    found afterwards included; ``summaries``: articles summarised; ``failed``:
    items whose fetch or extraction failed.  Only ``by`` of each is read.
    """
    steps = {"reads_discovered": direct, "articles_selected": selected, "articles_fetched": fetched,
             "summaries_created": summaries, "error_count": failed}
    counted = None
    for name, df in steps.items():
        part = df.select(by, F.lit(name).alias("_step"))
        counted = part if counted is None else counted.unionByName(part)
    j = counted.groupBy(by).agg(*[F.count_if(F.col("_step") == name).alias(name) for name in steps])
    return j.withColumn("status", F.when(F.col("error_count") > 0, F.lit("completed_with_errors"))
                        .otherwise(F.lit("completed")))


def run_errors(articles: DataFrame, by: str = "run_id") -> DataFrame:
    """E1 errors list as a flat table (one row per failed item)."""
    return articles.where(F.col("processing_status") == "failed_extraction").select(
        by, "seq", F.concat_ws(": ", F.col("article_url"), F.col("error_message")).alias("error"))


def discovery_blocked(reads_pages: DataFrame, base_col: str = "url", html_col: str = "html",
                      seq_col: str = "page_id") -> DataFrame:
    """A reads page is blocked when a debug snapshot was taken (challenge
    page, or nothing found) and it yielded no publications and no direct
    links.  All of it is decided inside the page's row: one parse, no shuffle."""
    seen = link_counts(reads_pages, base_col, html_col, seq_col)
    nothing = (F.col("direct_links") == 0) & (F.col("publication_links") == 0)
    snapshot = F.col("is_challenge") | nothing
    return seen.select("seq", snapshot.alias("snapshot_taken"), (snapshot & nothing).alias("discovery_blocked"))


def display_choice(runs: DataFrame, article_counts: DataFrame, profile_col: str = "source_profile",
                   order_col: str = "started_at", run_col: str = "run_id") -> DataFrame:
    """Which dataset each run shows.

    healthy, or current run has rows -> the current run; degraded and empty
    -> the last run promoted before (healthy runs are always promoted, even
    empty), stamped ``last_successful_fallback`` with the banner; failed ->
    current.  ``display_run_id`` is NULL when no healthy run exists yet
    (an empty fallback).

    The window has one partition per profile, of one small row per run.
    """
    w = (Window.partitionBy(profile_col).orderBy(F.col(order_col).asc(), F.col(run_col).asc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    r = runs.join(article_counts, run_col, "left").withColumn("article_count", F.coalesce("article_count", F.lit(0)))
    r = r.withColumn("_last_healthy", F.last(F.when(F.col("run_status") == "healthy", F.col(run_col)),
                                             ignorenulls=True).over(w))
    fallback = (F.col("run_status") == "degraded") & (F.col("article_count") == 0)
    return r.select(
        "*",
        F.when(fallback, F.col("_last_healthy")).otherwise(F.col(run_col)).alias("display_run_id"),
        F.when(fallback, F.lit("last_successful_fallback")).otherwise(F.lit("current")).alias("data_freshness"),
        F.when(fallback, F.lit(FALLBACK_BANNER)).alias("banner_message"),
        (F.col("run_status") == "healthy").alias("promoted"),
    ).drop("_last_healthy")


def latest_runs(runs: DataFrame, profile_col: str = "source_profile", order_col: str = "started_at",
                run_col: str = "run_id") -> DataFrame:
    """The run that is on display for each profile: the one started last."""
    return runs.groupBy(profile_col).agg(F.max(F.struct(order_col, run_col)).alias("_l")) \
        .select(F.col("_l")[run_col].alias(run_col))


def display_payload(runs: DataFrame, articles: DataFrame, run_col: str = "run_id",
                    shown: DataFrame | None = None, **kw) -> DataFrame:
    """article rows that the run on display shows (with freshness and banner).

    ``shown`` (``run_col``) names the runs to show, by default each profile's
    latest.  Rows are only copied for those: any number of earlier degraded
    runs may point to the same healthy run, and :func:`display_choice` keeps
    that pointer for every run without touching article rows.
    """
    counts = articles.groupBy(run_col).agg(F.count(F.lit(1)).alias("article_count"))
    choice = display_choice(runs, counts, run_col=run_col, **kw)
    shown = latest_runs(runs, run_col=run_col, **{k: v for k, v in kw.items() if k != "run_col"}) if shown is None else shown.select(run_col).distinct()
    c = choice.join(shown, run_col, "left_semi").select(
        F.col(run_col).alias("shown_for_run"), "run_status", "display_run_id", "data_freshness", "banner_message")
    a = articles.drop("data_freshness")
    j = c.join(a, c["display_run_id"] == a[run_col], "inner")
    return j.drop(run_col)


def consumer_outputs(runs: DataFrame, articles: DataFrame, run_col: str = "run_id", **kw) -> dict[str, DataFrame]:
    """H6: latest batch rows, digest and dashboard feed as displayed for each
    run, each with the banner column when falling back."""
    shown = display_payload(runs, articles, run_col=run_col, **kw)
    keys = ("shown_for_run", "banner_message")
    return {"articles": shown, "digest": digest(shown, keys), "dashboard_feed": dashboard_feed(shown, keys)}


def promote_latest(run: DataFrame, payload: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(current, last_successful) -- the current payload is always
    written; it becomes the last successful one only for a healthy run, even
    with zero articles.  ``run`` is the 1-row run state."""
    healthy = run.where(F.col("run_status") == "healthy").select("run_id")
    return payload, payload.join(healthy, "run_id", "left_semi")


def reads_source_row(checks: DataFrame, reads_host: str, profile_url: str, by: str = "run_id",
                     reads_name: str = "Reads profile", blocked: DataFrame | None = None) -> DataFrame:
    """The extra health row of the reads profile for every run.

    Status ok unless a preflight stage failed or discovery was blocked
    (``blocked`` names those runs); the error type follows the
    failed stage (dns -> dns_failure; http -> http_403 when the first failed
    http check on the reads host returned 403, else http_failure); the
    message is that check's error or, if that is blank, ``HTTP <code>``.
    """
    on_host = F.col("target").contains(reads_host) & ~F.col("ok")
    j = checks.groupBy(by).agg(
        _failed("dns").alias("_dns_fail"), _failed("http").alias("_http_fail"),
        F.min(F.when((F.col("kind") == "dns") & on_host, F.struct("seq", "error"))).alias("_dns"),
        F.min(F.when((F.col("kind") == "http") & on_host, F.struct("seq", "status_code", "error"))).alias("_http"),
        F.min("checked_at").alias("_started"))
    if blocked is not None:
        j = j.join(blocked.select(by, F.lit(True).alias("_blocked")).distinct(), by, "left")
    else:
        j = j.withColumn("_blocked", F.lit(None).cast("boolean"))
    stage = _stage()
    etype = (F.when(stage == "preflight_dns", F.lit("dns_failure"))
             .when(stage == "preflight_http", F.when(F.col("_http.status_code") == 403, F.lit("http_403"))
                   .otherwise(F.lit("http_failure"))))
    emsg = (F.when(stage == "preflight_dns", F.nullif(F.col("_dns.error"), F.lit("")))
            .when(stage == "preflight_http", F.coalesce(
                F.nullif(F.col("_http.error"), F.lit("")),
                F.when(F.col("_http").isNotNull(), F.concat(F.lit("HTTP "), F.col("_http.status_code").cast("string"))))))
    good = stage.isNull() & ~F.coalesce(F.col("_blocked"), F.lit(False))
    status = F.when(good, F.lit("ok")).otherwise(F.lit("error"))
    return j.select(
        by, F.lit(reads_name).alias("name"), F.lit(profile_url).alias("url"), status.alias("monitor_status"),
        F.when(good, F.col("_started")).alias("last_successful_check"),
        F.col("_started").alias("last_attempted_check"), etype.alias("last_error_type"),
        emsg.alias("last_error_message"))
