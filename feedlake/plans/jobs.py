"""Whole jobs (D9, K1-K4) composed from the operators.

Control flow that the reference runs as eager Python -- the discovery mode,
the preflight gate, dry run -- is decided on the driver from job arguments
or from one aggregated row; the data work itself is a DataFrame plan.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..operators import dedupe, extract, health, outputs, registry, state, summarize
from ..operators.seen import SeenSet
from ..session import cut_lineage
from ..sources import commits, io


@dataclass
class RunConfig:
    """Job arguments, with their bounds.  ``run_ts`` is the run's start in UTC; dates and ids are in ``run_zone``."""
    run_ts: str
    source_profile: str
    discovery_mode: str = "live_reads"
    dry_run: bool = False
    article_fetch_limit: int | None = 10        # None: no per-run limit
    max_posts_per_publication: int = 5
    max_publications_per_run: int | None = 20   # None: every active publication
    expiry_days: int = 30
    max_input_chars: int = 12000
    summaries_enabled: bool = True
    include_bullets: bool = True
    skip_existing: bool = True
    dedupe_enabled: bool = True
    dedupe_by_hash: bool = True
    rss_enabled: bool = True
    html_fallback_enabled: bool = True
    source_label: str | None = None
    model: str | None = None
    reads_enabled: bool = True
    run_zone: str = "UTC"

    def __post_init__(self):
        limits = [self.article_fetch_limit, self.max_posts_per_publication, self.max_publications_per_run]
        if any(x is not None and x < 1 for x in limits):
            raise ValueError("limits must be >= 1")
        if self.expiry_days < 1:
            raise ValueError("expiry must be >= 1")
        if self.max_input_chars < 1000:
            raise ValueError("max_input_chars must be >= 1000")

    @property
    def run_iso(self) -> str:
        return self.run_ts.replace(" ", "T") + "+00:00"

    @property
    def _local(self) -> datetime:
        return datetime.fromisoformat(self.run_ts).replace(tzinfo=timezone.utc).astimezone(ZoneInfo(self.run_zone))

    @property
    def run_date(self) -> str:
        return self._local.strftime("%Y-%m-%d")

    @property
    def run_id(self) -> str:
        return self._local.strftime("%Y%m%dT%H%M%S")

    @property
    def state_run_id(self) -> str:
        return self.run_ts.replace(" ", "T") + "Z"


def discovery(spark: SparkSession, cfg: RunConfig, reads_pages: DataFrame | None, reg: DataFrame,
              seeds: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(direct read items, found publications, registry) for the mode.

    ``live_reads`` parses the reads pages (C4 + C5, challenge pages go to
    quarantine), unless ``reads_enabled`` is off; ``manual_seed`` imports seeds (G3, then G1); and
    ``registry_only`` discovers nothing.  Any other mode is an error.
    """
    empty_items = spark.createDataFrame([], "seq long, pos int, source_url string, article_url string, "
                                            "discovered_at string, title_hint string, source_label string, "
                                            "discovered_via string")
    empty_pubs = spark.createDataFrame([], "seq long, publication_url string, publication_name string, "
                                           "rss_url string, discovered_from_profile string")
    if cfg.discovery_mode == "live_reads" and not cfg.reads_enabled:
        return empty_items, empty_pubs, reg
    if cfg.discovery_mode == "live_reads":
        clean, _quarantine = extract.quarantine_challenges(reads_pages)
        direct = extract.direct_articles(clean, cfg.run_iso, cfg.source_label)
        pubs = extract.discovered_publications(clean, cfg.run_iso)
        found = pubs.select("seq", "publication_url", "publication_name", "rss_url", "discovered_from_profile")
        return direct, found, registry.upsert_from_reads(reg, found, cfg.run_ts, cfg.expiry_days)
    if cfg.discovery_mode == "manual_seed":
        reg2, rows = registry.import_publications(reg, seeds, cfg.source_profile, cfg.run_ts, cfg.expiry_days)
        return empty_items, rows, registry.upsert_from_reads(reg2, rows, cfg.run_ts, cfg.expiry_days)
    if cfg.discovery_mode == "registry_only":
        return empty_items, empty_pubs, reg
    raise ValueError(f"Unsupported discovery mode: {cfg.discovery_mode}")


def run_daily(spark: SparkSession, cfg: RunConfig, *, reads_pages: DataFrame | None, fetched: DataFrame,
              feeds: DataFrame, homepages: DataFrame | None, responses: DataFrame | None,
              reg: DataFrame, seen: DataFrame | SeenSet, seeds: DataFrame | None = None) -> dict[str, DataFrame]:
    """K1: one daily run as a DataFrame plan (:func:`persist_run` writes it).

    ``fetched`` holds (url, html, error) of fetched (normalised) article URLs:
    a non-NULL error marks a failed fetch, a selected item without any fetched
    row fails with "page was not fetched".  Of several rows for one URL a page
    goes before an error, then the smallest html counts.  Returns the canonical
    articles, summaries, outputs and the new state tables; a seen-set in buckets
    is not among them, as :func:`persist_run` changes it in place.
    """
    fetched = fetched.groupBy("url").agg(F.min(F.struct(F.col("error").isNotNull().alias("bad"), "html", "error")).alias("f")) \
        .select("url", "f.html", "f.error")
    direct, found, reg = discovery(spark, cfg, reads_pages, reg, seeds)
    monitored_pubs = registry.top_publications(reg, cfg.run_ts, cfg.max_publications_per_run, cfg.expiry_days)
    feed_items, feed_status = extract.parse_feeds(feeds, cfg.max_posts_per_publication, cfg.run_iso)
    home_items = (extract.homepage_posts(homepages, cfg.max_posts_per_publication, cfg.run_iso)
                  if homepages is not None else None)
    home_status = (homepages.select("publication_url", F.lit(True).alias("home_ok"),
                                    F.lit(None).cast("string").alias("home_error"))
                   if homepages is not None else None)
    items, results = registry.recent_posts(monitored_pubs, feed_items, feed_status, home_items, home_status,
                                           cfg.rss_enabled, cfg.html_fallback_enabled, materialize=True)
    items = cut_lineage(items)  # narrow rows, read by the merge and by the raw sink
    reg = registry.mark_checked(reg, registry.check_rows(results, cfg.run_ts))
    # Run order of candidates: direct links first (page, anchor position),
    # then monitored posts in publication ranking (F1: last seen desc with
    # NULLs last, then insertion order) and feed position.  The key is a
    # struct of longs, so neither a window nor a global sort is needed.
    never = F.lit(2 ** 62)
    direct_o = direct.select(*extract.READ_ITEM_COLUMNS).withColumn("source_rank", F.lit(0)) \
        .withColumn("k1", F.col("seq").cast("long")).withColumn("k2", F.lit(0).cast("long")) \
        .withColumn("k3", F.lit(0).cast("long"))
    pubs_o = monitored_pubs.select(
        F.col("publication_url").alias("source_url"),
        F.coalesce(-F.unix_micros("last_seen_on_reads"), never).alias("k1"),
        F.coalesce(F.unix_micros("inserted_at"), never).alias("k2"), F.col("seq").cast("long").alias("k3"))
    monitored = (items.withColumn("seq", F.lit(0).cast("long")).select(*extract.READ_ITEM_COLUMNS)
                 .join(pubs_o, "source_url").withColumn("source_rank", F.lit(1)))
    order = ["source_rank", "k1", "k2", "k3", "pos"]
    both = direct_o.unionByName(monitored.select(*direct_o.columns)) \
        .withColumn("canonical_url", normalize_url(F.col("article_url")))
    merged = cut_lineage(dedupe.first_by_key(both, ["canonical_url"], order))  # narrow rows, for the lookup, the rest and the raw sink
    fresh = state.select_batch(dedupe.filter_new(merged, seen, cfg.skip_existing), cfg.article_fetch_limit, order)
    fresh = fresh.withColumn("seq", F.struct(*[F.col(c) for c in order])).drop("k1", "k2", "k3", "canonical_url")
    # The run's candidate batch feeds both the fetched articles and the failed
    # rows: materialise it once (discovery, monitoring and merge run once).
    fresh = cut_lineage(fresh)
    ok_pages = fetched.where(F.col("error").isNull())
    articles = fetched_articles = extract.build_articles(fresh, ok_pages, cfg.run_iso)
    errors = fetched.where(F.col("error").isNotNull()).select(F.col("url").alias("_u"), F.col("error").alias("_e"))
    failed = (fresh.join(ok_pages.select(F.col("url").alias("article_url")), "article_url", "left_anti")
              .join(errors, F.col("article_url") == F.col("_u"), "left")
              .withColumn("error", F.coalesce(F.col("_e"), F.lit("page was not fetched"))).drop("_u", "_e"))
    if cfg.dedupe_enabled:
        articles = dedupe.dedupe_first(articles, seen=seen, by_hash=cfg.dedupe_by_hash)
    summarized = summarize.summarize(articles, responses, cfg.summaries_enabled, cfg.include_bullets,
                                     cfg.max_input_chars, model=cfg.model, created_at=cfg.run_iso)
    canonical = extract.build_canonical(summarized, cfg.source_profile, cfg.run_date).unionByName(
        extract.build_failed(failed, cfg.source_profile, cfg.run_date, cfg.run_iso))
    new_seen = {} if isinstance(seen, SeenSet) else {"seen": state.remember(seen, articles)}
    return new_seen | {
        "direct": direct, "found": found, "registry": reg, "monitor_results": results,
        "raw_items": merged.select(*[c for c in extract.READ_ITEM_COLUMNS if c != "seq"]),
        "monitored_items": items.select(*[c for c in extract.READ_ITEM_COLUMNS if c in items.columns]),
        "candidates": fresh, "fetched_articles": fetched_articles, "failed": failed, "articles": articles, "summaries": summarized, "canonical": canonical,
        "digest": outputs.digest(canonical.withColumn("data_freshness", F.lit("current"))),
        "dashboard_feed": outputs.dashboard_feed(canonical.withColumn("data_freshness", F.lit("current"))),
        "batch_header": outputs.daily_batch_header(canonical, None, cfg.source_profile, cfg.run_iso),
    }


def load_registry(spark: SparkSession, base: str, cfg: RunConfig, state: commits.Snapshot | None = None) -> DataFrame:
    """The registry of the last committed run below ``base`` (or of ``state``)."""
    reg = (state or commits.current(spark, base)).read("state/registry")
    return registry.with_registry_defaults(registry.empty_registry(spark) if reg is None else reg, cfg.expiry_days)


def load_seen(spark: SparkSession, base: str) -> SeenSet:
    """The seen-set of the last committed run below ``base``."""
    return SeenSet(commits.current(spark, base))


def stored(df: DataFrame) -> DataFrame:
    """Cut a run's table from its plan, so that its several outputs don't compute it again."""
    return cut_lineage(df)


def manifest(out: dict[str, DataFrame], cfg: RunConfig, completed_at: str | None = None) -> DataFrame:
    """E1 for one run: counters of the steps, clocks and dry-run flag."""
    run = lambda df: df.select(F.lit(cfg.run_id).alias("run_id"))
    counts = health.run_manifest(run(out["direct"]), run(out["candidates"]), run(out["fetched_articles"]),
                                 run(out["summaries"]), run(out["failed"]))
    one = out["direct"].sparkSession.range(1).select(F.lit(cfg.run_id).alias("run_id"))  # a run without any row has a manifest, too
    numbers = ("reads_discovered", "articles_selected", "articles_fetched", "summaries_created", "error_count")
    joined = one.join(counts, "run_id", "left")
    return joined.select(
        "run_id", F.lit(cfg.run_date).alias("run_date"), F.lit(cfg.run_iso).alias("started_at"),
        F.lit(completed_at or cfg.run_iso).alias("completed_at"), F.lit(cfg.dry_run).alias("dry_run"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("status", F.lit("completed")).alias("status"))


def persist_run(spark: SparkSession, cfg: RunConfig, out: dict[str, DataFrame], base: str,
                completed_at: str | None = None, tx: commits.Transaction | None = None) -> dict[str, DataFrame]:
    """Write what one K1 run leaves behind below ``base``.

    Raw discovery rows are landed also in a dry run (A6).  Otherwise: the
    canonical articles and summaries of the run date (A7), the merged article
    index (G6), the archive of the batch, digest and dashboard feed (A8), the
    manifest and error rows of the run (A9, E1), the seen-set (G5), the registry
    (A10) and the checkpoints (G7).

    All of it becomes visible in one run commit, the last write.  A run that
    breaks off anywhere before leaves nothing that a reader sees, and is simply
    run again; run again after its commit it replaces its own rows.  With ``tx``
    the caller commits.
    """
    own, tx = tx is None, tx or commits.begin(spark, base, cfg.state_run_id)
    on_date = lambda df: df.withColumn("run_date", F.lit(cfg.run_date))
    for table, rows in (("raw/reads", "raw_items"), ("raw/publications", "found"), ("raw/monitored", "monitored_items")):
        tx.write(table, on_date(out[rows]), cfg.run_date)
    out = out | {k: stored(out[k]) for k in ("summaries", "registry")}
    flat = stored(numbered(out["canonical"]))
    fresh = flat.withColumn("data_freshness", F.lit("current"))
    man = stored(manifest(out, cfg, completed_at))
    out = out | {"manifest": man, "flat": flat}
    if not cfg.dry_run:
        tx.write("processed/articles", flat, cfg.run_date)
        tx.write("processed/summaries", on_date(out["summaries"]).drop("seq"), cfg.run_date)
        state.merge_index_buckets(tx, "processed/index", flat, cfg.run_date)
        header = outputs.daily_batch_header(flat, spark.range(1).select(F.lit(cfg.run_date).alias("run_date"), F.lit(cfg.run_id).alias("run_id")),
                                            cfg.source_profile, cfg.run_iso)
        tx.write_with("archive/batch", cfg.run_date, lambda path: io.write_daily_batch(header, fresh, path), "json")
        tx.write("archive/digest", on_date(outputs.digest(fresh)), cfg.run_date)
        tx.write("archive/dashboard_feed", on_date(outputs.dashboard_feed(fresh)), cfg.run_date)
        tx.write("runs/errors", on_date(out["failed"].select(
            F.lit(cfg.run_id).alias("run_id"), F.concat_ws(": ", "article_url", "error").alias("error"))), cfg.state_run_id)
        tx.write("runs/manifests", man, cfg.state_run_id)
        seen = SeenSet(tx)
        if "seen" in out:
            seen.replace(out["seen"])
        else:
            seen.remember(out["articles"])
        tx.write("state/checkpoints", state.next_checkpoints(tx.read("state/checkpoints"), man))
        tx.write("state/registry", out["registry"])
    if own:
        tx.commit()
    return out


def numbered(canonical: DataFrame) -> DataFrame:
    """The rows with ``seq`` as longs that increase with the run's order (a struct of keys).

    A global sort numbers its partitions in order, so no window is needed; the
    result is stored by the caller, which fixes the numbers.
    """
    return canonical.orderBy("seq").withColumn("seq", F.monotonically_increasing_id())


def import_seeds(spark: SparkSession, seeds_path: str, base: str, cfg: RunConfig) -> int:
    """K2: seeds file -> G3 -> the registry of a commit of its own (A10).  Returns
    the number of imported seed rows (one small aggregate)."""
    tx = commits.begin(spark, base, f"seeds-{uuid.uuid4().hex}")
    new_reg, rows = registry.import_publications(load_registry(spark, base, cfg, tx), io.read_seeds(spark, seeds_path), cfg.source_profile,
                                                 cfg.run_ts, cfg.expiry_days)
    tx.write("state/registry", new_reg)
    tx.commit()
    return rows.count()


def render_digest(spark: SparkSession, batch_path: str | list[str], out_path: str, title: str = outputs.DEFAULT_TITLE,
                  intro: str = outputs.DEFAULT_INTRO) -> DataFrame:
    """K3: batch files -> validate (A5) -> publishable (D8) -> Markdown (H4) -> files."""
    arts = runs = None
    for path in [batch_path] if isinstance(batch_path, str) else batch_path:
        batch = io.read_daily_batch(spark, path)
        batch = batch.withColumn("run_date", F.col("batch_run_date"))
        dates = batch.select("run_date").distinct()
        if io.path_exists(spark, f"{path}/header"):
            dates = dates.unionByName(io.read_batch_header(spark, path).select("run_date"))  # empty batches, too
        arts = batch if arts is None else arts.unionByName(batch)
        runs = (dates if runs is None else runs.unionByName(dates)).distinct()
    blocks = outputs.markdown_blocks(arts, runs, title, intro)
    io.write_markdown(blocks, out_path)
    return blocks


def run_with_health(spark: SparkSession, cfg: RunConfig, checks: DataFrame, base: str | None = None,
                    reads_host: str | None = None, **inputs) -> dict[str, DataFrame]:
    """K4: preflight gate (E5) -> K1 -> E6/E7 -> G10 / F6 / H5 / H6 -> G9 / G11.

    The gate reads one aggregated row for this run.  Whatever happens, the run
    has a status row and, with ``base``, it is published: the run's payload as
    ``latest`` and, if the run is healthy, as ``latest_successful``; what
    consumers see (a degraded run without rows shows the last successful
    payload under a banner); the registry's health snapshot with the row of the
    reads profile; and the row of run history.  All tables of the run, its state
    included, change in one commit; without ``reg`` or ``seen`` those of the
    state it starts from are taken.  An unexpected error ends
    in status ``failed`` at stage ``internal``: that row is all that is committed.
    """
    checks = checks.withColumn("run_id", F.lit(cfg.state_run_id))
    if "checked_at" not in checks.columns:
        checks = checks.withColumn("checked_at", F.lit(cfg.run_ts).cast("timestamp"))
    out: dict[str, DataFrame] = {}
    status = {"run_id": cfg.state_run_id, "started_at": cfg.run_ts, "run_status": "running", "failure_stage": None,
              "article_count": 0, "source_checks_attempted": 0, "source_checks_succeeded": 0, "source_checks_failed": 0,
              "preserved_last_successful_output": False, "warnings": [], "errors": []}
    tx = None
    if base:
        tx = commits.begin(spark, base, cfg.state_run_id)
        inputs = {"reg": load_registry(spark, base, cfg, tx), "seen": SeenSet(tx)} | inputs
    try:
        pre = health.preflight_status(checks).first()
        blocked = None
        if pre is not None and pre.core_status == "degraded":
            status |= {"run_status": "degraded", "failure_stage": pre.failure_stage, "warnings": [
                health.WARN_DNS if pre.failure_stage == "preflight_dns" else health.WARN_PREFLIGHT]}
            current = spark.createDataFrame([], PAYLOAD_SCHEMA)
        else:
            out = run_daily(spark, cfg, **inputs)
            if tx:
                out = persist_run(spark, cfg, out, base, tx=tx)
            counts = out["monitor_results"].agg(
                F.count(F.lit(1)).alias("attempted"), F.count_if("success").alias("succeeded"),
                F.count_if(~F.col("success")).alias("failed")).first()
            degraded = counts.succeeded == 0
            status |= {"run_status": "degraded" if degraded else "healthy", "failure_stage": "discovery" if degraded else None,
                       "source_checks_attempted": counts.attempted, "source_checks_succeeded": counts.succeeded,
                       "source_checks_failed": counts.failed, "warnings": [health.WARN_NO_SOURCES] if degraded else []}
            if cfg.discovery_mode == "live_reads" and cfg.reads_enabled and inputs.get("reads_pages") is not None:
                seen = health.discovery_blocked(inputs["reads_pages"])
                blocked = seen.agg(F.min("discovery_blocked").alias("b")).where("b").select(F.lit(cfg.state_run_id).alias("run_id"))
            current = out["flat"] if "flat" in out else stored(numbered(out["canonical"]))
        current = outputs.articles_payload(current, cfg.state_run_id, status["run_status"])
        out["reads_row"] = health.reads_source_row(checks, reads_host or _host(cfg.source_profile), cfg.source_profile, blocked=blocked)
        if tx:
            _publish(spark, cfg, tx, status, current, out)
        reg = out["registry"] if "registry" in out else inputs["reg"]
        out["health"] = registry.health_snapshot(reg, out["reads_row"])
        if tx:
            out["health"] = tx.write("latest/registry_snapshot", out["health"])
            _write_status(spark, tx, status).commit()
    except commits.CommitConflict:
        raise  # another run was faster: nothing of this one is visible, and it can be run again
    except Exception as e:  # the run is over; its status row tells why
        status |= {"run_status": "failed", "failure_stage": "internal", "errors": [repr(e)[:2000]]}
        if tx:
            _write_status(spark, commits.begin(spark, base, cfg.state_run_id), status).commit()
    out["run_status"] = _status_row(spark, status)
    return out


def _status_row(spark: SparkSession, status: dict) -> DataFrame:
    return spark.createDataFrame([tuple(status.values())], RUN_STATUS_SCHEMA)


def _write_status(spark: SparkSession, tx: commits.Transaction, status: dict) -> commits.Transaction:
    tx.write("runs/status", _status_row(spark, status), status["run_id"])
    return tx


RUN_STATUS_SCHEMA = ("run_id string, started_at string, run_status string, failure_stage string, article_count long, "
                     "source_checks_attempted long, source_checks_succeeded long, source_checks_failed long, "
                     "preserved_last_successful_output boolean, warnings array<string>, errors array<string>")
PAYLOAD_SCHEMA = ", ".join(f"{c} {'array<string>' if c in ('summary_bullets', 'topic_tags') else 'string'}"
                           for c in extract.CANONICAL_COLUMNS) + ", seq long"


def _host(url: str) -> str:
    return url.split("://", 1)[-1].split("/", 1)[0]


def _publish(spark: SparkSession, cfg: RunConfig, tx: commits.Transaction, status: dict, current: DataFrame, out: dict[str, DataFrame]) -> None:
    """The payload of this run, the last successful one, and what is shown."""
    current = tx.write("latest/payload", current)
    status["article_count"] = current.count()
    healthy = status["run_status"] == "healthy"
    if healthy:
        tx.tables["latest/successful"] = dict(tx.tables["latest/payload"])  # the same files under one more name
    status["preserved_last_successful_output"] = not healthy
    shown, banner = current, None
    if status["run_status"] == "degraded" and status["article_count"] == 0:
        last = tx.read("latest/successful")
        shown = (current if last is None else last).withColumn("data_freshness", F.lit("last_successful_fallback"))
        banner = outputs.FALLBACK_BANNER
    shown = shown.withColumn("banner_message", F.lit(banner).cast("string"))
    header = outputs.daily_batch_header(
        shown.withColumn("run_date", F.lit(cfg.run_date)),
        spark.range(1).select(F.lit(cfg.run_date).alias("run_date"), F.lit(cfg.state_run_id).alias("run_id")),
        cfg.source_profile, cfg.run_iso).withColumns({"status": F.lit(status["run_status"]), "banner_message": F.lit(banner).cast("string")})
    tx.write("latest/batch_header", header)
    out["displayed"] = tx.write("latest/batch", shown)
    tx.write("latest/digest", outputs.digest(shown, ("banner_message",)))
    tx.write("latest/dashboard_feed", outputs.dashboard_feed(shown, ("banner_message",)))
