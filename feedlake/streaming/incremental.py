"""Incremental article runs with Structured Streaming (L1).

Each trigger sees only pages that arrived since the last one.  Two forms:

* :func:`incremental_urls` -- URL-only first-wins dedupe as a streaming
  ``dropDuplicates`` on the normalised URL (state in the checkpoint).
* :func:`incremental_articles` -- successful fetches run through D1 -> C8 -> D2 ->
  D4 -> I1 -> G5 per micro-batch against the seen-set in buckets; failed ones wait
  in a retry queue until they succeed.

The queue's state is keyed by URL in the stream itself (``transformWithState``):
how often a page has failed since it last succeeded, and its last error, with a
time to live.  Only narrow rows pass through it, HTML never does.  Every micro-batch ends
in one run commit that moves its articles, the seen-set and the queue
together; a batch that is replayed starts from the state before it and replaces itself.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from ..functions.urls import normalize_url
from ..operators import dedupe, extract, summarize
from ..operators.seen import SeenSet
from ..sources import commits, io

#: Settings of the article stream's query: the state store that transformWithState needs, and no batches without
#: data, which a processing-time state would ask for without end.
QUERY_SETTINGS = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                  "spark.sql.streaming.noDataMicroBatches.enabled": "false"}

ARRIVALS_SCHEMA = T.StructType([*io.PAGES_SCHEMA.fields, T.StructField("error", T.StringType())])
#: What one key says after a batch: retry, given_up or recovered.
EVENT_SCHEMA = "canonical_url string, kind string, attempts int, error string"


def _page_stream(spark: SparkSession, pages_dir: str, file_glob: str | None, schema: T.StructType = io.PAGES_SCHEMA):
    reader = spark.readStream.schema(schema)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    return reader.parquet(pages_dir)


def incremental_urls(spark: SparkSession, pages_dir: str, checkpoint: str, out_path: str,
                     file_glob: str | None = None):
    """Start a stream that appends every first-seen normalised page URL to
    the parquet table at ``out_path`` (``availableNow`` trigger).

    The dedupe state and the sink's commit log live in ``checkpoint``, so a
    rerun only processes new files and only appends URLs never seen before;
    the file sink is exactly-once across restarts.
    """
    stream = _page_stream(spark, pages_dir, file_glob)
    urls = stream.select(normalize_url(F.col("url")).alias("canonical_url"), F.col("page_id").alias("seq"))
    deduped = urls.dropDuplicates(["canonical_url"])
    return (deduped.writeStream.format("parquet").option("path", out_path).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


class RetryState(StatefulProcessor):
    """Failures of a URL since its last success.

    A success settles the URL for its batch; without one every failure of the
    batch counts, and the one of the largest page_id gives the error.  One event
    tells how the batch ended: ``retry`` (failed fewer than ``max_attempts``
    times), ``given_up`` (at least as often) or ``recovered`` (a success after
    earlier failures).  A success without earlier failures leaves no state and no event.
    """

    def __init__(self, max_attempts: int, ttl_ms: int):
        self.max_attempts, self.ttl_ms = max_attempts, ttl_ms

    def init(self, handle) -> None:
        self.failed = handle.getValueState("failed", "attempts int, error string", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before = self.failed.get()[0] if self.failed.exists() else 0
        failures, settled, last = 0, False, (-1, "")
        for r in rows:  # one pass, nothing is kept
            if r.ok:
                settled = True
            else:
                failures, last = failures + 1, max(last, (r.page_id, r.error))
        if settled:
            if before:
                self.failed.clear()
                yield Row(canonical_url=key[0], kind="recovered", attempts=before, error=None)
        elif failures:
            attempts = before + failures
            self.failed.update((attempts, last[1]))
            yield Row(canonical_url=key[0], kind="retry" if attempts < self.max_attempts else "given_up", attempts=attempts, error=last[1])

    def close(self) -> None:
        pass


def arrivals_and_events(arrivals: DataFrame, max_attempts: int, ttl_ms: int) -> DataFrame:
    """Successful pages (``kind`` page) and the retry queue's events, as one stream."""
    ok = F.col("error").isNull() & F.col("html").isNotNull()
    pages = arrivals.where(ok).select("page_id", normalize_url(F.col("url")).alias("canonical_url"), "html", F.lit("page").alias("kind"),
                                      F.lit(None).cast("int").alias("attempts"), F.lit(None).cast("string").alias("error"))
    narrow = arrivals.select(F.coalesce("page_id", F.lit(-1)).alias("page_id"), normalize_url(F.col("url")).alias("canonical_url"), ok.alias("ok"),
                             F.coalesce("error", F.lit("page was not fetched")).alias("error"))
    events = narrow.groupBy("canonical_url").transformWithState(
        statefulProcessor=RetryState(max_attempts, ttl_ms), outputStructType=EVENT_SCHEMA, outputMode="Append", timeMode="ProcessingTime")
    none = F.lit(None)
    return pages.unionByName(events.select(none.cast("long").alias("page_id"), "canonical_url", none.cast("string").alias("html"),
                                           "kind", "attempts", "error"))


def process_batch(batch: DataFrame, batch_id: int, *, base: str, run_iso: str, responses: DataFrame | None = None) -> None:
    """One micro-batch of pages and events through the article chain, in one commit below ``base``.

    Replay-safe: the commit is named after the query and the batch, so a batch
    that is processed again reads the state before it.  Of pages that share a
    normalised URL the one with the smallest page_id counts.
    """
    spark, batch = batch.sparkSession, batch.persist()  # read several times; the state operator should run once
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    tx = commits.begin(spark, base, f"{query}-{batch_id}")
    seen = SeenSet(tx)
    pages = batch.where("kind = 'page'").select("page_id", "html", "canonical_url")
    pages = dedupe.first_by_key(pages, ["canonical_url"], ["page_id"])
    items = pages.select(F.col("page_id").alias("seq"), F.lit(0).alias("pos"), F.lit("").alias("source_url"),
                         F.col("canonical_url").alias("article_url"), F.lit(run_iso).alias("discovered_at"),
                         F.lit(None).cast("string").alias("title_hint"), F.lit(None).cast("string").alias("source_label"),
                         F.lit("reads_direct").alias("discovered_via"), "canonical_url")
    cands = dedupe.filter_new(items, seen)
    arts = extract.build_articles(cands.drop("canonical_url"), pages.select(F.col("canonical_url").alias("url"), "html"), run_iso)
    arts = dedupe.dedupe_first(arts, seen=seen)
    stored = tx.write("articles", summarize.summarize(arts, responses, created_at=run_iso), f"{batch_id:012d}")
    seen.remember(stored)
    events = batch.where("kind <> 'page'").select("canonical_url", "kind", "attempts", "error")
    waiting = tx.read("retry", schema=EVENT_SCHEMA)
    queue = events.where("kind <> 'recovered'")
    if waiting is not None:
        queue = queue.unionByName(waiting.join(events.select("canonical_url"), "canonical_url", "left_anti"))
    tx.write("retry", queue)
    tx.commit()
    batch.unpersist()


def incremental_articles(spark: SparkSession, pages_dir: str, checkpoint: str, base: str, run_iso: str,
                         file_glob: str | None = None, max_attempts: int = 3, retry_ttl_days: int = 30):
    """Start the stream (``availableNow``) over (page_id, url, html, error) arrivals and return it.

    ``base`` then holds the tables ``articles`` (a part for each batch),
    ``state/seen`` and ``retry`` of the last committed batch.
    """
    arrivals = _page_stream(spark, pages_dir, file_glob, ARRIVALS_SCHEMA)
    stream = arrivals_and_events(arrivals, max_attempts, retry_ttl_days * 86_400_000)
    before = {k: spark.conf.get(k, None) for k in QUERY_SETTINGS}
    for k, v in QUERY_SETTINGS.items():
        spark.conf.set(k, v)
    try:  # a query keeps the settings that it starts with
        return (stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
                .foreachBatch(lambda df, bid: process_batch(df, bid, base=base, run_iso=run_iso)).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
