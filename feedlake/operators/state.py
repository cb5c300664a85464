"""Ranking of candidates and persisted article state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEEN_SCHEMA = T.StructType([
    T.StructField("canonical_url", T.StringType(), False),
    T.StructField("article_id", T.StringType()),
    T.StructField("content_hash", T.StringType()),
    T.StructField("first_seen", T.TimestampType()),
    T.StructField("last_seen", T.TimestampType()),
])


def top_posts(items: DataFrame, n: int = 5, group_col: str = "source_url", order_col: str = "pos") -> DataFrame:
    """first ``n`` posts per publication by position.

    ``row_number() <= n`` plans as WindowGroupLimit, which trims every map
    partition to ``n`` rows per publication before the shuffle.
    """
    w = Window.partitionBy(group_col).orderBy(F.col(order_col).asc())
    return items.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def select_batch(fresh: DataFrame, n: int | None = 10, order_cols: list[str] | None = None) -> DataFrame:
    """first ``n`` fresh candidates in discovery order (the per-run fetch
    limit; plans as TakeOrderedAndProject).  ``n=None`` keeps every row."""
    if n is None:
        return fresh
    cols = order_cols or [c for c in ("source_rank", "seq", "pos") if c in fresh.columns]
    return fresh.orderBy(*[F.col(c).asc() for c in cols]).limit(n)


def remember(seen: DataFrame, kept: DataFrame, seen_at_col: str = "fetched_at") -> DataFrame:
    """Upsert the seen-set with the kept articles of a run.

    first_seen is kept for known URLs; article_id, content_hash and last_seen
    are replaced.  Within one run the last row per URL wins.
    """
    new = (kept.select("canonical_url", "article_id", "content_hash",
                       F.col(seen_at_col).cast("timestamp").alias("_at"), "seq")
           .groupBy("canonical_url").agg(
               F.max(F.struct("seq", "article_id", "content_hash", "_at")).alias("_last"),
               F.min("_at").alias("_first_at")))
    s = seen.alias("s")
    j = s.join(new.alias("n"), F.col("s.canonical_url") == F.col("n.canonical_url"), "full_outer")
    hit = F.col("n.canonical_url").isNotNull()
    return j.select(
        F.coalesce(F.col("s.canonical_url"), F.col("n.canonical_url")).alias("canonical_url"),
        F.when(hit, F.col("_last.article_id")).otherwise(F.col("s.article_id")).alias("article_id"),
        F.when(hit, F.col("_last.content_hash")).otherwise(F.col("s.content_hash")).alias("content_hash"),
        F.coalesce(F.col("s.first_seen"), F.col("_first_at")).alias("first_seen"),
        F.when(hit, F.col("_last._at")).otherwise(F.col("s.last_seen")).alias("last_seen"),
    )


def merge_index(index: DataFrame, batch: DataFrame, run_date: str) -> DataFrame:
    """Last write wins by article_id; a replaced row keeps its first
    position.  Position is (first_run_date, first_seq) so no global counter
    is needed.  Of a batch's rows of one id the highest seq wins, of equal ones
    the greatest hash of the row, so exactly one row of an id comes out.

    Both sides are read once: one aggregate with a partial step before the
    shuffle picks the whole winning row.
    """
    value_cols = [c for c in batch.columns if c not in ("first_run_date", "first_seq")]
    old = index.select(*value_cols, "first_run_date", "first_seq", F.lit(0).alias("_v"))
    new = batch.select(*value_cols, F.lit(run_date).alias("first_run_date"), F.col("seq").alias("first_seq"),
                       F.lit(1).alias("_v"))
    rest = [c for c in value_cols if c != "article_id"]
    won = old.unionByName(new).groupBy("article_id").agg(
        F.max_by(F.struct(*rest), F.struct("_v", "seq", F.xxhash64(*rest))).alias("_row"),
        F.min(F.struct("first_run_date", "first_seq")).alias("_pos"))
    return won.select(*[c if c == "article_id" else F.col("_row")[c].alias(c) for c in value_cols],
                      F.col("_pos.first_run_date").alias("first_run_date"), F.col("_pos.first_seq").alias("first_seq"))


def merge_index_buckets(tx, table: str, batch: DataFrame, run_date: str, buckets: int = 16) -> None:
    """G6 on stored state: the index lies in buckets of article_id (parts of a
    run commit); only those that the batch touches are read and written again."""
    n = tx.settings.setdefault(f"{table}.buckets", buckets)
    bucket = F.pmod(F.xxhash64("article_id"), F.lit(n)).cast("int")
    touched = [str(r[0]) for r in batch.select(bucket).distinct().collect()]  # at most `buckets`
    if not touched:
        return
    index = tx.read(table, touched)
    if index is None:
        index = batch.limit(0).withColumns({"first_run_date": F.lit(""), "first_seq": F.col("seq")})
    tx.write_parts(table, merge_index(index, batch, run_date).withColumn("bucket", bucket), "bucket", touched)


def next_checkpoints(last: DataFrame | None, manifest: DataFrame) -> DataFrame:
    """G7 by merging: the checkpoints so far and those of new manifests; no history is read again."""
    new = checkpoints(manifest)
    if last is None:
        return new
    return last.select(*new.columns).unionByName(new).agg(*[F.max(c).alias(c) for c in new.columns])


def checkpoints(manifests: DataFrame) -> DataFrame:
    """Last successful run date and last scrape date -- the latest
    finished non-dry run, with or without errors."""
    done = manifests.where(~F.col("dry_run") & F.col("status").isin("completed", "completed_with_errors"))
    return done.agg(F.max("run_date").alias("last_successful_run_date"),
                    F.max("run_date").alias("last_reads_scrape_date"))
