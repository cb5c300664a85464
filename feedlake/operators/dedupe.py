"""De-duplication against prior state and within a run.

Skew: one URL or hash may own a large share of the rows.  Every step here is
either an aggregate with map-side partial aggregation (``min``), or a join
whose keys include ``seq`` (unique), or an anti join on which AQE may split a
skewed left side; nothing collects a key group into one task.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import normalize_url
from ..session import cut_lineage
from .seen import SeenSet


def _known_urls(seen: DataFrame | SeenSet, urls: DataFrame) -> DataFrame:
    """URLs of the seen-set; of a bucketed one only those that also occur in ``urls``."""
    if isinstance(seen, SeenSet):
        return seen.known_urls(urls)
    return seen.select(F.col("canonical_url").alias("_seen_url")).distinct()


def _known_hashes(seen: DataFrame | SeenSet, hashes: DataFrame) -> DataFrame:
    if isinstance(seen, SeenSet):
        return seen.known_hashes(hashes)
    return seen.where(F.col("content_hash").isNotNull()).select(F.col("content_hash").alias("_seen_hash")).distinct()


def filter_new(candidates: DataFrame, seen: DataFrame | SeenSet, skip_existing: bool = True,
               url_col: str = "canonical_url", fallback_col: str = "article_url") -> DataFrame:
    """Drop candidates whose URL (canonical, else article URL) is already
    in the seen-set (left-anti equi-join)."""
    if not skip_existing:
        return candidates
    key = F.coalesce(F.nullif(F.col(url_col), F.lit("")), F.col(fallback_col))
    keyed = candidates.withColumn("_key", key)
    seen_urls = _known_urls(seen, keyed.select("_key"))
    return keyed.join(seen_urls, keyed["_key"] == seen_urls["_seen_url"], "left_anti").drop("_key")


def filter_unseen(articles: DataFrame, seen: DataFrame | SeenSet, by_hash: bool = True,
                  url_col: str = "canonical_url", hash_col: str = "content_hash") -> DataFrame:
    """Drop articles whose canonical URL **or** content hash is in the
    seen-set.  Two anti joins (an OR condition would plan a nested loop)."""
    seen_urls = _known_urls(seen, articles.select(url_col))
    out = articles.join(seen_urls, articles[url_col] == seen_urls["_seen_url"], "left_anti")
    if by_hash:
        seen_hashes = _known_hashes(seen, articles.select(hash_col))
        out = out.join(seen_hashes, out[hash_col] == seen_hashes["_seen_hash"], "left_anti")
    return out


def first_by_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """Keep, per key, the row with the smallest ``order_cols``.

    ``min(struct(order..., row...))`` aggregates partially before the shuffle,
    so a hot key costs one small row per map task, not its whole group.
    """
    others = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in others]).alias("_m")
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_m"))
    return agg.select(*keys, *[F.col("_m")[c].alias(c) for c in order_cols + others]).select(*df.columns)


def merge_items(direct: DataFrame, monitored: DataFrame) -> DataFrame:
    """D3: direct items, then monitored ones; first occurrence of each
    normalised URL wins.  Adds ``source_rank`` (0 direct, 1 monitored)."""
    cols = [c for c in direct.columns]
    both = (direct.withColumn("source_rank", F.lit(0))
            .unionByName(monitored.select(*cols).withColumn("source_rank", F.lit(1))))
    both = both.withColumn("_nurl", normalize_url(F.col("article_url")))
    order = ["source_rank"] + [c for c in ("seq", "pos") if c in cols]
    return first_by_key(both, ["_nurl"], order).drop("_nurl")


#: Conflicting pairs that one task settles in order (about 1 kB each in its memory).
COMPONENT_PAIRS = 100_000
#: Steps of label spreading; each reaches over one more URL and one more hash.
LABEL_STEPS = 3


def _rank(value):
    """Sort key of a collected value in Spark's order: null first, structs by their fields."""
    if value is None:
        return (0,)
    return (1, tuple(_rank(v) for v in value.values())) if isinstance(value, dict) else (1, value)


def _settle(pairs: DataFrame) -> DataFrame:
    """``k`` of the pairs that the rule keeps, each ``label`` in one task: a pair stays if no earlier kept one has its URL or hash."""
    def run(table: pa.Table) -> pa.Table:
        rows = table.select(["k_url", "k_hash", "k"]).to_pylist()
        urls, hashes, kept = set(), set(), []
        for i in sorted(range(len(rows)), key=lambda i: _rank(rows[i]["k"])):
            url, digest = rows[i]["k_url"], rows[i]["k_hash"]
            if url not in urls and digest not in hashes:
                urls.add(url)
                hashes.add(digest)
                kept.append(i)
        return table.take(pa.array(kept, pa.int64())).select(["k"])

    return cut_lineage(pairs.groupBy("label").applyInArrow(run, pairs.select("k").schema))


def _small_components(pairs: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """(kept ``k`` of the components that are found whole and have at most ``most`` pairs, the pairs of all others).

    A pair's label is the smallest pair within some steps over shared keys.  A label
    is a whole component if none of its URLs carries another one (its hashes
    can't, as the last step made them equal).
    """
    labelled = pairs.withColumn("label", F.col("k"))
    for _ in range(LABEL_STEPS):
        by_url = labelled.groupBy("k_url").agg(F.min("label").alias("lu"))
        labelled = labelled.join(by_url, "k_url")
        by_hash = labelled.groupBy("k_hash").agg(F.min("lu").alias("lh"))
        labelled = cut_lineage(labelled.join(by_hash, "k_hash").select("k_url", "k_hash", "k", F.col("lh").alias("label")))
    open_urls = labelled.groupBy("k_url").agg((F.min("label") != F.max("label")).alias("open"))
    whole = labelled.join(open_urls, "k_url").groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.col("open").cast("int")).alias("open")) \
        .where((F.col("open") == 0) & (F.col("n") <= most)).select("label")
    whole = cut_lineage(whole)
    return _settle(labelled.join(whole, "label", "left_semi")), cut_lineage(labelled.join(whole, "label", "left_anti").drop("label"))


def dedupe_first(df: DataFrame, url_col: str = "canonical_url", hash_col: str = "content_hash",
                 order_col: str = "seq", materialize: bool = True, seen: DataFrame | SeenSet | None = None,
                 by_hash: bool = True, component_pairs: int | None = None) -> DataFrame:
    """In-run rule -- a row is dropped when its URL or its hash equals that
    of an **earlier kept** row (dropped rows do not block later ones).

    Earlier means a smaller (order, URL, hash), so a repeated ``order_col`` is
    no ambiguity; of rows equal in all three one is kept.  Only those three
    travel through the steps:

    1. equal (URL, hash) pairs collapse to their first row; a later one never
       survives, whatever happens to the first;
    2. a URL group whose hashes occur nowhere else, or a hash group whose URLs
       occur nowhere else, is settled at once: its first pair stays;
    3. the rest, pairs in conflict on both keys, falls into components that don't
       share a key.  At most :data:`COMPONENT_PAIRS` pairs are settled in order by
       one task: all of them if they are no more, else each component that a
       few steps of label spreading find whole and within that bound;
    4. what is left goes through rounds: accept every pair that is first of both
       its groups, remove all pairs that share a URL or a hash with an accepted
       one.  The first undecided pair is always accepted, so each round makes
       progress and writes one checkpoint; as soon as no more than the bound is
       left, one task settles it.

    With ``seen``, rows known to the seen-set are dropped first (D2); that, too,
    is decided on the narrow columns, so full rows move once, at the end.
    Without ``by_hash`` only URLs count.

    A NULL key matches nothing.  With ``materialize`` the input rows are
    checkpointed first, so an expensive upstream plan (HTML extraction) runs
    once for both the keys and the returned rows.
    """
    component_pairs = COMPONENT_PAIRS if component_pairs is None else component_pairs
    if materialize:
        df = cut_lineage(df)

    def own(c: str):  # a NULL key gets a per-row value that no URL or digest can equal
        known = F.col(c) if by_hash or c != hash_col else F.lit(None).cast("string")
        return F.coalesce(known, F.concat(F.lit("~null:"), F.to_json(F.struct(order_col, url_col, hash_col))))

    keys = df.select(order_col, url_col, hash_col)
    if seen is not None:
        keys = cut_lineage(filter_unseen(keys, seen, by_hash, url_col, hash_col))  # narrow; read three times below
    keys = keys.select(own(url_col).alias("k_url"), own(hash_col).alias("k_hash"), F.col(order_col).alias("k_seq"))
    pairs = keys.groupBy("k_url", "k_hash").agg(F.min("k_seq").alias("k_seq")) \
        .select("k_url", "k_hash", F.struct("k_seq", "k_url", "k_hash").alias("k"))
    url_sizes = pairs.groupBy("k_url").agg(F.count(F.lit(1)).alias("n_url"))
    hash_sizes = pairs.groupBy("k_hash").agg(F.count(F.lit(1)).alias("n_hash"))
    pairs = cut_lineage(pairs.join(url_sizes, "k_url").join(hash_sizes, "k_hash"))
    # What a group's members have beside the group's own key decides whether it stands alone.
    url_groups = pairs.groupBy("k_url").agg(F.min("k").alias("k"), F.max("n_hash").alias("most"))
    hash_groups = pairs.groupBy("k_hash").agg(F.min("k").alias("k"), F.max("n_url").alias("most"))
    kept = url_groups.where("most = 1").select("k").unionByName(hash_groups.where("most = 1").select("k"))
    undecided = pairs.select("k_url", "k_hash", "k") \
        .join(url_groups.where("most = 1").select("k_url"), "k_url", "left_anti") \
        .join(hash_groups.where("most = 1").select("k_hash"), "k_hash", "left_anti")
    undecided = cut_lineage(undecided)
    left = undecided.count()
    if left > component_pairs:
        settled, undecided = _small_components(undecided, component_pairs)
        kept = kept.unionByName(settled)
        left = undecided.count()
    while left > component_pairs:
        first_url = undecided.groupBy("k_url").agg(F.min("k").alias("u"))
        first_hash = undecided.groupBy("k_hash").agg(F.min("k").alias("h"))
        seen = cut_lineage(undecided.join(first_url, "k_url").join(first_hash, "k_hash").select(
            "k_url", "k_hash", "k", ((F.col("k") == F.col("u")) & (F.col("k") == F.col("h"))).alias("accepted")))
        accepted = seen.where("accepted")
        kept = kept.unionByName(accepted.select("k"))
        undecided = cut_lineage(seen.where(~F.col("accepted")).select("k_url", "k_hash", "k")
                                .join(accepted.select("k_url"), "k_url", "left_anti").join(accepted.select("k_hash"), "k_hash", "left_anti"))
        left = undecided.count()
    if left:
        kept = kept.unionByName(_settle(undecided.withColumn("label", F.lit(0))))
    # A pair that is alone in both its groups is named twice.
    kept = kept.select("k.*").distinct()
    marked = df.withColumns({"_k_url": own(url_col), "_k_hash": own(hash_col), "_k_seq": F.col(order_col)})
    found = marked.join(kept.select(F.col("k_seq").alias("_k_seq"), F.col("k_url").alias("_k_url"), F.col("k_hash").alias("_k_hash")),
                        ["_k_seq", "_k_url", "_k_hash"], "left_semi")
    return found.dropDuplicates(["_k_seq", "_k_url", "_k_hash"]).select(*[F.col(f"`{c}`") for c in df.columns])
