"""The seen-set in buckets, each with a Bloom filter (D1, D2, G5 against stored state).

Rows lie in buckets by a hash of their URL, and the content hashes of all rows,
with the number of URLs that carry each, in buckets of their own.  Both tables are
parts of a run commit (:mod:`feedlake.sources.commits`), so a run rewrites the
buckets that it touches and names the others again: its cost follows the batch and
the buckets that it meets, not the history.

Beside every bucket lies its Bloom filter, a bitmap made by Spark's bitmap
aggregates.  A lookup reads the filters of the batch's buckets, a small fraction of
the state; only keys that pass are looked for in the rows, and only in the buckets
that hold such keys.  Filters never miss a key, so the result is that of an anti
join with the whole table.

The number of buckets is fixed when the first row is written and kept in the
commit's settings; :meth:`SeenSet.resize` changes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.commits import Snapshot, Transaction
from . import state

#: Bits of one bitmap: a fixed value of Spark's bitmap functions.
BITS = 32768
#: Bits set for a key.  Up to about 3,000 keys a bitmap, 1.4 % of unknown keys pass.
HASHES = 3
BUCKETS = 16


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def bit_positions(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(BITS)) for i in range(1, HASHES + 1)])


def has_bits(bits: Column, positions: Column) -> Column:
    """All of the positions are set in the bitmap."""
    def is_set(p: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bits, (F.floor(p / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        return F.getbit(byte, F.pmod(p, F.lit(8)).cast("int")) == 1
    return F.forall(positions, is_set)


def bloom_filters(rows: DataFrame, key: str, buckets: int, bitmaps: int) -> DataFrame:
    """(bucket, fine, bits): a bitmap for each of the ``bitmaps`` fine buckets of every bucket."""
    bits = rows.select(bucket_of(F.col(key), buckets).alias("bucket"), bucket_of(F.col(key), buckets * bitmaps).alias("fine"),
                       F.explode(bit_positions(F.col(key))).alias("p"))
    return bits.groupBy("bucket", "fine").agg(F.bitmap_construct_agg("p").alias("bits"))


def named(rows: DataFrame) -> list[str]:
    """The buckets that occur: at most as many as there are."""
    return [str(r[0]) for r in rows.select("bucket").distinct().collect()]


class SeenSet:
    """The seen-set of a snapshot or of a running transaction."""

    def __init__(self, source: Snapshot, buckets: int = BUCKETS, bitmaps: int = 1, name: str = "state/seen"):
        self.source, self.name = source, name
        self.buckets = source.settings.get(f"{name}.buckets", buckets)
        self.bitmaps = source.settings.get(f"{name}.bitmaps", bitmaps)

    def rows(self, parts: list[str] | None = None) -> DataFrame:
        """All rows (or those of some buckets)."""
        found = self.source.read(self.name, parts, state.SEEN_SCHEMA)
        return self.source.spark.createDataFrame([], state.SEEN_SCHEMA) if found is None else found

    def known_urls(self, keys: DataFrame) -> DataFrame:
        """The distinct values of ``keys``' only column that are URLs of the set, as ``_seen_url``."""
        return self._known(keys, self.name, "canonical_url").withColumnRenamed("key", "_seen_url")

    def known_hashes(self, keys: DataFrame) -> DataFrame:
        """The same for content hashes, as ``_seen_hash``."""
        return self._known(keys, f"{self.name}_hashes", "content_hash").withColumnRenamed("key", "_seen_hash")

    def _known(self, keys: DataFrame, table: str, column: str) -> DataFrame:
        asked = keys.select(F.col(keys.columns[0]).alias("key")).where("key is not null").distinct()
        asked = cut_lineage(asked.withColumn("bucket", bucket_of(F.col("key"), self.buckets)))
        filters = self.source.read(f"{table}_filter", named(asked), "fine int, bits binary")
        if filters is None:
            return asked.select("key").limit(0)
        passed = asked.withColumn("fine", bucket_of(F.col("key"), self.buckets * self.bitmaps)).join(filters, "fine") \
            .where(has_bits(F.col("bits"), bit_positions(F.col("key")))).select("key", "bucket")
        passed = cut_lineage(passed)
        stored = self.source.read(table, named(passed), f"{column} string")
        if stored is None:
            return passed.select("key").limit(0)
        return passed.join(stored, F.col("key") == F.col(column), "left_semi").select("key")

    def remember(self, kept: DataFrame, seen_at_col: str = "fetched_at") -> None:
        """G5 in the running transaction: upsert the kept articles, rewriting the touched buckets only."""
        tx = self._tx()
        new = cut_lineage(kept.select("canonical_url", "article_id", "content_hash", F.col(seen_at_col).alias("at"), F.col("seq"))
                          .withColumn("bucket", bucket_of(F.col("canonical_url"), self.buckets)))
        touched = named(new)
        if not touched:
            return
        before = self.rows(touched)
        after = state.remember(before, new, "at")
        self._write(self.name, "canonical_url", after, touched)
        stored = self.rows(touched)
        # What a URL's row said before and says now is one less and one more URL of these hashes.
        old = before.join(new.select("canonical_url").distinct(), "canonical_url", "left_semi").select("content_hash", F.lit(-1).alias("d"))
        now = stored.join(new.select("canonical_url").distinct(), "canonical_url", "left_semi").select("content_hash", F.lit(1).alias("d"))
        change = old.unionByName(now).where("content_hash is not null").groupBy("content_hash").agg(F.sum("d").alias("n")).where("n <> 0")
        self._count_hashes(change)

    def replace(self, rows: DataFrame) -> None:
        """Write ``rows`` as the whole set of the running transaction, in ``buckets`` buckets."""
        tx = self._tx()
        tx.settings |= {f"{self.name}.buckets": self.buckets, f"{self.name}.bitmaps": self.bitmaps}
        for table in (self.name, f"{self.name}_hashes"):
            tx.tables.pop(table, None)
            tx.tables.pop(f"{table}_filter", None)
        self._write(self.name, "canonical_url", rows, [])
        hashes = self.rows().where("content_hash is not null").groupBy("content_hash").agg(F.count(F.lit(1)).alias("n"))
        self._count_hashes(hashes)

    def resize(self, buckets: int, bitmaps: int = 1) -> None:
        """Deal all rows to another number of buckets: the one operation that rewrites the history."""
        rows = cut_lineage(self.rows())
        self.buckets, self.bitmaps = buckets, bitmaps
        self.replace(rows)

    def _count_hashes(self, change: DataFrame) -> None:
        table = f"{self.name}_hashes"
        change = cut_lineage(change.withColumn("bucket", bucket_of(F.col("content_hash"), self.buckets)))
        touched = named(change)
        if not touched:
            return
        rows = change.select("content_hash", "n")
        before = self.source.read(table, touched, "content_hash string, n long")
        if before is not None:
            rows = rows.unionByName(before).groupBy("content_hash").agg(F.sum("n").alias("n"))
        self._write(table, "content_hash", rows.where("n > 0"), touched)

    def _write(self, table: str, key: str, rows: DataFrame, touched: list[str]) -> None:
        tx = self._tx()
        tx.settings |= {f"{self.name}.buckets": self.buckets, f"{self.name}.bitmaps": self.bitmaps}
        tx.write_parts(table, rows.withColumn("bucket", bucket_of(F.col(key), self.buckets)), "bucket", touched)
        stored = tx.read(table, touched or None, f"{key} string")
        if stored is None:
            for part in touched:
                tx.tables.get(f"{table}_filter", {}).pop(part, None)
            return
        tx.write_parts(f"{table}_filter", bloom_filters(stored, key, self.buckets, self.bitmaps), "bucket", touched)

    def _tx(self) -> Transaction:
        if not isinstance(self.source, Transaction):
            raise TypeError("The seen-set of a snapshot can't be changed; open a transaction")
        return self.source
