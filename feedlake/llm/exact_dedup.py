"""Exact de-duplication by progressive refinement: length, prefix hash, full hash.

Two texts are equal when they are identical after deleting the six ASCII
white-space characters.  Equal texts have equal lengths and equal prefixes, so

1. rows are counted by normalised length,
2. rows of a length that occurs again are counted by (length, hash of the prefix),
3. only rows of a (length, prefix) group with another row get a hash of their
   whole content, and only those are grouped by it.

Everything is a DataFrame expression.  The counts have a map-side combine; the
table of surviving (length, prefix) groups is written first, so that the join
against it is planned on its real size: broadcast while small, otherwise a
sort-merge join whose hot keys adaptive execution splits on the text side.

Defined cases: null text is the empty text; empty texts equal each other;
rows repeated whole (same doc_id, same text) are members of one group, of which
exactly one row is kept; rows with one doc_id but different texts are separate;
a null doc_id is the smallest.  An empty table gives an empty result.  Extra
columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, ID_KEY, OWN, with_id_key, write_stage

PREFIX_CHARS = 64


def normalised(text: Column) -> Column:
    """The text without its ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, "")


def _keys(docs: DataFrame) -> DataFrame:
    body = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("body", normalised(F.col("text")))
    return body.select("doc_id", "body", F.char_length("text").cast("long").alias("n_chars"),
                       F.char_length("body").alias("len"),
                       F.xxhash64(F.substring("body", 1, PREFIX_CHARS)).alias("prefix"))


def surviving_groups(docs: DataFrame) -> DataFrame:
    """(len, prefix) groups of two or more rows: what levels 1 and 2 leave."""
    keys = _keys(docs).select("len", "prefix")
    # Written, so that the join knows its size: at most one row for each length that texts have.
    lengths = write_stage(keys.groupBy("len").count().where("count > 1").select("len"), "dedup-lengths")
    return keys.join(lengths, "len", "left_semi").groupBy("len", "prefix").count().where("count > 1") \
        .select("len", "prefix", F.lit(True).alias("again"))


def exact_dedup(docs: DataFrame, hash_all: bool = False) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, full_hash.

    ``full_hash`` (SHA-256 of the normalised text) is null for rows that levels
    1 and 2 have already shown to be alone, unless ``hash_all`` asks for the
    digest of every row.
    """
    again = write_stage(surviving_groups(docs), "dedup-groups")
    rows = _keys(docs).join(again, ["len", "prefix"], "left")
    digest = F.sha2(F.col("body").cast("binary"), 256)
    rows = rows.select("doc_id", "n_chars", F.coalesce("again", F.lit(False)).alias("again"),
                       (digest if hash_all else F.when(F.col("again"), digest)).alias("full_hash"),
                       F.monotonically_increasing_id().alias("row"))
    rows = write_stage(rows, "dedup-rows")  # narrow; fixes `row` and spares a second pass over the texts
    groups = rows.where("again").groupBy("full_hash").agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((-F.col("n_chars")).alias("n"), "doc_id", "row")).alias("best")).where("size > 1")
    groups = groups.select(F.col("full_hash").alias("h"), "size", F.col("best.doc_id").alias("best_id"), F.col("best.row").alias("best_row"))
    out = rows.join(groups, F.col("again") & (rows["full_hash"] == F.col("h")), "left")
    return out.select(
        "doc_id",
        F.when(F.col("h").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("h").isNull() | (F.col("row") == F.col("best_row"))).alias("kept"),
        "full_hash")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup() keeps, with all their columns.

    Kept rows are found again by (doc_id, full hash); of rows repeated whole
    one stays.
    """
    digest = OWN + "hash"
    keys = [*ID_KEY, digest]
    kept = with_id_key(exact_dedup(docs, hash_all=True).where("kept")).withColumnRenamed("full_hash", digest).select(*keys)
    keyed = with_id_key(docs).withColumn(digest, F.sha2(normalised(F.col("text")).cast("binary"), 256))
    out = keyed.join(kept, keys, "left_semi").dropDuplicates(keys)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
