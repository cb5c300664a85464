"""Merkle manifest of a dataset by slot pivot.

Every row is a leaf; the leaves of a group (a source), in order, are the bottom of
the group's tree, whose inner nodes are hashes over ``FANOUT`` consecutive nodes.
The groups' roots, in order of the groups, are the bottom of the tree on top.

A level is built by a slot pivot: a node's parent is its position divided by the
fanout and its slot the remainder; conditional aggregates spread the children of
each parent into one column per slot, and the concatenated columns hash to the
parent's digest.  A level is 1/16 of the one below and is written to the shared
folder.  On the way down a node meets its parent's row: the slot columns without
its own, to the left and to the right, are its siblings, and go in front of the
path of the parent.  So every leaf ends with its whole path, from which the proof
and the root follow without any other row.

Positions are ranks within a group, but no group is gathered: rows are
range-partitioned and sorted by (group, order), numbered where they lie, and
shifted by the counts of the same group in earlier partitions.

Digests are lowercase hex text and are hashed as text.

Defined cases: a null column is ``-`` in its leaf, unlike any text; a null doc_id
sorts first and is never tampered with; rows with one doc_id are ordered by leaf,
rows repeated whole have equal leaves, each with its own place; a null source is a
source of its own, the first; a run of one node is hashed like any other; a group
of one leaf has that leaf as its root.  An empty table gives an empty result.
Extra columns are ignored, so their names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import write_stage

FANOUT = 16
SLOTS = [f"slot{i}" for i in range(FANOUT)]
ABOVE = "above_"  # prefix of the parent's columns beside a node's own
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PATH_TYPE = "array<struct<left:string,right:string>>"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(value: Column) -> Column:
    """Lowercase hex SHA-256 of a string's UTF-8 bytes."""
    return F.sha2(value.cast("binary"), 256)


def encoded(value: Column) -> Column:
    """Byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(**changed: Column) -> Column:
    """Digest of a row's leaf columns, some of them replaced."""
    return digest(F.concat(*[encoded(changed.get(c, F.col(c))) for c in LEAF_COLUMNS]))


def tampered_leaf() -> Column:
    """The leaf after lower-casing A-Z in the text of the rows whose id's CRC-32 is divisible by 5; null elsewhere."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return F.when(hit, leaf_digest(text=F.translate("text", UPPER, LOWER)))


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """``rows``, written, with ``pos`` (rank from 0 within ``group`` by ``order``) and ``n`` (the group's rows).

    ``group`` has no nulls.  Equal rows may be far more than a partition holds, so a
    hash of a row number, which decides nothing else, spreads them over partitions.
    """
    spread = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    laid = spread.repartitionByRange(group, *order, "_tie").sortWithinPartitions(group, *order).drop("_tie") \
        .withColumn("_at", F.monotonically_increasing_id())
    laid = write_stage(laid.withColumn("_part", F.shiftright("_at", 33)), name)
    parts = laid.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    of_group = Window.partitionBy(group)
    parts = parts.select(
        group, "_part", F.sum("_n").over(of_group).alias("n"),
        (F.coalesce(F.sum("_n").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) - F.col("_first")).alias("_shift"))
    return laid.join(parts, [group, "_part"]).withColumn("pos", F.col("_at") + F.col("_shift")).drop("_part", "_at", "_shift")


def pivot_parents(nodes: DataFrame) -> DataFrame:
    """(grp, pos, n, digest, slot columns) of the parents of (grp, pos, n, digest) nodes."""
    slot = F.pmod("pos", F.lit(FANOUT))
    spread = nodes.groupBy("grp", F.expr(f"pos div {FANOUT}").alias("pos"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")) \
        .agg(*[F.max(F.when(slot == i, F.col("digest"))).alias(s) for i, s in enumerate(SLOTS)])
    return spread.withColumn("digest", digest(F.concat(*[F.coalesce(s, F.lit("")) for s in SLOTS])))


def build_levels(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The levels of parents above (grp, pos, n, digest) ``leaves``, each written; only groups with several nodes go on."""
    levels, nodes = [], leaves
    while True:
        several = nodes.where("n > 1").select("grp", "pos", "n", "digest")
        if several.isEmpty():
            return levels
        nodes = write_stage(pivot_parents(several), f"{name}-level")
        levels.append(nodes)


def siblings(slot: Column) -> Column:
    """(left, right): the parent's slot columns before and after the own one, side by side."""
    left = F.concat(*[F.when(slot > i, F.col(ABOVE + s)).otherwise("") for i, s in enumerate(SLOTS[:-1])])
    right = F.concat(*[F.when(slot < i, F.coalesce(ABOVE + s, F.lit(""))).otherwise("") for i, s in enumerate(SLOTS) if i])
    return F.struct(left.alias("left"), right.alias("right"))


def add_paths(nodes: DataFrame, parents: DataFrame | None, roots: DataFrame) -> DataFrame:
    """``nodes`` (grp, pos, n, ...) with ``path``: their siblings at this level, then their parent's path.

    A group's only node takes the path of the group's root from ``roots`` (grp, path).
    """
    alone = nodes.where("n = 1").join(roots, "grp").select(*nodes.columns, "path")
    if parents is None:
        return alone
    above = parents.select("grp", F.col("pos").alias("_parent"), *[F.col(s).alias(ABOVE + s) for s in SLOTS], F.col("path").alias(ABOVE + "path"))
    placed = nodes.where("n > 1").withColumn("_parent", F.expr(f"pos div {FANOUT}")).join(above, ["grp", "_parent"])
    path = F.concat(F.array(siblings(F.pmod("pos", F.lit(FANOUT)))), F.col(ABOVE + "path"))
    return placed.withColumn("path", path).select(*nodes.columns, "path").unionByName(alone)


def descend(leaves: DataFrame, levels: list[DataFrame], roots: DataFrame, name: str) -> DataFrame:
    """``leaves`` with their whole paths; the paths of each inner level are written once."""
    above = None
    for level in reversed(levels):
        above = write_stage(add_paths(level, above, roots), f"{name}-paths")
    return add_paths(leaves, above, roots)


def tops(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(grp, digest) of the only node that remains of each group."""
    found = [t.where("n = 1").select("grp", "digest") for t in (leaves, *levels)]
    out = found[0]
    for t in found[1:]:
        out = out.unionByName(t)
    return out


def fold(path: Column, start: Column) -> Column:
    """The digest that ``start`` leads to along ``path``."""
    return F.aggregate(path, start, lambda d, s: digest(F.concat(s["left"], d, s["right"])))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, tampered (leaf or null), subroot, root, path.

    ``path`` holds the siblings (left, right) of every level from the leaf to the root.
    """
    spark = docs.sparkSession
    # A null source is the empty key; the others follow a character that sorts above it.
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    rows = docs.select(*LEAF_COLUMNS).select("doc_id", key.alias("grp"), leaf_digest().alias("digest"), tampered_leaf().alias("tampered"))
    # The texts are read once: laying out a range samples its input first, and then reads the narrow rows.
    leaves = numbered(write_stage(rows, "merkle-rows"), "grp", ["doc_id", "digest"], "merkle-leaves")
    levels = build_levels(leaves, "merkle")
    subroots = write_stage(tops(leaves, levels), "merkle-subroots")
    # The tree on top: one group, whose leaves are the subroots in order of their sources.
    upper = numbered(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest"), "grp", ["of"], "merkle-top")
    upper_levels = build_levels(upper, "merkle-top")
    top = tops(upper, upper_levels).first()  # one row, or none of an empty table
    root = F.lit(top["digest"] if top else None).cast("string").alias("root")
    no_path = spark.range(1).select(F.lit("").alias("grp"), F.array().cast(PATH_TYPE).alias("path"))
    above = descend(upper, upper_levels, no_path, "merkle-top")
    above = write_stage(above.select(F.col("of").alias("grp"), F.col("digest").alias("subroot"), "path"), "merkle-roots")
    out = descend(leaves, levels, above.select("grp", "path"), "merkle")
    out = out.join(above.select("grp", "subroot"), "grp")
    return out.select("doc_id", F.col("digest").alias("leaf"), "tampered", "subroot", root, "path")
