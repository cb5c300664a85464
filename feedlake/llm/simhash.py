"""SimHash near-duplicates, paired exactly through a vantage-point tree.

Fingerprints.  A text is lower-cased (A-Z), cut into words at ASCII white space
and into shingles of three words, repeats included; each shingle votes with the
64 bits of its XXH64, and a fingerprint bit is 1 if more than half the shingles
set it.

Pairs.  The tree partitions fingerprints by Hamming distance.  Level i looks at
one segment of the 64 bits: its vantage point is that segment of ``VANTAGE``,
and the children of a node are the distances 0, 1, 2, ... from it.  By the
triangle inequality two fingerprints whose distances from a vantage point are d
and e differ in at least |d - e| bits of that segment, and the segments' bounds
add up, so a branch is pruned as soon as the sum of |d - e| over its levels
exceeds the radius.  The path from the root is a shard's key.  Each distinct
fingerprint lives in one shard and queries, besides its own, the shards that its
radius overlaps: keys within L1 distance ``radius``, 145 for 8 levels and radius
2, of which one half is enough as the relation is symmetric.  Spark joins
queries and shards on the key; the exact Hamming distance decides.  No pair of a
radius is lost, and a shard is never gathered in a task as a whole.

Equal fingerprints are one node, so groups of copies make no pairs.  Components
come from alternating large-star and small-star steps, which need a logarithmic
number of rounds also for long chains; each round is checkpointed to the shared
folder.

Scale.  The number of query rows is linear in the distinct fingerprints.  The
pairs that reach the exact test are those of overlapping shards: with 8 levels
about 3 in 10,000 of all pairs for evenly spread fingerprints.  So the tree
grows where the data are dense: a shard of more than ``SPLIT`` fingerprints is
split once more, by 16 vantage points on half segments whose distances add up to
those above, and only the queries that reach such a shard go on to its parts (5
in 10 million of all pairs if every shard is split).

Defined cases: null, empty and blank texts have the fingerprint zero and are
linked like any other; fewer words than a shingle make one shingle; repeated
rows get equal results; a null doc_id takes part, but is a component's smallest
id only if there is no other; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, join_hot, without_marked, write_stage

SHINGLE_WORDS = 3
RADIUS = 2
LEVELS = 8
#: A shard of more fingerprints than this is split, up to so many levels.
SPLIT = 64
DEEPEST = 16
SEED = 42
#: Any fixed value serves; this one has about half its bits set.
VANTAGE = 0x9E3779B97F4A7C15
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    digest, votes = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for i in range(0, n, _BLOCK):  # blocks bound the memory that a very long text needs
        part = words[i:min(i + _BLOCK, n) + shingle_words - 1]
        grams = zip(*[part[k:] for k in range(shingle_words)]) if len(part) >= shingle_words else [part]
        h = np.array([digest(b" ".join(g), SEED) for g in grams], dtype=">u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > n).tobytes(), "big")


def text_digest() -> Column:
    return F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)


def with_fingerprint(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, digest: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number with the same bits; with ``digest`` also the text's SHA-256."""
    source = docs.select("doc_id", "text", *([text_digest().alias("digest")] if digest else []))
    kept = [c for c in source.columns if c != "text"]
    schema = source.select(*kept, F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column("text")
            fps = np.array([fingerprint(texts[i].as_py(), shingle_words) for i in range(b.num_rows)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], pa.array(fps.view(np.int64), pa.int64())], [*kept, "fp"])

    return source.mapInArrow(run, schema)


def shard_key(fp: Column, levels: int = LEVELS) -> Column:
    """Path in the tree: the distance at each level, in a field of its own of one long."""
    width, room = 64 // levels, 64 // levels
    off = fp.bitwiseXOR(F.lit(VANTAGE - (1 << 64)))
    key = F.lit(0).cast("long")
    for i in range(levels):
        segment = F.shiftrightunsigned(off, i * width).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        key = key.bitwiseOR(F.shiftleft(F.bit_count(segment).cast("long"), i * room))
    return key


def overlaps(levels: int = LEVELS, radius: int = RADIUS, top: int | None = None) -> list[tuple[int, bool]]:
    """Moves between shards of ``levels`` distances within the radius, each with whether it stays in the shard above.

    The shard above is the one of ``top`` levels (the same, if not given), whose
    distances are sums of neighbouring ones.  As links are symmetric, one of each
    two opposite moves between shards above is enough; moves within one are all
    there, and the order of the two fingerprints makes each pair occur once.

    A field that would fall below 0 or rise above its segment's width names no
    shard: it wraps to a value that no distance has.
    """
    room, each = 64 // levels, levels // (top or levels)
    moves: list[tuple[int, bool]] = []

    def add(i: int, left: int, key: int, above: int, sums: tuple[int, ...]) -> None:
        if i and i % each == 0:
            sums, above = (*sums, above), 0
        if i == levels:
            first = next((x for x in sums if x), 0)
            if first >= 0:
                moves.append((((key + (1 << 63)) % (1 << 64)) - (1 << 63), first == 0))
            return
        for step in range(-left, left + 1):
            add(i + 1, left - abs(step), key + step * (1 << (i * room)), above + step, sums)

    add(0, radius, 0, 0, ())
    return moves


def close_pairs(fps: DataFrame, radius: int = RADIUS, levels: int = LEVELS, split: int = SPLIT) -> DataFrame:
    """(a, b) of distinct fingerprints that differ in 1 to ``radius`` bits, each pair once; ``fps`` has distinct ``fp``.

    A shard of more than ``split`` fingerprints is split by twice as many
    vantage points on segments of half the width, and queries that reach it go
    on to its parts.
    """
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    top, homes, queries, found = levels, fps, fps, None
    while True:
        moves = F.array(*[F.struct(F.lit(m).cast("long").alias("move"), F.lit(home).alias("home")) for m, home in overlaps(levels, radius, top)])
        shards = homes.select(F.col("fp").alias("b"), shard_key(F.col("fp"), levels).alias("shard"))
        asked = queries.select(F.col("fp").alias("a"), shard_key(F.col("fp"), levels).alias("own")) \
            .select("a", "own", F.explode(moves).alias("m")) \
            .select("a", (F.col("own") + F.col("m.move")).alias("shard"), F.col("m.home").alias("home"))
        full = None
        if 2 * levels <= DEEPEST:
            full = write_stage(shards.groupBy("shard").count().where(F.col("count") > split).select("shard"), "simhash-full")
            full = None if full.isEmpty() else full
        here = shards if full is None else shards.join(full, "shard", "left_anti")
        pairs = asked.join(here.hint("shuffle_hash"), (asked["shard"] == here["shard"]) & near & (~F.col("home") | (F.col("a") < F.col("b")))).select("a", "b")
        found = pairs if found is None else found.unionByName(pairs)
        if full is None:
            return found
        homes = write_stage(shards.join(full, "shard", "left_semi").select(F.col("b").alias("fp")), "simhash-homes")
        queries = write_stage(asked.join(full, "shard", "left_semi").select(F.col("a").alias("fp")).distinct(), "simhash-queries")
        levels *= 2


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edges (a, b).

    Large-star and small-star steps alternate until the edges are stars.
    """
    edges = cut_lineage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m")).withColumnRenamed("a", "u")
        # large star: every larger neighbour of u links to u's smallest
        large = both.join(least, both["a"] == least["u"]).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .where("a <> b").distinct()
        # small star: u and its smaller neighbours link to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
        joined = large.join(low, large["a"] == low["u"])
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(joined.select("a", F.col("m").alias("b"))) \
            .where("a <> b").distinct()
        new = cut_lineage(small)
        # Stars with the smallest node in the middle: every edge's smaller end is never a larger one.
        open_ends = new.join(new.select(F.col("a").alias("x")).distinct(), F.col("b") == F.col("x"), "left_semi").limit(1).count()
        twice = new.groupBy("a").count().where("count > 1").limit(1).count()
        edges = new
        if not open_ends and not twice:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def linked_nodes(nodes: DataFrame, radius: int, levels: int) -> DataFrame:
    """The rows of ``nodes`` whose fingerprint has a link, with their component's ``root``."""
    roots = components(close_pairs(nodes.select("fp"), radius, levels))
    roots = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    return roots.join(nodes, roots["node"] == nodes["fp"]).drop("node")


def best_of_components(nodes: DataFrame, radius: int, levels: int) -> DataFrame:
    """(fp, n, top): for every row (fp, n, best) of ``nodes`` the smallest ``best`` of its component; written."""
    linked = write_stage(linked_nodes(nodes, radius, levels), "simhash-linked")
    tops = linked.groupBy("root").agg(F.min("best").alias("top"))
    better = linked.join(tops, "root").select("fp", "top")
    return write_stage(nodes.join(better, "fp", "left").select("fp", "n", F.coalesce("top", "best").alias("top")), "simhash-named")


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS, levels: int = LEVELS) -> DataFrame:
    """One row per input row: doc_id, fp, component_id (smallest doc_id reachable over links, itself included)."""
    prints = write_stage(with_fingerprint(docs, shingle_words), "simhash")
    nodes = write_stage(prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("best")), "simhash-nodes")
    named = best_of_components(nodes, radius, levels)
    return join_hot(prints, named, "fp", "n").select("doc_id", "fp", F.col("top").alias("component_id"))


def keep_one(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """Exactly one row of ``docs`` of each component, with all its columns.

    It is the row of the smallest doc_id, a null one last, then of the smallest
    digest of the text.  Rows are told apart by doc_id and text, so rows that
    share an id, or have none, stay if their components differ; of rows
    repeated whole one stays.
    """
    prints = with_fingerprint(docs, shingle_words, digest=True)
    rows = write_stage(prints.groupBy("doc_id", "digest", "fp").agg(F.count(F.lit(1)).alias("copies")), "simhash-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    nodes = write_stage(rows.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("best")), "simhash-nodes")
    joined = join_hot(rows, best_of_components(nodes, radius, LEVELS), "fp", "n")
    kept = F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("digest") == F.col("top.digest"))
    marked = write_stage(joined.select("doc_id", "digest", "copies", kept.alias("once")).where("not once or copies > 1"), "simhash-marked")
    return without_marked(docs, text_digest(), marked)
