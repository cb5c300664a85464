"""Prefix trie of conversations: ternary search trees over range shards, merged at their boundaries.

A conversation is a sequence of turns.  Distinct turns (role, text) get integer ids
from a dictionary, so sequences are arrays of ids; equal sequences collapse to one
with its number of conversations.  Sequences are range-partitioned in their order,
and a task cuts its sorted sequences into shards of bounded size.

A shard is a ternary search tree, filled by inserting the median of every range of
its sorted sequences first, so the search trees of siblings are balanced.  One
iterative traversal (explicit stack) gives nodes in order with their keys, and the
way back accumulates members, leaves and savings.

Shards are neighbours in one order, so a node reaches beyond its shard only if it
is a prefix of the shard's first or last sequence.  Those nodes stay open, all others are
final.  Open nodes of neighbouring shards are merged: equal keys add up, and what is
no longer on the first or last path of the merged range closes, adding itself to
its parent.  That happens within a task from shard to shard, then between tasks in rounds of
``FAN_IN`` ranges, until one range is left.  A range has at most two paths of open
nodes, however many conversations share them.

Defined cases: rows without conv_id belong to no conversation and are ignored;
null role or text is the empty text; turns are ordered by turn (null first), then
role, then the text's digest, and repeated rows are repeated turns; texts of any
length count by their digest and byte length; an empty table gives an empty
result.  Extra columns are ignored, so their names cannot clash.  The ids of one
conversation (16 bytes a turn) are held by one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_stage

#: A task closes a shard at so many turns.
SHARD_TURNS = 50_000
#: Neighbouring ranges merged by one task of a round.
FAN_IN = 64
#: Members' ids of one chunk of the ordered lists.
CHUNK_IDS = 20_000
#: A turn that fills more than 1 / HEAVY of all rows is looked up in a broadcast of at most HEAVY rows.
HEAVY = 256

NO_MEMBER = (1 << 63) - 1

#: A node, final or open.  For an open node the sums cover its closed descendants only.
NODE_FIELDS = ("key string, parent_key string, depth long, n_convs long, conv_id long, n_ends long, first_end long, "
               "n_children long, n_leaves long, saved_tokens long, text_bytes long")
STEP_SCHEMA = f"range long, final boolean, was_open boolean, on_first boolean, on_last boolean, {NODE_FIELDS}, parent_conv_id long"
FIELDS = dict(f.split() for f in STEP_SCHEMA.split(", "))
ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


@dataclass
class Node:
    key: str
    parent_key: str
    depth: int
    n_convs: int
    conv_id: int
    n_ends: int
    first_end: int
    n_children: int = 0
    n_leaves: int = 0
    saved_tokens: int = 0
    text_bytes: int = 0
    parent_conv_id: int | None = None
    was_open: bool = False
    on_first: bool = False
    on_last: bool = False


class TernaryTree:
    """Sequences of (token, text bytes) in a ternary search tree: smaller, equal (next turn) and larger links."""

    def __init__(self):
        self.token: list[int] = []
        self.size: list[int] = []
        self.low: list[int] = []
        self.high: list[int] = []
        self.down: list[int] = [-1]  # of the root, then of each node: entry i + 1
        self.ends: list[int] = [0]
        self.first: list[int] = [NO_MEMBER]

    def insert(self, tokens, sizes, n: int, first: int) -> None:
        at = 0  # 0: the root; i + 1: node i
        for token, size in zip(tokens, sizes):
            i, link, owner = self.down[at], self.down, at
            while i >= 0 and self.token[i] != token:
                link = self.low if token < self.token[i] else self.high
                owner, i = i, link[i]
            if i < 0:
                i = len(self.token)
                link[owner] = i
                self.token.append(token)
                self.size.append(size)
                self.low.append(-1)
                self.high.append(-1)
                self.down.append(-1)
                self.ends.append(0)
                self.first.append(NO_MEMBER)
            at = i + 1
        self.ends[at] += n
        self.first[at] = min(self.first[at], first)

    def insert_sorted(self, rows: list[tuple]) -> None:
        """(tokens, sizes, n, first) rows in the order of their tokens, the median of each range first."""
        todo = [(0, len(rows))]
        while todo:
            a, b = todo.pop()
            if a < b:
                m = (a + b) // 2
                self.insert(*rows[m])
                todo += [(m + 1, b), (a, m)]

    def nodes(self) -> list[Node]:
        """All nodes in order, the root first; counts and minima cover the whole subtrees."""
        found = [Node(key_of(hashlib.sha256()), "", 0, self.ends[0], self.first[0], self.ends[0], self.first[0])]
        parents = [-1]
        todo = [(self.down[0], 0, hashlib.sha256(), False)]  # (node, its parent's place, the parent's hash, smaller ones done)
        while todo:
            i, parent, state, ready = todo.pop()
            if i < 0:
                continue
            if not ready:
                todo += [(self.high[i], parent, state, False), (i, parent, state, True), (self.low[i], parent, state, False)]
                continue
            state = state.copy()
            state.update(b"%d," % self.token[i])
            found.append(Node(key_of(state), found[parent].key, found[parent].depth + 1, self.ends[i + 1], self.first[i + 1],
                              self.ends[i + 1], self.first[i + 1], text_bytes=self.size[i]))
            parents.append(parent)
            todo.append((self.down[i + 1], len(found) - 1, state, False))
        for at in range(len(found) - 1, 0, -1):
            node, parent = found[at], found[parents[at]]
            parent.n_convs += node.n_convs
            parent.conv_id = min(parent.conv_id, node.conv_id)
        return found


def key_of(state) -> str:
    """128 bits of the hash over a prefix's ids, each followed by a comma."""
    return state.hexdigest()[:32]


def path_keys(tokens) -> list[str]:
    """Keys of all prefixes of a sequence, the empty one first."""
    state = hashlib.sha256()
    keys = [key_of(state)]
    for token in tokens:
        state.update(b"%d," % token)
        keys.append(key_of(state))
    return keys


def close(nodes: list[Node], first: set[str], last: set[str]) -> tuple[list[Node], list[Node]]:
    """(final, open) of the nodes of a range, given in order: open are those on its first or last path.

    A node that becomes final adds its leaves and savings, and itself as a child, to its parent.
    """
    by_key = {v.key: v for v in nodes}
    final, still = [], []
    for v in reversed(nodes):  # descendants come later in the order
        v.on_first, v.on_last = v.key in first, v.key in last
        if v.on_first or v.on_last:
            v.was_open = True
            still.append(v)
            continue
        if not v.n_children:
            v.n_leaves = 1
        v.saved_tokens += (v.n_convs - 1) * v.text_bytes
        parent = by_key.get(v.parent_key)
        if parent is not None:  # the root has none
            parent.n_children += 1
            parent.n_leaves += v.n_leaves
            parent.saved_tokens += v.saved_tokens
        final.append(v)
    for v in final:  # the smallest member of a final parent is known
        parent = by_key.get(v.parent_key)
        if parent is not None and not (parent.on_first or parent.on_last):
            v.parent_conv_id = parent.conv_id
    still.reverse()
    return final, still


def merged(left: list[Node], right: list[Node]) -> list[Node]:
    """Open nodes of two neighbouring ranges, in order; equal keys add up."""
    by_key = {v.key: v for v in left}
    out = list(left)
    for v in right:
        known = by_key.get(v.key)
        if known is None:
            by_key[v.key] = v
            out.append(v)
            continue
        known.n_convs += v.n_convs
        known.conv_id = min(known.conv_id, v.conv_id)
        known.n_ends += v.n_ends
        known.first_end = min(known.first_end, v.first_end)
        known.n_children += v.n_children
        known.n_leaves += v.n_leaves
        known.saved_tokens += v.saved_tokens
        known.on_last = v.on_last
    return in_order(out)


def in_order(nodes: list[Node]) -> list[Node]:
    """Parents before their descendants (by depth; the order of siblings doesn't matter for closing)."""
    return sorted(nodes, key=lambda v: v.depth)


def rows_of(rng: int, final: list[Node], still: list[Node]) -> pa.RecordBatch:
    """Final and open nodes of a range as rows of ``STEP_SCHEMA``."""
    nodes = [*final, *still]
    known = {"range": [rng] * len(nodes), "final": [True] * len(final) + [False] * len(still)}
    columns = [known[c] if c in known else [getattr(v, c) for v in nodes] for c in FIELDS]
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[t]) for c, t in zip(columns, FIELDS.values())], list(FIELDS))


def shard_partition(batches: Iterator[pa.RecordBatch], shard_turns: int = SHARD_TURNS) -> Iterator[pa.RecordBatch]:
    """Sorted (ids, sizes, n, first) rows of a partition -> its final nodes, and the open ones of the whole partition."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    still: list[Node] = []
    first: set[str] = set()
    shard, turns = [], 0

    def flush():
        nonlocal still, first, shard, turns
        tree = TernaryTree()
        tree.insert_sorted(shard)
        if not first:
            first = set(path_keys(shard[0][0]))
        last = set(path_keys(shard[-1][0]))
        final, still = close(merged(still, tree.nodes()) if still else tree.nodes(), first, last)
        shard, turns = [], 0
        return final

    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in ("ids", "sizes", "n", "first"))):
            shard.append(row)
            turns += len(row[0]) + 1
            if turns >= shard_turns:
                yield rows_of(part, flush(), [])
    if shard:
        yield rows_of(part, flush(), [])
    if still:
        yield rows_of(part, [], still)


def merge_ranges(spans: list[list[Node]], closing: bool) -> tuple[list[Node], list[Node]]:
    """Open nodes of neighbouring ranges, in order of the ranges -> (final, open) nodes of the whole."""
    first = {v.key for v in spans[0] if v.on_first}
    last = {v.key for v in spans[-1] if v.on_last}
    nodes: list[Node] = []
    for span in spans:
        nodes = merged(nodes, span) if nodes else in_order(span)
    return close(nodes, set() if closing else first, set() if closing else last)


def merge_round(opened: DataFrame, fan_in: int, closing: bool) -> DataFrame:
    """One round: each ``fan_in`` neighbouring ranges become one (``closing``: the last, nothing stays open)."""
    def run(table: pa.Table) -> pa.Table:
        spans: dict[int, list[Node]] = {}
        for row in table.to_pylist():
            spans.setdefault(row["range"], []).append(Node(**{c: row[c] for c in FIELDS if c not in ("range", "final")}))
        final, still = merge_ranges([spans[r] for r in sorted(spans)], closing)
        return pa.Table.from_batches([rows_of(min(spans) // fan_in, final, still)])

    return opened.groupBy(F.expr(f"`range` div {fan_in}").alias("_group")).applyInArrow(run, STEP_SCHEMA)


def first_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from the one that its id names: CRC-32 of the id's decimal text, modulo 9."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % 9).cast("int")


def encode_turns(talk: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, id, size of every turn; ids are those of a dictionary of distinct turns."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = talk.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.sha2(text.cast("binary"), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256).alias("entry"))
    turns = write_stage(turns, "trie-turns")
    counted = turns.groupBy("entry").agg(F.count(F.lit(1)).alias("n"))
    words = write_stage(counted.select("entry", "n", F.monotonically_increasing_id().alias("id")), "trie-dictionary")
    total = words.agg(F.sum("n")).first()[0] or 0
    heavy = words.where(F.col("n") * HEAVY > total)  # fewer than HEAVY rows
    quick = turns.join(F.broadcast(heavy.select("entry", "id")), "entry", "left")
    rare = quick.where("id is null").drop("id").join(words.where(F.col("n") * HEAVY <= total).select("entry", "id"), "entry")
    return quick.where("id is not null").unionByName(rare).drop("entry")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, turns (array of id, size): the first turns of conversation c - c % 5, then the own ones after as many."""
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "digest", "id", "size")))
    whole = turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["id"], t["size"])).alias("turns"))
    whole = write_stage(whole, "trie-conversations")
    heads = whole.select(F.col("conv_id").alias("base"), F.slice("turns", 1, 8).alias("head"))
    h = first_turns(F.col("conv_id"))
    # An own turn stands after the first h; slice() asks for a length of at least 0.
    own = F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0)))
    joined = whole.withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    taken = F.when(F.col("head").isNotNull() & (h > 0), F.slice("head", 1, F.greatest(h, F.lit(1)))).otherwise(F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(taken, own).alias("turns"))


def sequence_key(ids: Column) -> Column:
    """The key of a whole sequence, as :func:`path_keys` gives it."""
    text = F.array_join(F.transform(ids, lambda i: F.concat(i.cast("string"), F.lit(","))), "")
    return F.substring(F.sha2(text.cast("binary"), 256), 1, 32)


def member_digests(members: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """(key, ends_sha256): digest of each key's conv_ids, ascending and comma-joined, from (key, conv_id) rows.

    Range partitions in (key, conv_id) order turn runs of ids into chunks of text;
    then a key's chunks pass through one running hash.  No list is held whole.
    """
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, ids):
            return pa.RecordBatch.from_arrays([pa.array([key]), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["key", "first", "ids"])

        key, ids = None, []
        for b in batches:
            for k, c in zip(b.column("key").to_pylist(), b.column("conv_id").to_pylist()):
                if ids and (k != key or len(ids) >= chunk_ids):
                    yield out(key, ids)
                    ids = []
                key = k
                ids.append(c)
        if ids:
            yield out(key, ids)

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, hashlib.sha256()
        for b in batches:
            done: list[tuple[str, str]] = []
            for k, text in zip(b.column("key").to_pylist(), b.column("ids").to_pylist()):
                if k == key:
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256()
                state.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done]) for i in (0, 1)], ["key", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    laid = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(chunks, "key string, first long, ids string")
    return laid.repartition("key").sortWithinPartitions("key", "first").mapInArrow(hashes, "key string, ends_sha256 string")


def build_trie(sequences: DataFrame, shard_turns: int = SHARD_TURNS, fan_in: int = FAN_IN) -> DataFrame:
    """Nodes of the trie over (conv_id, turns): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = sequences.select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.size").alias("sizes"))
    rows = write_stage(rows.withColumn("key", sequence_key(F.col("ids"))), "trie-sequences")
    distinct = rows.groupBy("key").agg(F.any_value("ids").alias("ids"), F.any_value("sizes").alias("sizes"),
                                       F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"))
    distinct = write_stage(distinct, "trie-distinct")
    several = rows.select("key", "conv_id").join(distinct.where("n > 1").select("key"), "key", "left_semi")
    shards = distinct.repartitionByRange("ids").sortWithinPartitions("ids").select("ids", "sizes", "n", "first") \
        .mapInArrow(lambda batches: shard_partition(batches, shard_turns), STEP_SCHEMA)
    shards = write_stage(shards, "trie-shards")
    opened, rounds = shards.where("not final"), []
    ranges = opened.agg(F.max("range")).first()[0]
    while ranges is not None:
        done = ranges < fan_in
        step = write_stage(merge_round(opened, fan_in, done), "trie-merge")
        rounds.append(step.where("final"))
        if done:
            break
        opened = step.where("not final")
        ranges = opened.agg(F.max("range")).first()[0]
    # A final node whose parent was still open learns the parent's smallest member now.  The join holds the range,
    # so the children of a parent that spans many ranges meet it range by range.
    late = shards.limit(0)
    for step in rounds:
        late = late.unionByName(step)
    members = late.select("key", F.col("conv_id").alias("member"))
    parents = shards.where("not final").select("range", "key").join(members, "key").select("range", "key", "member") \
        .unionByName(shards.where("final and was_open").select("range", "key", F.col("conv_id").alias("member")))
    waiting = shards.where("final and parent_conv_id is null")
    early = waiting.drop("parent_conv_id").join(
        parents.select("range", F.col("key").alias("parent_key"), F.col("member").alias("parent_conv_id")), ["range", "parent_key"])
    # A node that closed later meets at most one row of each range.
    late = late.drop("parent_conv_id").join(members.select(F.col("key").alias("parent_key"), F.col("member").alias("parent_conv_id")), "parent_key", "left")
    nodes = shards.where("final and parent_conv_id is not null")
    for part in (early, late):
        nodes = nodes.unionByName(part.select(*nodes.columns))
    nodes = nodes.join(member_digests(several), "key", "left")
    one = F.sha2(F.col("first_end").cast("string").cast("binary"), 256)
    none = F.sha2(F.lit("").cast("binary"), 256)
    ends = F.when(F.col("n_ends") == 0, none).when(F.col("n_ends") == 1, one).otherwise(F.col("ends_sha256"))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", ends.alias("ends_sha256"))


def prefix_trie(talk: DataFrame) -> DataFrame:
    """Nodes of the trie of the rebuilt conversations of (conv_id, turn, role, text) rows."""
    return build_trie(rebuilt(encode_turns(talk)))
