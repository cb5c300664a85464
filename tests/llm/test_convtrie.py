"""Conversation trie: against a brute-force trie, over shards and merge rounds of any size, defined cases."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from feedlake.llm import convtrie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(sequences):
    """Rows of all nodes of {conv_id: [(role, text), ...]}."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    kids = {}
    for p in members:
        if p:
            kids.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = kids.get(p, [])
        leaves[p] = sum(leaves[k] for k in below) if below else 1
        own = (len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0
        saved[p] = own + sum(saved[k] for k in below)
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(sequences[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids.get(p, [])), leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def rebuild(rows):
    """The contract's conversations of (conv_id, turn, role, text) rows."""
    talks = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            talks.setdefault(c, []).append(((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest()), role, text))
    talks = {c: [(r, t) for _, r, t in sorted(v)] for c, v in talks.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in talks}
    return {c: talks.get(c - c % 5, [])[:h[c]] + v[h[c]:] for c, v in talks.items()}


def collected(df):
    assert df.columns == COLUMNS
    return sorted((tuple(r) for r in df.collect()), key=repr)


def encoded(spark, sequences):
    """(conv_id, turns) with one id for each distinct turn, as the dictionary gives them."""
    ids = {t: i * 7919 % 100003 for i, t in enumerate(sorted({t for s in sequences.values() for t in s}))}
    rows = [(c, [(ids[t], len(t[1].encode())) for t in s]) for c, s in sequences.items()]
    return spark.createDataFrame(rows, "conv_id long, turns array<struct<id: long, size: long>>").repartition(4)


@pytest.mark.parametrize("partitions,shard_turns,fan_in", [(1, 10 ** 6, 64), (1, 5, 64), (7, 3, 2), (13, 20, 3)])
def test_shards_and_rounds_give_one_trie(spark, partitions, shard_turns, fan_in):
    rnd = random.Random(partitions)
    sequences, pool = {}, [("u" if i % 2 else "a", "é" * i) for i in range(6)]
    for c in range(400):
        depth = rnd.randint(0, 7)
        sequences[c] = [rnd.choice(pool[:2 + d]) for d in range(depth)]
    sequences |= {c: sequences[0] for c in range(400, 550)}                 # a hot sequence
    sequences |= {c: [pool[0]] * 60 + [pool[c % 3]] for c in range(550, 560)}  # deep ones
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = collected(convtrie.build_trie(encoded(spark, sequences), shard_turns, fan_in))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute(sequences)


def test_defined_cases(spark):
    rnd = random.Random(3)
    rows = [(c, rnd.choice([None, 0, 1, 2, 2]), rnd.choice([None, "", "user", "assistant"]), rnd.choice([None, "", "hi", "ho", "x" * 100_000]))
            for c in range(40) for _ in range(rnd.randint(1, 9))]
    rows += [(7, 1, "user", "same")] * 3 + [(None, 0, "user", "nobody's"), (-7, 0, "user", "a"), (-6, 0, "user", "a")]
    want_rows = [r for r in rows]
    # the remainder of a negative id has its sign, as in SQL
    sequences = {}
    for c, turns in rebuild([r for r in want_rows if r[0] is None or r[0] >= 0]).items():
        sequences[c] = turns
    for c in (-7, -6):  # their base -5 is absent
        sequences[c] = [("user", "a")][zlib.crc32(str(c).encode()) % 9:]
    talk = spark.createDataFrame([(*r, 1, "k") for r in rows], "conv_id long, turn long, role string, text string, id int, key string").repartition(5)
    assert collected(convtrie.prefix_trie(talk)) == brute(sequences)
    assert collected(convtrie.prefix_trie(talk.limit(0))) == []


def test_median_insertion_balances():
    tree = convtrie.TernaryTree()
    tree.insert_sorted([([t], [1], 1, t) for t in range(1023)])
    depth, level = 0, [tree.down[0]]
    while level:
        depth += 1
        level = [k for i in level for k in (tree.low[i], tree.high[i]) if k >= 0]
    assert depth == 10
    nodes = tree.nodes()
    assert [v.conv_id for v in nodes[1:]] == list(range(1023)) and nodes[0].n_convs == 1023


def test_members_lists_are_hashed_in_chunks(spark):
    rows = [("a", i) for i in range(2, 3000)] + [("b", 10), ("b", 9)]
    out = convtrie.member_digests(spark.createDataFrame(rows, "key string, conv_id long").repartition(6), chunk_ids=100)
    want = {k: hashlib.sha256(",".join(str(c) for c in sorted(c for x, c in rows if x == k)).encode()).hexdigest() for k in "ab"}
    assert {r["key"]: r["ends_sha256"] for r in out.collect()} == want


def test_query_against_brute_force_and_sql(spark, sf_dir):
    talk = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    got = collected(queries.QUERIES["op12_conversation_trie"](spark, sf_dir))
    assert got == brute(rebuild([tuple(r) for r in talk.select("conv_id", "turn", "role", "text").collect()]))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf_dir}/conversations.parquet'")
    assert sorted(con.execute(queries.ORACLES["op12_conversation_trie"]).fetchall(), key=repr) == got


def test_hot_turns_are_looked_up_in_a_broadcast(spark):
    talk = spark.createDataFrame([(c, 0, "user", "hello") for c in range(300)] + [(c, 1, "user", f"t{c}") for c in range(300)],
                                 "conv_id long, turn long, role string, text string")
    turns = convtrie.encode_turns(talk)
    assert turns.select("id").distinct().count() == 301 and turns.count() == 600
    assert turns.groupBy("digest").agg(F.count_distinct("id").alias("n")).where("n > 1").count() == 0
