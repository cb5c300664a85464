"""SimHash: fingerprints, exact pairs and components against brute force."""

import random
from itertools import product

import xxhash
from pyspark.sql import functions as F

from feedlake.llm import simhash
from feedlake.llm.common import join_hot


def naive(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def brute_components(fps, radius=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_fingerprint(monkeypatch):
    rnd = random.Random(3)
    texts = [None, "", " \t", "One", "one TWO", "É é x y", "a b c d e"] + [" ".join(rnd.choice("abcdef") for _ in range(rnd.randint(1, 80))) for _ in range(40)]
    assert [simhash.fingerprint(t) for t in texts] == [naive(t) for t in texts]
    monkeypatch.setattr(simhash, "_BLOCK", 7)  # block borders lose no shingle
    assert [simhash.fingerprint(t) for t in texts] == [naive(t) for t in texts]
    spark_hash = xxhash.xxh64_intdigest(b"x y z", 42)
    assert simhash.fingerprint("x y z") == spark_hash


def test_overlaps_are_half_of_the_l1_ball():
    for levels in (2, 4, 8):
        ball = [v for v in product(range(-2, 3), repeat=levels) if sum(map(abs, v)) <= 2] if levels < 8 else range(145)
        assert len(simhash.overlaps(levels, 2)) == (len(ball) + 1) // 2
    assert len(set(simhash.overlaps(16, 2))) == 273


def test_moves_within_a_split_shard():
    """Every fine move within the radius is there once, but for the opposite of one that leaves the shard above."""
    fine = [v for v in product(range(-2, 3), repeat=4) if sum(map(abs, v)) <= 2]
    above = [(v[0] + v[1], v[2] + v[3]) for v in fine]
    got = simhash.overlaps(4, 2, top=2)
    assert len({m for m, _ in got}) == len(got) == sum(a >= (0, 0) for a in above)
    assert sum(home for _, home in got) == above.count((0, 0))


def planted(seed=1, n=400):
    rnd = random.Random(seed)
    fps = {0, (1 << 64) - 1, simhash.VANTAGE, simhash.VANTAGE ^ ((1 << 64) - 1)}
    for _ in range(n):
        f = rnd.getrandbits(64)
        fps.add(f)
        for _ in range(rnd.randint(0, 4)):  # chains of near fingerprints
            for _ in range(rnd.randint(1, 4)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    return sorted(fps)


def test_close_pairs_and_components(spark):
    fps = planted()
    want = {(signed(a), signed(b)) for a in fps for b in fps if a != b and (a ^ b).bit_count() <= 2}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    for levels in (4, 8, 16):
        got = [(r["a"], r["b"]) for r in simhash.close_pairs(df, 2, levels).collect()]
        assert len(got) == len(set(got)) and {frozenset(p) for p in got} == {frozenset(p) for p in want}
    for levels, split in ((8, 0), (8, 1), (4, 0), (4, 3), (2, 5)):  # shards that are too full are split
        got = [(r["a"], r["b"]) for r in simhash.close_pairs(df, 2, levels, split).collect()]
        assert len(got) == len(set(got)) and {frozenset(p) for p in got} == {frozenset(p) for p in want}
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.close_pairs(df)).collect()}
    brute = brute_components(fps)
    groups = {}
    for f, top in brute.items():
        groups.setdefault(top, []).append(signed(f))
    for members in groups.values():
        if len(members) > 1:
            assert {roots.get(m, m) for m in members} == {min(members)}


def test_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 400)] + [(1000, 1000 + i) for i in range(1, 50)] + [(7, 7)]
    random.Random(0).shuffle(edges)
    got = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 401)}, **{1000 + i: 1000 for i in range(1, 50)}}


def test_defined_cases(spark):
    text = "one two three four five six seven"
    rows = [(5, None, 1), (3, "", 2), (9, "  ", 3), (8, text, 4), (6, text.upper(), 5), (6, text.upper(), 5), (None, text, 6), (None, "alone here now ok", 7), (2, "other words are in this one", 8)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long").withColumn("component_id", F.lit("x"))
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=repr)
    assert got == sorted([(5, 3), (3, 3), (9, 3), (8, 6), (6, 6), (6, 6), (None, 6), (None, None), (2, 2)], key=repr)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted([3, 6, 2, None], key=repr)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] and simhash.keep_one(empty).collect() == []


def test_keep_one_row_of_each_component(spark):
    """Rows without an id, or with a repeated one, are told apart by their text."""
    text = "one two three four five six seven"
    rows = [(None, "first of the texts without any id", "a"), (None, "another one that has no number at all", "b"), (None, "another one that has no number at all", "b"),
            (None, "third and quite different line of words", "c"), (6, text, "near"), (6, "a text that only this row has", "d"),
            (4, text.upper(), "e"), (None, text, "near"), (9, "repeated id here is nine", "f"), (9, "nine again but other words follow it", "g"), (2, None, "h"), (None, "", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, mark string")
    kept = simhash.keep_one(df.repartition(5))
    assert kept.columns == df.columns
    assert sorted(r["mark"] for r in kept.collect()) == ["a", "b", "c", "d", "e", "f", "g", "h"]
    assert {tuple(r) for r in kept.collect()} <= set(rows)


def test_join_of_hot_keys(spark):
    """Rows of a key that holds most rows, of rare keys and of none."""
    rows = spark.createDataFrame([(1, i) for i in range(3000)] + [(2, 0), (3, 0), (3, 1)], "fp long, i long")
    named = spark.createDataFrame([(1, 3000, "a"), (2, 1, "b"), (3, 2, None)], "fp long, n long, top string")
    got = sorted(map(tuple, join_hot(rows, named, "fp", "n").select("fp", "i", "top").collect()), key=repr)
    assert got == sorted([(1, i, "a") for i in range(3000)] + [(2, 0, "b"), (3, 0, None), (3, 1, None)], key=repr)
    assert join_hot(rows.limit(0), named.limit(0), "fp", "n").collect() == []
