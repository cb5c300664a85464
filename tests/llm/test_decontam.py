"""Edit matching against dynamic programming over whole texts."""

import random

from pyspark.sql import functions as F

from feedlake.llm import decontam


def brute(pattern, text):
    """Least edit distance of the pattern to a substring of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, x in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != x), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(rnd, text, n):
    out = list(text)
    for _ in range(n):
        i, kind = rnd.randrange(len(out)), rnd.randrange(3)
        if kind == 0:
            out[i] = rnd.choice("abcde ")
        elif kind == 1 and len(out) > 1:
            del out[i]
        else:
            out.insert(i, rnd.choice("abcde "))
    return "".join(out)


def noise(rnd, n):
    return "".join(rnd.choice("abcde ") for _ in range(n))


def test_no_match_is_lost_and_none_is_invented():
    rnd = random.Random(5)
    hits = 0
    for _ in range(400):
        items = [(j, noise(rnd, rnd.randint(5, 60))) for j in range(2)]
        matcher = decontam.Matcher(items, 0.2)
        text = decontam.normalise(noise(rnd, rnd.randint(0, 60)) + edited(rnd, items[0][1], rnd.randint(0, 12)) + " " + noise(rnd, rnd.randint(0, 40)))
        got = {i: (d, lo, hi) for i, d, lo, hi in matcher.match(text)}
        for i, (_, norm, k, _, _) in enumerate(matcher.items):
            best = brute(norm, text)
            assert (i in got) == (best <= k)
            if i in got:
                hits += 1
                d, lo, hi = got[i]
                assert d == best and 0 <= lo < hi <= len(text)
                assert brute(norm, text[lo:hi]) == d
    assert hits > 100


def test_pieces_cover():
    for m, k in ((1, 0), (10, 1), (23, 2), (5, 9)):
        parts = decontam.pieces("x" * m, k)
        assert sum(len(p) for _, p in parts) == m and len(parts) <= k + 1


ITEMS = [(1, "The quick brown fox jumps over the lazy dog near the old river bank today."), (2, None), (3, ""), (4, "!!"), (5, "short one"),
         (6, "The quick brown fox jumps over the lazy dog near the old river bank today.")]


def test_defined_cases(spark):
    leak = "the QUICK brown,  fox jumps over the lazy dog near\nthe old river bank today"
    docs = [(1, None, 0), (2, "", 0), (3, "start. " + leak + " end", 0), (3, "start. " + leak + " end", 0), (4, "nothing here", 0),
            (5, "x " * 50000 + leak.replace("lazy", "lzy").replace("old", "odl") + " y" * 50000, 0), (None, "a short one b", 0), (6, "ashort one", 0)]
    df = spark.createDataFrame(docs, "doc_id long, text string, distance long").withColumn("item_id", F.lit("x"))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = decontam.find_leaks(df, items).collect()
    got = sorted(((r["doc_id"], r["item_id"], r["distance"]) for r in rows), key=repr)
    assert got == sorted([(3, 1, 0), (3, 6, 0)] * 2 + [(5, 1, 3), (5, 6, 3), (None, 5, 0), (6, 5, 1)], key=repr)
    for r in rows:
        if r["doc_id"] == 3:
            assert docs[2][1][r["start_char"]:r["end_char"]] == leak
    clean = decontam.drop_leaks(df, items)
    assert clean.columns == df.columns and sorted(r["doc_id"] for r in clean.collect()) == [1, 2, 4]
    none = items.limit(0)
    assert decontam.find_leaks(df, none).collect() == [] and decontam.drop_leaks(df, none).count() == len(docs)
    assert decontam.find_leaks(df.limit(0), items).collect() == []


def test_blocks_of_a_large_benchmark(spark):
    items = spark.createDataFrame([(i, f"item number {i} of a benchmark with words {i * 7}") for i in range(50)], "item_id long, text string")
    blocks = list(decontam.item_blocks(items, block_chars=500))
    assert len(blocks) > 2 and sorted(i for b in blocks for i, _ in b) == list(range(50))
