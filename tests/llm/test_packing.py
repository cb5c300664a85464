"""Packing: the planner against brute force, tokens against the tokenizer, places exactly once."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedlake.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [None, "", "a", "hello world", "<|endoftext|> x", "  \n\t ", "é😀" * 30, "word " * 900, "a" * 3000, "hello world", "It's 12 o'clock, we'll see 　!"]


def test_best_fill_is_closest():
    rnd = random.Random(2)
    for _ in range(200):
        counts = {rnd.randint(1, 15): rnd.randint(1, 3) for _ in range(rnd.randint(0, 4))}
        room = rnd.randint(0, 40)
        sums = {sum(n * k for n, k in zip(counts, ks)) for ks in itertools.product(*[range(c + 1) for c in counts.values()])}
        used = packing.best_fill(counts, room)
        assert all(0 < k <= counts[n] for n, k in used.items())
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room)


def test_plan_uses_all_pieces():
    rnd = random.Random(3)
    counts = {n: rnd.randint(0, 50) for n in range(1, 129)}
    plan = packing.plan_windows(counts, 128)
    used = {}
    for times, window in plan:
        assert sum(n * c for n, c in window.items()) <= 128
        for n, c in window.items():
            used[n] = used.get(n, 0) + times * c
    assert used == {n: c for n, c in counts.items() if c}
    assert len(plan) <= 2 * 128
    total = sum(n * c for n, c in counts.items())
    # no plan needs fewer windows than this: pieces of over half a window never share one
    least = max(-(-total // 128), sum(c for n, c in counts.items() if n > 64))
    assert sum(t for t, _ in plan) <= 1.05 * least + 1
    huge = packing.plan_windows({n: c * 10 ** 9 for n, c in counts.items()}, 128)
    assert len(huge) <= 2 * 128


def test_fast_ids_equal_the_tokenizer():
    enc, slow = packing.Encoder(PATH), Tokenizer.from_file(PATH)
    assert enc.fast is not None
    for t in TEXTS:
        assert list(enc.ids(t or "")) == slow.encode(t or "", add_special_tokens=False).ids
    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.fast is None and list(other.ids("Hello World")) == other.slow.encode("Hello World", add_special_tokens=False).ids


def test_fast_ids_on_documents(sf_dir):
    import pyarrow.parquet as pq

    enc = packing.Encoder(PATH)
    for t in pq.read_table(f"{sf_dir}/documents.parquet", columns=["text"])["text"].to_pylist()[:300]:
        assert list(enc.ids(t or "")) == enc.slow.encode(t or "", add_special_tokens=False).ids


@pytest.mark.parametrize("partitions", [1, 5])
def test_every_token_has_one_place(spark, partitions):
    rows = [(i if i else None, t, i) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length long").withColumn("rank", F.lit(1)).repartition(partitions)
    got = packing.pack_documents(docs, PATH, capacity=64, end_id=1, with_ids=True).cache()
    tok = Tokenizer.from_file(PATH)
    want = {i: np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1]) for i, t, _ in rows if i}
    pieces, where = {}, {}
    for r in got.collect():
        assert r["length"] == len(r["ids"]) <= 64
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        where.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        if r["doc_id"]:
            pieces.setdefault(r["doc_id"], []).append((r["start"], r["ids"], r["doc_tokens"]))
    for i, ids in want.items():
        parts = sorted(pieces[i])
        assert [x for _, p, _ in parts for x in p] == list(ids)
        assert all(n == len(ids) for _, _, n in parts)
        assert [s for s, _, _ in parts] == list(range(0, len(ids), 64))
    for places in where.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    total = sum(n for p in where.values() for _, n in p)
    assert len(where) <= -(-total // 64) + 1
    for r in packing.sequences(got, 64, pad_id=7).collect():
        n = r["n_tokens"]
        assert len(r["ids"]) == (n if n & (n - 1) == 0 else 64) and set(r["ids"][n:]) <= {7}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(df, PATH).collect() == []
