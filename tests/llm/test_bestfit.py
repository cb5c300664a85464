"""Best-fit packing: the plan against best-fit decreasing over single pieces, places exactly once, defined cases."""

import bisect
import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from feedlake.llm import bestfit, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


def single_pieces(lengths, capacity):
    """Rooms left in every sequence by best-fit decreasing, piece by piece."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        i = bisect.bisect_left(rooms, n)
        room = rooms.pop(i) if i < len(rooms) else capacity
        bisect.insort(rooms, room - n)
    return rooms


def test_plan_equals_best_fit_of_single_pieces():
    rnd = random.Random(1)
    for capacity in (7, 16, 64, 128):
        for _ in range(60):
            counts = {n: rnd.choice([0, 1, 2, 5, 30]) for n in range(1, capacity + 1)}
            served, filled = {}, {}
            for length, a, b, each, first, offset in bestfit.plan_slots(counts, capacity):
                for r in range(a, b):
                    served.setdefault(length, []).append(r)
                    filled.setdefault(first + (r - a) // each, []).append((offset + (r - a) % each * length, length))
            assert {n: sorted(r) for n, r in served.items()} == {n: list(range(c)) for n, c in counts.items() if c}
            for places in filled.values():
                at = 0
                for offset, length in sorted(places):
                    assert offset == at
                    at += length
                assert at <= capacity
            assert sorted(filled) == list(range(len(filled)))
            rooms = single_pieces([n for n, c in counts.items() for _ in range(c)], capacity)
            assert sorted(capacity - sum(n for _, n in p) for p in filled.values()) == rooms


def test_plan_grows_with_the_capacity_only():
    rnd = random.Random(2)
    shares = {n: rnd.random() / n for n in range(1, 1025)}
    for scale in (10 ** 3, 10 ** 6, 10 ** 12):
        plan = bestfit.plan_slots({n: int(s * scale) for n, s in shares.items()})
        assert len(plan) < 4096


def test_cut_points():
    assert bestfit.cut_points(1, 4) == [0] and bestfit.cut_points(4, 4) == [0]
    assert bestfit.cut_points(5, 4) == [0, 1] and bestfit.cut_points(8, 4) == [0, 4] and bestfit.cut_points(11, 4) == [0, 3, 7]


def check(rows, texts, capacity=1024, end_id=2):
    """Every id of every text in exactly one piece, and gapless sequences; returns the number of sequences."""
    tok = Tokenizer.from_file(PATH)
    pieces, filled = {}, {}
    for r in rows:
        pieces.setdefault(r["doc_id"], []).append(r)
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    want, got = [], []
    for text in texts:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, end_id], dtype="<u4")
        odd = len(ids) % capacity or capacity
        starts = [0, *range(odd, len(ids), capacity)]
        want += [(i, s, e - s, zlib.crc32(ids[s:e].tobytes())) for i, (s, e) in enumerate(zip(starts, [*starts[1:], len(ids)]))]
    got = [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got) == sorted(want)
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(filled) == len(single_pieces([w[2] for w in want], capacity))
    return len(filled)


def test_defined_cases(spark):
    texts = [None, "", "a", "hello world", "same", "same", "word " * 5000, "a" * 3000, "é😀" * 400]
    rows = [(i, t, 1, "x") for i, t in enumerate(texts)] + [(4, "same", 1, "x"), (None, "no id", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int, sequence_id string").repartition(3)
    got = [r.asDict() for r in bestfit.best_fit_pack(docs, PATH).collect()]
    check(got, [r[1] for r in rows])
    assert sorted(r["length"] for r in got if r["doc_id"] is None) == [3]
    empty = bestfit.best_fit_pack(docs.limit(0), PATH)
    assert empty.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and empty.collect() == []


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = [r.asDict() for r in queries.QUERIES["op11_best_fit_packing"](spark, sf_dir).collect()]
    used = check(got, [r["text"] for r in docs.select("text").collect()])
    assert used <= -(-sum(r["length"] for r in got) // 1024) * 1.01 + 1
