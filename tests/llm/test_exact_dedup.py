"""Exact dedup against a brute-force grouping."""

import hashlib
import re
from collections import defaultdict

import pytest

from feedlake.llm import exact_dedup

ROWS = [
    (1, "a b\tc", 10), (2, "abc", 1), (3, "a  b c", 3), (4, None, 4), (5, "", 5), (6, " \n\x0b\x0c\r\t ", 6), (7, "abd", 7),
    (8, "a bc", 8), (2, "abc", 1), (9, "x" * 70 + "y", 9), (10, "x" * 70 + "z", 10), (11, "x" * 70 + " z", 11), (11, "other", 11),
    (None, "abc", 0), (12, "É" * 5000, 0), (13, "É" * 5000 + " ", 0), (14, "a  b c", 3),
]


def brute(rows):
    groups = defaultdict(list)
    for i, (doc_id, text, _) in enumerate(rows):
        norm = re.sub(r"[\x20\x09-\x0d]", "", text or "")
        groups[norm].append((-len(text or ""), doc_id is not None, doc_id or 0, i))
    out = []
    for norm, members in groups.items():
        best = min(members)
        for n, has, d, i in members:
            out.append((d if has else None, best[2] if best[1] else None, len(members), i == best[3], hashlib.sha256(norm.encode()).hexdigest()))
    return out


def key(rows):
    return sorted(map(repr, rows))


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, n_chars long")
    for clash in ("row", "len", "again", "h", "best", "size", "prefix", "body"):
        df = df.withColumn(clash, df["n_chars"])
    return df


def test_matches_brute_force(docs):
    got = [tuple(r) for r in exact_dedup.exact_dedup(docs, hash_all=True).collect()]
    assert [k for k in key((*r[:3], r[4]) for r in got)] == key((*r[:3], r[4]) for r in brute(ROWS))
    # of rows repeated whole exactly one is kept
    assert sum(r[3] for r in got) == len({r[4] for r in got})


def test_full_hash_only_for_surviving_groups(docs):
    got = exact_dedup.exact_dedup(docs).collect()
    alone = {r["doc_id"] for r in got if r["full_hash"] is None}
    assert 7 not in {r["doc_id"] for r in got if r["group_size"] > 1}
    assert 12 not in alone and 9 not in alone  # same length and prefix as another row
    assert any(r["doc_id"] == 11 and r["full_hash"] is None for r in got)  # "other" has a length of its own


def test_drop_copies_keeps_columns(docs):
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert len(kept) == len({re.sub(r"[\x20\x09-\x0d]", "", t or "") for _, t, _ in ROWS})
    assert (3, "a  b c") in kept and (14, "a  b c") not in kept


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_dedup(df).collect() == []
    assert exact_dedup.drop_copies(df).collect() == []
