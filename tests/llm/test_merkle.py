"""Merkle manifest: against a tree built by hand, proofs, tampering, defined cases."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from feedlake.llm import merkle, queries


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, **changed):
    out = ""
    for c in ("doc_id", "source", "lang", "n_chars", "text"):
        v = changed.get(c, row[c])
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def climb(nodes):
    """(root, siblings): for each node the [(left, right)] of every level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for k, i in enumerate(at):
            run, slot = runs[i // 16], i % 16
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
        at = [i // 16 for i in at]
        nodes = [sha("".join(r)) for r in runs]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault((r["source"] is not None, (r["source"] or "").encode()), []).append(r)
    order = sorted(groups)
    found = {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        found[g] = climb([leaf(r) for r in groups[g]])
    root, above = climb([found[g][0] for g in order])
    out = []
    for g, top in zip(order, above):
        subroot, paths = found[g]
        for r, path in zip(groups[g], paths):
            whole = path + top
            bad = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
            lower = None if r["text"] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            d = leaf(r, text=lower) if bad else leaf(r)
            for left, right in whole:
                d = sha(left + d + right)
            out.append((r["doc_id"], leaf(r), subroot, root, sha("".join(a + b for a, b in whole)), d, d == root))
    return sorted(out, key=repr)


def result(df):
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    out = df.select("doc_id", "leaf", "subroot", "root", merkle.digest(proof), merkle.fold(F.col("path"), F.coalesce("tampered", "leaf")).alias("d"))
    return sorted((tuple(r) for r in out.withColumn("ok", F.col("d") == F.col("root")).collect()), key=repr)


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows_of(df):
    return [r.asDict() for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.mark.parametrize("sizes", [[1], [2], [16], [17], [1, 1], [300, 1, 17], [1] * 20, [33] + [2] * 256])
def test_trees_of_any_size(spark, sizes):
    rows = [(1000 * s + i, f"Text {i}", "en", f"s{s:03d}", i) for s, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(merkle.merkle_manifest(docs)) == brute(rows_of(docs))


def test_defined_cases(spark):
    rows = [(i, f"Doc É {i}", "en", "hot", i) for i in range(40)]
    rows += [(5, "Doc É 5", "en", "hot", 5)] * 30 + [(5, "another", None, "hot", None)]           # repeated rows, one id with two texts
    rows += [(None, "No id", "en", "hot", 1), (None, None, None, None, None), (1, "", "", "", 0), (0, None, "en", None, 3)]
    rows += [(2, "-", "-", "-", 0), (3, "X" * 200_000, "en", "é", 200_000), (4, "A", "en", "z", 1), (4, "A", "en", "Z", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"grp": F.lit("x"), "pos": F.lit(7), "n": F.lit(9), "digest": F.lit("y"), "path": F.lit("p")})
    got = result(merkle.merkle_manifest(docs.repartition(6)))
    assert got == brute(rows_of(docs))
    assert merkle.merkle_manifest(docs.limit(0)).collect() == []


def test_a_null_is_no_text(spark):
    docs = spark.createDataFrame([(1, None, "en", "s", 1), (2, "-", "en", "s", 1), (3, "", "en", "s", 1)], SCHEMA)
    assert len({r["leaf"] for r in merkle.merkle_manifest(docs).collect()}) == 3


def test_query_and_tampering(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = queries.QUERIES["op13_merkle_manifest"](spark, sf_dir)
    got = sorted((tuple(r) for r in out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)
    assert got == brute(rows_of(docs))
    assert 0 < sum(not r[6] for r in got) < len(got) / 3
