"""The pipeline against a brute-force run of the same stages, and the queries' oracles."""

import re
import sys

import duckdb
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from feedlake.llm import decontam, exact_dedup, html_extract, langid, packing, quality, queries, secrets, simhash, toxicity

SMALL = "/root/testdata/sf0.001"


def brute(spark, sf_dir):
    rows = [r.asDict() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    model = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    pair = model.compressors()
    rows = [r for r in rows if model.score([quality.difference(r["text"], *pair)])[0] >= 0.5]
    best = {}
    for r in rows:
        norm = re.sub(r"[\x20\x09-\x0d]", "", r["text"] or "")
        best[norm] = min(best.get(norm, (0, sys.maxsize, None)), (-len(r["text"] or ""), r["doc_id"], r["text"]))
    rows = [(d, t) for _, d, t in best.values()]
    fps = {d: simhash.fingerprint(t) for d, t in rows}
    root = {d: d for d in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    rows = [(d, t) for d, t in rows if find(d) == d]
    matcher = decontam.Matcher(items)
    return {d: t for d, t in rows if not matcher.match(decontam.normalise(t))}


def test_run_matches_brute_force(spark):
    want = brute(spark, SMALL)
    got = corpus_pipeline.run(spark, SMALL).collect()
    tok = Tokenizer.from_file(queries.tokenizer_path())
    assert {r["doc_id"] for r in got} == set(want)
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == {d: len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for d, t in want.items()}
    assert sum(r["length"] for r in got) == sum({r["doc_id"]: r["doc_tokens"] for r in got}.values())
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect() == []


def test_columns_with_clashing_names(spark):
    """Working and result names as input columns: kept, or replaced by the result, and never mixed up."""
    rows = [(1, "The quick brown fox jumps over the lazy dog", "en"), (2, None, None), (None, "", "de"), (3, "Der Hund und die Katze im Haus", "de"), (3, "Der Hund und die Katze im Haus", "de")]
    names = ["score", "lang_pred", "quality_score", "toxicity", "_id", "_hash", "fp", "component_id", "kept", "keep_id", "rank", "row", "h", "again", "best",
             "size", "start", "length", "part", "ids", "item_id", "distance", "root", "node", "y", "shard", "a", "b", "turn", "count", "full_hash", "html", "body"]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for n in names:
        df = df.withColumn(n, F.lit("own " + n))
    for out, made in ((langid.predict_language(df, langid.train(df)), {"lang_pred", "score"}), (quality.score_quality(df, quality.fit([])), {"quality_score"}),
                      (toxicity.score_toxicity(df, toxicity.fit([])), {"toxicity"}), (html_extract.extract_main_text(df, html_extract.fit([], layouts=1), "body"), {"body"}),
                      (secrets.scan_secrets(df), {"base_spans", "entropy_spans"}), (exact_dedup.drop_copies(df), set()), (simhash.keep_one(df), set()),
                      (decontam.drop_leaks(df, spark.createDataFrame([(1, "no such words here")], "item_id long, text string").withColumn("doc_id", F.lit(9))), set())):
        assert set(out.columns) == set(df.columns) | made and len(out.columns) == len(set(out.columns))
        got = out.collect()
        assert got and all(r[n] == "own " + n for r in got for n in names if n not in made)
    assert packing.pack_documents(df, queries.tokenizer_path(), 64).count() == len(rows)
    assert exact_dedup.exact_dedup(df).count() == simhash.near_duplicates(df).count() == len(rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "benchmark", "labels"):
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    want = con.execute(queries.ORACLES[name])
    columns = sorted(d[0] for d in want.description)
    place = [[d[0] for d in want.description].index(c) for c in columns]
    want = sorted(tuple(r[i] for i in place) for r in want.fetchall())
    df = queries.QUERIES[name](spark, sf_dir)
    assert sorted(df.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in df.collect()) == want


@pytest.mark.parametrize("name", ["op2_chat_format", "op6_secret_scan", "op7_exact_dedup"])
def test_native_queries_have_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
