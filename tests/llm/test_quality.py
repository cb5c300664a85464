"""Compression classifier: held-out accuracy and defined cases."""

import numpy as np
from pyspark.sql import functions as F

from feedlake.llm import quality
from feedlake.llm.common import fold, sample_by_hash

DIR = "/root/testdata/sf0.1"


def auc(score, y):
    rank = np.empty(len(score))
    rank[np.argsort(score, kind="stable")] = np.arange(1, len(score) + 1)
    pos = y == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{DIR}/documents.parquet"), spark.read.parquet(f"{DIR}/labels.parquet")
    model = quality.train(docs, labels)
    away = labels.where(fold(F.col("doc_id"), 3) == 1).select("doc_id", "quality")
    got = quality.score_quality(docs.select("doc_id", "text"), model).join(away, "doc_id").toPandas()
    s, y = got["quality_score"].to_numpy(), got["quality"].to_numpy()
    assert auc(s, y) > 0.97
    assert ((s >= 0.5) == y).mean() > 0.95
    assert s.min() >= 0 and s.max() <= 1


def test_sample_is_bounded_stable_and_balanced(spark):
    rows = spark.range(20000).selectExpr("id as doc_id", "if(id % 10 = 0, 0, 1) as y")
    got = sample_by_hash(rows, "doc_id", "y", {0: 100, 1: 300}).collect()
    assert sorted((y, sum(r["y"] == y for r in got)) for y in (0, 1)) == [(0, 100), (1, 300)]
    again = sample_by_hash(rows.repartition(7), "doc_id", "y", {0: 100, 1: 300}).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in again}
    few = sample_by_hash(rows.where("doc_id < 50"), "doc_id", "y", 40).groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in few} == {0: 5, 1: 40}
    assert sample_by_hash(rows.limit(0), "doc_id", "y", 5).collect() == []


def test_whole_text_counts():
    model = quality.fit([(1, "plain words of a story " * 9 + str(i)) for i in range(20)] + [(0, "!!%% BUY ## NOW $$ " * 9 + str(i)) for i in range(20)])
    pair = model.compressors()
    good, bad = "plain words of a story " * 50, "!!%% BUY ## NOW $$ " * 50
    assert quality.difference(good, *pair) > 0 > quality.difference(bad, *pair)
    both = quality.difference(good + bad * 20, *pair)
    assert both < quality.difference(good, *pair)
    assert model.score([quality.difference(good, *pair)])[0] > 0.5 > model.score([quality.difference(bad, *pair)])[0]


def test_few_labels_and_empty_texts(spark):
    assert quality.fit([]).score([0.3])[0] == 0.5
    one = quality.fit([(1, "a"), (1, "b"), (1, "c"), (0, "d")])
    assert abs(one.score([9.0])[0] - 0.75) < 1e-6
    df = spark.createDataFrame([(1, None, 0.0), (2, "", 1.0), (None, "x" * 300000, 2.0), (2, "", 1.0)], "doc_id long, text string, score double")
    got = quality.score_quality(df, one).collect()
    assert len(got) == 4 and len({r["quality_score"] for r in got}) == 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.score_quality(empty, quality.train(empty, labels)).collect() == []
