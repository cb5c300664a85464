"""Corpus preparation: quality filter, exact and near de-duplication, decontamination, packing.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the
stage before it kept.  All but the last return the columns of ``documents``; the
last returns packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedlake.llm import decontam, exact_dedup, packing, quality, simhash
from feedlake.llm.common import OWN, read, remove_stage, write_stage_at
from feedlake.llm.queries import tokenizer_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the compression classifier, learnt outside its held-out fold, finds good."""
    model = quality.train(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), folds=3, held_out=1)
    score = OWN + "quality"
    return quality.score_quality(docs, model, score).where(F.col(score) >= 0.5).drop(score)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the longest original, then the smallest doc_id."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: shingles of 3 words, at most 2 differing bits."""
    return simhash.keep_one(docs, shingle_words=3, radius=2)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows in which no benchmark item occurs within its error budget."""
    return decontam.drop_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all remaining documents and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path(), capacity=2048, end_id=1)


STAGES = [
    ("quality_classifier", quality_filter),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: Fingerprints, compression and tokenisation are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written to the shared folder, as the next stage reads it more than once.

    A stage's copy is removed when the next one is written, so one is left: that the result reads.
    """
    docs, last = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs, path = write_stage_at(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if last:
            remove_stage(spark, last)
        last = path
    return STAGES[-1][1](spark, docs, sf_dir)
