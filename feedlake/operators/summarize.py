"""Summaries (I1) from model responses produced elsewhere.

Calling a model is not part of the engine: a responses table
(``article_id``, ``output_text``) is joined in; a missing response is a
failed call (``fallback``), a blank one an ``empty_response``.  The
extractive fallback and the bullet rules are built-in expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import NO_SUMMARY, bullets, first_sentences, strip_ws, summary_prompt, trim_text

# Reference defaults.
DEFAULT_MAX_INPUT_CHARS = 12000
DEFAULT_SUMMARY_LENGTH = "medium"


def prompts(articles: DataFrame, max_input_chars: int = DEFAULT_MAX_INPUT_CHARS,
            length: str = DEFAULT_SUMMARY_LENGTH, key: str = "article_id") -> DataFrame:
    """B18 as a job: (``key``, prompt) for an external model."""
    return articles.select(key, summary_prompt(F.col("title"), trim_text(F.col("body_text"), max_input_chars),
                                                        length).alias("prompt"))


def summarize(articles: DataFrame, responses: DataFrame | None = None, enabled: bool = True,
              include_bullets: bool = True, max_input_chars: int = DEFAULT_MAX_INPUT_CHARS,
              provider: str = "openai", model: str | None = None, created_at: str | None = None,
              key: str = "article_id") -> DataFrame:
    """Add summary_short, summary_bullets, key_takeaway, summary_status,
    provider, model, created_at to every article row.

    ``responses`` holds (``key``, ``output_text``); by default the key is the
    article id (unique after dedupe)."""
    src = trim_text(F.col("body_text"), max_input_chars)
    if responses is not None and enabled:
        r = responses.select(F.col(key).alias("_rid"), strip_ws(F.col("output_text")).alias("_resp"))
        df = articles.join(r, articles[key] == r["_rid"], "left").drop("_rid")
    else:
        df = articles.withColumn("_resp", F.lit(None).cast("string"))
    if not enabled:
        status = F.lit("disabled")
    else:
        status = (F.when(F.col("_resp").isNull(), F.lit("fallback"))
                  .when(F.col("_resp") == "", F.lit("empty_response"))
                  .otherwise(F.lit("completed")))
    df = df.withColumn("summary_status", status)
    fallback_text = F.coalesce(F.nullif(first_sentences(src, 3), F.lit("")), F.lit(NO_SUMMARY))
    df = df.withColumn("summary_short", F.when(F.col("summary_status") == "completed", F.col("_resp"))
                       .otherwise(fallback_text))
    empty = F.array().cast("array<string>")
    # Bullets are computed once; the key takeaway uses them even when the
    # bullet list itself is switched off.
    df = df.withColumn("_b", bullets(F.col("summary_short")))
    df = df.withColumn("summary_bullets", F.col("_b") if include_bullets else empty)
    df = df.withColumn("key_takeaway", F.coalesce(F.get(F.col("_b"), 0),
                                                  F.nullif(strip_ws(F.col("summary_short")), F.lit(""))))
    return (df.withColumn("provider", F.lit(provider))
            .withColumn("model", F.lit(model).cast("string"))
            .withColumn("created_at", F.lit(created_at).cast("string"))
            .drop("_resp", "_b"))
