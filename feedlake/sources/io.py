"""Sources and sinks.

Readers take explicit schemas (no inference).  Writers use Spark's commit
protocol; "atomic publish" is a versioned directory plus a pointer file
written last, so a reader never sees a half-written dataset and no job
overwrites a path it is reading.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.outputs import markdown_sort_order

PAGES_SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                             T.StructField("html", T.StringType())])
FEEDS_SCHEMA = T.StructType([T.StructField("publication_url", T.StringType()),
                             T.StructField("publication_name", T.StringType()),
                             T.StructField("xml", T.StringType())])
SEED_FIELDS = ["publication_url", "url", "publication_name", "name", "rss_url", "discovered_from_profile"]
SEED_STRUCT = T.StructType([T.StructField(f, T.StringType()) for f in SEED_FIELDS])


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(hpath)


def spread(df: DataFrame, partitions: int, key: str) -> DataFrame:
    """Hash-partition ``df`` on ``key``: an explicit choice of the caller, for
    CPU-heavy work over a scan that the file layout cannot split (one file of
    one row group).  Never decided from the input's size."""
    return df.repartition(partitions, key)


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A1: fetched pages (page_id, url, html).  ``fmt="html"`` reads landed
    raw files (one page per file; url = file path)."""
    if fmt == "html":
        raw = spark.read.format("text").option("wholetext", True).load(path)
        return raw.select(F.xxhash64(F.col("_metadata.file_path")).alias("page_id"),
                          F.col("_metadata.file_path").alias("url"), F.col("value").alias("html"))
    return spark.read.schema(PAGES_SCHEMA).parquet(path)


def read_feeds(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A2: fetched RSS/Atom documents (publication_url, publication_name, xml)."""
    if fmt == "xml":
        raw = spark.read.format("text").option("wholetext", True).load(path)
        return raw.select(F.col("_metadata.file_path").alias("publication_url"),
                          F.lit(None).cast("string").alias("publication_name"), F.col("value").alias("xml"))
    return spark.read.schema(FEEDS_SCHEMA).parquet(path)


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """A3: seed list -- a JSON object with a ``publications`` array, or a
    bare array; rows keep their file order in ``seq``.

    A file that is neither, or that is cut off, raises ``ValueError``: a
    broken list must not pass for an empty one.
    """
    text = spark.read.format("text").option("wholetext", True).load(path)
    doc = F.trim(F.col("value"), F.lit(" \t\r\n"))
    as_obj = F.from_json(doc, T.StructType([T.StructField("publications", T.ArrayType(SEED_STRUCT))]))
    as_arr = F.from_json(doc, T.ArrayType(SEED_STRUCT))
    arr = F.when(doc.startswith("["), as_arr).otherwise(as_obj["publications"])
    broken = text.select(_is_broken_json(doc).alias("broken"),
                         (doc.startswith("{") & ~F.coalesce(F.array_contains(F.json_object_keys(doc), "publications"), F.lit(False)))
                         .alias("no_list"), F.col("_metadata.file_path").alias("file"))
    seen = broken.agg(F.count(F.lit(1)).alias("files"), F.max(F.when(F.col("broken") | F.col("no_list"), F.col("file"))).alias("bad")).first()
    if not seen.files or seen.bad:  # a file without a byte gives no row
        raise ValueError(f"Seed file is not a JSON list of publications: {seen.bad or path}")
    rows = text.select(F.posexplode(F.coalesce(arr, F.array())).alias("seq", "s"))
    return rows.select(F.col("seq").cast("long").alias("seq"), *[F.col(f"s.{f}").alias(f) for f in SEED_FIELDS])


def _is_broken_json(doc: Column) -> Column:
    """True when the text is not one whole JSON object or array."""
    whole_obj = doc.startswith("{") & doc.endswith("}") & F.json_object_keys(doc).isNotNull()
    whole_arr = doc.startswith("[") & doc.endswith("]") & F.json_array_length(doc).isNotNull()
    return ~F.coalesce(whole_obj | whole_arr, F.lit(False))


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A4: persisted state with the given schema; empty when absent.
    Older files missing newer columns get NULLs (``mergeSchema``)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.option("mergeSchema", True).parquet(path)
    for field in schema.fields:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(None).cast(field.dataType))
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


BATCH_ARTICLE = T.StructType([
    T.StructField(c, T.ArrayType(T.StringType()) if c in ("summary_bullets", "topic_tags") else T.StringType())
    for c in ["article_id", "source_profile", "source_label", "article_url", "canonical_url", "title", "subtitle",
              "author", "publication", "published_at", "body_text", "summary_short", "summary_bullets",
              "key_takeaway", "topic_tags", "scraped_at", "run_date", "processing_status", "summary_status",
              "summary_model", "content_hash", "error_message", "discovered_via"]])


def read_daily_batch(spark: SparkSession, path: str) -> DataFrame:
    """A5: load daily batches and validate their shape.

    ``path`` is a JSON document, a folder of them, or a folder that
    :func:`write_daily_batch` wrote.  Raises ``ValueError`` when any document
    is not one whole object, has no ``run_date``, has no ``articles`` or
    ``articles`` is not a list.  Returns the article rows with their batch's
    run date and ``seq`` (position in the batch).
    """
    if path_exists(spark, f"{path}/articles") and path_exists(spark, f"{path}/header"):
        return _read_batch_tables(spark, path)
    text = spark.read.format("text").option("wholetext", True).load(path)
    doc = F.trim(F.col("value"), F.lit(" \t\r\n"))
    arts = F.ltrim(F.get_json_object(doc, "$.articles"))
    keys = F.json_object_keys(F.when(doc.startswith("{"), doc))
    # Every file is validated; one row of counts reaches the driver, never the articles.
    is_obj = doc.startswith("{") & ~_is_broken_json(doc)
    wrong = lambda c: F.count_if(~F.coalesce(c, F.lit(False)))
    probe = text.agg(
        F.count(F.lit(1)).alias("files"), wrong(is_obj).alias("no_object"),
        wrong(F.array_contains(keys, "run_date")).alias("no_date"),
        wrong(F.array_contains(keys, "articles")).alias("no_articles"), wrong(arts.startswith("[")).alias("no_list")).first()
    if not probe.files or probe.no_object:
        raise ValueError("A daily batch file is not one whole JSON object")
    if probe.no_date:
        raise ValueError("A daily batch file has no run_date")
    if probe.no_articles:
        raise ValueError("A daily batch file has no articles")
    if probe.no_list:
        raise ValueError("The articles of a daily batch file are not a list")
    schema = T.StructType([T.StructField("run_date", T.StringType()),
                           T.StructField("articles", T.ArrayType(BATCH_ARTICLE))])
    parsed = text.select(F.from_json(doc, schema).alias("b"))
    rows = parsed.select(F.col("b.run_date").alias("batch_run_date"),
                         F.posexplode(F.col("b.articles")).alias("seq", "a"))
    return rows.select(F.col("seq").cast("long").alias("seq"), "batch_run_date", "a.*")


def _read_batch_tables(spark: SparkSession, path: str) -> DataFrame:
    """The batch that :func:`write_daily_batch` wrote: JSON lines of article rows per run date.

    A line that is no JSON object raises (FAILFAST).
    """
    fields = [T.StructField("seq", T.LongType())] + [f for f in BATCH_ARTICLE.fields if f.name != "run_date"]
    arts = spark.read.schema(T.StructType(fields + [T.StructField("run_date", T.StringType())])) \
        .option("mode", "FAILFAST").json(f"{path}/articles")
    return arts.select("seq", F.col("run_date").alias("batch_run_date"), *[F.col(f.name) for f in BATCH_ARTICLE.fields])


def read_batch_header(spark: SparkSession, path: str) -> DataFrame:
    """The header rows that :func:`write_daily_batch` wrote, one per run date (also of empty batches)."""
    schema = "schema_version string, run_id string, source_profile string, generated_at string, article_count long, status string, run_date string"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(f"{path}/header")


def write_raw(df: DataFrame, path: str, run_date_col: str = "run_date") -> None:
    """Land raw discovery rows per run date (also in dry runs);
    re-running a date replaces only that date."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(run_date_col).parquet(path))


def write_processed(df: DataFrame, path: str, run_date_col: str = "run_date", dry_run: bool = False) -> bool:
    """Per-date processed articles / summaries; skipped in dry runs."""
    if dry_run:
        return False
    write_raw(df, path, run_date_col)
    return True


def write_archive(df: DataFrame, path: str, run_date_col: str = "run_date") -> None:
    """Dated archive (dynamic partition overwrite)."""
    write_raw(df, path, run_date_col)


def publish_version(df: DataFrame, base: str, fmt: str = "parquet", version: int | None = None) -> str:
    """A8 latest / A10 atomic publish: write ``base/v=<n>`` then point
    ``base/_CURRENT`` at it.  Readers resolve the pointer first.

    Without ``version`` the next free number is taken.  A caller that names
    the version (a stream names its batch) replaces that version, so that a
    repeated run publishes the same thing in the same place; it must not read
    the version it replaces.
    """
    spark = df.sparkSession
    mode = "errorifexists" if version is None else "overwrite"
    target = f"{base}/v={_next_version(spark, base) if version is None else version}"
    df.write.mode(mode).format(fmt).save(target)
    _write_pointer(spark, f"{base}/_CURRENT", target)
    return target


def read_published(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    """The current version, or None if nothing has been published yet."""
    target = _read_pointer(spark, f"{base}/_CURRENT")
    return spark.read.format(fmt).load(target) if target else None


def read_version_before(spark: SparkSession, base: str, version: int, fmt: str = "parquet") -> DataFrame | None:
    """The highest finished version below ``version``, or None if there is none."""
    fs, hbase = hadoop_path(spark, base)
    if not fs.exists(hbase):
        return None
    done = [n for n in _versions(spark, base) if n < version
            and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{base}/v={n}/_SUCCESS"))]
    return spark.read.format(fmt).load(f"{base}/v={max(done)}") if done else None


def append_manifest(df: DataFrame, path: str) -> None:
    """Append run rows (manifests or run status) to their history."""
    df.write.mode("append").parquet(path)


def latest_run(history: DataFrame, order_col: str = "started_at") -> DataFrame:
    """The latest run row (``max_by`` over the whole struct)."""
    return history.agg(F.max_by(F.struct(*history.columns), F.col(order_col)).alias("r")).select("r.*")


def write_markdown(blocks: DataFrame, path: str) -> None:
    """Markdown digest files, one folder per run date; part files in
    name order hold the document in order (range-partitioned sort).  Only the
    run dates in ``blocks`` are replaced."""
    ordered = blocks.orderBy(*markdown_sort_order())
    (ordered.select("run_date", "text").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_date").text(path))


def write_daily_batch(header: DataFrame, articles: DataFrame, path: str) -> None:
    """H1 sink: header rows and article rows as JSON lines per run date; only
    the run dates written are replaced.  ``read_daily_batch`` reads it back."""
    for df, part in ((header, "header"), (articles, "articles")):
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_date").json(f"{path}/{part}"))


# -- pointer helpers (tiny text files through the Hadoop FS API) ------------

def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop's API."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def _versions(spark: SparkSession, base: str) -> list[int]:
    fs, hbase = hadoop_path(spark, base)
    if not fs.exists(hbase):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(hbase)]
    return [int(n[2:]) for n in names if n.startswith("v=")]


def _next_version(spark: SparkSession, base: str) -> int:
    return max(_versions(spark, base), default=-1) + 1


def _write_pointer(spark: SparkSession, path: str, target: str) -> None:
    """Replace the pointer in one rename: readers see the old or the new one, never none."""
    fs, hpath = hadoop_path(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(json.dumps({"target": target}).encode()))
    out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(fs.makeQualified(tmp), fs.makeQualified(hpath), options)


def _read_pointer(spark: SparkSession, path: str) -> str | None:
    """The pointer's target; None before the first version.

    Versions without a pointer are a damaged dataset, which must not pass for
    an empty one.
    """
    fs, hpath = hadoop_path(spark, path)
    if not fs.exists(hpath):
        base = path.rsplit("/", 1)[0]
        if _next_version(spark, base) > 0:
            raise FileNotFoundError(f"{base} holds versions but no pointer to the current one")
        return None
    stream = fs.open(hpath)
    reader = spark.sparkContext._jvm.java.io.BufferedReader(
        spark.sparkContext._jvm.java.io.InputStreamReader(stream))
    text = reader.readLine()
    reader.close()
    return json.loads(text)["target"]
