"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from feedlake.session import cut_lineage, ensure_checkpoint_dir  # noqa: F401  (re-exported)

#: The six ASCII white-space characters that the contracts name.
ASCII_SPACE = " \t\n\x0b\f\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id written as text, modulo ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


#: Prefix of working columns; input columns are not expected to use it.
OWN = "__feedlake_"
#: Names of the columns that with_id_key() adds.
ID_KEY = (OWN + "id_null", OWN + "id")


def with_id_key(df: DataFrame) -> DataFrame:
    """``df`` with doc_id as two columns that are never null: a join and a later
    dropDuplicates() on them share one shuffle, also where ids are null."""
    return df.withColumn(ID_KEY[0], F.col("doc_id").isNull()).withColumn(ID_KEY[1], F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def map_texts(df: DataFrame, text: str, added: dict[str, str], fn) -> DataFrame:
    """``df`` with columns computed from a text column, batch by batch in Python tasks.

    ``added``: the new columns and their types; an input column of such a name
    is replaced.  ``fn()`` runs once per task and gives the function that maps
    a list of texts (null is empty) to one list for each new column.
    """
    base = df.drop(*[c for c in added if c != text]) if text not in added else df
    kept = [c for c in base.columns if c not in added]
    schema = base.select(*[F.col(f"`{c}`") for c in kept], *[F.lit(None).cast(t).alias(c) for c, t in added.items()]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for b in batches:
            columns: list[list] = [[] for _ in added]
            for _, texts in batches_by_bytes(b.column(text)):
                for column, values in zip(columns, work(texts)):
                    column.extend(values)
            arrays = [pa.array(c, ARROW[t]) for c, t in zip(columns, added.values())]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *arrays], [*kept, *added])

    return base.mapInArrow(run, schema)


ARROW = {"string": pa.string(), "double": pa.float64(), "long": pa.int64()}


def sample_by_hash(rows: DataFrame, of: str, group: str, most: int | dict) -> DataFrame:
    """At most ``most`` rows of each group (a number, or one for each group), chosen by a hash of column ``of``.

    The choice is the same on every run and does not follow the order of files.
    A threshold on the hash, from the group's count, first leaves about eight
    times the rows wanted, wherever they lie; only those are ranked, so neither
    a task nor the driver sees more, however frequent the group.  The counts
    are one row per group and are broadcast: groups are classes or languages.
    """
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias(OWN + "n"))
    if isinstance(most, dict):
        wanted = F.lit(0)
        for value, n in most.items():
            wanted = F.when(F.col(group) == value, n).otherwise(wanted)
    else:
        wanted = F.lit(most)
    share = F.least(F.lit(1.0), 8.0 * wanted / F.col(OWN + "n"))
    fine = 1 << 30
    near = rows.join(F.broadcast(counts), group).where(F.pmod(F.xxhash64(of), F.lit(fine)) < share * fine)
    order = Window.partitionBy(group).orderBy(F.xxhash64(of), of)
    near = near.withColumn(OWN + "rank", F.row_number().over(order)).where(F.col(OWN + "rank") <= wanted)
    return near.drop(OWN + "rank", OWN + "n")


def labelled_sample(docs: DataFrame, labels: DataFrame, value: str, rows_per_class: int | dict,
                    held_out: Column | None = None) -> DataFrame:
    """(doc_id, y, text) of at most ``rows_per_class`` labelled documents of each class 0 and 1.

    Labels are narrow, so they are cut down before any text is touched; the ids
    kept are a bounded set, which makes the broadcast of them safe.  Rows for
    which ``held_out`` is true never take part.
    """
    lab = labels.select("doc_id", F.col(value).alias("y")).where("y in (0, 1) and doc_id is not null")
    if held_out is not None:
        lab = lab.where(~held_out)
    chosen = sample_by_hash(lab.dropDuplicates(), "doc_id", "y", rows_per_class)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")


def write_stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Unlike checkpoint() the copy is columnar and its size is known to the
    optimiser, which then broadcasts it only when it is small.
    """
    return write_stage_at(df, name)[0]


def write_stage_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """write_stage() and the folder it wrote, for a caller that removes it when nothing reads it any more."""
    import uuid

    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/feedlake-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def remove_stage(spark: SparkSession, path: str) -> None:
    """Delete a folder of write_stage_at()."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


#: A key with more than one row in so many is hot: there are fewer hot keys than this.
HOT_SHARE = 1000


def join_hot(rows: DataFrame, named: DataFrame, key: str, n: str) -> DataFrame:
    """``rows`` joined to ``named``, which has one row for each ``key`` and in ``n`` the number of rows of that key.

    Rows of hot keys stay where they lie and meet a broadcast of the hot part of
    ``named``: fewer than HOT_SHARE rows, as the counts add up to all rows.  The
    others are joined by the key.  Both tables are read twice, so they are
    expected to be written ones.
    """
    total = named.agg(F.sum(n)).first()[0] or 0
    hot = F.col(n) * HOT_SHARE > total
    few, rest = named.where(hot), named.where(~hot)
    near = rows.join(F.broadcast(few), key)
    return near.unionByName(rows.join(F.broadcast(few.select(key)), key, "left_anti").join(rest, key))


def without_marked(docs: DataFrame, digest: Column, marked: DataFrame) -> DataFrame:
    """``docs`` without the rows that ``marked`` (doc_id, digest, once) names, but one row of each that has ``once``.

    Texts are shuffled only where ``marked`` is too large for a broadcast; rows
    marked ``once``, if there are any, are taken from a second pass over ``docs``.
    """
    name = OWN + "digest"
    keys = [*ID_KEY, name]
    marked = with_id_key(marked).select(*ID_KEY, F.col("digest").alias(name), "once")
    keyed = with_id_key(docs).withColumn(name, digest)
    out = keyed.join(marked.select(*keys), keys, "left_anti")
    if not marked.where("once").isEmpty():
        out = out.unionByName(keyed.join(marked.where("once").select(*keys), keys, "left_semi").dropDuplicates(keys))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def batches_by_bytes(texts: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) groups of a column with about ``limit`` characters each; null is empty."""
    start, size, group = 0, 0, []
    for i in range(len(texts)):
        t = texts[i].as_py() or ""
        if group and size + len(t) > limit:
            yield start, group
            start, size, group = i, 0, []
        group.append(t)
        size += len(t)
    if group:
        yield start, group
