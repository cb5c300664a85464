"""Best-fit packing planned on the length histogram.

A document is its ids (tokenizer, then an end id).  Only a document longer than a
sequence is cut; its first piece takes the odd remainder, all others are full.

The planner sees how many pieces of each length there are, at most ``capacity``
numbers whatever the corpus, and packs counts instead of pieces: lengths go from
long to short; the pieces of one length go to the open sequences whose room is
the smallest that suffices, and only what no open sequence takes opens new ones.
Sequences with the same content are one *run* of consecutive sequence numbers.
Taking some of a run splits it, so a length splits at most two runs and the plan
has a number of entries that depends on the capacity, not on the corpus.  The
result is that of best-fit decreasing over the single pieces.

Documents then take the planned slots by a join on their rank within their
length: a slot entry serves the ranks from ``first_rank`` to ``end_rank``, and
sequence and offset follow from the rank by arithmetic.  A piece's rank is its
number within the partition that cut it plus the counts of earlier partitions,
so no length, however frequent, is gathered in a task.

Defined cases: null and empty texts are the end id alone; rows repeated whole or
in their doc_id, also null ids, are separate documents; texts of any length are
tokenised whole; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import write_stage
from .packing import encoder

CAPACITY = 1024
END_ID = 2

SLOTS = "length long, first_rank long, end_rank long, per_sequence long, first_sequence long, offset long"


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of ``n`` ids start: the first piece is the remainder, the others are full."""
    first = n % capacity or capacity
    return [0, *range(first, n, capacity)]


def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, with ``part`` (the partition
    that cut it) and ``local_rank`` (its number among that partition's pieces of its length)."""
    source = docs.select("doc_id", "text")
    schema = source.select("doc_id").schema.add("piece", "integer")
    numbers = ("start", "length", "ids_crc32", "part", "local_rank")
    for name in numbers:
        schema = schema.add(name, "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, enc = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), encoder(tokenizer)
        for b in batches:
            rows, pieces, values = [], [], []
            texts = b.column("text")
            for r in range(b.num_rows):
                ids = np.append(enc.ids(texts[r].as_py() or ""), np.uint32(end_id)).astype("<u4")
                starts = cut_points(len(ids), capacity)
                for i, (start, end) in enumerate(zip(starts, [*starts[1:], len(ids)])):
                    rows.append(r)
                    pieces.append(i)
                    values.append((start, end - start, zlib.crc32(ids[start:end].tobytes()), part, seen[end - start]))
                    seen[end - start] += 1
            table = np.array(values, dtype=np.int64).reshape(-1, len(numbers))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(pieces, pa.int32()),
                 *[pa.array(table[:, i]) for i in range(len(numbers))]], schema.names)

    return source.mapInArrow(run, schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: rows of ``SLOTS``.

    An entry serves the pieces of ``length`` with first_rank <= rank < end_rank:
    ``per_sequence`` of them lie side by side from ``offset`` on in each of the
    sequences from ``first_sequence`` on.
    """
    slots: list[tuple[int, int, int, int, int, int]] = []
    runs: dict[int, list[tuple[int, int]]] = {capacity: []}  # room -> (first sequence, number of sequences)
    opened = 0
    for length in sorted((n for n, c in counts.items() if c > 0), reverse=True):
        left, rank = counts[length], 0
        # Rooms that suffice, closest first; what this length leaves behind is too small for it.
        for room in sorted(r for r in runs if r >= length and runs[r]):
            fits = room // length
            while left and runs[room]:
                first, number = runs[room].pop()
                full = min(number, left // fits)
                odd = left - full * fits if full < number else 0  # pieces in one more sequence, not filled up
                if full:
                    slots.append((length, rank, rank + full * fits, fits, first, capacity - room))
                    runs.setdefault(room - fits * length, []).append((first, full))
                    rank, left = rank + full * fits, left - full * fits
                if odd:
                    slots.append((length, rank, rank + odd, odd, first + full, capacity - room))
                    runs.setdefault(room - odd * length, []).append((first + full, 1))
                    rank, left, full = rank + odd, left - odd, full + 1
                if full < number:
                    runs[room].append((first + full, number - full))
        if left:
            fits = capacity // length
            for each, number in ((fits, left // fits), (left % fits, 1)):
                if each and number:
                    slots.append((length, rank, rank + each * number, each, opened, 0))
                    runs.setdefault(capacity - each * length, []).append((opened, number))
                    rank, opened = rank + each * number, opened + number
        runs.pop(0, None)
    return slots


def best_fit_pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = write_stage(cut_pieces(docs, tokenizer, capacity, end_id), "bestfit-pieces")
    by_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = cut.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    # The plan's size has a bound set by the capacity alone, so it may be broadcast.
    slots = F.broadcast(spark.createDataFrame(plan_slots(counts, capacity), SLOTS).withColumnRenamed("length", "slot_length"))
    taken = ranked.join(slots, (F.col("length") == F.col("slot_length")) & (F.col("rank") >= F.col("first_rank")) & (F.col("rank") < F.col("end_rank")))
    nth = F.col("rank") - F.col("first_rank")
    return taken.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        F.expr("first_sequence + (rank - first_rank) div per_sequence").alias("sequence_id"),
        (F.col("offset") + F.pmod(nth, F.col("per_sequence")) * F.col("length")).alias("offset"))
