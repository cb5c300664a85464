"""Packing documents into token windows by minimum bin slack.

A document's ids (tokenizer, then an end id) are cut into pieces of the window's
capacity; only the last piece is shorter.  A full piece is a sequence.  For the
rest the planner sees nothing but how many pieces of each length remain, at most
``capacity`` numbers whatever the corpus.  Again and again it takes the longest
remaining length and asks a subset-sum table which multiset of the other
remaining lengths fills the window closest to its capacity.  The table is a
bitset (an integer whose bit s says that sum s can be reached), one per step of
the bounded-multiplicity expansion; walking back through the steps gives the
counts of each length.  The multiset found is applied as often as the remaining
counts allow, which uses up at least one length, so the number of plan entries
is bounded by the capacity as well.

Pieces then find their places without meeting: a piece's rank among those of its
length is its rank within its partition plus the counts of earlier partitions,
and the plan maps (length, rank) to a sequence and an offset.  No length, however
frequent, is gathered in a task.

Defined cases: null and empty texts are the end id alone; repeated rows are
packed separately; texts of any length are tokenised whole; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import write_stage

CAPACITY = 2048
END_ID = 1

# The pre-tokenisation pattern of byte-level BPE vocabularies of this kind.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Encoder:
    """Ids of a text under a ``tokenizers`` file, without its special tokens around them.

    A byte-level BPE file whose ids follow its merges can be run by tiktoken,
    which gives the same ids several times faster; texts that hold the string of
    an added token, and all other files, go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.added = [t["content"] for t in spec.get("added_tokens") or []]
        ranks = self.byte_ranks(spec)
        self.fast = None
        if ranks is not None:
            import tiktoken

            self.fast = tiktoken.Encoding("byte-level", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def byte_ranks(spec: dict) -> dict[bytes, int] | None:
        """Byte strings and their ids if the file is a plain byte-level BPE with ids in merge order, else None."""
        model, pre = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
        if model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer") \
                or not pre.get("use_regex", True) or model.get("dropout") or model.get("byte_fallback") or model.get("ignore_merges"):
            return None
        # Printable bytes stand for themselves, the others for code points from 256 on, in order.
        plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        vocab = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        if any(vocab.get(a + b) != 256 + i for i, (a, b) in enumerate(merges)):
            return None
        ranks = {}
        for token, i in vocab.items():
            if i < 256 + len(merges):
                if any(c not in byte_of for c in token):
                    return None
                ranks[bytes(byte_of[c] for c in token)] = i
        return ranks if len(ranks) == 256 + len(merges) else None

    def ids(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if self.fast is None or any(t in text for t in self.added):
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids_crc32, doc_tokens, part, local_rank (and ids).

    ``part`` is the partition that cut the piece, ``local_rank`` the piece's
    number among that partition's pieces of its length.
    """
    source = docs.select("doc_id", "text")
    schema = source.select("doc_id").schema
    for name in ("start", "length", "ids_crc32", "doc_tokens", "part", "local_rank"):
        schema = schema.add(name, "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seen, enc = TaskContext.get().partitionId(), np.zeros(capacity + 1, dtype=np.int64), encoder(tokenizer)
        for b in batches:
            rows, cols, ids_out = [], [], []
            texts = b.column("text")
            for r in range(b.num_rows):
                ids = np.append(enc.ids(texts[r].as_py() or ""), np.uint32(end_id)).astype("<u4")
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append(r)
                    cols.append((start, len(piece), zlib.crc32(piece.tobytes()), len(ids), part, seen[len(piece)]))
                    seen[len(piece)] += 1
                    if with_ids:
                        ids_out.append(piece.astype(np.int32))
            values = np.array(cols, dtype=np.int64).reshape(-1, 6)
            arrays = [b.column("doc_id").take(pa.array(rows, pa.int64())), *[pa.array(values[:, i]) for i in range(6)]]
            if with_ids:
                arrays.append(pa.array(ids_out, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return source.mapInArrow(run, schema)


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset {length: number}, within ``counts``, whose sum is at most ``room`` and closest to it.

    Longer lengths are offered first and the table stops growing once the room
    can be filled, so short pieces are saved for later windows.
    """
    if room <= 0:
        return {}
    full = (1 << (room + 1)) - 1
    steps, tables = [], [1]
    reach = 1
    for length in sorted((n for n, c in counts.items() if c > 0 and n <= room), reverse=True):
        left, times = min(counts[length], room // length), 1
        while left > 0:  # 1, 2, 4, ... copies: every number up to the count is a sum of them
            take = min(times, left)
            left, times = left - take, times * 2
            grown = (reach | (reach << (take * length))) & full
            if grown != reach:
                steps.append((length, take))
                tables.append(grown)
                reach = grown
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for i in range(len(steps), 0, -1):
        if tables[i - 1] >> at & 1:
            continue  # reached without this step
        length, take = steps[i - 1]
        used[length] = used.get(length, 0) + take
        at -= take * length
    return used


def plan_windows(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, dict[int, int]]]:
    """[(times, {length: number per window})] that uses up all of ``counts``."""
    left = {n: c for n, c in counts.items() if c > 0}
    plan = []
    while left:
        longest = max(left)
        rest = dict(left)
        rest[longest] -= 1
        window = best_fill(rest, capacity - longest)
        window[longest] = window.get(longest, 0) + 1
        times = min(left[n] // c for n, c in window.items())
        plan.append((times, window))
        for n, c in window.items():
            left[n] -= times * c
            if not left[n]:
                del left[n]
    return plan


@dataclass
class Places:
    """For each length, the plan entries that use it, in order of the ranks they serve."""

    first_rank: np.ndarray
    per_window: np.ndarray
    first_sequence: np.ndarray
    offset: np.ndarray


def places(plan: list[tuple[int, dict[int, int]]]) -> dict[int, Places]:
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    served: dict[int, int] = {}
    sequence = 0
    for times, window in plan:
        offset = 0
        for length, number in sorted(window.items(), reverse=True):
            rows.setdefault(length, []).append((served.get(length, 0), number, sequence, offset))
            served[length] = served.get(length, 0) + times * number
            offset += length * number
        sequence += times
    return {n: Places(*np.array(r, dtype=np.int64).T) for n, r in rows.items()}


def assign(lengths: np.ndarray, ranks: np.ndarray, at: dict[int, Places]) -> tuple[np.ndarray, np.ndarray]:
    """(sequence_id, offset) of pieces, by their length and rank."""
    sequence, offset = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    for n in np.unique(lengths):
        sel, p = np.nonzero(lengths == n)[0], at[int(n)]
        k = np.searchsorted(p.first_rank, ranks[sel], side="right") - 1
        j = ranks[sel] - p.first_rank[k]
        sequence[sel] = p.first_sequence[k] + j // p.per_window[k]
        offset[sel] = p.offset[k] + (j % p.per_window[k]) * n
    return sequence, offset


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset (and ids)."""
    cut = write_stage(cut_documents(docs, tokenizer, capacity, end_id, with_ids), "pieces")
    by_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    at = docs.sparkSession.sparkContext.broadcast(places(plan_windows(counts, capacity)))
    ranked = cut.join(before, ["length", "part"]).withColumn("rank", F.col("before") + F.col("local_rank"))
    keep = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    tail = ["ids"] if with_ids else []
    ranked = ranked.select(*keep, "rank", *tail)
    schema = ranked.select(*keep, F.col("rank").alias("sequence_id"), F.col("rank").alias("offset"), *tail).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sequence, offset = assign(b.column("length").to_numpy(), b.column("rank").to_numpy(), at.value)
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(sequence), pa.array(offset), *[b.column(c) for c in tail]], schema.names)

    return ranked.mapInArrow(run, schema)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """Whole sequences from pack_documents(with_ids=True): sequence_id, ids padded to ``capacity``, n_tokens, doc_ids.

    A sequence whose length is a power of two is not padded.
    """
    rows = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    rows = rows.select("sequence_id", ids.alias("ids"), F.transform("p", lambda x: x["doc_id"]).alias("doc_ids"))
    n = F.size("ids")
    padding = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(capacity - n)
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"), n.alias("n_tokens"), "doc_ids")
