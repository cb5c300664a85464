"""Run commits: one record names the files of every table of a run.

Layout below a base folder::

    _commits/<number>.json     records; the highest number is the current state
    <table>/<attempt>-<n>/     files, written once and never changed

A table consists of parts: run dates, run ids, buckets, or a single part with the
empty name.  A record maps the parts of every table to folders, so one rename
(create if absent) moves all tables of a run at once, and a reader that
resolves its tables through one record sees one state.  A run that breaks off before
its commit leaves folders that no record names; the same run started again begins from
the same state.  A run repeated after its commit starts from the state before
it and takes its place, as long as no later run builds on it.

Records hold names, never data: their size grows with the number of parts.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from .io import hadoop_path

LOG = "_commits"
ATTEMPT = re.compile(r"[0-9a-f]{12}-[0-9]+")


class CommitConflict(RuntimeError):
    """Another run has committed since this one began."""


class AlreadyCommitted(ValueError):
    """The run is committed and later runs build on it."""


@dataclass
class Snapshot:
    """The state that one record names."""
    spark: SparkSession
    base: str
    number: int = -1
    run: str | None = None
    before: int = -1                       # the record that the run started from
    tables: dict[str, dict[str, str]] = field(default_factory=dict)
    formats: dict[str, str] = field(default_factory=dict)
    settings: dict[str, int] = field(default_factory=dict)

    def parts(self, table: str) -> dict[str, str]:
        """Part name -> folder, below the base."""
        return self.tables.get(table, {})

    def folders(self, table: str, parts: list[str] | None = None) -> list[str]:
        known = self.parts(table)
        return [f"{self.base}/{known[p]}" for p in (sorted(known) if parts is None else parts) if p in known]

    def read(self, table: str, parts: list[str] | None = None, schema=None) -> DataFrame | None:
        """The table's rows, or those of the named parts only; None if there is none of them."""
        found = self.folders(table, parts)
        if not found:
            return None
        reader = self.spark.read.format(self.formats.get(table, "parquet"))
        return (reader.schema(schema) if schema is not None else reader).load(found)


@dataclass
class Transaction(Snapshot):
    """What a run reads: the state that it began with, then also what it has written."""
    head: int = -1                         # the highest record when the run began
    attempt: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    writes: int = 0

    @classmethod
    def on(cls, start: Snapshot, run: str, head: int) -> Transaction:
        tables = {t: dict(p) for t, p in start.tables.items()}
        return cls(start.spark, start.base, start.number, run, start.number, tables, dict(start.formats), dict(start.settings), head)

    def _folder(self, table: str) -> str:
        self.writes += 1
        return f"{table}/{self.attempt}-{self.writes}"

    def write_with(self, table: str, part: str, write: Callable[[str], None], fmt: str = "parquet") -> str:
        """``write`` a new folder (it gets the path), which becomes the table's ``part``; returns the path."""
        folder = self._folder(table)
        write(f"{self.base}/{folder}")
        self.tables.setdefault(table, {})[part] = folder
        self.formats[table] = fmt
        return f"{self.base}/{folder}"

    def write(self, table: str, df: DataFrame, part: str = "", fmt: str = "parquet") -> DataFrame:
        """Write ``df`` as the table's ``part`` and return it as stored."""
        path = self.write_with(table, part, lambda p: df.write.format(fmt).save(p), fmt)
        return self.spark.read.format(fmt).schema(df.schema).load(path)

    def write_parts(self, table: str, df: DataFrame, by: str, touched: list[str]) -> None:
        """Write ``df`` with one part for each value of column ``by``; ``touched`` parts without rows go."""
        folder = self._folder(table)
        df.repartition(by).write.partitionBy(by).parquet(f"{self.base}/{folder}")
        parts = self.tables.setdefault(table, {})
        for name in touched:
            parts.pop(name, None)
        fs, path = hadoop_path(self.spark, f"{self.base}/{folder}")
        for st in fs.listStatus(path):
            name = st.getPath().getName()
            if name.startswith(f"{by}="):
                parts[name.split("=", 1)[1]] = f"{folder}/{name}"
        self.formats[table] = "parquet"

    def commit(self) -> Snapshot:
        """Make all that was written the current state, by one rename that fails if another run was faster."""
        number = self.head + 1
        record = {"number": number, "run": self.run, "before": self.before, "at": time.time(), "tables": self.tables,
                  "formats": self.formats, "settings": self.settings}
        if not _create(self.spark, f"{self.base}/{LOG}", f"{number:012d}.json", json.dumps(record)):
            raise CommitConflict(f"{self.base}: record {number} exists already")
        return _snapshot(self.spark, self.base, record)


def current(spark: SparkSession, base: str) -> Snapshot:
    """The state of the highest record; an empty one before the first."""
    numbers = _numbers(spark, base)
    return at(spark, base, numbers[-1]) if numbers else Snapshot(spark, base)


def at(spark: SparkSession, base: str, number: int) -> Snapshot:
    """The state of one record; number -1 is the empty state."""
    return Snapshot(spark, base) if number < 0 else _snapshot(spark, base, _load(spark, f"{base}/{LOG}/{number:012d}.json"))


def begin(spark: SparkSession, base: str, run: str) -> Transaction:
    """A transaction of ``run`` on the current state, or on the state before it if the run was the last to commit."""
    head = current(spark, base)
    if head.run == run:
        return Transaction.on(at(spark, base, head.before), run, head.number)
    if any(s.run == run for s in log(spark, base)):
        raise AlreadyCommitted(f"{run} is committed, and later runs build on it")
    return Transaction.on(head, run, head.number)


def log(spark: SparkSession, base: str) -> list[Snapshot]:
    """All records that are still there, oldest first."""
    return [at(spark, base, n) for n in _numbers(spark, base)]


def vacuum(spark: SparkSession, base: str, keep: int = 10, older_than_s: float = 7 * 86400.0) -> int:
    """Delete all records but the last ``keep`` and the folders that none of these names; returns how many folders.

    A record that a kept one started from stays, too, so that its run can be
    repeated.  Folders younger than ``older_than_s`` stay: a run that has not
    committed yet may be writing them.
    """
    numbers = _numbers(spark, base)
    states = [at(spark, base, n) for n in numbers[-keep:]]
    kept = {s.number for s in states} | {s.before for s in states}
    states += [at(spark, base, n) for n in numbers if n in kept and n not in numbers[-keep:]]
    alive = {"/".join(f.split("/")[:t.count("/") + 2]) for s in states for t, parts in s.tables.items() for f in parts.values()}
    tables = {t for n in numbers for t in at(spark, base, n).tables}
    deleted = 0
    for table in tables:
        fs, path = hadoop_path(spark, f"{base}/{table}")
        for st in fs.listStatus(path) if fs.exists(path) else ():
            name = st.getPath().getName()
            old = time.time() - st.getModificationTime() / 1000 > older_than_s
            if ATTEMPT.fullmatch(name) and f"{table}/{name}" not in alive and old:
                fs.delete(st.getPath(), True)
                deleted += 1
    for n in numbers:
        if n not in kept:
            fs, path = hadoop_path(spark, f"{base}/{LOG}/{n:012d}.json")
            fs.delete(path, False)
    return deleted


def _snapshot(spark: SparkSession, base: str, record: dict) -> Snapshot:
    return Snapshot(spark, base, record["number"], record["run"], record["before"], record["tables"], record["formats"], record["settings"])


def _numbers(spark: SparkSession, base: str) -> list[int]:
    fs, path = hadoop_path(spark, f"{base}/{LOG}")
    if not fs.exists(path):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(path)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json"))


def _load(spark: SparkSession, path: str) -> dict:
    fs, hpath = hadoop_path(spark, path)
    stream = fs.open(hpath)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()


def _create(spark: SparkSession, folder: str, name: str, text: str) -> bool:
    """Write a file under a temporary name and rename it, without replacing; False if the name is taken."""
    jvm = spark.sparkContext._jvm
    fs, target = hadoop_path(spark, f"{folder}/{name}")
    _, tmp = hadoop_path(spark, f"{folder}/.{name}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf)
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(tmp), fs.makeQualified(target), options)
        return True
    except Exception as e:  # the gateway wraps the file system's own error
        if fs.exists(target):
            fs.delete(tmp, False)
            return False
        raise e

