"""Daily partial aggregates of checks, merged at read.

A day's checks are folded once into narrow rows: one per run with counts, one per
publication with its last check, last success and whether any succeeded.  Sums and
maxima merge in any grouping, so the history of a run or a publication is read
from one small row per day instead of from its checks.  The partials are parts
of a run commit, named after the day: recording a day again replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.commits import Snapshot, Transaction
from . import health, registry

RUNS = "state/run_checks"
PUBLICATIONS = "state/publication_checks"
COUNTS = ("attempted", "succeeded", "failed", "dns_failed", "http_failed")


def run_partials(checks: DataFrame, *by: str) -> DataFrame:
    """Counts of the checks of every run (and day): mergeable by sums."""
    def n(condition):
        return F.count_if(condition)

    source = F.col("kind") == "source"
    return checks.groupBy(*(by or ("run_id",))).agg(
        n(source).alias("attempted"), n(source & F.col("ok")).alias("succeeded"), n(source & ~F.col("ok")).alias("failed"),
        n((F.col("kind") == "dns") & ~F.col("ok")).alias("dns_failed"), n((F.col("kind") == "http") & ~F.col("ok")).alias("http_failed"))


def merge_runs(partials: DataFrame, by: str = "run_id") -> DataFrame:
    return partials.groupBy(by).agg(*[F.sum(c).cast("long").alias(c) for c in COUNTS])


def check_counts(merged: DataFrame, by: str = "run_id") -> DataFrame:
    """E2 from merged partials; runs without source checks have no row."""
    return merged.where("attempted > 0").select(by, *[F.col(c).alias(f"source_checks_{c}") for c in COUNTS[:3]])


def preflight_status(merged: DataFrame, by: str = "run_id") -> DataFrame:
    """E5 from merged partials."""
    flags = merged.select(by, (F.col("dns_failed") > 0).cast("int").alias("_dns_fail"), (F.col("http_failed") > 0).cast("int").alias("_http_fail"))
    return health.preflight_from_flags(flags, by)


def record_days(tx: Transaction, run_checks: DataFrame, publication_checks: DataFrame, day_col: str = "day") -> None:
    """Fold the checks of one or more days into their parts of the running transaction; these days are replaced, others stay.

    ``run_checks``: run_id, kind, ok and the day; ``publication_checks``: the rows of :func:`registry.mark_checked` and the day.
    """
    days = [str(r[0]) for r in run_checks.select(day_col).unionByName(publication_checks.select(day_col)).distinct().collect()]
    tx.write_parts(RUNS, run_partials(run_checks, "run_id", day_col), day_col, days)
    tx.write_parts(PUBLICATIONS, registry.check_fold(publication_checks, day_col), day_col, days)


def runs(state: Snapshot) -> DataFrame | None:
    """Merged counts of all runs."""
    found = state.read(RUNS)
    return None if found is None else merge_runs(found)


def mark_checked(reg: DataFrame, state: Snapshot, days: list[str] | None = None) -> DataFrame:
    """G4 from the partials of all days (or of some): the registry as if their checks had been folded at once."""
    found = state.read(PUBLICATIONS, days)
    return reg if found is None else registry.apply_checks(reg, registry.merge_folds(found))
