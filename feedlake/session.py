"""Spark session defaults and lineage helpers.

Every job in the package takes an existing ``SparkSession``; this module only
offers a builder with the settings the jobs assume (UTC clock, AQE with skew
splitting) and a helper that cuts long lineages through the cluster's shared
checkpoint folder.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, app_name: str = "feedlake",
                  shuffle_partitions: int | None = None) -> SparkSession:
    """Session with the settings the jobs are written for.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs executors inside the driver JVM.
            builder = builder.config("spark.driver.memory",
                                     os.environ.get("FEEDLAKE_DRIVER_MEMORY", "12g"))
    parts = shuffle_partitions or int(os.environ.get("FEEDLAKE_SHUFFLE_PARTITIONS", "8"))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoint files of DataFrames that are no longer referenced are removed.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder
    and is used as is.  Only a local session without one (tests, the bench)
    gets a fresh scratch folder; on a cluster a missing setting is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    if current:
        if not sc_dir:
            spark.sparkContext.setCheckpointDir(current)
        return current
    if sc_dir:
        return sc_dir
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
    path = tempfile.mkdtemp(prefix="feedlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
