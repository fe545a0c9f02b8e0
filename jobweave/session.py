"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    app_name: str = "jobweave",
    master: str | None = None,
    default_fs: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create or reuse a session.

    The master comes from the argument, else from ``SPARK_MASTER``, else from
    whatever ``spark-submit`` was given.  ``extra`` carries sink settings such
    as the host and port of a search index.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    master = master or os.getenv("SPARK_MASTER")
    if master:
        builder = builder.master(master)
    if default_fs:
        builder = builder.config("spark.hadoop.fs.defaultFS", default_fs)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only where none is named.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  A machine-local folder is acceptable in local mode alone.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
        named = tempfile.mkdtemp(prefix="jobweave-checkpoint-")
    spark.sparkContext.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan with fewer partitions than cores before costly row work.

    A large scan already has more partitions than cores and is left alone, so
    nothing is shuffled at scale.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def deal(df: DataFrame) -> DataFrame:
    """Deal narrow rows evenly to three tasks a core before costly row work.

    The partitions of a scan follow the bytes of its files, and a row group is never split: a few MB hold a million
    narrow rows, which one task would then work on alone, however many partitions the scan has.
    """
    return df.repartition(3 * df.sparkSession.sparkContext.defaultParallelism)


def compute_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters must not evaluate a second time.

    Catalyst copies a column's expression into filters it pushes below the
    projection; it does not push them below a generator.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
