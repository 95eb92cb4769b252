"""Session helpers.

Cluster jobs get their SparkSession from the platform; ``local_session`` is
only for tests and the bench.  ``scratch_path`` hands out directories under
the shared folder named by ``spark.checkpoint.dir`` so that intermediate
tables survive executor loss; only when that setting is missing (local
tests) does it create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

_CKPT_KEY = "spark.checkpoint.dir"
_CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "zoneflow") -> SparkSession:
    """Local session with AQE on, UTC, UI off (tests and bench only)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # Single node: list partition directories on the driver instead of
        # launching a listing job (clusters on object stores keep the default).
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "100000")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get(_CKPT_KEY, None) or sc.getConf().get(_CKPT_KEY, None)
    if not base:
        base = local_scratch(sc.master)
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()


def local_scratch(master: str) -> str:
    """A machine-local folder, for a single-machine session only: executors of a
    cluster would each write to a disk of their own."""
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"{_CKPT_KEY} has to name a folder that all executors share")
    return tempfile.mkdtemp(prefix="zoneflow-ckpt-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/zoneflow-{name}-{uuid.uuid4().hex[:12]}"


def table_path(root: str, *parts: str) -> str:
    """Zone / domain / table path convention (one helper, see SURVEY Q17)."""
    return os.path.join(root, *parts)


def materialize(spark: SparkSession, df, name: str):
    """Write ``df`` as a parquet table in the shared checkpoint folder and read
    it back: cuts lineage, avoids recomputing a reused intermediate, and
    survives executor loss (unlike localCheckpoint / cache)."""
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write in this block drops its shuffle files as it ends.  Otherwise they stay, beside all that
    is written next, until the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEANUP_KEY, None)
    spark.conf.set(_CLEANUP_KEY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP_KEY)
        else:
            spark.conf.set(_CLEANUP_KEY, before)


def spread(df, min_partitions: int | None = None):
    """Round-robin repartition only when a scan yields fewer partitions than
    the cluster's parallelism (e.g. one big row group); on large inputs it is
    a no-op, so no extra shuffle is added at scale."""
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def in_tasks_of(df, rows: int = 1 << 18):
    """``df`` in tasks of about ``rows`` rows: what an aggregate holds of a task's rows then does not
    grow with the table.  A table that is dealt finely enough already is left as it is."""
    tasks = -(-df.count() // rows)
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df
