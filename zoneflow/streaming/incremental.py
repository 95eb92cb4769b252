"""Incremental load (I1): batch loader over the change feed, and its
Structured Streaming twin.

Batch rule: the source table's change feed is on *and* the last processed
version is at or after the version where it was switched on -> read change
rows of versions (last, latest] (an overwrite's rows count as inserts);
otherwise, or if a merge in between recorded no change rows, switch the feed on and do a full
load of the latest snapshot.  "Never processed" is its own state (null), not
version 0 (Q21), and the range starts after the last processed version, not
at it (Q1).  The control row is written only after the caller's merge
succeeded (``commit``): at-least-once delivery made idempotent by the merge.

Streaming twin: a file-source ``readStream`` over the table's commit rows
(each is written last, so only committed versions are seen),
``foreachBatch`` applying a merge to their change rows,
``trigger(availableNow)`` and a checkpoint in the shared folder; the file
source's own log replaces the control table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Sequence
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators.merge import merge_replace
from zoneflow.sources.store import COMMIT_SCHEMA, VersionedTable

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType(), False),
        T.StructField("last_processed_version", T.LongType(), False),
        T.StructField("last_run_ts", T.TimestampType(), True),
    ]
)


class ControlTable:
    """Per-source high-water versions, upserted with K8 (replace)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.table = VersionedTable(spark, path)

    def _df(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], CONTROL_SCHEMA)
        return self.table.read()

    def last_processed(self, source: str) -> int | None:
        rows = self._df().where(F.col("source_table") == source).select("last_processed_version").collect()
        return rows[0][0] if rows else None

    def update(self, source: str, version: int, as_of: _dt.datetime | None = None) -> None:
        ts = as_of or _dt.datetime.now(_dt.UTC).replace(tzinfo=None)
        row = self.spark.createDataFrame([(source, int(version), ts)], CONTROL_SCHEMA)
        if not self.table.exists():
            self.table.create(row, enable_cdf=False)
        else:
            # The new version is written to its own directory, so reading the
            # previous version while writing it is safe.
            self.table.overwrite(merge_replace(self._df(), row, ["source_table"]))


class IncrementalLoader:
    def __init__(self, spark: SparkSession, control: ControlTable, source_name: str, source: VersionedTable):
        self.spark = spark
        self.control = control
        self.name = source_name
        self.source = source
        self.pending_version: int | None = None
        self.mode: str | None = None

    def get_new_data(self, change_types: Sequence[str] = ("insert",)) -> DataFrame:
        last = self.control.last_processed(self.name)
        latest = self.source.latest_version()
        cdf_from = self.source.cdf_start_version()
        if last is not None and cdf_from is not None and last >= cdf_from and self.source.changes_recorded(last + 1, latest):
            self.pending_version = latest
            if last >= latest:
                self.mode = "none"
                return self.source.empty()
            self.mode = "changes"
            return self.source.read_changes(last + 1, latest, change_types)
        if cdf_from is None:
            self.source.enable_cdf()
            latest = self.source.latest_version()
        self.mode = "full"
        self.pending_version = latest
        return self.source.read(version=latest)

    def commit(self) -> None:
        if self.pending_version is None:
            raise RuntimeError("get_new_data() first")
        self.control.update(self.name, self.pending_version)


def stream_merge(
    spark: SparkSession,
    source: VersionedTable,
    apply_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    change_types: Sequence[str] = ("insert", "update_postimage"),
) -> None:
    """Streaming twin of I1: the change rows of every newly committed version
    of ``source`` flow through ``apply_batch(batch_df, batch_id)`` (typically
    a K6 merge into a target VersionedTable); ``max_files_per_trigger`` bounds
    the commit files of a micro-batch.  Versions that only add rows are taken
    together; a merge or an overwrite is a batch of its own, so that a key's
    old and new rows do not meet in one.  Runs until all commits are processed."""
    reader = spark.readStream.schema(COMMIT_SCHEMA).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))

    def apply_commits(commits: DataFrame, batch_id: int) -> None:
        # the versions of one micro-batch are consecutive: commit files are taken oldest first
        span = commits.where(F.col("operation") != "SET TBLPROPERTIES").agg(F.min("version"), F.max("version")).first()
        if span[0] is not None:
            log = [c for c in source.history(refresh=True) if span[0] <= c.version <= span[1]]
            for _, run in groupby(log, key=lambda c: c.version if c.operation in ("MERGE", "WRITE_OVERWRITE") else -1):
                versions = [c.version for c in run if c.operation != "SET TBLPROPERTIES"]
                if versions:
                    apply_batch(source.read_changes(versions[0], versions[-1], change_types), batch_id)

    query = (
        reader.parquet(source.commits_path)
        .writeStream.foreachBatch(apply_commits)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
