"""Incremental load (I1) on plain Spark: arriving files -> unit-partitioned Parquet.

A file-source stream takes each file of a growing folder once.  Rows that were
delivered before are dropped by the state store, which remembers a key for
``horizon`` of arrival time; what is left is appended to Parquet partitioned
by unit (a day, say) through the file sink.  Sources, state and sink share one
checkpoint, so a run that was killed at any point goes on where it stopped and
every row is written exactly once.  There is no control table and no commit
log besides Spark's own.  The units stand in for versions: a state as of a unit, an
increment and the history of loads are filters and counts over partitions.

The watermark runs on the arrival time of files, not on the rows' own times: a
row that is late by its own time is still loaded.

Rows with a null in a key have no identity and are only dropped as copies of
the whole row.  Reading an increment is a filter on the unit, which prunes
partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

UNIT = "unit"


def start_load(
    spark: SparkSession,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    keys: Sequence[str],
    unit: Column,
    horizon: str = "30 days",
    max_files_per_trigger: int | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """The running load of the Parquet files below ``source``; ``every``: an interval, default: until all present files are loaded."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = reader.parquet(source).withColumn("__arrived", F.col("_metadata.file_modification_time"))
    unknown = F.lit(False)
    for k in keys:
        unknown = unknown | F.col(k).isNull()
    whole = F.sha2(F.to_json(F.struct(*schema.fieldNames())), 256)
    rows = rows.withColumn("__whole", F.when(unknown, whole)).withWatermark("__arrived", horizon)
    rows = rows.dropDuplicatesWithinWatermark([*keys, "__whole"]).select(*schema.fieldNames()).withColumn(UNIT, unit)
    writer = rows.writeStream.format("parquet").partitionBy(UNIT).option("path", target).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def load_arrivals(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, keys: Sequence[str], unit: Column, **options) -> None:
    """Loads all files that are there and returns; a failure is raised, and the next call goes on after it."""
    query = start_load(spark, source, schema, target, checkpoint, keys, unit, **options)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def read_units(spark: SparkSession, target: str, after=None, upto=None) -> DataFrame:
    """The loaded rows of the units beyond ``after`` and up to ``upto``."""
    rows = spark.read.parquet(target)
    if after is not None:
        rows = rows.where(F.col(UNIT) > F.lit(after))
    if upto is not None:
        rows = rows.where(F.col(UNIT) <= F.lit(upto))
    return rows


def unit_history(spark: SparkSession, target: str) -> DataFrame:
    """What has been loaded so far: each unit's rows, and whether it is the latest."""
    units = spark.read.parquet(target).groupBy(UNIT).agg(F.count("*").alias("n_rows"))
    latest = units.agg(F.max(UNIT).alias("latest"))  # one row
    return units.crossJoin(F.broadcast(latest)).select(UNIT, "n_rows", (F.col(UNIT) == F.col("latest")).alias("is_latest"))


def deliver(rows: DataFrame, unit: Column, source: str) -> None:
    """Adds ``rows`` to a folder of arriving files, a folder for each unit; large units become several files."""
    rows.withColumn(UNIT, unit).hint("rebalance", UNIT).write.partitionBy(UNIT).mode("append").parquet(source)
