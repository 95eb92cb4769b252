"""File scans, empty relations, order, stamps and namespace upkeep."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import temporal
from zoneflow.operators import shape
from zoneflow.plans.registry import register, table
from zoneflow.session import scratch_path
from zoneflow.sources import files, sinks
from zoneflow.sources.store import VersionedTable


@register("json_scan", "SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events")
def json_scan(spark, d):
    """Events as JSON files, read with a schema of their own (nothing is inferred)."""
    events = table(spark, d, "events").withColumn("at", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).drop("ts")
    path = scratch_path(spark, "json")
    events.write.json(path)
    return files.read_json(spark, path, events.schema, multi_line=False).select("event_id", "user_id", "event_type", "value", "props", "at")


@register(
    "tabular_scan",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'csv' AS kind FROM customer UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'parquet' FROM customer",
)
def tabular_scan(spark, d):
    """S3: customers as a CSV file with a header and as Parquet, both read with a schema."""
    customers = table(spark, d, "customer")
    out = []
    for kind in ("csv", "parquet"):
        path = scratch_path(spark, f"table-{kind}")
        customers.write.format(kind).options(**({"header": "true"} if kind == "csv" else {})).save(path)
        out.append(files.read_table_file(spark, path, kind, customers.schema).withColumn("kind", F.lit(kind)))
    return shape.union_batches(out)


@register("empty_relation", "SELECT * FROM orders")
def empty_relation(spark, d):
    """No rows with the source's own schema, to which the first load is added by name."""
    orders = table(spark, d, "orders")
    source = VersionedTable(spark, scratch_path(spark, "empty-source"))
    source.create(orders)
    return source.empty().unionByName(source.read())


@register("overwrite_schema", "SELECT o_orderkey AS order_id, upper(o_orderpriority) AS priority FROM orders WHERE o_orderstatus <> 'P'")
def overwrite_schema(spark, d):
    """K4: a table overwritten with other columns reads back with those."""
    orders = table(spark, d, "orders")
    target = VersionedTable(spark, scratch_path(spark, "overwritten"))
    target.create(orders)
    target.overwrite(orders.where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("order_id"), F.upper("o_orderpriority").alias("priority")))
    return target.read()


@register("namespace_stats", "SELECT source, count(*) AS n_vectors, CAST(0 AS BIGINT) AS after_reset FROM documents GROUP BY source")
def namespace_stats(spark, d):
    """Vectors of each namespace, and what a reset leaves."""
    records = table(spark, d, "documents").select(F.col("doc_id").alias("_id"), "source")
    left = sinks.namespace_stats(sinks.reset_namespace(spark, records)).withColumnRenamed("n_vectors", "left")
    return sinks.namespace_stats(records).join(left, "source", "left").select("source", "n_vectors", F.coalesce("left", F.lit(0)).cast("bigint").alias("after_reset"))


@register("peek_latest", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at FROM events ORDER BY ts DESC LIMIT 5")
def peek_latest(spark, d):
    """T1 + T7: the first rows of a global order (the limit is the feature)."""
    events = shape.order_by(table(spark, d, "events"), "ts", ascending=False)
    rows = [(r.event_id, r.user_id, r.ts.strftime("%Y-%m-%d %H:%M:%S.%f")) for r in shape.peek(events, 5)]
    return spark.createDataFrame(rows, T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()), T.StructField("at", T.StringType())]))


@register("ingestion_stamps", "SELECT event_id, '2024-06-01 12:00:00' AS given, true AS recent FROM events")
def ingestion_stamps(spark, d):
    """a stamp that is given, and one of the time of the load."""
    as_of = dt.datetime(2024, 6, 1, 12, 0, 0)
    events = table(spark, d, "events").withColumns({"given": temporal.stamp(as_of), "loaded": temporal.stamp()})
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("loaded")
    return events.select("event_id", F.date_format("given", "yyyy-MM-dd HH:mm:ss").alias("given"), age.between(0, 3600).alias("recent"))
