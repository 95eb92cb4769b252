"""Versioned-store, merge, incremental and sink queries.

Operators: K6 J4 K7 A5 P12 K8 M4 I1 S5 S6 S7 K1 K3 K5 K10.  Each query writes
its tables under the shared checkpoint folder (never a machine-local temp
dir) and returns the resulting snapshot as a DataFrame.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from zoneflow.operators import evolve, quality, shape
from zoneflow.operators import merge as mg
from zoneflow.plans.registry import register, table
from zoneflow.session import scratch_path
from zoneflow.sources import sinks
from zoneflow.sources.store import VersionedTable
from zoneflow.streaming import arrivals

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _orders_split(spark, d):
    """Trusted snapshot = orders before 1998; landing batch = orders from 1997
    on (overlapping a year), with some priorities missing and open orders
    re-priced."""
    orders = table(spark, d, "orders")
    target = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    batch = orders.where(F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice") + 1.0).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("o_orderpriority"),
    )
    return target, batch


_SPLIT_SQL = """
WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
     s AS (SELECT o_orderkey, o_custkey, o_orderstatus,
                  CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1.0 ELSE o_totalprice END AS o_totalprice,
                  o_orderdate, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
           FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
"""

_COALESCE_SQL = (
    _SPLIT_SQL
    + """
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       coalesce(s.o_custkey, t.o_custkey) AS o_custkey,
       coalesce(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
       coalesce(s.o_totalprice, t.o_totalprice) AS o_totalprice,
       coalesce(s.o_orderdate, t.o_orderdate) AS o_orderdate,
       coalesce(s.o_orderpriority, t.o_orderpriority) AS o_orderpriority
FROM t FULL OUTER JOIN s ON s.o_orderkey = t.o_orderkey
"""
)


# Trusted orders are laid out by order month; merges rewrite only the months
# that hold matched keys.
def order_month():
    return F.date_format("o_orderdate", "yyyyMM").cast("int")


@register("merge_upsert", _COALESCE_SQL)
def merge_upsert(spark, d):
    """K6 through the store: create the trusted table, merge the batch
    (partition-aware: only months with matching keys are rewritten), read latest."""
    target, batch = _orders_split(spark, d)
    vt = VersionedTable(spark, scratch_path(spark, "merge-upsert"), unit=order_month())
    vt.create(target)
    vt.merge_into(batch, ["o_orderkey"], "coalesce", check_unique=True)
    return vt.read()


@register("merge_high_water", _COALESCE_SQL)
def merge_high_water(spark, d):
    """K7: high-water split at the store - rows at or below the max date are
    merged (with the Q5/Q6 fixes), newer rows are a plain append; the result
    equals K6."""
    target, batch = _orders_split(spark, d)
    vt = VersionedTable(spark, scratch_path(spark, "merge-hw"), unit=order_month())
    vt.create(target)
    vt.merge_high_water(batch, ["o_orderkey"], "o_orderdate")
    return vt.read()


@register(
    "merge_replace",
    """
WITH t AS (SELECT * FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'MACHINERY')),
     s AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal - 100.0 AS c_acctbal, c_mktsegment
           FROM customer WHERE c_mktsegment IN ('FURNITURE', 'HOUSEHOLD'))
SELECT * FROM t WHERE c_custkey NOT IN (SELECT c_custkey FROM s)
UNION ALL SELECT * FROM s
""",
)
def merge_replace(spark, d):
    """K8 / M4: whole-row replace upsert."""
    cust = table(spark, d, "customer")
    target = cust.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "FURNITURE", "MACHINERY"))
    batch = cust.where(F.col("c_mktsegment").isin("FURNITURE", "HOUSEHOLD")).withColumn(
        "c_acctbal", F.col("c_acctbal") - 100.0
    )
    vt = VersionedTable(spark, scratch_path(spark, "merge-replace"), unit=F.pmod(F.xxhash64("c_custkey"), F.lit(16)))
    vt.create(target)
    vt.merge_into(batch, ["c_custkey"], "replace")
    return vt.read()


@register(
    "incremental_versions",
    """
SELECT * FROM events WHERE CAST(ts AS DATE) >= (SELECT min(CAST(ts AS DATE)) FROM events) + INTERVAL 10 DAY
""",
)
def incremental_versions(spark, d):
    """I1 + P12: ten days of events have arrived and are loaded, then the others; the second
    run goes on from the checkpoint, and the increment is read by its units."""
    events, day = table(spark, d, "events"), F.to_date("ts")
    source, target, checkpoint = (scratch_path(spark, n) for n in ("events-in", "events-loaded", "events-checkpoint"))
    first = events.agg(F.min(day)).first()[0]
    early = day < F.date_add(F.lit(first), 10)
    for rows in (events.where(early), events.where(~early)):
        arrivals.deliver(rows, day, source)
        arrivals.load_arrivals(spark, source, events.schema, target, checkpoint, ["event_id"], day)
    return arrivals.read_units(spark, target, after=first + timedelta(days=9)).select(*events.columns)


@register("incremental_stream", "SELECT * FROM events")
def incremental_stream(spark, d):
    """I1 as a stream: daily folders arrive, a seventh of the events is delivered twice; micro-batches
    of bounded size append what is new to daily Parquet."""
    events, day = table(spark, d, "events"), F.to_date("ts")
    source, target, checkpoint = (scratch_path(spark, n) for n in ("events-in", "events-loaded", "events-checkpoint"))
    arrivals.deliver(events, day, source)
    arrivals.deliver(events.where("event_id % 7 = 0"), day, source)
    arrivals.load_arrivals(spark, source, events.schema, target, checkpoint, ["event_id"], day, max_files_per_trigger=64)
    return arrivals.read_units(spark, target).select(*events.columns)


def _loaded_events(spark, d):
    """Events as daily folders, loaded into daily Parquet; the first day."""
    events, day = table(spark, d, "events"), F.to_date("ts")
    source, target, checkpoint = (scratch_path(spark, n) for n in ("events-in", "events-loaded", "events-checkpoint"))
    arrivals.deliver(events, day, source)
    arrivals.load_arrivals(spark, source, events.schema, target, checkpoint, ["event_id"], day)
    return events.columns, target, events.agg(F.min(day)).first()[0]


@register("units_as_of", "SELECT * FROM events WHERE CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) FROM events) + INTERVAL 14 DAY")
def units_as_of(spark, d):
    """S5 + S4: the loaded table as it was after its fifteenth day, by pruned partitions."""
    columns, target, first = _loaded_events(spark, d)
    return arrivals.read_units(spark, target, upto=first + timedelta(days=14)).select(*columns)


@register(
    "units_range",
    "SELECT * FROM events WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events) + INTERVAL 5 DAY AND CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) FROM events) + INTERVAL 12 DAY",
)
def units_range(spark, d):
    """What came after one unit and up to another."""
    columns, target, first = _loaded_events(spark, d)
    return arrivals.read_units(spark, target, after=first + timedelta(days=5), upto=first + timedelta(days=12)).select(*columns)


@register(
    "units_history",
    "SELECT CAST(ts AS DATE) AS unit, count(*) AS n_rows, CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) AS is_latest FROM events GROUP BY CAST(ts AS DATE)",
)
def units_history(spark, d):
    """S7 + T5: what each load brought, and the latest."""
    _, target, _ = _loaded_events(spark, d)
    return arrivals.unit_history(spark, target)


@register("snapshot_read", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def snapshot_read(spark, d):
    """S5 + K3 + K1: v0 all orders, v1 overwrite with finished orders, v2
    append of open orders; time travel to v1."""
    orders = table(spark, d, "orders")
    vt = VersionedTable(spark, scratch_path(spark, "snapshots"))
    vt.create(orders)
    vt.overwrite(orders.where(F.col("o_orderstatus") == "F"))
    vt.append(orders.where(F.col("o_orderstatus") == "O"))
    return vt.read(version=1)


@register(
    "batched_sink_report",
    """
SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS _id, CASE WHEN length(text) > 20000 THEN 'failed' ELSE 'sent' END AS status,
       CASE WHEN length(text) > 20000 THEN 'ValueError(''more than 20000 characters'')' END AS error
FROM documents
""",
)
def batched_sink_report(spark, d):
    """A dry run of every document record through the batched sink: records over the
    service's limit fail their batch, are retried alone and are reported."""
    docs = table(spark, d, "documents")
    records = docs.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("_id"),
        F.col("text").alias("text_to_embed"),
        F.lit("documents").alias("source"),
    )
    return sinks.batched_upsert(records, lambda: sinks.Preflight(20000), batch_size=95)


@register(
    "append_evolved",
    """
SELECT o_orderkey, CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS price, CAST(NULL AS VARCHAR) AS priority, CAST(o_orderdate AS DATE)::TIMESTAMP AS placed, NULL AS customer_id, NULL AS customer_segment FROM orders WHERE o_orderkey % 3 = 0
UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderdate, o_custkey, NULL FROM orders WHERE o_orderkey % 3 = 1
UNION ALL SELECT o_orderkey, o_totalprice, NULL, NULL, o_custkey, o_orderstatus FROM orders WHERE o_orderkey % 3 = 2
""",
)
def append_evolved(spark, d):
    """K2 + K4 + P3: three batches of orders whose schema drifts: narrower numbers and dates first, then new
    columns and a new struct, then a new field in the struct and columns that are gone."""
    orders = table(spark, d, "orders")
    part = lambda k: orders.where(F.col("o_orderkey") % 3 == k)
    batches = [
        part(0).select(F.col("o_orderkey").cast("int").alias("o_orderkey"), F.col("o_totalprice").cast("float").alias("price"), F.col("o_orderdate").cast("date").alias("placed")),
        part(1).select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").alias("placed"), F.struct(F.col("o_custkey").cast("int").alias("id")).alias("customer")),
        part(2).select("o_orderkey", F.col("o_totalprice").alias("price"), F.struct(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("segment")).alias("customer")),
    ]
    evolving = evolve.EvolvingTable(spark, scratch_path(spark, "evolving"))
    for batch in batches:
        evolving.append(batch)
    return evolving.read().select("o_orderkey", "price", "priority", "placed", F.col("customer.id").alias("customer_id"), F.col("customer.segment").alias("customer_segment"))


@register(
    "stage_deltas",
    """
WITH a AS (SELECT DISTINCT text, lang, source FROM documents), b AS (SELECT * FROM a WHERE length(text) >= 200), c AS (SELECT DISTINCT text FROM b), e AS (SELECT text, unnest([1, 2]) AS role FROM c)
SELECT 'dedupe' AS stage, 0 AS place, (SELECT count(*) FROM documents) AS rows_in, (SELECT count(*) FROM a) AS rows_out, (SELECT count(*) FROM documents) - (SELECT count(*) FROM a) AS removed, CAST(0 AS BIGINT) AS added
UNION ALL SELECT 'long texts', 1, (SELECT count(*) FROM a), (SELECT count(*) FROM b), (SELECT count(*) FROM a) - (SELECT count(*) FROM b), 0
UNION ALL SELECT 'merge', 2, (SELECT count(*) FROM b), (SELECT count(*) FROM c), (SELECT count(*) FROM b) - (SELECT count(*) FROM c), 0
UNION ALL SELECT 'roles', 3, (SELECT count(*) FROM c), (SELECT count(*) FROM e), 0, (SELECT count(*) FROM e) - (SELECT count(*) FROM c)
""",
)
def stage_deltas(spark, d):
    """Rows in, out, removed and added of each stage of a cleaning job, counted while the stages run."""
    docs = table(spark, d, "documents").select("text", "lang", "source")
    stages = [
        ("dedupe", quality.dedupe),
        ("long texts", lambda df: df.where(F.length("text") >= 200)),
        ("merge", lambda df: quality.merge_elements(df, ["text"])),
        ("roles", lambda df: df.select("text", F.explode(F.array(F.lit(1), F.lit(2))).alias("role"))),
    ]
    return quality.counted_stages(spark, docs, stages)[1]


@register(
    "records_and_registry",
    """
WITH r AS (SELECT o_orderkey, nullif(CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderpriority END, '4-NOT SPECIFIED') AS first, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS second, CAST(o_orderdate AS DATE) AS placed FROM orders)
SELECT 'records' AS kind, 'order_' || CAST(o_orderkey AS VARCHAR) AS id, coalesce(first, second) AS text, CAST(NULL AS DATE) AS placed FROM r WHERE coalesce(first, second, '') <> ''
UNION ALL SELECT 'registry', CAST(o_orderkey AS VARCHAR), NULL, placed FROM r
""",
)
def records_and_registry(spark, d):
    """Records and the key/date registry of orders, from one pass, both read back."""
    orders = table(spark, d, "orders").select(
        "o_orderkey",
        F.nullif(F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderpriority")), F.lit("4-NOT SPECIFIED")).alias("first"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("second"),
        F.to_date("o_orderdate").alias("placed"),
    )
    records, registry = shape.write_records(orders, scratch_path(spark, "records"), "o_orderkey", ["first", "second"], "orders", "placed", "order_")
    left = records.select(F.lit("records").alias("kind"), F.col("_id").alias("id"), F.col("text_to_embed").alias("text"), F.lit(None).cast("date").alias("placed"))
    return left.unionByName(registry.select(F.lit("registry").alias("kind"), F.col("o_orderkey").alias("id"), F.lit(None).cast("string").alias("text"), "placed"))
