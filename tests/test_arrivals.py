"""The incremental load: every row once, across repeated deliveries, kills and lost commits."""

import os
import time
from collections import Counter

from pyspark.sql import functions as F

from zoneflow.streaming import arrivals

SCHEMA = "id long, ts timestamp_ntz, text string"


def rows(spark, ids, day=1, text="t"):
    out = spark.createDataFrame([(i, text) for i in ids], "id long, text string")
    return out.select("id", F.lit(f"2024-01-{day:02d} 10:00:00").cast("timestamp_ntz").alias("ts"), "text")


def load(spark, base, **options):
    schema = rows(spark, []).schema
    arrivals.load_arrivals(spark, f"{base}/in", schema, f"{base}/out", f"{base}/checkpoint", ["id", "ts"], F.to_date("ts"), **options)
    return Counter((r.id, r.ts.day if r.ts else None, r.text) for r in arrivals.read_units(spark, f"{base}/out").collect())


def test_repeated_late_and_unknown_rows(spark, tmp_path):
    base, day = str(tmp_path), F.to_date("ts")
    arrivals.deliver(rows(spark, range(50), 9), day, f"{base}/in")
    arrivals.deliver(rows(spark, range(20), 9), day, f"{base}/in")  # again
    first = load(spark, base)
    assert first == Counter((i, 9, "t") for i in range(50))
    late = rows(spark, range(5), 1)  # an earlier day arrives later
    unknown = spark.createDataFrame([(None, None, "a"), (None, None, "b"), (None, None, "a")], SCHEMA)
    arrivals.deliver(late.unionByName(unknown).unionByName(rows(spark, [3], 9)), day, f"{base}/in")
    second = load(spark, base)
    assert second - first == Counter([*((i, 1, "t") for i in range(5)), (None, None, "a"), (None, None, "b")])
    assert load(spark, base) == second  # nothing new
    assert arrivals.read_units(spark, f"{base}/out", after=F.lit("2024-01-05").cast("date")).count() == 50


def test_killed_run_goes_on(spark, tmp_path):
    base, day = str(tmp_path), F.to_date("ts")
    for k in range(8):  # overlapping deliveries, some files each
        arrivals.deliver(rows(spark, range(10 * k, 10 * k + 15), 1 + k % 3).withColumn("ts", F.lit("2024-01-02 10:00:00").cast("timestamp_ntz")), day, f"{base}/in")
    schema = rows(spark, []).schema
    query = arrivals.start_load(spark, f"{base}/in", schema, f"{base}/out", f"{base}/checkpoint", ["id", "ts"], day, max_files_per_trigger=1, every="10 milliseconds")
    commits = f"{base}/checkpoint/commits"
    until = time.time() + 120
    while time.time() < until and len([f for f in (os.listdir(commits) if os.path.isdir(commits) else []) if f.isdigit()]) < 2:
        time.sleep(0.05)
    query.stop()  # in the midst of a batch
    done = sorted(int(f) for f in os.listdir(commits) if f.isdigit())
    assert len(done) >= 2
    # a driver that died between writing a batch and noting it: the batch runs again
    for name in (f"{commits}/{done[-1]}", f"{commits}/.{done[-1]}.crc"):
        if os.path.exists(name):
            os.remove(name)
    assert load(spark, base, max_files_per_trigger=2) == Counter((i, 2, "t") for i in range(85))


def test_empty_delivery(spark, tmp_path):
    arrivals.deliver(rows(spark, [1]), F.to_date("ts"), f"{tmp_path}/in")
    arrivals.deliver(rows(spark, []), F.to_date("ts"), f"{tmp_path}/in")
    assert load(spark, str(tmp_path)) == Counter([(1, 1, "t")])
