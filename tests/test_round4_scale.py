"""Disk of the triples' round trip: finding F1 of round 4."""

from __future__ import annotations

import os
import re
import time

import pytest

from zoneflow.plans import graph_plans
from zoneflow.session import scratch_path, shuffles_dropped
from zoneflow.sources import files, sinks

TRIPLE = "subject string, predicate string, object string, object_kind string, datatype string"


def _files(path):
    return [f for f in os.listdir(path.removeprefix("file:")) if f.startswith("part-")]


@pytest.fixture
def tables(spark, tmp_path):
    for name, sql in {
        "nation": "SELECT CAST(id AS INT) AS n_nationkey, concat('Land ', id) AS n_name FROM range(5)",
        "customer": "SELECT id % 40 AS c_custkey, IF(id = 7, NULL, concat('a\\\\t \"', id % 40)) AS c_name, CAST(id % 5 AS INT) AS c_nationkey FROM range(60)",
        "part": "SELECT id AS p_partkey, concat('> ring', id) AS p_name, 'Brand#1' AS p_brand, concat('T', id % 3) AS p_type, CAST(id AS INT) AS p_size, id * 1.5D AS p_retailprice FROM range(50)",
        "orders": """SELECT IF(id = 9, NULL, id) AS o_orderkey, IF(id % 2 = 0, 'F', 'O') AS o_orderstatus, concat(id % 5 + 1, '-LOW') AS o_orderpriority,
                  TIMESTAMP_NTZ '1995-05-25 00:00:00' AS o_orderdate FROM range(80)""",
    }.items():
        spark.sql(sql).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_round_trip_keeps_little_on_disk(spark, tables, monkeypatch):
    paths = {}
    monkeypatch.setattr(graph_plans, "scratch_path", lambda s, name: paths.setdefault(name, scratch_path(s, name)))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = graph_plans.ntriples_roundtrip(spark, tables)
        plan = out._jdf.queryExecution().executedPlan().toString()
        rows = sorted(map(tuple, out.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert rows == sorted(map(tuple, graph_plans.kg_triples(spark, tables).collect()), key=repr) and len(rows) > 400
    for path in paths.values():
        assert _files(path) and all(f.endswith(".gz") for f in _files(path))
    # one shuffle a side, made before the join's hash: nothing below it computes or carries that column
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    below = [line for line in plan.splitlines() if "xxhash64" in line]
    assert len(below) == 4 and all(("AS key" in line) != ("Exchange" in line) for line in below)


def test_compressed_files_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_LINES", 3)
    rows = [(f"http://e/{i}", "http://e/p", f"line\n\t\\{i} ", "literal", "string" if i % 2 else None) for i in range(10)]
    triples = spark.createDataFrame(rows, TRIPLE).coalesce(1)
    nt, tsv = scratch_path(spark, "t-nt-gz"), scratch_path(spark, "t-tsv-gz")
    sinks.write_ntriples(triples, nt, compression="gzip")
    sinks.write_tsv(triples.select("subject", "predicate", "object"), tsv, compression="gzip")
    assert len(_files(nt)) == len(_files(tsv)) == 4
    assert sorted(map(tuple, sinks.read_ntriples(spark, nt).collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(map(tuple, files.read_triples_tsv(spark, tsv).collect())) == sorted(r[:3] for r in rows)


@pytest.mark.parametrize("set_before", [None, "false"])
def test_shuffles_are_dropped_as_a_write_ends(spark, set_before):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    dirs = [str(d) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    shuffles = lambda: {f for top in dirs for _, _, names in os.walk(top) for f in names if f.endswith(".data") and f.startswith("shuffle_")}
    write = lambda path: spark.range(1000).repartition(3).write.parquet(path) or path
    if set_before:
        spark.conf.set(key, set_before)
    try:
        old = shuffles()
        write(scratch_path(spark, "t-kept"))
        kept = shuffles() - old
        with pytest.raises(ZeroDivisionError), shuffles_dropped(spark):
            path = write(scratch_path(spark, "t-dropped"))
            raise ZeroDivisionError
        assert spark.conf.get(key, None) == set_before
    finally:
        spark.conf.unset(key)
    for _ in range(100):  # Spark deletes them in the background
        if not (left := shuffles() - old - kept):
            break
        time.sleep(0.1)
    assert kept and not left and spark.read.parquet(path).count() == 1000
