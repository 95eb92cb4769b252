"""Schema evolution, stage counts, two-output records, the batched sink and PCA."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators import cluster as cl
from zoneflow.operators import evolve, quality, shape
from zoneflow.sources import sinks


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "smallint", "bigint"),
        ("int", "float", "double"),
        ("float", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"),
        ("void", "string", "string"),
        ("array<int>", "array<bigint>", "array<bigint>"),
        ("struct<a:int>", "struct<b:string,a:bigint>", "struct<a:bigint,b:string>"),
        ("array<struct<a:int>>", "array<struct<b:date>>", "array<struct<a:int,b:date>>"),
        ("bigint", "double", None),  # a bigint may not fit a double
        ("string", "int", None),
        ("struct<a:int>", "array<int>", None),
        ("struct<a:int>", "struct<a:string>", None),
        ("boolean", "int", None),
        ("decimal(10,2)", "decimal(12,2)", None),
    ],
)
def test_type_lattice(spark, a, b, expected):
    kind = lambda t: spark.createDataFrame([], f"x {t}").schema["x"].dataType
    for one, two in ((a, b), (b, a)):
        if expected is None:
            with pytest.raises(evolve.SchemaConflict):
                evolve.join_types(kind(one), kind(two), "x")
        else:
            got = evolve.join_types(kind(one), kind(two), "x")
            same = lambda t: sorted(t.simpleString().replace("<", ",").replace(">", ",").split(","))
            assert same(got) == same(kind(expected))


def test_appended_batches_read_as_one(spark, tmp_path):
    table = evolve.EvolvingTable(spark, str(tmp_path / "t"))
    assert table.schema() is None
    table.append(spark.createDataFrame([(1, 2, [(1,)])], "id int, n smallint, deep array<struct<a:int>>"))
    table.append(spark.createDataFrame([(2**40, 3.5, "new", [(2**40, "b"), None])], "id bigint, n float, extra string, deep array<struct<a:bigint,b:string>>"))
    table.append(spark.createDataFrame([(None, 4)], "deep array<struct<a:int>>, id tinyint"))
    before = table.read().count()
    for bad in ("id string", "deep struct<a:int>", "n bigint"):
        with pytest.raises(evolve.SchemaConflict):
            table.append(spark.createDataFrame([], bad))
    got = {r.id: (r.n, r.extra, None if r.deep is None else [x and (x.a, x.b) for x in r.deep]) for r in table.read().collect()}
    assert got == {1: (2.0, None, [(1, None)]), 2**40: (3.5, "new", [(2**40, "b"), None]), 4: (None, None, None)}
    assert table.read().count() == before == 3
    assert table.append(spark.createDataFrame([], "id int")) == table.schema()


def test_counts_are_taken_while_stages_run(spark):
    df = spark.createDataFrame([(i % 10, "x") for i in range(100)], "a int, b string")
    stages = [("distinct", quality.dedupe), ("none", lambda d: d.where("a > 100")), ("empty", lambda d: d.where("a > 0"))]
    out, counts = quality.counted_stages(spark, df, stages)
    assert out.count() == 0
    assert [tuple(r) for r in counts.orderBy("place").collect()] == [("distinct", 0, 100, 10, 90, 0), ("none", 1, 10, 0, 10, 0), ("empty", 2, 0, 0, 0, 0)]


def test_records_and_registry_of_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(1, "t", None, "2024-01-01"), (2, None, "u", None), (3, "", "v", "2024-01-03"), (None, "w", None, None), (3, "", "v", "2024-01-03")], "id long, a string, b string, day string")
    records, registry = shape.write_records(df.withColumn("day", F.to_date("day")).withColumn("kind", F.lit("clash")), str(tmp_path / "r"), "id", ["a", "b"], "src", "day", "p_")
    assert Counter(map(tuple, records.collect())) == Counter([("p_1", "t", "src"), ("p_2", "u", "src"), (None, "w", "src")])
    assert Counter((r.id, str(r.day)) for r in registry.collect()) == Counter([("1", "2024-01-01"), ("2", "None"), ("3", "2024-01-03"), ("3", "2024-01-03"), (None, "None")])
    assert isinstance(registry.schema["day"].dataType, T.DateType)


def test_sink_retries_alone_and_reports_every_record(spark):
    class Flaky:
        """A service that refuses some records, and every request that holds one."""

        def upsert(self, records):
            assert 0 < len(records) <= 95
            if any(r["_id"].endswith("7") for r in records):
                raise RuntimeError(f"refused among {len(records)}")
            assert all(v is not None and v == v for r in records for v in r.values())  # nulls and NaN are not sent

    rows = [(f"d{i}", None if i % 3 else "text", float("nan") if i % 5 else 1.0) for i in range(1000)]
    out = sinks.batched_upsert(spark.createDataFrame(rows, "_id string, text string, weight double").repartition(3), Flaky).collect()
    assert Counter(r._id for r in out) == Counter(r[0] for r in rows)
    assert {r._id for r in out if r.status == "failed"} == {f"d{i}" for i in range(1000) if i % 10 == 7}
    assert all((r.error is None) == (r.status == "sent") for r in out)
    assert {r.error for r in out if r.error} == {"RuntimeError('refused among 1')"}


def test_principal_components_up_to_their_signs(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 6)) @ np.diag([5, 3, 2, 1, 0.5, 0.1]) @ np.linalg.qr(rng.normal(size=(6, 6)))[0]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    z = (x - x.mean(0)) / x.std(0)
    _, s, axes = np.linalg.svd(z, full_matrices=False)
    rows = {r.vec_id: r.reduced for r in cl.reduce_dims(df, "embedding", 3).collect()}
    got = np.array([rows[i] for i in range(200)])
    np.testing.assert_allclose(np.abs(got), np.abs(z @ axes[:3].T), atol=1e-8)
    np.testing.assert_allclose((got**2).sum(0), s[:3] ** 2)  # explained variance, falling
    # what the first three leave out is what the others explain
    left = z - got @ (np.sign((got * (z @ axes[:3].T)).sum(0))[:, None] * axes[:3])
    assert (left**2).sum() == pytest.approx((s[3:] ** 2).sum())
