import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions import temporal
from zoneflow.operators import shape
from zoneflow.session import scratch_path
from zoneflow.sources import files, sinks


def _local(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def test_read_json_array_file_with_schema(spark):
    path = scratch_path(spark, "t-json")
    import os

    os.makedirs(_local(path))
    with open(f"{_local(path)}/batch.json", "w") as f:
        json.dump([{"id": 1, "source": {"id": None, "name": "A B"}}, {"id": 2, "source": {"id": "x", "name": "X"}}], f)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("source", T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())]))])
    df = files.read_json(spark, path, schema)
    assert df.count() == 2 and df.schema == schema
    inferred = files.read_json(spark, path)  # inference as a fallback
    assert set(inferred.columns) == {"id", "source"}


def test_extract_payload_keeps_totals(spark):
    body = json.dumps({"results": 2, "response": [{"a": 1}, {"a": 2}]})
    df = spark.createDataFrame([(body,)], "body string")
    schema = T.StructType([T.StructField("results", T.LongType()), T.StructField("response", T.ArrayType(T.StructType([T.StructField("a", T.LongType())])))])
    out = files.extract_payload(df, "body", schema, "response", keep=("results",))
    assert sorted(tuple(r) for r in out.collect()) == [(2, 1), (2, 2)]
    assert files.payload_total(df, "body", schema, "response").first()[0] == 2


def test_csv_table_file(spark):
    path = scratch_path(spark, "t-csv")
    spark.createDataFrame([(1, "Drama")], "GenreId int, Genre string").write.option("header", True).csv(path)
    df = files.read_table_file(spark, path, "csv", T.StructType([T.StructField("GenreId", T.IntegerType()), T.StructField("Genre", T.StringType())]))
    assert shape.lower_columns(df).columns == ["genreid", "genre"] and df.first()[0] == 1


def test_namespace_stats_and_reset(spark):
    recs = spark.createDataFrame([("a", "t", "news"), ("b", "t", "news"), ("c", "t", "sports")], "_id string, text_to_embed string, source string")
    assert {r.source: r.n_vectors for r in sinks.namespace_stats(recs).collect()} == {"news": 2, "sports": 1}
    empty = sinks.reset_namespace(spark, recs)
    assert empty.count() == 0 and empty.schema == recs.schema


def test_order_peek_and_stamp(spark):
    df = spark.createDataFrame([(1,), (3,), (2,)], "x int")
    assert [r.x for r in shape.order_by(df, "x", ascending=False).collect()] == [3, 2, 1]
    assert len(shape.peek(df, 2)) == 2
    as_of = dt.datetime(2025, 1, 2, 3, 4, 5)
    assert df.select(temporal.stamp(as_of)).first()[0] == as_of


def test_tsv_dictionary_gzip_roundtrip(spark):
    path = scratch_path(spark, "t-dict")
    d = spark.createDataFrame([(0, "http://e/a"), (1, "http://e/b")], "id long, label string")
    sinks.write_tsv(d, path, compression="gzip")
    back = files.read_dictionary(spark, path)
    assert sorted(tuple(r) for r in back.collect()) == [(0, "http://e/a"), (1, "http://e/b")]
    assert any(str(p).endswith(".gz") for p in __import__("pathlib").Path(_local(path)).iterdir())


def test_sports_trusted_matches_and_run_parameters(spark, sf001):
    from zoneflow.flows import sports
    from zoneflow.operators import cluster as cl
    from zoneflow.plans.flow_plans import sports_landing

    flat = sports.expand(sports_landing(spark, sf001))
    m = sports.trusted_matches(flat)
    assert "venue_id" in m.columns and "team_home_name" not in m.columns and "venue_name" not in m.columns
    assert m.where(F.col("venue_id") == "unknown").count() == flat.where(F.col("venue_name").isNull()).count()
    params = cl.run_parameters(spark, 4.0, 5, 100, 1000, 100, "random").first()
    assert params.eps == 4.0 and params.users_processed == 100 and params.sampling_method == "random"


TEXTS = ["plain", "", " both ends ", "a\\nb", "line\nbreak", "cr\rlf\r\n", "tab\there", 'quote " \\" end', "\\", "\\\\", 'x"^^<y> .', "\\t\t\\\t", "\u2028 \u0085", "z" * 50_000 + "\\n\n" * 20_000]


def test_triple_codecs_are_identities(spark):
    rows = [(f"http://e/{i}", "http://e/p", t, "literal", kind) for i, t in enumerate(TEXTS) for kind in (None, "string")]
    triples = spark.createDataFrame(rows, "subject string, predicate string, object string, object_kind string, datatype string")
    nt, tsv = scratch_path(spark, "t-nt"), scratch_path(spark, "t-tsv")
    sinks.write_ntriples(triples, nt)
    assert sorted(map(tuple, sinks.read_ntriples(spark, nt).collect()), key=str) == sorted(rows, key=str)
    sinks.write_tsv(triples.select("subject", "predicate", "object"), tsv)
    assert sorted(map(tuple, files.read_triples_tsv(spark, tsv).collect())) == sorted(r[:3] for r in rows)


def test_malformed_ntriples_raise(spark):
    path = scratch_path(spark, "t-bad-nt")
    spark.createDataFrame([("<a> <b> <c> .",), ("# note",), ("",)], "value string").write.text(path)
    assert sinks.read_ntriples(spark, path).count() == 1
    spark.createDataFrame([("<a> <b> c .",)], "value string").write.mode("append").text(path)
    with pytest.raises(Exception, match="not a triple"):
        sinks.read_ntriples(spark, path).collect()
