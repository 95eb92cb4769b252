from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.operators import quality, shape


def test_merge_elements_respects_order_not_scan_order(spark):
    # Q8: for column v ascending order asks for o=2, even though o=3 comes first in the data.
    rows = [("k", 3, "c3"), ("k", 2, "c2"), ("k", 1, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = quality.merge_elements(df.repartition(3), ["k"], ["o"]).first()
    assert out["v"] == "c2" and out["o"] == 1
    desc = quality.merge_elements(df, ["k"], ["o"], desc=True).first()
    assert desc["v"] == "c3" and desc["o"] == 3


def test_merge_elements_unique_keys_and_partition_invariant(spark, sf001):
    ev = spark.read.parquet(f"{sf001}/events.parquet").select(
        "user_id", "ts", F.nullif(F.col("event_type"), F.lit("click")).alias("t")
    )
    a = quality.merge_elements(ev, ["user_id"], ["ts"]).collect()
    b = quality.merge_elements(ev.repartition(7, "ts"), ["user_id"], ["ts"]).collect()
    assert sorted(a) == sorted(b)
    assert len({r.user_id for r in a}) == len(a)


def test_first_row_per_key_total_order(spark):
    df = spark.createDataFrame([("a", 1, "z"), ("a", 1, "b"), ("b", 5, "q")], "k string, o int, x string")
    got = {r.k: r.x for r in quality.first_row_per_key(df, "k", "o").collect()}
    assert got == {"a": "b", "b": "q"}


def test_dedupe_observation(spark):
    obs = Observation("dedupe")
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "i int, s string")
    out = quality.dedupe(df, metrics=obs)
    assert out.count() == 2 and obs.get["rows_in"] == 3


def test_null_percentage_empty_is_null(spark):
    empty = spark.createDataFrame([], "a int, b string")
    r = quality.null_percentage(empty).first()
    assert r["n_rows"] == 0 and r["null_pct"] is None
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert quality.null_percentage(df).first()["null_pct"] == 50.0


def test_country_codes_rules(spark):
    rows = [
        ("World", None, "w.svg"),
        ("Spain", "ES", "es.svg"),
        ("Nowhere", None, "n.svg"),
        ("England", "GB", "gb-eng.svg"),
        ("Wales", "GB", "gb-wls.svg"),
        (None, None, None),
    ]
    df = spark.createDataFrame(rows, "name string, code string, flag string")
    got = {r.country_name: r.country_code for r in quality.country_codes(df, "name", "code", "flag").collect()}
    assert got == {"world": "wrd", "spain": "es", "nowhere": "nowhere", "england": "gb-england", "wales": "gb-wales"}


def test_duplicated_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert [tuple(r) for r in quality.duplicated_keys(df, "k").collect()] == [(1, 2)]


def test_conform_typed_defaults(spark):
    # Q7: missing string gets null (not 0), numeric 0, timestamp now.
    schema = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("title", T.StringType()),
         T.StructField("runtime", T.IntegerType()), T.StructField("ingestion_time", T.TimestampType())]
    )
    df = spark.createDataFrame([("7",)], "ID string")
    out = shape.conform(shape.lower_columns(df), schema).first()
    assert out["id"] == 7 and out["title"] is None and out["runtime"] == 0 and out["ingestion_time"] is not None
    a = shape.conform(shape.lower_columns(df), schema)
    assert a.unionByName(a).count() == 2  # types line up (the int-default string would fail under ANSI)


def test_rename_present_and_fallback(spark):
    df = spark.createDataFrame([(1, 2)], "id int, genreid int")
    out = shape.rename_present(df, {"filmid": "film_id", "genreid": "genre_id"}, fallback={"id": "film_id"})
    assert out.columns == ["film_id", "genre_id"]


def test_repair_struct_and_flatten(spark):
    df = spark.createDataFrame([((None, "BBC News"),), (("cnn", "CNN"),)], "source struct<id:string,name:string>")
    ids = sorted(r[0] for r in shape.struct_to_field(shape.repair_struct_id(df, "source"), "source").collect())
    assert ids == ["bbc-news", "cnn"]
    nested = spark.createDataFrame([((1, (2, 3)),)], "f struct<id:int,p:struct<first:int,second:int>>")
    flat = shape.flatten(nested, {"fixture_id": "f.id", "period_first": "f.p.first"})
    assert flat.columns == ["fixture_id", "period_first"] and tuple(flat.first()) == (1, 2)


def test_union_roles_single_scan(spark):
    df = spark.createDataFrame([(1, "a", 2, "b")], "h_id int, h_name string, a_id int, a_name string")
    out = shape.union_roles(df, [{"team_id": "h_id", "team_name": "h_name"}, {"team_id": "a_id", "team_name": "a_name"}])
    assert sorted(map(tuple, out.collect())) == [(1, "a"), (2, "b")]


def test_prepare_records_registry(spark):
    df = spark.createDataFrame([(1, None, "t", "2024-01-01"), (2, None, None, "2024-01-02")], "k int, a string, b string, d string")
    recs, reg = shape.prepare_records(df, "k", ["a", "b"], "news", date_col="d", key_prefix="news_")
    assert [tuple(r) for r in recs.collect()] == [("news_1", "t", "news")]
    assert reg.count() == 2
