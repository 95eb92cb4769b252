from pyspark.sql import functions as F

from zoneflow.functions import ids, temporal, text


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_normalize_text_rules(spark):
    f = text.normalize_text("x")
    assert one(spark, f, "Hello,  World! http://a.b/c x") == "hello   world    x"
    assert one(spark, f, "https://only.example.com") is None  # URL only -> '' -> null
    assert one(spark, f, "Café\tBar") == "caf \tbar"  # non-ASCII letter -> space, tab kept inside
    assert one(spark, f, None) is None


def test_normalize_genre_keeps_no_digits_no_trim(spark):
    assert one(spark, text.normalize_genre("x"), " Sci-Fi 2 ") == " sci fi   "


def test_slug_and_surrogate_key(spark):
    assert one(spark, text.slug("x"), "BBC News Top") == "bbc-news-top"
    assert one(spark, text.surrogate_key("x"), "Camp Nou") == "Camp_Nou"
    assert one(spark, text.surrogate_key("x"), None) == "unknown"


def test_ascii_only(spark):
    assert one(spark, text.ascii_only("x"), "https://ex.com/é/ü") == "https://ex.com//"


def test_combined_and_first_non_null(spark):
    df = spark.createDataFrame([("a", None, "c")], "p string, q string, r string")
    assert df.select(text.combined_text(["p", "q", "r"])).first()[0] == "a  c"
    assert df.select(text.first_non_null(["q", "r"])).first()[0] == "c"
    assert df.select(text.first_non_null(["q"])).first()[0] == ""


def test_parse_completion(spark):
    f = text.parse_completion("x")
    assert one(spark, f, "Question: old?\nctx\nQuestion:  What is it? more\nnext") == "What is it"
    assert one(spark, f, "no marker here? x") == "no marker here"


def test_iso_parse_bad_input_is_null(spark):
    df = spark.createDataFrame([("2025-05-01T10:00:00Z",), ("garbage",)], "x string")
    got = [r[0] for r in df.select(F.unix_timestamp(temporal.parse_iso("x"))).collect()]
    assert got == [1746093600, None]


def test_display_date(spark):
    df = spark.createDataFrame([(0,)], "x long")
    assert df.select(temporal.display_date(temporal.epoch_to_timestamp("x"))).first()[0] == "01 January 1970"


def test_typed_literals_and_iri(spark):
    df = spark.createDataFrame([(12.9, "true")], "x double, b string")
    r = df.select(ids.typed_literal("x", "integer"), ids.typed_literal("b", "boolean"), ids.iri("film", F.lit(3))).first()
    assert r[0] == "12" and r[1] == "true" and r[2].endswith("/resource/film_3")


def test_record_json_drops_nulls(spark):
    df = spark.createDataFrame([(1, None, "x")], "a int, b string, c string")
    assert df.select(ids.record_json(["a", "b", "c"])).first()[0] == '{"a":1,"c":"x"}'


def test_stable_hash_matches_hashlib(spark):
    import hashlib

    assert one(spark, ids.stable_hash("x"), "abc") == hashlib.sha256(b"abc").hexdigest()
