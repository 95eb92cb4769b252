"""Work that is done once, and regexes that cost little: findings F8, F10 and F12."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from zoneflow.functions import text
from zoneflow.plans import flow_plans
from zoneflow.session import scratch_path
from zoneflow.sources import sinks


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ntriples_line_is_matched_for_all_parts_at_once(spark):
    texts = ["a>b<c", 'x" .', '"^^<http://e/t>', "back\\n\\\\", "tab\there", "line\nbreak\r", "", "> <", "\u2028"]
    rows = [(f"http://e/{i}", "http://e/p", t, "literal", "string" if i % 2 else None) for i, t in enumerate(texts)] + [("http://e/s", "http://e/q", "http://e/o", "iri", None)]
    path = scratch_path(spark, "t-nt-once")
    sinks.write_ntriples(spark.createDataFrame(rows, "subject string, predicate string, object string, object_kind string, datatype string"), path)
    back = sinks.read_ntriples(spark, path)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(rows, key=repr)
    assert "regexp_extract" not in _plan(back)


def test_cleaning_rule_is_one_lookup_a_character(spark):
    every = "".join(chr(c) for c in [*range(1, 0x250), 0x2028, 0x212A, 0x4E2D, 0xFF21, 0x1F600, 0x10FFFF])
    out = spark.range(1).select(F.regexp_replace(F.lit(every), text.NON_ALNUM_SPACE, " "), F.regexp_replace(F.lit(every), text.NON_ALPHA_SPACE, " ")).first()
    assert list(out) == [re.sub(p, " ", every, flags=re.ASCII) for p in (r"[^a-zA-Z0-9\s]", r"[^a-zA-Z\s]")]
    assert "a-z" not in text.NON_ALNUM_SPACE + text.NON_ALPHA_SPACE


def test_match_facts_are_made_once(spark, tmp_path, monkeypatch):
    spark.sql(
        """SELECT id AS o_orderkey, id % 7 AS o_custkey, IF(id % 2 = 0, 'F', 'O') AS o_orderstatus, id * 10.5D AS o_totalprice,
           TIMESTAMP_NTZ '1995-05-25 00:00:00' + make_interval(0, 0, 0, CAST(id AS INT)) AS o_orderdate FROM range(1, 20)"""
    ).write.parquet(str(tmp_path / "orders.parquet"))
    plans, write = {}, flow_plans.materialize
    monkeypatch.setattr(flow_plans, "materialize", lambda s, df, name: plans.setdefault(name, _plan(df)) and write(s, df, name))
    assert flow_plans.sports_matches_trusted(spark, str(tmp_path)).count() == 19
    assert "o_orderkey" in plans["matches-facts"] and "o_orderkey" not in plans["matches"]
