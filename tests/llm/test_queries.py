"""The corpus queries against their SQL, and the pipeline against its operators' outputs."""

import hashlib
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from zoneflow.llm import bpe, decontam, jaccard, queries  # noqa: E402
from zoneflow.plans import oracle_check  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    found = oracle_check.compare(spark, name, queries.QUERIES[name], queries.ORACLE[name], SMALL)
    assert found["status"] == "match", found


def test_entry_has_every_corpus_query():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {x.split("_")[0] for x in names} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


def test_pipeline_stages(spark, tmp_path):
    docs = queries.table(spark, SMALL, "documents")
    columns = docs.columns
    kept = {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        kept[name] = {r.doc_id for r in out.select("doc_id").collect()}
        assert kept[name] <= before
        if name == "jaccard_join":
            groups = {r.doc_id: r.component_id for r in jaccard.similar_groups(docs).collect()}
            assert kept[name] == {i for i, g in groups.items() if i == g}
        if name == "decontamination":
            found = decontam.contamination(docs, queries.table(spark, SMALL, "benchmark"))
            assert kept[name] == {r.doc_id for r in found.where(~F.col("contaminated")).collect()}
        if name != "byte_bpe":
            assert out.columns == columns
            docs = out
    assert kept["byte_bpe"] == kept["decontamination"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        assert r.decoded_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, out.collect()))
    assert bpe.load_ranks(queries.BPE_RANKS)
