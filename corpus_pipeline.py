"""The corpus job: clean documents to token digests, stage by stage.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``.  All but the last return the columns of ``docs``.  Each stage
works on every row that its predecessor kept.  No stage but the third and
fourth has an SQL form, so ``ORACLE_SQL`` is None and tests compare the stages
with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import bpe, decontam, jaccard, quality, toxicity
from zoneflow.llm.common import held_out
from zoneflow.llm.queries import BPE_RANKS, table, without_labels
from zoneflow.session import scratch_path

ORACLE_SQL = None
KEY = "near_copy_key__"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject; it learns from the labelled rows that may train."""
    marked = docs.withColumn("held_out", held_out("doc_id", 5, 0))
    model = toxicity.fit(marked.where(~F.col("held_out")), without_labels(table(spark, sf_dir, "labels"), 5, 0))
    scored = toxicity.score(docs, model, keep=tuple(c for c in docs.columns if c != "doc_id"))
    return scored.where("predicted = 0").select(*docs.columns)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    marked = docs.withColumn("held_out", held_out("doc_id", 3, 1))
    model = quality.fit(marked.where(~F.col("held_out")), without_labels(table(spark, sf_dir, "labels"), 3, 1))
    scored = quality.score(docs, model, keep=tuple(c for c in docs.columns if c != "doc_id"))
    return scored.where("predicted = 1").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that of the smallest id (null only if there is no other).

    Rows are told apart by id and text, so ids may repeat or be null.  Texts
    without a shingle belong to no group and stay.
    """
    keyed = docs.withColumn(KEY, F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text")))
    groups = jaccard.similar_groups(keyed, id_column=KEY).where("n_shingles > 0")
    lost = groups.where(F.col(KEY) != F.col("component_id")).select(KEY).distinct()
    repeated = groups.where(F.col(KEY) == F.col("component_id")).groupBy(KEY).count().where("count > 1").select(KEY)
    kept = keyed.join(lost, KEY, "left_anti")
    once = kept.join(repeated, KEY, "left_semi").dropDuplicates([KEY])
    return kept.join(repeated, KEY, "left_anti").unionByName(once).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go."""
    return decontam.without_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each document's token ids and of the bytes they decode to."""
    return bpe.decode(bpe.encode(docs, BPE_RANKS, public_tokenizers.PATTERN), BPE_RANKS, digests=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("byte_bpe", tokenize),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are a table in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
