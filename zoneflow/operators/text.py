"""Corpus keywords (M1), keyword tagging (M2/J9) and text vectors (M3).

M1 re-expresses "TF-IDF over the collected texts, top-3 terms per document,
most common n" as distributed aggregations: tokens are exploded from whole
texts, term frequencies / document frequencies are grouped with partial
aggregation, the vocabulary cap and every top-k are window ranks with a
``<= k`` filter (Spark plans these with a per-partition group limit before
the shuffle).  Nothing is collected to the driver.

Conventions (documented deviations from a single-machine vectorizer):
Spark's English stop words; idf = ln((1 + N) / (1 + df)) + 1 (smooth idf);
vocabulary = the ``max_features`` terms with the largest corpus count, ties
by term; the per-document L2 norm is skipped because it does not change the
in-document ranking; zero scores never count (Q19); all ties by term.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF, IDF, Normalizer, RegexTokenizer, StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.functions import stopwords
from zoneflow.functions.text import TOKEN_PATTERN, combined_text
from zoneflow.session import materialize


def _rank_le(df: DataFrame, part: Sequence[str], order: Sequence, k: int, name: str = "rank") -> DataFrame:
    w = Window.partitionBy(*part).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)


def doc_terms(
    docs: DataFrame, id_col: str, text_cols: Sequence, group_cols: Sequence[str] = (), lowercase: bool = True
) -> DataFrame:
    """(group..., doc, term, tf) over the combined, tokenized text (F11 + F20).

    Stop words are removed by a broadcast anti-join against the fixed list
    (a hash probe per token, JVM-side), and ``explode_outer`` + an explicit
    null filter keeps the optimizer from re-evaluating the tokenizer in an
    inferred pre-filter."""
    combined = combined_text(text_cols)
    if lowercase:
        combined = F.lower(combined)
    tokens = docs.select(
        *group_cols,
        F.col(id_col).alias("doc"),
        F.explode_outer(F.regexp_extract_all(combined, F.lit(TOKEN_PATTERN), 0)).alias("term"),
    ).where(F.col("term").isNotNull())
    stop = F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in stopwords.ENGLISH], "term string"))
    kept = tokens.join(stop, "term", "left_anti")
    return kept.groupBy(*group_cols, "doc", "term").agg(F.count(F.lit(1)).alias("tf"))


def corpus_keywords(
    docs: DataFrame,
    id_col: str,
    text_cols: Sequence,
    top_n: int = 10,
    group_cols: Sequence[str] = (),
    max_features: int = 5000,
    per_doc: int = 3,
    score_digits: int | None = None,
    lowercase: bool = True,
    materialize_as: str | None = "tf",
) -> DataFrame:
    """M1: per group, the ``top_n`` terms most often among the ``per_doc``
    best TF-IDF terms of a document -> (group..., term, n_docs, rank)."""
    g = list(group_cols)
    tf = doc_terms(docs, id_col, text_cols, g, lowercase)
    if materialize_as:
        # tf feeds both the corpus statistics and the scoring: write it once.
        tf = materialize(docs.sparkSession, tf, materialize_as)
    n_docs = docs.groupBy(*g).agg(F.count(F.lit(1)).alias("N")) if g else docs.agg(F.count(F.lit(1)).alias("N"))
    stats = tf.groupBy(*g, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    vocab = _rank_le(stats, g, [F.desc("total"), F.asc("term")], max_features, "__vr").drop("__vr", "total")
    # The vocabulary (at most max_features rows per group) is written first:
    # its size is then known, and Spark broadcasts it below its threshold.
    vocab = materialize(docs.sparkSession, vocab, "vocabulary")
    n_docs = materialize(docs.sparkSession, n_docs, "group-sizes")
    scored = tf.join(vocab, [*g, "term"])
    scored = scored.join(n_docs, g) if g else scored.crossJoin(F.broadcast(n_docs))
    idf = F.log((F.lit(1.0) + F.col("N")) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)
    score = F.col("tf") * idf
    if score_digits is not None:
        score = F.round(score, score_digits)
    scored = scored.select(*g, "doc", "term", score.alias("score")).where(F.col("score") > 0)
    top = _rank_le(scored, [*g, "doc"], [F.desc("score"), F.asc("term")], per_doc, "__dr")
    counts = top.groupBy(*g, "term").agg(F.count(F.lit(1)).alias("n_docs"))
    ranked = _rank_le(counts, g, [F.desc("n_docs"), F.asc("term")], top_n)
    return ranked.select(*g, "term", "n_docs", F.col("rank").cast("bigint").alias("rank"))


def tag_documents(
    docs: DataFrame,
    id_col: str,
    text_col,
    keywords: DataFrame,
    keyword_col: str = "term",
    on: Sequence[str] = (),
    lowercase: bool = True,
) -> DataFrame:
    """(doc, keyword) for every keyword that is a substring of
    the lower-cased text.  The keyword list is written first, so that Spark
    knows its size and broadcasts it below its threshold (top-n lists are far
    below); ``on`` adds equi-keys (e.g. the category) to the join."""
    kw = materialize(docs.sparkSession, keywords.select(*on, F.col(keyword_col).alias("__kw")), "keywords")
    body = F.col(text_col) if isinstance(text_col, str) else text_col
    d = docs.select(*on, F.col(id_col).alias("__doc"), (F.lower(body) if lowercase else body).alias("__text"))
    cond = [d[c] == kw[c] for c in on] + [F.contains(d["__text"], kw["__kw"])]
    cond_all = cond[0]
    for c in cond[1:]:
        cond_all = cond_all & c
    return d.join(kw, cond_all).select(F.col("__doc").alias(id_col), F.col("__kw").alias("keyword"))


def text_vectors(docs: DataFrame, id_col: str, text_col: str, num_features: int = 1 << 18) -> DataFrame:
    """M3: hashed TF -> IDF -> L2 normalised sparse vectors (MLlib, JVM-side).
    The IDF fit is one aggregation whose result is bounded by num_features."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="__tok", pattern=TOKEN_PATTERN, gaps=False, toLowercase=True)
    sw = StopWordsRemover(inputCol="__tok", outputCol="__terms", stopWords=stopwords.ENGLISH)
    tf = HashingTF(inputCol="__terms", outputCol="__tf", numFeatures=num_features)
    staged = tf.transform(sw.transform(tok.transform(docs.select(id_col, text_col))))
    idf = IDF(inputCol="__tf", outputCol="__tfidf").fit(staged)
    out = Normalizer(inputCol="__tfidf", outputCol="features", p=2.0).transform(idf.transform(staged))
    return out.select(id_col, "features")
