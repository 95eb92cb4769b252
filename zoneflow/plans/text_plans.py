"""Text queries: corpus keywords, keyword tagging, text vectors, retrieval
prompts and completion parsing (M1-M3, M6, J9, F11, F19-F22, A12, A13, W4, T3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.functions import stopwords, text
from zoneflow.operators import text as tx
from zoneflow.operators import vectors as vx
from zoneflow.plans.registry import register, table
from zoneflow.session import materialize, spread

TOP_N = 15

_NORM_SQL = (
    r"nullif(trim(regexp_replace(regexp_replace(regexp_replace(lower(text), 'http\S+|www\.\S+', ' ', 'g'),"
    r" '[^a-zA-Z0-9\s]', ' ', 'g'), '[^\x00-\x7F]', '', 'g')), '')"
)

KEYWORDS_CTE = (
    """
docs AS (SELECT doc_id, lang, """
    + _NORM_SQL
    + r""" AS norm FROM documents),
n AS (SELECT lang, count(*) AS n FROM docs GROUP BY lang),
stop(w) AS (VALUES """
    + stopwords.values_sql()
    + r"""),
tok AS (SELECT doc_id, lang, unnest(regexp_extract_all(lower(coalesce(norm, '')), '\b\w\w+\b')) AS term FROM docs),
ftok AS (SELECT * FROM tok WHERE term NOT IN (SELECT w FROM stop)),
tf AS (SELECT lang, doc_id, term, count(*) AS tf FROM ftok GROUP BY lang, doc_id, term),
stats AS (SELECT lang, term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY lang, term),
vocab AS (SELECT lang, term, df FROM stats QUALIFY row_number() OVER (PARTITION BY lang ORDER BY total DESC, term) <= 5000),
scored AS (SELECT tf.lang, tf.doc_id, tf.term, tf.tf * (ln((1.0 + n.n) / (1.0 + v.df)) + 1.0) AS score
           FROM tf JOIN vocab v ON v.lang = tf.lang AND v.term = tf.term JOIN n ON n.lang = tf.lang),
top3 AS (SELECT * FROM scored WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY lang, doc_id ORDER BY score DESC, term) <= 3),
kw AS (SELECT lang, term, count(*) AS n_docs FROM top3 GROUP BY lang, term),
keywords AS (SELECT lang, term, n_docs, rank FROM (
   SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n_docs DESC, term) AS rank FROM kw) WHERE rank <= 15)
"""
)


def _norm_docs(spark, d):
    # spread: the text scan may be a single row group; normalization is CPU-bound.
    return spread(table(spark, d, "documents")).select("doc_id", "lang", text.normalize_text("text").alias("norm"))


def _keywords(spark, d, docs=None):
    docs = docs if docs is not None else _norm_docs(spark, d)
    # Normalized text is already lower-case.
    return tx.corpus_keywords(docs, "doc_id", ["norm"], top_n=TOP_N, group_cols=["lang"], lowercase=False)


register("corpus_keywords", "WITH " + KEYWORDS_CTE + "SELECT * FROM keywords")(_keywords)


@register(
    "keyword_tagging",
    "WITH "
    + KEYWORDS_CTE
    + """
SELECT d.doc_id, k.term AS keyword FROM docs d JOIN keywords k ON k.lang = d.lang AND contains(lower(d.norm), k.term)
""",
)
def keyword_tagging(spark, d):
    """Documents tagged with their language's corpus keywords."""
    docs = materialize(spark, _norm_docs(spark, d), "normalized")  # normalized once, for the keywords and the tags
    return tx.tag_documents(docs, "doc_id", "norm", _keywords(spark, d, docs), "term", on=["lang"], lowercase=False)


@register("text_vectors")
def text_vectors(spark, d):
    """M3: hashed TF-IDF vectors of every document (rows-only check)."""
    return tx.text_vectors(table(spark, d, "documents"), "doc_id", "text")


@register(
    "completion_parse",
    """
SELECT conv_id, turn,
       trim(split_part(split_part(string_split(completion, 'Question:')[-1], chr(10), 1), '?', 1)) AS question
FROM (SELECT conv_id, turn,
             'Question: draft?' || chr(10) || 'Context: ' || role || chr(10) || 'Question: ' || text AS completion
      FROM conversations)
""",
)
def completion_parse(spark, d):
    """model completions (synthesised from every turn's full text) cut
    to the generated question."""
    conv = table(spark, d, "conversations")
    completion = F.concat(F.lit("Question: draft?\nContext: "), F.col("role"), F.lit("\nQuestion: "), F.col("text"))
    return conv.select("conv_id", "turn", text.parse_completion(completion).alias("question"))


PROMPT_PARTS = ("Read this passage: \"", "\"\nAsk one question a curious reader would have about it.\nQuestion:")


@register(
    "interest_prompts",
    """
WITH q AS (SELECT vec_id AS interest_id, embedding AS qv FROM embeddings WHERE vec_id % 50 = 0),
idx AS (SELECT e.vec_id, e.embedding, d.text FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id),
scored AS (
  SELECT q.interest_id, idx.vec_id, idx.text,
         round(list_sum(list_transform(range(1, len(qv) + 1), lambda i: CAST(qv[i] AS DOUBLE) * CAST(idx.embedding[i] AS DOUBLE)))
               / (sqrt(list_sum(list_transform(range(1, len(qv) + 1), lambda i: CAST(idx.embedding[i] AS DOUBLE) * CAST(idx.embedding[i] AS DOUBLE))))
                  * sqrt(list_sum(list_transform(range(1, len(qv) + 1), lambda i: CAST(qv[i] AS DOUBLE) * CAST(qv[i] AS DOUBLE))))), 6) AS score
  FROM idx CROSS JOIN q WHERE idx.vec_id <> q.interest_id)
SELECT interest_id, vec_id AS hit_id, score,
       'Read this passage: "' || text || '"' || chr(10) || 'Ask one question a curious reader would have about it.' || chr(10) || 'Question:' AS prompt
FROM scored QUALIFY row_number() OVER (PARTITION BY interest_id ORDER BY score DESC, vec_id) = 1
""",
)
def interest_prompts(spark, d):
    """Every interest whose id is divisible by 50 -> best other hit (k = 1)
    among the vectors that have a document -> prompt around the hit's full text."""
    emb = table(spark, d, "embeddings")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("vec_id"), "text")
    index = emb.join(docs, "vec_id")
    interests = emb.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("interest_id"), F.col("embedding").alias("query_vec"))
    hits = vx.search(index.select("vec_id", "embedding"), interests, k=1, id_col="vec_id", query_id_col="interest_id", exclude_self=True)
    with_text = hits.join(docs, "vec_id")
    return with_text.select(
        "interest_id",
        F.col("vec_id").alias("hit_id"),
        "score",
        text.prompt([PROMPT_PARTS[0], F.col("text"), PROMPT_PARTS[1]]).alias("prompt"),
    )
