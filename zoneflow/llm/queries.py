"""The queries of this package: name -> (Spark builder, DuckDB SQL or None).

Each query applies its operator, with production parameters, to its whole
table and derives the digest columns from the operator's outputs.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zoneflow.llm import bpe, chat, decontam, jaccard, langid, lexical, lm, packing, quality, repair, topk, toxicity, urlgraph
from zoneflow.llm.common import held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_labels(labels: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """The label rows that may train."""
    return labels.where(~held_out("doc_id", modulus, remainder))


@_register("op1_language_id")
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 4, 2))
    fitted = langid.fit(docs.where(~F.col("held_out") & F.col("lang").isNotNull()))
    return langid.predict(docs, fitted, keep=("held_out",))


OP2_SQL = """
WITH sound AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))) IS NOT FALSE
  GROUP BY vec_id
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM sound q JOIN sound c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_register("op2_exact_topk", OP2_SQL)
def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@_register("op3_quality")
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 3, 1))
    model = quality.fit(docs.where(~F.col("held_out")), without_labels(table(spark, sf_dir, "labels"), 3, 1))
    return quality.score(docs, model, keep=("held_out",))


URL_RULES = [
    urlgraph.Rule("allow", "com", "/"),
    urlgraph.Rule("block", "example.com", "/en/"),
    urlgraph.Rule("allow", "www.example.com", "/en/"),
    urlgraph.Rule("block", "net", "/es/"),
    urlgraph.Rule("block", "net", "/fr/"),
]


def _url_sql(rules: list[urlgraph.Rule], rounds: int = 12, damping: float = 0.6, threshold: float = 0.5) -> str:
    """The rounds of the spread as one table expression each."""
    fits = " UNION ALL ".join(f"SELECT '{r.action}' AS action, '{r.host}' AS r_host, '{r.path}' AS r_path" for r in rules)
    steps = "".join(
        f"""
, r{k} AS (
  SELECT b.host, {1 - damping} * b.t0 + {damping} * coalesce(f.t, 0) AS t, {1 - damping} * b.d0 + {damping} * coalesce(g.d, 0) AS d
  FROM base b
  LEFT JOIN (SELECT s.target AS host, sum(r.t * s.forward) AS t FROM shares s JOIN r{k - 1} r ON r.host = s.source GROUP BY 1) f ON f.host = b.host
  LEFT JOIN (SELECT s.source AS host, sum(r.d * s.backward) AS d FROM shares s JOIN r{k - 1} r ON r.host = s.target GROUP BY 1) g ON g.host = b.host
)"""
        for k in range(1, rounds + 1)
    )
    link = urlgraph.LINK.replace("'", "''")
    return f"""
WITH rules AS ({fits}), parsed AS (
  SELECT row_number() OVER () AS n, page_id, html,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{urlgraph.UPPER}', '{urlgraph.LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), fitting AS (
  SELECT p.n, arg_max(r.r_host || r.r_path, length(r.r_host || r.r_path)) AS rule, arg_max(r.action, length(r.r_host || r.r_path)) AS action
  FROM parsed p JOIN rules r ON (p.host = r.r_host OR ends_with(p.host, '.' || r.r_host)) AND starts_with(p.path, r.r_path) GROUP BY p.n
), judged AS (
  SELECT p.*, f.rule, f.action FROM parsed p LEFT JOIN fitting f USING (n)
), links AS (
  SELECT host AS source, translate(unnest(regexp_extract_all(html, '{link}', 1)), '{urlgraph.UPPER}', '{urlgraph.LOWER}') AS target FROM parsed
), edges AS (
  SELECT source, target, count(*) AS links FROM links WHERE source <> target AND source <> '' GROUP BY 1, 2
), shares AS (
  SELECT source, target, links / sum(links) OVER (PARTITION BY source) AS forward, links / sum(links) OVER (PARTITION BY target) AS backward FROM edges
), seeds AS (
  SELECT host, avg(CASE WHEN action = 'allow' THEN 1.0 ELSE 0.0 END) AS t0, avg(CASE WHEN action = 'block' THEN 1.0 ELSE 0.0 END) AS d0 FROM judged GROUP BY host
), base AS (
  SELECT host, coalesce(t0, 0) AS t0, coalesce(d0, 0) AS d0 FROM seeds FULL JOIN (SELECT source AS host FROM edges UNION SELECT target FROM edges) e USING (host)
), r0 AS (SELECT host, {1 - damping} * t0 AS t, {1 - damping} * d0 AS d FROM base){steps}
SELECT j.page_id, j.host, j.path, j.rule, coalesce(j.action, CASE WHEN r.t + r.d > 0 AND r.d >= {threshold} * (r.t + r.d) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged j LEFT JOIN r{rounds} r ON r.host = j.host
"""


@_register("op4_url_filters", _url_sql(URL_RULES))
def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlgraph.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("trust", "distrust")


OP5_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 13) AS size, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item WHERE len(w) > 0)
), places AS (
  SELECT n, size, i, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT n, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc CROSS JOIN (SELECT DISTINCT size FROM windows))
), met AS (
  SELECT n, item, i, size FROM places JOIN windows USING (size, s)
), hit AS (
  SELECT n, count(DISTINCT p) AS n_hit FROM (SELECT n, unnest(range(i, i + size)) AS p FROM met) GROUP BY n
), items AS (
  SELECT n, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT n, item FROM met) GROUP BY n
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (n) LEFT JOIN items USING (n)
"""


@_register("op5_decontamination", OP5_SQL)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@_register("op6_lm_scoring")
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), held_out=held_out("doc_id", 5, 1))


@_register("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out("doc_id", 5, 0))
    model = toxicity.fit(docs.where(~F.col("held_out")), without_labels(table(spark, sf_dir, "labels"), 5, 0))
    return toxicity.score(docs, model, keep=("held_out",))


OP8_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), sized AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l')) AS text_chars,
    length(replace(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c'), chr(10), '\n')) AS role_chars
  FROM rows
), per AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss, sum(4 + role_chars + 2 + text_chars + 8) AS chars
  FROM sized GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars FROM per
"""


@_register("op8_chat_format", OP8_SQL)
def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text")
    )
    turns = F.transform(
        F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))), lambda r: F.struct(r["turn"], r["role"], r["text"])
    )
    records = rows.unionByName(tricky).groupBy("conv_id").agg(turns.alias("rows")).select("conv_id", F.struct("rows").alias("record"))
    out = chat.format_turns(chat.canonical_turns(records, "record"))
    read, loss = chat.read_turns(F.col("formatted")), chat.read_loss(F.col("formatted"), F.col("loss_spans"))
    whole = F.array_join(F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    out = out.select("conv_id", "formatted", read.alias("read"), loss.alias("loss"))
    return out.select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT doc_id, len(w) AS n_words,
    CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), sets AS (
  SELECT doc_id, len(s) AS n, list_sort(s) AS s FROM shingles
), classes AS (
  SELECT n, s, min(doc_id) AS rep FROM sets WHERE n > 0 GROUP BY n, s
), items AS (
  SELECT rep, n, unnest(s) AS x FROM classes
), pairs AS (
  SELECT p.rep AS a, q.rep AS b FROM items p JOIN items q ON p.x = q.x AND p.rep < q.rep
    AND 100 * least(p.n, q.n) >= 80 * greatest(p.n, q.n)
  GROUP BY p.rep, q.rep, p.n, q.n HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), edges AS (
  SELECT a, b FROM pairs UNION SELECT b, a FROM pairs
), reach(rep, seen) AS (
  SELECT DISTINCT a, a FROM edges UNION SELECT r.rep, e.b FROM reach r JOIN edges e ON r.seen = e.a
), labels AS (
  SELECT rep, min(seen) AS component_id FROM reach GROUP BY rep
)
SELECT d.doc_id, CAST(d.n AS BIGINT) AS n_shingles, coalesce(l.component_id, c.rep, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON d.n > 0 AND c.n = d.n AND c.s = d.s LEFT JOIN labels l ON l.rep = c.rep
"""


@_register("op9_ngram_jaccard", OP9_SQL)
def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(table(spark, sf_dir, "documents"))


@_register("op10_byte_bpe")
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), BPE_RANKS, public_tokenizers.PATTERN)
    return bpe.decode(encoded, BPE_RANKS, digests=True)


@_register("op11_packing")
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(WORD_TOKENIZER, encoding="utf-8") as file:
        pieces = packing.pack(table(spark, sf_dir, "documents"), file.read())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


OP12_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL
), item AS (
  SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), asked AS (
  SELECT i, any_value(item_id) AS item_id, term, count(*) AS times FROM item GROUP BY i, term
), total AS (
  SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM doc WHERE len(w) > 0
), place AS (
  SELECT n, term, count(*) AS tf FROM (SELECT n, unnest(w) AS term FROM doc) GROUP BY n, term
), weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM place CROSS JOIN total WHERE term IN (SELECT term FROM asked) GROUP BY term
), scored AS (
  SELECT a.i, any_value(a.item_id) AS item_id, p.n, d.doc_id,
    CAST(sum(a.times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(d.w) * docs) // total.terms)))) AS BIGINT) AS score
  FROM asked a JOIN place p USING (term) JOIN weight USING (term) JOIN doc d ON d.n = p.n CROSS JOIN total GROUP BY a.i, p.n, d.doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@_register("op12_lexical_search", OP12_SQL)
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))


def _repair_sql() -> str:
    """The damage (with CRC-32 byte by byte), the faults, and the edits by a left-to-right search over the four states."""
    white = r"[^\x20\x09-\x0D]"
    return rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce(range(8), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, i) ORDER BY i) AS t FROM range(256) r(i)
), coded AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT))) AS bytes
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(bytes, lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 20 AS h FROM coded CROSS JOIN crc_table
), damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM hit, range(CASE h WHEN 3 THEN 2 ELSE 1 END) WHERE h <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, regexp_extract(text, '(?s)({white})[\x20\x09-\x0D]*$', 1) AS final FROM damaged
), seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen FROM placed
), judged AS (
  SELECT *, left(role, 1) AS initial, CASE WHEN final = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM seen
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), inserts(p, q, cost, audit, said) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 5, 'I', 'user:\n'), (1, 2, 5, 'I', 'user:\n'), (3, 2, 5, 'I', 'user:\n'), (2, 3, 5, 'I', 'assistant:\n'),
    (0, 3, 10, 'II', 'user:\nassistant:\n'), (1, 3, 10, 'II', 'user:\nassistant:\n')
), edits(p, q, edit, cost, role) AS (
  VALUES (0, 0, 'D', 2, ''), (1, 1, 'D', 2, ''), (2, 2, 'D', 2, ''), (3, 3, 'D', 2, ''), (0, 2, 'R', 1, 'user'), (1, 2, 'R', 1, 'user'), (3, 2, 'R', 1, 'user'), (2, 3, 'R', 1, 'assistant'),
    (0, 1, 'K', 0, 's'), (0, 2, 'K', 0, 'u'), (1, 2, 'K', 0, 'u'), (3, 2, 'K', 0, 'u'), (2, 3, 'K', 0, 'a')
), moves AS (
  SELECT j.conv_id, j.i, e.p, t.q, e.cost + t.cost + CASE WHEN e.edit <> 'D' AND j.fault = 'truncated' THEN 5 ELSE 0 END AS cost, e.edit || t.audit AS audit,
    CASE e.edit WHEN 'D' THEN '' WHEN 'R' THEN e.role || ':' || j.text || chr(10) ELSE j.role || ':' || j.text || chr(10) END || replace(t.said, '\n', chr(10)) AS said
  FROM judged j JOIN edits e ON (e.edit = 'D' OR j.fault NOT IN ('blank', 'duplicate')) AND (e.edit <> 'K' OR e.role = j.initial) JOIN inserts t ON t.p = e.q
), search AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS i, t.q, t.cost, t.audit, replace(t.said, '\n', chr(10)) AS said FROM counted, inserts t WHERE t.p = 0
  UNION ALL
  SELECT conv_id, i, q, min(cost), arg_min(audit, (cost, audit)), arg_min(said, (cost, audit))
  FROM (SELECT m.conv_id, m.i, m.q, s.cost + m.cost AS cost, s.audit || m.audit AS audit, s.said || m.said AS said
        FROM search s JOIN moves m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.i = s.i + 1 AND m.p = s.q)
  GROUP BY conv_id, i, q
), best AS (
  SELECT s.conv_id, min(s.cost) AS cost, arg_min(s.audit, (s.cost, s.audit)) AS audit, arg_min(s.said, (s.cost, s.audit)) AS said
  FROM search s JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i WHERE s.q IN (0, 3) GROUP BY s.conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost, coalesce(audit, '') AS audit, sha256(CASE WHEN coalesce(said, '') = '' THEN '' ELSE left(said, length(said) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@_register("op13_conversation_repair", _repair_sql())
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damaged(table(spark, sf_dir, "conversations"))).withColumnRenamed("conv", "conv_id")
