"""Knowledge-graph queries: mapping, serialization round trip, RDFS closure,
metrics, path patterns, per-cluster preferences, sampling, split and
TransE scoring (G1-G10, K12-K14, J5-J8, J12, S8, S9, S12, T6, T8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, RES, iri, stable_hash
from zoneflow.operators.graph import mapping as gm
from zoneflow.operators.graph import metrics, pattern, rdfs, sample, score
from zoneflow.operators.graph.tbox import (
    RDF_PROPERTY,
    RDFS_CLASS,
    RDFS_DOMAIN,
    RDFS_RANGE,
    RDFS_SUBCLASS,
    RDFS_SUBPROPERTY,
    tbox_triples,
    values_sql,
)
from zoneflow.plans.registry import register, table
from zoneflow.session import in_tasks_of, materialize, scratch_path, shuffles_dropped, spread
from zoneflow.sources import files, sinks

SEED = 7


def _country(key_col) -> F.Column:
    return iri("country", stable_hash(key_col))


def kg_triples(spark, d):
    """G1-G3 + U4 over the test tables (nation = countries, customer = users,
    part = movies + genres, orders = matches + competitions)."""
    nation = table(spark, d, "nation")
    customer = in_tasks_of(spread(table(spark, d, "customer")))
    part = in_tasks_of(spread(table(spark, d, "part")))
    orders = in_tasks_of(spread(table(spark, d, "orders")))
    pri = F.col("o_orderpriority")
    maps = [
        (nation, gm.TableMap(_country("n_nationkey"), "Country", [gm.literal("country_name", F.lower("n_name"))])),
        (
            customer,
            gm.TableMap(
                iri("user", F.col("c_custkey")),
                "User",
                [gm.literal("user_name", F.col("c_name")), gm.link("user_country", _country("c_nationkey"))],
            ),
        ),
        (
            part,
            gm.TableMap(
                iri("film", F.col("p_partkey")),
                "Movie",
                [
                    gm.literal("movie_title", F.col("p_name")),
                    gm.literal("movie_runtime", F.col("p_size"), "integer"),
                    gm.literal("movie_revenue", F.col("p_retailprice"), "integer"),
                    gm.link("has_genre", iri("genre", stable_hash("p_type"))),
                    gm.flag("trending_movie", F.col("p_size") > 45),
                    gm.flag("upcoming_movie", F.col("p_brand") == "Brand#1"),
                ],
            ),
        ),
        (part.select("p_type").distinct(), gm.TableMap(iri("genre", stable_hash("p_type")), "Genre", [gm.literal("genre_name", F.lower("p_type"))])),
        (
            orders,
            gm.TableMap(
                iri("match", F.col("o_orderkey")),
                "Match",
                [
                    gm.literal("match_date", F.col("o_orderdate"), "dateTime"),
                    gm.literal(
                        "match_status",
                        F.when(F.col("o_orderstatus") == "F", F.lit("match finished")).otherwise(F.lit("not started")),
                    ),
                    gm.link("match_competition", iri("competition", stable_hash(pri))),
                ],
                guard=F.col("o_orderstatus").isin("F", "O"),
            ),
        ),
        (
            orders.select("o_orderpriority").distinct(),  # a priority's triples are made once, not once an order
            gm.TableMap(
                iri("competition", stable_hash(pri)),
                F.when(pri.isin("1-URGENT", "2-HIGH"), F.lit(ONT + "Cup")).otherwise(F.lit(ONT + "League")),  # G3
                [
                    gm.literal("competition_name", F.lower(F.expr("substring(o_orderpriority, 3)"))),
                    gm.link(
                        "competition_country",
                        F.when(pri == "5-LOW", F.lit(RES + "country_world")).otherwise(_country(F.substring(pri, 1, 1))),
                    ),
                ],
            ),
        ),
    ]
    return gm.map_tables(maps)


_SUBST = {"R": RES, "O": ONT, "TYPE": RDF_TYPE}


def _sql(text: str) -> str:
    for k, v in {
        "{R}": RES,
        "{O}": ONT,
        "{TYPE}": RDF_TYPE,
        "{DOMAIN}": RDFS_DOMAIN,
        "{RANGE}": RDFS_RANGE,
        "{SUBCLASS}": RDFS_SUBCLASS,
        "{SUBPROP}": RDFS_SUBPROPERTY,
        "{CLASS}": RDFS_CLASS,
        "{PROPERTY}": RDF_PROPERTY,
    }.items():
        text = text.replace(k, v)
    return text


ABOX_CTE = """
abox AS (SELECT DISTINCT * FROM (
  SELECT '{R}country_' || sha256(CAST(n_nationkey AS VARCHAR)) AS subject, '{TYPE}' AS predicate, '{O}Country' AS object, 'iri' AS object_kind, CAST(NULL AS VARCHAR) AS datatype FROM nation
  UNION ALL SELECT '{R}country_' || sha256(CAST(n_nationkey AS VARCHAR)), '{O}country_name', lower(n_name), 'literal', 'string' FROM nation
  UNION ALL SELECT '{R}user_' || CAST(c_custkey AS VARCHAR), '{TYPE}', '{O}User', 'iri', NULL FROM customer
  UNION ALL SELECT '{R}user_' || CAST(c_custkey AS VARCHAR), '{O}user_name', c_name, 'literal', 'string' FROM customer
  UNION ALL SELECT '{R}user_' || CAST(c_custkey AS VARCHAR), '{O}user_country', '{R}country_' || sha256(CAST(c_nationkey AS VARCHAR)), 'iri', NULL FROM customer
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{TYPE}', '{O}Movie', 'iri', NULL FROM part
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}movie_title', p_name, 'literal', 'string' FROM part
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}movie_runtime', CAST(p_size AS VARCHAR), 'literal', 'integer' FROM part
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}movie_revenue', CAST(CAST(trunc(p_retailprice) AS BIGINT) AS VARCHAR), 'literal', 'integer' FROM part
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}has_genre', '{R}genre_' || sha256(p_type), 'iri', NULL FROM part
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}trending_movie', 'true', 'literal', 'boolean' FROM part WHERE p_size > 45
  UNION ALL SELECT '{R}film_' || CAST(p_partkey AS VARCHAR), '{O}upcoming_movie', 'true', 'literal', 'boolean' FROM part WHERE p_brand = 'Brand#1'
  UNION ALL SELECT '{R}genre_' || sha256(p_type), '{TYPE}', '{O}Genre', 'iri', NULL FROM part
  UNION ALL SELECT '{R}genre_' || sha256(p_type), '{O}genre_name', lower(p_type), 'literal', 'string' FROM part
  UNION ALL SELECT '{R}match_' || CAST(o_orderkey AS VARCHAR), '{TYPE}', '{O}Match', 'iri', NULL FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT '{R}match_' || CAST(o_orderkey AS VARCHAR), '{O}match_date', strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S'), 'literal', 'dateTime' FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT '{R}match_' || CAST(o_orderkey AS VARCHAR), '{O}match_status', CASE WHEN o_orderstatus = 'F' THEN 'match finished' ELSE 'not started' END, 'literal', 'string' FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT '{R}match_' || CAST(o_orderkey AS VARCHAR), '{O}match_competition', '{R}competition_' || sha256(o_orderpriority), 'iri', NULL FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL SELECT '{R}competition_' || sha256(o_orderpriority), '{TYPE}', CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN '{O}Cup' ELSE '{O}League' END, 'iri', NULL FROM orders
  UNION ALL SELECT '{R}competition_' || sha256(o_orderpriority), '{O}competition_name', lower(substr(o_orderpriority, 3)), 'literal', 'string' FROM orders
  UNION ALL SELECT '{R}competition_' || sha256(o_orderpriority), '{O}competition_country',
                   CASE WHEN o_orderpriority = '5-LOW' THEN '{R}country_world' ELSE '{R}country_' || sha256(substr(o_orderpriority, 1, 1)) END, 'iri', NULL FROM orders
))
"""

TRIPLES_SQL = _sql("WITH " + ABOX_CTE + "SELECT * FROM abox")

CLOSURE_CTES = (
    ABOX_CTE
    + """,
tbox(subject, predicate, object) AS (VALUES
"""
    + values_sql()
    + """
),
sc(sub, sup) AS (SELECT subject, object FROM tbox WHERE predicate = '{SUBCLASS}'
                 UNION SELECT sc.sub, t.object FROM sc JOIN tbox t ON t.subject = sc.sup AND t.predicate = '{SUBCLASS}'),
sp(sub, sup) AS (SELECT subject, object FROM tbox WHERE predicate = '{SUBPROP}'
                 UNION SELECT sp.sub, t.object FROM sp JOIN tbox t ON t.subject = sp.sup AND t.predicate = '{SUBPROP}'),
base AS (SELECT * FROM abox UNION ALL SELECT subject, predicate, object, 'iri', NULL FROM tbox),
t1 AS (SELECT * FROM base UNION ALL SELECT b.subject, sp.sup, b.object, b.object_kind, b.datatype FROM base b JOIN sp ON b.predicate = sp.sub),
types AS (SELECT subject, object FROM t1 WHERE predicate = '{TYPE}'
          UNION ALL SELECT t1.subject, d.object FROM t1 JOIN tbox d ON d.predicate = '{DOMAIN}' AND d.subject = t1.predicate
          UNION ALL SELECT t1.object, r.object FROM t1 JOIN tbox r ON r.predicate = '{RANGE}' AND r.subject = t1.predicate WHERE t1.object_kind = 'iri'),
suptypes AS (SELECT ty.subject, sc.sup AS object FROM types ty JOIN sc ON ty.object = sc.sub),
props AS (SELECT predicate AS x FROM t1
          UNION SELECT subject FROM tbox WHERE predicate IN ('{DOMAIN}', '{RANGE}', '{SUBPROP}')
          UNION SELECT object FROM tbox WHERE predicate = '{SUBPROP}'),
classes AS (SELECT object AS x FROM types UNION SELECT object FROM suptypes
            UNION SELECT object FROM tbox WHERE predicate IN ('{DOMAIN}', '{RANGE}', '{SUBCLASS}')
            UNION SELECT subject FROM tbox WHERE predicate = '{SUBCLASS}'),
meta AS (SELECT DISTINCT '{PROPERTY}' AS x FROM props UNION SELECT DISTINCT '{CLASS}' FROM classes),
closure AS (SELECT DISTINCT * FROM (
  SELECT subject, predicate, object, object_kind, datatype FROM t1
  UNION ALL SELECT subject, '{TYPE}', object, 'iri', NULL FROM types
  UNION ALL SELECT subject, '{TYPE}', object, 'iri', NULL FROM suptypes
  UNION ALL SELECT x, '{TYPE}', '{PROPERTY}', 'iri', NULL FROM props
  UNION ALL SELECT x, '{TYPE}', '{CLASS}', 'iri', NULL FROM classes
  UNION ALL SELECT x, '{TYPE}', '{CLASS}', 'iri', NULL FROM meta))
"""
)


register("triples_mapping", TRIPLES_SQL)(kg_triples)


@register("ntriples_roundtrip", TRIPLES_SQL)
def ntriples_roundtrip(spark, d):
    """K13 write N-Triples -> K14 bulk load back (empty check) -> K12 TSV
    export with header -> S8 read; the literal columns ride along through
    the N-Triples path."""
    triples = kg_triples(spark, d)
    nt_path = scratch_path(spark, "kg-nt")
    with shuffles_dropped(spark):
        sinks.write_ntriples(triples, nt_path, compression="gzip")
    loaded = materialize(spark, sinks.read_ntriples(spark, nt_path), "kg-loaded")  # parsed once, for the export and the join
    tsv_path = scratch_path(spark, "kg-tsv")
    sinks.write_tsv(pattern.all_triples(loaded), tsv_path, compression="gzip")
    spo = files.read_triples_tsv(spark, tsv_path)
    # kind/datatype are not part of the 3-column TSV export: re-attach them
    # from the N-Triples load (same triples, equi-join on s, p, o).
    # The hash comes first in the join's order: IRIs share their first letters, numbers sort faster.
    # The rows are dealt out as the join needs them before the hash is made, so that it is not shuffled itself.
    spo_cols = ["subject", "predicate", "object"]
    key = F.xxhash64(*spo_cols)
    keyed = lambda df: df.repartition(key, *spo_cols).withColumn("key", key)
    return keyed(spo).join(keyed(loaded), ["key", *spo_cols]).select(*spo_cols, "object_kind", "datatype")


@register("rdfs_closure", _sql("WITH RECURSIVE " + CLOSURE_CTES + "SELECT * FROM closure"))
def rdfs_closure(spark, d):
    return rdfs.materialize(spark, kg_triples(spark, d), tbox_triples(spark))


@register(
    "kg_metrics",
    _sql(
        "WITH RECURSIVE "
        + CLOSURE_CTES
        + """
SELECT count(*) AS n_triples,
       count(DISTINCT CASE WHEN predicate = '{TYPE}' AND object = '{CLASS}' AND starts_with(subject, '{O}') THEN subject END) AS n_classes,
       count(DISTINCT CASE WHEN predicate = '{TYPE}' AND object = '{PROPERTY}' AND starts_with(subject, '{O}') THEN subject END) AS n_properties,
       count(DISTINCT CASE WHEN predicate = '{TYPE}' AND object = '{O}User' THEN subject END) AS n_users
FROM closure
"""
    ),
)
def kg_metrics(spark, d):
    return metrics.kg_metrics(rdfs.materialize(spark, kg_triples(spark, d), tbox_triples(spark)))


@register(
    "path_match",
    _sql(
        "WITH "
        + ABOX_CTE
        + """
SELECT a.subject AS start, 'country' AS category, b.object AS name
FROM abox a JOIN abox b ON a.object = b.subject AND b.predicate = '{O}country_name'
WHERE a.predicate = '{O}user_country'
  AND a.subject IN (SELECT '{R}user_' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_mktsegment = 'BUILDING')
UNION
SELECT a.subject, 'genre', b.object
FROM abox a JOIN abox b ON a.object = b.subject AND b.predicate = '{O}genre_name'
WHERE a.predicate = '{O}has_genre'
  AND a.subject IN (SELECT '{R}film_' || CAST(p_partkey AS VARCHAR) FROM part WHERE p_size < 10)
"""
    ),
)
def path_match(spark, d):
    """Two-hop patterns restricted to listed subjects."""
    triples = kg_triples(spark, d)
    listed_users = table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING").select(iri("user", F.col("c_custkey")).alias("u"))
    listed_films = table(spark, d, "part").where(F.col("p_size") < 10).select(iri("film", F.col("p_partkey")).alias("u"))
    countries = pattern.restrict_to(pattern.match_path(triples, [ONT + "user_country", ONT + "country_name"], "start", "name"), "start", listed_users, "u")
    genres = pattern.restrict_to(pattern.match_path(triples, [ONT + "has_genre", ONT + "genre_name"], "start", "name"), "start", listed_films, "u")
    return (
        countries.select("start", F.lit("country").alias("category"), "name")
        .unionByName(genres.select("start", F.lit("genre").alias("category"), "name"))
        .distinct()
    )


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register(
    "cluster_top_preference",
    """
WITH members AS (
  SELECT 'user_' || CAST(c_custkey AS VARCHAR) AS u,
         CAST(CASE WHEN c_acctbal < 0 THEN -1
                   ELSE list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) - 1 END AS BIGINT) AS cluster
  FROM customer),
sol AS (
  SELECT m.cluster, 'nation' AS category, n.n_name AS name
  FROM customer c JOIN members m ON m.u = 'user_' || CAST(c.c_custkey AS VARCHAR) JOIN nation n ON n.n_nationkey = c.c_nationkey
  UNION ALL
  SELECT m.cluster, 'priority', o.o_orderpriority FROM orders o JOIN members m ON m.u = 'user_' || CAST(o.o_custkey AS VARCHAR)
  UNION ALL
  SELECT m.cluster, 'brand', p.p_brand
  FROM (SELECT DISTINCT o.o_custkey, l.l_partkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey) b
  JOIN members m ON m.u = 'user_' || CAST(b.o_custkey AS VARCHAR) JOIN part p ON p.p_partkey = b.l_partkey),
counts AS (SELECT cluster, category, name, count(*) AS n FROM sol WHERE cluster <> -1 GROUP BY cluster, category, name)
SELECT cluster, category, name, n FROM counts
QUALIFY row_number() OVER (PARTITION BY cluster, category ORDER BY n DESC, name) = 1
""",
)
def cluster_top_preference(spark, d):
    """Customers clustered by segment (negative balance = noise), their
    nation / order priorities / bought brands as preference categories."""
    cust = table(spark, d, "customer")
    orders = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    nation = table(spark, d, "nation")
    part = table(spark, d, "part")
    user = lambda c: F.concat(F.lit("user_"), F.col(c).cast("string"))
    seg_list = F.array(*[F.lit(s) for s in SEGMENTS])
    assignments = cust.select(
        user("c_custkey").alias("user"),
        F.when(F.col("c_acctbal") < 0, F.lit(-1)).otherwise(F.array_position(seg_list, F.col("c_mktsegment")) - 1).cast("bigint").alias("cluster"),
    )
    t = lambda s, p, o: (s, F.lit(p), o)
    parts = [
        cust.select(*[c.alias(n) for c, n in zip(t(user("c_custkey"), "in_nation", F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"))), ["subject", "predicate", "object"], strict=True)]),
        nation.select(*[c.alias(n) for c, n in zip(t(F.concat(F.lit("nation_"), F.col("n_nationkey").cast("string")), "named", F.col("n_name")), ["subject", "predicate", "object"], strict=True)]),
        orders.select(*[c.alias(n) for c, n in zip(t(user("o_custkey"), "placed", F.concat(F.lit("order_"), F.col("o_orderkey").cast("string"))), ["subject", "predicate", "object"], strict=True)]),
        orders.select(*[c.alias(n) for c, n in zip(t(F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")), "priority", F.col("o_orderpriority")), ["subject", "predicate", "object"], strict=True)]),
        orders.join(li, li.l_orderkey == orders.o_orderkey).select(
            *[c.alias(n) for c, n in zip(t(user("o_custkey"), "bought", F.concat(F.lit("part_"), F.col("l_partkey").cast("string"))), ["subject", "predicate", "object"], strict=True)]
        ),
        part.select(*[c.alias(n) for c, n in zip(t(F.concat(F.lit("part_"), F.col("p_partkey").cast("string")), "brand", F.col("p_brand")), ["subject", "predicate", "object"], strict=True)]),
    ]
    triples = parts[0]
    for p in parts[1:]:
        triples = triples.unionByName(p)
    triples = triples.distinct()
    cats = {"nation": ["in_nation", "named"], "priority": ["placed", "priority"], "brand": ["bought", "brand"]}
    return metrics.top_preferences(assignments, triples, cats)


@register(
    "sample_k_per_key",
    """
WITH items AS (SELECT n_nationkey AS item, row_number() OVER (ORDER BY n_nationkey) - 1 AS idx FROM nation),
mm AS (SELECT count(*) AS m FROM items),
s0 AS (SELECT c_custkey, least(1 + ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':k'), 1, 8))::BIGINT % 3, mm.m) AS k,
              mm.m AS m, CAST([] AS BIGINT[]) AS s FROM customer, mm),
s1 AS (SELECT c_custkey, k, m, CASE WHEN 0 < k THEN
         (CASE WHEN list_contains(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':0'), 1, 8))::BIGINT % (m - k + 0 + 1))
               THEN list_append(s, m - k + 0)
               ELSE list_append(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':0'), 1, 8))::BIGINT % (m - k + 0 + 1)) END)
         ELSE s END AS s FROM s0),
s2 AS (SELECT c_custkey, k, m, CASE WHEN 1 < k THEN
         (CASE WHEN list_contains(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':1'), 1, 8))::BIGINT % (m - k + 1 + 1))
               THEN list_append(s, m - k + 1)
               ELSE list_append(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':1'), 1, 8))::BIGINT % (m - k + 1 + 1)) END)
         ELSE s END AS s FROM s1),
s3 AS (SELECT c_custkey, k, m, CASE WHEN 2 < k THEN
         (CASE WHEN list_contains(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':2'), 1, 8))::BIGINT % (m - k + 2 + 1))
               THEN list_append(s, m - k + 2)
               ELSE list_append(s, ('0x' || substr(sha256('7:' || CAST(c_custkey AS VARCHAR) || ':2'), 1, 8))::BIGINT % (m - k + 2 + 1)) END)
         ELSE s END AS s FROM s2)
SELECT c_custkey, item AS n_nationkey FROM (SELECT c_custkey, unnest(s) AS idx FROM s3) x JOIN items USING (idx)
""",
)
def sample_k_per_key(spark, d):
    """Every customer likes 1-3 distinct nations, drawn uniformly."""
    cust = table(spark, d, "customer").select("c_custkey")
    nation = table(spark, d, "nation").select("n_nationkey")
    return sample.sample_k_per_key(spark, cust, "c_custkey", nation, "n_nationkey", 1, 3, SEED)


@register(
    "sample_cap",
    "SELECT vec_id, label FROM embeddings ORDER BY sha256('7:' || CAST(vec_id AS VARCHAR)), vec_id LIMIT 100",
)
def sample_cap(spark, d):
    """A seeded random cap of 100 vectors (the limit is the feature)."""
    emb = table(spark, d, "embeddings").select("vec_id", "label")
    return sample.sample_cap(emb, "vec_id", 100, "random", SEED)


NEG_ROUNDS = 6


def _draw(what: str, row: str) -> str:
    return f"('0x' || substr(sha256('7:{what}:' || {row}.s || ':' || {row}.p || ':' || {row}.o), 1, 8))::BIGINT"


def _rounds_sql() -> str:
    """Each round's draws, and those that made a known triple; then a draw among the entities that make none."""
    steps = "".join(
        f""",
d{r} AS (SELECT c.s, c.p, c.o, c.head, CASE WHEN c.head THEN {_draw(f"neg{r}", "c")} % n.n ELSE c.s END AS ns, CASE WHEN c.head THEN c.o ELSE {_draw(f"neg{r}", "c")} % n.n END AS no FROM c{r} c CROSS JOIN n),
c{r + 1} AS (SELECT s, p, o, head FROM d{r} d WHERE EXISTS (SELECT 1 FROM tb k WHERE k.s = d.ns AND k.p = d.p AND k.o = d.no))"""
        for r in range(NEG_ROUNDS)
    )
    done = " UNION ALL ".join(f"SELECT s, p, o, ns, no FROM d{r} d WHERE NOT EXISTS (SELECT 1 FROM tb k WHERE k.s = d.ns AND k.p = d.p AND k.o = d.no)" for r in range(NEG_ROUNDS))
    return f"""{steps},
free AS (SELECT c.s, c.p, c.o, c.head, e.idx, row_number() OVER w - 1 AS j, count(*) OVER (PARTITION BY c.s, c.p, c.o) AS free
         FROM c{NEG_ROUNDS} c CROSS JOIN ent e
         WHERE NOT EXISTS (SELECT 1 FROM tb k WHERE k.p = c.p AND k.s = CASE WHEN c.head THEN e.idx ELSE c.s END AND k.o = CASE WHEN c.head THEN c.o ELSE e.idx END)
         WINDOW w AS (PARTITION BY c.s, c.p, c.o ORDER BY e.idx)),
last AS (SELECT c.s, c.p, c.o, CASE WHEN f.idx IS NOT NULL THEN CASE WHEN c.head THEN f.idx ELSE c.s END END AS ns, CASE WHEN f.idx IS NOT NULL THEN CASE WHEN c.head THEN c.o ELSE f.idx END END AS no
         FROM c{NEG_ROUNDS} c LEFT JOIN free f ON f.s = c.s AND f.p = c.p AND f.o = c.o AND f.j = {_draw("last", "f")} % f.free),
drawn AS ({done} UNION ALL SELECT * FROM last)"""


@register(
    "triple_split_negatives",
    _sql(
        "WITH "
        + ABOX_CTE
        + """,
t AS (SELECT DISTINCT subject, predicate, object FROM abox WHERE object_kind = 'iri'),
ent AS (SELECT entity, row_number() OVER (ORDER BY entity) - 1 AS idx FROM (SELECT subject AS entity FROM t UNION SELECT object FROM t)),
pre AS (SELECT predicate, row_number() OVER (ORDER BY predicate) - 1 AS p FROM (SELECT DISTINCT predicate FROM t)),
n AS (SELECT count(*) AS n FROM ent),
tb AS (SELECT es.idx AS s, pre.p, eo.idx AS o, t.*, ('0x' || substr(sha256('7:' || subject || ':' || predicate || ':' || object), 1, 8))::BIGINT AS h
       FROM t JOIN ent es ON es.entity = t.subject JOIN ent eo ON eo.entity = t.object JOIN pre USING (predicate)),
ms AS (SELECT s, min(h) AS min_s FROM tb GROUP BY s),
mo AS (SELECT o, min(h) AS min_o FROM tb GROUP BY o),
stat AS (SELECT p, count(DISTINCT s) AS ds, count(DISTINCT o) AS dob FROM tb GROUP BY p),
c0 AS (SELECT c.s, c.p, c.o, """
        + _draw("side", "c")
        + """ % (ds + dob) < dob AS head FROM tb c JOIN stat USING (p))"""
        + _rounds_sql()
        + """
SELECT tb.subject, tb.predicate, tb.object, CASE WHEN h % 1000 < 100 AND h <> min_s AND h <> min_o THEN 'test' ELSE 'train' END AS split, es.entity AS neg_subject, eo.entity AS neg_object
FROM tb JOIN ms USING (s) JOIN mo USING (o) JOIN drawn d ON d.s = tb.s AND d.p = tb.p AND d.o = tb.o LEFT JOIN ent es ON es.idx = d.ns LEFT JOIN ent eo ON eo.idx = d.no
"""
    ),
)
def triple_split_negatives(spark, d):
    """Hash split, and a corrupted head or tail for every triple that makes no known one."""
    return sample.split_with_negatives(spark, kg_triples(spark, d), 100, SEED)


RANK_CTE = """
WITH e AS (SELECT vec_id AS id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
known AS (SELECT a.id AS h, a.label AS r, a.id + j AS t, j FROM e a, range(1, 4) x(j) WHERE EXISTS (SELECT 1 FROM e b WHERE b.id = a.id + j)),
asked AS (
  SELECT k.h, k.r, k.t, 'tail' AS side, list_transform(a.v, lambda x: x + 0.01 * (k.r + 1)) AS q, k.t AS truth FROM known k JOIN e a ON a.id = k.h WHERE k.j = 1
  UNION ALL SELECT k.h, k.r, k.t, 'head', list_transform(b.v, lambda x: x - 0.01 * (k.r + 1)), k.h FROM known k JOIN e b ON b.id = k.t WHERE k.j = 1
), own AS (SELECT a.*, list_distance(a.q, e.v) AS own FROM asked a JOIN e ON e.id = a.truth),
met AS (
  SELECT o.h, o.r, o.t, o.side, o.own, list_distance(o.q, e.v) AS other FROM own o JOIN e ON e.id <> o.truth
  WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.r = o.r AND k.h = CASE WHEN o.side = 'tail' THEN o.h ELSE e.id END AND k.t = CASE WHEN o.side = 'tail' THEN e.id ELSE o.t END)
), ranks AS (
  SELECT h AS head, 'rel_' || CAST(r AS VARCHAR) AS relation, t AS tail, side, 1 + count(*) FILTER (WHERE other < own) AS optimistic, 1 + count(*) FILTER (WHERE other <= own) AS pessimistic
  FROM met GROUP BY ALL
)
"""


def _ranks(spark, d):
    """Successors up to three places on are known tails; the next one is asked for."""
    emb = table(spark, d, "embeddings")
    entities = emb.select(F.col("vec_id").alias("id"), "embedding")
    known = emb.select(F.col("vec_id").alias("head"), F.concat(F.lit("rel_"), F.col("label").cast("string")).alias("relation"), F.explode(F.array(*(F.col("vec_id") + j for j in (1, 2, 3)))).alias("tail"))
    return score.link_ranking(known.where("tail = head + 1"), known, entities, _relations(emb))


def _relations(emb):
    """A relation for each label, with a fixed vector: 0.01 * (label + 1) in every dimension."""
    dims = emb.groupBy("label").agg(F.max(F.size("embedding")).alias("dim"))
    return dims.select(F.concat(F.lit("rel_"), F.col("label").cast("string")).alias("id"), F.array_repeat(F.lit(0.01) * (F.col("label") + 1), F.col("dim")).alias("embedding"))


@register("link_ranking", RANK_CTE + "SELECT *, (optimistic + pessimistic) / 2.0 AS realistic FROM ranks")
def link_ranking(spark, d):
    """Filtered head and tail ranks among all entities."""
    return _ranks(spark, d)


@register(
    "link_metrics",
    RANK_CTE
    + """, sided AS (SELECT unnest([side, 'both']) AS side, (optimistic + pessimistic) / 2.0 AS rank FROM ranks)
SELECT side, count(*) AS n, round(avg(rank), 6) AS mean_rank, round(avg(1.0 / rank), 6) AS mrr, round(avg(CASE WHEN rank <= 1 THEN 1.0 ELSE 0.0 END), 6) AS hits_at_1,
       round(avg(CASE WHEN rank <= 3 THEN 1.0 ELSE 0.0 END), 6) AS hits_at_3, round(avg(CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END), 6) AS hits_at_10
FROM sided GROUP BY side""",
)
def link_metrics(spark, d):
    """Mean rank, MRR and hits@k of the filtered ranks, for each side and both."""
    out = score.ranking_metrics(_ranks(spark, d))
    return out.select("side", "n", *(F.round(c, 6).alias(c) for c in ("mean_rank", "mrr", "hits_at_1", "hits_at_3", "hits_at_10")))


@register(
    "transe_score",
    """
SELECT h.vec_id AS head, 'rel_' || CAST(h.label AS VARCHAR) AS relation, t.vec_id AS tail,
       round(sqrt(list_sum(list_transform(range(1, len(h.embedding) + 1),
             lambda i: (CAST(h.embedding[i] AS DOUBLE) + 0.01 * (h.label + 1) - CAST(t.embedding[i] AS DOUBLE))
                * (CAST(h.embedding[i] AS DOUBLE) + 0.01 * (h.label + 1) - CAST(t.embedding[i] AS DOUBLE))))), 6) AS score
FROM embeddings h JOIN embeddings t ON t.vec_id = h.vec_id + 1
""",
)
def transe_score(spark, d):
    """Each vector's successor as the tail; relation = its label, with a
    fixed relation vector 0.01 * (label + 1) in every dimension."""
    emb = table(spark, d, "embeddings")
    triples = emb.select(
        F.col("vec_id").alias("head"),
        F.concat(F.lit("rel_"), F.col("label").cast("string")).alias("relation"),
        (F.col("vec_id") + 1).alias("tail"),
    )
    entities = emb.select(F.col("vec_id").alias("id"), "embedding")
    scored = score.transe_score(triples, entities, _relations(emb), id_col="id")
    return scored.select("head", "relation", "tail", F.round("score", 6).alias("score"))
