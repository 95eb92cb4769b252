"""Vector and clustering queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, RES
from zoneflow.operators import cluster as cl
from zoneflow.operators import vectors as vx
from zoneflow.operators.graph.sample import sample_cap
from zoneflow.plans.registry import register, table
from zoneflow.session import materialize, scratch_path
from zoneflow.sources import files, sinks

SEED = 7
EPS = 0.015
MIN_SAMPLES = 5

_COS_SQL = """
round(list_sum(list_transform(range(1, len(q.qv) + 1), lambda i: CAST(q.qv[i] AS DOUBLE) * CAST(e.embedding[i] AS DOUBLE)))
      / (sqrt(list_sum(list_transform(range(1, len(q.qv) + 1), lambda i: CAST(e.embedding[i] AS DOUBLE) * CAST(e.embedding[i] AS DOUBLE))))
         * sqrt(list_sum(list_transform(range(1, len(q.qv) + 1), lambda i: CAST(q.qv[i] AS DOUBLE) * CAST(q.qv[i] AS DOUBLE))))), 6)
"""


@register(
    "vector_search",
    """
WITH q AS (SELECT vec_id AS query_id, embedding AS qv FROM embeddings WHERE vec_id % 50 = 0),
scored AS (SELECT q.query_id, e.vec_id, """
    + _COS_SQL
    + """ AS score FROM embeddings e CROSS JOIN q)
SELECT query_id, vec_id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 10
""",
)
def vector_search(spark, d):
    """Top-10 cosine hits over the whole index for every vector whose id is divisible by 50."""
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    queries = emb.where(F.col("vec_id") % 50 == 0).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    return vx.search(emb, queries, k=10, id_col="vec_id")


@register(
    "vector_upsert",
    """
SELECT vec_id, label, round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) * CASE WHEN vec_id % 3 = 0 THEN 2 ELSE 1 END, 6) AS l2,
       CASE WHEN vec_id % 3 = 0 THEN 'new' ELSE 'old' END AS origin
FROM embeddings WHERE label < 8 OR vec_id % 3 = 0
""",
)
def vector_upsert(spark, d):
    """M4: the vectors of labels below 8 are the index; every third vector of the table, doubled, is upserted by id."""
    emb = table(spark, d, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding"))
    index = emb.where("label < 8").withColumn("origin", F.lit("old"))
    records = emb.where("vec_id % 3 = 0").withColumn("embedding", F.transform("embedding", lambda x: 2 * x)).withColumn("origin", F.lit("new"))
    out = vx.upsert_vectors(index, records, "vec_id")
    return out.select("vec_id", "label", F.round(vx.norm("embedding"), 6).alias("l2"), "origin")


CLASS_BY_LABEL = {0: "User", 1: "Movie", 2: "Team"}


@register(
    "entity_gather",
    f"""
SELECT vec_id AS id, '{RES}entity_' || CAST(vec_id AS VARCHAR) AS label, CAST(len(embedding) AS BIGINT) AS dim,
       round(sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))), 6) AS l2
FROM embeddings WHERE label = 0
""",
)
def entity_gather(spark, d):
    """J7 + J8 + S8 + S9 + S12 + K12: the entity dictionary is written as a
    gzip TSV, the typed triples as a TSV with header; both are read back,
    users are found by ``rdf:type User`` and their vectors gathered by id."""
    emb = table(spark, d, "embeddings")
    label_iri = F.concat(F.lit(RES + "entity_"), F.col("vec_id").cast("string"))
    cls = F.element_at(F.create_map(*[x for k, v in CLASS_BY_LABEL.items() for x in (F.lit(k), F.lit(ONT + v))]), F.col("label"))
    dict_path = scratch_path(spark, "entity-dict")
    sinks.write_tsv(emb.select(F.col("vec_id").alias("id"), label_iri.alias("label")), dict_path, compression="gzip")
    triples_path = scratch_path(spark, "entity-types")
    sinks.write_tsv(emb.select(label_iri.alias("subject"), F.lit(RDF_TYPE).alias("predicate"), cls.alias("object")), triples_path)
    dictionary = files.read_dictionary(spark, dict_path)
    triples = files.read_triples_tsv(spark, triples_path)
    users = triples.where((F.col("predicate") == RDF_TYPE) & (F.col("object") == ONT + "User")).select(F.col("subject").alias("label"))
    user_ids = dictionary.join(users, "label", "left_semi")  # J7
    gathered = user_ids.join(emb.select(F.col("vec_id").alias("id"), "embedding"), "id")  # J8
    return gathered.select(
        "id", "label", F.size("embedding").cast("bigint").alias("dim"), F.round(vx.norm("embedding"), 6).alias("l2")
    )


@register(
    "standardize",
    """
WITH x AS (SELECT vec_id, CAST(i - 1 AS BIGINT) AS dim, CAST(embedding[i] AS DOUBLE) AS v
           FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding)),
s AS (SELECT dim, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END AS sd FROM x GROUP BY dim)
SELECT vec_id, dim, round((v - mu) / sd, 6) AS z FROM x JOIN s USING (dim)
""",
)
def standardize(spark, d):
    """Per-dimension z-scores (population std)."""
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    scaled = cl.standardize(emb, "embedding", "z")
    return scaled.select("vec_id", F.posexplode("z").alias("dim", "z")).select(
        "vec_id", F.col("dim").cast("bigint").alias("dim"), F.round("z", 6).alias("z")
    )


@register("pca_project")
def pca_project(spark, d):
    """M8 + M10: standardize -> PCA(min(50, n-1, d)) -> PCA(2) (rows-only:
    component signs are not unique)."""
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    reduced = cl.reduce_dims(emb, "embedding", 50)
    flat = cl.pca(reduced.select("vec_id", "reduced"), "reduced", 2, "xy")
    return flat.select("vec_id", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))


@register(
    "pca_invariants",
    """
WITH x AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding)),
s AS (SELECT i, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END AS sd FROM x GROUP BY i),
pts AS (SELECT vec_id, list((v - mu) / sd ORDER BY i) AS z FROM x JOIN s USING (i) GROUP BY vec_id)
SELECT p.vec_id, round(list_distance(p.z, list_transform(p.z, lambda x: 0.0)), 6) AS length, round(list_distance(p.z, q.z), 6) AS to_next FROM pts p LEFT JOIN pts q ON q.vec_id = p.vec_id + 1
""",
)
def pca_invariants(spark, d):
    """M8 + M10: what a projection on all principal components keeps, whatever their signs: every vector's
    length and its distance to the next (fails if components are not orthonormal or not all there)."""
    points = _scaled(spark, d)
    dim = points.select(F.max(F.size("z"))).first()[0]
    pcs = materialize(spark, cl.pca(points, "z", dim, "pcs").select("vec_id", "pcs"), "pcs")
    nexts = pcs.select((F.col("vec_id") - 1).alias("vec_id"), F.col("pcs").alias("other"))
    away = F.zip_with("pcs", "other", lambda a, b: a - b)
    return pcs.join(nexts, "vec_id", "left").select("vec_id", F.round(vx.norm("pcs"), 6).alias("length"), F.round(vx.norm(away), 6).alias("to_next"))


def _points(spark, d):
    emb = table(spark, d, "embeddings")
    return emb.select("vec_id", F.slice("embedding", 1, 2).alias("xy"))


@register(
    "eps_neighbours",
    """
WITH p AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings)
SELECT a.id AS a, b.id AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 9) AS dist
FROM p a JOIN p b ON a.id < b.id AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.015
""",
)
def eps_neighbours(spark, d):
    """Pairs within eps on the first two dimensions (a < b)."""
    pairs = cl.eps_pairs(_points(spark, d), "vec_id", "xy", EPS)
    return pairs.where(F.col("a") < F.col("b")).select("a", "b", F.round("dist", 9).alias("dist"))


DBSCAN_SQL = """
WITH RECURSIVE pts AS (SELECT vec_id AS id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y FROM embeddings),
nb AS (SELECT a.id AS a, b.id AS b FROM pts a JOIN pts b ON sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 0.015),
deg AS (SELECT a, count(*) AS d FROM nb GROUP BY a),
core AS (SELECT a AS id FROM deg WHERE d >= 5),
ce AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON c1.id = nb.a JOIN core c2 ON c2.id = nb.b),
reach(a, b) AS (SELECT a, b FROM ce UNION SELECT r.a, ce.b FROM reach r JOIN ce ON ce.a = r.b),
comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
lab AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp)),
core_lab AS (SELECT comp.id, lab.cluster FROM comp JOIN lab ON lab.root = comp.root),
border AS (SELECT nb.a AS id, min(cl.cluster) AS cluster FROM nb JOIN core_lab cl ON cl.id = nb.b
           WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a)
SELECT p.id AS vec_id, CAST(coalesce(cl.cluster, b.cluster, -1) AS BIGINT) AS cluster
FROM pts p LEFT JOIN core_lab cl ON cl.id = p.id LEFT JOIN border b ON b.id = p.id
"""


@register("dbscan", DBSCAN_SQL)
def dbscan(spark, d):
    """M9 + A14: DBSCAN(eps=0.015, min_samples=5) on the first two dimensions."""
    return cl.dbscan(spark, _points(spark, d), "vec_id", "xy", EPS, MIN_SAMPLES)


WHOLE_CTE = """
WITH RECURSIVE x AS (SELECT vec_id, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) r(i) WHERE i <= len(embedding)),
s AS (SELECT i, avg(v) AS mu, CASE WHEN stddev_pop(v) = 0 THEN 1.0 ELSE stddev_pop(v) END AS sd FROM x GROUP BY i),
pts AS (SELECT vec_id AS id, list((v - mu) / sd ORDER BY i) AS z FROM x JOIN s USING (i) GROUP BY vec_id),
asked AS (SELECT id, z FROM pts ORDER BY sha256('7:' || CAST(id AS VARCHAR)), id LIMIT 200),
kth AS (SELECT a.id, list_sort(list(list_distance(a.z, p.z)))[5] AS dist FROM asked a CROSS JOIN pts p GROUP BY a.id),
radius AS (SELECT round(quantile_disc(dist, 0.1), 2) + 0.005 AS eps FROM kth),
nb AS (SELECT a.id AS a, b.id AS b, list_distance(a.z, b.z) AS dist FROM pts a CROSS JOIN pts b WHERE list_distance(a.z, b.z) <= (SELECT eps FROM radius)),
deg AS (SELECT a, count(*) AS d FROM nb GROUP BY a),
core AS (SELECT a AS id FROM deg WHERE d >= 5),
ce AS (SELECT nb.a, nb.b FROM nb JOIN core c1 ON c1.id = nb.a JOIN core c2 ON c2.id = nb.b),
reach(a, b) AS (SELECT a, b FROM ce UNION SELECT r.a, ce.b FROM reach r JOIN ce ON ce.a = r.b),
comp AS (SELECT a AS id, min(b) AS root FROM reach GROUP BY a),
lab AS (SELECT root, row_number() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp)),
core_lab AS (SELECT comp.id, lab.cluster FROM comp JOIN lab ON lab.root = comp.root),
border AS (SELECT nb.a AS id, min(cl.cluster) AS cluster FROM nb JOIN core_lab cl ON cl.id = nb.b
           WHERE nb.a NOT IN (SELECT id FROM core) GROUP BY nb.a),
label AS (SELECT p.id AS vec_id, CAST(coalesce(cl.cluster, b.cluster, -1) AS BIGINT) AS cluster
          FROM pts p LEFT JOIN core_lab cl ON cl.id = p.id LEFT JOIN border b ON b.id = p.id)
"""


def _scaled(spark, d):
    """The whole vectors, standardized."""
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    return materialize(spark, cl.standardize(emb, "embedding", "z").select("vec_id", "z"), "scaled")


def _radius(points, vec_col):
    """A radius at which a tenth of the points are cores, by the distances to their fifth neighbours."""
    return cl.k_distance(points, "vec_id", vec_col, MIN_SAMPLES, 0.1, seed=SEED)


@register("eps_neighbours_whole", WHOLE_CTE + "SELECT a, b, round(dist, 6) AS dist FROM nb WHERE a <= b")
def eps_neighbours_whole(spark, d):
    """Pairs within the k-distance radius on the standardized whole vectors (a <= b: each
    point is its own neighbour, as in DBSCAN)."""
    points = _scaled(spark, d)
    return cl.near_pairs(points, "vec_id", "z", _radius(points, "z")).select("a", "b", F.round("dist", 6).alias("dist"))


@register("dbscan_whole", WHOLE_CTE + "SELECT vec_id, cluster FROM label")
def dbscan_whole(spark, d):
    """M9 + A14: DBSCAN(min_samples=5) on the standardized whole vectors, eps from their k-distances."""
    points = _scaled(spark, d)
    return cl.dbscan(spark, points, "vec_id", "z", _radius(points, "z"), MIN_SAMPLES)


@register("cluster_distribution_whole", WHOLE_CTE + "SELECT cluster, count(*) AS n_points FROM label GROUP BY cluster")
def cluster_distribution_whole(spark, d):
    """Points per cluster (noise = -1) of the run on the whole vectors."""
    return dbscan_whole(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n_points"))


@register(
    "cluster_run",
    WHOLE_CTE
    + """SELECT (SELECT eps FROM radius) AS eps, 5 AS min_samples, 0 AS max_users, count(*) AS total_users_available, count(*) AS users_processed, 'random' AS sampling_method,
       count(DISTINCT cluster) FILTER (WHERE cluster >= 0) AS n_clusters, count(*) FILTER (WHERE cluster < 0) AS n_noise FROM label""",
)
def cluster_run(spark, d):
    """The parameters of a clustering run over all users (cap 0: none), and what came out."""
    users = table(spark, d, "embeddings").select("vec_id", "embedding")
    capped = sample_cap(users, "vec_id", 0, "random", SEED)
    points = materialize(spark, cl.standardize(capped, "embedding", "z").select("vec_id", "z"), "scaled")
    eps = _radius(points, "z")
    labels = cl.dbscan(spark, points, "vec_id", "z", eps, MIN_SAMPLES)
    found = labels.agg(F.countDistinct(F.when(F.col("cluster") >= 0, F.col("cluster"))).alias("n_clusters"), F.count_if(F.col("cluster") < 0).alias("n_noise"))
    run = cl.run_parameters(spark, eps, MIN_SAMPLES, 0, users.count(), points.count(), "random")
    return run.crossJoin(found)  # one row each


@register("cluster_report")
def cluster_report(spark, d):
    """M8-M11 + A17: users -> standardized -> PCA to min(50, n - 1, d) -> DBSCAN at their k-distance radius
    -> one row a point with 2-D PCA coordinates and cluster size (PCA has no SQL form)."""
    emb = table(spark, d, "embeddings").select("vec_id", "embedding")
    reduced = materialize(spark, cl.reduce_dims(emb, "embedding", 50).select("vec_id", "reduced"), "reduced")
    labels = cl.dbscan(spark, reduced, "vec_id", "reduced", _radius(reduced, "reduced"), MIN_SAMPLES)
    coords = cl.pca(reduced, "reduced", 2, "xy").select("vec_id", F.col("xy")[0].alias("x"), F.col("xy")[1].alias("y"))
    return cl.cluster_report(labels, coords, "vec_id")


@register(
    "cluster_distribution",
    DBSCAN_SQL.replace(
        "SELECT p.id AS vec_id, CAST(coalesce(cl.cluster, b.cluster, -1) AS BIGINT) AS cluster",
        "SELECT CAST(coalesce(cl.cluster, b.cluster, -1) AS BIGINT) AS cluster, count(*) AS n_points",
    )
    + " GROUP BY 1",
)
def cluster_distribution(spark, d):
    """Points per cluster (noise = -1) of the DBSCAN run."""
    return dbscan(spark, d).groupBy("cluster").agg(F.count(F.lit(1)).alias("n_points"))
