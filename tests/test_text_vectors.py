import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.functions import stopwords
from zoneflow.operators import cluster as cl
from zoneflow.operators import text as tx
from zoneflow.operators import vectors as vx
from zoneflow.sources import sinks
from zoneflow.session import scratch_path

DOCS = [
    (1, "g", "apple banana apple cherry the and"),
    (2, "g", "banana banana date"),
    (3, "g", "cherry date egg fig"),
    (4, "g", "apple fig fig fig"),
    (5, "h", "kiwi lime kiwi"),
    (6, "h", ""),
]


def brute_keywords(docs, top_n, per_doc=3, max_features=5000):
    out = {}
    for g in sorted({d[1] for d in docs}):
        texts = [(i, t) for i, gg, t in docs if gg == g]
        toks = {i: [w for w in re.findall(r"\b\w\w+\b", t.lower()) if w not in set(stopwords.ENGLISH)] for i, t in texts}
        total = Counter(w for ws in toks.values() for w in ws)
        vocab = {w for w, _ in sorted(total.items(), key=lambda kv: (-kv[1], kv[0]))[:max_features]}
        df = Counter(w for ws in toks.values() for w in set(ws))
        n = len(texts)
        best = Counter()
        for i, ws in toks.items():
            tf = Counter(w for w in ws if w in vocab)
            scored = sorted(((-c * (math.log((1 + n) / (1 + df[w])) + 1), w) for w, c in tf.items()))
            best.update(w for _, w in scored[:per_doc])
        out[g] = [w for w, _ in sorted(best.items(), key=lambda kv: (-kv[1], kv[0]))[:top_n]]
    return out


def test_corpus_keywords_vs_brute_force(spark):
    df = spark.createDataFrame(DOCS, "doc_id int, lang string, text string")
    got = {}
    for r in tx.corpus_keywords(df, "doc_id", ["text"], top_n=3, group_cols=["lang"]).orderBy("lang", "rank").collect():
        got.setdefault(r.lang, []).append(r.term)
    assert got == brute_keywords(DOCS, 3)


def test_tagging_substring(spark):
    docs = spark.createDataFrame([(1, "g", "Pineapple pie"), (2, "h", "apple")], "doc_id int, lang string, text string")
    kw = spark.createDataFrame([("g", "apple"), ("h", "pie")], "lang string, term string")
    got = sorted(map(tuple, tx.tag_documents(docs, "doc_id", "text", kw, on=["lang"]).collect()))
    assert got == [(1, "apple")]


def brute_dbscan(pts, eps, min_samples):
    n = len(pts)
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    nb = [np.where(d[i] <= eps)[0] for i in range(n)]
    core = np.array([len(x) >= min_samples for x in nb])
    labels = -np.ones(n, dtype=int)
    c = 0
    for i in range(n):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        labels[i] = c
        while stack:
            j = stack.pop()
            if not core[j]:
                continue
            for k in nb[j]:
                if labels[k] == -1:
                    labels[k] = c
                    if core[k]:
                        stack.append(k)
        c += 1
    return labels


def test_dbscan_vs_brute_force(spark):
    rng = np.random.default_rng(5)
    blob_a = rng.normal([0, 0], 0.05, (25, 2))
    blob_b = rng.normal([1, 1], 0.05, (25, 2))
    border = np.array([[0.0, 0.33]])
    noise = np.array([[5.0, 5.0], [-3.0, 2.0]])
    pts = np.vstack([blob_b, blob_a, border, noise])  # blob b first: labels follow index order
    df = spark.createDataFrame([(i, [float(x), float(y)]) for i, (x, y) in enumerate(pts)], "id long, v array<double>")
    got = {r.id: r.cluster for r in cl.dbscan(spark, df, "id", "v", 0.3, 5).collect()}
    expect = brute_dbscan(pts, 0.3, 5)
    assert [got[i] for i in range(len(pts))] == list(expect)


def test_dbscan_expected_counts_sf001(spark, sf01):
    from zoneflow.plans.vector_plans import dbscan

    out = dbscan(spark, sf01)
    counts = {r.c: r.n for r in out.groupBy((F.col("cluster") >= 0).alias("c")).agg(F.count("*").alias("n")).collect()}
    assert out.where(F.col("cluster") >= 0).select("cluster").distinct().count() == 19
    assert counts[True] == 85 + 68 and counts[False] == 347


def test_whole_vector_clustering_vs_brute_force(spark, tmp_path):
    from zoneflow.plans import vector_plans as vp

    rng = np.random.default_rng(9)
    x = rng.normal(0, 1, (150, 64))
    for k in range(3):  # groups that the first two dimensions do not tell apart
        x[k * 30 : k * 30 + 25, 2:] = rng.normal(0, 1, 62) * 2 + rng.normal(0, 0.3, (25, 62))
        x[k * 30 : k * 30 + 25, :2] *= 0.1
    x = x[rng.permutation(len(x))]
    x[100:108] = x[100]
    spark.createDataFrame([(i, [float(a) for a in v], 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    d = str(tmp_path)
    z = (x - x.mean(0)) / x.std(0)
    pts = z @ np.linalg.svd(z, full_matrices=False)[2][:50].T
    for points, column, frame in ((z, "z", vp._scaled(spark, d)), (pts, "reduced", None)):
        dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
        radius = lambda q, dist=dist: round(np.sort(np.sort(dist, 1)[:, 4])[int(np.ceil(q * 150)) - 1], 2) + 0.005
        eps = radius(0.1)
        expect = brute_dbscan(points, eps, 5)
        assert (expect == -1).any() and expect.max() >= 0
        if frame is None:
            assert {r.vec_id: (r.cluster, r.cluster_size) for r in vp.cluster_report(spark, d).collect()} == {i: (c, (expect == c).sum()) for i, c in enumerate(expect)}
            continue
        assert {r.vec_id: r.cluster for r in vp.dbscan_whole(spark, d).collect()} == dict(enumerate(expect))
        assert {r.cluster: r.n_points for r in vp.cluster_distribution_whole(spark, d).collect()} == Counter(expect.tolist())
        wide = radius(0.5)  # half of the points are cores
        assert cl.k_distance(frame, "vec_id", column, 5, 0.5) == pytest.approx(wide)
        pairs = {(r.a, r.b): r.dist for r in cl.near_pairs(frame, "vec_id", column, wide).collect()}
        assert set(pairs) == {(a, b) for a, b in np.argwhere(dist <= wide).tolist() if a <= b}
        assert all(abs(dist[k] - v) < 1e-9 for k, v in pairs.items())
        expect = brute_dbscan(points, wide, 5)
        assert expect.max() >= 2
        assert {r.vec_id: r.cluster for r in cl.dbscan(spark, frame, "vec_id", column, wide, 5).collect()} == dict(enumerate(expect))


def test_eps_pairs_vs_brute_force(spark):
    rng = np.random.default_rng(1)
    pts = rng.uniform(0, 1, (150, 3))
    df = spark.createDataFrame([(i, [float(v) for v in p]) for i, p in enumerate(pts)], "id long, v array<double>")
    got = {(r.a, r.b) for r in cl.eps_pairs(df, "id", "v", 0.12).collect()}
    d = np.sqrt(((pts[:, None, :] - pts[None, :, :]) ** 2).sum(-1))
    expect = {(i, j) for i in range(150) for j in range(150) if i != j and d[i, j] <= 0.12}
    assert got == expect


def test_search_vs_brute_force(spark):
    rng = np.random.default_rng(2)
    vecs = rng.normal(size=(60, 8))
    idx = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, embedding array<double>")
    q = spark.createDataFrame([(100, [float(x) for x in vecs[3]])], "query_id long, query_vec array<double>")
    got = [r.id for r in vx.search(idx, q, k=5).orderBy("rank").collect()]
    sims = vecs @ vecs[3] / (np.linalg.norm(vecs, axis=1) * np.linalg.norm(vecs[3]))
    assert got == list(np.argsort(-sims)[:5])


def test_standardize_population_std(spark):
    df = spark.createDataFrame([(0, [1.0, 5.0]), (1, [3.0, 5.0])], "id int, embedding array<double>")
    z = {r.id: r.scaled for r in cl.standardize(df).collect()}
    assert z[0] == [-1.0, 0.0] and z[1] == [1.0, 0.0]


def test_batched_upsert_retries(spark):
    recs = spark.createDataFrame(
        [(f"d{i}", "x" * (50 if i == 3 else 5), "s") for i in range(10)], "_id string, text_to_embed string, source string"
    ).coalesce(1)
    out = {r._id: r.status for r in sinks.batched_upsert(recs, lambda: sinks.Preflight(10), batch_size=4).collect()}
    assert out["d3"] == "failed" and sum(1 for s in out.values() if s == "sent") == 9


def test_ntriples_roundtrip_escapes(spark):
    rows = [("http://e/s", "http://e/p", 'say "hi"\nback\\slash', "literal", "string"), ("http://e/s", "http://e/q", "http://e/o", "iri", None)]
    t = spark.createDataFrame(rows, "subject string, predicate string, object string, object_kind string, datatype string")
    path = scratch_path(spark, "t-nt")
    sinks.write_ntriples(t, path)
    back = sorted(tuple(r) for r in sinks.read_ntriples(spark, path).collect())
    assert back == sorted(rows, key=lambda r: r)


def test_read_ntriples_empty_raises(spark):
    import pytest

    path = scratch_path(spark, "t-nt-empty")
    spark.createDataFrame([], "value string").write.text(path)
    with pytest.raises(ValueError):
        sinks.read_ntriples(spark, path)


def _union_find_roots(n, edges):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    roots = {}
    for v in range(n):
        roots.setdefault(find(v), []).append(v)
    return {v: min(members) for members in roots.values() for v in members}


def test_connected_components_vs_union_find(spark):
    rng = np.random.default_rng(11)
    n = 300
    path = [(i, i + 1) for i in range(0, 60)]  # long path: many rounds for label propagation
    star = [(100, j) for j in range(101, 140)]
    rand = [tuple(int(x) for x in rng.integers(150, n, 2)) for _ in range(120)]
    edges = path + star + rand + [(299, 0)]
    vertices = spark.range(n)
    e = spark.createDataFrame(edges, "src long, dst long")
    got = {r.id: r.root for r in cl.connected_components(spark, vertices, e).collect()}
    assert got == _union_find_roots(n, edges)


def test_dbscan_dense_cells_vs_brute_force(spark):
    rng = np.random.default_rng(7)
    hot = rng.normal([0, 0], 0.08, (500, 2))  # many dense cells next to each other
    ring_t = rng.uniform(0, 2 * np.pi, 160)
    ring = np.c_[2 + 0.5 * np.cos(ring_t), 2 + 0.5 * np.sin(ring_t)]  # thin dense ring
    bridge = np.c_[np.linspace(0.3, 1.6, 14), np.linspace(0.3, 1.6, 14)]  # sparse chain
    two_blobs = np.vstack([rng.normal([5, 5], 0.01, (40, 2)), rng.normal([5.13, 5], 0.01, (40, 2))])  # close, not touching
    noise = rng.uniform(-3, 8, (40, 2))
    pts = np.vstack([ring, hot, bridge, two_blobs, noise])
    perm = rng.permutation(len(pts))
    pts = pts[perm]
    df = spark.createDataFrame([(i, [float(x), float(y)]) for i, (x, y) in enumerate(pts)], "id long, v array<double>")
    for eps, ms in [(0.1, 5), (0.05, 8)]:
        got = {r.id: r.cluster for r in cl.dbscan(spark, df, "id", "v", eps, ms).collect()}
        expect = brute_dbscan(pts, eps, ms)
        assert [got[i] for i in range(len(pts))] == list(expect), (eps, ms)


def test_search_in_query_blocks_and_zero_vectors(spark):
    vecs = [(i, [float(i % 5), float(i % 3), 1.0]) for i in range(30)] + [(30, [0.0, 0.0, 0.0])]
    index = spark.createDataFrame(vecs, "id long, embedding array<float>")
    queries = index.select(F.col("id").alias("query_id"), F.col("embedding").alias("query_vec"))
    whole = sorted(map(str, vx.search(index, queries, k=4, exclude_self=True).collect()))
    assert whole == sorted(map(str, vx.search(index, queries, k=4, exclude_self=True, block_bytes=7 * 24).collect()))
    last = [r for r in vx.search(index, queries.where("query_id = 1"), k=31).collect() if r.id == 30]
    assert last[0].score is None and last[0]["rank"] == 31
    assert vx.search(index, queries.limit(0), k=4).count() == 0
