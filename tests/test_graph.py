from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE
from zoneflow.operators.graph import mapping as gm
from zoneflow.operators.graph import metrics, pattern, rdfs, sample, tbox


def test_tbox_counts():
    ax = tbox.axioms()
    assert len(ax) == 113
    assert sum(1 for _, p, _ in ax if p == tbox.RDFS_DOMAIN) == 46
    assert sum(1 for _, p, _ in ax if p == tbox.RDFS_SUBCLASS) == 18
    assert sum(1 for _, p, _ in ax if p == tbox.RDFS_SUBPROPERTY) == 3
    has_genre = [(p, d, r) for p, d, r in tbox.PROPERTIES if p == "has_genre"][0]
    assert has_genre == ("has_genre", "Movie", "Genre")  # Q14 fixed


def _abox(spark):
    rows = [
        (ONT + "x/league1", RDF_TYPE, ONT + "League", "iri", None),
        (ONT + "x/u1", ONT + "user_name", "Ann", "literal", "string"),
        (ONT + "x/u1", ONT + "likes_movie", ONT + "x/f1", "iri", None),
        (ONT + "x/f1", ONT + "movie_title", "Up", "literal", "string"),
    ]
    return spark.createDataFrame(rows, tbox.TRIPLE_SCHEMA)


def test_rdfs_inference_and_fixpoint(spark):
    tb = tbox.tbox_triples(spark)
    closure = rdfs.materialize(spark, _abox(spark), tb)
    types = {(r.subject, r.object) for r in closure.where(F.col("predicate") == RDF_TYPE).collect()}
    assert (ONT + "x/league1", ONT + "Competition") in types  # 2-level subclass
    assert (ONT + "x/league1", ONT + "Sports") in types
    assert (ONT + "x/u1", ONT + "User") in types  # domain
    assert (ONT + "x/f1", ONT + "Movie") in types  # range on an IRI
    assert (ONT + "x/u1", "http://xmlns.com/foaf/0.1/Person") in types
    assert not any(s == "Ann" or s == "Up" for s, _ in types)  # literals never typed
    names = closure.where(F.col("predicate") == "http://xmlns.com/foaf/0.1/name").count()
    assert names == 1  # user_name subPropertyOf foaf:name
    again = rdfs.materialize(spark, closure, tb)
    assert again.count() == closure.count()  # fix-point


def test_kg_metrics_tbox_only(spark):
    empty = spark.createDataFrame([], tbox.TRIPLE_SCHEMA)
    m = metrics.kg_metrics(rdfs.materialize(spark, empty, tbox.tbox_triples(spark))).first()
    assert m["n_classes"] == 21  # 22 in the source ontology minus the 'Referees' typo (Q15)
    assert m["n_properties"] == 46
    assert m["n_users"] == 0


def test_mapping_conditional_class_and_guard(spark):
    df = spark.createDataFrame([(1, "cup", None), (2, "league", "x")], "id int, kind string, name string")
    tm = gm.TableMap(
        F.concat(F.lit("s"), F.col("id").cast("string")),
        F.when(F.col("kind") == "cup", F.lit(ONT + "Cup")).otherwise(F.lit(ONT + "League")),
        [gm.literal("competition_name", F.col("name"))],
        guard=F.col("id") > 0,
    )
    out = {(r.subject, r.predicate, r.object) for r in gm.map_tables([(df, tm), (df, tm)]).collect()}
    assert out == {("s1", RDF_TYPE, ONT + "Cup"), ("s2", RDF_TYPE, ONT + "League"), ("s2", ONT + "competition_name", "x")}


def test_match_path_and_restrict(spark):
    t = spark.createDataFrame(
        [("u1", "p", "x1", "iri", None), ("x1", "n", "A", "literal", "string"), ("u2", "p", "x1", "iri", None)],
        tbox.TRIPLE_SCHEMA,
    )
    path = pattern.match_path(t, ["p", "n"], "start", "name")
    listed = spark.createDataFrame([("u1",)], "u string")
    assert [tuple(r) for r in pattern.restrict_to(path, "start", listed, "u").collect()] == [("u1", "A")]


def test_sample_k_per_key_properties(spark):
    keys = spark.range(200).withColumnRenamed("id", "k")
    items = spark.range(7).withColumnRenamed("id", "item")
    a = sample.sample_k_per_key(spark, keys, "k", items, "item", 1, 3, seed=1)
    got = {}
    for r in a.collect():
        got.setdefault(r.k, []).append(r.item)
    assert set(got) == set(range(200))
    assert all(1 <= len(v) <= 3 and len(set(v)) == len(v) for v in got.values())
    b = sample.sample_k_per_key(spark, keys, "k", items, "item", 1, 3, seed=1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    # k capped by the number of items
    few = sample.sample_k_per_key(spark, keys, "k", spark.range(2).withColumnRenamed("id", "item"), "item", 3, 3, seed=2)
    assert few.count() == 400


def test_dense_index(spark):
    df = spark.createDataFrame([(s,) for s in ["d", "b", "a", "c", "b"]], "v string")
    idx = {r.v: r.idx for r in sample.dense_index(spark, df, "v").collect()}
    assert idx == {"a": 0, "b": 1, "c": 2, "d": 3}


def test_split_keeps_every_entity_in_train(spark, sf001):
    from zoneflow.plans.graph_plans import kg_triples

    out = sample.split_with_negatives(spark, kg_triples(spark, sf001), 500, seed=3)
    train = out.where(F.col("split") == "train")
    ents = out.select(F.col("subject").alias("e")).union(out.select(F.col("object").alias("e"))).distinct()
    covered = train.select(F.col("subject").alias("e")).union(train.select(F.col("object").alias("e"))).distinct()
    assert ents.subtract(covered).count() == 0
    assert out.where(F.col("split") == "test").count() > 0


def test_hierarchy_closure_deep_chain_and_cycle(spark):
    p = tbox.RDFS_SUBCLASS
    chain = [(f"c{i:03d}", p, f"c{i + 1:03d}") for i in range(200)]
    ring = [(f"r{i}", p, f"r{j}") for i in range(6) for j in range(6) if i != j]
    edges = spark.createDataFrame(chain + ring, "subject string, predicate string, object string")
    got = {tuple(r) for r in rdfs.hierarchy_closure(spark, edges, p).collect()}
    above = {(f"c{i:03d}", f"c{j:03d}") for i in range(201) for j in range(i + 1, 201)}
    assert got == above | {(f"r{i}", f"r{j}") for i in range(6) for j in range(6)}
    assert rdfs.hierarchy_closure(spark, edges, "other").count() == 0


def test_sample_k_per_key_with_a_wide_range(spark):
    keys = spark.range(50).withColumnRenamed("id", "k")
    items = spark.range(40).withColumnRenamed("id", "item")
    out = sample.sample_k_per_key(spark, keys, "k", items, "item", 0, 30, seed=4).groupBy("k").agg(F.count("item").alias("n"), F.count_distinct("item").alias("d"))
    assert all(r.n == r.d <= 30 for r in out.collect())
    assert sample.sample_k_per_key(spark, keys, "k", items.limit(0), "item", 1, 3).count() == 0
