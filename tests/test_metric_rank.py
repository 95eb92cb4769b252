"""Metric partition, whole-vector DBSCAN, link ranking and negatives against brute force."""

import functools
import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest

from zoneflow.operators import cluster as cl
from zoneflow.operators import metric
from zoneflow.operators import vectors as vx
from zoneflow.operators.graph import sample, score


def frame(spark, x, kind="double"):
    return spark.createDataFrame([(i, None if v is None else [float(a) for a in v]) for i, v in enumerate(x)], f"id long, v array<{kind}>")


def blobs(rng, n_blobs, n, dim, spread=0.05, box=10):
    return np.concatenate([rng.uniform(-box, box, dim) + rng.normal(0, spread, (n, dim)) for _ in range(n_blobs)])


def expected_labels(x, eps, least):
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= eps
    core = near.sum(1) >= least
    label, next_ = np.full(len(x), -1), 0
    for i in range(len(x)):
        if core[i] and label[i] < 0:
            todo, label[i] = [i], next_
            while todo:
                for j in np.flatnonzero(near[todo.pop()] & core & (label < 0)):
                    label[j] = next_
                    todo.append(j)
            next_ += 1
    for i in np.flatnonzero(~core):
        found = label[np.flatnonzero(near[i] & core)]
        label[i] = found.min() if len(found) else -1
    return label


@pytest.mark.parametrize("block_rows", [7, 2048])
def test_every_near_pair_meets_once(spark, block_rows):
    rng = np.random.default_rng(block_rows)
    x = np.concatenate([blobs(rng, 6, 40, 5, 0.4), rng.uniform(-10, 10, (60, 5)), np.repeat(rng.uniform(-10, 10, (1, 5)), 9, 0)])
    p = metric.partition(frame(spark, x), 1.1, leaf_points=10, block_rows=block_rows)

    def pairs(left, right, near, same):
        a, b = np.nonzero(near)
        import pyarrow as pa

        yield pa.RecordBatch.from_arrays([left.column("id").combine_chunks().take(pa.array(a)), right.column("id").combine_chunks().take(pa.array(b)), pa.array([same] * len(a), pa.bool_())], ["a", "b", "same"])

    rows = p.compared(pairs, "a long, b long, same boolean", skip_dense=False).collect()
    got = Counter((min(r.a, r.b), max(r.a, r.b)) for r in rows if not r.same or r.a <= r.b)
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert got == Counter((a, b) for a, b in np.argwhere(dist <= 1.1).tolist() if a <= b)


def test_clustered_data_compare_few_pairs(spark):
    rng = np.random.default_rng(3)
    x = blobs(rng, 40, 50, 16, 0.1)
    share = metric.partition(frame(spark, x), 0.8).share()
    assert 0 < share < 0.2


@pytest.mark.parametrize("settings", [{}, {"leaf_points": 6, "block_rows": 5}, {"leaf_points": 20, "sample_points": 40}])
def test_dbscan_on_the_partition(spark, monkeypatch, settings):
    monkeypatch.setattr(cl, "partition", functools.partial(metric.partition, **settings))
    rng = np.random.default_rng(len(settings))
    hot = np.repeat(rng.uniform(-5, 5, (2, 4)), [30, 3], 0)  # many copies, and too few for a core
    tight = rng.uniform(-5, 5, 4) + rng.normal(0, 1e-4, (60, 4))  # a dense leaf
    x = np.concatenate([blobs(rng, 5, 25, 4, 0.25, 5), hot, tight, rng.uniform(-6, 6, (50, 4))])
    x = x[rng.permutation(len(x))]
    for eps, least in ((0.6, 5), (0.3, 4), (1.5, 8)):
        expect = expected_labels(x, eps, least)
        got = {r.id: r.cluster for r in cl.dbscan(spark, frame(spark, x), "id", "v", eps, least).collect()}
        assert got == dict(enumerate(expect.tolist()))


def test_dbscan_of_unsound_points_and_empty_table(spark):
    rows = [[0.0, 0.0, 0.0]] * 5 + [[float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [9.0, 9.0, 9.0]]
    got = {r.id: r.cluster for r in cl.dbscan(spark, frame(spark, rows), "id", "v", 0.5, 5).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 0, 4: 0, 5: -1, 6: -1, 7: -1}
    assert cl.near_pairs(frame(spark, rows).limit(0), "id", "v", 1.0).count() == 0


def test_search_equals_brute_force_with_ties_text_ids_and_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-2, 3, (300, 6)).astype(float)  # many equal scores
    x[250:] = x[7]  # and many copies
    rows = [(f"v{i:03d}", v.tolist()) for i, v in enumerate(x)] + [("v900", None), ("v901", [1.0]), ("v902", [float("nan")] * 6)]
    index = spark.createDataFrame(rows, "id string, embedding array<double>")
    asked = [(int(i), x[i].tolist()) for i in rng.choice(300, 40, replace=False)]
    queries = spark.createDataFrame(asked, "query_id long, query_vec array<double>")
    expected = set()
    for q, v in asked:
        scores = []
        for name, w in rows:
            ok = w is not None and len(w) == 6 and np.isfinite(w).all() and any(w) and any(v)
            s = round(float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w)), 6) if ok else None
            scores.append((s is None, -(s or 0), name, s))
        expected |= {(q, name, s, rank) for rank, (_, _, name, s) in enumerate(sorted(scores)[:9], 1)}
    for block_bytes in (1 << 20, 48 * 9):
        got = {tuple(r) for r in vx.search(index.repartition(5), queries, k=9, block_bytes=block_bytes).collect()}
        assert got == expected


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_link_ranks_equal_brute_force(spark, block_bytes):
    rng = np.random.default_rng(7)
    ents = {f"e{i}": rng.integers(-2, 3, 3).astype(float) for i in range(40)}  # ties
    rels = {f"r{i}": rng.integers(-1, 2, 3).astype(float) for i in range(3)}
    known = list({(f"e{rng.integers(0, 6)}", f"r{rng.integers(0, 3)}", f"e{rng.integers(0, 40)}") for _ in range(150)})
    test = known[:25] + [("e39", "r0", "e38"), ("e39", "r0", "e38"), ("e39", "r0", "nowhere"), (None, "r0", "e1")]
    as_rows = lambda m: spark.createDataFrame([(k, v.tolist()) for k, v in m.items()], "id string, embedding array<double>")
    names = "head string, relation string, tail string"
    ranks = score.link_ranking(spark.createDataFrame(test, names), spark.createDataFrame(known, names), as_rows(ents), as_rows(rels), block_bytes=block_bytes)
    have = set(known) | set(test)
    expected = set()
    for h, r, t in set(test):
        if h in ents and t in ents:
            for side in ("head", "tail"):
                s = lambda e, side=side, h=h, r=r, t=t: ((((ents[e] if side == "head" else ents[h]) + rels[r]) - (ents[t] if side == "head" else ents[e])) ** 2).sum()
                true = h if side == "head" else t
                others = [s(e) for e in ents if e != true and ((e, r, t) if side == "head" else (h, r, e)) not in have]
                low, high = 1 + sum(o < s(true) for o in others), 1 + sum(o <= s(true) for o in others)
                expected.add((h, r, t, side, low, high, (low + high) / 2))
    rows = ranks.collect()
    assert {tuple(x) for x in rows} == expected and len(rows) == len(expected)
    metrics = {m.side: m for m in score.ranking_metrics(ranks).collect()}
    both = [x[-1] for x in expected]
    assert metrics["both"].n == len(both)
    assert metrics["both"].mrr == pytest.approx(np.mean([1 / x for x in both]))
    assert metrics["both"].hits_at_3 == pytest.approx(np.mean([x <= 3 for x in both]))


def test_negatives_are_never_known_and_null_only_without_a_candidate(spark):
    n = 12
    full = [(s, 0, 5) for s in range(n)] + [(5, 0, o) for o in range(n)]  # every entity is known as head of 5 and tail of 5
    almost = [(s, 1, 3) for s in range(n - 1)] + [(4, 1, o) for o in range(n) if o != 9]  # one candidate left
    some = [(s, 2, (s * 5 + k) % n) for s, k in itertools.product(range(n), range(3))]
    known = sorted(set(full + almost + some))
    frame = spark.createDataFrame(known, "s long, p long, o long")
    for rounds in (0, 1, 6):
        rows = sample.negatives(spark, frame, frame, n, seed=3, rounds=rounds).collect()
        assert sorted((r.s, r.p, r.o) for r in rows) == known
        heads, tails = defaultdict(set), defaultdict(set)
        for s, p, o in known:
            heads[p, o].add(s)
            tails[s, p].add(o)
        for r in rows:
            if r.ns is None:
                assert len(heads[r.p, r.o]) == n or len(tails[r.s, r.p]) == n
            else:
                assert (r.ns, r.p, r.no) not in set(known)
                assert (r.ns == r.s) != (r.no == r.o) and 0 <= r.ns < n and 0 <= r.no < n
        assert any(r.ns is None for r in rows) and sum(r.ns is not None for r in rows) > len(known) // 2


def test_positions_number_rows_in_order(spark):
    rows = [(i % 7, (i * 37) % 100) for i in range(500)]
    got = sample.positions(spark, spark.createDataFrame(rows, "a int, b int").repartition(6), ["a", "b"]).collect()
    assert sorted(r.pos for r in got) == list(range(500))
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r.pos)] == sorted(rows)


def test_points_without_clusters_are_sent_once_a_region_not_once_a_leaf(spark):
    x = np.random.default_rng(8).uniform(-1, 1, (400, 20))
    p = metric.partition(frame(spark, x), 2.5, leaf_points=4, block_rows=50)
    assert p.leaves.count() > 50 and p.regions.count <= 10
    rows = lambda left, right, near, same: iter(left.select(["id"]).to_batches())
    assert p.compared(rows, "id long").groupBy("id").count().agg({"count": "max"}).first()[0] <= 40


def test_points_are_stored_once_and_not_shuffled_for_each_region(spark):
    x = np.random.default_rng(8).uniform(-1, 1, (400, 20))
    p = metric.partition(frame(spark, x), 2.5, leaf_points=4, block_rows=50)
    met = p.compared(lambda left, right, near, same: iter(left.select(["id"]).to_batches()), "id long")
    plan = met._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "FlatMapGroups" not in plan


def test_whole_vectors_that_differ_in_the_sign_of_zero_are_copies(spark):
    x = [[0.0, 1.0, -0.0], [-0.0, 1.0, 0.0], [0.0, 1.0, 0.0], [0.0, 9.0, 0.0], [-0.0, 9.0, 0.0], [5.0, 5.0, 5.0]]
    got = {r.id: r.cluster for r in cl.dbscan(spark, frame(spark, x), "id", "v", 0.5, 3).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: -1, 4: -1, 5: -1}


def test_regions_hold_bounded_runs_of_leaves_and_parts_of_large_ones():
    r = metric.Regions.of(np.array([3, 4, 2, 25, 1, 9]), 10)
    assert r.first.tolist() == [0, 0, 0, 1, 4, 4] and r.parts.tolist() == [1, 1, 1, 3, 1, 1] and r.count == 5
    assert [r.leaves(k) for k in range(5)] == [(0, 2), (3, 3), (3, 3), (3, 3), (4, 5)]


def test_pairs_without_the_mark_are_left_out(spark):
    x = np.random.default_rng(4).uniform(-1, 1, (120, 3))
    marked = frame(spark, x).selectExpr("id", "v", "id % 3 = 0 AS mark")
    import pyarrow as pa

    def pairs(left, right, near, same):
        a, b = np.nonzero(near)
        yield pa.RecordBatch.from_arrays([left.column("id").combine_chunks().take(pa.array(a)), right.column("id").combine_chunks().take(pa.array(b)), pa.array([same] * len(a), pa.bool_())], ["a", "b", "same"])

    p = metric.partition(marked, 0.5, leaf_points=10, block_rows=20)
    rows = p.compared(pairs, "a long, b long, same boolean", skip_dense=False, columns=("id", "v", "mark"), only="mark").collect()
    got = {(min(r.a, r.b), max(r.a, r.b)) for r in rows if r.a % 3 == 0 or r.b % 3 == 0}
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert got == {(a, b) for a, b in np.argwhere(dist <= 0.5).tolist() if a <= b and (a % 3 == 0 or b % 3 == 0)}


def test_link_ranks_in_tiles_tell_scores_apart_that_single_precision_does_not(spark, monkeypatch):
    monkeypatch.setattr(score, "TILE", 7)
    rng = np.random.default_rng(2)
    base = rng.normal(0, 1, 8)
    ents = {f"e{i}": base + rng.normal(0, 1e-9, 8) * (i % 4) for i in range(30)}
    as_rows = lambda m: spark.createDataFrame([(k, v.tolist()) for k, v in m.items()], "id string, embedding array<double>")
    test = spark.createDataFrame([(f"e{i}", "r", f"e{i + 1}") for i in range(20)], "head string, relation string, tail string")
    ranks = score.link_ranking(test, test, as_rows(ents), as_rows({"r": np.full(8, 0.25)})).where("side = 'tail'")
    square = lambda h, t: ((ents[h] + 0.25 - ents[t]) ** 2).sum()
    for r in ranks.collect():
        others = [square(r.head, e) for e in ents if e != r.tail]
        own = square(r.head, r.tail)
        assert (r.optimistic, r.pessimistic) == (1 + sum(o < own for o in others), 1 + sum(o <= own for o in others))


def test_pools_are_not_broadcast(spark):
    pools = spark.createDataFrame([("film", str(i)) for i in range(50)], "kind string, item string")
    users = spark.createDataFrame([(i,) for i in range(20)], "user long")
    drawn = sample.draw_from_pools(spark, users, "user", pools, {"film": (1, 3)}, seed=1)
    assert "Broadcast" not in drawn._jdf.queryExecution().executedPlan().toString()
    assert drawn.groupBy("user").count().count() == 20
