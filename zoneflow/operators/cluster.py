"""Scaling, PCA, epsilon-neighbours and DBSCAN as distributed jobs
(M7-M11, J10, A14, A17).

DBSCAN semantics follow the usual index-order labelling: a point is core
when at least ``min_samples`` points (itself included) lie within ``eps``;
cores within ``eps`` of each other share a cluster; clusters are numbered
0, 1, ... in the order of their smallest core id; a non-core point within
``eps`` of a core takes the smallest adjacent cluster; the rest is -1.

Neighbour search in many dimensions is a metric partition over all of them
(``operators.metric``).  In two dimensions it is a grid join: a point's cell is ``floor(coord / eps)``
on two coordinates; each point is matched against the 3 x 3 block of cells
around its own (an equi-join on the cell), and the exact distance - over
the full vector, which is never shorter than the 2-D one - filters the
candidates.  Core connectivity is hook / shortcut / contract connected
components (O(log n) rounds); each step is written to the shared
checkpoint folder so lineage stays short.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.operators.graph.sample import dense_index, sample_cap
from zoneflow.operators.metric import matrix, partition
from zoneflow.session import materialize, spread


def standardize(df: DataFrame, vec_col: str = "embedding", out_col: str = "scaled") -> DataFrame:
    """(x - mean) / population std per dimension (zero std -> 1).

    One Summarizer pass (tree aggregation, partial per partition); the
    single statistics row is broadcast back."""
    stats = df.select(
        Summarizer.metrics("mean", "variance", "count").summary(array_to_vector(F.col(vec_col))).alias("s")
    ).select(
        vector_to_array(F.col("s.mean")).alias("__mu"),
        vector_to_array(F.col("s.variance")).alias("__var"),
        F.col("s.count").alias("__n"),
    )
    pop_sd = F.transform(
        "__var",
        lambda v: F.when(F.sqrt(v * (F.col("__n") - 1) / F.col("__n")) == 0, F.lit(1.0)).otherwise(
            F.sqrt(v * (F.col("__n") - 1) / F.col("__n"))
        ),
    )
    stats = stats.select("__mu", pop_sd.alias("__sd"))
    j = df.crossJoin(F.broadcast(stats))  # one row
    centred = F.zip_with(F.col(vec_col), F.col("__mu"), lambda x, m: x.cast("double") - m)
    z = F.zip_with(centred, F.col("__sd"), lambda c, s: c / s)
    return j.select(*df.columns, z.alias(out_col))


def pca(df: DataFrame, vec_col: str, k: int, out_col: str = "pcs") -> DataFrame:
    """Projection on the top-k principal components (input must be
    centred - MLlib's PCA does not centre).  The d x d covariance is
    aggregated distributedly; only it reaches the driver."""
    staged = df.withColumn("__v", array_to_vector(F.col(vec_col)))
    model = PCA(k=k, inputCol="__v", outputCol="__p").fit(staged)
    return model.transform(staged).withColumn(out_col, vector_to_array("__p")).drop("__v", "__p")


def reduce_dims(df: DataFrame, vec_col: str = "embedding", max_components: int = 50) -> DataFrame:
    """Standardize, then PCA to min(max_components, n - 1, d) components."""
    n = df.count()
    d = df.select(F.size(vec_col).alias("d")).first()["d"]
    k = max(1, min(max_components, n - 1, d))
    return pca(standardize(df, vec_col), "scaled", k, "reduced")


def _dist(a: Column, b: Column) -> Column:
    sq = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(sq, F.lit(0.0), lambda acc, v: acc + v))


def eps_pairs(points: DataFrame, id_col: str, vec_col: str, eps: float, include_self: bool = False) -> DataFrame:
    """All (a, b) with distance(a, b) <= eps, via a grid equi-join
    (cells from the first two coordinates) plus the exact distance."""
    p = points.select(
        F.col(id_col).alias("__id"),
        F.transform(F.col(vec_col), lambda x: x.cast("double")).alias("__v"),
    ).withColumns(
        {
            "__cx": F.floor(F.col("__v")[0] / F.lit(eps)),
            "__cy": F.floor(F.col("__v")[1] / F.lit(eps)),
        }
    )
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    left = p.select(
        F.col("__id").alias("a"), F.col("__v").alias("va"), F.explode(offsets).alias("o"), "__cx", "__cy"
    ).select("a", "va", (F.col("__cx") + F.col("o.dx")).alias("cx"), (F.col("__cy") + F.col("o.dy")).alias("cy"))
    right = p.select(F.col("__id").alias("b"), F.col("__v").alias("vb"), F.col("__cx").alias("cx"), F.col("__cy").alias("cy"))
    cand = left.join(right, ["cx", "cy"])
    if not include_self:
        cand = cand.where(F.col("a") != F.col("b"))
    return cand.select("a", "b", _dist(F.col("va"), F.col("vb")).alias("dist")).where(F.col("dist") <= F.lit(eps))


def _vectors(points: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the points that have an id and a vector of finite components."""
    v = F.col(vec_col).cast("array<double>")
    p = points.select(F.col(id_col).alias("id"), v.alias("v")).where("id IS NOT NULL AND v IS NOT NULL")
    return p.where(F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))


def near_pairs(points: DataFrame, id_col: str, vec_col: str, eps: float) -> DataFrame:
    """J10 for vectors of one length with many dimensions, by a metric partition over all of
    them: all (a, b, dist) with a <= b and distance(a, b) <= eps, a point being its
    own neighbour as in DBSCAN.  Points with a null or non-finite component have no neighbour."""
    p = partition(spread(_vectors(points, id_col, vec_col)), eps)

    def work(left: pa.Table, right: pa.Table, near: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        x, y = matrix(left.column("v")), matrix(right.column("v"))
        a, b = np.nonzero(near)
        for i in range(0, len(a), 10_000):
            k, m = a[i : i + 10_000], b[i : i + 10_000]
            dist = np.sqrt(((x[k] - y[m]) ** 2).sum(1))
            ids = (left.column("id").combine_chunks().take(pa.array(k)), right.column("id").combine_chunks().take(pa.array(m)))
            yield pa.RecordBatch.from_arrays([*ids, pa.array(dist), pa.array([same] * len(k))], ["a", "b", "dist", "same"])

    kind = p.homes.schema["id"].dataType.simpleString()
    found = p.compared(work, f"a {kind}, b {kind}, dist double, same boolean", skip_dense=False)
    return found.where("a <= b OR NOT same").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "dist")


def k_distance(points: DataFrame, id_col: str, vec_col: str, k: int, quantile: float, sample_points: int = 200, seed: int = 7) -> float:
    """The ``quantile`` of the distances to the k-th nearest point (itself the first), over a
    bounded sample of points against all of them: a radius for DBSCAN with min_samples = k,
    rounded to hundredths and moved off them, so that no distance sits on the edge."""
    p = _vectors(points, id_col, vec_col)
    asked = sample_cap(p, "id", sample_points, "random", seed).toArrow()
    shared = points.sparkSession.sparkContext.broadcast(matrix(asked.column("v")))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        best = np.full((len(q), k), np.inf)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x = matrix(batch.slice(at, 2048).column("v"))
                d = np.stack([np.sqrt(((x - row) ** 2).sum(1)) for row in q])
                best = np.sort(np.concatenate([best, d], 1), 1)[:, :k]
        row, place = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(best[row, place])], ["q", "dist"])

    found = spread(p).mapInArrow(nearest, "q long, dist double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("dist"))
    kth = found.withColumn("rank", rank).where(F.col("rank") == k)
    at = kth.agg(F.expr(f"percentile_disc({quantile}) WITHIN GROUP (ORDER BY dist)")).first()[0]
    return (round(at, 2) if at is not None else 0.0) + 0.005


def _components(near: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, columns) of each connected part of a bipartite graph."""
    rows = near.any(1)
    columns = np.ones(near.shape[1], bool)
    for r in range(len(near)):
        if not rows[r]:
            continue
        new, in_rows, in_columns = np.array([r]), [], []
        while len(new):
            rows[new] = False
            in_rows.append(new)
            reached = np.flatnonzero(near[new].any(0) & columns)
            columns[reached] = False
            in_columns.append(reached)
            new = np.flatnonzero(near[:, reached].any(1) & rows) if len(reached) else reached
        yield np.concatenate(in_rows), np.concatenate(in_columns)


def _dbscan_pieces(spark: SparkSession, points: DataFrame, id_col: str, vec_col: str, eps: float, min_samples: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Cores (id), edges (src, dst) that connect them as their neighbourhoods do, and (a, b) of the other points with
    the cores near them (fewer than ``min_samples`` each).

    Equal vectors are one point with a weight.  Pairs of regions report sums and spanning edges, never all
    pairs; the points of a dense leaf are neighbours of each other without a look.  Points whose only neighbours
    are their copies have no edge to look for and are left out of the second comparison.
    """
    whole = _vectors(points, id_col, vec_col)
    distinct = whole.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("w"))
    p = partition(distinct, eps)
    kind = whole.schema["id"].dataType.simpleString()
    dense = p.leaves.where("dense").select("leaf")

    def degrees(left: pa.Table, right: pa.Table, near: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        sides = [(left, near @ right.column("w").to_numpy())]
        if not same:
            sides.append((right, near.T @ left.column("w").to_numpy()))
        for rows, found in sides:
            some = found > 0
            yield pa.RecordBatch.from_arrays([rows.column("id").combine_chunks().filter(pa.array(some)), pa.array(found[some], pa.int64())], ["id", "deg"])

    own = p.homes.join(F.broadcast(dense), "leaf")  # leaves of the tree, which its sample bounds
    own = own.join(F.broadcast(own.groupBy("leaf").agg(F.sum("w").alias("deg"))), "leaf").select("id", "deg")
    degree = p.compared(degrees, f"id {kind}, deg long", columns=("id", "v", "w")).unionByName(own).groupBy("id").agg(F.sum("deg").alias("deg"))
    degree = materialize(spark, degree, "dbscan-degrees").withColumn("core", F.col("deg") >= min_samples)
    core = degree.where("core").select("id")
    homes = p.homes.select("leaf", "id", "w").join(degree, "id", "left").withColumn("core", F.coalesce("core", F.lit(False)))
    linked = p.homes.join(degree, "id").where("deg > w").select("leaf", "id", "v", "core")
    linked = p.of(materialize(spark, linked, "dbscan-linked"))

    def links(left: pa.Table, right: pa.Table, near: np.ndarray, same: bool) -> Iterator[pa.RecordBatch]:
        a_ids, b_ids = left.column("id").combine_chunks(), right.column("id").combine_chunks()
        a_core, b_core = left.column("core").to_numpy(), right.column("core").to_numpy()
        for rows, columns in _components(near & a_core[:, None] & b_core[None, :]):
            members = pa.concat_arrays([a_ids.take(pa.array(rows)), b_ids.take(pa.array(columns))])
            first = pa.concat_arrays([members.slice(0, 1)] * len(members))
            yield pa.RecordBatch.from_arrays([first, members, pa.array([True] * len(members))], ["a", "b", "core"])
        a, b = np.nonzero(near & ~a_core[:, None] & b_core[None, :])
        yield pa.RecordBatch.from_arrays([a_ids.take(pa.array(a)), b_ids.take(pa.array(b)), pa.array([False] * len(a), pa.bool_())], ["a", "b", "core"])
        if not same:
            a, b = np.nonzero(near & a_core[:, None] & ~b_core[None, :])
            yield pa.RecordBatch.from_arrays([b_ids.take(pa.array(b)), a_ids.take(pa.array(a)), pa.array([False] * len(a), pa.bool_())], ["a", "b", "core"])

    found = materialize(spark, linked.compared(links, f"a {kind}, b {kind}, core boolean", columns=("id", "v", "core"), only="core"), "dbscan-links")
    # in a dense leaf all cores, and so all points near a core, go with its smallest core
    inside = homes.join(F.broadcast(dense), "leaf")
    least = inside.where("core").groupBy("leaf").agg(F.min("id").alias("least"))
    inside = inside.join(F.broadcast(least), "leaf").select(F.col("id").alias("a"), F.col("least").alias("b"), "core")
    # equal vectors share the core and the cluster of the one that stands for them; digests tell them apart, as groups
    # of vectors do (0.0 and -0.0 are equal), and no vector is shuffled for it
    digest = F.sha2(F.transform("v", lambda x: F.when(x == 0, 0.0).otherwise(x)).cast("string"), 256).alias("digest")
    stands = p.homes.where("w > 1").select("id", digest).join(degree.select("id", "core"), "id", "left")
    stands = stands.select("digest", F.col("id").alias("stands"), F.coalesce("core", F.lit(False)).alias("core"))
    copies = whole.select("id", digest).join(stands, "digest").where("id <> stands")
    copies = copies.select(F.col("id").alias("a"), F.col("stands").alias("b"), "core")
    found = found.unionByName(inside)
    cores = core.unionByName(copies.where("core").select(F.col("a").alias("id")))
    edges = found.unionByName(copies).where("core AND a <> b").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst")).distinct()
    border = found.where("NOT core").select("a", "b")
    of_copies = copies.where("NOT core").join(border.select(F.col("a").alias("s"), F.col("b").alias("near")), F.col("b") == F.col("s")).select("a", F.col("near").alias("b"))
    return cores, edges, border.unionByName(of_copies)


def connected_components(spark: SparkSession, vertices: DataFrame, edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(id) + undirected (src, dst) edges -> (id, root = smallest id of its
    component), in O(log n) rounds of hook / shortcut / contract:

    1. hook: every vertex with an edge points to min(itself, its smallest
       neighbour) - a forest, since pointers only go down;
    2. shortcut: pointer jumping (p <- p(p)) until every vertex points at its
       tree root, which is the tree's smallest id;
    3. contract: edges are rewritten between roots, self-loops dropped, and
       the original vertices' labels follow their root.
    Every non-isolated super-vertex merges each round, so the graph at least
    halves.  Each step is written to the shared folder (short lineage, a
    lost executor recomputes one step)."""
    labels = materialize(spark, vertices.select(F.col("id"), F.col("id").alias("label")), "cc-labels")
    both = edges.select("src", "dst").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    e = materialize(spark, both.where(F.col("src") != F.col("dst")).distinct(), "cc-edges")
    for _ in range(max_rounds):
        if e.limit(1).count() == 0:
            return labels.select("id", F.col("label").alias("root"))
        parent = e.groupBy(F.col("src").alias("v")).agg(F.least(F.col("src"), F.min("dst")).alias("p"))
        parent = materialize(spark, parent.select("v", "p"), "cc-parent")
        while True:
            up = parent.select(F.col("v").alias("pv"), F.col("p").alias("pp"))
            nxt = parent.join(up, parent.p == up.pv, "left").select(
                "v", F.col("p").alias("old"), F.coalesce(F.col("pp"), F.col("p")).alias("p")
            )
            nxt = materialize(spark, nxt, "cc-parent")
            parent = nxt.select("v", "p")
            if nxt.where(F.col("p") != F.col("old")).limit(1).count() == 0:
                break
        ps = parent.select(F.col("v").alias("sv"), F.col("p").alias("sp"))
        pd = parent.select(F.col("v").alias("dv"), F.col("p").alias("dp"))
        moved = (
            e.join(ps, e.src == ps.sv, "left")
            .join(pd, e.dst == pd.dv, "left")
            .select(F.coalesce("sp", "src").alias("src"), F.coalesce("dp", "dst").alias("dst"))
        )
        e = materialize(spark, moved.where(F.col("src") != F.col("dst")).distinct(), "cc-edges")
        relabel = labels.join(parent, labels.label == parent.v, "left").select("id", F.coalesce("p", "label").alias("label"))
        labels = materialize(spark, relabel, "cc-labels")
    raise RuntimeError(f"connected components did not converge in {max_rounds} rounds")


def _dbscan_2d(spark: SparkSession, points: DataFrame, id_col: str, vec_col: str, eps: float, ms: int, k_sub: int = 4) -> DataFrame:
    """Exact DBSCAN for 2-D points without emitting the pairs inside dense
    regions.

    Cells have side eps/sqrt(2) (shrunk by 1e-9 so rounding cannot stretch a
    cell past eps): all points of a cell are mutual neighbours.  A cell with
    >= min_samples points is all-core.  Point pairs are enumerated only from
    points of sparse cells (< min_samples points) to the other cells of their
    5 x 5 block - at most 24 * min_samples partners per dense-cell point.
    Cores of one cell form one vertex (id = its smallest core id).  Two dense
    neighbour cells are linked when some pair of their occupied k x k
    sub-cells is entirely within eps; only for cell pairs without such a
    certain link are the points of the ambiguous sub-cell pairs compared.
    """
    side = eps / math.sqrt(2.0) * (1.0 - 1e-9)
    sub = side / k_sub
    tol = eps * 1e-9
    pts = materialize(
        spark,
        points.select(
            F.col(id_col).alias("id"), F.col(vec_col)[0].cast("double").alias("x"), F.col(vec_col)[1].cast("double").alias("y")
        ).withColumns({"cx": F.floor(F.col("x") / side), "cy": F.floor(F.col("y") / side)}),
        "db-points",
    )
    cells = materialize(spark, pts.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")), "db-cells")
    sparse_pts = pts.join(cells.where(F.col("n") < ms).select("cx", "cy"), ["cx", "cy"], "left_semi")
    off24 = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) != (0, 0)])
    left = sparse_pts.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), "cx", "cy", F.explode(off24).alias("o")).select(
        "a", "ax", "ay", (F.col("cx") + F.col("o.dx")).alias("ncx"), (F.col("cy") + F.col("o.dy")).alias("ncy")
    )
    right = pts.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("cx").alias("ncx"), F.col("cy").alias("ncy"))
    d_ab = F.sqrt((F.col("ax") - F.col("bx")) * (F.col("ax") - F.col("bx")) + (F.col("ay") - F.col("by")) * (F.col("ay") - F.col("by")))
    pairs = materialize(spark, left.join(right, ["ncx", "ncy"]).where(d_ab <= F.lit(eps)).select("a", "b"), "db-pairs")
    # Degree of sparse-cell points = own cell count + partners in other cells.
    partner_n = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m"))
    sparse_deg = sparse_pts.join(cells, ["cx", "cy"]).join(partner_n, sparse_pts.id == partner_n.a, "left").select(
        "id", "cx", "cy", (F.col("n") + F.coalesce(F.col("m"), F.lit(0))).alias("deg")
    )
    dense_cells = cells.where(F.col("n") >= ms).select("cx", "cy")
    cores = materialize(
        spark,
        pts.join(dense_cells, ["cx", "cy"], "left_semi").select("id", "cx", "cy").unionByName(
            sparse_deg.where(F.col("deg") >= ms).select("id", "cx", "cy")
        ),
        "db-cores",
    )
    cell_v = cores.groupBy("cx", "cy").agg(F.min("id").alias("cv"))
    core_v = cores.join(cell_v, ["cx", "cy"]).select("id", "cv")
    # Links through enumerated pairs (one side in a sparse cell).
    ca = core_v.select(F.col("id").alias("a"), F.col("cv").alias("va"))
    cb = core_v.select(F.col("id").alias("b"), F.col("cv").alias("vb"))
    e_pairs = pairs.join(ca, "a").join(cb, "b").select(F.col("va").alias("src"), F.col("vb").alias("dst"))
    # Links between dense neighbour cells via sub-cells.
    dpts = pts.join(dense_cells, ["cx", "cy"], "left_semi").withColumns(
        {"sx": F.floor(F.col("x") / sub), "sy": F.floor(F.col("y") / sub)}
    )
    subs = dpts.groupBy("cx", "cy", "sx", "sy").agg(F.count(F.lit(1)).alias("k"))
    dc = dense_cells.select(F.col("cx").alias("acx"), F.col("cy").alias("acy"), F.explode(off24).alias("o")).select(
        "acx", "acy", (F.col("acx") + F.col("o.dx")).alias("bcx"), (F.col("acy") + F.col("o.dy")).alias("bcy")
    )
    dc = dc.join(dense_cells.select(F.col("cx").alias("bcx"), F.col("cy").alias("bcy")), ["bcx", "bcy"], "left_semi").where(
        (F.col("acx") < F.col("bcx")) | ((F.col("acx") == F.col("bcx")) & (F.col("acy") < F.col("bcy")))
    )
    sa = subs.select(F.col("cx").alias("acx"), F.col("cy").alias("acy"), F.col("sx").alias("asx"), F.col("sy").alias("asy"))
    sb = subs.select(F.col("cx").alias("bcx"), F.col("cy").alias("bcy"), F.col("sx").alias("bsx"), F.col("sy").alias("bsy"))
    gx, gy = F.abs(F.col("asx") - F.col("bsx")), F.abs(F.col("asy") - F.col("bsy"))
    box_min = F.sqrt(F.greatest(gx - 1, F.lit(0)) ** 2 + F.greatest(gy - 1, F.lit(0)) ** 2) * F.lit(sub)
    box_max = F.sqrt((gx + 1) ** 2 + (gy + 1) ** 2) * F.lit(sub)
    sub_pairs = materialize(
        spark,
        dc.join(sa, ["acx", "acy"]).join(sb, ["bcx", "bcy"]).select(
            "acx", "acy", "bcx", "bcy", "asx", "asy", "bsx", "bsy", box_min.alias("dmin"), box_max.alias("dmax")
        ).where(F.col("dmin") <= F.lit(eps + tol)),
        "db-subpairs",
    )
    cell_keys = ["acx", "acy", "bcx", "bcy"]
    certain = sub_pairs.where(F.col("dmax") <= F.lit(eps - tol)).select(*cell_keys).distinct()
    open_pairs = sub_pairs.join(certain, cell_keys, "left_anti")
    pa = dpts.select(F.col("id").alias("a"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("cx").alias("acx"), F.col("cy").alias("acy"), F.col("sx").alias("asx"), F.col("sy").alias("asy"))
    pb = dpts.select(F.col("id").alias("b"), F.col("x").alias("bx"), F.col("y").alias("by"), F.col("cx").alias("bcx"), F.col("cy").alias("bcy"), F.col("sx").alias("bsx"), F.col("sy").alias("bsy"))
    checked = (
        open_pairs.join(pa, ["acx", "acy", "asx", "asy"])
        .join(pb, ["bcx", "bcy", "bsx", "bsy"])
        .where(d_ab <= F.lit(eps))
        .select(*cell_keys)
        .distinct()
    )
    linked = certain.unionByName(checked)
    va = cell_v.select(F.col("cx").alias("acx"), F.col("cy").alias("acy"), F.col("cv").alias("src"))
    vb = cell_v.select(F.col("cx").alias("bcx"), F.col("cy").alias("bcy"), F.col("cv").alias("dst"))
    e_dense = linked.join(va, ["acx", "acy"]).join(vb, ["bcx", "bcy"]).select("src", "dst")
    edges = e_pairs.unionByName(e_dense).where(F.col("src") != F.col("dst"))
    comps = connected_components(spark, cell_v.select(F.col("cv").alias("id")), edges)
    numbered = dense_index(spark, comps.select("root"), "root", "cluster")
    cell_cluster = comps.join(numbered, "root").select(F.col("id").alias("cv"), "cluster")
    core_lab = materialize(spark, core_v.join(cell_cluster, "cv").select("id", "cluster"), "db-core-labels")
    # Borders: non-core points (only in sparse cells) next to a core - in
    # their own cell (all same-cell points are neighbours) or via a pair.
    non_core = sparse_pts.select("id", "cx", "cy").join(cores.select("id"), "id", "left_anti")
    own_cell = non_core.join(
        cores.join(core_lab, "id").groupBy("cx", "cy").agg(F.min("cluster").alias("cluster")), ["cx", "cy"]
    ).select("id", "cluster")
    via_pair = (
        pairs.join(non_core.select(F.col("id").alias("a")), "a")
        .join(core_lab.select(F.col("id").alias("b"), "cluster"), "b")
        .select(F.col("a").alias("id"), "cluster")
    )
    border = own_cell.unionByName(via_pair).groupBy("id").agg(F.min("cluster").alias("cluster"))
    labelled = core_lab.unionByName(border)
    out = pts.select("id").join(labelled, "id", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.col("cluster"), F.lit(-1)).cast("bigint").alias("cluster")
    )
    return out


def dbscan(spark: SparkSession, points: DataFrame, id_col: str, vec_col: str, eps: float, min_samples: int) -> DataFrame:
    """M9: (id, cluster) with -1 for noise; see the module docstring.  2-D
    inputs use the dense-cell grid (no pairs inside dense regions), longer ones
    the metric partition (there, points with a null or non-finite component are noise);
    vectors of differing lengths are never neighbours."""
    dims = points.select(F.min(F.size(vec_col)).alias("lo"), F.max(F.size(vec_col)).alias("hi")).first()
    if dims["lo"] == 2 and dims["hi"] == 2:
        return _dbscan_2d(spark, points, id_col, vec_col, eps, min_samples)
    if dims["lo"] == dims["hi"] and (dims["lo"] or 0) > 2:
        cores, core_edges, border_pairs = _dbscan_pieces(spark, points, id_col, vec_col, eps, min_samples)
    else:
        pairs = materialize(spark, eps_pairs(points, id_col, vec_col, eps, include_self=True).select("a", "b"), "eps-pairs")
        degree = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("deg"))
        cores = degree.where(F.col("deg") >= min_samples).select(F.col("a").alias("id"))
        core_edges = (
            pairs.where(F.col("a") < F.col("b"))
            .join(cores.withColumnRenamed("id", "a"), "a", "left_semi")
            .join(cores.withColumnRenamed("id", "b"), "b", "left_semi")
            .select(F.col("a").alias("src"), F.col("b").alias("dst"))
        )
        border_pairs = pairs.join(cores.withColumnRenamed("id", "a"), "a", "left_anti")
    comps = connected_components(spark, cores, core_edges)
    numbered = dense_index(spark, comps.select("root"), "root", "cluster")
    core_lab = comps.join(numbered, "root").select("id", "cluster")
    border = (
        border_pairs.join(core_lab.withColumnRenamed("id", "b"), "b")
        .groupBy("a")
        .agg(F.min("cluster").alias("cluster"))
        .select(F.col("a").alias("id"), "cluster")
    )
    labelled = core_lab.unionByName(border)
    out = points.select(F.col(id_col)).join(labelled.withColumnRenamed("id", id_col), id_col, "left")
    return out.select(id_col, F.coalesce(F.col("cluster"), F.lit(-1)).cast("bigint").alias("cluster"))


def cluster_report(labels: DataFrame, coords: DataFrame, id_col: str, noise: int = -1) -> DataFrame:
    """One flat row per point - cluster, 2-D coordinates and
    the cluster's size (the distribution is a group count joined back;
    plotting groups are read from this table, not collected per cluster)."""
    sizes = labels.groupBy("cluster").agg(F.count(F.lit(1)).alias("cluster_size"))
    return labels.join(coords, id_col).join(sizes, "cluster").withColumn("is_noise", F.col("cluster") == noise)


def run_parameters(spark: SparkSession, eps: float, min_samples: int, max_users: int, users_available: int, users_processed: int, sampling: str) -> DataFrame:
    """The one-row parameter record of a clustering run."""
    return spark.createDataFrame(
        [(float(eps), int(min_samples), int(max_users), int(users_available), int(users_processed), sampling)],
        "eps double, min_samples int, max_users int, total_users_available bigint, users_processed bigint, sampling_method string",
    )
