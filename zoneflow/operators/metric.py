"""Metric partition for joins of vectors within a distance.

A tree of pivots is built from a bounded sample.  A point goes to the leaf that
its nearest pivots lead to, over all components.  Two points in different
leaves can only be within ``eps`` if the one is near enough to the other's
leaf, for which three lower bounds are at hand: the point's distance to the
plane between two sibling pivots (at every level), and to the ball around the
leaf's centre that holds all of its points.

Leaves that follow each other in the tree make up regions of at most
``region_bytes`` of vectors (a larger leaf is dealt over several).  A region is
stored once, as one row with the regions that the bounds leave open for it, and
the regions that are open to each other are joined row by row: no point is
written for each region it meets, so the disk grows with the points alone.
There, blocks of ``block_rows`` points meet as far as the bounds allow, each pair
at most once.  A leaf whose ball has a diameter of at most ``eps`` is *dense*: its
points are neighbours of each other without comparison.

The sample steers the work and not the result.  How many of all pairs the bounds
leave open is ``Partition.share``; it falls with the clusteredness of the data, and
in many dimensions without clusters it is near 1 for any such index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.session import materialize


def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """All distances between the rows of x and y."""
    return np.sqrt(np.maximum(0.0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T)))


def within(x: np.ndarray, y: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of x and y lie within eps: by the scalar product, and by the differences where rounding could decide."""
    nx, ny = (x * x).sum(1), (y * y).sum(1)
    # |x|^2 + |y|^2 - 2xy as one product
    square = np.column_stack([-2 * x, nx, np.ones(len(x))]) @ np.column_stack([y, np.ones(len(y)), ny]).T
    slack = 1e-11 * (nx.max(initial=0) + ny.max(initial=0) + eps * eps)
    near = square <= eps * eps - slack
    unsure = (square <= eps * eps + slack) & ~near
    for a, b in (np.argwhere(unsure)[i : i + 10_000].T for i in range(0, int(unsure.sum()), 10_000)):
        near[a, b] = np.sqrt(((x[a] - y[b]) ** 2).sum(1)) <= eps
    return near


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def spread_out(points: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: up to ``n`` distinct points, each the farthest from those before."""
    chosen = [int(np.argmax(((points - points.mean(0)) ** 2).sum(1)))]
    nearest = ((points - points[chosen[0]]) ** 2).sum(1)
    while len(chosen) < n and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


@dataclass
class Node:
    pivots: np.ndarray
    between: np.ndarray  # distances of the pivots
    children: list[Node | int]  # an int is a leaf
    leaves: list[tuple[int, int]]  # first and last leaf below each child


class Tree:
    """Pivots to descend by, and the centres of the leaves."""

    def __init__(self, sample: np.ndarray, leaf_points: int, fanout: int, pivot_choice: int = 512):
        self.centres: list[np.ndarray] = []
        self._rng, self._choice = np.random.default_rng(11), pivot_choice
        self.root = self._grow(sample, leaf_points, fanout)
        self.centres = np.stack(self.centres)

    def _grow(self, points: np.ndarray, leaf_points: int, fanout: int) -> Node | int:
        if len(points) > leaf_points:
            some = points if len(points) <= self._choice else points[self._rng.choice(len(points), self._choice, replace=False)]
            pivots = spread_out(some, min(fanout, -(-len(points) // leaf_points)))
            if len(pivots) > 1:
                # one step towards the middle of what each pivot has
                own = distances(points, pivots).argmin(1)
                pivots = np.unique(np.stack([points[own == k].mean(0) if (own == k).any() else p for k, p in enumerate(pivots)]), axis=0)
                own = distances(points, pivots).argmin(1)
                if len(pivots) > 1 and (np.bincount(own) < len(points)).all():
                    children, leaves = [], []
                    for k in range(len(pivots)):
                        first = len(self.centres)
                        children.append(self._grow(points[own == k], leaf_points, fanout))
                        leaves.append((first, len(self.centres) - 1))
                    return Node(pivots, distances(pivots, pivots), children, leaves)
        self.centres.append(points.mean(0) if len(points) else np.zeros(points.shape[1]))
        return len(self.centres) - 1

    def home(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out, open_ = np.zeros(len(x), np.int64), [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if isinstance(node, int):
                out[rows] = node
            elif len(rows):
                own = distances(x[rows], node.pivots).argmin(1)
                open_ += [(child, rows[own == k]) for k, child in enumerate(node.children)]
        return out

    def reach(self, x: np.ndarray, eps: float, radius: np.ndarray, first: int = 0, last: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of the leaves from ``first`` to ``last`` that may have a point within ``eps`` of the row."""
        last = len(self.centres) - 1 if last is None else last
        slack = eps + 1e-7 * (eps + np.abs(x).max(initial=0.0))
        rows_out, leaves_out, open_ = [], [], [(self.root, np.arange(len(x)))]
        while open_:
            node, rows = open_.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                near = distances(x[rows], self.centres[node][None, :])[:, 0] <= radius[node] + slack
                rows_out.append(rows[near])
                leaves_out.append(np.full(int(near.sum()), node))
                continue
            square = distances(x[rows], node.pivots) ** 2
            for k, child in enumerate(node.children):
                if node.leaves[k][1] < first or node.leaves[k][0] > last:
                    continue
                others = np.arange(len(node.pivots)) != k
                plane = ((square[:, [k]] - square[:, others]) / (2 * node.between[k, others])).max(1)
                open_.append((child, rows[plane <= slack]))
        return np.concatenate(rows_out) if rows_out else np.zeros(0, np.int64), np.concatenate(leaves_out) if leaves_out else np.zeros(0, np.int64)


Work = Callable[[pa.Table, pa.Table, np.ndarray, bool], Iterator[pa.RecordBatch]]


@dataclass
class Regions:
    """Which leaves make up which region: a leaf's first region, and how many it is dealt over."""

    first: np.ndarray
    parts: np.ndarray
    count: int

    @classmethod
    def of(cls, sizes: np.ndarray, rows: int) -> Regions:
        first, parts = np.zeros(len(sizes), np.int64), np.maximum(1, -(-sizes // rows))
        region = filled = 0
        for leaf, n in enumerate(sizes.tolist()):
            if filled and filled + n > rows:
                region, filled = region + 1, 0
            first[leaf] = region
            if parts[leaf] > 1:
                region += int(parts[leaf])
            else:
                filled += n
        return cls(first, parts, region + 1)

    @staticmethod
    def rows(n: int, block_rows: int, most: int) -> int:
        """How many of ``n`` points a region may have: few enough for several tasks, and not more than ``most``."""
        return max(1, min(most, max(block_rows, -(-n // 8))))

    def leaves(self, region: int) -> tuple[int, int]:
        """The first and the last leaf of a region."""
        held = np.flatnonzero((self.first <= region) & (region < self.first + self.parts))
        return (int(held[0]), int(held[-1])) if len(held) else (0, -1)


@dataclass
class Block:
    """Some points of a cell that are met at once, and which leaves of the other region each may have neighbours in."""

    rows: pa.Table
    x: np.ndarray
    leaf: np.ndarray
    flagged: bool
    first: int
    open: np.ndarray

    def reaching(self, other: Block) -> np.ndarray:
        return self.open[:, np.unique(other.leaf) - self.first].any(1)


@dataclass
class Partition:
    homes: DataFrame  # leaf, id, v and further columns
    leaves: DataFrame  # leaf, n, dense
    eps: float
    block_rows: int
    region_bytes: int
    tree: Broadcast[Tree]
    radii: Broadcast[np.ndarray]
    regions: Regions

    def of(self, homes: DataFrame) -> Partition:
        """The partition for some of its points only (a stored table of them)."""
        count = np.zeros(len(self.radii.value), np.int64)
        for row in homes.groupBy("leaf").count().collect():  # leaves of the tree
            count[row["leaf"]] = row["count"]
        most = self.region_bytes // (8 * self.tree.value.centres.shape[1])
        return replace(self, homes=homes, regions=Regions.of(count, Regions.rows(int(count.sum()), self.block_rows, most)))

    def share(self) -> float:
        """How many of all pairs (of a point with another) the bounds leave open."""
        tree, radii, eps = self.tree, self.radii, self.eps

        def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            count = np.zeros(len(radii.value), np.int64)
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    piece = batch.slice(at, 1024)
                    row, leaf = tree.value.reach(matrix(piece.column("v")), eps, radii.value)
                    count += np.bincount(leaf[leaf > piece.column("leaf").to_numpy()[row]], minlength=len(count))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(count)), pa.int32()), pa.array(count)], ["leaf", "guests"])

        guests = self.homes.select("leaf", "v").mapInArrow(visits, "leaf int, guests long").groupBy("leaf").agg(F.sum("guests").alias("guests"))
        met = self.leaves.join(guests, "leaf", "left").withColumn("guests", F.coalesce("guests", F.lit(0)))
        row = met.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("dense"), 0).otherwise(F.col("n") * (F.col("n") - 1) / 2) + F.col("n") * F.col("guests")).alias("met")).first()
        return row.met / (row.n * (row.n - 1) / 2) if row.n and row.n > 1 else 0.0

    def compared(self, work: Work, schema: str, skip_dense: bool = True, columns: tuple[str, ...] = ("id", "v"), only: str | None = None) -> DataFrame:
        """``work(left, right, near, same)`` for blocks of rows that may be near: two blocks, which of their rows are within
        eps, and whether they are one block (each pair is in ``near`` twice then).  With ``skip_dense``, dense leaves' own
        pairs are left out; with ``only`` (a column of booleans), pairs of which neither has it."""
        spark = self.homes.sparkSession
        tree, radii, regions, eps, block_rows = self.tree, self.radii, self.regions, self.eps, self.block_rows
        dense = np.zeros(len(radii.value), bool)
        if skip_dense:
            dense[[r.leaf for r in self.leaves.where("dense").select("leaf").collect()]] = True  # leaves of the tree
        kind = {f.name: f.dataType.simpleString() for f in self.homes.schema}

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                leaf = batch.column("leaf").to_numpy()
                own = regions.first[leaf] + batch.column("hash").to_numpy() % regions.parts[leaf]
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(leaf, pa.int64()), *(batch.column(c) for c in columns)], ["region", "leaf", *columns])

        def packed(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
            """A region as one row: its points as an Arrow stream, and the regions that they may have neighbours in."""
            open_ = np.zeros(regions.count, bool)
            open_[key[0].as_py()] = True
            for at in range(0, rows.num_rows, 1024):
                to = np.unique(tree.value.reach(matrix(rows.column("v").slice(at, 1024)), eps, radii.value)[1])
                for k in range(int(regions.parts[to].max(initial=1))):
                    open_[regions.first[to[regions.parts[to] > k]] + k] = True
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema) as out:
                out.write_table(rows)
            some = bool(rows.column(only).to_numpy().any()) if only else True
            return pa.table({"region": [key[0].as_py()], "open": pa.array([np.flatnonzero(open_)], pa.list_(pa.int64())), "some": [some], "points": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

        def blocks(rows: pa.Table, against: int) -> list[Block]:
            """The rows in the order of their leaves; a large dense leaf and those with ``only`` have blocks of their own."""
            leaf = rows.column("leaf").to_numpy()
            flagged = rows.column(only).to_numpy() if only else np.ones(len(leaf), bool)
            order = np.lexsort((leaf, flagged))
            rows, leaf, flagged = rows.take(pa.array(order)), leaf[order], flagged[order]
            alone = np.where(dense[leaf] & (np.bincount(leaf)[leaf] >= min(256, block_rows)), leaf, -1) if len(leaf) else leaf
            cuts = np.flatnonzero((np.diff(flagged.astype(int)) != 0) | (np.diff(alone) != 0)) + 1
            first, last = regions.leaves(against)
            out = []
            for start, end in zip([0, *cuts], [*cuts, len(leaf)], strict=True):
                for at in range(start, end, block_rows):
                    some = rows.slice(at, min(block_rows, end - at))
                    x = matrix(some.column("v"))
                    open_ = np.zeros((len(x), last - first + 1), bool)
                    row, to = tree.value.reach(x, eps, radii.value, first, last)
                    open_[row, to - first] = True
                    out.append(Block(some, x, leaf[at : at + len(x)], bool(flagged[at]), first, open_))
            return out

        def met(a: Block, b: Block, same: bool) -> Iterator[pa.RecordBatch]:
            if a.leaf[0] == a.leaf[-1] == b.leaf[0] == b.leaf[-1] and dense[a.leaf[0]]:
                return
            left, right = a.reaching(b), b.reaching(a)
            if same:
                left = right = left | right
            if left.any() and right.any():
                near = within(a.x[left], b.x[right], eps)
                if dense[a.leaf].any():
                    near &= ~((a.leaf[left][:, None] == b.leaf[right][None, :]) & dense[a.leaf[left]][:, None])
                if near.any():
                    yield from work(a.rows.filter(pa.array(left)), b.rows.filter(pa.array(right)), near, same)

        def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for n in range(batch.num_rows):
                    i, j = batch.column("i")[n].as_py(), batch.column("j")[n].as_py()
                    left_rows, right_rows = (pa.ipc.open_stream(batch.column(c)[n].as_buffer()).read_all() for c in ("left", "right"))
                    left = blocks(left_rows.drop_columns("region"), j)
                    right = left if i == j else blocks(right_rows.drop_columns("region"), i)
                    for n_a, a in enumerate(left):
                        for n_b, b in enumerate(right):
                            if (i != j or n_a <= n_b) and (a.flagged or b.flagged):
                                yield from met(a, b, i == j and n_a == n_b)

        rest = "".join(f", {c} {kind[c]}" for c in columns)
        rows = self.homes.withColumn("hash", F.xxhash64("id")).mapInArrow(dealt, f"region long, leaf long{rest}")
        # regions are work even where their rows are few; each two parts of the stored table are a task
        parts = max(1, min(regions.count, max(spark.sparkContext.defaultParallelism, regions.count // 4)))
        stored = rows.repartition(parts, "region").groupBy("region").applyInArrow(packed, "region long, open array<long>, some boolean, points binary")
        stored = materialize(spark, stored, "metric-regions")
        left = stored.select(F.col("region").alias("i"), F.col("open").alias("i_open"), F.col("some").alias("i_some"), F.col("points").alias("left"))
        right = stored.select(F.col("region").alias("j"), F.col("open").alias("j_open"), F.col("some").alias("j_some"), F.col("points").alias("right"))
        meet = F.expr("i <= j AND (i_some OR j_some) AND array_contains(i_open, j) AND array_contains(j_open, i)")
        return left.join(right, meet).select("i", "j", "left", "right").mapInArrow(joined, schema)


def partition(points: DataFrame, eps: float, sample_points: int = 100_000, leaf_points: int = 64, fanout: int = 16, block_rows: int = 2048, region_bytes: int = 4 << 20) -> Partition:
    """``points`` (id, v and further columns; vectors of one length, finite) dealt out by a tree from about ``sample_points`` of them."""
    spark = points.sparkSession
    others = [c for c in points.columns if c not in ("id", "v")]
    points = materialize(spark, points, "metric-points")
    n = points.count()
    share = F.pmod(F.xxhash64(F.lit(5), F.col("id")), F.lit(1 << 30)) < int(min(1.0, sample_points / max(1, n)) * (1 << 30))
    sample = matrix(points.where(share).select("v").toArrow().column("v"))
    if not len(sample):
        sample = np.zeros((1, max(1, points.select(F.coalesce(F.max(F.size("v")), F.lit(1))).first()[0])))
    tree = spark.sparkContext.broadcast(Tree(sample, leaf_points, fanout))
    kind = {f.name: f.dataType.simpleString() for f in points.schema}
    rest = "".join(f", {c} {kind[c]}" for c in others)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("v"))
                leaf = tree.value.home(x)
                far = np.sqrt(((x - tree.value.centres[leaf]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(leaf, pa.int32()), pa.array(far), *(batch.column(c) for c in ("id", "v", *others))], ["leaf", "far", "id", "v", *others])

    homes = materialize(spark, points.mapInArrow(placed, f"leaf int, far double, id {kind['id']}, v array<double>{rest}"), "metric-homes")
    sizes = homes.groupBy("leaf").agg(F.count("*").alias("n"), F.max("far").alias("far"))
    # one row a leaf of the tree, which the sample bounds
    radius = np.full(len(tree.value.centres), -np.inf)
    held = sizes.collect()
    for row in held:
        radius[row.leaf] = row.far
    radii = spark.sparkContext.broadcast(radius)
    count = np.zeros(len(radius), np.int64)
    for row in held:
        count[row.leaf] = row.n
    regions = Regions.of(count, Regions.rows(n, block_rows, region_bytes // (8 * sample.shape[1])))
    leaves = sizes.select("leaf", "n", (F.col("far") <= eps / 2 * (1 - 1e-9)).alias("dense"))
    return Partition(homes.drop("far"), materialize(spark, leaves, "metric-leaves"), eps, block_rows, region_bytes, tree, radii, regions)
