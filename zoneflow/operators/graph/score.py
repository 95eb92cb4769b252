"""TransE scoring ||h + r - t|| over embedding arrays (row by row, JVM-side)
and the filtered ranks of links among all entities (blocks of packed vectors)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.blocks import BLOCK_BYTES, in_query_blocks
from zoneflow.operators.graph.sample import positions
from zoneflow.operators.metric import matrix
from zoneflow.session import materialize, spread


TILE = 2048  # links and entities that are met at once


def l2_distance(a: Column, b: Column) -> Column:
    diff2 = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(diff2, F.lit(0.0), lambda acc, v: acc + v))


def transe_score(
    triples: DataFrame,
    entities: DataFrame,
    relations: DataFrame,
    head: str = "head",
    rel: str = "relation",
    tail: str = "tail",
    id_col: str = "id",
    vec_col: str = "embedding",
) -> DataFrame:
    """Score = ||e(h) + e(r) - e(t)|| (lower is more plausible).  Entity
    vectors are gathered by two equi-joins; relation vectors (a small,
    schema-sized table) by a third."""
    e = entities.select(F.col(id_col), F.col(vec_col))
    hv = e.select(F.col(id_col).alias(head), F.col(vec_col).alias("__h"))
    tv = e.select(F.col(id_col).alias(tail), F.col(vec_col).alias("__t"))
    rv = relations.select(F.col(id_col).alias(rel), F.col(vec_col).alias("__r"))
    j = triples.join(hv, head).join(tv, tail).join(rv, rel)
    translated = F.zip_with(F.col("__h"), F.col("__r"), lambda x, y: x.cast("double") + y.cast("double"))
    return j.select(*triples.columns, l2_distance(translated, F.col("__t")).alias("score"))


def _square(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of x and y, always summed in one way."""
    return ((x - y) ** 2).sum(-1)


def link_ranking(
    test: DataFrame,
    known: DataFrame,
    entities: DataFrame,
    relations: DataFrame,
    head: str = "head",
    rel: str = "relation",
    tail: str = "tail",
    id_col: str = "id",
    vec_col: str = "embedding",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Filtered ranks of the true tail and of the true head of every ``test`` triple among all entities.

    (head, relation, tail, side, optimistic, pessimistic, realistic): one plus
    the entities that score better, or at least as well, than the true one, and
    the mean of both; entities that make another ``known`` (or test) triple do
    not count.  All entities are counted in blocks: tasks hold a block of the
    translated vectors, read the entities once and report two counts for each
    link.  Known triples need no such pass: within a (side, relation, anchor)
    the ones that score better are a place in their order.  A triple without a
    vector for one of its parts has no rank; repeated triples count once."""
    spark = test.sparkSession
    names = {head: "h", rel: "r", tail: "t"}
    plain = lambda df: df.select(*(F.col(c).alias(n) for c, n in names.items())).dropna().distinct()
    triples = plain(known).withColumn("asked", F.lit(False)).unionByName(plain(test).withColumn("asked", F.lit(True)))
    triples = triples.groupBy("h", "r", "t").agg(F.max("asked").alias("asked"))
    vectors = entities.select(F.col(id_col).alias("e"), F.col(vec_col).cast("array<double>").alias("v")).where("e IS NOT NULL AND v IS NOT NULL")
    vectors = materialize(spark, spread(vectors), "rank-entities")
    rel_vectors = relations.select(F.col(id_col).alias("r"), F.col(vec_col).cast("array<double>").alias("rv"))
    whole = triples.join(rel_vectors, "r").join(vectors.select(F.col("e").alias("h"), F.col("v").alias("hv")), "h").join(vectors.select(F.col("e").alias("t"), F.col("v").alias("tv")), "t")
    tail_side = whole.select("h", "r", "t", "asked", F.lit("tail").alias("side"), F.zip_with("hv", "rv", lambda x, y: x + y).alias("q"), F.col("tv").alias("truth"))
    head_side = whole.select("h", "r", "t", "asked", F.lit("head").alias("side"), F.zip_with("tv", "rv", lambda x, y: x - y).alias("q"), F.col("hv").alias("truth"))
    both = tail_side.unionByName(head_side)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            square = _square(matrix(batch.column("q")), matrix(batch.column("truth")))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("h", "r", "t", "asked", "side", "q")), pa.array(square)], ["h", "r", "t", "asked", "side", "q", "square"])

    kind = {f.name: f.dataType.simpleString() for f in both.schema}
    schema = f"h {kind['h']}, r {kind['r']}, t {kind['t']}, asked boolean, side string, q array<double>, square double"
    links = materialize(spark, both.mapInArrow(scored, schema), "rank-links")

    # known links that score better or the same: places in the order of each anchor's links
    anchor = F.when(F.col("side") == "tail", F.col("h").cast("string")).otherwise(F.col("t").cast("string")).alias("anchor")
    ordered = positions(spark, links.select("h", "r", "t", "asked", "side", anchor, "square"), ["side", "r", "anchor", "square"])
    begins = ordered.groupBy("side", "r", "anchor").agg(F.min("pos").alias("begin"))
    equals = ordered.groupBy("side", "r", "anchor", "square").agg(F.min("pos").alias("first"), F.count("*").alias("equal_known"))
    asked = ordered.where("asked").join(begins, ["side", "r", "anchor"]).join(equals, ["side", "r", "anchor", "square"])
    asked = asked.select("h", "r", "t", "side", (F.col("first") - F.col("begin")).alias("better_known"), "equal_known")

    queries = materialize(spark, links.where("asked").select(F.monotonically_increasing_id().alias("n"), "h", "r", "t", "side", "q", "square"), "rank-queries")
    dim = queries.agg(F.coalesce(F.max(F.size("q")), F.lit(1))).first()[0]

    def against(block: pa.Table) -> DataFrame:
        shared = spark.sparkContext.broadcast((block.column("n").to_numpy(), matrix(block.column("q")), block.column("square").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n, q, own = shared.value
            better, equal = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            norms = (q * q).sum(1)
            for batch in batches:
                for at in range(0, batch.num_rows if len(n) else 0, TILE):
                    x = matrix(batch.slice(at, TILE).column("v"))
                    lengths = (x * x).sum(1)
                    largest = 2 * (norms.max() + lengths.max(initial=0.0)) + own.max()
                    # halves of the precision do where numbers fit them: what rounding could decide is summed anew
                    kind, slack = (np.float32, 4e-6 * largest + 1e-30) if largest < 1e30 else (np.float64, 1e-11 * largest)
                    against = np.column_stack([x, np.ones(len(x)), lengths]).astype(kind).T
                    for start in range(0, len(n), TILE):
                        some = slice(start, start + TILE)
                        # |q|^2 + |x|^2 - 2qx less the link's own square, as one product
                        gap = np.column_stack([-2 * q[some], norms[some] - own[some], np.ones(len(q[some]))]).astype(kind) @ against
                        surely, open_ = gap < -slack, gap <= slack
                        sure = np.count_nonzero(surely, 1)
                        better[some] += sure
                        maybe = np.count_nonzero(open_, 1)
                        if (maybe > sure).any():
                            # those are summed as the links' own scores were
                            pairs = np.argwhere(open_ & ~surely)
                            for a, b in (pairs[i : i + 10_000].T for i in range(0, len(pairs), 10_000)):
                                exact = _square(q[start + a], x[b]) - own[start + a]
                                better += np.bincount(start + a[exact < 0], minlength=len(n))
                                equal += np.bincount(start + a[exact == 0], minlength=len(n))
            yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(better), pa.array(equal)], ["n", "better", "equal"])

        return vectors.select("v").mapInArrow(run, "n long, better long, equal long")

    counts = in_query_blocks(queries.select("n", "q", "square"), "n", 8 * dim + 16, against, block_bytes).groupBy("n").agg(F.sum("better").alias("better"), F.sum("equal").alias("equal"))
    found = queries.select("n", "h", "r", "t", "side").join(counts, "n").join(asked, ["h", "r", "t", "side"])
    optimistic = F.lit(1) + F.col("better") - F.col("better_known")
    pessimistic = optimistic + F.col("equal") - F.col("equal_known")
    found = found.withColumns({"optimistic": optimistic, "pessimistic": pessimistic}).withColumn("realistic", (F.col("optimistic") + F.col("pessimistic")) / 2)
    return found.select(*(F.col(n).alias(c) for c, n in names.items()), "side", "optimistic", "pessimistic", "realistic")


def ranking_metrics(ranks: DataFrame, ks: tuple[int, ...] = (1, 3, 10)) -> DataFrame:
    """Mean rank, mean reciprocal rank and hits@k of ``link_ranking``'s realistic ranks, for each side and both."""
    rank = F.col("realistic")
    hits = [F.avg((rank <= k).cast("double")).alias(f"hits_at_{k}") for k in ks]
    both = ranks.withColumn("side", F.explode(F.array("side", F.lit("both"))))
    return both.groupBy("side").agg(F.count("*").alias("n"), F.avg(rank).alias("mean_rank"), F.avg(1 / rank).alias("mrr"), *hits)
