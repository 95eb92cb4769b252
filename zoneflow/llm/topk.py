"""Exact top-k inner products by pivot-table elimination.

Every vector's distances to ``n_pivots`` pivots are computed once and kept with
it.  For a query q and a vector x the triangle inequality bounds their distance
from below by max over pivots p of |d(q, p) - d(x, p)|, and as

    <q, x> = (|q|^2 + |x|^2 - d(q, x)^2) / 2,

the inner product from above.  Candidates are evaluated in descending order of
that bound until it falls below the k-th best score found, which is exact: a
candidate with a bound equal to the k-th score is still evaluated, since a
smaller id wins a tie.

Vectors and queries are packed into blocks of bounded size, and every query
block meets every vector block in one task (a grid of cells, each with one of
both); a cell returns its k best for each query, and the cells' results are
ranked by Spark.  Pivots are chosen farthest-first from a sample of at most
about ``pivot_sample`` vectors; the choice only affects how much is evaluated.

Defined results: vectors that are null or hold null or non-finite components
take no part, nor do rows without an id; shorter vectors are continued by
zeros; an id with several vectors has the smallest of them (as arrays);
queries are never their own candidates; a query with fewer than k candidates
gets all of them, one without any gets no row.  Components beyond 2 ** 31 in
size fail the job, as their products would not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.llm.common import hash_share
from zoneflow.session import materialize


def choose_pivots(vectors: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first: each pivot is the vector farthest from those chosen so far."""
    if not len(vectors):
        return np.zeros((0, vectors.shape[1]))
    chosen = [int(np.argmax((vectors**2).sum(1)))]
    nearest = ((vectors - vectors[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(vectors)) and nearest.max() > 0:
        chosen.append(int(np.argmax(nearest)))
        nearest = np.minimum(nearest, ((vectors - vectors[chosen[-1]]) ** 2).sum(1))
    return vectors[chosen]


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind) -> np.ndarray:
    """Fixed-length lists as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(flat), dim)


def search_cell(queries: np.ndarray, query_ids: np.ndarray, query_table: np.ndarray, vectors: np.ndarray, ids: np.ndarray, table: np.ndarray, k: int, step: int = 512) -> tuple[list, list, list, int]:
    """k best (query id, vector id, score) of each query among ``vectors``, and how many products were evaluated."""
    out_q, out_v, out_s, evaluated = [], [], [], 0
    norms = (vectors.astype(np.float64) ** 2).sum(1)
    for q, q_id, q_row in zip(queries, query_ids, query_table, strict=True):
        distance = np.zeros(len(vectors))
        for j in range(table.shape[1]):
            np.maximum(distance, np.abs(table[:, j] - q_row[j]), out=distance)
        q_norm = float((q.astype(np.float64) ** 2).sum())
        # a margin for rounding in the distances; the products themselves are integers
        bound = (q_norm + norms - distance**2) / 2 + 1e-6 * (q_norm + norms + 1)
        bound[ids == q_id] = -np.inf
        best_s, best_v, done = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
        left = np.arange(len(vectors))
        while len(left):
            if len(left) > step:
                top = np.argpartition(-bound[left], step)
                now, left = left[top[:step]], left[top[step:]]
            else:
                now, left = left, left[:0]
            now = now[bound[now] > -np.inf]
            if len(best_s) >= k:
                now = now[bound[now] >= best_s[k - 1]]
                if not len(now):
                    break
            done += len(now)
            best_s = np.concatenate([best_s, vectors[now] @ q])
            best_v = np.concatenate([best_v, ids[now]])
            order = np.lexsort((best_v, -best_s))[:k]
            best_s, best_v = best_s[order], best_v[order]
            if len(best_s) >= k:
                left = left[bound[left] >= best_s[k - 1]]
        evaluated += done
        out_q += [int(q_id)] * len(best_v)
        out_v += best_v.tolist()
        out_s += best_s.tolist()
    return out_q, out_v, out_s, evaluated


def search(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector: str = "embedding",
    k: int = 5,
    scale: int = 256,
    n_pivots: int = 24,
    pivot_sample: int = 2000,
    vectors_a_block: int = 8192,
    queries_a_block: int = 2048,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's ``k`` largest inner products of floor(scale * x)."""
    spark = vectors.sparkSession
    x = F.col(vector)
    sound = x.isNotNull() & F.col(id_column).isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    whole = vectors.withColumn("is_query", F.coalesce(is_query, F.lit(False))).where(F.coalesce(sound, F.lit(False)))
    whole = whole.select(F.col(id_column).cast("long").alias("id"), "is_query", F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))
    rows = materialize(spark, whole.groupBy("id").agg(F.min("v").alias("v"), F.max("is_query").alias("is_query")), "topk-vectors")
    n, n_queries, dim, far = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0)), F.max(F.size("v")), F.max(F.greatest(F.array_max("v"), -F.array_min("v")))).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not n or not n_queries:
        return empty
    dim = max(1, dim)
    if far is not None and far >= 1 << 31:
        raise ValueError("a component is too large for integer inner products")
    kind = np.float64 if dim * float(max(1, far or 0)) ** 2 < 2**53 else np.int64  # both exact; the first is faster
    padded = rows.withColumn("v", F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dim) - F.size("v"))))
    sample = padded.where(hash_share("id", 505) < pivot_sample / n).select("v").toArrow()
    pivots = choose_pivots(_matrix(sample.column("v"), dim, np.float64), n_pivots)
    shared = spark.sparkContext.broadcast(pivots)

    def pivot_table(batches):
        for batch in batches:
            m = _matrix(batch.column("v"), dim, np.float64)
            distances = np.stack([np.sqrt(((m - p) ** 2).sum(1)) for p in shared.value], 1) if len(shared.value) else np.zeros((len(m), 0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("is_query"), pa.array([r.astype("<i8").tobytes() for r in m], pa.binary()), pa.array([r.tobytes() for r in distances], pa.binary())], ["id", "is_query", "v", "table"]
            )

    tabled = materialize(spark, padded.mapInArrow(pivot_table, "id long, is_query boolean, v binary, table binary"), "topk-pivots")
    data_blocks, query_blocks = -(-n // vectors_a_block), -(-n_queries // queries_a_block)
    block = F.pmod(F.xxhash64("id"), F.lit(data_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(query_blocks)).cast("int")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    # a cell has one block of each side; a vector goes to the cells of its block, a query to those of its own
    data = tabled.select(block.alias("i"), every(query_blocks).alias("j"), "id", "v", "table")
    asked = tabled.where("is_query").select(every(data_blocks).alias("i"), query_block.alias("j"), "id", "v", "table")

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        def parts(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            m = np.frombuffer(b"".join(t.column("v").to_pylist()), "<i8").reshape(t.num_rows, dim).astype(kind)
            d = np.frombuffer(b"".join(t.column("table").to_pylist()), np.float64).reshape(t.num_rows, -1) if t.num_rows and len(shared.value) else np.zeros((t.num_rows, 0))
            return m, t.column("id").to_numpy(), d

        v, v_ids, v_table = parts(right)
        q, q_ids, q_table = parts(left)
        out_q, out_v, out_s, _ = search_cell(q, q_ids, q_table, v, v_ids, np.ascontiguousarray(v_table.T).T, k)
        return pa.table([pa.array(out_q, pa.int64()), pa.array(out_v, pa.int64()), pa.array([int(s) for s in out_s], pa.int64())], ["query_id", "vec_id", "score"])

    found = asked.groupBy("i", "j").cogroup(data.groupBy("i", "j")).applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
