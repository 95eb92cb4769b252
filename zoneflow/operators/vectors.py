"""Vector similarity, exact top-k search and retrieval prompts.

Vectors are ``array<float>`` columns, computed with in double precision: row by
row with JVM-side higher-order functions, and as matrices of packed vectors
where many meet many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from zoneflow.functions._util import as_col
from zoneflow.operators.blocks import BLOCK_BYTES, in_query_blocks
from zoneflow.session import materialize

LANES = 256


def dot(a, b) -> Column:
    prod = F.zip_with(as_col(a), as_col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(prod, F.lit(0.0), lambda acc, v: acc + v)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b, norm_a=None, norm_b=None) -> Column:
    """Null where a vector has no direction (zero norm); norms may be given."""
    lengths = (norm(a) if norm_a is None else as_col(norm_a)) * (norm(b) if norm_b is None else as_col(norm_b))
    return F.try_divide(dot(a, b), lengths)


def _rows(column: pa.Array, dim: int, unit: bool) -> tuple[np.ndarray, np.ndarray]:
    """Lists as the rows of a matrix (of length 1 with ``unit``), and which of them have a score: those of ``dim`` finite components, not all zero with ``unit``."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    fit = lengths == dim
    out = np.zeros((len(column), dim))
    flat = column.filter(pa.array(fit)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    out[fit] = flat.reshape(-1, dim)
    fit &= np.isfinite(out).all(1)
    out[~fit] = 0
    if unit:
        length = np.sqrt((out * out).sum(1))
        fit &= length > 0
        out /= np.where(length > 0, length, 1)[:, None]
    return out, fit


def _k_largest(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores; of equal ones the first."""
    if len(scores) <= k:
        return np.arange(len(scores))
    least = -np.partition(-scores, k - 1)[k - 1]
    above = np.flatnonzero(scores > least)
    return np.concatenate([above, np.flatnonzero(scores == least)[: k - len(above)]])


class _Top:
    """The k best (score, id) of each query so far; a smaller id wins a tie, and no score (-inf) comes last."""

    def __init__(self, n_queries: int, k: int):
        self.k, self.rows = k, [[] for _ in range(n_queries)]
        self.least = np.full(n_queries, -np.inf)

    def offer(self, scores: np.ndarray, ids: list, allowed: np.ndarray | None) -> None:
        """``scores`` of every query (row) and candidate; candidates in ascending order of id."""
        hit = scores >= self.least[:, None]
        if allowed is not None:
            hit &= allowed
        for q in np.flatnonzero(hit.any(1)).tolist():
            places = np.flatnonzero(hit[q])
            places = places[_k_largest(scores[q, places], self.k)]
            both = self.rows[q] + [(-float(scores[q, i]), ids[i]) for i in places.tolist()]
            self.rows[q] = sorted(both)[: self.k]
            if len(self.rows[q]) == self.k:
                self.least[q] = -self.rows[q][-1][0]


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    id_col: str = "id",
    vec_col: str = "embedding",
    query_id_col: str = "query_id",
    query_vec_col: str = "query_vec",
    metric: str = "cosine",
    digits: int = 6,
    exclude_self: bool = False,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Exact top-k per query -> (query_id, id, score, rank).

    Queries are taken in blocks of bounded size, packed as a matrix of unit
    vectors (cosine) that every task holds.  A task multiplies pieces of the
    index with it and keeps the k best of each query, so k rows a query and
    task are all that is shuffled; they are ranked in two steps.  Scores are
    rounded to ``digits`` before ranking; ties go to the smaller id.  A score
    that does not exist (a null or zero vector, a null or non-finite component,
    differing lengths) is null and ranks last.  Rows without an id take no part."""
    spark = index.sparkSession
    asked = queries.select(F.col(query_id_col).alias("q"), F.col(query_vec_col).cast("array<double>").alias("v")).where("q IS NOT NULL")
    asked = materialize(spark, asked, "search-queries")
    dim = asked.agg(F.coalesce(F.max(F.size("v")), F.lit(0))).first()[0]
    rows = index.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where("id IS NOT NULL")
    kinds = [asked.schema["q"].dataType, rows.schema["id"].dataType]
    schema = f"query {kinds[0].simpleString()}, id {kinds[1].simpleString()}, score double, lane int"
    unit, dim = metric == "cosine", max(1, dim)

    def against(block: pa.Table) -> DataFrame:
        shared = spark.sparkContext.broadcast(block.combine_chunks())

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids_of_queries = shared.value.column("q").combine_chunks()
            asked, has_score = _rows(shared.value.column("v").combine_chunks(), dim, unit)
            names = ids_of_queries.unique()
            own = pc.index_in(ids_of_queries, value_set=names).to_numpy(zero_copy_only=False)
            top = _Top(len(asked), k)
            step = max(64, min(4096, (1 << 22) // max(1, len(asked))))
            for batch in batches:
                order = pc.sort_indices(batch.column("id"))
                for at in range(0, batch.num_rows if len(asked) else 0, step):
                    piece = batch.take(order.slice(at, step))
                    x, sound = _rows(piece.column("v"), dim, unit)
                    scores = np.round(asked @ x.T, digits)
                    scores[~has_score] = -np.inf
                    scores[:, ~sound] = -np.inf
                    allowed = None
                    if exclude_self:
                        found = pc.fill_null(pc.index_in(piece.column("id").cast(names.type), value_set=names), -1).to_numpy(zero_copy_only=False)
                        allowed = own[:, None] != found[None, :]
                    top.offer(scores, piece.column("id").to_pylist(), allowed)
            q = [i for i, held in enumerate(top.rows) for _ in held]
            found = [row for held in top.rows for row in held]
            lane = TaskContext.get().partitionId() % LANES
            yield pa.RecordBatch.from_arrays(
                [
                    ids_of_queries.take(pa.array(q, pa.int64())),
                    pa.array([i for _, i in found], to_arrow_type(kinds[1])),
                    pa.array([None if s == np.inf else -s for s, _ in found], pa.float64()),
                    pa.array([lane] * len(q), pa.int32()),
                ],
                ["query", "id", "score", "lane"],
            )

        return rows.mapInArrow(run, schema)

    found = in_query_blocks(asked, "q", 8 * dim, against, block_bytes).withColumn("score", F.round("score", digits))
    order = [F.desc_nulls_last("score"), F.asc("id")]
    for keys in (["query", "lane"], ["query"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
    return found.select(F.col("query").alias(query_id_col), F.col("id").alias(id_col), "score", F.col("rank").cast("bigint").alias("rank"))


def upsert_vectors(index: DataFrame, records: DataFrame, id_col: str = "_id") -> DataFrame:
    """M4: replace-by-id upsert of vector records (K8)."""
    from zoneflow.operators.merge import merge_replace

    return merge_replace(index, records, [id_col])
