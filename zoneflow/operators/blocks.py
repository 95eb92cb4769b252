"""A stated set of queries against all rows, in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.session import scratch_path

BLOCK_BYTES = 64 << 20


def in_query_blocks(queries: DataFrame, id_col: str, row_bytes: int, run: Callable[[pa.Table], DataFrame], max_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``run`` for every block of about ``max_bytes`` of ``queries`` (a stored table).

    One block is what tasks hold of the queries.  With several, each block's
    rows are added to a table in the shared folder, so that neither the plan
    nor the memory grows with their number."""
    blocks = -(-queries.count() * row_bytes // max_bytes)
    if blocks <= 1:
        return run(queries.toArrow())
    spark = queries.sparkSession
    path = scratch_path(spark, "query-blocks")
    for b in range(blocks):
        block = queries.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == b).toArrow()
        run(block).write.mode("append").parquet(path)
    return spark.read.parquet(path)
