"""Registry of test-data queries: name -> (Spark builder, DuckDB oracle SQL).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the
given parquet tables.  Oracle SQL runs in DuckDB over views with the same
table names; ``None`` means no SQL oracle (rows-only check).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_all() -> None:
    """Import every plan module so its queries register."""
    from zoneflow.plans import (  # noqa: F401
        abox_plans,
        curation,
        flow_plans,
        graph_plans,
        merging,
        scan_plans,
        text_plans,
        vector_plans,
    )
