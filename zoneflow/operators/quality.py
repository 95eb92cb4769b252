"""Dedupe, coalescing group-merge, key checks and data-quality metrics
(A1-A4, A7, A8, W1-W3, F13).

All group operators are aggregates with map-side partial aggregation
(``min_by``/``max_by``/``count``), never ``collect_list`` of a group, so a
key holding a third of all rows is combined per input partition before the
shuffle instead of landing whole in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zoneflow.operators.shape import any_null
from zoneflow.session import materialize


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def dedupe(df: DataFrame, subset: Sequence[str] | None = None, metrics: Observation | None = None) -> DataFrame:
    """A1 (+A7): drop exact duplicates.  ``metrics`` (an Observation) receives
    rows_in when the result is first computed; rows_out = result count."""
    src = df if metrics is None else df.observe(metrics, F.count(F.lit(1)).alias("rows_in"))
    return src.dropDuplicates(list(subset)) if subset else src.dropDuplicates()


def counted_stages(spark: SparkSession, df: DataFrame, stages: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]]) -> tuple[DataFrame, DataFrame]:
    """The result of ``stages`` and a table (stage, place, rows_in, rows_out, removed, added).

    A stage's result is written once; both counts are observed while that job
    runs, so counting takes no pass of its own.  ``removed`` and ``added`` are
    the two sides of the difference."""
    counts = []
    for place, (name, stage) in enumerate(stages):
        before, after = Observation(), Observation()
        count = F.count(F.lit(1)).alias("n")
        df = materialize(spark, stage(df.observe(before, count)).observe(after, count), f"stage-{place}")
        n_in, n_out = before.get["n"], after.get["n"]
        counts.append((name, place, n_in, n_out, max(0, n_in - n_out), max(0, n_out - n_in)))
    return df, spark.createDataFrame(counts, "stage string, place int, rows_in bigint, rows_out bigint, removed bigint, added bigint")


def merge_elements(
    df: DataFrame,
    key_cols: str | Sequence[str],
    order_cols: str | Sequence[str] | None = None,
    desc: bool = False,
) -> DataFrame:
    """A3: per key, every other column = its first non-null value in order.

    Ordering is (order_cols..., the value itself) so ties resolve to the
    smallest (largest when ``desc``) value: a total order, unlike the
    window + ``first`` form whose order Catalyst may prune (Q8).
    """
    keys = _keys(key_cols)
    order = _keys(order_cols) if order_cols is not None else keys
    pick = F.max_by if desc else F.min_by
    data_cols = [c for c in df.columns if c not in keys]
    aggs = [
        pick(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*[F.col(o) for o in order], F.col(c)))).alias(c)
        for c in data_cols
    ]
    return df.groupBy(*keys).agg(*aggs)


def first_row_per_key(
    df: DataFrame, key_cols: str | Sequence[str], order_cols: str | Sequence[str], desc: bool = False
) -> DataFrame:
    """The whole first row per key in order; ties broken by the
    remaining columns (Q11).  Same result as ``row_number() == 1`` but as a
    partially-aggregated ``min_by`` so skewed keys do not sort in one task."""
    keys = _keys(key_cols)
    order = _keys(order_cols)
    rest = [c for c in df.columns if c not in keys and c not in order]
    data = [c for c in df.columns if c not in keys]
    pick = F.max_by if desc else F.min_by
    ordering = F.struct(*[F.col(c) for c in order + rest])
    row = F.struct(*[F.col(c) for c in data])
    return df.groupBy(*keys).agg(pick(row, ordering).alias("__row")).select(*keys, "__row.*")


def duplicated_keys(df: DataFrame, key_cols: str | Sequence[str], count_col: str = "n") -> DataFrame:
    """A4: keys that occur more than once, with their count."""
    return df.groupBy(*_keys(key_cols)).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def assert_unique(df: DataFrame, key_cols: str | Sequence[str]) -> None:
    """Raise if a key repeats (used before MERGE; one small job)."""
    dup = duplicated_keys(df, key_cols).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key in merge source: {dup[0].asDict()}")


def null_percentage(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """A8 (+A9): rows, rows with >= 1 null, and their percentage in one
    aggregate; percentage is null on empty input (Q10)."""
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    flag = F.when(any_null(cols), 1).otherwise(0)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(flag).cast("bigint").alias("n_null_rows"),
        (F.avg(flag) * 100.0).alias("null_pct"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def country_codes(
    df: DataFrame,
    name_col: str = "country_name",
    code_col: str = "country_code",
    flag_col: str = "country_flag",
    world: str = "world",
    world_code: str = "wrd",
) -> DataFrame:
    """(country_code, country_name, country_flag), distinct.

    code = 'wrd' for World, else lower(code); a null code falls back to the
    name (rows still null are dropped); a code shared by several
    (name, flag) pairs becomes 'code-name'.  The shared-code test is a
    group count joined back, not a driver-side collect.
    """
    name = F.lower(F.col(name_col))
    code = F.when(name == world, F.lit(world_code)).otherwise(F.lower(F.col(code_col)))
    base = (
        df.select(
            F.coalesce(code, name).alias("country_code"),
            name.alias("country_name"),
            F.lower(F.col(flag_col)).alias("country_flag"),
        )
        .where(F.col("country_code").isNotNull())
        .distinct()
    )
    shared = (
        base.groupBy("country_code")
        .agg(F.count(F.lit(1)).alias("__n"))
        .where(F.col("__n") > 1)
        .select("country_code", F.lit(True).alias("__shared"))
    )
    joined = base.join(shared, "country_code", "left")
    fixed: Column = F.when(
        F.col("__shared"), F.concat(F.col("country_code"), F.lit("-"), F.col("country_name"))
    ).otherwise(F.col("country_code"))
    return joined.select(fixed.alias("country_code"), "country_name", "country_flag").distinct()
