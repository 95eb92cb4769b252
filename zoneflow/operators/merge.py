"""MERGE-style upserts as DataFrame plans.

Each function returns the *new snapshot* plus, for K6, the change rows
(``_change_type`` insert / update_preimage / update_postimage) so the store
can keep a change feed.  Keys use plain ``=`` (a null key never matches, as
in a SQL MERGE), so null-key source rows are inserted.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.operators.quality import assert_unique


def _keys(k) -> list[str]:
    return [k] if isinstance(k, str) else list(k)


def check_source(source: DataFrame, keys: Sequence[str]) -> None:
    """Raise if a key without nulls repeats in a merge source."""
    assert_unique(source.dropna(subset=list(keys)), keys)


def replace_changes(target: DataFrame, source: DataFrame, key_cols: str | Sequence[str]) -> DataFrame:
    """The change rows of a K8 merge: pre- and post-images of replaced rows, inserts of new ones."""
    keys = _keys(key_cols)
    source = source.select(*target.columns)
    held = target.select(*keys).distinct()
    return (
        source.join(held, keys, "left_semi").select(*target.columns, F.lit("update_postimage").alias("_change_type"))
        .unionByName(source.join(held, keys, "left_anti").select(*target.columns, F.lit("insert").alias("_change_type")))
        .unionByName(target.join(source.select(*keys), keys, "left_semi").select(*target.columns, F.lit("update_preimage").alias("_change_type")))
    )


def _merge_join(target: DataFrame, source: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    data_cols = [c for c in target.columns if c not in keys]
    t = target.select(
        *[F.col(k).alias(f"__tk_{k}") for k in keys],
        *[F.col(c).alias(f"__t_{c}") for c in data_cols],
        F.lit(True).alias("__in_t"),
    )
    s = source.select(
        *[F.col(k).alias(f"__sk_{k}") for k in keys],
        *[(F.col(c) if c in source.columns else F.lit(None).cast(target.schema[c].dataType)).alias(f"__s_{c}") for c in data_cols],
        F.lit(True).alias("__in_s"),
    )
    cond = [t[f"__tk_{k}"] == s[f"__sk_{k}"] for k in keys]
    # Full outer equi-join; presence flags tell a miss from an all-null row.
    return t.join(s, cond, "full_outer"), data_cols


def merge_coalesce(
    target: DataFrame,
    source: DataFrame,
    key_cols: str | Sequence[str],
    check_unique: bool = True,
    stage: bool = False,
    insert_defaults: Mapping[str, Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """K6: matched -> coalesce(new.c, old.c) per non-key column; unmatched source
    rows -> inserted; target rows without a match stay.  Returns
    (snapshot, changes).  A key that repeats in the source raises, as a MERGE
    with two matches for one row does (``check_unique=False`` if the caller
    knows better; null keys never match and may repeat).  ``stage=True`` writes the joined rows once to the
    shared folder so writing the snapshot and the change feed does not run
    the full outer join twice.  ``insert_defaults`` fills nulls of these
    columns in inserted rows only."""
    keys = _keys(key_cols)
    if check_unique:
        check_source(source, keys)
    j, data_cols = _merge_join(target, source, keys)
    if stage:
        from zoneflow.session import materialize

        j = materialize(target.sparkSession, j, "merge-join")
    matched = F.col("__in_t").isNotNull() & F.col("__in_s").isNotNull()
    key_out = [F.coalesce(F.col(f"__sk_{k}"), F.col(f"__tk_{k}")).alias(k) for k in keys]
    inserted = F.col("__in_t").isNull()
    old = {c: F.col(f"__t_{c}") for c in data_cols}
    for c, default in (insert_defaults or {}).items():
        old[c] = F.when(inserted, default.cast(target.schema[c].dataType)).otherwise(old[c])
    val_out = [F.coalesce(F.col(f"__s_{c}"), old[c]).alias(c) for c in data_cols]
    ordered = [F.col(c) for c in target.columns]
    snapshot = j.select(*key_out, *val_out).select(*ordered)

    kind = F.when(matched, F.lit("update")).when(F.col("__in_s").isNotNull(), F.lit("insert"))
    flagged = j.select(*key_out, *val_out, kind.alias("__kind"), *[F.col(f"__t_{c}") for c in data_cols])
    post = flagged.where(F.col("__kind").isNotNull()).select(
        *[F.col(c) for c in target.columns],
        F.when(F.col("__kind") == "update", "update_postimage").otherwise("insert").alias("_change_type"),
    )
    pre = flagged.where(F.col("__kind") == "update").select(
        *[F.col(k) for k in keys],
        *[F.col(f"__t_{c}").alias(c) for c in data_cols],
    ).select(*ordered, F.lit("update_preimage").alias("_change_type"))
    return snapshot, post.unionByName(pre)


def merge_high_water(
    target: DataFrame, batch: DataFrame, key_cols: str | Sequence[str], ts_col: str
) -> tuple[DataFrame, DataFrame]:
    """K7: rows at or below the target's max timestamp go through K6; rows
    above it are appended.  Fixes: null timestamps and a null max go to the
    merge branch (Q5); above-max rows whose key already exists are merged,
    not appended as duplicates (Q6).  The max is one scalar (A5/P12)."""
    keys = _keys(key_cols)
    check_source(batch, keys)
    max_ts = target.agg(F.max(ts_col).alias("m")).first()["m"]
    if max_ts is None:
        return merge_coalesce(target, batch, keys, check_unique=False)
    late = batch.where(F.col(ts_col).isNull() | (F.col(ts_col) <= F.lit(max_ts)))
    fresh = batch.where(F.col(ts_col) > F.lit(max_ts))
    existing = fresh.join(target.select(*keys), keys, "left_semi")
    appended = fresh.join(target.select(*keys), keys, "left_anti")
    merged, changes = merge_coalesce(target, late.unionByName(existing), keys, check_unique=False)
    appended = appended.select(*target.columns)
    return (
        merged.unionByName(appended),
        changes.unionByName(appended.withColumn("_change_type", F.lit("insert"))),
    )


def merge_replace(target: DataFrame, source: DataFrame, key_cols: str | Sequence[str], check_unique: bool = True) -> DataFrame:
    """K8 / M4: whole-row upsert (update all / insert all): target rows whose
    key is in the source are replaced, new keys inserted; a key that repeats
    in the source raises."""
    keys = _keys(key_cols)
    if check_unique:
        check_source(source, keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source.select(*target.columns))
