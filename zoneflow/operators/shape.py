"""Projections, renames, schema conformance and unions.

Everything here is a narrow transformation (no shuffle) except the explicit
dedupe steps; Catalyst prunes unused columns down to the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions._util import as_col


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def rename_present(df: DataFrame, mapping: Mapping[str, str], fallback: Mapping[str, str] | None = None) -> DataFrame:
    """Rename the columns that exist; ``fallback`` renames apply only when the
    target name is still missing afterwards (e.g. id -> film_id)."""
    out = df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})
    for old, new in (fallback or {}).items():
        if new not in out.columns and old in out.columns:
            out = out.withColumnRenamed(old, new)
    return out


def _typed_default(dtype: T.DataType, now: Column | None) -> Column:
    if isinstance(dtype, T.TimestampType | T.TimestampNTZType):
        return (now if now is not None else F.current_timestamp()).cast(dtype)
    if isinstance(dtype, T.NumericType):
        return F.lit(0).cast(dtype)
    return F.lit(None).cast(dtype)


def conform(df: DataFrame, schema: T.StructType, now: Column | None = None, defaults: bool = True) -> DataFrame:
    """Select the target schema; missing columns get a *typed* default
    (timestamp -> now, numeric -> 0, else null; Q7), present ones are cast.
    A source of a coalescing merge is conformed with ``defaults=False``: a
    default there would overwrite real values (see ``absent_defaults``)."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append((_typed_default(f.dataType, now) if defaults else F.lit(None).cast(f.dataType)).alias(f.name))
    return df.select(*cols)


def absent_defaults(df: DataFrame, schema: T.StructType, now: Column | None = None) -> dict[str, Column]:
    """Q7's typed defaults of the columns of ``schema`` that ``df`` lacks, for rows that a merge inserts."""
    return {f.name: _typed_default(f.dataType, now) for f in schema.fields if f.name not in df.columns}


def flatten(df: DataFrame, mapping: Mapping[str, str], keep: Sequence[str] = (), drop_parents: bool = True) -> DataFrame:
    """Nested paths -> named columns in one projection.

    ``mapping`` is {output_name: "a.b.c"}; parent struct columns are dropped.
    """
    parents = {p.split(".")[0] for p in mapping.values()}
    kept = [c for c in df.columns if c in keep or (not drop_parents or c not in parents)]
    return df.select(*[F.col(f"`{c}`") for c in kept], *[F.col(p).alias(n) for n, p in mapping.items()])


def repair_struct_id(df: DataFrame, col: str, id_field: str = "id", name_field: str = "name", id_fn=None) -> DataFrame:
    """P5: when ``col.id`` is null rebuild the struct with id = id_fn(name)."""
    from zoneflow.functions.text import slug

    id_fn = id_fn or slug
    s = F.col(col)
    rebuilt = F.struct(id_fn(s.getField(name_field)).alias(id_field), s.getField(name_field).alias(name_field))
    return df.withColumn(col, F.when(s.getField(id_field).isNull(), rebuilt).otherwise(s))


def struct_to_field(df: DataFrame, col: str, field: str = "id") -> DataFrame:
    """Replace a struct column by one of its fields."""
    return df.withColumn(col, F.col(col).getField(field))


def drop_present(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns; absent ones are ignored (DataFrame.drop semantics)."""
    return df.drop(*cols)


def any_null(cols: Iterable) -> Column:
    """OR-reduce of isNull over the columns."""
    return reduce(lambda a, b: a | b, [as_col(c).isNull() for c in cols], F.lit(False))


def null_or_nan(c) -> Column:
    """P16 guard: true for null and for NaN."""
    x = as_col(c)
    return x.isNull() | F.isnan(x)


def clean_double(c) -> Column:
    """NaN -> null so downstream code sees one 'missing' value."""
    x = as_col(c)
    return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)


def prepare_records(
    df: DataFrame,
    key_col: str,
    text_cols: Sequence,
    source: str,
    date_col: str | None = None,
    key_prefix: str | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """(records, registry).

    records = (_id, text_to_embed, source) with text = first non-null of
    ``text_cols`` else '' and empty texts removed; registry = (key, date)
    when the date column exists.
    """
    from zoneflow.functions.text import first_non_null

    key = F.col(key_col).cast("string")
    if key_prefix:
        key = F.concat(F.lit(key_prefix), key)
    records = (
        df.select(key.alias("_id"), first_non_null(text_cols).alias("text_to_embed"))
        .filter(F.col("text_to_embed") != "")
        .select("_id", "text_to_embed", F.lit(source).alias("source"))
    )
    registry = df.select(key_col, date_col) if date_col and date_col in df.columns else None
    return records, registry


def write_records(df: DataFrame, path: str, key_col: str, text_cols: Sequence, source: str, date_col: str, key_prefix: str | None = None) -> tuple[DataFrame, DataFrame]:
    """P18's two outputs in one pass: (records, registry), written below ``path`` and read back.

    A row becomes a registry row (key, date) and, if it has a text, a record;
    both are laid out by kind in the one write, so the input is read once."""
    from zoneflow.functions.text import first_non_null

    key, date = F.col(key_col).cast("string"), df.schema[date_col].dataType
    text = first_non_null(text_cols)
    record = F.struct(
        F.lit("records").alias("kind"), (F.concat(F.lit(key_prefix), key) if key_prefix else key).alias("_id"), text.alias("text_to_embed"), F.lit(source).alias("source"), F.lit(None).cast(date).alias(date_col)
    )
    entry = F.struct(F.lit("registry").alias("kind"), key.alias("_id"), F.lit(None).cast("string").alias("text_to_embed"), F.lit(None).cast("string").alias("source"), F.col(date_col))
    rows = df.select(F.explode(F.array(entry, F.when(text != "", record))).alias("r")).where("r IS NOT NULL").select("r.*")
    rows.write.partitionBy("kind").parquet(path)
    both = df.sparkSession.read.schema(rows.schema).parquet(path)
    return both.where("kind = 'records'").select("_id", "text_to_embed", "source"), both.where("kind = 'registry'").select(F.col("_id").alias(key_col), date_col)


def union_roles(df: DataFrame, roles: Sequence[Mapping[str, str]]) -> DataFrame:
    """One row per role from a single scan.

    ``roles`` is a list of {output_col: input_col}; every role must produce the
    same output names.  Implemented as ``inline(array(struct...))`` so the
    input is read once (no self-union of the scan).
    """
    names = list(roles[0].keys())
    structs = [F.struct(*[F.col(r[n]).alias(n) for n in names]) for r in roles]
    return df.select(F.inline(F.array(*structs)))


def union_batches(batches: Sequence[DataFrame]) -> DataFrame:
    """Union by name; columns missing in a batch become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), batches)


def order_by(df: DataFrame, col: str, ascending: bool = True) -> DataFrame:
    """Global order (range-partitioned sort).  Before a merge it has no
    lasting effect; to lay files out by a column use ``sorted_within``."""
    return df.orderBy(F.col(col).asc() if ascending else F.col(col).desc())


def sorted_within(df: DataFrame, col: str, ascending: bool = True) -> DataFrame:
    """T1 at write time: sort inside each partition (no global shuffle)."""
    return df.sortWithinPartitions(F.col(col).asc() if ascending else F.col(col).desc())


def peek(df: DataFrame, n: int = 5) -> list:
    """The first n rows (a limit, not a full collect)."""
    return df.limit(n).collect()
