"""Batches whose schema drifts, appended to plain Parquet.

Schemas are reconciled over a lattice of types: a column keeps the least type
that holds both sides without loss (``WIDER``), a new column or struct field is
added, and anything else (a number that becomes a text, a struct that becomes an
array) is refused before a row is written.  Files keep the types they were
written with; the reader widens them and fills absent columns with null, so no
old file is rewritten.  The reconciled schema is kept beside the data, one small
file a change.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# each type's direct wider types; all of these are widened by Spark's Parquet reader
WIDER: dict[type[T.DataType], tuple[type[T.DataType], ...]] = {
    T.ByteType: (T.ShortType,),
    T.ShortType: (T.IntegerType,),
    T.IntegerType: (T.LongType, T.DoubleType),
    T.FloatType: (T.DoubleType,),
    T.DateType: (T.TimestampNTZType,),
}


class SchemaConflict(ValueError):
    """Two types that no type of the lattice holds."""


def wider_types(kind: type[T.DataType]) -> list[type[T.DataType]]:
    """``kind`` and what it may become, nearest first."""
    out, todo = [], [kind]
    while todo:
        k = todo.pop(0)
        if k not in out:
            out.append(k)
            todo += WIDER.get(k, ())
    return out


def join_types(a: T.DataType, b: T.DataType, at: str = "") -> T.DataType:
    """The least type that holds both; raises ``SchemaConflict`` where there is none."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return join_schemas(a, b, f"{at}.")
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(join_types(a.elementType, b.elementType, f"{at}[]"), a.containsNull or b.containsNull)
    for kind in wider_types(type(a)):
        if kind in wider_types(type(b)) and not isinstance(a, T.StructType | T.ArrayType | T.MapType | T.DecimalType):
            return kind()
    raise SchemaConflict(f"{at}: {a.simpleString()} and {b.simpleString()}")


def join_schemas(a: T.StructType, b: T.StructType, at: str = "") -> T.StructType:
    """Fields of both, those of ``a`` first; names are matched as they are written."""
    other = {f.name: f for f in b.fields}
    fields = [T.StructField(f.name, join_types(f.dataType, other[f.name].dataType, at + f.name) if f.name in other else f.dataType, True) for f in a.fields]
    known = {f.name for f in a.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in b.fields if f.name not in known])


def fitted(value: Column, have: T.DataType, want: T.DataType) -> Column:
    """``value`` in a wider type, nested fields and elements included."""
    if have == want:
        return value
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        types = {f.name: f.dataType for f in have.fields}
        parts = [fitted(value[f.name], types[f.name], f.dataType).alias(f.name) if f.name in types else F.lit(None).cast(f.dataType).alias(f.name) for f in want.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda x: fitted(x, have.elementType, want.elementType))
    return value.cast(want)


def fit(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the columns of ``schema``; absent ones are null."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*((fitted(F.col(f"`{f.name}`"), types[f.name], f.dataType) if f.name in types else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


class EvolvingTable:
    """A folder of Parquet files and the schema that holds them all."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.data, self.schemas = spark, f"{path.rstrip('/')}/data", f"{path.rstrip('/')}/schemas"

    def schema(self) -> T.StructType | None:
        """The reconciled schema; None before the first batch."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.schemas)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        # one row a change; the join of all, so the order in which they were noted does not matter
        found = [T.StructType.fromJson(json.loads(r.schema)) for r in self.spark.read.json(self.schemas, schema="n long, schema string").orderBy("n").collect()]
        return reduce(join_schemas, found)

    def append(self, batch: DataFrame) -> T.StructType:
        """Adds a batch, widening the table's schema where it has to; a batch that does not fit raises and adds nothing."""
        old = self.schema()
        new = batch.schema if old is None else join_schemas(old, batch.schema)
        if new != old:  # noted first: a schema wider than the data does no harm
            n = 0 if old is None else self.spark.read.json(self.schemas, schema="n long, schema string").count()
            self.spark.createDataFrame([(n, new.json())], "n long, schema string").coalesce(1).write.mode("append").json(self.schemas)
        fit(batch, new).write.mode("append").parquet(self.data)
        return new

    def read(self) -> DataFrame:
        return self.spark.read.schema(self.schema()).parquet(self.data)
