"""File sources (S1-S3, S8, S9) with explicit schemas.

Schema inference is a fallback only: it costs an extra pass over the input
and drifts between batches, so every reader takes a schema first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.sources.escapes import LINE, unescape

TRIPLE_SCHEMA = T.StructType(
    [T.StructField("subject", T.StringType()), T.StructField("predicate", T.StringType()), T.StructField("object", T.StringType())]
)
DICT_SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("label", T.StringType())])


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True) -> DataFrame:
    """JSON files (a file may hold one array of objects -> multiLine)."""
    reader = spark.read.option("multiLine", str(multi_line).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def extract_payload(df: DataFrame, json_col: str, schema: T.StructType, array_field: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse a wrapped API payload and keep only the records array
    (one row per record); ``keep`` names top-level fields kept as metadata."""
    parsed = df.select(F.from_json(F.col(json_col), schema).alias("__p"))
    meta = [F.col(f"__p.{k}").alias(k) for k in keep]
    return parsed.select(*meta, F.inline(F.col(f"__p.{array_field}")))


def payload_total(df: DataFrame, json_col: str, schema: T.StructType, array_field: str) -> DataFrame:
    """A9 on payloads: records per payload via ``size``."""
    return df.select(F.size(F.from_json(F.col(json_col), schema)[array_field]).alias("n_records"))


def read_table_file(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None, header: bool = True) -> DataFrame:
    """S3: tabular file (csv/parquet); xlsx is not decoded (single-machine format)."""
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", str(header).lower())
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_triples_tsv(spark: SparkSession, path: str) -> DataFrame:
    """TSV triples with a header row (Q3: the header is read as a header);
    texts are unescaped, an empty field is the empty text."""
    out = spark.read.schema(TRIPLE_SCHEMA).option("sep", "\t").option("header", "true").option("quote", "").csv(path)
    return out.select(*[unescape(F.coalesce(F.col(c), F.lit("")), LINE).alias(c) for c in out.columns])


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(id, label) TSV, gzip-compressed files are decompressed by extension."""
    out = spark.read.schema(DICT_SCHEMA).option("sep", "\t").option("header", "true").option("quote", "").csv(path)
    return out.select(*[unescape(F.col(c), LINE).alias(c) if kind == "string" else F.col(c) for c, kind in out.dtypes])
