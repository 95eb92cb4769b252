"""Sinks (K10-K14).

K10 sends records to an external service in batches from the executors
(``mapInPandas``: each task opens its own client); the per-record outcome
comes back as a DataFrame instead of being printed and lost.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from zoneflow.functions.ids import XSD
from zoneflow.sources.escapes import LINE, QUOTED, escape, unescape
from zoneflow.sources.files import TRIPLE_SCHEMA

RESULT_SCHEMA = "_id string, status string, error string"


class IndexClient(Protocol):
    def upsert(self, records: list[dict]) -> None: ...


def _clean(rec: dict) -> dict:
    # Null (and NaN) fields are not sent.
    return {k: v for k, v in rec.items() if v is not None and not (isinstance(v, float) and math.isnan(v))}


def batched_upsert(df: DataFrame, client_factory: Callable[[], IndexClient], batch_size: int = 95, id_col: str = "_id") -> DataFrame:
    """Partition-parallel batched upsert; a failed batch is retried
    record by record.  (_id, status sent|failed, error) of every record: written
    as a table, its failed rows are what to send again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = client_factory()
        for batch in batches:
            for at in range(0, batch.num_rows, batch_size):
                piece = batch.slice(at, batch_size)
                records = [_clean(r) for r in piece.to_pylist()]
                errors: list[str | None] = [None] * len(records)
                try:
                    client.upsert(records)
                except Exception:  # batch failed: retry one by one
                    for i, r in enumerate(records):
                        try:
                            client.upsert([r])
                        except Exception as e:  # noqa: BLE001
                            errors[i] = repr(e)
                status = ["sent" if e is None else "failed" for e in errors]
                yield pa.RecordBatch.from_arrays([piece.column(id_col).cast(pa.string()), pa.array(status), pa.array(errors, pa.string())], ["_id", "status", "error"])

    return df.mapInArrow(run, RESULT_SCHEMA)


class Preflight:
    """A client that sends nothing and refuses what the service would: a dry run before a load.

    A request fails if one of its texts is longer than ``max_chars``."""

    def __init__(self, max_chars: int, text_field: str = "text_to_embed"):
        self.max_chars = max_chars
        self.text_field = text_field

    def upsert(self, records: list[dict]) -> None:
        for r in records:
            if len(r.get(self.text_field, "")) > self.max_chars:
                raise ValueError(f"more than {self.max_chars} characters")


def namespace_stats(records: DataFrame) -> DataFrame:
    """Vectors per source."""
    return records.groupBy("source").agg(F.count(F.lit(1)).alias("n_vectors"))


def reset_namespace(spark: SparkSession, records: DataFrame) -> DataFrame:
    """Delete-all = an empty namespace with the same schema."""
    return spark.createDataFrame([], records.schema)


# Lines of a compressed file: it is read in one piece, so its size decides how finely the next read is dealt out.
FILE_LINES = 1 << 19


def _compressed(w: DataFrameWriter, compression: str | None) -> DataFrameWriter:
    return w.option("compression", compression).option("maxRecordsPerFile", FILE_LINES) if compression else w


def write_tsv(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Tab-separated export with a header line; backslash, tab and line
    breaks in texts are escaped, null and the empty text are an empty field."""
    texts = {name for name, kind in df.dtypes if kind == "string"}
    df = df.select(*[escape(F.col(c), LINE).alias(c) if c in texts else F.col(c) for c in df.columns])
    w = df.write.mode("overwrite").option("sep", "\t").option("header", "true").option("quote", "").option("emptyValue", "")
    w = w.option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
    _compressed(w, compression).csv(path)


def ntriples_lines(triples: DataFrame) -> DataFrame:
    """One N-Triples line per triple (N-Triples is a subset of Turtle)."""
    obj = F.when(F.col("object_kind") == "iri", F.concat(F.lit("<"), F.col("object"), F.lit(">"))).otherwise(
        F.concat(
            F.lit('"'),
            escape(F.col("object"), QUOTED),
            F.lit('"'),
            F.when(F.col("datatype").isNotNull(), F.concat(F.lit("^^<"), F.lit(XSD), F.col("datatype"), F.lit(">"))).otherwise(F.lit("")),
        )
    )
    line = F.concat(F.lit("<"), F.col("subject"), F.lit("> <"), F.col("predicate"), F.lit("> "), obj, F.lit(" ."))
    return triples.select(line.alias("value"))


def write_ntriples(triples: DataFrame, path: str, compression: str | None = None) -> None:
    _compressed(ntriples_lines(triples).write.mode("overwrite"), compression).text(path)


# The literal runs to the last quote of the line: a datatype holds none.
_NT = r'(?s)^<([^>]*+)> <([^>]*+)> (?:<([^>]*+)>|"(.*)"(?:\^\^<([^>"]*+)>)?) \.$'
# subject, predicate, IRI, datatype, text: only the last one may hold a ">"
_NT_PARTS = "$1>$2>$3>$5>$4"


def read_ntriples(spark: SparkSession, path: str, require_rows: bool = True) -> DataFrame:
    """Parse N-Triples lines back into the triples table; an empty
    input raises (the bulk-load empty-file check), and so does a line that is
    neither a triple nor blank nor a comment."""
    lines = spark.read.text(path)
    blank = F.col("value").rlike(r"^\s*(#.*)?$")
    if require_rows and lines.where(~blank).limit(1).count() == 0:
        raise ValueError(f"no triples in {path}")
    wrong = F.raise_error(F.concat(F.lit("not a triple: "), F.col("value"))).cast("boolean")
    lines = lines.where(F.when(F.col("value").rlike(_NT), F.lit(True)).when(blank, F.lit(False)).otherwise(wrong))
    # one match gives all parts of a line; ".*" takes a line break that "$" leaves
    parsed = lines.select(F.split(F.regexp_replace("value", _NT + ".*", _NT_PARTS), ">", 5).alias("p"))
    part = lambda i: F.col("p")[i]
    is_iri = part(2) != ""
    return parsed.select(
        part(0).alias("subject"),
        part(1).alias("predicate"),
        F.when(is_iri, part(2)).otherwise(unescape(part(4), QUOTED)).alias("object"),
        F.when(is_iri, F.lit("iri")).otherwise(F.lit("literal")).alias("object_kind"),
        F.when(is_iri | (part(3) == ""), F.lit(None)).otherwise(F.replace(part(3), F.lit(XSD), F.lit(""))).alias("datatype"),
    )


__all__ = [
    "TRIPLE_SCHEMA",
    "batched_upsert",
    "namespace_stats",
    "ntriples_lines",
    "read_ntriples",
    "reset_namespace",
    "write_ntriples",
    "write_tsv",
]
