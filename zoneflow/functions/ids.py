"""Keys, IRIs, literals and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zoneflow.functions._util import as_col

# Fixed vocabulary namespaces (our own; configurable per graph).
ONT = "http://zoneflow.example/ontology/"
RES = "http://zoneflow.example/resource/"
RDF_TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
XSD = "http://www.w3.org/2001/XMLSchema#"
FOAF = "http://xmlns.com/foaf/0.1/"


def key_string(c, prefix: str | None = None) -> Column:
    """Cast a key to string, optionally prefixed (one shared id namespace, Q23)."""
    s = as_col(c).cast("string")
    return s if prefix is None else F.concat(F.lit(prefix), s)


def stable_hash(c) -> Column:
    """F16: sha256 of the value's string form, as hex (equality preserving)."""
    return F.sha2(as_col(c).cast("string"), 256)


def iri(kind: str, id_col, base: str = RES) -> Column:
    """<base><kind>_<id>."""
    return F.concat(F.lit(f"{base}{kind}_"), as_col(id_col).cast("string"))


def typed_literal(c, datatype: str) -> Column:
    """lexical form for an xsd datatype; values that do not fit -> null."""
    x = as_col(c)
    if datatype in ("integer", "long"):
        return x.try_cast("bigint").cast("string")
    if datatype == "decimal":
        return x.try_cast("decimal(18,2)").cast("string")
    if datatype == "boolean":
        return F.lower(x.try_cast("boolean").cast("string"))
    if datatype == "date":
        return F.date_format(x.try_cast("date"), "yyyy-MM-dd")
    if datatype == "dateTime":
        return F.date_format(x, "yyyy-MM-dd'T'HH:mm:ss")
    return x.cast("string")


def record_json(cols) -> Column:
    """JSON object of the columns; null fields are omitted."""
    return F.to_json(F.struct(*[as_col(c) for c in cols]))
