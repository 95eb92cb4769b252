"""Declarative table -> triples mapping (R2RML-like).

A ``TableMap`` names a subject template, a class (a Column, so it can be
conditional - G3), an optional row guard and a list of ``PredicateMap``
(predicate, object Column, kind, datatype).  Each table is mapped in ONE
scan: ``inline(array(struct(...)))`` emits all of a row's triples, nulls
are dropped, and the union of all tables is made a set with ``distinct``.
Nothing goes through the driver (unlike a row loop into an in-memory graph).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE, typed_literal
from zoneflow.operators.graph.tbox import TRIPLE_COLS


@dataclass(frozen=True)
class PredicateMap:
    predicate: str  # local name in the ontology namespace, or a full IRI
    value: Column
    kind: str = "literal"  # "iri" | "literal"
    datatype: str | None = "string"  # xsd local name for literals


@dataclass(frozen=True)
class TableMap:
    subject: Column
    cls: Column | str | None
    predicates: Sequence[PredicateMap] = field(default_factory=list)
    guard: Column | None = None


def _iri(name: str, ont: str) -> str:
    return name if "://" in name else ont + name


def literal(predicate: str, value: Column, datatype: str = "string") -> PredicateMap:
    """G1 literal object with F18 coercion to the datatype's lexical form."""
    return PredicateMap(predicate, typed_literal(value, datatype), "literal", datatype)


def link(predicate: str, value: Column) -> PredicateMap:
    return PredicateMap(predicate, value, "iri", None)


def flag(predicate: str, condition: Column) -> PredicateMap:
    """Membership flag - a constant 'true' boolean when the condition holds."""
    return PredicateMap(predicate, F.when(condition, F.lit("true")), "literal", "boolean")


def table_triples(df: DataFrame, tmap: TableMap, ont: str = ONT) -> DataFrame:
    rows = df if tmap.guard is None else df.where(tmap.guard)
    entries = []
    if tmap.cls is not None:
        cls = F.lit(_iri(tmap.cls, ont)) if isinstance(tmap.cls, str) else tmap.cls
        entries.append(F.struct(F.lit(RDF_TYPE).alias("predicate"), cls.alias("object"), F.lit("iri").alias("object_kind"), F.lit(None).cast("string").alias("datatype")))
    for pm in tmap.predicates:
        entries.append(
            F.struct(
                F.lit(_iri(pm.predicate, ont)).alias("predicate"),
                pm.value.cast("string").alias("object"),
                F.lit(pm.kind).alias("object_kind"),
                F.lit(pm.datatype).cast("string").alias("datatype"),
            )
        )
    out = rows.select(tmap.subject.alias("subject"), F.inline(F.array(*entries)))
    return out.where(F.col("subject").isNotNull() & F.col("object").isNotNull()).select(*TRIPLE_COLS)


def map_tables(pairs: Sequence[tuple[DataFrame, TableMap]], ont: str = ONT) -> DataFrame:
    """Union of every table's triples as a set (U4: re-adding is a no-op)."""
    parts = [table_triples(df, m, ont) for df, m in pairs]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()
