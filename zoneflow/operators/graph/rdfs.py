"""G4 + J12: RDFS materialisation of instance triples against a TBox.

Rules (RDF 1.1 Semantics, RDFS entailment): rdfs5/rdfs11 (hierarchy
closures, computed on the TBox), rdfs7 (sub-property),
rdfs2 (domain), rdfs3 (range, IRI objects only - literals never get a type),
rdfs9 (sub-class); plus the typing that the RDFS axiomatic triples imply:
every predicate in use and every subject/object of domain, range and
subPropertyOf statements is an rdf:Property, every object of rdf:type,
domain and range and both sides of subClassOf is an rdfs:Class.

The instance side is written once and read three times: for the types it
implies (one pass, joined with schema-sized tables), for the predicates and
classes in use, and for the result.  The only shuffles of instance triples are
the set ``distinct`` and that of the type pairs.  The result is a fix-point.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from zoneflow.session import materialize as write_table

from zoneflow.functions.ids import RDF_TYPE
from zoneflow.operators.graph.tbox import (
    RDF_PROPERTY,
    RDFS_CLASS,
    RDFS_DOMAIN,
    RDFS_RANGE,
    RDFS_SUBCLASS,
    RDFS_SUBPROPERTY,
    TRIPLE_COLS,
)


def hierarchy_closures(spark: SparkSession, tbox: DataFrame, predicates: Sequence[str]) -> DataFrame:
    """Transitive closures (rule, sub, sup) of subClassOf and subPropertyOf, side by side.

    Path doubling: each round joins the pairs found so far with themselves, so
    a chain of depth d takes about log2(d) rounds; pairs are a set, so a cycle
    ends it too (its members then are above themselves).  Each round is a
    table in the shared folder, counted while it is written."""

    def written(pairs: DataFrame) -> tuple[DataFrame, int]:
        size = Observation()
        out = write_table(spark, pairs.distinct().observe(size, F.count(F.lit(1)).alias("n")), "rdfs-closure")
        return out, size.get["n"]

    statements = tbox.where(F.col("predicate").isin(*predicates))
    pairs, known = written(statements.select(F.col("predicate").alias("rule"), F.col("subject").alias("sub"), F.col("object").alias("sup")))
    while True:
        further = pairs.select("rule", F.col("sub").alias("sup"), F.col("sup").alias("above"))
        longer = pairs.join(further, ["rule", "sup"]).select("rule", "sub", F.col("above").alias("sup"))
        pairs, n = written(pairs.unionByName(longer))
        if n == known:
            return pairs
        known = n


def hierarchy_closure(spark: SparkSession, tbox: DataFrame, predicate: str) -> DataFrame:
    """Transitive closure (sub, sup) of subClassOf or subPropertyOf."""
    return hierarchy_closures(spark, tbox, [predicate]).select("sub", "sup")


def _iri_triple(s, p, o) -> list:
    return [s.alias("subject"), p.alias("predicate"), o.alias("object"), F.lit("iri").alias("object_kind"), F.lit(None).cast("string").alias("datatype")]


def materialize(spark: SparkSession, abox: DataFrame, tbox: DataFrame) -> DataFrame:
    """Return TBox + ABox + all inferred triples, as a set."""
    # Schema-sized tables are written first: their size is then known, and Spark
    # broadcasts them below its threshold and shuffles beyond it.
    tb = write_table(spark, tbox.select(*TRIPLE_COLS), "rdfs-tbox")
    closures = hierarchy_closures(spark, tb, [RDFS_SUBPROPERTY, RDFS_SUBCLASS])
    sub_prop, sub_cls = (closures.where(F.col("rule") == r).select("sub", "sup") for r in (RDFS_SUBPROPERTY, RDFS_SUBCLASS))
    supers = write_table(spark, sub_cls.groupBy("sub").agg(F.collect_set("sup").alias("supers")), "rdfs-supers")

    def classes_by(rule: str, prefix: str) -> DataFrame:
        """Per predicate the classes that ``rule`` implies, superclasses included."""
        direct = tb.where(F.col("predicate") == rule).select(F.col("subject").alias("p"), F.col("object").alias("c"))
        above = direct.join(sub_cls, direct.c == sub_cls.sub).select("p", F.col("sup").alias("c"))
        grouped = direct.unionByName(above).groupBy("p").agg(F.collect_set("c").alias(f"{prefix}_classes"))
        return write_table(spark, grouped.withColumnRenamed("p", f"{prefix}_p"), f"rdfs-{prefix}")

    domain, rng = classes_by(RDFS_DOMAIN, "dom"), classes_by(RDFS_RANGE, "rng")

    base = abox.select(*TRIPLE_COLS).unionByName(tb)
    # rdfs7: (s p o), p subPropertyOf* q -> (s q o)
    via_sup = base.join(sub_prop, base.predicate == sub_prop.sub).select(
        "subject", F.col("sup").alias("predicate"), "object", "object_kind", "datatype"
    )
    # t1 is read three times below: write it once to the shared folder so the
    # ABox mapping upstream is not recomputed.
    t1 = write_table(spark, base.unionByName(via_sup).distinct(), "rdfs-t1")
    is_type, is_iri = F.col("predicate") == RDF_TYPE, F.col("object_kind") == "iri"

    # rdfs2 / rdfs3 / rdfs9 in one pass: every triple hands out the types that
    # its predicate's domain and range and its own class imply; asserted types
    # come along flagged, to be taken out of the inferred ones again.
    none = F.array().cast("array<string>")

    def typed(x: str, classes) -> Column:
        return F.transform(F.coalesce(classes, none), lambda c: F.struct(F.col(x).alias("subject"), c.alias("object"), F.lit(1).alias("__new")))

    own = F.array(F.struct("subject", "object", F.lit(0).alias("__new")))
    types = F.concat(
        typed("subject", F.col("dom_classes")),
        typed("object", F.when(is_iri, F.col("rng_classes"))),
        typed("subject", F.when(is_type, F.col("supers"))),
        F.filter(own, lambda _: is_type),
    )
    widened = (
        t1.join(domain, t1.predicate == domain.dom_p, "left")
        .join(rng, t1.predicate == rng.rng_p, "left")
        .join(supers, is_type & (t1.object == supers["sub"]), "left")
    )
    typings = widened.select(F.inline(types))

    # Schema typing implied by the RDFS axiomatic triples, from the predicates
    # and asserted classes in use (a schema-sized aggregate of t1).
    usage = t1.select("predicate", F.when(is_type, F.col("object")).alias("cls"), is_iri.alias("on_iri")).distinct()
    usage = write_table(spark, usage, "rdfs-usage")
    props = (
        usage.select(F.col("predicate").alias("x"))
        .unionByName(tb.where(F.col("predicate").isin(RDFS_DOMAIN, RDFS_RANGE, RDFS_SUBPROPERTY)).select(F.col("subject").alias("x")))
        .unionByName(tb.where(F.col("predicate") == RDFS_SUBPROPERTY).select(F.col("object").alias("x")))
    )
    named = usage.where("cls is not null").select(F.col("cls").alias("x"))
    classes = [
        named,
        named.join(sub_cls, named.x == sub_cls["sub"]).select(F.col("sup").alias("x")),
        usage.join(domain, usage.predicate == domain.dom_p).select(F.explode("dom_classes").alias("x")),
        usage.where("on_iri").join(rng, F.col("predicate") == rng.rng_p).select(F.explode("rng_classes").alias("x")),
        tb.where(F.col("predicate").isin(RDFS_DOMAIN, RDFS_RANGE, RDFS_SUBCLASS)).select(F.col("object").alias("x")),
        tb.where(F.col("predicate") == RDFS_SUBCLASS).select(F.col("subject").alias("x")),
    ]
    property_types = props.distinct().select(F.col("x").alias("subject"), F.lit(RDF_PROPERTY).alias("object"), F.lit(1).alias("__new"))
    class_types = reduce(DataFrame.unionByName, classes).distinct().select(F.col("x").alias("subject"), F.lit(RDFS_CLASS).alias("object"), F.lit(1).alias("__new"))
    # rdf:Property / rdfs:Class are themselves objects of the typing triples
    # just made, hence classes too (needed for the result to be a fix-point).
    meta = property_types.select("object").unionByName(class_types.select("object")).distinct()
    meta_types = meta.select(F.col("object").alias("subject"), F.lit(RDFS_CLASS).alias("object"), F.lit(1).alias("__new"))
    # t1 is already a set: only the type pairs are deduplicated (one shuffle of
    # them), and those already asserted are left out; t1 is not reshuffled.
    new = (
        typings.unionByName(property_types)
        .unionByName(class_types)
        .unionByName(meta_types)
        .groupBy("subject", "object")
        .agg(F.min("__new").alias("__new"))
        .where(F.col("__new") == 1)
        .select(*_iri_triple(F.col("subject"), F.lit(RDF_TYPE), F.col("object")))
    )
    return t1.unionByName(new)
