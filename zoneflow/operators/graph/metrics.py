"""G6 (KG metrics) and G7 (per-cluster top preference)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.functions.ids import ONT, RDF_TYPE
from zoneflow.operators.graph.pattern import match_path
from zoneflow.operators.graph.tbox import RDF_PROPERTY, RDFS_CLASS


def kg_metrics(triples: DataFrame, ont: str = ONT, user_class: str = "User") -> DataFrame:
    """A10 + A11 in one aggregate: triples, ontology classes, ontology
    properties, users (type + prefix filters).  ``triples`` is a set, as the
    RDFS closure is: a subject has a type once, so nothing has to be distinct."""
    is_type = F.col("predicate") == RDF_TYPE
    in_ont = F.startswith(F.col("subject"), F.lit(ont))
    return triples.agg(
        F.count(F.lit(1)).alias("n_triples"),
        F.count(F.when(is_type & (F.col("object") == RDFS_CLASS) & in_ont, F.col("subject"))).alias("n_classes"),
        F.count(F.when(is_type & (F.col("object") == RDF_PROPERTY) & in_ont, F.col("subject"))).alias("n_properties"),
        F.count(F.when(is_type & (F.col("object") == ont + user_class), F.col("subject"))).alias("n_users"),
    )


def top_preferences(
    assignments: DataFrame,
    triples: DataFrame,
    categories: Mapping[str, Sequence[str]],
    user_col: str = "user",
    cluster_col: str = "cluster",
    noise: int | None = -1,
) -> DataFrame:
    """For every cluster and category the most
    frequent name reached by the category's predicate path from the
    cluster's members (noise excluded).  All clusters in one job: the
    path solutions of all categories are unioned, counted per
    (cluster, category, name) with partial aggregation, and the arg-max per
    (cluster, category) is a ``min_by`` over (-count, name): ties -> name asc.
    """
    members = assignments.select(F.col(user_col).alias("start"), F.col(cluster_col).alias("cluster"))
    if noise is not None:
        members = members.where(F.col("cluster") != noise)
    solutions = None
    for cat, preds in categories.items():
        # The member set is applied as a join on the first hop (J6) so that
        # only members' paths are expanded.
        hop1 = triples.where(F.col("predicate") == preds[0]).select(F.col("subject").alias("start"), F.col("object").alias("x"))
        first = hop1.join(members, "start")
        if len(preds) > 1:
            sol = first.join(match_path(triples, preds[1:], "x", "name"), "x")
        else:
            sol = first.withColumn("name", F.col("x"))
        sol = sol.select("cluster", F.lit(cat).alias("category"), "start", "x", "name")
        solutions = sol if solutions is None else solutions.unionByName(sol)
    counts = solutions.groupBy("cluster", "category", "name").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("cluster", "category").agg(
        F.min_by(F.struct("name", "n"), F.struct((-F.col("n")).alias("neg"), F.col("name"))).alias("top")
    )
    return best.select("cluster", "category", F.col("top.name").alias("name"), F.col("top.n").alias("n"))
