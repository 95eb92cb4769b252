"""Basic graph patterns as joins over the triples table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_path(triples: DataFrame, predicates: Sequence[str], start: str = "start", end: str = "end") -> DataFrame:
    """``?start p1 ?x1 . ?x1 p2 ?x2 ... ?x(n-1) pn ?end`` -> (start, end).

    Each hop is an inner equi-join object == subject on predicate-filtered
    triples (the predicate filter is pushed into the scan).  Solutions are
    a set, as in SPARQL over a set-valued graph."""
    hop = lambda i, p: triples.where(F.col("predicate") == p).select(
        F.col("subject").alias(f"__n{i}"), F.col("object").alias(f"__n{i + 1}")
    )
    path = hop(0, predicates[0])
    for i, p in enumerate(predicates[1:], start=1):
        path = path.join(hop(i, p), f"__n{i}")
    last = len(predicates)
    return path.select(F.col("__n0").alias(start), F.col(f"__n{last}").alias(end)).distinct()


def restrict_to(df: DataFrame, col: str, listed: DataFrame, listed_col: str) -> DataFrame:
    """Keep solutions whose ``col`` is in the listed set (``VALUES``)."""
    keys = listed.select(F.col(listed_col).alias(col)).distinct()
    return df.join(keys, col, "left_semi")


def all_triples(triples: DataFrame) -> DataFrame:
    """``SELECT ?s ?p ?o``."""
    return triples.select("subject", "predicate", "object")
