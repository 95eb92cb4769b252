"""Fact enrichment: role-playing star joins, string aggregation.

Join strategy is left to Catalyst/AQE: a dimension is broadcast at run time
only when its measured size is under ``spark.sql.autoBroadcastJoinThreshold``
(that is the size check); above it the join falls back to a shuffle join.
``fixed_dim`` marks dimensions whose size is bounded by their definition
(e.g. 25 nations) and is therefore always safe to broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Role:
    """One role a dimension plays for a fact.

    ``on`` maps fact column -> dimension column; ``columns`` maps dimension
    column -> the role-specific output name.  ``fixed_size`` states that the
    dimension has a bounded size so it can be broadcast without a check.
    """

    dim: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str] = field(default_factory=dict)
    how: str = "inner"
    fixed_size: bool = False


def join_role(fact: DataFrame, role: Role) -> DataFrame:
    """Join one pre-renamed dimension; its key columns are not kept."""
    keys = {d: f"__k{i}" for i, d in enumerate(role.on.values())}
    dim = role.dim.select(
        *[F.col(d).alias(k) for d, k in keys.items()],
        *[F.col(c).alias(n) for c, n in role.columns.items()],
    )
    if role.fixed_size:
        dim = F.broadcast(dim)
    cond = [fact[f] == dim[keys[d]] for f, d in role.on.items()]
    return fact.join(dim, cond, role.how).drop(*keys.values())


def star_join(fact: DataFrame, roles: Sequence[Role]) -> DataFrame:
    """Chain of role joins (matches -> league -> home -> away -> venue)."""
    out = fact
    for r in roles:
        out = join_role(out, r)
    return out


def sentence(parts: Sequence) -> Column:
    """``concat`` template; any null part makes the sentence null."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def string_agg(
    pairs: DataFrame, key: str | Sequence[str], value: str, out: str, sep: str = ", "
) -> DataFrame:
    """Per key the sorted, comma-joined distinct values (Q9: ordered).

    Pairs are deduplicated first (map-side partial aggregation), so each
    group collects at most the number of distinct values, not its row count.
    """
    keys = [key] if isinstance(key, str) else list(key)
    distinct_pairs = pairs.select(*keys, value).where(F.col(value).isNotNull()).distinct()
    return distinct_pairs.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_list(value)), sep).alias(out)
    )
