"""URL verdicts: rules first, trust and distrust over the link graph for the rest.

A rule names a host and a path prefix; it fits urls of the host and of its
subdomains whose path starts with the prefix, and the longest fitting rule
decides.  Pages without a rule get the verdict of their host: hosts are
connected by the absolute links of their pages, trust spreads along the links
from hosts in proportion to their allowed pages, distrust spreads against them
from hosts in proportion to their blocked pages (a page that links to a bad
host is suspect), both as personalised PageRank, in rounds until every host has
settled.
A host is blocked if distrust makes up at least ``threshold`` of its trust and
distrust together; a host that neither reaches is allowed.

Pages are reduced to hosts and distinct host edges by aggregates with map-side
partial sums before anything is joined, so a host of very many pages or links
is one row a task; every round writes its host table to the shared folder.

Defined results: a null url or one without ``://`` has an empty host and path, no
rule and the verdict of a host that nothing reaches (allow); a null page body
has no links; repeated rows each get their verdict and weigh as often as they
occur; links of a host to itself do not count.  Other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zoneflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """``allow`` or ``block`` for a host with its subdomains and a path prefix."""

    action: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _longest(rules: list[Rule], host: Column, path: Column, value) -> Column:
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    return F.coalesce(*(F.when(r.fits(host, path), F.lit(value(r))) for r in ordered)) if ordered else F.lit(None).cast("string")


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(source, target, links) of the absolute links between different hosts."""
    links = pages.select(F.col(host).alias("source"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("target"))
    links = links.withColumn("target", F.translate("target", UPPER, LOWER)).where("source <> target and source <> ''")
    return links.groupBy("source", "target").agg(F.count("*").alias("links"))


def spread_trust(seeds: DataFrame, edges: DataFrame, rounds: int | None, damping: float, tolerance: float = 1e-6) -> DataFrame:
    """(host, trust, distrust) from (host, allowed, blocked) shares after ``rounds`` rounds.

    None: as many as it takes until no host is newly reached and none changes by more than ``tolerance`` of its value.
    """
    spark = seeds.sparkSession
    start = seeds.select("host", F.col("allowed").alias("trust"), F.col("blocked").alias("distrust"))
    edges = materialize(spark, edges, "urls-edges")
    if edges.isEmpty():
        return start.select("host", *(((1 - damping) * F.col(c)).alias(c) for c in ("trust", "distrust")))
    # links with their share among those of the source and among those into the target
    out = edges.groupBy("source").agg(F.sum("links").alias("n_out"))
    into = edges.groupBy("target").agg(F.sum("links").alias("n_in"))
    shares = materialize(spark, edges.join(out, "source").join(into, "target").select("source", "target", (F.col("links") / F.col("n_out")).alias("forward"), (F.col("links") / F.col("n_in")).alias("backward")), "urls-shares")
    ends = shares.select(F.col("source").alias("host")).unionByName(shares.select(F.col("target").alias("host"))).distinct()
    base = materialize(spark, start.join(ends, "host", "full").select("host", F.coalesce("trust", F.lit(0.0)).alias("trust0"), F.coalesce("distrust", F.lit(0.0)).alias("distrust0")), "urls-base")
    state = base.select("host", *(((1 - damping) * F.col(f"{c}0")).alias(c) for c in ("trust", "distrust")))
    for _ in count() if rounds is None else range(rounds):
        forward = shares.join(state.select(F.col("host").alias("source"), "trust"), "source").select(F.col("target").alias("host"), (F.col("trust") * F.col("forward")).alias("t"), F.lit(0.0).alias("d"))
        backward = shares.join(state.select(F.col("host").alias("target"), "distrust"), "target").select(F.col("source").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("backward")).alias("d"))
        got = forward.unionByName(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        new = base.join(got, "host", "left").join(state.select("host", F.col("trust").alias("trust_was"), F.col("distrust").alias("distrust_was")), "host")
        state = materialize(
            spark,
            new.select(
                "host",
                ((1 - damping) * F.col("trust0") + damping * F.coalesce("t", F.lit(0.0))).alias("trust"),
                ((1 - damping) * F.col("distrust0") + damping * F.coalesce("d", F.lit(0.0))).alias("distrust"),
                "trust_was",
                "distrust_was",
            ),
            "urls-round",
        )
        # a host that is reached anew changes by its whole value
        moves = [F.abs(F.col(c) - F.col(f"{c}_was")) > tolerance * F.col(c) for c in ("trust", "distrust")]
        if rounds is None and state.where(moves[0] | moves[1]).isEmpty():
            break
    return state.select("host", "trust", "distrust")


def judge(
    pages: DataFrame,
    rules: list[Rule],
    id_column: str = "page_id",
    url: str = "url",
    html: str = "html",
    rounds: int | None = None,
    damping: float = 0.6,
    threshold: float = 0.5,
) -> DataFrame:
    """id, host, path, rule (name or null), verdict, and the host's trust and distrust."""
    spark = pages.sparkSession
    parsed = pages.select(F.col(id_column).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"), F.col(html).alias("html"))
    parsed = parsed.withColumns({"rule": _longest(rules, F.col("host"), F.col("path"), lambda r: r.name), "action": _longest(rules, F.col("host"), F.col("path"), lambda r: r.action)})
    share = lambda action: (F.sum(F.when(F.col("action") == action, 1).otherwise(0)) / F.count("*")).alias({"allow": "allowed", "block": "blocked"}[action])
    seeds = parsed.groupBy("host").agg(share("allow"), share("block"))
    state = spread_trust(seeds, host_edges(parsed, "host", "html"), rounds, damping)
    distrusted = (F.col("trust") + F.col("distrust") > 0) & (F.col("distrust") >= threshold * (F.col("trust") + F.col("distrust")))
    hosts = materialize(spark, state.select("host", "trust", "distrust", F.when(distrusted, "block").otherwise("allow").alias("host_verdict")), "urls-hosts")
    out = parsed.drop("html").join(hosts, "host", "left")
    return out.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("action", "host_verdict", F.lit("allow")).alias("verdict"), "trust", "distrust")
