"""Seeded, exactly reproducible sampling (T6, T8/G8) and the triple
train/test split with negatives (G9).

Randomness is a keyed hash: ``h(x) = first 8 hex digits of sha256(x)`` as an
integer, so the same draw is reproducible in any engine that has sha256.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zoneflow.session import materialize


def h32(*parts) -> Column:
    """Keyed 32-bit hash of ':'-joined parts."""
    s = F.concat_ws(":", *[p if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    return F.conv(F.substring(F.sha2(s, 256), 1, 8), 16, 10).cast("bigint")


def positions(spark: SparkSession, df: DataFrame, order_cols: list, name: str = "pos") -> DataFrame:
    """``df`` with each row's place in the order of ``order_cols`` (0, 1, ..., over all rows).

    Range partitions are sorted and numbered on their own, and a partition's
    offset is a running sum over one row a partition: no window holds all rows,
    and no key needs to fit a task.  The numbered table is written once, so the
    numbers are stable on recompute."""
    ranged = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    tagged = materialize(spark, ranged.withColumns({"__pid": F.spark_partition_id(), "__mono": F.monotonically_increasing_id()}), "positions")
    counts = tagged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__pid", F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__off"))
    pos = F.col("__off") + F.col("__mono") - F.shiftleft(F.col("__pid").cast("bigint"), 33)
    return tagged.join(offsets, "__pid").withColumn(name, pos.cast("bigint")).drop("__pid", "__mono", "__off")


def dense_index(spark: SparkSession, df: DataFrame, order_col: str, idx_col: str = "idx") -> DataFrame:
    """0-based dense index of the distinct values of ``order_col`` in sort order."""
    return positions(spark, df.select(order_col).distinct(), [order_col], idx_col).select(order_col, idx_col)


def sample_cap(df: DataFrame, key_col: str, n: int, method: str = "random", seed: int = 0) -> DataFrame:
    """At most ``n`` rows - a seeded random subset without replacement
    (hash order) or the first ``n`` in key order; ``n <= 0`` = no cap.
    A distributed top-n (TakeOrderedAndProject), not a global sort."""
    if n <= 0:
        return df
    order = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key_col).cast("string")), 256) if method == "random" else F.col(key_col)
    return df.orderBy(order, F.col(key_col)).limit(n)


def sample_k_per_key(
    spark: SparkSession,
    keys: DataFrame,
    key_col: str,
    items: DataFrame,
    item_col: str,
    lo: int = 1,
    hi: int = 3,
    seed: int = 0,
) -> DataFrame:
    """Every key draws k ~ U[lo, hi] (capped by the number of
    items m) distinct items uniformly without replacement.

    Floyd's algorithm folded over the steps with ``aggregate`` (the plan has
    one size for any ``hi``): for j = m-k .. m-1 draw t in [0, j]; take t unless already taken, else j.
    It needs no cross join and no candidate cap, and the work per key is
    O(hi); the chosen item indices are equi-joined to the indexed items.
    """
    idx = dense_index(spark, items, item_col)
    m = idx.count()
    k_raw = F.lit(lo) + F.pmod(h32(seed, F.col(key_col), "k"), F.lit(hi - lo + 1))
    state = keys.select(F.col(key_col), F.least(k_raw, F.lit(m)).cast("bigint").alias("__k"))
    drawn_idx = _floyd(F.lit(m), F.col("__k"), lambda i: h32(seed, F.col(key_col), i.cast("string")))
    state = state.select(F.col(key_col), drawn_idx.alias("__s"))
    drawn = state.select(F.col(key_col), F.explode("__s").alias("idx"))
    return drawn.join(idx.hint("merge"), "idx").select(key_col, item_col)  # items are as many as their table has, see draw_from_pools


def _indexed(spark: SparkSession, triples: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entity, idx), (predicate, pidx) and the distinct IRI triples as numbers (s, p, o)."""
    t = triples.where(F.col("object_kind") == "iri").select("subject", "predicate", "object").distinct()
    t = materialize(spark, t, "iri-triples")
    entities = materialize(spark, dense_index(spark, t.select(F.col("subject").alias("entity")).unionByName(t.select(F.col("object").alias("entity"))), "entity"), "entities")
    predicates = materialize(spark, dense_index(spark, t, "predicate", "p"), "predicates")
    numbered = t.join(entities.select(F.col("entity").alias("subject"), F.col("idx").alias("s")), "subject")
    numbered = numbered.join(entities.select(F.col("entity").alias("object"), F.col("idx").alias("o")), "object").join(predicates, "predicate")
    return entities, predicates, materialize(spark, numbered.select("s", "p", "o", h32_of("subject", "predicate", "object")), "numbered-triples")


def draw_from_pools(spark: SparkSession, keys: DataFrame, key_col: str, pools: DataFrame, limits: dict[str, tuple[int, int]], seed: int = 0) -> DataFrame:
    """(key, kind, item): every key draws k ~ U[lo, hi] distinct items of each kind, uniformly without replacement.

    ``pools`` (kind, item) holds all kinds' items, ``limits`` the (lo, hi) of each
    kind.  The items are numbered once, kind after kind, so one draw and one
    join serve all pools: a kind is an offset and a size.  A kind with fewer
    items than k gives them all, one without items none."""
    numbered = materialize(spark, positions(spark, pools.select("kind", "item").dropna().distinct(), ["kind", "item"], "idx"), "pools")
    spans = numbered.groupBy("kind").agg(F.min("idx").alias("offset"), F.count("*").alias("m"))
    bounds = spark.createDataFrame([(k, lo, hi) for k, (lo, hi) in limits.items()], "kind string, lo int, hi int")
    kinds = [tuple(r) for r in spans.join(bounds, "kind").select("kind", "offset", "m", "lo", "hi").collect()]  # one row a kind
    if not kinds:
        return keys.select(key_col).limit(0).crossJoin(numbered.select("kind", "item").limit(0))
    each = F.array(*(F.struct(F.lit(k).alias("kind"), F.lit(o).cast("bigint").alias("offset"), F.lit(m).cast("bigint").alias("m"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for k, o, m, lo, hi in kinds))
    asked = keys.select(F.col(key_col), F.explode(each).alias("p")).select(key_col, "p.*")
    k = F.col("lo") + F.pmod(h32(seed, F.col("kind"), F.col(key_col), "k"), F.col("hi") - F.col("lo") + 1)
    asked = asked.withColumn("__k", F.least(k, F.col("m")).cast("bigint"))
    drawn = asked.select(key_col, "kind", "offset", F.explode(_floyd(F.col("m"), F.col("__k"), lambda i: h32(seed, F.col("kind"), F.col(key_col), i.cast("string")))).alias("t"))
    # the pools are as large as their tables, whatever their size when compressed: never held whole by the driver or a task
    items = numbered.select("idx", "item").hint("merge")
    return drawn.withColumn("idx", F.col("offset") + F.col("t")).join(items, "idx").select(key_col, "kind", "item")


def _floyd(m: Column, k: Column, draw) -> Column:
    """k distinct numbers below m, uniformly: for j = m-k .. m-1 draw t in [0, j]; take t unless taken, else j."""
    none = F.array().cast("array<bigint>")

    def step(taken: Column, i: Column) -> Column:
        j = m - k + i
        t = F.pmod(draw(i), j + 1)
        return F.array_append(taken, F.when(F.array_contains(taken, t), j).otherwise(t))

    steps = F.when(k > 0, F.sequence(F.lit(0).cast("bigint"), k - 1)).otherwise(none)
    return F.aggregate(steps, none, step)


def h32_of(*cols: str) -> Column:
    """The columns' texts, joined: what a triple's draws are keyed by."""
    return F.concat_ws(":", *cols).alias("text")


def negatives(spark: SparkSession, triples: DataFrame, known: DataFrame, n_entities: int, seed: int = 0, rounds: int = 6) -> DataFrame:
    """One corrupted triple for each (s, p, o) of ``triples``: columns ns and no, of which one is replaced.

    Bernoulli corruption: a head is replaced with the odds of the predicate's
    distinct tails to its distinct heads, so that a predicate with many heads
    for a tail has its head replaced less often.  A replacement is drawn from
    all entities and drawn again, by an anti-join with the known triples, until
    it is not known; what ``rounds`` draws leave open (almost all entities are
    known there) draws among the entities that are not, by counting in their
    order.  Null only if every entity makes a known triple."""
    heads = known.select("p", "s").distinct().groupBy("p").agg(F.count("*").alias("ds"))
    tails = known.select("p", "o").distinct().groupBy("p").agg(F.count("*").alias("do"))
    key = lambda what: h32(seed, what, F.col("s").cast("string"), F.col("p").cast("string"), F.col("o").cast("string"))
    rest = triples.join(heads.join(tails, "p"), "p").withColumn("head", F.pmod(key("side"), F.col("ds") + F.col("do")) < F.col("do"))
    rest = materialize(spark, rest.select("s", "p", "o", "head"), "neg-rest")
    have = known.select(F.col("s").alias("ns"), "p", F.col("o").alias("no"), F.lit(True).alias("known"))
    done = []
    put = lambda df, neg: df.withColumns({"ns": F.when(F.col("head"), neg).otherwise(F.col("s")), "no": F.when(F.col("head"), F.col("o")).otherwise(neg)})
    for r in range(rounds):
        drawn = put(rest, F.pmod(key(f"neg{r}"), F.lit(n_entities)))
        # few are drawn again: their table's size is known, so the known triples are not shuffled for them
        met = have.join(drawn.select("ns", "p", "no"), ["ns", "p", "no"], "left_semi") if r else have
        drawn = materialize(spark, drawn.join(met, ["ns", "p", "no"], "left"), "neg-drawn")
        done.append(drawn.where("known IS NULL").select("s", "p", "o", "ns", "no"))
        rest = materialize(spark, drawn.where("known").select("s", "p", "o", "head"), "neg-rest")
        if rest.isEmpty():
            return reduce(DataFrame.unionByName, done)
    return reduce(DataFrame.unionByName, [*done, _unknown_ones(spark, rest, known, n_entities, key("last"), put)])


def _unknown_ones(spark: SparkSession, rest: DataFrame, known: DataFrame, n_entities: int, draw: Column, put) -> DataFrame:
    """A draw among the entities that make no known triple: the j-th missing number of each anchor's known ones.

    If an anchor's known numbers are k_0 < k_1 < ..., then k_i - i are missing
    before k_i, so the j-th missing one is j + the count of k_i - i <= j.  The
    counts are places in one order, whatever the size of an anchor."""
    anchor = ["head", "p", "a"]
    rest = rest.withColumn("a", F.when(F.col("head"), F.col("o")).otherwise(F.col("s")))
    sides = known.select(F.lit(True).alias("head"), "p", F.col("o").alias("a"), F.col("s").alias("k")).unionByName(known.select(F.lit(False).alias("head"), "p", F.col("s").alias("a"), F.col("o").alias("k")))
    sides = positions(spark, sides.join(rest.select(*anchor).distinct(), anchor, "left_semi").distinct(), [*anchor, "k"])
    totals = sides.groupBy(*anchor).agg(F.min("pos").alias("start"), F.count("*").alias("m"))
    gaps = sides.join(totals, anchor).select(*anchor, (F.col("k") - (F.col("pos") - F.col("start"))).alias("value"), F.lit(0).alias("asks"))
    asked = rest.join(totals.select(*anchor, "m"), anchor).withColumn("value", F.pmod(draw, F.greatest(F.lit(n_entities) - F.col("m"), F.lit(1))))
    asked = materialize(spark, asked, "neg-asked")
    open_ = positions(spark, asked.where(F.col("m") < n_entities).withColumn("asks", F.lit(1)), [*anchor, "value", "s", "o"], "own")
    both = gaps.withColumns({c: F.lit(None).cast("bigint") for c in ("s", "o", "own")}).unionByName(open_.select(*anchor, "value", "asks", "s", "o", "own"))
    both = positions(spark, both, [*anchor, "value", "asks", "s", "o"])
    starts = both.groupBy(*anchor).agg(F.min("pos").alias("start"), F.min("own").alias("own_start"))
    found = both.where("asks = 1").join(starts, anchor)
    before = (F.col("pos") - F.col("start")) - (F.col("own") - F.col("own_start"))
    found = put(found, F.col("value") + before)
    none = asked.where(F.col("m") >= n_entities).withColumns({"ns": F.lit(None).cast("bigint"), "no": F.lit(None).cast("bigint")})
    return found.select("s", "p", "o", "ns", "no").unionByName(none.select("s", "p", "o", "ns", "no"))


def split_with_negatives(spark: SparkSession, triples: DataFrame, test_per_mille: int = 100, seed: int = 0) -> DataFrame:
    """train/test split of IRI triples and one corrupted triple for each.

    A triple goes to test when its hash falls in the test share, unless it
    is the minimum-hash triple of its subject or of its object: every entity
    keeps at least one training triple.  Entities and predicates are numbered
    once and joined as numbers; see ``negatives`` for (neg_subject, neg_object),
    which are null only where every entity makes a known triple."""
    entities, predicates, t = _indexed(spark, triples)
    t = materialize(spark, t.select("s", "p", "o", h32(seed, F.col("text")).alias("h")), "split-triples")
    min_s = t.groupBy("s").agg(F.min("h").alias("min_s"))
    min_o = t.groupBy("o").agg(F.min("h").alias("min_o"))
    is_test = (F.pmod(F.col("h"), F.lit(1000)) < test_per_mille) & (F.col("h") != F.col("min_s")) & (F.col("h") != F.col("min_o"))
    split = t.join(min_s, "s").join(min_o, "o").select("s", "p", "o", F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"))
    drawn = negatives(spark, t.select("s", "p", "o"), t.select("s", "p", "o"), entities.count(), seed)
    out = split.join(drawn, ["s", "p", "o"]).join(predicates, "p")
    for column, number in (("subject", "s"), ("object", "o"), ("neg_subject", "ns"), ("neg_object", "no")):
        out = out.join(entities.select(F.col("entity").alias(column), F.col("idx").alias(number)), number, "left")
    return out.select("subject", "predicate", "object", "split", "neg_subject", "neg_object")
