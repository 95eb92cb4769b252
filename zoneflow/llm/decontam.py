"""Benchmark decontamination: a prefix-filtered set join of word shingles.

An item's windows (13 consecutive words; a shorter item is one window) are the
sets to contain, their elements the three-word shingles at their places
(shorter windows: as many words as they have).

1. One pass over the documents finds the places of every item shingle: the
   shingles of a document are joined to the distinct item shingles, compared
   by hash and then word by word.
2. Shingles are ordered by rarity over all documents.  A window must be
   contained whole, so its necessary prefix is its rarest shingle alone; a
   window with a shingle that no document holds cannot occur.
3. A place of that shingle, with its offset in the window, gives the only start
   the window can have there (positional bound) and the shingles that must lie
   before and after it (length bound).
4. Containment is verified on the document's item shingles around the place:
   all of the window's, each at its own position.

Hit words are counted by merging a document's windows as intervals, so many
overlapping windows stay one row each.  Everything is DataFrame expressions.
Item shingles and windows are broadcast if there are at most
``broadcast_rows`` of them (benchmarks are small), else joined by shuffling.

Documents are recognised by id and a hash of the text, so rows of one id with
different texts are judged by their own text.

Defined results: null and empty texts have no words and are not contaminated;
repeated rows all get their result; several items of one text are all listed,
items without a word match nothing, a null item_id is listed as an empty name;
an empty benchmark contaminates nothing.  Other columns are ignored or, if
kept as they are by ``without_contaminated``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zoneflow.session import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, item_id: str, text: str, window: int, width: int) -> DataFrame:
    """Distinct windows: w (words), k (words of a shingle), shingles (in order) and the items that hold it."""
    w = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item"), words(F.col(text)).alias("all")).where(F.size("all") > 0)
    last = F.greatest(F.size("all") - window, F.lit(0))
    spread = w.select("item", "all", F.explode(F.sequence(F.lit(0), last)).alias("start"))
    cut = spread.select("item", F.slice("all", F.col("start") + 1, F.lit(window)).alias("w"))
    distinct = cut.groupBy("w").agg(F.collect_set("item").alias("items")).withColumn("k", F.least(F.size("w"), F.lit(width)))
    shingles = F.transform(F.sequence(F.lit(0), F.size("w") - F.col("k")), lambda i: F.array_join(F.slice("w", i + 1, F.col("k")), " "))
    return distinct.withColumn("shingles", shingles)


def _shingle_places(docs: DataFrame, k: int, known: DataFrame) -> DataFrame:
    """(key, k, pos, shingle) of the ``k``-word shingles of documents that are in ``known`` (w1 .. wk, shingle, hash)."""
    parts = [F.col("all") if i == 0 else F.slice("all", F.lit(i + 1), F.greatest(F.size("all") - i, F.lit(0))) for i in range(k)]
    names = [f"w{i}" for i in range(k)]
    zipped = F.arrays_zip(*(p.alias(n) for p, n in zip(parts, names, strict=True)))
    spread = docs.select("key_id", "key_hash", F.size("all").alias("all_words"), F.posexplode(zipped).alias("pos", "z")).select("key_id", "key_hash", "all_words", "pos", *(F.col("z")[n].alias(n) for n in names))
    spread = spread.where(F.col(names[-1]).isNotNull()).withColumn("hash", F.xxhash64(*names))
    other = known.select("hash", "shingle", *(F.col(n).alias(f"i_{n}") for n in names))
    same = reduce(lambda a, b: a & b, (F.col(n) == F.col(f"i_{n}") for n in names))
    return spread.join(other, "hash").where(same).select("key_id", "key_hash", "all_words", F.lit(k).alias("k"), "pos", "shingle")


def _bounded(df: DataFrame, rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if rows <= limit else df


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _found(docs: DataFrame, benchmark: DataFrame, id_column: str, text: str, item_id: str, item_text: str, window: int, width: int, broadcast_rows: int) -> DataFrame | None:
    """(hit_id, hit_hash, n_hit, items, all_words) of the documents in which a window occurs, or None for an empty benchmark."""
    spark = docs.sparkSession
    windows = materialize(spark, item_windows(benchmark, item_id, item_text, window, width), "decontam-windows")
    known = windows.select("k", F.explode("shingles").alias("shingle")).distinct()
    sizes = {r["k"]: r["count"] for r in known.groupBy("k").count().collect()}
    keyed = docs.select(F.col(id_column).alias("key_id"), _text_key(F.col(text)).alias("key_hash"), words(F.col(text)).alias("all"))
    found = []
    for k in sorted(sizes):
        parts = F.split("shingle", " ")
        own = known.where(F.col("k") == k).select("shingle", *(parts[i].alias(f"w{i}") for i in range(k))).withColumn("hash", F.xxhash64(*(f"w{i}" for i in range(k))))
        found.append(_shingle_places(keyed, k, _bounded(own, sizes[k], broadcast_rows)))
    return _hits(spark, reduce(DataFrame.unionByName, found), windows, window, broadcast_rows) if found else None


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 13,
    width: int = 3,
    one_in: int = 20,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """id, n_words, n_hit, n_items, items (sorted names) and contaminated (``one_in`` * n_hit >= n_words > 0) of every document."""
    hits = _found(docs, benchmark, id_column, text, item_id, item_text, window, width, broadcast_rows)
    rows = docs.select(F.col(id_column).alias("key_id"), _text_key(F.col(text)).alias("key_hash"), F.size(words(F.col(text))).cast("long").alias("n_words"))
    if hits is not None:
        rows = rows.join(hits.drop("all_words"), rows["key_id"].eqNullSafe(hits["hit_id"]) & (rows["key_hash"] == hits["hit_hash"]), "left")
    else:
        rows = rows.withColumns({"n_hit": F.lit(0).cast("long"), "items": F.array().cast("array<string>")})
    n_hit, items = F.coalesce("n_hit", F.lit(0)).cast("long"), F.coalesce("items", F.array().cast("array<string>"))
    out = rows.select(F.col("key_id").alias(id_column), "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"), items.alias("items"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words")))


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 13, width: int = 3, one_in: int = 20, broadcast_rows: int = 500_000) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns; only documents with hits are counted and joined."""
    hits = _found(docs, benchmark, id_column, text, item_id, item_text, window, width, broadcast_rows)
    if hits is None:
        return docs
    spoilt = materialize(docs.sparkSession, hits.where(one_in * F.col("n_hit") >= F.col("all_words")).select("hit_id", "hit_hash"), "decontam-spoilt")
    return docs.join(spoilt, docs[id_column].eqNullSafe(spoilt["hit_id"]) & (_text_key(docs[text]) == spoilt["hit_hash"]), "left_anti")


def _hits(spark, places: DataFrame, windows: DataFrame, window: int, broadcast_rows: int) -> DataFrame:
    """(hit_id, hit_hash, n_hit, items, all_words) of the documents in which a window occurs."""
    places = materialize(spark, places, "decontam-places")
    rarity = places.groupBy("k", "shingle").count()
    spread = windows.select("w", "k", F.posexplode("shingles").alias("offset", "shingle")).join(rarity, ["k", "shingle"], "left")
    prefix = spread.groupBy("w", "k").agg(F.min_by(F.struct("shingle", "offset"), F.struct("count", "shingle", "offset")).alias("rarest"), F.min(F.coalesce("count", F.lit(0))).alias("least"))
    prefix = prefix.where("least > 0").join(windows, ["w", "k"]).select("k", F.col("rarest.shingle").alias("shingle"), F.col("rarest.offset").alias("offset"), F.size("w").alias("length"), "shingles", "items")
    prefix = materialize(spark, prefix, "decontam-prefixes")

    # each place with the item shingles around it, as far as a window can reach
    reach = window - 1
    around = Window.partitionBy("key_id", "key_hash", "k").orderBy("pos").rowsBetween(-reach, reach)
    distinct = places.repartition("key_id", "key_hash").dropDuplicates(["key_id", "key_hash", "k", "pos"])
    context = distinct.withColumn("around", F.collect_list(F.struct("pos", F.col("shingle").alias("s"))).over(around))
    start = F.col("pos") - F.col("offset")
    count = F.size("shingles")
    here = F.transform(F.filter("around", lambda x: (x["pos"] >= start) & (x["pos"] < start + count)), lambda x: x["s"])
    met = context.join(_bounded(prefix, prefix.count(), broadcast_rows), ["k", "shingle"]).where((start >= 0) & (here == F.col("shingles")))
    spans = met.select("key_id", "key_hash", start.alias("a"), (start + F.col("length")).alias("b"), "items", "all_words")

    # the union of a document's spans, from what each adds to those that start before it
    before = Window.partitionBy("key_id", "key_hash").orderBy("a", "b").rowsBetween(Window.unboundedPreceding, -1)
    added = F.greatest(F.col("b") - F.greatest("a", F.coalesce(F.max("b").over(before), F.col("a"))), F.lit(0))
    summed = spans.withColumn("added", added).groupBy("key_id", "key_hash").agg(F.sum("added").alias("n_hit"), F.flatten(F.collect_set("items")).alias("items"), F.max("all_words").alias("all_words"))
    return summed.select(F.col("key_id").alias("hit_id"), F.col("key_hash").alias("hit_hash"), "n_hit", F.array_sort(F.array_distinct("items")).alias("items"), "all_words")
