"""Ranked lexical search: best-first document intervals bounded by range-maximum tables.

``build_index`` turns every input partition into segments of about 8 MB of text.
A segment holds its documents in ascending order of id and, for each of its
terms, the posting list (documents and occurrences).  The index is a table in
the shared folder and covers every row and every term; searching it again, or
for another set of items, does not read the texts.

``search`` works on one segment at a time, with the items of a block at hand:

- the asked terms' posting lists get their impacts (a term's share of a
  document's score) and lie end to end, as do their sparse tables: level j has
  for each posting the place of the largest impact among the 2**j that follow,
  so two look-ups give the largest impact of any range of a list;
- an interval of documents is a range of each of the item's lists.  The sum of
  the ranges' maxima bounds every score in it.  Intervals are taken best bound
  first; the interval is split at the document of its largest impact, which is
  scored, and the two sides are bounded anew.  A side with few postings left
  is scored at once;
- an item is done in a segment when no interval can hold a better document than
  its k-th best.  What was found in a task's earlier segments counts too.

Each task returns its k best for each item, and Spark ranks those.

Terms are the maximal runs of ASCII letters, digits and all characters beyond
ASCII, with only A-Z lower-cased.  Weights follow the number of documents with
a term (df) among those with any term (N): floor(1000 ln((2N + 2) / (2 df + 1))).
A document of n terms has m = 25 + (75 n N) div L, where L counts all terms, and
an occurrence count tf gives the share weight * ((10**9 tf) div (1000 tf + 8 m)).

Defined results: null and empty texts, and texts without a term, are no
candidates; every input row is a document of its own, so repeated rows rank
beside each other; equal scores rank by id, null first; every row of the items
is an item of its own and asks for a repeated term as often as it holds it; an
item without a term, or whose documents all score 0, gets no row; other columns
are ignored, whatever their names; empty tables give an empty result.  A very
long text is a segment of its own.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BinaryType, LongType, StringType, StructField, StructType

from zoneflow.llm.bpe import _flat_gather, _pack, _unpack
from zoneflow.llm.common import ascii_words, keyed_rows, keyed_slices, row_of
from zoneflow.session import materialize

SEGMENT_BYTES = 8 << 20
LANES = 256
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def term_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Row offsets, a code for each term of the texts, and the distinct terms by code."""
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].copy() if n else np.zeros(1, np.int32)
    raw = texts.buffers()[2] if n else None
    data = raw[offsets[0] : offsets[-1]].to_pybytes().translate(_KEEP) if raw is not None else b""
    return ascii_words(pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data)]))


def postings(offsets: np.ndarray, codes: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By term: where its list begins, then the lists' rows (ascending) and occurrences."""
    n_rows = max(1, len(offsets) - 1)
    keys, counts = np.unique(codes * n_rows + row_of(offsets), return_counts=True)
    return np.searchsorted(keys, np.arange(n_terms + 1) * n_rows), keys % n_rows, counts


def build_index(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row a segment: ids, terms of each document, distinct terms and their posting lists; with_terms and n_terms count its documents and terms."""
    rows = keyed_rows(docs, id_column, (), text)
    id_type = rows.schema["key"].dataType.fields[0].dataType
    schema = StructType(
        [StructField(c, t) for c, t in (("with_terms", LongType()), ("n_terms", LongType()), ("ids", ArrayType(id_type)), ("terms", ArrayType(StringType())))]
        + [StructField(c, BinaryType()) for c in ("sizes", "starts", "rows", "counts")]
    )

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, texts in keyed_slices(batch, text, max_bytes=SEGMENT_BYTES):
                ids = key.field(0)
                order = pc.array_sort_indices(ids, null_placement="at_start")
                ids = ids.take(order)
                offsets, codes, terms = term_arrays(texts.take(order))
                sizes = np.diff(offsets)
                starts, at, counts = postings(offsets, codes, len(terms))
                columns = [
                    pa.array([int((sizes > 0).sum())], pa.int64()),
                    pa.array([len(codes)], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.ListArray.from_arrays(pa.array([0, len(terms)], pa.int32()), terms),
                    *(pa.array([_pack(x)], pa.binary()) for x in (sizes, starts, at, counts)),
                ]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    return materialize(docs.sparkSession, rows.mapInArrow(indexed, schema), "lexical-index")


class Segment:
    """The asked terms' posting lists of one segment, with impacts and sparse tables."""

    def __init__(self, ids: list, sizes: np.ndarray, found: np.ndarray, starts: np.ndarray, rows: np.ndarray, counts: np.ndarray, weights: np.ndarray, total_docs: int, total_terms: int):
        """``found`` has for each term of the segment its number among the asked ones, or -1."""
        self.ids, self.n = ids, max(1, len(ids))
        here = np.flatnonzero(found >= 0)
        self.local = np.full(len(weights), -1, np.int64)
        self.local[found[here]] = np.arange(len(here))
        lengths = starts[here + 1] - starts[here]
        at = _flat_gather(here, starts, np.arange(len(rows)))
        self.begin = np.concatenate([[0], np.cumsum(lengths)])
        self.rows = rows[at]
        self.keys = np.repeat(np.arange(len(here)), lengths) * self.n + self.rows
        m = 25 + (75 * sizes.astype(np.int64) * total_docs) // total_terms
        tf = counts[at].astype(np.int64)
        self.impacts = np.repeat(weights[found[here]], lengths) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[self.rows]))
        self.tables = [np.arange(len(at), dtype=np.int32)]
        while 2 << (len(self.tables) - 1) <= lengths.max(initial=0):
            below, half = self.tables[-1], 1 << (len(self.tables) - 1)
            right = np.concatenate([below[half:], below[len(below) - half :]])
            self.tables.append(np.where(self.impacts[below] >= self.impacts[right], below, right))
        self.table = np.stack(self.tables)

    def best(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each range the place of its largest impact, and that impact; 0 for an empty range."""
        level = np.frexp(np.maximum(hi - lo, 1))[1] - 1
        last = len(self.keys) - 1
        x, y = self.table[level, np.minimum(lo, last)], self.table[level, np.clip(hi - (1 << level), 0, last)]
        at = np.where(self.impacts[x] >= self.impacts[y], x, y)
        return at, np.where(hi > lo, self.impacts[at], 0)


class Best:
    """The k best (score, id) so far; equal scores by ascending id, null first."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.last = k, [], 1, None

    def offer(self, score: int, key) -> None:
        row = (-score, (key is not None, key))
        if len(self.rows) < self.k or row < self.rows[-1]:
            bisect.insort(self.rows, row)
            del self.rows[self.k :]
            if len(self.rows) == self.k:
                self.least, self.last = -self.rows[-1][0], self.rows[-1][1]

    def open(self, bound: int, key) -> bool:
        """Whether a document that scores ``bound`` at most, with an id not below ``key``, may still enter."""
        return bound > self.least or bound == self.least and (self.last is None or (key is not None, key) < self.last)


def search_segment(segment: Segment, terms: np.ndarray, times: np.ndarray, best: Best, leaf: int = 1024) -> int:
    """Offers ``best`` every document of the segment that may belong to an item's k best; returns how many were scored."""
    local = segment.local[terms]
    lists, times = local[local >= 0], times[local >= 0]
    if not len(lists):
        return 0
    scored, tickets, heap = 0, 0, []

    def push(first: int, lo: np.ndarray, hi: np.ndarray) -> None:
        nonlocal tickets
        at, top = segment.best(lo, hi)
        shares = top * times
        bound = int(shares.sum())
        if bound and best.open(bound, segment.ids[first]):
            tickets += 1
            heapq.heappush(heap, (-bound, tickets, first, lo, hi, at, shares))

    push(0, segment.begin[lists], segment.begin[lists + 1])
    while heap:
        bound, _, first, lo, hi, at, shares = heapq.heappop(heap)
        if not best.open(-bound, segment.ids[first]):
            if -bound < best.least:
                break
            continue
        left = hi - lo
        if left.sum() <= leaf:
            which = np.repeat(np.arange(len(lists)), left)
            place = np.arange(len(which)) - np.repeat(np.cumsum(left) - left - lo, left)
            rows, group = np.unique(segment.rows[place], return_inverse=True)
            scores = np.zeros(len(rows), np.int64)
            np.add.at(scores, group, segment.impacts[place] * times[which])
            scored += len(rows)
            for i in np.flatnonzero(scores >= best.least).tolist():
                best.offer(int(scores[i]), segment.ids[rows[i]])
            continue
        row = int(segment.rows[at[np.argmax(shares)]])
        wanted = lists * segment.n + row
        split = np.searchsorted(segment.keys, wanted)
        has = segment.keys[np.minimum(split, len(segment.keys) - 1)] == wanted
        score = int((segment.impacts[split[has]] * times[has]).sum())
        scored += 1
        if score:
            best.offer(score, segment.ids[row])
        push(first, lo, split)
        if row + 1 < segment.n:
            push(row + 1, split + has, hi)
    return scored


def _asked(items: DataFrame, text: str, id_column: str) -> DataFrame:
    """The items' rows, numbered: item, key, terms and how often the item holds each."""
    rows = keyed_rows(items, id_column, (), text).withColumn("item", F.monotonically_increasing_id())
    schema = StructType(
        [StructField("item", LongType()), StructField("key", rows.schema["key"].dataType), StructField("terms", ArrayType(StringType())), StructField("times", ArrayType(LongType()))]
    )

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, codes, terms = term_arrays(pc.fill_null(batch.column("text").cast(pa.string()), ""))
            held = [np.unique(codes[a:b], return_counts=True) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(c) for c, _ in held])]).astype(np.int32), pa.int32())
            flat = np.concatenate([c for c, _ in held]) if held else np.zeros(0, np.int64)
            times = np.concatenate([n for _, n in held]) if held else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("item"), batch.column("key"), pa.ListArray.from_arrays(ends, terms.take(pa.array(flat, pa.int64()))), pa.ListArray.from_arrays(ends, pa.array(times, pa.int64()))], schema.names
            )

    return materialize(items.sparkSession, rows.mapInArrow(counted, schema), "lexical-items")


def _document_counts(index: DataFrame, terms: pa.Array) -> np.ndarray:
    """The number of documents that hold each of ``terms``."""
    shared = index.sparkSession.sparkContext.broadcast(terms)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                found = pc.fill_null(pc.index_in(batch.column("terms")[i].values, value_set=shared.value), -1).to_numpy(zero_copy_only=False)
                lengths = np.diff(_unpack(batch.column("starts")[i].as_py()))
                np.add.at(total, found[found >= 0], lengths[found >= 0])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["term", "df"])

    rows = index.select("terms", "starts").mapInArrow(counted, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(len(terms), np.int64)
    out[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return out


def search(index: DataFrame, items: DataFrame, k: int = 10, text: str = "text", item_column: str = "item_id", id_column: str = "doc_id", block_terms: int = 1_000_000) -> DataFrame:
    """item_id, rank (from 1), doc_id and score of each item's ``k`` best documents of an index.

    Items are searched in blocks of about ``block_terms`` terms, which is what a task holds of them.
    """
    spark = index.sparkSession
    id_type = index.schema["ids"].dataType.elementType
    asked = _asked(items, text, item_column)
    total_docs, total_terms = index.agg(F.coalesce(F.sum("with_terms"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    asked_terms = asked.agg(F.coalesce(F.sum(F.size("terms").cast("long")), F.lit(0))).first()[0]
    found_type = StructType([StructField("item", LongType()), StructField("lane", LongType()), StructField("doc", id_type), StructField("score", LongType())])
    found = spark.createDataFrame([], found_type)
    blocks = -(-asked_terms // block_terms) if total_docs else 0
    for block in range(blocks):
        rows = asked.where((F.pmod(F.xxhash64("item"), F.lit(blocks)) == block) & (F.size("terms") > 0)).select("item", "terms", "times").toArrow().combine_chunks()
        if rows.num_rows:
            found = found.unionByName(_search_block(index, rows, found_type, k, total_docs, total_terms))
    best = F.struct((-F.col("score")).alias("score"), F.col("doc"))
    # two steps, so that an item's candidates of all tasks do not meet in one at once
    for keys in (["item", "lane"], ["item"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(best))).where(F.col("rank") <= k)
    names = asked.select("item", F.col("key").getField(item_column).alias("name"))
    return found.join(names, "item").select(F.col("name").alias("item_id"), "rank", F.col("doc").alias("doc_id"), "score")


def _search_block(index: DataFrame, rows: pa.Table, found_type: StructType, k: int, total_docs: int, total_terms: int) -> DataFrame:
    doc_type = to_arrow_type(found_type["doc"].dataType)
    lists, times = rows.column("terms").combine_chunks(), rows.column("times").combine_chunks()
    coded = lists.flatten().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    terms = coded.dictionary
    df = _document_counts(index, terms)
    weights = np.array([math.floor(1000 * math.log((2 * total_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    shared = index.sparkSession.sparkContext.broadcast(
        (terms, weights, rows.column("item").to_pylist(), offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), times.flatten().to_numpy(zero_copy_only=False).astype(np.int64))
    )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, weights, names, offsets, codes, times = shared.value
        best = [Best(k) for _ in names]
        for batch in batches:
            for i in range(batch.num_rows):
                found = pc.fill_null(pc.index_in(batch.column("terms")[i].values, value_set=terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)
                sizes, starts, at, counts = (_unpack(batch.column(c)[i].as_py()) for c in ("sizes", "starts", "rows", "counts"))
                segment = Segment(batch.column("ids")[i].as_py(), sizes, found, starts, at, counts, weights, total_docs, total_terms)
                for j, held in enumerate(best):
                    search_segment(segment, codes[offsets[j] : offsets[j + 1]], times[offsets[j] : offsets[j + 1]], held)
        lane = TaskContext.get().partitionId() % LANES
        out = [(name, lane, key[1], -score) for name, held in zip(names, best, strict=True) for score, key in held.rows]
        columns = list(zip(*out, strict=True)) or [[]] * 4
        kinds = [pa.int64(), pa.int64(), doc_type, pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], found_type.names)

    return index.select("ids", "terms", "sizes", "starts", "rows", "counts").mapInArrow(searched, found_type)
