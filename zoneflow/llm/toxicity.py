"""Toxicity: a character n-gram linear classifier with naive Bayes scaled features.

Features are the character n-grams (orders ``low`` to ``high``) inside words,
word boundaries included, hashed to ``2 ** log_buckets`` places and present or
absent in a document.  Training counts, for each place, the toxic and the clean
documents that hold it and takes the log ratio r of the two rates, smoothed
towards the class shares so that an unseen n-gram has r = 0.  The places with
the strongest association (G statistic at least ``least_g``, at most
``max_features``) enter a logistic regression in which a present feature has
the value r and weights are regularised.

The training sample holds at most about ``max_rows`` labelled documents of each
class, which bounds what is broadcast and collected.  Scoring covers every
document in whole; an n-gram is looked up once for each distinct word of a
slice of text.

Defined results: null and empty texts hold no feature and get the score of the
bias; duplicate label rows of a document count as toxic if any is; null labels
do not train; without both classes every score is the share of toxic labels
(0 without labels).  Rows repeat as often as they occur; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import ascii_words, bounded_sample, keyed_rows, keyed_slices, mix64, ngram_hashes, plain_strings, row_of, text_slices, word_points


@dataclass(frozen=True)
class Grams:
    low: int = 3
    high: int = 6
    log_buckets: int = 20


def word_features(words: list[str], grams: Grams, numbers: np.ndarray | None = None, words_a_time: int = 1 << 14) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, feature) pairs of the words' n-grams, sorted; ``numbers`` maps places to features (-1: none), default: every place."""
    pairs = []
    for begin in range(0, len(words), words_a_time):  # every n-gram of so many words is held at once
        points, word, place = word_points(words[begin : begin + words_a_time])
        found = []
        for n, hashes in enumerate(ngram_hashes(points, grams.high), 1):
            if n >= grams.low:
                ok = place >= n - 1
                feature = (mix64(hashes[ok]) >> np.uint64(64 - grams.log_buckets)).astype(np.int64)
                own = word[ok]
                if numbers is not None:
                    feature = numbers[feature]
                    own, feature = own[feature >= 0], feature[feature >= 0]
                found.append((own + begin) * (1 << 32) + feature)
        pairs.append(np.unique(np.concatenate(found)))
    own = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
    return own >> 32, own & 0xFFFFFFFF


def document_features(texts: pa.Array, grams: Grams, numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, feature) pairs, sorted; ``numbers`` maps places to features (-1: none), default: every place."""
    offsets, codes, words = ascii_words(pc.utf8_lower(texts))
    pairs = np.unique(row_of(offsets) * max(len(words), 1) + codes)
    row, code = pairs // max(len(words), 1), pairs % max(len(words), 1)
    word, feature = word_features(words.to_pylist(), grams, numbers)
    starts = np.searchsorted(word, np.arange(len(words) + 1))
    sizes = np.diff(starts)[code]
    keep = sizes > 0
    row, code, sizes = row[keep], code[keep], sizes[keep]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) - np.repeat(ends - sizes - starts[code], sizes)
    both = np.unique(np.repeat(row, sizes) * (1 << 32) + feature[at])
    return both >> 32, both & 0xFFFFFFFF


@dataclass
class ToxicityModel:
    grams: Grams
    numbers: np.ndarray  # place -> feature or -1
    weights: np.ndarray  # feature -> ratio times weight
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        row, feature = document_features(texts, self.grams, self.numbers) if len(self.weights) else (np.zeros(0, np.int64),) * 2
        margin = self.bias + (np.bincount(row, weights=self.weights[feature], minlength=len(texts)) if len(row) else np.zeros(len(texts)))
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def log_count_ratios(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int, share: float | None = None) -> np.ndarray:
    """Smoothed log ratio of the document rates of each place; 0 where nothing is known.  ``share``: of toxic documents, default: as counted."""
    share = n_toxic / (n_toxic + n_clean) if share is None else share
    return np.log((toxic + share) / n_toxic) - np.log((clean + 1 - share) / n_clean)


def g_statistic(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Twice the log likelihood ratio of one rate for both classes against a rate for each."""
    n, rest = toxic + clean, n_toxic + n_clean - toxic - clean
    out = np.zeros(len(toxic))
    for seen, of, total in ((toxic, n, n_toxic), (clean, n, n_clean), (n_toxic - toxic, rest, n_toxic), (n_clean - clean, rest, n_clean)):
        expected = of * (total / (n_toxic + n_clean))
        out += np.where(seen > 0, seen * np.log(np.maximum(seen, 1) / np.maximum(expected, 1e-12)), 0)
    return 2 * out


def fit_weights(row: np.ndarray, feature: np.ndarray, y: np.ndarray, ratios: np.ndarray, share: float, l2: float = 0.02, steps: int = 200) -> tuple[np.ndarray, float]:
    """Logistic regression on features of value ``ratios`` by Adam; the rows of each class weigh together as much as its ``share`` (of class 1)."""
    x, n = ratios[feature], len(y)
    weigh = np.where(y > 0, share / y.mean(), (1 - share) / (1 - y.mean())) / n
    w, b = np.zeros(len(ratios) + 1), np.log(share / (1 - share))
    w[-1] = b
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        margin = w[-1] + np.bincount(row, weights=x * w[feature], minlength=n)
        error = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) * weigh
        g = np.empty_like(w)
        g[:-1] = np.bincount(feature, weights=x * error[row], minlength=len(ratios)) + l2 / max(1, len(ratios)) * w[:-1]
        g[-1] = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1] * ratios, float(w[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    id_column: str = "doc_id",
    text: str = "text",
    grams: Grams = Grams(),
    max_rows: int = 10_000,
    max_features: int = 4096,
    least_g: float = 25.0,
) -> ToxicityModel:
    """Fit on the documents of ``docs`` that ``labels`` marks; two passes over the bounded sample.

    The sample thins each class by its own rate, so its rows are weighted back
    to the shares of all labelled rows: the decision does not move with the bound.
    """
    sc = docs.sparkSession.sparkContext
    marked = labels.where(F.col(label).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("id")).agg(F.max(label).cast("int").alias("y"))
    totals = {r.y: r["count"] for r in marked.groupBy("y").count().collect()}
    true_share = totals.get(1, 0) / max(1, sum(totals.values()))
    sample = bounded_sample(marked, "id", "y", max_rows, F.lit(1), seed=404)  # bounded, so it may be broadcast
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).join(F.broadcast(sample), "id").select("y", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, sizes = np.zeros((2, 1 << grams.log_buckets), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for piece in text_slices(batch, max_bytes=1 << 20, give_back=True):  # every n-gram of a slice is held at once
                y = piece.column("y").to_numpy(zero_copy_only=False)
                row, place = document_features(plain_strings(piece.column("text")), grams)
                for k in (0, 1):
                    totals[k] += np.bincount(place[y[row] == k], minlength=totals.shape[1])
                    sizes[k] += int((y == k).sum())
        seen = np.flatnonzero(totals.sum(0))
        place, clean, toxic = np.append(seen, -1), np.append(totals[0, seen], sizes[0]), np.append(totals[1, seen], sizes[1])
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (place, clean, toxic)], ["place", "clean", "toxic"])

    counts = rows.mapInArrow(count, "place long, clean long, toxic long").groupBy("place").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    place, clean, toxic = (counts.column(c).to_numpy() for c in ("place", "clean", "toxic"))
    n_clean, n_toxic = int(clean[place < 0].sum()), int(toxic[place < 0].sum())
    numbers = np.full(1 << grams.log_buckets, -1, np.int64)
    if not n_clean or not n_toxic:
        share = n_toxic / max(1, n_clean + n_toxic)
        return ToxicityModel(grams, numbers, np.zeros(0), 30.0 if share else -30.0)
    place, clean, toxic = place[place >= 0], clean[place >= 0], toxic[place >= 0]
    g = g_statistic(toxic, clean, n_toxic, n_clean)
    order = np.lexsort((place, -g))[:max_features]
    order = order[g[order] >= least_g]
    numbers[place[order]] = np.arange(len(order))
    ratios = log_count_ratios(toxic[order], clean[order], n_toxic, n_clean, true_share)
    shared = sc.broadcast(numbers)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, max_bytes=4 << 20, give_back=True):
                row, feature = document_features(plain_strings(piece.column("text")), grams, shared.value)
                starts = np.searchsorted(row, np.arange(piece.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(feature, pa.int32()))
                yield pa.RecordBatch.from_arrays([piece.column("y"), lists], ["y", "features"])

    table = rows.mapInArrow(present, "y int, features array<int>").toArrow()
    lists = table.column("features").combine_chunks()
    starts = lists.offsets.to_numpy()
    feature = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    y = table.column("y").to_numpy().astype(float)
    weights, bias = fit_weights(row_of(starts - starts[0]), feature, y, ratios, true_share)
    return ToxicityModel(grams, numbers, weights, bias)


def score(docs: DataFrame, model: ToxicityModel, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns, score (0 to 1) and predicted (1 if score >= 0.5)."""
    rows = keyed_rows(docs, id_column, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = rows.select("key", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, texts in keyed_slices(batch, text, max_bytes=4 << 20):
                s = shared.value.score(texts)
                yield pa.RecordBatch.from_arrays([key, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema.fieldNames())

    return rows.mapInArrow(judge, schema).select("key.*", "score", "predicted")
