"""Language identification with interpolated Kneser-Ney character models.

Each language has a character n-gram model over the letters of words (context
never leaves a word, so a word's probability does not depend on its
neighbours and is worked out once for each distinct word of a slice of text).
A model is, for each order, a sorted array of 64-bit n-gram hashes with the
interpolated probability and the back-off weight of each, looked up by binary
search.  A text gets the language of the lowest cross-entropy per character;
ties go to the smaller language name.

The models are fitted on a sample of at most about ``max_train_chars``
characters of each language, which also bounds their size (at most ``order``
entries a character) and with it the broadcast.  Word counts of the sample are
made in Spark.  A second, disjoint sample of ``max_calibration_chars`` a
language sets the temperature that turns entropies into a probability, and the
rejection level: the entropy that all but one in a thousand of the correctly
identified calibration texts stay below.

Defined results: null texts and texts without a letter are ``und`` with score
0; other rows get a learned language; ``rejected`` marks texts beyond the
rejection level or below ``min_score``.  With no training row everything is
``und``.  Rows repeat as often as they occur; other columns are ignored; null
languages do not train; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import ascii_words, bounded_sample, ngram_hashes, plain_strings, row_of, text_slices, word_points

UNDETERMINED = "und"
#: Share of a uniform model over SYMBOLS characters in every probability: it
#: bounds what one foreign letter costs, so a quoted foreign passage weighs by its length.
UNIFORM, SYMBOLS = 0.1, 64


@dataclass
class CharModel:
    """One language: for each order sorted hashes, probabilities and back-off weights."""

    hashes: list[np.ndarray]
    probabilities: list[np.ndarray]
    weights: list[np.ndarray]
    base: float


def fit_model(words: list[str], counts: np.ndarray, order: int) -> CharModel:
    """Interpolated Kneser-Ney: raw counts at the highest order, continuation counts below, one discount an order."""
    points, word, place = word_points(words)
    weight = counts.astype(np.float64)[word]
    grams = list(ngram_hashes(points, order))
    symbols = len(np.unique(points)) + 1
    hashes, raw = [], []
    for n in range(1, order + 1):
        # n-grams that start with a word's start mark are whole contexts of their own and keep raw counts
        ok = place >= n - 1
        keys, at = np.unique(grams[n - 1][ok], return_inverse=True)
        total = np.bincount(at, weights=weight[ok])
        if n < order:
            longer = place >= n
            # one occurrence of each longer n-gram says which shorter one it ends in
            one = np.unique(grams[n][longer], return_index=True)[1]
            kinds = np.bincount(np.searchsorted(keys, grams[n - 1][longer][one]), minlength=len(keys))
            marked = np.zeros(len(keys), bool)
            marked[at[(place[ok] == n - 1)]] = n > 1
            total = np.where(marked, total, np.maximum(kinds, 1))
        hashes.append(keys)
        raw.append(total)
    probabilities, weights = [], [np.zeros(0)] * order
    lower_p = None
    for n in range(1, order + 1):
        ok = np.flatnonzero(place >= n - 1)
        keys, first = np.unique(grams[n - 1][ok], return_index=True)
        ends = ok[first]  # one occurrence of each n-gram
        c = raw[n - 1]
        ones, twos = (c == 1).sum(), (c == 2).sum()
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
        if n == 1:
            lower = np.full(len(keys), 1.0 / symbols)
            context = np.zeros(len(keys), np.int64)
            context_hashes = np.zeros(1, np.uint64)
        else:
            lower = lower_p[np.searchsorted(hashes[n - 2], grams[n - 2][ends])]
            context_of = grams[n - 2][ends - 1]
            context_hashes, context = np.unique(context_of, return_inverse=True)
        totals, kinds = np.bincount(context, weights=c), np.bincount(context)
        backoff = discount * kinds / totals
        p = np.maximum(c - discount, 0) / totals[context] + backoff[context] * lower
        probabilities.append(p)
        if n == 1:
            base = float(backoff[0] / symbols)
        else:  # a context's weight stands at the context's own entry, where it has one
            w = np.ones(len(hashes[n - 2]))
            at = np.searchsorted(hashes[n - 2], context_hashes)
            at_ok = np.minimum(at, len(hashes[n - 2]) - 1)
            known = hashes[n - 2][at_ok] == context_hashes
            w[at_ok[known]] = backoff[known]
            weights[n - 2] = w
        lower_p = p
    weights[order - 1] = np.ones(len(hashes[order - 1]))
    return CharModel(hashes, probabilities, weights, base)


@dataclass
class Lookup:
    """All models side by side: for each order one sorted hash array, and a column of probabilities and of weights for each language (probability 0: not there)."""

    hashes: list[np.ndarray]
    probabilities: list[np.ndarray]
    weights: list[np.ndarray]
    bases: np.ndarray

    @classmethod
    def of(cls, models: list[CharModel]) -> Lookup:
        hashes, probabilities, weights = [], [], []
        for n in range(max(len(m.hashes) for m in models)):
            union = np.unique(np.concatenate([m.hashes[n] for m in models]))
            p, w = np.zeros((len(models), len(union)), np.float32), np.ones((len(models), len(union)), np.float32)
            for k, m in enumerate(models):
                at = np.searchsorted(union, m.hashes[n])
                p[k, at], w[k, at] = m.probabilities[n], m.weights[n]
            hashes.append(union)
            probabilities.append(p)
            weights.append(w)
        return cls(hashes, probabilities, weights, np.array([m.base for m in models]))


def word_log_probabilities(models: Lookup, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Log2 probability of each word in each language (words x languages), and its number of predicted characters."""
    out = np.zeros((len(words), len(models.bases)))
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // (1 << 18))) + 1).tolist(), len(words)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):  # pieces that fit the processor's caches
        points, word, place = word_points(words[a:b])
        found = []
        for hashes, grams, n in zip(models.hashes, ngram_hashes(points, len(models.hashes)), range(len(points)), strict=False):
            at = np.searchsorted(hashes, grams)
            at[at == len(hashes)] = 0
            found.append((at, (hashes[at] == grams) & (place >= n)))
        starts = np.flatnonzero(place == 0)
        for k, base in enumerate(models.bases):
            p = np.full(len(points), base, np.float32)
            weight = None
            for n, (at, hit) in enumerate(found):
                if n:  # the weight of the context that ends just before
                    shifted = np.ones(len(points), np.float32)
                    shifted[1:] = weight[:-1]
                    p = np.where(place >= n, p * shifted, p)
                own = models.probabilities[n][k][at]
                p = np.where(hit & (own > 0), own, p)
                weight = np.where(hit, models.weights[n][k][at], np.float32(1))
            logs = np.log2((1 - UNIFORM) * p + UNIFORM / SYMBOLS)
            logs[starts] = 0
            out[a:b, k] = np.add.reduceat(logs, starts)
    return out, sizes


def letter_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Row offsets, codes and distinct words, the words lower-cased and without what is not a letter."""
    offsets, codes, words = ascii_words(texts)
    return offsets, codes, letters_only(words)


def letters_only(words: pa.Array) -> list[str]:
    return pc.replace_substring_regex(pc.utf8_lower(words.cast(pa.string())), r"[^\p{L}]+", "").to_pylist()


def entropies(models: Lookup, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Cross-entropy per character of each text in each language, and its number of characters (0: no letter)."""
    offsets, codes, words = letter_words(texts)
    distinct = sorted(set(words) - {""})
    place = {w: i for i, w in enumerate(distinct)}
    to = np.fromiter((place.get(w, -1) for w in words), np.int64, len(words))
    logs, sizes = word_log_probabilities(models, distinct)
    row, known = row_of(offsets), to[codes] >= 0
    row, at = row[known], to[codes][known]
    n = np.bincount(row, weights=sizes[at], minlength=len(texts)) if len(at) else np.zeros(len(texts))
    total = np.stack([np.bincount(row, weights=logs[at, k], minlength=len(texts)) for k in range(len(models.bases))], 1) if len(at) else np.zeros((len(texts), len(models.bases)))
    return -total / np.maximum(n, 1)[:, None], n


def confidences(entropy: np.ndarray, n: np.ndarray, temperature: float) -> np.ndarray:
    logits = -entropy * np.sqrt(np.maximum(n, 1))[:, None] * temperature
    logits -= logits.max(1, keepdims=True)
    return np.exp(logits) / np.exp(logits).sum(1, keepdims=True)


@dataclass
class LanguageModels:
    languages: list[str]
    models: Lookup | None
    temperature: float = 1.0
    max_entropy: float = float("inf")


def fit(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", language: str = "lang", order: int = 4, max_train_chars: int = 3_000_000, max_calibration_chars: int = 300_000
) -> LanguageModels:
    """Models of every language of ``docs`` (rows that may train), from bounded samples."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(language).alias("language")).where(F.col("text").isNotNull())
    chars = F.length("text").cast("long")
    # a tenth of the texts (by id and text) is kept out of training, to calibrate with; languages of few texts train with all
    sizes = {r.language: r["count"] for r in rows.where(F.col("language").isNotNull()).groupBy("language").count().collect()}
    kept_out = F.col("language").isin([x for x, n in sizes.items() if n >= 20]) & (F.pmod(F.xxhash64(F.lit(303), F.col("id"), F.col("text")), F.lit(10)) == 0)
    sample = bounded_sample(rows.where(~kept_out), "id", "language", max_train_chars, chars, seed=101)
    # letters-only words are made the same way as in scoring, once for each distinct raw word
    raw = sample.select("language", F.explode(F.split("text", r"[ \t\n\x0b\f\r]+")).alias("word")).groupBy("language", "word").count()
    table = raw.toArrow()
    by: dict[str, dict[str, int]] = {}
    if table.num_rows:
        cleaned = letters_only(table.column("word").combine_chunks())
        for lang, word, count in zip(table.column("language").to_pylist(), cleaned, table.column("count").to_pylist(), strict=True):
            if word:
                own = by.setdefault(lang, {})
                own[word] = own.get(word, 0) + count
    languages = sorted(by)
    if not languages:
        return LanguageModels([], None)
    out = LanguageModels(languages, Lookup.of([fit_model(sorted(by[x]), np.array([by[x][w] for w in sorted(by[x])]), order) for x in languages]))
    held = bounded_sample(rows.where(kept_out), "id", "language", max_calibration_chars, chars, seed=202).toArrow()
    if held.num_rows:
        entropy, n = entropies(out.models, plain_strings(held.column("text").combine_chunks()))
        truth = np.array([languages.index(x) if x in by else -1 for x in held.column("language").to_pylist()])
        ok = (n > 0) & (truth >= 0)
        if ok.any():
            entropy, n, truth = entropy[ok], n[ok], truth[ok]
            grid = np.geomspace(0.05, 20, 40)
            loss = [-np.log(np.maximum(confidences(entropy, n, t)[np.arange(len(truth)), truth], 1e-12)).mean() for t in grid]
            out.temperature = float(grid[int(np.argmin(loss))])
            right = entropy.argmin(1) == truth
            if right.any():
                out.max_entropy = float(np.quantile(entropy.min(1)[right], 0.999)) * 1.05
    return out


def predict(docs: DataFrame, fitted: LanguageModels, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), min_score: float = 0.0) -> DataFrame:
    """id, ``keep`` columns, lang_pred, score (confidence, 0 to 1), entropy (bits a character, null for ``und``) and rejected."""
    rows = docs.select(F.struct(id_column, *keep).alias("key"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    schema = rows.select("key", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.expr("double(null)").alias("entropy"), F.lit(True).alias("rejected")).schema

    def identify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for piece in text_slices(batch):
                k = piece.num_rows
                if m.models is None:
                    yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array([UNDETERMINED] * k), pa.array(np.zeros(k)), pa.nulls(k, pa.float64()), pa.array([True] * k)], schema.fieldNames())
                    continue
                entropy, n = entropies(m.models, plain_strings(piece.column("text")))
                best, some = entropy.argmin(1), n > 0
                score = np.where(some, confidences(entropy, n, m.temperature)[np.arange(k), best], 0.0)
                names = [m.languages[b] if s else UNDETERMINED for b, s in zip(best.tolist(), some.tolist(), strict=True)]
                lowest = entropy.min(1)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("key"), pa.array(names), pa.array(score), pa.array(lowest, mask=~some), pa.array(~some | (lowest > m.max_entropy) | (score < min_score))],
                    schema.fieldNames(),
                )

    return rows.mapInArrow(identify, schema).select("key.*", "lang_pred", "score", "entropy", "rejected")
