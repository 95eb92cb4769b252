"""The trained models against independent brute force: risk, prior, smoothed n-gram probabilities, Kneser-Ney."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zoneflow.llm import langid, lm, quality


# --- positive-unlabelled risk and prior ---------------------------------------------------


def mixture(rng, n, share, dim=6):
    """Rows of which a share is positive: the first half of the statistics tells them apart."""
    good = rng.random(n) < share
    x = rng.normal(size=(n, dim))
    x[:, : dim // 2] += 1.6 * good[:, None]
    return x, good


def risk(model, positive, unlabelled, pi, l2):
    fp, fu = model.margin(positive), model.margin(unlabelled)
    negative = np.log1p(np.exp(fu)).mean() - pi * np.log1p(np.exp(fp)).mean()
    return pi * np.log1p(np.exp(-fp)).mean() + max(0.0, negative) + l2 / 2 * (model.weights**2).sum()


def test_the_fit_minimises_the_non_negative_risk():
    rng = np.random.default_rng(1)
    positive, unlabelled = mixture(rng, 400, 1.0)[0], mixture(rng, 2000, 0.4)[0]
    edges = np.quantile(np.concatenate([positive, unlabelled]), np.arange(1, quality.BINS) / quality.BINS, axis=0).T
    l2 = 0.02
    model = quality._least_risk(edges, positive, unlabelled, 0.4, 600, l2)
    least = risk(model, positive, unlabelled, 0.4, l2)
    for _ in range(60):
        near = quality.QualityModel(edges, model.weights + rng.normal(0, 0.1, model.weights.shape), model.bias + rng.normal(0, 0.1), 0.4)
        assert risk(near, positive, unlabelled, 0.4, l2) > least - 1e-3
    start = quality.QualityModel(edges, np.zeros_like(model.weights), 0.0, 0.4)
    assert least < risk(start, positive, unlabelled, 0.4, l2) - 0.1


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_prior_and_scores_are_recovered_without_negatives(share):
    rng = np.random.default_rng(int(10 * share))
    positive = mixture(rng, 1500, 1.0)[0]
    unlabelled, good = mixture(rng, 4000, share)
    model = quality.train(positive, unlabelled)
    assert model.prior == pytest.approx(share, abs=0.08)
    held, truth = mixture(rng, 4000, share)
    scores = model.score(held)
    assert ((scores >= 0.5) == truth).mean() > 0.85
    # of held-out rows about the given share is said to be positive
    assert scores.mean() == pytest.approx(share, abs=0.08)


# --- smoothed probabilities from a filter --------------------------------------------------


def test_scores_are_those_of_quantised_counts(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[min(int(rng.paretovariate(0.7)), 59)] for _ in range(rng.randint(0, 40))) for _ in range(200)] + [None, "", "Never SEEN words", "w1 w1 W1"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    out = {r.doc_id: r for r in lm.score(docs, held_out=F.col("doc_id") % 5 == 1, mu=50.0, bits_per_ngram=400.0).collect()}
    tokens = [[w.lower() for w in (t or "").split()] + ["<end>"] for t in texts]
    unigrams, bigrams, starts = collections.Counter(), collections.Counter(), 0
    for i, t in enumerate(tokens):
        if i % 5 != 1:
            unigrams.update(t)
            bigrams.update(zip(["<s>", *t[:-1]], t, strict=True))
            starts += 1
    total, distinct = sum(unigrams.values()), len(unigrams)

    def kept(c):
        """The middle of the range of counts that share a level."""
        if c <= 1:
            return float(c)
        low = 2 ** math.floor(math.log2(c))
        return (low + 2 * low - 1) / 2

    for i, t in enumerate(tokens):
        expected = base = 0.0
        for v, w in zip(["<s>", *t[:-1]], t, strict=True):
            base += math.log10((unigrams[w] + 0.5) / (total + 0.5 * (distinct + 1)))
            context = kept(starts if v == "<s>" else unigrams[v])
            pair = min(kept(bigrams[v, w]), context, kept(unigrams[w]))
            unigram = (kept(unigrams[w]) + 0.5) / (total + 0.5 * (distinct + 1))
            expected += math.log10((pair + 50.0 * unigram) / (context + 50.0))
        r = out[i]
        assert (r.n_tokens, r.train_tokens, r.n_known) == (len(t), total, sum(unigrams[w] > 0 for w in t))
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(expected)
    # ids may be unknown: such rows train
    odd = docs.withColumn("doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id")))
    assert lm.score(odd, held_out=F.col("doc_id") % 5 == 1).count() == len(texts)


# --- interpolated Kneser-Ney -----------------------------------------------------------------


def brute_kneser_ney(words, counts, order):
    """log2 of a word's probability, with dictionaries of strings: raw counts at the highest order and for n-grams
    that begin a word, numbers of distinct predecessors otherwise, one discount an order."""
    raw = [collections.Counter() for _ in range(order + 1)]
    heads = [set() for _ in range(order + 1)]
    for w, c in zip(words, counts, strict=True):
        marked = f"\x02{w}\x03"
        for n in range(1, order + 1):
            for i in range(len(marked) - n + 1):
                raw[n][marked[i : i + n]] += c
            heads[n].add(marked[:n]) if len(marked) >= n else None
    used = [None]
    for n in range(1, order + 1):
        before = collections.Counter(g[1:] for g in raw[n + 1]) if n < order else None
        used.append({g: c if n == order or n > 1 and g in heads[n] else max(1, before[g]) for g, c in raw[n].items()})
    symbols = len({x for g in raw[1] for x in g}) + 1
    p, rest = [None], [None]
    for n in range(1, order + 1):
        ones, twos = (sum(c == k for c in used[n].values()) for k in (1, 2))
        discount = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
        total, kinds = collections.Counter(), collections.Counter()
        for g, c in used[n].items():
            total[g[:-1]] += c
            kinds[g[:-1]] += 1
        rest.append({h: discount * kinds[h] / total[h] for h in total})
        p.append({g: max(c - discount, 0) / total[g[:-1]] + rest[n][g[:-1]] * (p[n - 1][g[1:]] if n > 1 else 1 / symbols) for g, c in used[n].items()})

    def chance(history, x):
        out = p[1].get(x, rest[1][""] / symbols)
        for n in range(2, order + 1):
            if len(history) >= n - 1:
                h = history[-(n - 1) :]
                out = p[n].get(h + x, out * rest[n].get(h, 1.0))
        return out

    def log(word):
        marked = f"\x02{word}\x03"
        return sum(math.log2((1 - langid.UNIFORM) * chance(marked[:i], marked[i]) + langid.UNIFORM / langid.SYMBOLS) for i in range(1, len(marked)))

    return log


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model_equals_a_model_of_dictionaries(order):
    rng = random.Random(order)
    counts = collections.Counter("".join(rng.choice("aabbcd") for _ in range(rng.randint(1, 6))) for _ in range(120))
    words = sorted(counts)
    model = langid.Lookup.of([langid.fit_model(words, np.array([counts[w] for w in words]), order)])
    log = brute_kneser_ney(words, [counts[w] for w in words], order)
    asked = [*words, "abcdabcd", "zz", "az", "q", "dddddd", "bd"]
    got, sizes = langid.word_log_probabilities(model, asked)
    for w, g, n in zip(asked, got[:, 0], sizes, strict=True):
        assert g == pytest.approx(log(w), rel=1e-4) and n == len(w) + 1
