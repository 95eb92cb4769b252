"""Quality classifier by positive-unlabelled learning.

Trusted positives are the rows labelled 1; everything else that may train is
unlabelled web text, whatever its label.  The model is logistic over one-hot
quantile bins of per-document text statistics and minimises the non-negative
unbiased risk

    pi R_p(+) + max(0, R_u(-) - pi R_p(-)),

where the class prior pi is estimated without negatives: a first classifier
tells positives from unlabelled text, and pi is the smallest ratio, over its
upper score ranges, of the unlabelled share to the positive share (where the
unlabelled text of a range is all positive, the ratio is pi).

Both samples are bounded by ``max_rows`` documents; what reaches the driver is
one row of 21 numbers for each.  Scoring covers every document in whole.

Defined results: null and empty texts have all statistics 0 and are scored
like any other; duplicate label rows of a document count as positive if any
is; null labels are unlabelled; without a positive row every score is 0.5.
Rows repeat as often as they occur; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zoneflow.llm.common import ascii_words, hash_share, keyed_rows, keyed_slices, plain_strings, row_of, text_slices

BINS = 16
#: Byte classes whose shares of a text are statistics.
CLASSES = ["upper", "lower", "digit", "space", "newline", "stop", "bang", "mark", "bar", "other", "high"]


def _byte_classes() -> np.ndarray:
    table = np.full(256, CLASSES.index("other"), np.int64)
    for name, members in {
        "upper": range(65, 91),
        "lower": range(97, 123),
        "digit": range(48, 58),
        "space": b" \t",
        "newline": b"\n\r",
        "stop": b".,;:'\"-()",
        "bang": b"!?",
        "mark": b"#*%$&@=+~^_<>/\\",
        "bar": b"|{}[]",
        "high": range(128, 256),
    }.items():
        table[list(members)] = CLASSES.index(name)
    return table


_TABLE = _byte_classes()
FEATURES = [*CLASSES, "log_bytes", "log_words", "distinct_words", "top_word", "repeats", "word_bytes", "log_lines", "distinct_lines", "upper_words", "ended_words"]


def statistics(texts: pa.Array) -> np.ndarray:
    """Texts x statistics."""
    n = len(texts)
    out = np.zeros((n, len(FEATURES)))
    put = {name: i for i, name in enumerate(FEATURES)}
    texts = texts.cast(pa.large_string())
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    size = np.diff(bounds)
    for i in range(n):
        if size[i]:
            per_byte = np.bincount(data[bounds[i] : bounds[i + 1]], minlength=256)
            out[i, : len(CLASSES)] = np.bincount(_TABLE, weights=per_byte, minlength=len(CLASSES)) / size[i]
    out[:, put["log_bytes"]] = np.log1p(size)

    offsets, codes, words = ascii_words(texts.cast(pa.string()))
    row, count = row_of(offsets), np.diff(offsets)
    out[:, put["log_words"]] = np.log1p(count)
    if len(codes):
        key, times = np.unique(row * len(words) + codes, return_counts=True)
        owner = key // len(words)
        many = np.maximum(count, 1)
        out[:, put["distinct_words"]] = np.bincount(owner, minlength=n) / many
        top = np.zeros(n)
        np.maximum.at(top, owner, times)
        out[:, put["top_word"]] = top / many
        same = (codes[1:] == codes[:-1]) & (row[1:] == row[:-1])
        out[:, put["repeats"]] = np.bincount(row[1:][same], minlength=n) / many
        width = pc.binary_length(words).to_numpy().astype(float)
        out[:, put["word_bytes"]] = np.bincount(row, weights=width[codes], minlength=n) / many
        letters = pc.replace_substring_regex(words, r"[^\p{L}]+", "")
        loud = pc.and_(pc.equal(pc.utf8_upper(letters), letters), pc.greater(pc.utf8_length(letters), 2)).to_numpy(zero_copy_only=False)
        ended = pc.match_substring_regex(words, r"[^\p{L}\p{N}]$").to_numpy(zero_copy_only=False)
        out[:, put["upper_words"]] = np.bincount(row, weights=loud[codes], minlength=n) / many
        out[:, put["ended_words"]] = np.bincount(row, weights=ended[codes], minlength=n) / many
    lines = pc.split_pattern(texts.cast(pa.string()), "\n")
    at = lines.offsets.to_numpy().astype(np.int64)
    flat = lines.flatten().dictionary_encode()
    line_row = row_of(at - at[0])
    line = np.unique(line_row * (len(flat.dictionary) + 1) + flat.indices.to_numpy(zero_copy_only=False))
    out[:, put["log_lines"]] = np.log1p(np.diff(at))
    out[:, put["distinct_lines"]] = np.bincount(line // (len(flat.dictionary) + 1), minlength=n) / np.maximum(np.diff(at), 1)
    return out


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityModel:
    edges: np.ndarray  # statistics x (BINS - 1)
    weights: np.ndarray  # statistics x BINS
    bias: float
    prior: float

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], 1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[np.arange(x.shape[1]), self.bins(x)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.margin(x))


def _descend(model: QualityModel, xp: np.ndarray, xu: np.ndarray, gradient, steps: int, l2: float) -> None:
    """Adam on the weights; ``gradient(fp, fu)`` gives the derivative of the risk by each margin."""
    bp, bu = model.bins(xp), model.bins(xu)
    d, flat = bp.shape[1], model.weights.size
    ip, iu = (bp + np.arange(d) * BINS).ravel(), (bu + np.arange(d) * BINS).ravel()
    w, m, v = np.zeros(flat + 1), np.zeros(flat + 1), np.zeros(flat + 1)
    for t in range(1, steps + 1):
        fp, fu = w[-1] + w[ip].reshape(-1, d).sum(1), w[-1] + w[iu].reshape(-1, d).sum(1)
        gp, gu = gradient(fp, fu)
        g = np.bincount(ip, weights=np.repeat(gp, d), minlength=flat + 1) + np.bincount(iu, weights=np.repeat(gu, d), minlength=flat + 1)
        g[-1] = gp.sum() + gu.sum()
        g[:-1] += l2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.weights, model.bias = w[:-1].reshape(model.weights.shape), float(w[-1])


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least_share: float = 0.3) -> float:
    """The smallest ratio of the unlabelled to the positive share above a threshold.

    Only ranges with at least ``least_share`` of the positives count, and each
    ratio is taken one standard error up, as the smallest of many noisy ones
    is too low.  Scores must come from rows that did not fit the scorer.
    """
    found = []
    for cut in np.quantile(positive, np.linspace(0, 1 - least_share, 40)):
        p, u = (positive >= cut).mean(), (unlabelled >= cut).mean()
        spread = np.sqrt((1 - p) / (p * len(positive)) + (1 - u) / (max(u, 1e-9) * len(unlabelled)))
        found.append(u / p * (1 + spread))
    return float(min(0.99, max(0.01, min(found))))


def _against_unlabelled(edges: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, steps: int, l2: float) -> QualityModel:
    model = QualityModel(edges, np.zeros((len(edges), BINS)), 0.0, 0.5)
    n_p, n_u = len(positive), len(unlabelled)
    _descend(model, positive, unlabelled, lambda fp, fu: (-_logistic(-fp) / n_p, _logistic(fu) / n_u), steps, l2)
    return model


def train(positive: np.ndarray, unlabelled: np.ndarray, steps: int = 250, l2: float = 0.15) -> QualityModel:
    """Fit from the statistics of trusted positives and of unlabelled text (which holds positives too).

    ``l2`` is divided by the square root of the number of positives.
    """
    both = np.concatenate([positive, unlabelled])
    edges = np.quantile(both, np.arange(1, BINS) / BINS, axis=0).T
    # a last edge in the upper tail and a first in the lower one: what is rare sits there
    edges[:, -1], edges[:, 0] = np.quantile(both, 0.985, axis=0), np.quantile(both, 0.015, axis=0)
    edges.sort(1)
    n_p, n_u = len(positive), len(unlabelled)
    l2 /= np.sqrt(n_p)
    if min(n_p, n_u) < 2:
        return QualityModel(edges, np.zeros((both.shape[1], BINS)), 0.0, 0.5)
    # the prior, by cross-fitting: each half is scored by a classifier fitted on the other
    halves = [(positive[k::2], unlabelled[k::2]) for k in (0, 1)]
    pi = float(np.mean([estimate_prior(m.margin(h[0]), m.margin(h[1])) for h, m in zip(halves, [_against_unlabelled(edges, *h, steps, l2) for h in halves[::-1]], strict=True)]))
    model = _least_risk(edges, positive, unlabelled, pi, steps, l2)
    # slope and offset that make the margin a probability, from rows that did not fit it
    crossed = [(m.margin(h[0]), m.margin(h[1])) for h, m in zip(halves, [_least_risk(edges, *h, pi, steps, l2) for h in halves[::-1]], strict=True)]
    slope, offset = _calibrate(*(np.concatenate(x) for x in zip(*crossed, strict=True)), pi)
    model.weights, model.bias = model.weights * slope, model.bias * slope + offset
    return model


def _least_risk(edges: np.ndarray, positive: np.ndarray, unlabelled: np.ndarray, pi: float, steps: int, l2: float) -> QualityModel:
    """The minimiser of the non-negative unbiased risk."""
    model = QualityModel(edges, np.zeros((len(edges), BINS)), 0.0, pi)
    n_p, n_u = len(positive), len(unlabelled)

    def gradient(fp: np.ndarray, fu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        negative = np.logaddexp(0, fu).mean() - pi * np.logaddexp(0, fp).mean()
        if negative >= 0:  # the unbiased risk
            return np.full(n_p, -pi / n_p), _logistic(fu) / n_u
        return pi * _logistic(fp) / n_p, -_logistic(fu) / n_u  # its negative part is over-fitted: step back up

    _descend(model, positive, unlabelled, gradient, steps, l2)
    return model


def _calibrate(fp: np.ndarray, fu: np.ndarray, pi: float, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the margin of least unbiased risk (convex in both; Newton steps with a small ridge)."""
    a, b = 1.0, 0.0
    for _ in range(steps):
        s = _logistic(a * fu + b)
        h = s * (1 - s)
        g = np.array([(s * fu).mean() - pi * fp.mean() + 1e-3 * (a - 1), s.mean() - pi + 1e-3 * b])
        hessian = np.array([[(h * fu * fu).mean(), (h * fu).mean()], [(h * fu).mean(), h.mean()]]) + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, g)
        step *= min(1.0, 1.0 / np.abs(step).max(initial=1e-12))
        a, b = a - step[0], b - step[1]
    return max(a, 0.1), b


def _measured(rows: DataFrame) -> DataFrame:
    """key, label -> key, label, statistics."""
    schema = rows.select("key", F.array(F.lit(0.0)).alias("x")).schema

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in text_slices(batch, give_back=True):
                x = statistics(plain_strings(piece.column("text")))
                values = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column("key"), values], ["key", "x"])

    return rows.mapInArrow(measure, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id", text: str = "text", max_rows: int = 20_000, seed: int = 303) -> QualityModel | None:
    """Fit on ``docs`` that may train and on ``labels``; at most about ``max_rows`` positives and as many unlabelled documents."""
    trusted = labels.where(F.col(label) == 1).select(F.col(id_column).alias("id")).distinct()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    n_docs, n_trusted = rows.count(), trusted.count()
    if not n_docs or not n_trusted:
        return None
    trusted = trusted.where(hash_share("id", seed) < max_rows / n_trusted)  # bounded, so it may be broadcast
    positive = rows.join(F.broadcast(trusted), "id").select(F.lit(True).alias("key"), "text")
    unlabelled = rows.where(F.coalesce(hash_share("id", seed + 1) < max_rows / n_docs, F.lit(True))).select(F.lit(False).alias("key"), "text")
    table = _measured(positive.unionByName(unlabelled)).toArrow()
    x = np.array(table.column("x").to_pylist()).reshape(-1, len(FEATURES))
    is_positive = np.array(table.column("key").to_pylist(), bool)
    if not is_positive.any() or is_positive.all():
        return None
    return train(x[is_positive], x[~is_positive])


def score(docs: DataFrame, model: QualityModel | None, id_column: str = "doc_id", text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``keep`` columns, score (0 to 1) and predicted (1 if score >= 0.5)."""
    rows = keyed_rows(docs, id_column, keep, text)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = rows.select("key", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for key, texts in keyed_slices(batch, text):
                s = m.score(statistics(texts)) if m else np.full(len(key), 0.5)
                yield pa.RecordBatch.from_arrays([key, pa.array(s), pa.array((s >= 0.5).astype(np.int32))], schema.fieldNames())

    return rows.mapInArrow(judge, schema).select("key.*", "score", "predicted")
