"""Text quality by positive-unlabelled learning with a non-negative risk.

Trusted positives and unlabelled documents are turned into a few dozen surface measures. The share of positives among
the unlabelled is estimated from the two samples alone: a plain positive-against-unlabelled model ranks both, and no
tail of the ranking can hold fewer unlabelled than the prior's share of positives, so the smallest ratio of the tails
is the prior. The final model minimises

    prior * R_p(+1) + max(0, R_u(-1) - prior * R_p(-1))

with the logistic loss; where the second part turns negative, steps go against it, as the non-negative estimator asks.

Defined results: null text counts as empty, and empty texts are scored like others; rows with a null id are scored but
never learned from; a repeated id is learned from once; without positives or documents every score is 0.5. Learning
takes bounded samples (``most_positive``, ``most_unlabelled``; texts over ``most_chars`` characters aren't learned
from); scoring takes every whole text. Other columns pass through; those named like the new ones are replaced.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._shared import hashed_sample, small_batches, texts_of, worker

_LOWER, _UPPER, _DIGIT, _SPACE, _LINE, _STOP, _MARK, _CRY, _SIGN, _BAR, _WIDE = range(11)


def _byte_kinds() -> np.ndarray:
    kinds = np.full(256, _SIGN, np.uint8)
    for chars, kind in ((range(97, 123), _LOWER), (range(65, 91), _UPPER), (range(48, 58), _DIGIT), (b" \t", _SPACE), (b"\n\r\x0b\x0c", _LINE), (b".", _STOP), (b",;:'\"()-?", _MARK), (b"!", _CRY), (b"|", _BAR), (range(128, 256), _WIDE)):
        kinds[list(chars)] = kind
    return kinds


_KINDS = _byte_kinds()
MEASURES = 26


def measures(text: str) -> list[float]:
    """Surface measures of one text, none of which needs a language."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(_KINDS[raw], minlength=11).astype(float)
    size = max(1, len(raw))
    words = text.split()
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x.strip()]
    often = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    most = max(often.values(), default=0)
    letters = counts[_LOWER] + counts[_UPPER] + counts[_WIDE]
    text_bytes = max(1.0, size - counts[_SPACE] - counts[_LINE])
    share = counts / size
    long_line = max(map(len, lines), default=0)
    return [
        math.log1p(size),
        math.log1p(len(words)),
        math.log1p(len(lines)),
        letters / text_bytes,
        counts[_UPPER] / max(1.0, letters),
        counts[_DIGIT] / text_bytes,
        share[_SPACE],
        share[_LINE],
        counts[_STOP] / n,
        counts[_MARK] / n,
        math.log1p(10 * counts[_CRY] / n),
        math.log1p(10 * counts[_SIGN] / n),
        math.log1p(10 * counts[_BAR] / n),
        counts[_WIDE] / text_bytes,
        len(often) / n,
        math.log(max(1, len(often))) / math.log1p(n),
        pairs / max(1, n - 1),
        math.log(max(1, pairs)) / math.log1p(n),
        sum(map(operator.eq, words, words[1:])) / n,
        most / n,
        math.log1p(most / math.sqrt(n)),
        len(set(lines)) / max(1, len(lines)),
        text_bytes / n,
        math.log1p(n / max(1.0, counts[_STOP])),
        math.log1p(long_line),
        float(not words),
    ]


def _expand(x: np.ndarray) -> np.ndarray:
    """Standardised measures with their squares and hinges on both sides of two standard deviations."""
    return np.hstack((x, x * x / 4, np.maximum(0, x - 1), np.maximum(0, -1 - x)))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(z / 2))


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def inputs(self, x: np.ndarray) -> np.ndarray:
        return np.hstack((_expand(np.clip((x - self.mean) / self.scale, -8, 8)), np.ones((len(x), 1))))

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.inputs(x) @ self.weights)


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, least_tail: float = 0.5) -> float:
    """Smallest ratio of the unlabelled share to the positive share of any upper tail with enough positives.

    A standard error is added to each ratio, as the smallest of many noisy ratios lies too low.
    """
    cuts = np.quantile(positive, np.linspace(0, 1 - least_tail, 200))
    p = np.array([(positive >= c).mean() for c in cuts])
    u = np.array([(unlabelled >= c).mean() for c in cuts])
    error = np.sqrt(u * (1 - u) / len(unlabelled)) / p + u / p**2 * np.sqrt(p * (1 - p) / len(positive))
    return float(np.clip((u / p + error).min(), 0.02, 0.98))


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, steps: int = 600, rate: float = 0.05, decay: float = 2e-4) -> QualityModel | None:
    """Model of the positives' measures against the unlabelled; None without rows. ``prior`` is estimated if not given."""
    if not len(positive) or not len(unlabelled):
        return None
    both = np.vstack((positive, unlabelled))
    model = QualityModel(both.mean(axis=0), both.std(axis=0) + 1e-6, np.zeros(0), prior or 0.5)
    p, u = model.inputs(positive), model.inputs(unlabelled)
    keep = np.ones(p.shape[1])
    keep[-1] = 0
    if prior is None:
        plain = _adam(lambda w: -(p * (1 - _sigmoid(p @ w))[:, None]).mean(axis=0) + (u * _sigmoid(u @ w)[:, None]).mean(axis=0) + decay * keep * w, p.shape[1], steps // 2, rate)
        model.prior = estimate_prior(p @ plain, u @ plain)

    def gradient(w: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(p @ w), _sigmoid(u @ w)
        zp, zu = p @ w, u @ w
        part = np.logaddexp(0, zu).mean() - model.prior * np.logaddexp(0, zp).mean()
        negative = (u * su[:, None]).mean(axis=0) - model.prior * (p * sp[:, None]).mean(axis=0)
        if part < 0:
            return -negative
        return negative - model.prior * (p * (1 - sp)[:, None]).mean(axis=0) + decay * keep * w

    model.weights = _adam(gradient, p.shape[1], steps, rate)
    return model


def _measured(texts: DataFrame, id_column: str) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [measures(t or "") for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.float64()))], names=["k", "x"])

    kind = texts.schema[id_column].dataType.simpleString()
    rows = texts.mapInArrow(worker("quality", run), f"k {kind}, x array<double>").groupBy("k").agg(F.min("x").alias("x")).orderBy("k").collect()
    return np.array([r.x for r in rows]).reshape(-1, MEASURES)


def train(documents: DataFrame, positives: DataFrame, unlabelled: DataFrame, prior: float | None = None, most_positive: int = 6000, most_unlabelled: int = 12000, most_chars: int = 100_000, id_column: str = "doc_id", text_column: str = "text") -> QualityModel | None:
    """Learn from the texts that ``documents`` has for the ids of ``positives`` and of ``unlabelled``."""
    small_batches(documents.sparkSession)
    short = documents.where(F.coalesce(F.length(text_column), F.lit(0)) <= most_chars)
    x = [_measured(texts_of(short, hashed_sample(ids, id_column, most, seed), id_column, text_column), id_column) for ids, most, seed in ((positives, most_positive, 11), (unlabelled, most_unlabelled, 12))]
    return fit(*x, prior=prior)


def score(documents: DataFrame, model: QualityModel | None, threshold: float = 0.3, id_column: str = "doc_id", text_column: str = "text", block: int = 512) -> DataFrame:
    """``documents`` with two more columns: quality_score and quality_kept (the score reaches ``threshold``)."""
    small_batches(documents.sparkSession)
    documents = documents.drop("quality_score", "quality_kept")
    names = documents.columns
    schema = StructType(documents.schema.fields + StructType.fromDDL("quality_score double, quality_kept boolean").fields)
    at_text = names.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, block):
                batch = whole.slice(at, block)
                if model is None:
                    y = np.full(batch.num_rows, 0.5)
                else:
                    y = model.score(np.array([measures(t or "") for t in batch.column(at_text).to_pylist()]).reshape(-1, MEASURES))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(y), pa.array(y >= threshold)], names=schema.names)

    return documents.mapInArrow(worker("quality", run), schema)
