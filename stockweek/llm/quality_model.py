"""Text quality by logistic regression on hashed word n-grams.

Tokens are runs of word characters or runs of other signs; a document's features
are its tokens and pairs of neighbours, hashed into a fixed number of weights; a
token after itself is one and the same pair, whatever the token.
Training follows the regularised leader, one document at a time; a score is a
sparse dot product of counts and weights, over the root of the number of features.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from stockweek.llm.columns import TextWork, as_bytes, map_texts
from stockweek.llm.labelled import SAMPLE_DOCS, fit_in_one_task, labelled_sample
from stockweek.llm.perfect_hash import mix
from stockweek.llm.words import byte_classes, hashed_tokens

BUCKET_BITS = 18
EPOCHS = 3

# The regularised leader's learning rate, its offset, and its L1 and L2 weights.
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.05, 1.0

TWICE = mix(np.array([1], np.uint64))[0]

#: Word characters are one class, signs another; spaces and controls are gaps.
TOKENS = byte_classes(
    (0x21, 0x7E, 2), (0x30, 0x39, 1), (0x41, 0x5A, 1), (0x61, 0x7A, 1), (0x80, 0xFF, 1)
)


def _features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and bucket of every token and neighbouring pair, in parts."""
    shift = np.uint64(64 - BUCKET_BITS)
    last_owner, last_hash = -1, np.zeros(1, np.uint64)
    for owner, hashes in hashed_tokens(texts, TOKENS):
        if not len(owner):
            continue
        before = np.concatenate([last_hash, hashes[:-1]])
        same = np.concatenate([[owner[0] == last_owner], owner[1:] == owner[:-1]])
        left, right = before[same], hashes[same]
        pairs = np.where(left == right, TWICE, mix(left * np.uint64(3) + right))
        yield (
            np.concatenate([owner, owner[same]]),
            (np.concatenate([hashes, pairs]) >> shift).astype(np.int64),
        )
        last_owner, last_hash = owner[-1], hashes[-1:]


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def train(texts: list[bytes], labels: list[int], epochs: int = EPOCHS) -> np.ndarray:
    """Weights by bucket, the intercept last."""
    size = 1 << BUCKET_BITS
    docs = []
    for raw in texts:
        buckets = np.concatenate([np.zeros(0, np.int64), *(b for _, b in _features([raw]))])
        found, counts = np.unique(buckets, return_counts=True)
        values = counts / np.sqrt(max(1, len(buckets)))
        docs.append((np.append(found, size).astype(np.int32), np.append(values, 1.0).astype(np.float32)))
    pulls, squares = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at) -> np.ndarray:
        z = pulls[at]
        firm = (BETA + np.sqrt(squares[at])) / ALPHA + L2
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / firm)

    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(docs)):
            at, values = docs[i]
            now = weights(at)
            slope = (_sigmoid(now @ values) - labels[i]) * values
            more = squares[at] + slope * slope
            pulls[at] += slope - (np.sqrt(more) - np.sqrt(squares[at])) / ALPHA * now
            squares[at] = more
    return weights(np.arange(size + 1)).astype(np.float32)


def _fit(texts: list[bytes], labels: list[int]) -> bytes:
    return train(texts, labels).tobytes()


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    usable: Column | None = None,
    per_class: int = SAMPLE_DOCS,
) -> np.ndarray | None:
    """Weights learned from a bounded sample of the usable labels; None without both classes."""
    sample = labelled_sample(docs, labels, label, usable=usable, per_class=per_class)
    if sample is None:
        return None
    weights = np.frombuffer(fit_in_one_task(sample.rows, _fit), np.float32).copy()
    weights[-1] += sample.shift
    return weights


def _score_work(broadcast) -> TextWork:
    weights = broadcast.value

    def work(texts: pa.Array) -> list[pa.Array]:
        raws = as_bytes(texts)
        total, count = np.zeros(len(raws)), np.zeros(len(raws))
        for owner, buckets in _features(raws):
            total += np.bincount(owner, weights[buckets], len(raws))
            count += np.bincount(owner, minlength=len(raws))
        score = _sigmoid(total / np.sqrt(np.maximum(1, count)) + weights[-1])
        return [pa.array(score, pa.float64())]

    return work


def score_quality(
    df: DataFrame,
    weights: np.ndarray | None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` and ``score``, the chance of label 1, of every row.

    A null or empty text has no features and gets the score of the intercept.
    Without weights every score is 0.5.
    """
    if weights is None:
        weights = np.zeros((1 << BUCKET_BITS) + 1, np.float32)
    shared = df.sparkSession.sparkContext.broadcast(weights)
    return map_texts(df, text, keep, "score double", partial(_score_work, shared))
