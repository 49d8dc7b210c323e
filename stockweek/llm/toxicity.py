"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes ratios.

A feature is the presence of a hashed n-gram of characters, which are code points. Its value
is the log ratio of its shares among the n-grams of toxic and of other texts; logistic
regression then weighs the scaled features. The n-grams that tell the classes apart best
are kept, so scoring looks only at the few of a text that matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from stockweek.llm.columns import TextWork, as_bytes, map_texts
from stockweek.llm.labelled import SAMPLE_DOCS, fit_in_one_task, labelled_sample
from stockweek.llm.words import LOWER, SEGMENT

ORDERS = (3, 4, 5, 6)
BUCKET_BITS = 20

# N-grams in fewer training texts are left out.
MIN_TEXTS = 5

# Of the others so many get a weight, and training takes so many rounds, by default. The
# README has what more or fewer of either find.
KEPT = 4096
ROUNDS = 150

SMOOTHING, RATE, L2 = 1.0, 0.05, 1e-3

# A-Z are lower-cased; tabs and line ends are spaces. A 0 stands between texts.
FOLD = LOWER.copy()
FOLD[9:14] = 32
FOLD[0] = 32

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _characters(raw: bytes) -> Iterator[np.ndarray]:
    """Folded code points of a text, in pieces of a segment that overlap by the longest n-gram less one."""
    at, before = 0, np.zeros(0, np.uint32)
    while at < len(raw):
        end = min(len(raw), at + SEGMENT)
        while end < len(raw) and raw[end] & 0xC0 == 0x80:  # not inside a character
            end -= 1
        points = np.frombuffer(raw[at:end].decode().encode("utf-32-le"), np.uint32)
        plain = points < 128
        points = np.where(plain, FOLD[np.where(plain, points, 0)], points).astype(np.uint32)
        points = np.concatenate([before, points])
        yield points
        at, before = end, points[-(max(ORDERS) - 1) :]


def _joined(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """About a segment of characters of texts with a 0 after each, their starts and numbers."""
    stop = np.zeros(1, np.uint32)
    parts, starts, owners, size = [], [], [], 0
    for number, raw in enumerate(texts):
        for piece in _characters(raw):
            if parts and size + len(piece) > SEGMENT:
                yield np.concatenate(parts), np.array(starts), np.array(owners)
                parts, starts, owners, size = [], [], [], 0
            parts += [piece, stop]
            starts.append(size)
            owners.append(number)
            size += len(piece) + 1
    if parts:
        yield np.concatenate(parts), np.array(starts), np.array(owners)


def _ngrams(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each order: the bucket of the n-gram that starts at each character.

    Each n-gram that holds a 0 gets bucket 0, which no other has.
    """
    stops = np.flatnonzero(data == 0)
    wide = data.astype(np.uint64)
    rolled = wide.copy()
    top = np.uint64(64 - BUCKET_BITS)
    for order in range(2, max(ORDERS) + 1):
        if len(data) < order:
            return
        rolled = rolled[:-1] * np.uint64(0x100000001B3) + wide[order - 1 :]
        if order not in ORDERS:
            continue
        mixed = rolled * _MULTIPLIER
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MULTIPLIER
        buckets = np.maximum(mixed >> top, np.uint64(1)).astype(np.int64)
        for back in range(order):
            at = stops - back
            buckets[at[(at >= 0) & (at < len(buckets))]] = 0
        yield order, buckets


def _present(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The distinct buckets of each text."""
    seen = np.zeros(1 << BUCKET_BITS, bool)
    for raw in texts:
        for data, _, _ in _joined([raw]):
            for _, buckets in _ngrams(data):
                seen[buckets] = True
        seen[0] = False
        found = np.flatnonzero(seen)
        yield found
        seen[found] = False


def train(
    texts: list[bytes], labels: list[int], most: int = KEPT, rounds: int = ROUNDS
) -> np.ndarray:
    """A weight by bucket, 0 for all but the ``most`` kept; the intercept is in bucket 0."""
    size, toxic = 1 << BUCKET_BITS, np.array(labels, bool)
    held = np.zeros((2, size))
    for buckets, label in zip(_present(texts), labels, strict=True):
        held[label, buckets] += 1
    both, texts_of = held.sum(axis=0), np.array([(~toxic).sum(), toxic.sum()])
    share = held.sum(axis=1) / held.sum()
    # How far the counts lie from those of n-grams that tell nothing (chi squared).
    away = held[1] - both * texts_of[1] / texts_of.sum()
    score = np.where(both >= MIN_TEXTS, away * away / np.maximum(1, both), 0.0)
    kept = np.argsort(-score, kind="stable")[:most]
    kept = np.sort(kept[score[kept] > 0])
    smooth = held + SMOOTHING
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    slot = np.full(size, -1, np.int32)
    slot[kept] = np.arange(len(kept))

    counts, columns = [], []
    for buckets in _present(texts):
        found = slot[buckets]
        columns.append(found[found >= 0])
        counts.append(len(columns[-1]))
    rows, columns = np.repeat(np.arange(len(texts)), counts), np.concatenate(columns)
    values = ratio[kept][columns]
    weights, bias = np.zeros(len(kept)), float(np.log(share[1] / share[0]))
    first, second = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, rounds + 1):
        sums = np.bincount(rows, values * weights[columns], len(texts)) + bias
        error = (1 / (1 + np.exp(-np.clip(sums, -35, 35))) - toxic) / len(texts)
        slope = np.bincount(columns, values * error[rows], len(kept)) + L2 * weights
        slope = np.append(slope, error.sum())
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        move = first / (1 - 0.9**step) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        now = RATE * (1 - 0.9 * step / rounds)
        weights -= now * move[:-1]
        bias -= now * move[-1]
    out = np.zeros(size, np.float32)
    out[kept] = weights * ratio[kept]
    out[0] = bias
    return out


def _fit(most: int, rounds: int, texts: list[bytes], labels: list[int]) -> bytes:
    return train(texts, labels, most, rounds).tobytes()


def learn_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    usable: Column | None = None,
    per_class: int = SAMPLE_DOCS,
    most: int = KEPT,
    rounds: int = ROUNDS,
) -> np.ndarray | None:
    """Weights learned from a bounded sample of the usable labels; None without both classes.

    ``most`` is how many n-grams get a weight, ``rounds`` how long the training takes.
    """
    sample = labelled_sample(docs, labels, label, usable=usable, per_class=per_class)
    if sample is None:
        return None
    weights = np.frombuffer(fit_in_one_task(sample.rows, partial(_fit, most, rounds)), np.float32).copy()
    weights[0] += sample.shift
    return weights


def score_texts(texts: list[bytes], weights: np.ndarray) -> np.ndarray:
    known = weights != 0
    known[0] = False
    found = [np.zeros(0, np.int64)]
    for data, starts, owners in _joined(texts):
        for _, buckets in _ngrams(data):
            at = np.flatnonzero(known[buckets])
            owner = owners[np.searchsorted(starts, at, side="right") - 1]
            found.append(np.unique(owner << BUCKET_BITS | buckets[at]))
    every = np.unique(np.concatenate(found))
    owner, bucket = every >> BUCKET_BITS, every & ((1 << BUCKET_BITS) - 1)
    sums = np.bincount(owner, weights[bucket], len(texts)) + weights[0]
    return 1 / (1 + np.exp(-np.clip(sums, -35, 35)))


def _score_work(broadcast) -> TextWork:
    weights = broadcast.value

    def work(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(score_texts(as_bytes(texts), weights), pa.float64())]

    return work


def score_toxicity(
    df: DataFrame,
    weights: np.ndarray | None,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep`` and ``score``, the chance of label 1, of every row.

    A null text, or one shorter than the shortest n-gram, gets the score of the
    intercept. Without weights every score is 0.5. Repeated rows stay and score alike, an
    empty table gives an empty result, a long text is worked on in pieces.
    """
    if weights is None:
        weights = np.zeros(1 << BUCKET_BITS, np.float32)
    shared = df.sparkSession.sparkContext.broadcast(weights)
    return map_texts(df, text, keep, "score double", partial(_score_work, shared))
