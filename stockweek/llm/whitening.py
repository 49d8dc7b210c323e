"""Whitening of embeddings by their leading principal components.

One pass makes the list of distinct vectors, one sums it, one adds up the products of
the centred vectors: a task holds one matrix and passes on its rows, which are added
up by row number. The eigenvalues come from contour integration, one task for each
interval of the spectrum. A last pass over the distinct vectors measures the
covariance of what whitening makes of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweek.llm import feast
from stockweek.llm.columns import bound_batches, col, without
from stockweek.session import scratch_dir

STEPS, OFFSET = 64, 1_000_000

# Entries beyond this have no exact whole number of steps; their rows are left out.
_LARGEST = float(1 << 53)

# A task holds a matrix of that many columns squared, 134 MB.
MAX_DIMS = 4096

_FIELDS = (
    "component int, n bigint, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


class Whitening(NamedTuple):
    """What is learned from the distinct vectors."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    weights: np.ndarray  # one column for each component, over the root of its eigenvalue
    trace: float
    identity_error: float


def _whole(vectors: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """The places of the vectors to use, and their entries as whole numbers."""
    places, out = [], []
    offsets = vectors.offsets.to_numpy()
    flat = vectors.values
    null = flat.is_null().to_numpy(zero_copy_only=False)
    entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    steps = np.floor(STEPS * entries)
    good = ~null & np.isfinite(entries) & (np.abs(steps) <= _LARGEST)
    bad = np.concatenate([[0], np.cumsum(~good)])
    steps = np.where(good, steps, 0.0).astype(np.int64) + OFFSET
    for i, valid in enumerate(vectors.is_valid().to_pylist()):
        begin, end = int(offsets[i]), int(offsets[i + 1])
        if valid and bad[begin] == bad[end]:
            places.append(i)
            out.append(steps[begin:end])
    return np.array(places, np.int64), out


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        _, rows = _whole(batch.column(0))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([len(x) for x in rows], pa.int32()),
                pa.array([x.tobytes() for x in rows], pa.binary()),
            ],
            names=["dims", "x"],
        )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def _sums(dims: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = [0] * dims, 0
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            # Halves of 32 bits, so that a batch of any length adds up exactly.
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(b) for t, h, b in zip(total, high, low, strict=True)]
            n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(dims), pa.int32()),
                    pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)),
                    pa.array([n] * dims, pa.int64()),
                ],
                names=["at", "total", "n"],
            )

    return run


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> tuple[np.ndarray, list[int]]:
    """x - S/n, and the sum of (n*x - S)^2 of each row, exact.

    S/n is split into whole steps and a rest below n, so that nothing is rounded
    before the last subtraction.
    """
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    near = x - whole
    centred = near - rest / n
    if np.abs(near).max(initial=0) < 1 << 19 and n < 1 << 31:
        gaps = near * n - rest
        high, low = gaps >> 31, gaps & 0x7FFFFFFF
        parts = ((high * high).sum(1), (high * low).sum(1), (low >> 16, low & 0xFFFF))
        a, b = parts[2]
        squares = ((a * a).sum(1), (a * b).sum(1), (b * b).sum(1))
        exact = [
            (hh << 62) + (hl << 32) + (aa << 32) + (ab << 17) + bb
            for hh, hl, aa, ab, bb in zip(
                parts[0].tolist(), parts[1].tolist(), *(s.tolist() for s in squares), strict=True
            )
        ]
    else:
        exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
    return centred, exact


def _products(dims: int, prepare: Callable[[np.ndarray], np.ndarray], width: int) -> Callable:
    """Of the prepared rows of a task: their sum, as row -1, and the sum of their products."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros((width, width)), np.zeros(width)
        for batch in batches:
            made = prepare(_matrix(batch.column(0), dims))
            total += made.T @ made
            rows += made.sum(axis=0)
        yield _by_row([-1, *range(width)], [rows, *total])

    return run


def _by_row(numbers: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
    values = pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), values], names=["at", "row"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one number added up."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held[at] = held[at] + np.array(row) if at in held else np.array(row)
    if held:
        yield _by_row(list(held), list(held.values()))


def _covariance(
    fit: DataFrame, dims: int, n: int, prepare: Callable[[np.ndarray], np.ndarray], width: int
) -> np.ndarray:
    """The covariance, with divisor n, of the prepared vectors, which are centred."""
    schema = "at int, row array<double>"
    parts = fit.select("x").mapInArrow(_products(dims, prepare, width), schema)
    rows = dict(parts.repartition("at").mapInArrow(_added, schema).collect())
    mean = np.array(rows.pop(-1)) / n
    matrix = np.array([rows[i] for i in range(width)]) / n - np.outer(mean, mean)
    return (matrix + matrix.T) / 2


def _components(spark, matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues above zero and their vectors, a task for each interval."""
    parts = feast.intervals_of_largest(matrix, k)
    if not parts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    shared = spark.sparkContext.broadcast(matrix)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                values, vectors = feast.solve_interval(shared.value, feast.Interval(**row))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values), pa.array(vectors.T.tolist(), pa.list_(pa.float64()))],
                    names=["value", "vector"],
                )

    table = spark.createDataFrame(parts, "low double, high double, count int")
    found = table.repartition(len(parts)).mapInArrow(solve, "value double, vector array<double>")
    rows = sorted(found.collect(), key=lambda r: -r["value"])[:k]
    # Vectors of larger eigenvalues are taken out of the others, as far as rounding left them there.
    vectors = np.linalg.qr(np.array([r["vector"] for r in rows]).T)[0]
    # Either sign is right; the largest entry of each is made positive.
    largest = np.abs(vectors).argmax(axis=0)
    signs = np.sign(vectors[largest, np.arange(len(rows))])
    return np.array([r["value"] for r in rows]), vectors * signs


def fit_whitening(df: DataFrame, embedding: str = "embedding", components: int = 16) -> Whitening | None:
    """Means and components of the distinct vectors; None without any.

    A vector is left out if it is null, or holds an entry that is null, not finite, or
    beyond 2^53 steps of 1/64. Of vectors of several lengths, only those of the commonest
    length among the distinct ones are used, the longer one of a tie. The components are
    as many as asked for, but no more than the eigenvalues above rounding: none if all
    vectors are equal. A length above ``MAX_DIMS`` raises.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "vectors")
    bound_batches(spark)
    vectors = df.select(col(embedding).cast("array<double>").alias("v"))
    vectors.mapInArrow(_distinct, "dims int, x binary").distinct().write.parquet(path)
    fit = spark.read.parquet(path)
    common = fit.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None or not common["dims"]:
        return None
    dims = common["dims"]
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS} can be whitened")
    fit = fit.filter(F.col("dims") == dims)
    added = fit.select("x").mapInArrow(_sums(dims), "at int, total decimal(38,0), n bigint")
    by_dim = added.groupBy("at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    rows = sorted(by_dim.collect())
    n, sums = rows[0]["n"], [int(r["total"]) for r in rows]
    centre = lambda x: _deviations(x, n, sums)[0]
    matrix = _covariance(fit, dims, n, centre, dims)
    values, vectors = _components(spark, matrix, components)
    weights = vectors / np.sqrt(values)
    error = 0.0
    if len(values):
        made = _covariance(fit, dims, n, lambda x: centre(x) @ weights, len(values))
        error = float(np.abs(made - np.eye(len(values))).max())
    return Whitening(n, sums, values, weights, float(np.trace(matrix)), error)


def whiten(
    df: DataFrame,
    model: Whitening | None,
    embedding: str = "embedding",
    keep: tuple[str, ...] = ("vec_id",),
) -> DataFrame:
    """For each vector in use and each component of ``model``, numbered from 1: ``keep`` and the measures.

    They are ``n``, the distinct vectors; ``deviation``, the exact sum of (n*x - S)^2;
    ``whitened``, the centred vector along the component over the root of its
    eigenvalue; ``explained``, the eigenvalue's share of the variance;
    ``identity_error`` of the whole table. Vectors that ``fit_whitening`` leaves out
    give no rows, repeated rows give theirs each time, ids may be of any type, null or
    repeated. Without a model, or without a component, the result is empty. Other columns are
    not read; a measure replaces a kept column of its name. A long vector is one row,
    of up to ``MAX_DIMS`` entries.
    """
    added = T.StructType.fromDDL(_FIELDS).fields
    keep = without(keep, [f.name for f in added])
    schema = T.StructType([df.schema[name] for name in keep] + added)
    names, kept = schema.names, len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        explained = model.values / model.trace
        for batch in batches:
            places, rows = _whole(batch.column(kept))
            right = [i for i, x in enumerate(rows) if len(x) == len(model.sums)]
            if not right or not k:
                continue
            centred, exact = _deviations(np.array([rows[i] for i in right]), model.n, model.sums)
            m = len(right)
            taken = pa.array(np.repeat(places[right], k))
            columns = [c.take(taken) for c in batch.columns[:kept]]
            deviation = pa.array([Decimal(e) for e in exact], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    deviation.take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array((centred @ model.weights).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ],
                names=names,
            )

    bound_batches(df.sparkSession)
    inputs = [col(name).alias(f"c{i}") for i, name in enumerate(keep)]
    rows = df if model is not None else df.limit(0)
    return rows.select(*inputs, col(embedding).cast("array<double>").alias("v")).mapInArrow(run, schema)
