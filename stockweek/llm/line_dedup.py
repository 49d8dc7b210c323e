"""Dropping lines that an earlier document holds, through sharded perfect hashes.

Every distinct line has a 128-bit key. The keys are dealt into shards of bounded
size; each shard becomes a minimal perfect hash with compact arrays of
fingerprints, counts and owners (the smallest document id). Documents send only
their keys to the shards and probe the arrays there; line texts never move.
Lines so common that one task would get too many probes are at most
``HOT_LINES`` by their definition, so their arrays are broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import TextWork, as_bytes, free_name, integer_id, map_texts
from stockweek.llm.perfect_hash import LineIndex
from stockweek.session import scratch_dir

SPACES = b" \t\n\x0b\x0c\r"
MIN_KEY_CHARS = 10

# Distinct lines in a shard, and probes of it, on average and at most; and the least number
# of shards for each partition of a shuffle, so that a few lines fill the tasks as well.
SHARD_KEYS, SHARD_PROBES = 1 << 15, 1 << 18
SHARDS_PER_TASK = 4

# A line held by this part of all (line, document) pairs is hot; so no more than
# HOT_LINES are, and any other line sends less than that part to its shard.
HOT_LINES = 10_000

# The largest lists of lines to drop that are sent to every executor, in bytes.
BROADCAST_BYTES = 32 << 20

NO_ID = -(1 << 63)


def _key(line: bytes) -> bytes | None:
    """The 128-bit key of a line that is long enough to count."""
    key = line.strip(SPACES).lower()  # bytes.lower() changes A-Z only
    if len(key) < MIN_KEY_CHARS or len(key) < 40 and len(key.decode()) < MIN_KEY_CHARS:
        return None
    return xxhash.xxh3_128_digest(key)


def _halves(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def _keys_work() -> TextWork:
    """The distinct keys of every text, as one run of bytes."""

    def work(texts: pa.Array) -> list[pa.Array]:
        found = [set(map(_key, t.split(b"\n"))) for t in as_bytes(texts)]
        return [pa.array([b"".join(k for k in keys if k) for keys in found], pa.binary())]

    return work


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(1)
        sizes = pa.compute.binary_length(keys).to_numpy(zero_copy_only=False) // 16
        high, low = _halves(keys.to_pylist())
        doc = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), sizes)
        yield pa.RecordBatch.from_arrays(
            [pa.array(high), pa.array(low), pa.array(doc, pa.int64())], names=["high", "low", "doc"]
        )


def _build(shard: pa.Table) -> pa.Table:
    high, low, n, owner = (shard[c].to_numpy() for c in ("high", "low", "n", "owner"))
    data = LineIndex.build(high, low, n, owner).to_bytes()
    return pa.table({"shard": shard["shard"][:1], "data": pa.array([data], pa.binary())})


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by shard, each shard's arrays first: the probes that hit."""
    index = None
    for batch in batches:
        high, low, doc = (batch.column(c).to_numpy(zero_copy_only=False) for c in (1, 2, 3))
        data = batch.column(4)
        starts = np.flatnonzero(data.is_valid().to_numpy(zero_copy_only=False))
        hits, at = np.zeros(len(high), bool), 0
        for end in [*starts.tolist(), len(high)]:
            if end > at:
                part = slice(at, end)
                hits[part] = index.shared_elsewhere(high[part], low[part], doc[part])
            if end < len(high):
                index = LineIndex.from_bytes(data[end].as_py())
            at = end + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[hits]), pa.array(high[hits])], names=["doc", "high"]
        )


def _lines_to_drop(pairs: DataFrame, scratch: str) -> tuple[DataFrame, LineIndex]:
    """Keys to drop by document, from (key, document) pairs; and the hot lines' arrays."""
    spark = pairs.sparkSession
    one = pairs.groupBy("high", "low").agg(
        F.min("doc").alias("owner"), F.count(F.lit(1)).alias("n")
    )
    one.write.parquet(f"{scratch}/lines")
    lines = spark.read.parquet(f"{scratch}/lines")
    n_keys, n_pairs = lines.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    is_hot = F.col("n") >= max(1000, n_pairs // HOT_LINES)
    rows = np.array(lines.filter(is_hot).select("high", "low", "n", "owner").collect(), np.int64)
    rows = rows.reshape(-1, 4)
    # All lines of all documents ask it, so it holds the whole keys, 160 KB at most.
    hot = LineIndex.build(*rows.T, whole=True)

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(SHARDS_PER_TASK * tasks, n_keys // SHARD_KEYS, n_pairs // SHARD_PROBES)
    shard = F.pmod("high", F.lit(shards)).cast("int").alias("shard")
    index = (
        lines.filter(~is_hot)
        .select(shard, "high", "low", "n", "owner")
        .groupBy("shard")
        .applyInArrow(_build, "shard int, data binary")
    )
    none = F.lit(None).cast("bigint")
    arrays = index.select("shard", none.alias("high"), none.alias("low"), none.alias("doc"), "data")
    hot_keys = spark.createDataFrame(rows[:, :2].tolist(), "high bigint, low bigint")
    cold = pairs.join(F.broadcast(hot_keys), ["high", "low"], "left_anti")
    probes = cold.select(shard, "high", "low", "doc", F.lit(None).cast("binary").alias("data"))
    hits = (
        arrays.unionByName(probes)
        .repartition("shard")
        .sortWithinPartitions("shard", F.col("data").isNull())
        .select("shard", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("high", "low", "doc")), "data")
        .mapInArrow(_probe, "doc bigint, high bigint")
    )
    by_doc = hits.groupBy("doc").agg(F.collect_set("high").alias("drop"))
    by_doc.write.parquet(f"{scratch}/drops")
    return spark.read.parquet(f"{scratch}/drops"), hot


def _rewrite_work(hot) -> TextWork:
    common = LineIndex.from_bytes(hot.value)

    def kept(text: bytes, doc: int, drop: set[int]) -> tuple[int, list[bytes]]:
        lines = text.split(b"\n")
        keys = [_key(line) for line in lines]
        at = [i for i, key in enumerate(keys) if key]
        if not at:
            return len(lines), lines
        high, low = _halves([keys[i] for i in at])
        gone = common.shared_elsewhere(high, low, np.int64(doc))
        if drop:
            gone |= np.array([h in drop for h in high.tolist()])
        dropped = {i for i, out in zip(at, gone.tolist(), strict=True) if out}
        return len(lines), [line for i, line in enumerate(lines) if i not in dropped]

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        ids, drops, texts = batch.columns[-3:]
        out = [
            kept(text, doc, set(drop or ()))
            for text, doc, drop in zip(
                as_bytes(texts), ids.to_pylist(), drops.to_pylist(), strict=True
            )
        ]
        n = [lines for lines, _ in out]
        texts = pa.array([b"\n".join(lines) for _, lines in out], pa.binary()).cast(pa.string())
        return [
            pa.compute.if_else(batch.columns[-1].is_valid(), texts, pa.scalar(None, pa.string())),
            pa.array(n, pa.int64()),
            pa.array([a - len(lines) for a, (_, lines) in zip(n, out, strict=True)], pa.int64()),
        ]

    return work


def dedup_lines(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep``, ``kept_text``, ``n_lines`` and ``n_dropped`` of every row.

    A line's key is the line with ASCII spaces stripped and A-Z lower-cased. A
    key of ten or more code points in two or more documents loses all its lines
    except in the document with the smallest id. Rows that share an id are one
    document; so are all rows without an id, which comes before any other. A
    null text stays null and counts as one empty line. An empty table gives an
    empty result. Lines compare by a 128-bit hash. Rows without an id hold the smallest one,
    so they lose no line, and none is listed for them. Ids are integers, see
    ``columns.integer_id``. A long text is worked on whole, at about five times its size. A
    result replaces a kept column of its name, other columns may have any.
    """
    spark = df.sparkSession
    scratch = scratch_dir(spark, "lines")
    id_column, drop_column = free_name(df.columns, "doc"), free_name(df.columns, "drop")
    docs = df.select(
        "*", F.coalesce(integer_id(df, doc_id), F.lit(NO_ID)).alias(id_column)
    )
    keyed = map_texts(docs, text, [id_column], "keys binary", _keys_work)
    pairs = keyed.mapInArrow(_exploded, "high bigint, low bigint, doc bigint")
    pairs.write.parquet(f"{scratch}/pairs")
    drops, hot = _lines_to_drop(spark.read.parquet(f"{scratch}/pairs"), scratch)

    rows, keys = drops.agg(F.count(F.lit(1)), F.sum(F.size("drop"))).first()
    if 32 * rows + 8 * (keys or 0) <= BROADCAST_BYTES:
        drops = F.broadcast(drops)
    drops = drops.select(F.col("doc").alias(id_column), F.col("drop").alias(drop_column))
    known = spark.sparkContext.broadcast(hot.to_bytes())
    return map_texts(
        docs.join(drops, id_column, "left"),
        text,
        keep,
        "kept_text string, n_lines bigint, n_dropped bigint",
        partial(_rewrite_work, known),
        beside=(id_column, drop_column),
    )
