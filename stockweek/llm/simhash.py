"""SimHash fingerprints, and groups of near-duplicates found with pivot distance tables.

Documents with equal fingerprints are one class. Two fingerprints at most d bits
apart agree on some m-d of m blocks of bits, so each class goes to one bucket per
choice of m-d blocks; m grows with the number of classes, which keeps the buckets
small. In a bucket, the Hamming distances to a set of reference fingerprints form
a table: two fingerprints whose entries differ by more than d anywhere are
further apart than d. The pairs that survive are compared bit by bit. A bucket
passes on the links that join its fingerprints, never all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import (
    TextWork,
    as_bytes,
    col,
    free_name,
    give_back,
    integer_id,
    map_texts,
    own_names,
)
from stockweek.llm.components import component_labels
from stockweek.llm.perfect_hash import mix
from stockweek.session import scratch_dir

BITS = 64
SEED = 42
PIVOTS = 8

# Classes per bucket, on average, up to which the fewest tables are used.
BUCKET = 256

# Buckets up to this size compare all pairs; larger ones search outward from a
# member, which skips the pairs within a dense group.
SMALL_BUCKET = 64

# Larger buckets than two chunks are cut into chunks of so many, and a task gets two.
CHUNK = 1 << 15

_VOTE_ROWS = 1 << 15

# Bytes of a text that are split into words at a time; a run ends at the next space.
PIECE = 1 << 18
_GAP = re.compile(rb"[\x20\x09-\x0D]")


def _word_runs(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in runs of about ``PIECE`` bytes."""
    at = 0
    while at < len(raw):
        end = at + PIECE
        if end < len(raw):
            gap = _GAP.search(raw, end)
            end = gap.start() if gap else len(raw)
        yield raw[at:end].lower().split()  # bytes: A-Z only, and ASCII spaces
        at = end


def _shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """The hash bytes of every shingle of at least ``width`` words."""
    joined = b" ".join(words)
    ends = list(accumulate(map((1).__add__, map(len, words))))
    starts = [0, *ends[:-1]]
    spans = zip(starts, ends[width - 1 :], strict=False)
    hashes = b"".join([xxhash.xxh64_digest(joined[a : b - 1], SEED) for a, b in spans])
    return np.frombuffer(hashes, np.uint8).reshape(-1, 8)


def fingerprint(raw: bytes, width: int = 4) -> int:
    """The SimHash of a text's word shingles: bits that more than half their hashes have.

    A long text is taken in runs, each with the last words of the one before it.
    """
    votes, n, words = np.zeros(BITS, np.int64), 0, []
    for run in _word_runs(raw):
        words += run
        if len(words) < width:
            continue
        each = _shingle_hashes(words, width)
        for at in range(0, len(each), _VOTE_ROWS):
            votes += np.unpackbits(each[at : at + _VOTE_ROWS], axis=1).sum(axis=0, dtype=np.int64)
        n += len(each)
        words = words[len(words) - width + 1 :]
    if not n:
        return int.from_bytes(xxhash.xxh64_digest(b" ".join(words), SEED), "big") if words else 0
    return int.from_bytes(np.packbits(2 * votes > n).tobytes(), "big")


def _fingerprint_work(width: int) -> TextWork:
    def work(texts: pa.Array) -> list[pa.Array]:
        found = np.array([fingerprint(t, width) for t in as_bytes(texts)], np.uint64)
        return [pa.array(found.view(np.int64)), pa.array(mix(found).view(np.int64))]

    return work


def fingerprints(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), width: int = 4
) -> DataFrame:
    """``keep``, ``fingerprint`` and ``node``, a one-to-one scramble of it."""
    make = partial(_fingerprint_work, width)
    return map_texts(df, text, keep, "fingerprint bigint, node bigint", make)


def _blocks(classes: int, bits: int) -> list[int]:
    """Masks of the bits that a bucket shares; small buckets on average, whatever the count."""
    for m in range(bits + 1, bits + 5):
        edges = [round(BITS * i / m) for i in range(m + 1)]
        if classes >> (BITS * (m - bits) // m) <= BUCKET:
            break
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(chosen) for chosen in combinations(blocks, m - bits)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def pivot_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of fingerprints to the reference fingerprints, a row per reference."""
    pivots = mix(np.arange(1, PIVOTS + 1, dtype=np.uint64))
    return np.stack([np.bitwise_count(prints ^ p) for p in pivots]).astype(np.int8)


def _near(prints, table, i, j, bits: int) -> np.ndarray:
    """Which of the pairs ``i``, ``j`` are at most ``bits`` apart."""
    left = np.arange(len(i))
    for row in table:
        left = left[np.abs(row[i[left]] - row[j[left]]) <= bits]
    same = np.bitwise_count(prints[i[left]] ^ prints[j[left]]) <= bits
    return left[same]


def _small_links(prints, table, bucket, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """All links within small buckets; rows of a bucket follow one another."""
    found, rows, step = [], np.arange(len(prints)), 1
    while True:
        rows = rows[rows + step < len(prints)]
        rows = rows[bucket[rows] == bucket[rows + step]]
        if not len(rows):
            break
        near = rows[_near(prints, table, rows, rows + step, bits)]
        found.append((near, near + step))
        step += 1
    pairs = list(zip(*found, strict=True)) or [[np.zeros(0, int)]] * 2
    return np.concatenate(pairs[0]), np.concatenate(pairs[1])


def _flood(prints, table, bits: int) -> tuple[list[int], list[int]]:
    """Links that join a bucket's members: each member is reached once, from a near one."""
    open_, heads, members = np.arange(len(prints)), [], []
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            head = queue.pop()
            near = _near(prints, table, np.full(len(open_), head), open_, bits)
            reached = open_[near].tolist()
            queue += reached
            heads += [head] * len(reached)
            members += reached
            open_ = np.delete(open_, near)
    return heads, members


def _spanning(a: list[int], b: list[int]) -> Iterator[tuple[int, int]]:
    """Those links that join what earlier ones had not."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for x, y in zip(a, b, strict=True):
        if (p := root(x)) != (q := root(y)):
            parent[q] = p
            yield x, y


def _bucket_links(prints: np.ndarray, bucket: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Row pairs that join the near fingerprints of each bucket; rows sorted by bucket."""
    table = pivot_table(prints)
    starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    sizes = np.diff(np.concatenate([starts, [len(prints)]]))
    small = np.flatnonzero(np.repeat(sizes <= SMALL_BUCKET, sizes))
    a, b = _small_links(prints[small], table[:, small], bucket[small], bits)
    a, b = small[a].tolist(), small[b].tolist()
    # A row belongs to one bucket here, so the links of all buckets can be thinned together.
    links = list(_spanning(a, b))
    for start, size in zip(starts, sizes, strict=True):
        if size > SMALL_BUCKET:
            rows = slice(start, start + size)
            heads, members = _flood(prints[rows], table[:, rows], bits)
            links += [(start + x, start + y) for x, y in zip(heads, members, strict=True)]
    return links


def _links(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links within the buckets of a partition sorted by bucket; a bucket is whole before it is used."""
    pa.set_memory_pool(pa.system_memory_pool())
    rest = None
    for batch in _and_none(batches):
        rows = None
        if batch is not None:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(rows[0]):
                continue
        if rest is not None:
            rows = rest if rows is None else [np.concatenate(p) for p in zip(rest, rows, strict=True)]
        if rows is None:
            give_back()
            return
        *place, prints, node = rows
        key = place[0]
        new = np.flatnonzero(np.any([p[1:] != p[:-1] for p in place], axis=0)) + 1
        cut = len(key) if batch is None else int(new[-1]) if len(new) else 0
        rest = [column[cut:] for column in rows]
        bucket = np.zeros(len(key), np.int64)
        bucket[new] = 1
        bucket = np.cumsum(bucket)[:cut]
        if cut:
            pairs = _bucket_links(prints[:cut].view(np.uint64), bucket, bits)
            a, b = (np.array([p[k] for p in pairs], np.int64) for k in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node[a]), pa.array(node[b])], names=["a", "b"]
            )
            del pairs, a, b
        del place, prints, node, key, new, bucket, rows
        give_back()


def _and_none(batches):
    yield from batches
    yield None


def near_links(classes: DataFrame, bits: int, count: int) -> DataFrame:
    """Links ``a``, ``b`` between nodes that join all fingerprints at most ``bits`` apart."""
    masks = [
        F.struct(F.lit(i).alias("t"), F.col("fingerprint").bitwiseAND(F.lit(_signed(m))).alias("k"))
        for i, m in enumerate(_blocks(count, bits))
    ]
    buckets = classes.select(F.explode(F.array(*masks)).alias("at"), "fingerprint", "node")
    buckets = buckets.select("at.t", "at.k", "fingerprint", "node")
    return (
        _dealt(buckets)
        .repartition("t", "k", "pair")
        .sortWithinPartitions("t", "k", "pair")
        .mapInArrow(partial(_links, bits), "a bigint, b bigint")
    )


def _dealt(buckets: DataFrame) -> DataFrame:
    """``t``, ``k``, ``pair``, ``fingerprint``, ``node``: what is compared in one place.

    A bucket of more than two chunks is cut by a hash of the node, and each chunk
    goes to a pair with each other one, so that every two members meet.
    """
    spark = buckets.sparkSession
    path = f"{scratch_dir(spark, 'buckets')}/large"
    sizes = buckets.groupBy("t", "k").agg(F.count("*").alias("n")).filter(F.col("n") > 2 * CHUNK)
    sizes.write.parquet(path)
    sizes = spark.read.parquet(path).select("t", "k", F.ceil(F.col("n") / CHUNK).alias("chunks"))
    large = sizes.count()
    if not large:
        return buckets.select("t", "k", F.lit(0).cast("bigint").alias("pair"), "fingerprint", "node")
    sizes = F.broadcast(sizes) if 24 * large <= BROADCAST_BYTES else sizes
    own, chunks = F.pmod(F.xxhash64("node"), F.col("chunks")), F.col("chunks")
    others = F.filter(F.sequence(F.lit(0).cast("bigint"), chunks - 1), lambda c: c != F.col("own"))
    pairs = F.transform(others, lambda c: F.least(c, "own") * chunks + F.greatest(c, "own"))
    whole = F.array(F.lit(0).cast("bigint"))
    pairs = F.when(chunks.isNull(), whole).otherwise(pairs)
    cut = buckets.join(sizes, ["t", "k"], "left").withColumn("own", own)
    return cut.select("t", "k", F.explode(pairs).alias("pair"), "fingerprint", "node")


def near_duplicates(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    width: int = 4,
    bits: int = 4,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint) and ``component_id`` of every row.

    ``component_id`` is the smallest id reached by links of at most ``bits``
    differing bits. Words are split at ASCII spaces, A-Z lower-cased; a text of
    fewer words than ``width`` is one shingle. A null or empty text has
    fingerprint 0 and links like any other. Repeated rows stay; a null id is
    never the smallest unless a group has no other. An empty table gives an
    empty result. Ids are integers, see ``columns.integer_id``. A long text is split
    into words in runs. Other columns are not read.
    """
    found = _grouped(df, text, doc_id, width, bits)
    return found.select(F.col("doc_id").alias(doc_id), "fingerprint", "component_id")


def _grouped(df: DataFrame, text: str, doc_id: str, width: int = 4, bits: int = 4) -> DataFrame:
    """``doc_id``, ``fingerprint``, ``component_id`` of every row, and whether it is ``first``.

    First are the rows with the smallest id of the component, nulls last, and among
    these the ones with the smallest fingerprint; several rows if they repeat.
    """
    spark = df.sparkSession
    scratch = scratch_dir(spark, "simhash")
    source = df.select(integer_id(df, doc_id).alias("doc_id"), col(text).alias("text"))
    fingerprints(source, width=width).write.parquet(f"{scratch}/prints")
    prints = spark.read.parquet(f"{scratch}/prints")
    grouped = prints.groupBy("fingerprint", "node").agg(F.min("doc_id").alias("least"))
    grouped.write.parquet(f"{scratch}/classes")
    classes = spark.read.parquet(f"{scratch}/classes")
    links = near_links(classes, bits, classes.count())
    labels = component_labels(links, f"{scratch}/graph")
    labels.join(classes, "node").write.parquet(f"{scratch}/labelled")
    labelled = spark.read.parquet(f"{scratch}/labelled")
    order = F.struct(F.col("least").isNull().alias("none"), "least", "fingerprint")
    least = labelled.groupBy("label").agg(F.min(order).alias("of"))
    linked = labelled.join(least, "label").select(
        "fingerprint",
        F.col("of.least").alias("component_id"),
        (F.col("of.fingerprint") == F.col("fingerprint")).alias("leads"),
    )
    # A class without a link is a component of its own.
    named = classes.join(linked, "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("component_id", "least").alias("component_id"),
        F.coalesce("leads", F.lit(True)).alias("leads"),
    )
    first = F.col("leads") & F.col("doc_id").eqNullSafe(F.col("component_id"))
    return prints.join(named, "fingerprint").select(
        "doc_id", "fingerprint", "component_id", first.alias("first")
    )


def drop_near_duplicates(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    width: int = 4,
    bits: int = 4,
) -> DataFrame:
    """One row of ``df`` per group: that with the smallest id; all columns stay.

    Rows without an id go when their group has a document with one. Rows of the
    smallest id that are near copies of one another count as one: that with the
    smallest fingerprint stays, then that with the smallest text, a null as an empty one, and
    of those the row that is smallest as JSON. An empty table stays empty.
    """
    spark = df.sparkSession
    groups = _grouped(df, text, doc_id, width, bits)
    scratch = scratch_dir(spark, "copies")
    # An id of a single row tells that row; of others, and of rows without, the text must.
    alike = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("first").alias("first"))
    unclear = F.col("doc_id").isNull() | (F.col("n") > 1)
    listed = alike.filter(unclear | ~F.col("first"))
    listed.select("doc_id", unclear.alias("unclear")).write.parquet(f"{scratch}/copies")
    listed = spark.read.parquet(f"{scratch}/copies")
    name = free_name(df.columns, "copy")
    ids = listed.filter("doc_id IS NOT NULL").select(F.col("doc_id").alias(name), "unclear")
    own = integer_id(df, doc_id)
    known = own.isNotNull()
    kept = df.filter(known).join(_sent(ids.select(name)), own == F.col(name), "left_anti")
    unclear_ids = ids.filter("unclear").select(name)
    open_rows = []
    if not unclear_ids.isEmpty():
        open_rows.append(df.join(_sent(unclear_ids), own == F.col(name), "left_semi"))
    if not listed.filter("doc_id IS NULL").isEmpty():
        open_rows.append(df.filter(~known))
    if not open_rows:
        return kept
    rows, names = own_names(open_rows[0] if len(open_rows) == 1 else open_rows[0].union(open_rows[1]))
    rows = fingerprints(rows, names[text], tuple(names.values()), width)
    rows = rows.withColumn("id", F.col(names[doc_id]).cast("bigint"))
    first = groups.filter("first").select(
        F.col("doc_id").alias("first_id"), F.col("fingerprint").alias("first_print")
    )
    same = F.col("id").eqNullSafe(F.col("first_id")) & (F.col("fingerprint") == F.col("first_print"))
    rows = rows.join(first.distinct(), same, "left_semi")
    # Combined before the shuffle, so that a row repeated often costs one per task.
    whole = F.struct(*names.values())
    order = F.struct(F.coalesce(F.col(names[text]).cast("string"), F.lit("")), F.to_json(whole))
    one = rows.groupBy("id", "fingerprint").agg(F.min_by(whole, order).alias("row"))
    return kept.union(one.select(*(F.col(f"row.{own}").alias(n) for n, own in names.items())))


def _sent(ids: DataFrame) -> DataFrame:
    """The ids, to be broadcast if they are measured to be few."""
    return F.broadcast(ids) if 16 * ids.count() <= BROADCAST_BYTES else ids


# The largest list of ids that is sent to every executor, in bytes.
BROADCAST_BYTES = 32 << 20
