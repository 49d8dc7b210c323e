"""Licence notices in documents, by MinHash bands over overlapping windows of words.

A document's shingles are cut into overlapping windows. The smallest hashes of a
window are its MinHash sketch, of one function and several minima; each minimum
is a band. All shingles of a notice are in the index of bands, so a window finds a
notice when any shingle they share is among the window's minima; there are so many
minima that this can hardly fail. A band tells the notice and where it would have
to begin; there the share of its shingles is counted exactly. All of it is
DataFrame functions on the document's own row.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, comb
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweek.llm.columns import col
from stockweek.llm.license_texts import LICENSE_TEXTS

SHINGLE = 5
CONTAINED = 0.8

# The chance that a window has no band of a notice that it holds to CONTAINED.
MISS = 0.001

# Bands of all notices, which every task holds.
MAX_BANDS = 200_000


class Shape(NamedTuple):
    """Words in a shingle, shingles in a window, shingles from one window to the next.

    Of a notice no longer than a window less a step, some window holds all; of a
    longer one, some window holds at least that much.
    """

    shingle: int
    window: int
    stride: int

    @classmethod
    def of(cls, words: int) -> Shape:
        size = min(SHINGLE, words)
        shingles = words - size + 1
        return cls(size, 1, 1) if shingles == 1 else cls(size, 8, 4) if shingles <= 5 else cls(size, 16, 8)

    def bands(self, words: int) -> int:
        """Minima per window, so that a notice of so many words is missed with chance ``MISS`` at most.

        Of a window's n shingles at least c are the notice's. All k minima are among
        the n - c others with the chance C(n - c, k) / C(n, k).
        """
        n, shingles = self.window, words - self.shingle + 1
        c = min(ceil(CONTAINED * shingles), ceil(CONTAINED * (n - self.stride + 1)))
        return next(k for k in range(1, n + 1) if comb(n - c, k) <= MISS * comb(n, k))


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; none for null."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.array_remove(parts, "")


def _shingles(words: Column, size: Column) -> Column:
    """The shingles of an array of words, as text."""
    last = F.size(words) - size
    starts = F.when(last >= 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, size), " "))


def _with_hashes(df: DataFrame, sizes: set[int]) -> DataFrame:
    """Adds ``h3``, ``h5``...: the hashes of the shingles of ``words`` of these sizes, in order."""
    df = df.withColumn("w", F.transform("words", lambda x: F.xxhash64(x)))
    for size in sorted(sizes):
        whole = F.greatest(F.size("w") - (size - 1), F.lit(0))
        df = df.withColumn(f"h{size}", F.slice(_hashed(F.col("w"), size), 1, whole))
    return df


def _hashed(words: Column, size: int) -> Column:
    return F.transform(
        words, lambda x, i: F.xxhash64(x, *(F.get(words, i + F.lit(k)) for k in range(1, size)))
    )


class _Index(NamedTuple):
    """The bands of the notices of one shape: as a frame and as values; minima to take; longest notice."""

    shape: Shape
    rows: DataFrame
    values: list[int]
    bands: int
    longest: int


def _indexes(notices: DataFrame, words: dict[int, int]) -> list[_Index]:
    """The shingles of the notices as bands; notices are few, as their bands are counted."""
    shapes: dict[Shape, list[int]] = {}
    for notice, n in words.items():
        shapes.setdefault(Shape.of(n), []).append(notice)
    hashed, found, total = _with_hashes(notices, {s.shingle for s in shapes}), [], 0
    for shape, members in sorted(shapes.items()):
        rows = hashed.filter(F.col("notice").isin(members)).select(
            F.lit(str(tuple(shape))).alias("shape"),
            "notice",
            F.posexplode(f"h{shape.shingle}").alias("offset", "band"),
        )
        got = rows.limit(MAX_BANDS + 1).collect()
        total += len(got)
        if total > MAX_BANDS:
            raise ValueError(f"the notices have more than {MAX_BANDS} bands")
        frame = notices.sparkSession.createDataFrame(got, rows.schema)
        sizes = [words[notice] for notice in members]
        bands = max(map(shape.bands, sizes))
        found.append(_Index(shape, frame, sorted({r["band"] for r in got}), bands, max(sizes)))
    return found


def _windows(index: _Index) -> Column:
    """Of the windows that share a band with a notice: where they are, their words, those bands."""
    (size, window, stride), name = index.shape, f"h{index.shape.shingle}"
    hashes = F.col(name)
    # The last window may be shorter, so that no shingle is left out.
    last = F.greatest(F.size(hashes) - window + stride - 1, F.lit(0))
    places = F.sequence(F.lit(0), last, F.lit(stride))

    def within(at: Column) -> Column:
        return F.slice(name, at + 1, window)

    def known(x: Column) -> Column:
        return x.isin(index.values)

    def minima(at: Column) -> Column:
        return F.slice(F.sort_array(within(at)), 1, index.bands)

    if window == 1:
        hits = F.filter(F.transform(hashes, lambda x, i: F.when(known(x), i)), F.isnotnull)
    else:
        hits = F.filter(places, lambda at: F.exists(minima(at), known))

    def found(at: Column) -> Column:
        begin = F.greatest(at - index.longest, F.lit(0))
        near = F.slice("words", begin + 1, 2 * index.longest + window + size)
        return F.struct(
            F.lit(str(tuple(index.shape))).alias("shape"),
            begin.alias("begin"),
            near.alias("near"),
            F.transform(
                F.filter(minima(at), known),
                lambda x: F.struct(
                    x.alias("band"),
                    (at + F.array_position(within(at), x).cast("int") - 1).alias("place"),
                ),
            ).alias("bands"),
        )

    return F.when(F.size(hashes) > 0, F.transform(hits, found)).otherwise(
        F.transform(F.array().cast("array<int>"), found)
    )


def _candidates(docs: DataFrame, indexes: list[_Index]) -> DataFrame:
    """Documents and the notices that bands retrieve, with the words around and the notice's start."""
    hit = docs.select("doc", F.explode(F.concat(*map(_windows, indexes))).alias("c"))
    rows = hit.select("doc", "c.shape", "c.begin", "c.near", F.explode("c.bands").alias("b"))
    rows = rows.select("doc", "shape", "begin", "near", "b.band", "b.place")
    bands = reduce(DataFrame.unionByName, [index.rows for index in indexes])
    found = rows.join(F.broadcast(bands), ["shape", "band"])
    start = F.greatest(F.col("place") - F.col("offset"), F.lit(0)).alias("start")
    # All bands of one copy give the same start.
    return found.select("doc", "notice", start, "begin", "near")


def scan_licenses(
    df: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    notices: list[tuple[str, str]] | None = None,
) -> DataFrame:
    """``doc_id``, ``license_id`` and ``containment`` of each licence that a document holds.

    A document holds a licence if some stretch of it, as many words long as one of
    the licence's notices, has at least ``CONTAINED`` of that notice's distinct
    five-word shingles; a shorter notice is one shingle. Words are lower-case runs
    of letters and digits. Each pair of id and licence comes once, with the largest
    share found; rows that share an id are one document, also those without one.
    Null and empty texts hold nothing.
    """
    known, words = _notices(df.sparkSession, notices or LICENSE_TEXTS)
    docs = df.select(col(doc_id).alias("doc"), words_of(col(text)).alias("words"))
    indexes = _indexes(known, words)
    docs = _with_hashes(docs, {index.shape.shingle for index in indexes})
    known = known.select("notice", "license_id", F.size("words").alias("length"), "shingles")
    held = _candidates(docs, indexes).join(F.broadcast(known), "notice")
    there = F.slice("near", F.col("start") - F.col("begin") + 1, F.col("length"))
    held = held.withColumn("there", there)
    own = _shingles(F.col("there"), F.least(F.lit(SHINGLE), F.col("length")))
    share = F.size(F.array_intersect("shingles", own)) / F.size("shingles")
    return (
        held.select("doc", "license_id", share.alias("share"))
        .filter(F.col("share") >= CONTAINED)
        .groupBy("doc", "license_id")
        .agg(F.max("share").alias("containment"))
        .select(F.col("doc").alias(doc_id), "license_id", "containment")
    )


def _notices(spark: SparkSession, notices: list[tuple[str, str]]) -> tuple[DataFrame, dict[int, int]]:
    """The notices' words and distinct shingles; and the number of words of each that has any."""
    given = [(i, name, text) for i, (name, text) in enumerate(notices)]
    frame = spark.createDataFrame(given, "notice int, license_id string, text string")
    frame = frame.select("notice", "license_id", words_of(F.col("text")).alias("words"))
    frame = frame.filter(F.size("words") > 0)
    size = F.least(F.lit(SHINGLE), F.size("words"))
    frame = frame.withColumn("shingles", F.array_distinct(_shingles(F.col("words"), size)))
    counts = frame.select("notice", F.size("words").alias("n")).collect()
    return frame, {r["notice"]: r["n"] for r in counts}
