"""Benchmark passages in documents, found with an FM-index per shard of documents.

A shard is a group of documents inside one task. Words that no phrase holds can be
in no occurrence, so they are breaks in the shard's sequence, and stretches
shorter than the shortest phrase are left out; neither loses a match. All phrases
are then searched backwards through the index at once, located by its kept
positions, and merged to spans of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweek.llm.columns import TextWork, as_bytes, bound_batches, col, integer_id, map_texts, without
from stockweek.llm.fm_index import FmIndex
from stockweek.llm.words import LETTERS_AND_DIGITS, LOWER, hashed_tokens, token_borders
from stockweek.session import scratch_dir

WINDOW = 10

# Words of documents and kept symbols that one index may cover; a longer document
# has an index of its own.
SHARD_WORDS = 1 << 20

# Phrase words and item ids sent to the executors at a time; more are searched block by block.
BLOCK_WORDS = 1 << 20

# Words of a passage; a longer item makes several. Lists that the ids of equal passages make.
PASSAGE_WORDS = 1 << 16
ID_LISTS = 64


class Phrases(NamedTuple):
    """Distinct windows as symbols, aligned to the right, and the items that hold each.

    A window has a list of the passages that hold it, and a passage one of its items.
    """

    vocabulary: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    first_passage: np.ndarray
    passages: np.ndarray
    first_item: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, passages: list[tuple[list[int], list[int]]], window: int) -> Phrases:
        """Of passages, each with the ids of its items and its words."""
        words = [np.array(w, np.int64).view(np.uint64) for _, w in passages]
        vocabulary = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]))
        rows, ids = [], []
        for number, found in enumerate(words):
            symbols = np.searchsorted(vocabulary, found).astype(np.int64) + 1
            if 0 < len(symbols) < window:
                rows.append(np.pad(symbols, (window - len(symbols), 0))[None])
            elif len(symbols):
                rows.append(np.lib.stride_tricks.sliding_window_view(symbols, window))
            else:
                continue
            ids.append(np.full(len(rows[-1]), number))
        all_rows = np.concatenate([*rows, np.zeros((0, window), np.int64)])
        patterns, which = np.unique(all_rows, axis=0, return_inverse=True)
        which = which.reshape(-1)
        order = np.argsort(which, kind="stable")
        first = np.searchsorted(which[order], np.arange(len(patterns) + 1))
        held = np.concatenate([*ids, np.zeros(0, np.int64)]).astype(np.int64)[order]
        items = [np.array(i, np.int64) for i, _ in passages]
        first_item = np.cumsum([0, *map(len, items)])
        every = np.concatenate([*items, np.zeros(0, np.int64)])
        return cls(vocabulary, patterns, (patterns > 0).sum(axis=1), first, held, first_item, every)

    def items_of(self, pattern: int) -> set[int]:
        """The items that hold a window."""
        at = self.passages[self.first_passage[pattern] : self.first_passage[pattern + 1]]
        return {i for p in at for i in self.items[self.first_item[p] : self.first_item[p + 1]].tolist()}


# Stands for a missing item id: its phrases count as hits but are not listed.
NO_ITEM = -(1 << 63)


def _symbols(texts: list[bytes], phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text number and symbol of every word, in parts."""
    known = phrases.vocabulary
    for owner, hashes in hashed_tokens(texts, LETTERS_AND_DIGITS, LOWER):
        at = np.minimum(np.searchsorted(known, hashes), max(0, len(known) - 1))
        hit = known[at] == hashes if len(known) else np.zeros(len(at), bool)
        yield owner, np.where(hit, at + 1, 0)


def _stretches(owner: np.ndarray, symbol: np.ndarray, shortest: int):
    """Places of the words to index, with a break (-1) after each stretch of them."""
    edge = np.concatenate([[True], owner[1:] != owner[:-1]]) | (symbol == 0)
    stretch = np.cumsum(edge)
    known = symbol > 0
    sizes = np.bincount(stretch[known], minlength=stretch[-1] + 1 if len(stretch) else 1)
    places = np.flatnonzero(known & (sizes[stretch] >= shortest))
    ends = np.flatnonzero(np.diff(stretch[places], append=-1) != 0) + 1
    return np.insert(places, ends, -1)


def find_phrases(owner: np.ndarray, symbol: np.ndarray, phrases: Phrases):
    """Of each occurrence: the place of its first word, its length, and its pattern."""
    none = np.zeros(0, np.int64)
    if not len(owner) or not len(phrases.patterns):
        return none, none, none
    places = _stretches(owner, symbol, int(phrases.lengths.min()))
    if not len(places):
        return none, none, none
    text = np.where(places < 0, 0, symbol[places])
    index = FmIndex(text, len(phrases.vocabulary))
    first, last = index.search(phrases.patterns, phrases.lengths)
    found = np.maximum(last - first, 0)
    pattern = np.repeat(np.arange(len(found)), found)
    rows = np.arange(found.sum()) - np.repeat(np.cumsum(found) - found - first, found)
    at = places[index.locate(rows)]
    return at, phrases.lengths[pattern], pattern


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    merged: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if merged and start <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
        else:
            merged.append((start, end))
    return merged


class _Hits(NamedTuple):
    words: int
    spans: list[tuple[int, int]]
    items: set[int]


def _shard_hits(texts: list[bytes], phrases: Phrases) -> Iterator[_Hits]:
    parts = list(_symbols(texts, phrases))
    owner = np.concatenate([np.zeros(0, np.int64), *(o for o, _ in parts)])
    symbol = np.concatenate([np.zeros(0, np.int64), *(s for _, s in parts)])
    counts = np.bincount(owner, minlength=len(texts))
    begins = np.cumsum(counts) - counts
    at, length, pattern = find_phrases(owner, symbol, phrases)
    hits = [_Hits(n, [], set()) for n in counts.tolist()]
    doc = owner[at]
    start = at - begins[doc]
    for d, s, n in np.unique(np.stack([doc, start, length]), axis=1).T.tolist():
        hits[d].spans.append((s, s + n))
    for d, p in np.unique(np.stack([doc, pattern]), axis=1).T.tolist():
        hits[d].items.update(phrases.items_of(p))
    yield from hits


def _hits(texts: list[bytes], phrases: Phrases) -> Iterator[_Hits]:
    group, size = [], 0
    for raw in texts:
        if group and size + len(raw) > 4 * SHARD_WORDS:
            yield from _shard_hits(group, phrases)
            group, size = [], 0
        group.append(raw)
        size += len(raw)
    if group:
        yield from _shard_hits(group, phrases)


def _pairs(flat: list[int] | None) -> list[tuple[int, int]]:
    return list(zip(flat[::2], flat[1::2], strict=True)) if flat else []


def _search_work(broadcast) -> TextWork:
    phrases = Phrases(*broadcast.value)

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        spans, items, texts = batch.columns
        found = list(_hits(as_bytes(texts), phrases))
        all_spans = [
            [x for span in merge_spans(_pairs(old) + hit.spans) for x in span]
            for old, hit in zip(spans.to_pylist(), found, strict=True)
        ]
        all_items = [
            sorted({*(old or ()), *hit.items} - {NO_ITEM})
            for old, hit in zip(items.to_pylist(), found, strict=True)
        ]
        return [
            pa.array([hit.words for hit in found], pa.int64()),
            pa.array(all_spans, pa.list_(pa.int64())),
            pa.array(all_items, pa.list_(pa.int64())),
        ]

    return work


def _passages(window: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items as hashed words, a long one in passages that overlap by a window less one word."""
    for batch in batches:
        for item, raw in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
            parts = [h for _, h in hashed_tokens([raw], LETTERS_AND_DIGITS, LOWER)]
            words = np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.uint64).view(np.int64)
            step = PASSAGE_WORDS - window + 1
            cut = [words[at : at + PASSAGE_WORDS] for at in range(0, max(1, len(words) - window + 1), step)]
            cut = [c for c in cut if len(c)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([NO_ITEM if item is None else item] * len(cut), pa.int64()),
                    pa.array([c.tolist() for c in cut], pa.list_(pa.int64())),
                ],
                names=["item", "words"],
            )


def phrase_blocks(items: DataFrame, text: str, item_id: str, window: int) -> Iterator[tuple[Phrases, bool]]:
    """The phrases of all items, in blocks of at most ``BLOCK_WORDS`` words and ids; whether more follow.

    Equal passages are one, with all their items. The blocks are filled as the passages
    stream by, so the driver holds one block. Without any words there is one empty block.
    """
    spark, scratch = items.sparkSession, scratch_dir(items.sparkSession, "phrases")
    bound_batches(spark)
    source = items.select(integer_id(items, item_id).alias("item"), col(text).cast("string").cast("binary").alias("t"))
    passages = source.mapInArrow(partial(_passages, window), "item bigint, words array<bigint>")
    # Ids are dealt to lists, so that those of one frequent passage make no single row.
    part = F.pmod(F.xxhash64("item"), F.lit(ID_LISTS)).alias("part")
    passages.groupBy("words", part).agg(F.collect_set("item").alias("ids")).write.parquet(scratch)
    block, size, ready = [], 0, None
    for row in spark.read.parquet(scratch).select("ids", "words").toLocalIterator():
        weight = len(row["ids"]) + len(row["words"])
        if block and size + weight > BLOCK_WORDS:
            if ready is not None:
                yield Phrases.of(ready, window), True
            ready, block, size = block, [], 0
        block.append((row["ids"], row["words"]))
        size += weight
    if ready is not None:
        yield Phrases.of(ready, window), True
    yield Phrases.of(block, window), False


def find_contamination(
    df: DataFrame,
    items: DataFrame,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    item_text: str = "text",
    item_id: str = "item_id",
    window: int = WINDOW,
) -> DataFrame:
    """``keep``, ``n_words``, ``hit_spans`` and ``hit_items`` of every row of ``df``.

    Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
    characters. A phrase is ``window`` consecutive words of an item, or all words
    of a shorter item. ``hit_spans`` lists the merged spans of words inside any
    occurrence as start, end, start, end...; ``hit_items`` the items that occur, in
    order, each once. A null text has no words; items without words, or an empty
    table of items, match nothing. An item without an id is searched but not
    listed. Item ids are integers, see ``columns.integer_id``; those of ``df`` may be
    anything. Repeated rows stay and get the same result, repeated items count once. A long
    text is an index of its own. Words compare by a 64-bit hash.
    """
    spark, scratch = df.sparkSession, scratch_dir(df.sparkSession, "contamination")
    none = F.lit(None).cast("array<bigint>")
    kept = without(keep, ["n_words", "hit_spans", "hit_items"])
    kept = {name: f"k{i}" for i, name in enumerate(kept)}
    source = df.select(
        *(col(name).alias(k) for name, k in kept.items()),
        col(text).alias("text"),
        none.alias("hit_spans"),
        none.alias("hit_items"),
    )
    fields = "n_words bigint, hit_spans array<bigint>, hit_items array<bigint>"
    before = ("hit_spans", "hit_items")
    blocks = phrase_blocks(items, item_text, item_id, window)
    for number, (phrases, more) in enumerate(blocks):
        make = partial(_search_work, spark.sparkContext.broadcast(tuple(phrases)))
        # Between blocks the text goes along, and each block's result is written.
        along = [*kept.values(), "text"] if more else list(kept.values())
        found = map_texts(source, "text", along, fields, make, beside=before)
        if more:
            found.write.parquet(f"{scratch}/{number}")
            source = spark.read.parquet(f"{scratch}/{number}")
    return found.select(*(F.col(k).alias(name) for name, k in kept.items()), "n_words", *before)


def _cut_work() -> TextWork:
    def cut(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
        if not spans:
            return raw
        begin, end = token_borders(LETTERS_AND_DIGITS[LOWER[np.frombuffer(raw, np.uint8)]])
        out, at = [], 0
        for first, last in spans:
            out.append(raw[at : begin[first]])
            at = end[last - 1]
        return b"".join([*out, raw[at:]])

    def work(batch: pa.RecordBatch) -> list[pa.Array]:
        spans, texts = batch.columns
        out = [
            cut(raw, _pairs(flat))
            for raw, flat in zip(as_bytes(texts), spans.to_pylist(), strict=True)
        ]
        kept = pa.array(out, pa.binary()).cast(pa.string())
        return [pa.compute.if_else(texts.is_valid(), kept, pa.scalar(None, pa.string()))]

    return work


def cut_spans(df: DataFrame, text: str, spans: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep`` and ``cut_text``: the text without the bytes from each span's first to last word.

    A null text stays null; without spans a text stays as it is.
    """
    return map_texts(df, text, keep, "cut_text string", _cut_work, beside=(spans,))
