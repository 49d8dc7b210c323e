import random
import re

import numpy as np
import odd
import pytest

from stockweek.llm import decontaminate
from stockweek.llm.decontaminate import cut_spans, find_contamination
from stockweek.llm.fm_index import FmIndex, WaveletTree, suffix_order

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(WORD, odd.lower(text or ""))


def expected(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(len(w) - 9) if len(w) >= 10 else range(bool(w)):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, text in rows:
        w = words(text)
        hit, held = set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                if found := windows.get(tuple(w[at : at + n])):
                    hit.update(range(at, at + n))
                    held |= found
        out.append((i, len(w), sorted(hit), sorted(held - {None})))
    return sorted(out, key=str)


def found(df, items):
    out = []
    for r in find_contamination(df, items).collect():
        spans = r["hit_spans"]
        assert spans == sorted(spans)
        hit = [x for a, b in zip(spans[::2], spans[1::2], strict=True) for x in range(a, b)]
        out.append((r["doc_id"], r["n_words"], hit, r["hit_items"]))
    return sorted(out, key=str)


ITEMS = [
    (1, " ".join(odd.WORDS)),
    (2, "Katze sitzt, AUF der"),
    (2, "row of number seven"),
    (3, None),
    (4, "!!! ..."),
    (10, "日本語"),
    (-7, " ".join(odd.WORDS[2:13])),
    (None, "without an id"),
    (12, " ".join(["ö"] * 12)),
]


def items_frame(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id bigint, text string, doc_id string")


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_odd_documents(spark, monkeypatch, block):
    """In one block of phrases, and in several."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    got = found(odd.documents(spark), items_frame(spark, ITEMS))
    assert got == expected(odd.texts(), ITEMS)


@pytest.mark.parametrize("passage", [12, 40, 1 << 16])
def test_long_items_in_passages(spark, monkeypatch, passage):
    monkeypatch.setattr(decontaminate, "PASSAGE_WORDS", passage)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 100)
    rng = random.Random(2)
    items = [(i, " ".join(rng.choices("abcdef", k=n))) for i, n in enumerate((300, 45, 44, 12, 10, 9, 1))]
    docs = [(i, " ".join(rng.choices("abcdef", k=80))) for i in range(20)]
    docs += [(100 + i, "x " + items[0][1][i * 20 : i * 20 + 60] + " y") for i in range(20)]
    docs += [(200 + i, t) for i, (_, t) in enumerate(items)]
    got = found(odd.documents(spark, docs), items_frame(spark, items))
    assert got == expected(docs, items)


def test_blocks_are_bounded(spark, monkeypatch):
    """By words and ids, for equal items, long ones and those without words."""
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 3000)
    monkeypatch.setattr(decontaminate, "PASSAGE_WORDS", 1000)
    same = " ".join(f"w{i}" for i in range(20))
    items = [(i, same) for i in range(5000)] + [(9000, " ".join(f"v{i}" for i in range(20_000)))]
    items += [(10_000 + i, "!!!") for i in range(5000)]
    frame = items_frame(spark, items)
    blocks = list(decontaminate.phrase_blocks(frame, "text", "item_id", 10))
    sizes = [len(p.items) + len(p.vocabulary) for p, _ in blocks]
    assert max(sizes) <= 3000 and [more for _, more in blocks] == [True] * (len(blocks) - 1) + [False]
    assert sum(sizes) < 5000 + 64 * 20 + 21_000
    docs = [(1, f"x {same} y"), (2, " ".join(f"v{i}" for i in range(500, 515)))]
    one, two = sorted(find_contamination(odd.documents(spark, docs), frame).collect())
    assert one["hit_items"] == list(range(5000)) and one["hit_spans"] == [1, 21]
    assert two["hit_items"] == [9000] and two["hit_spans"] == [0, 15]


def test_item_ids_are_integers(spark):
    items = spark.createDataFrame([("a", "x")], "item_id string, text string")
    with pytest.raises(TypeError, match="ids must be integers"):
        find_contamination(odd.documents(spark), items)


def test_small_shards(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 50)
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abc", k=rng.randint(0, 60)))) for i in range(60)]
    items = [(i, " ".join(rng.choices("abc", k=rng.randint(1, 14)))) for i in range(40)]
    got = found(odd.documents(spark, rows), items_frame(spark, items))
    assert got == expected(rows, items)


def test_empty_tables(spark):
    docs, none = odd.documents(spark), odd.documents(spark, [])
    assert found(none, items_frame(spark, ITEMS)) == []
    assert found(docs, items_frame(spark, [])) == expected(odd.texts(), [])


def test_spans_are_cut_from_the_text(spark):
    docs = odd.documents(spark, [(1, "Keep this: Katze sitzt auf der, end."), (2, None), (3, "none")])
    hits = find_contamination(docs, items_frame(spark, ITEMS), keep=("doc_id", "text"))
    cut = {r["doc_id"]: r["cut_text"] for r in cut_spans(hits, "text", "hit_spans", ("doc_id",)).collect()}
    assert cut == {1: "Keep this: , end.", 2: None, 3: "none"}


@pytest.mark.parametrize("largest", [1, 2, 5, 200])
def test_index_finds_all_occurrences(largest):
    rng = np.random.default_rng(largest)
    text = np.append(rng.integers(0, largest + 1, 3000), 0)
    index = FmIndex(text, largest)
    patterns = np.zeros((300, 6), np.int64)
    lengths = rng.integers(1, 7, 300)
    for row, n in zip(patterns, lengths, strict=True):
        row[6 - n :] = rng.integers(1, largest + 1, n)
    first, last = index.search(patterns, lengths)
    for row, n, a, b in zip(patterns, lengths, first, last, strict=True):
        at = [i for i in range(len(text) - n + 1) if (text[i : i + n] == row[6 - n :]).all()]
        assert sorted(index.locate(np.arange(a, max(a, b))).tolist()) == at


def test_wavelet_tree_ranks_and_symbols():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 37, 1000)
    tree = WaveletTree(symbols, 6)
    assert (tree.access(np.arange(1000)) == symbols).all()
    for symbol in (0, 1, 36):
        at = np.arange(1001)
        want = np.concatenate([[0], np.cumsum(symbols == symbol)])
        assert (tree.rank(np.full(1001, symbol), at) == want).all()


def test_suffixes_are_sorted():
    rng = np.random.default_rng(5)
    symbols = np.append(rng.integers(1, 3, 400), 0)
    want = sorted(range(401), key=lambda i: symbols[i:].tolist())
    assert suffix_order(symbols).tolist() == want
