import re
from collections import defaultdict

import numpy as np
import odd
import pytest

from stockweek.llm import line_dedup
from stockweek.llm.line_dedup import dedup_lines
from stockweek.llm.perfect_hash import LineIndex, PerfectHash


def expected(rows):
    """Brute force: what every row keeps, how many lines it had, how many go."""
    key = lambda line: odd.lower(re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line))
    order = lambda i: (i is not None, i or 0)
    holders = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 10:
                holders[key(line)].add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [
            x
            for x in lines
            if len(holders[key(x)]) < 2 or i == min(holders[key(x)], key=order)
        ]
        out.append((i, None if text is None else "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


def found(df, **options):
    rows = dedup_lines(df, **options).collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_odd_documents(spark):
    assert found(odd.documents(spark)) == expected(odd.texts())


def test_hot_lines_and_shards(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    rows = [
        (i, f"one line that every document has\nnumber {i % 40} of the lines\nonly in {i:09d}")
        for i in range(3000)
    ]
    assert found(odd.documents(spark, rows)) == expected(rows)


def test_empty_tables(spark):
    assert found(odd.documents(spark, [])) == []
    assert found(odd.documents(spark, [(1, None)])) == [(1, None, 1, 0)]


def test_all_columns_can_be_kept(spark):
    docs = odd.documents(spark)
    kept = dedup_lines(docs, keep=tuple(docs.columns))
    assert kept.columns == [c for c in docs.columns if c != "kept_text"] + [
        "kept_text", "n_lines", "n_dropped"
    ]
    assert kept.count() == docs.count()


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_perfect_hash_is_minimal(n):
    rng = np.random.default_rng(n)
    high, low = (rng.integers(-(1 << 63), (1 << 63) - 1, n) for _ in range(2))
    slots = PerfectHash.build(high, low).slots(high, low)
    assert sorted(slots.tolist()) == list(range(n))


def test_index_survives_its_bytes_and_tells_strangers():
    rng = np.random.default_rng(1)
    high, low = (rng.integers(-(1 << 63), (1 << 63) - 1, 5000) for _ in range(2))
    counts, owners = np.arange(5000) % 3 + 1, np.arange(5000)
    index = LineIndex.from_bytes(LineIndex.build(high, low, counts, owners).to_bytes())
    other = index.shared_elsewhere(high, low, np.full(5000, 7))
    assert (other == ((counts >= 2) & (owners != 7))).all()
    assert not index.shared_elsewhere(low, high, np.full(5000, 7)).any()


@pytest.mark.parametrize("n", [1, 10_000])
def test_strangers_with_the_same_low_bits_are_no_hot_lines(n):
    rng = np.random.default_rng(n)
    high, low, other = (rng.integers(-(1 << 63), (1 << 63) - 1, n) for _ in range(3))
    index = LineIndex.build(high, low, np.full(n, 5000), np.zeros(n, np.int64), whole=True)
    index = LineIndex.from_bytes(index.to_bytes())
    doc = np.full(n, 7)
    assert index.shared_elsewhere(high, low, doc).all()
    for _ in range(20):
        at = rng.integers(0, n, 100_000)
        strangers = rng.integers(-(1 << 63), (1 << 63) - 1, len(at))
        same_low32 = (strangers & ~0xFFFFFFFF) | (low[at] & 0xFFFFFFFF)
        doc = np.full(len(at), 7)
        assert not index.shared_elsewhere(strangers, same_low32, doc).any()
        assert not index.shared_elsewhere(strangers, low[at], doc).any()
        assert not index.shared_elsewhere(high[at], same_low32, doc).any()


def test_ids_are_integers(spark):
    with pytest.raises(TypeError, match="ids must be integers"):
        dedup_lines(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_equal_keys_are_refused():
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.array([1, 1]), np.array([2, 2]))
