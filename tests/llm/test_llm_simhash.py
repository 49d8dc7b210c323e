import random

import numpy as np
import odd
import pytest
import xxhash

from stockweek.llm import simhash
from stockweek.llm.components import component_labels
from stockweek.llm.simhash import drop_near_duplicates, fingerprint, near_duplicates


def brute_fingerprint(text, width=4):
    words = odd.words(odd.lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles or [" ".join(words)]]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits):
    """The first index of each group, by comparing all pairs."""
    group = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= bits and group[i] != group[j]:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = [new if g == old else g for g in group]
    return group


@pytest.mark.parametrize("text", ["", "one", "a b c", "A b C d", "a b c d e " * 9, "ÄÖ ß\x0b日 本"])
def test_fingerprint(text):
    assert fingerprint(text.encode()) == brute_fingerprint(text)


def test_spark_has_the_same_hash(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(F.xxhash64(F.lit("one two three four")).alias("h")).first()
    assert row["h"] % (1 << 64) == xxhash.xxh64_intdigest("one two three four", 42)


def test_odd_documents(spark):
    rows = odd.texts()
    found = near_duplicates(odd.documents(spark))
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    got = sorted(((r[0], r[1] % (1 << 64), r[2]) for r in found.collect()), key=str)
    prints = [brute_fingerprint(t) for _, t in rows]
    group = brute_groups(prints, 4)
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = [(i, p, least.get(g)) for (i, _), p, g in zip(rows, prints, group, strict=True)]
    assert got == sorted(want, key=str)


def crowd(n, seed):
    """Fingerprints in dense groups, in chains and far apart."""
    rng = random.Random(seed)
    base = [rng.getrandbits(64) for _ in range(8)]
    found = set(base)
    while len(found) < n // 2:
        x = rng.choice(base)
        for _ in range(rng.randint(1, 3)):
            x ^= 1 << rng.randrange(64)
        found.add(x)
    x = rng.getrandbits(64)
    while len(found) < 2 * n // 3:
        for _ in range(4):
            x ^= 1 << rng.randrange(64)
        found.add(x)
    while len(found) < n:
        found.add(rng.getrandbits(64))
    return sorted(found)


@pytest.mark.parametrize("count", [300, 1 << 24, 1 << 40])
def test_links_join_what_all_pairs_join(spark, tmp_path, monkeypatch, count):
    """For any number of tables, with small and large buckets."""
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 16)
    prints = crowd(500, 3)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p, p) for p in signed], "fingerprint bigint, node bigint")
    links = simhash.near_links(classes, 4, count)
    labels = {r["node"]: r["label"] for r in component_labels(links, f"{tmp_path}/g").collect()}
    want = brute_groups(prints, 4)
    for i, a in enumerate(signed):
        for j in range(i):
            same = labels.get(a, a) == labels.get(signed[j], signed[j])
            assert same == (want[i] == want[j])


def test_a_bucket_passes_on_no_more_links_than_members():
    prints = np.array(crowd(400, 5), np.uint64)
    links = simhash._bucket_links(prints, np.zeros(len(prints), np.int64), 4)
    assert len(links) < len(prints)
    small = np.repeat(np.arange(10), 40)
    assert len(simhash._bucket_links(prints, small, 4)) < len(prints)


def test_pivot_table_never_discards_a_near_pair():
    prints = np.array(crowd(300, 7), np.uint64)
    table = simhash.pivot_table(prints).astype(int)
    for i in range(len(prints)):
        near = np.bitwise_count(prints ^ prints[i]) <= 4
        assert (np.abs(table - table[:, [i]]).max(axis=0)[near] <= 4).all()


@pytest.mark.parametrize("bits", [3, 4])
def test_each_pair_within_the_distance_shares_a_bucket(bits):
    rng = random.Random(2)
    for count in (10, 1 << 20, 1 << 30, 1 << 50):
        masks = simhash._blocks(count, bits)
        for _ in range(300):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), bits):
                b ^= 1 << bit
            assert any(a & m == b & m for m in masks)


def test_chain_of_components(spark, tmp_path):
    rng = random.Random(4)
    names = rng.sample(range(10**9), 300)
    pairs = [(names[i], names[i + 1]) for i in range(299) if i not in (99, 199)]
    pairs += [(a, a) for a in names[:3]] + pairs[:20]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    labels = {r["node"]: r["label"] for r in component_labels(edges, f"{tmp_path}/g").collect()}
    for part in (names[:100], names[100:200], names[200:]):
        assert {labels[x] for x in part} == {min(part)}


def test_empty_table(spark):
    assert near_duplicates(odd.documents(spark, [])).collect() == []


def test_one_document_of_each_group_stays(spark):
    text = " ".join(odd.WORDS)
    docs = odd.documents(spark, [(2, text), (1, text), (None, text), (3, "all else"), (4, None), (5, "")])
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None) == [1, 3, 4]


@pytest.mark.parametrize("broadcast", [0, 32 << 20])
def test_one_row_of_each_group_stays(spark, monkeypatch, broadcast):
    """Every row counts: ids that are null or repeat, and repeated rows."""
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", broadcast)
    copied, clean, other = " ".join(odd.WORDS), "a clean text of its own, held once", "all else"
    rows = [
        (1, copied), (2, copied), (2, clean), (None, copied),  # id 2 repeats, one of them a copy
        (3, other), (3, other), (3, other.upper()), (None, None), (None, ""),
        (7, "a row that is there twice over"), (7, "a row that is there twice over"),
        (7, "and once with a text unlike it"), (8, "and once with a text unlike it"), (9, "single"),
    ]
    docs = odd.documents(spark, rows)
    kept = drop_near_duplicates(docs.repartition(3))
    assert kept.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"] or "") for r in kept.collect()), key=str)
    want = [
        (1, copied), (2, clean), (3, other.upper()), (None, ""), (9, "single"),
        (7, "a row that is there twice over"), (7, "and once with a text unlike it"),
    ]
    assert got == sorted(want, key=str)


def test_rows_of_odd_documents_that_stay(spark):
    rows = odd.texts()
    prints = [brute_fingerprint(t) for _, t in rows]
    group = brute_groups(prints, 4)
    best = {}
    for (i, t), p, g in zip(rows, prints, group, strict=True):
        key = (i is None, i or 0, p - (1 << 64) if p >> 63 else p, (t or "").encode())
        best[g] = min(best.get(g, key), key)
    got = drop_near_duplicates(odd.documents(spark)).collect()
    found = [(r["doc_id"], (r["text"] or "").encode()) for r in got]
    want = [(None if none else i, t) for none, i, _, t in best.values()]
    assert sorted(found, key=str) == sorted(want, key=str)


@pytest.mark.parametrize("broadcast", [0, 32 << 20])
def test_a_large_bucket_is_cut_and_loses_no_link(spark, tmp_path, monkeypatch, broadcast):
    """One group that shares most of its bits: its buckets hold nearly all members."""
    monkeypatch.setattr(simhash, "CHUNK", 30)
    monkeypatch.setattr(simhash, "SMALL_BUCKET", 16)
    monkeypatch.setattr(simhash, "BROADCAST_BYTES", broadcast)
    rng = random.Random(6)
    base = rng.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 6))) for _ in range(300)}
    prints = sorted(prints | set(crowd(60, 8)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    classes = spark.createDataFrame([(p, p) for p in signed], "fingerprint bigint, node bigint")
    compared = []
    deal = simhash._dealt
    monkeypatch.setattr(simhash, "_dealt", lambda b: compared.append((b, deal(b))) or compared[-1][1])
    links = simhash.near_links(classes, 4, 300)
    (before, after), = compared
    largest = max(r["count"] for r in before.groupBy("t", "k").count().collect())
    assert largest > 120
    assert max(r["count"] for r in after.groupBy("t", "k", "pair").count().collect()) < 100
    labels = {r["node"]: r["label"] for r in component_labels(links, f"{tmp_path}/g").collect()}
    want = brute_groups(prints, 4)
    for i, a in enumerate(signed):
        for j in range(i):
            assert (labels.get(a, a) == labels.get(signed[j], signed[j])) == (want[i] == want[j])


def plain_fingerprint(text, width=4):
    import xxhash

    w = odd.words(odd.lower(text))
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("width", [1, 2, 4])
@pytest.mark.parametrize("piece", [1, 7, 30, 1 << 18])
def test_fingerprints_of_texts_in_runs(monkeypatch, piece, width):
    monkeypatch.setattr(simhash, "PIECE", piece)
    texts = ["", " ", "one", "a b", "a b c", "a b c d", "A\tb\nc  d e", "x" * 50 + " y", "many words go here " * 20]
    for text in texts + ["Ö ä\x85ß \x0bZ " * 9]:
        assert simhash.fingerprint(text.encode(), width) == plain_fingerprint(text, width)


def test_memory_of_a_long_text():
    import tracemalloc

    raw = b"the quick brown fox jumps over the lazy dog and so on " * 200_000  # 10.8 MB
    tracemalloc.start()
    simhash.fingerprint(raw)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 80e6


def test_rows_that_differ_in_another_column_only(spark):
    """Whatever the partitions, the same one stays."""
    schema = "doc_id bigint, text string, tag string, n int"
    rows = [(1, "same text of all rows here", t, n) for n, t in enumerate("dbaacx")]
    rows.append((2, "same text of all rows here", "a", 0))
    kept = set()
    for parts in (1, 3, 7):
        df = spark.createDataFrame(rows, schema).repartition(parts)
        found = [tuple(r) for r in simhash.drop_near_duplicates(df).collect()]
        assert len(found) == 1
        kept.add(found[0])
    assert len(kept) == 1


def test_ids_are_integers(spark):
    df = spark.createDataFrame([("a", "x")], "doc_id string, text string")
    for work in (simhash.near_duplicates, simhash.drop_near_duplicates):
        with pytest.raises(TypeError, match="ids must be integers"):
            work(df)
