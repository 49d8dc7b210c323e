import zlib
from hashlib import sha256

import odd
import pytest
from pyspark.sql import functions as F

from stockweek.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return sha256(text.encode()).hexdigest()


def leaf_of(row):
    values = [None if v is None else str(v) for v in row]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def tree(nodes):
    """The root, and the siblings of each node level by level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = range(i // 16 * 16, min(len(nodes), i // 16 * 16 + 16))
            ways[k].append(([nodes[j] for j in run if j < i], [nodes[j] for j in run if j > i]))
        nodes = [h("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at = [i // 16 for i in at]
    return nodes[0], ways


def fold(leaf, way):
    for left, right in way:
        leaf = h("".join([*left, leaf, *right]))
    return leaf


def brute(rows):
    """Of (id, source, lang, n_chars, text): sorted tuples of id, leaf, subroot, root, proof."""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf_of(row)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s])]) for s in order}
    root, upper = tree([trees[s][0] for s in order])
    out = []
    for s, way_up in zip(order, upper, strict=True):
        for (known, i, leaf), way in zip(sorted(by_source[s]), trees[s][1], strict=True):
            siblings = "".join("".join([*a, *b]) for a, b in [*way, *way_up])
            assert fold(leaf, [*way, *way_up]) == root
            out.append((i if known else None, leaf, trees[s][0], root, siblings))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, lang string, n_chars bigint, text string")


def found(df):
    rows = merkle.merkle_manifest(df, FIELDS)
    rows = rows.withColumn("folded", merkle.root_from_proof(F.col("leaf"), *map(F.col, ("proof", "places", "runs"))))
    out = rows.collect()
    assert all(r["folded"] == r["root"] for r in out)
    return sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof"]) for r in out), key=str)


@pytest.mark.parametrize("levels", [0, 1, 2])
@pytest.mark.parametrize("partitions", [1, 7])
def test_brute_force_with_few_and_many_blocks(spark, monkeypatch, levels, partitions):
    """Small blocks, so that a few hundred rows need several rounds of swaps."""
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK_ROWS", 16**levels)
    sizes = {None: 1, "": 16, "a": 17, "b": 300, "ö": 256, "z": 2, **{f"s{i}": 1 + i % 3 for i in range(20)}}
    rows = [(i * 7 % 1000 - 5, s, None, i, f"text {i}") for s, n in sizes.items() for i in range(n)]
    df = table(spark, rows).repartition(partitions)
    assert found(df) == brute(rows)


def test_many_sources_and_a_hot_one(spark):
    rows = [(i, "hot", "de", None, "x") for i in range(5000)]
    rows += [(i, f"s{i:04}", None, 1, None) for i in range(600)]
    assert found(table(spark, rows).repartition(5)) == brute(rows)


def test_ties_repeated_rows_and_no_ids(spark):
    rows = [(1, "a", None, None, "same")] * 40 + [(None, "a", None, None, f"t{i % 3}") for i in range(20)]
    rows += [(1, "a", None, None, "other"), (None, None, None, None, None)]
    assert found(table(spark, rows).repartition(4)) == brute(rows)


def test_odd_documents(spark):
    df = odd.documents(spark)
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in df.select(*names).collect()]
    assert found(df) == brute(rows)
    kept = merkle.merkle_manifest(df, FIELDS, keep=("text", "a.b", "c0", "score"))
    assert kept.columns == ["text", "a.b", "c0", "score", "leaf", "subroot", "root", "proof", "places", "runs"]
    assert kept.filter("c0 = 'x'").count() == len(rows)


def test_empty_table_and_single_row(spark):
    assert found(table(spark, [])) == []
    rows = [(1, "a", "b", 2, "c")]
    assert found(table(spark, rows)) == [(1, leaf_of(rows[0]), leaf_of(rows[0]), leaf_of(rows[0]), "")]


def test_a_changed_leaf_or_proof_does_not_verify(spark):
    rows = [(i, "a", None, i, f"Text {i}") for i in range(50)]
    df = merkle.merkle_manifest(table(spark, rows), FIELDS)
    way = [F.col(c) for c in ("places", "runs")]
    wrong = df.select(
        merkle.root_from_proof(F.sha2("leaf", 256), F.col("proof"), *way).alias("a"),
        merkle.root_from_proof(F.col("leaf"), F.translate("proof", "0", "1"), *way).alias("b"),
        "root",
    )
    assert wrong.filter("a = root or b = root").count() == 0


def test_crc_of_the_query_is_unsigned(spark):
    df = spark.range(0, 2000).select("id", F.crc32(F.col("id").cast("string")).alias("crc"))
    assert all(r["crc"] == zlib.crc32(str(r["id"]).encode()) for r in df.collect())
